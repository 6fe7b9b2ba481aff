"""Streaming sources: message broker (pass-through) and files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerguard.config import DEFAULT_CONFIG, ScreeningConfig


def kafka_source(spark: SparkSession, cfg: ScreeningConfig = DEFAULT_CONFIG,
                 starting_offsets: str = "earliest", options: dict | None = None) -> DataFrame:
    """Raw transaction messages from ``cfg.raw_topic`` (column ``value``).

    Options such as ``kafka.bootstrap.servers`` are passed through;
    ``minPartitions`` splits an oversized topic partition over several tasks.
    Needs the Kafka connector on the classpath.
    """
    r = spark.readStream.format("kafka")
    for k, v in kafka_options(cfg, starting_offsets, options).items():
        r = r.option(k, v)
    return r.load()


def kafka_options(cfg: ScreeningConfig = DEFAULT_CONFIG, starting_offsets: str = "earliest",
                  options: dict | None = None) -> dict:
    """Options of the broker source: a micro-batch is bounded, unless the given options say otherwise."""
    return {"subscribe": cfg.raw_topic, "startingOffsets": starting_offsets,
            "maxOffsetsPerTrigger": str(cfg.max_offsets_per_trigger), **cfg.kafka_options, **(options or {})}


def file_source(spark: SparkSession, path: str, fmt: str = "text",
                schema: StructType | None = None, max_files_per_trigger: int | None = 1,
                options: dict | None = None) -> DataFrame:
    """Files as a stream: ``text`` gives one message per line in ``value``."""
    r = spark.readStream.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path)
