"""Alert messages: JSON encode/decode and the message sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerguard.config import DEFAULT_CONFIG, ScreeningConfig
from ledgerguard.schema import ALERT_COLUMNS, ALERT_SCHEMA

#: A message as file sinks hold it.
MESSAGE = StructType([StructField("value", StringType(), True)])


def encode_alerts(alerts: DataFrame) -> DataFrame:
    """One JSON object per alert in ``value`` (NULL fields are omitted), no key."""
    return alerts.select(F.to_json(F.struct(*[F.col(c) for c in ALERT_COLUMNS])).alias("value"))


def decode_alerts(messages: DataFrame, value_col: str = "value") -> DataFrame:
    data = F.from_json(F.col(value_col).cast("string"), ALERT_SCHEMA)
    return messages.select(data.alias("a")).select("a.*")


def write_alert_messages(encoded: DataFrame, cfg: ScreeningConfig = DEFAULT_CONFIG,
                         fmt: str = "kafka", path: str | None = None,
                         options: dict | None = None, mode: str = "append") -> None:
    """Publish encoded alerts.

    ``fmt="kafka"`` writes to ``cfg.alert_topic``; ``kafka.bootstrap.servers``
    and other producer options come from ``cfg.kafka_options`` / ``options``
    (the connector jar must be on the classpath). ``json``/``text``/``parquet``
    write message files under ``path`` instead (``mode="overwrite"`` on a
    per-batch folder makes a replayed batch idempotent).
    """
    opts = dict(cfg.kafka_options)
    opts.update(options or {})
    if fmt == "kafka":
        w = encoded.write.format("kafka").option("topic", cfg.alert_topic)
        for k, v in opts.items():
            w = w.option(k, v)
        w.save()
    elif fmt in ("json", "text", "parquet"):
        if path is None:
            raise ValueError("path is required for file message sinks")
        encoded.write.mode(mode).format(fmt).options(**opts).save(path)
    else:
        raise ValueError(f"unknown alert sink format {fmt!r}")
