"""Per-micro-batch routing: alerts to the message sink and fraud lake, valid
rows to the valid lake, and one metrics row per batch.

The rules are the batch operators; ``foreachBatch`` is only the multi-sink
fan-out. A micro-batch is cached once; its counts are observed on a write.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ledgerguard.config import (DEFAULT_CONFIG, FRAUD_TYPE_HIGH_VALUE, FRAUD_TYPE_TRAVEL,
                                ScreeningConfig)
from ledgerguard.functions.expressions import as_instant
from ledgerguard.operators.rules import all_alerts, drop_landed, fraud_lake_rows, valid_transactions
from ledgerguard.schema import (ALERT_SCHEMA, CORRUPT_COLUMN, EVENT_TIME, TRANSACTION_COLUMNS,
                                TRANSACTION_SCHEMA)
from ledgerguard.session import glob_exists, path_exists
from ledgerguard.sinks.alerts import encode_alerts, write_alert_messages
from ledgerguard.sinks.commits import commit, commit_root, new_attempt
from ledgerguard.sinks.lakes import write_attempt
from ledgerguard.sources.json_ingest import malformed_reason
from ledgerguard.sources.lakes import read_fraud_lake, read_valid_lake

METRICS_SCHEMA = StructType([StructField(n, LongType(), True) for n in (
    "batch_id", "raw", "valid", "high_value", "unrouted", "malformed", "alerts", "travel_alerts")])


QUARANTINE_SCHEMA = StructType([StructField(c, StringType(), True) for c in
                                ("value", "transaction_id", "user_id", "country", "reason")])

#: Late rows: the transaction, the watermark that it came after, and its batch.
LATE_SCHEMA = StructType(TRANSACTION_SCHEMA.fields + [StructField("watermark_ms", LongType(), True),
                                                      StructField("batch_id", LongType(), True)])

#: Event time as an instant, which carries the watermark of a stream whose late rows are kept.
INSTANT = "_instant"


@dataclass
class BatchRouter:
    """``foreachBatch`` callback for screened-form micro-batches.

    ``alert_format``: ``kafka`` (publish to ``cfg.alert_topic``), ``json`` /
    ``text`` / ``parquet`` (message files under ``alert_path``) or ``None``.
    All that a batch writes is one attempt, committed last (see
    ``sinks.commits``): readers see all of it or nothing, and a batch that runs
    again takes the place of its former try. A broker topic is at-least-once.
    ``run_id`` names the writer: ``start_screening`` keeps it with the
    checkpoint, a router used by itself gets a new one.

    ``quarantine_path`` takes the rows that cannot be routed, with their text
    and the reason. ``late_path`` takes the rows that came after the watermark
    of their batch, which stateful rules leave out; they are routed like others
    here. It needs ``checkpoint``, whose offset log says what that watermark was.

    ``drop_copies`` leaves out rows whose id the lakes already hold, however
    long ago, or as far back as ``copy_days`` days before the batch's first event
    (lake dates prune the scan). What an earlier try of the same batch left does
    not count.

    ``cache=False`` is for tables: each sink then reads its few columns of the
    input again, where caching would copy the whole table to the executors'
    disks. Counts are observed on the writes, and messages are made from the
    fraud rows just written, so neither costs a read of the input.
    """

    valid_path: str
    fraud_path: str
    cfg: ScreeningConfig = DEFAULT_CONFIG
    alert_format: str | None = None
    alert_path: str | None = None
    metrics_path: str | None = None
    quarantine_path: str | None = None
    late_path: str | None = None
    checkpoint: str | None = None
    run_id: str = field(default_factory=lambda: f"run-{uuid.uuid4().hex}")
    cache: bool = True
    drop_copies: bool = False
    copy_days: int | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        attempt = new_attempt()
        if self.drop_copies:
            batch = drop_landed(batch, self._landed(batch, int(batch_id)))
        rows = batch.persist() if self.cache else batch
        try:
            self._write(rows, int(batch_id), attempt)
        finally:
            if self.cache:
                rows.unpersist()
        commit(batch.sparkSession, commit_root(self.valid_path), self.run_id, batch_id, attempt)

    def _write(self, rows: DataFrame, batch_id: int, attempt: str) -> None:
        spark = rows.sparkSession
        write_attempt(fraud_lake_rows(all_alerts(rows, self.cfg)), self.fraud_path, attempt, self.run_id, batch_id)
        written = self._fraud(spark, attempt)
        if self.alert_format:
            path = f"{self.alert_path}/attempt={attempt}" if self.alert_path else None
            write_alert_messages(encode_alerts(written), self.cfg, self.alert_format, path)
        parsed = CORRUPT_COLUMN in rows.columns
        bad = malformed_reason().isNotNull() if parsed else F.col("transaction_id").isNull() | F.col("amount").isNull()
        counts, seen = self._counts(bad), Observation()
        keep_bad = bool(self.quarantine_path and parsed)
        # a write without a shuffle: adaptive planning would drop the counts with an empty shuffle
        counted = rows.observe(seen, *counts) if self.metrics_path and keep_bad else rows
        if keep_bad:
            text = F.coalesce(CORRUPT_COLUMN, F.to_json(F.struct(*TRANSACTION_COLUMNS)))
            (counted.withColumn("reason", malformed_reason()).where(F.col("reason").isNotNull())
             .select(text.alias("value"), "transaction_id", "user_id", "country", "reason")
             .write.parquet(f"{self.quarantine_path}/attempt={attempt}"))
        if self.late_path:
            mark = batch_watermark_ms(spark, self.checkpoint, batch_id)
            (rows.where(F.unix_micros(INSTANT) < F.lit(mark * 1000))
             .select(*TRANSACTION_COLUMNS, F.lit(mark).cast("long").alias("watermark_ms"),
                     F.lit(batch_id).cast("long").alias("batch_id"))
             .write.parquet(f"{self.late_path}/attempt={attempt}"))
        write_attempt(valid_transactions(rows, self.cfg), self.valid_path, attempt, self.run_id, batch_id)
        if self.metrics_path:
            raw = seen.get if keep_bad else rows.agg(*counts).first().asDict()
            found = written.agg(F.count(F.lit(1)).alias("alerts"), F.count_if(
                F.col("fraud_type") == F.lit(FRAUD_TYPE_TRAVEL)).alias("travel_alerts")).first().asDict()
            row = {"batch_id": batch_id, **raw, **found}
            (spark.createDataFrame([tuple(row[f.name] for f in METRICS_SCHEMA)], METRICS_SCHEMA)
             .write.parquet(f"{self.metrics_path}/attempt={attempt}"))

    def _landed(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Ids in the lakes but for those of this batch's own earlier tries."""
        spark = batch.sparkSession
        fraud = read_fraud_lake(spark, self.fraud_path)
        rows = []
        for lake in (read_valid_lake(spark, self.valid_path), fraud.where(F.col("fraud_type") == FRAUD_TYPE_HIGH_VALUE)):
            if "run_id" in lake.columns:
                lake = lake.where(~((F.col("run_id") == self.run_id) & (F.col("batch_id") == batch_id)))
            rows.append(lake.select("transaction_id", "date"))
        landed = rows[0].union(rows[1])
        if self.copy_days is not None:
            first = batch.agg(F.min(EVENT_TIME).cast("date").alias("d")).first()["d"]
            if first is not None:
                landed = landed.where(F.col("date").isNull() | (F.col("date") >= F.date_sub(F.lit(first), self.copy_days)))
        return landed

    def _counts(self, bad) -> list:
        t, a = F.lit(float(self.cfg.high_value_threshold)), F.col("amount")
        return [F.count(F.lit(1)).alias("raw"), F.count_if(a <= t).alias("valid"), F.count_if(a > t).alias("high_value"),
                F.count_if(a.isNull()).alias("unrouted"), F.count_if(bad).alias("malformed")]

    def _fraud(self, spark: SparkSession, attempt: str) -> DataFrame:
        """The alerts that ``attempt`` has just written: their own folders alone."""
        pattern = f"{self.fraud_path}/date=*/attempt={attempt}"
        if not glob_exists(spark, pattern):
            return spark.createDataFrame([], ALERT_SCHEMA)
        return spark.read.schema(ALERT_SCHEMA).parquet(pattern)


def batch_watermark_ms(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The watermark, in milliseconds, that a batch began with, as the query's own offset log has it.

    The log is written before the batch runs, so that a batch that runs again
    splits its rows at the same place.
    """
    for r in spark.read.text(f"{checkpoint}/offsets/{int(batch_id)}").collect():  # three lines
        if r["value"].startswith("{") and "batchWatermarkMs" in r["value"]:
            return int(json.loads(r["value"])["batchWatermarkMs"])
    raise ValueError(f"no watermark of batch {batch_id} under {checkpoint}")


def checkpoint_run_id(spark: SparkSession, checkpoint: str) -> str:
    """The run id kept beside a checkpoint; a new checkpoint gets a new one."""
    path = f"{checkpoint.rstrip('/')}-run-id"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        rows = spark.createDataFrame([(f"run-{uuid.uuid4().hex}",)], "run_id string")
        rows.coalesce(1).write.mode("overwrite").text(path)
    return spark.read.text(path).first()[0]


def start_screening(stream: DataFrame, router: BatchRouter, checkpoint: str,
                    available_now: bool = False, query_name: str | None = None) -> StreamingQuery:
    """Start the routing query; trigger from ``cfg.trigger_interval`` unless
    ``available_now`` (process what is there, then stop)."""
    router.run_id = checkpoint_run_id(stream.sparkSession, checkpoint)
    if router.late_path:
        router.checkpoint = checkpoint
        stream = (stream.withColumn(INSTANT, as_instant(stream, EVENT_TIME))
                  .withWatermark(INSTANT, router.cfg.watermark_delay))
    w = stream.writeStream.foreachBatch(router).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else \
        w.trigger(processingTime=router.cfg.trigger_interval)
    return w.start()
