"""Stateful streaming rules (event-time state bounded by the watermark)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampNTZType

from ledgerguard.config import DEFAULT_CONFIG, FRAUD_TYPE_TRAVEL, ScreeningConfig
from ledgerguard.functions.expressions import as_instant, travel_reason, wall_clock_from_micros
from ledgerguard.operators.rules import WINDOW_START, members_of, travel_alerts_of
from ledgerguard.operators.travel import slicing
from ledgerguard.schema import ALERT_SCHEMA, EVENT_TIME, TRANSACTION_COLUMNS
from ledgerguard.sources.lakes import read_parquet_or_empty


def with_event_watermark(stream: DataFrame, cfg: ScreeningConfig = DEFAULT_CONFIG) -> DataFrame:
    """Event time as an instant (watermarks reject TIMESTAMP_NTZ) plus the watermark.

    Rows older than ``max event time - cfg.watermark_delay`` are dropped by the
    stateful operators downstream; the progress reports count them
    (``stateOperators[].numRowsDroppedByWatermark``).
    """
    return (stream.withColumn(EVENT_TIME, as_instant(stream, EVENT_TIME))
                  .withWatermark(EVENT_TIME, cfg.watermark_delay))


def wall_clock(c: Column) -> Column:
    """TIMESTAMP instant -> TIMESTAMP_NTZ wall clock in UTC (session-zone free)."""
    return wall_clock_from_micros(F.unix_micros(c))


def flagged_windows(stream: DataFrame, cfg: ScreeningConfig = DEFAULT_CONFIG) -> DataFrame:
    """(user_id, window_start) of tumbling windows seen in more than one country.

    Unlike the per-batch rule, a pair split over two micro-batches is found. Run
    in ``update`` mode, into a ``MemberSink``: a batch emits the flagged windows
    that it changed. All that is kept of a window is its least and greatest
    country, until the watermark passes its end; ids stay in the landing table.
    """
    g = (with_event_watermark(stream, cfg)
         .groupBy("user_id", F.window(F.col(EVENT_TIME), cfg.travel_window).alias("w"))
         .agg(F.min("country").alias("c_min"), F.max("country").alias("c_max")))
    return g.where(F.col("c_min") != F.col("c_max")).select("user_id", wall_clock(F.col("w.start")).alias(WINDOW_START))


def stateful_session_travel(stream: DataFrame, cfg: ScreeningConfig = DEFAULT_CONFIG) -> DataFrame:
    """Session-window travel (``append`` mode: a session is emitted once the
    watermark passes its end, so the last open sessions wait for later data)."""
    s = (with_event_watermark(stream.where(F.col("user_id").isNotNull()), cfg)
         .groupBy("user_id", F.session_window(F.col(EVENT_TIME), cfg.travel_window).alias("s"))
         .agg(F.count(F.lit(1)).alias("transactions"), F.collect_set("country").alias("countries")))
    return (s.where(F.size("countries") > 1)
             .select("user_id", wall_clock(F.col("s.start")).alias("session_start"),
                     wall_clock(F.col("s.end")).alias("session_end"), "transactions",
                     F.concat_ws(", ", F.array_sort("countries")).alias("country"),
                     F.lit(FRAUD_TYPE_TRAVEL).alias("fraud_type"),
                     travel_reason(F.array_sort("countries"), cfg).alias("fraud_reason")))


def dedup_transactions(stream: DataFrame, cfg: ScreeningConfig = DEFAULT_CONFIG) -> DataFrame:
    """Drop redelivered transactions (same ``transaction_id``) within the watermark.

    Rows without an id (malformed messages) are not copies of one another: all
    of them pass.
    """
    rows = with_event_watermark(stream, cfg)
    return (rows.where(F.col("transaction_id").isNotNull())
            .dropDuplicatesWithinWatermark(["transaction_id"])
            .unionByName(rows.where(F.col("transaction_id").isNull())))


@dataclass
class UpsertSink:
    """``foreachBatch`` sink for ``update``-mode results.

    Each batch's changed rows go to ``path/batch_id=<n>`` (overwritten on
    replay); ``read`` keeps the latest version of each key.
    """

    path: str
    keys: tuple[str, ...]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
              .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("batch_id").parquet(self.path))

    def read(self, spark, schema=None) -> DataFrame:
        """Latest version per key; ``schema`` (the stream's) makes an empty sink readable."""
        from pyspark.sql.types import LongType, StructField, StructType
        full = None if schema is None else StructType(
            list(schema.fields) + [StructField("batch_id", LongType(), True)])
        df = read_parquet_or_empty(spark, self.path, full)
        value_cols = [c for c in df.columns if c not in self.keys and c != "batch_id"]
        latest = df.groupBy(*self.keys).agg(
            F.max_by(F.struct(*value_cols), F.col("batch_id")).alias("_v"))
        return latest.select(*self.keys, *[F.col(f"_v.{c}").alias(c) for c in value_cols])


@dataclass
class MemberSink:
    """``foreachBatch`` sink of ``flagged_windows``: fetches the members of those windows and keeps their alerts.

    ``landed`` gives the landing table in screened form: the table that the
    stream itself is read from, so that every row the stream has seen is there.
    It is read from the first to the last flagged window alone (a filter on
    ``event_time``, and on ``date`` where the table has that column). A window
    that changes again is fetched again; ``read`` keeps the latest alert.
    """

    path: str
    landed: Callable[[], DataFrame]
    cfg: ScreeningConfig = DEFAULT_CONFIG

    def __post_init__(self):
        self.sink = UpsertSink(self.path, keys=("user_id", WINDOW_START))

    def between(self, first, last) -> DataFrame:
        """Landed rows of the windows that start from ``first`` to ``last``."""
        rows = self.landed()
        end = F.lit(last) + F.expr(f"INTERVAL '{self.cfg.window_seconds}' SECOND")
        rows = rows.where((F.col(EVENT_TIME) >= F.lit(first)) & (F.col(EVENT_TIME) < end))
        if "date" in rows.columns:
            rows = rows.where(F.col("date").between(F.lit(first).cast("date"), end.cast("date")))
        return rows

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        keys = batch.persist()  # read twice; few
        try:
            span = keys.agg(F.min(WINDOW_START).alias("a"), F.max(WINDOW_START).alias("b")).first()
            if span["a"] is not None:
                members = members_of(self.between(span["a"], span["b"]), keys, self.cfg)
                self.sink(travel_alerts_of(members, self.cfg), batch_id)
        finally:
            keys.unpersist()

    def read(self, spark: SparkSession) -> DataFrame:
        window = StructType([StructField(WINDOW_START, TimestampNTZType(), True)])
        return self.sink.read(spark, StructType(ALERT_SCHEMA.fields + window.fields))


def stateful_trailing_travel(stream: DataFrame, cfg: ScreeningConfig = DEFAULT_CONFIG) -> DataFrame:
    """Trailing-window travel as a stream-stream left-semi join (``append`` mode).

    The rule of ``operators.travel.trailing_travel``: a row at ``t`` is flagged
    iff its user has a row in another country in ``[t - W, t]``, whichever of the
    two arrives first. Spark keeps and expires all state by the watermark.

    The context side is aggregated before the join, to the first and last time
    of each (user, slice, country). That decides exactly: a slice (``W / k``) is
    shorter than the window, so at most one end of the window lies in it, and
    some time of the slice is inside iff its last is not before ``t - W`` and its
    first not after ``t``. Context is shipped to the W-wide bucket of its slice
    and to the next one, so the join's keys are (user, bucket): a probe meets
    two buckets of slices by country however busy the user is, and no pairs of
    rows are made.

    A row is emitted once, when the watermark has passed the slice of the row
    that flags it; ``live_travel`` does not wait for that.
    """
    w, k, g = slicing(cfg)
    if k < 2:
        raise ValueError("trailing travel on a stream needs two slices in a window at least")
    rows = (with_event_watermark(stream, cfg)
            .where(F.col("user_id").isNotNull() & F.col("country").isNotNull() & F.col(EVENT_TIME).isNotNull()))
    t = F.unix_micros(F.col(EVENT_TIME))
    slices = (rows.groupBy("user_id", F.window(F.col(EVENT_TIME), f"{g} microseconds").alias("slice"), "country")
              .agg(F.min(t).alias("_first"), F.max(t).alias("_last")))
    bucket = F.floor(F.unix_micros("slice.start") / F.lit(w))
    context = slices.select(F.col("user_id").alias("_user"), F.col("country").alias("_country"), "_first", "_last",
                            F.window_time("slice").alias("_end"), F.explode(F.array(bucket, bucket + 1)).alias("_bucket"))
    probes = rows.withColumn("_own_bucket", F.floor(t / F.lit(w)))
    inside = ((F.col("_user") == F.col("user_id")) & (F.col("_bucket") == F.col("_own_bucket"))
              & (F.col("_country") != F.col("country")) & (F.col("_last") >= t - F.lit(w)) & (F.col("_first") <= t)
              # the same in event time, which is what lets Spark expire both sides
              & (F.col("_end") >= F.col(EVENT_TIME) - F.expr(f"INTERVAL '{w // 1_000_000}' SECOND"))
              & (F.col("_end") <= F.col(EVENT_TIME) + F.expr(f"INTERVAL '{-(-g // 1_000_000)}' SECOND")))
    return probes.join(context, inside, "left_semi").select(*TRANSACTION_COLUMNS)


__all__ = ["with_event_watermark", "flagged_windows", "MemberSink", "stateful_session_travel",
           "stateful_trailing_travel", "dedup_transactions", "UpsertSink", "wall_clock",
           "rows_dropped_by_watermark"]


def rows_dropped_by_watermark(query) -> int:
    """Late rows dropped by the stateful operators in the last micro-batch.

    Spark counts rows at the state store input, i.e. after map-side partial
    aggregation: late rows sharing a group key count once.
    """
    p = query.lastProgress or {}
    return sum(int(op.get("numRowsDroppedByWatermark", 0)) for op in p.get("stateOperators", []))
