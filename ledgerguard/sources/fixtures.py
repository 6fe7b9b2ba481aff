"""Table-backed transactions: the ``events`` table mapped onto the wire schema.

``events(event_id, ts, user_id, event_type, value, props)`` becomes one
transaction per row. The branch country is picked by position ``k mod n`` with
``k`` read from the ``props`` JSON. Nothing is filtered, so work grows with the
table; Catalyst prunes the scan to the six columns used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerguard.config import CURRENCY, ScreeningConfig, DEFAULT_CONFIG
from ledgerguard.functions.expressions import epoch_micros


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def timestamp_text(df: DataFrame, name: str):
    """``yyyy-MM-dd HH:mm:ss.ffffff`` text of a TIMESTAMP_NTZ, independent of the
    session zone (``date_format`` would convert through it and move wall-clock
    times that fall in a daylight-saving gap)."""
    micros = F.pmod(epoch_micros(df, name), F.lit(1_000_000))
    return F.concat(F.substring(F.col(name).cast("string"), 1, 19), F.lit("."),
                    F.lpad(micros.cast("string"), 6, "0"))


def transactions_from_events(events: DataFrame, cfg: ScreeningConfig = DEFAULT_CONFIG) -> DataFrame:
    """Screened-form transactions (7 wire columns + ``event_time``) from events."""
    branches = F.array(*[F.lit(c) for c in cfg.branch_countries])
    k = F.get_json_object(F.col("props"), "$.k").try_cast("long")
    country = F.element_at(branches, (F.pmod(k, F.lit(len(cfg.branch_countries))) + 1).cast("int"))
    return events.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("user_id").cast("string").alias("user_id"),
        timestamp_text(events, "ts").alias("timestamp"),
        F.col("value").cast("double").alias("amount"),
        F.lit(CURRENCY).alias("currency"),
        F.col("event_type").alias("merchant_category"),
        country.alias("country"),
        F.col("ts").alias("event_time"),
    )


def fixture_transactions(spark: SparkSession, sf_dir: str,
                         cfg: ScreeningConfig = DEFAULT_CONFIG) -> DataFrame:
    return transactions_from_events(read_table(spark, sf_dir, "events"), cfg)
