"""Screening rules: high value, valid, tumbling impossible travel, alert union.

Each function maps a screened-form transaction DataFrame (wire columns plus
``event_time``) to another DataFrame and triggers no Spark action.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from ledgerguard.config import (FRAUD_TYPE_HIGH_VALUE, FRAUD_TYPE_TRAVEL, DEFAULT_CONFIG,
                                ScreeningConfig)
from ledgerguard.functions.expressions import (earliest_by_time, high_value_reason,
                                               is_branch_country, is_foreign_country, money_sum,
                                               partition_date, travel_reason)
from ledgerguard.schema import ALERT_COLUMNS, EVENT_TIME, TRANSACTION_COLUMNS

WINDOW_START = "window_start"


def _threshold(cfg: ScreeningConfig):
    return F.lit(float(cfg.high_value_threshold))


def high_value_alerts(tx: DataFrame, cfg: ScreeningConfig = DEFAULT_CONFIG) -> DataFrame:
    """Rule 1: ``amount > threshold`` (strict; NaN counts as above, NULL never)."""
    return (tx.where(F.col("amount") > _threshold(cfg))
              .select(*TRANSACTION_COLUMNS,
                      F.lit(FRAUD_TYPE_HIGH_VALUE).alias("fraud_type"),
                      high_value_reason(cfg).alias("fraud_reason")))


def valid_transactions(tx: DataFrame, cfg: ScreeningConfig = DEFAULT_CONFIG) -> DataFrame:
    """Rows routed to the valid lake: ``amount <= threshold``, plus the ``date`` partition.

    Only the amount is tested, so members of a travel alert with a small
    amount are valid too (as in the screened system); see
    ``valid_excluding_travel`` for the stricter routing.
    """
    return (tx.where(F.col("amount") <= _threshold(cfg))
              .select(*TRANSACTION_COLUMNS, lake_date(tx).alias("date")))


def lake_date(tx: DataFrame):
    """Partition date: the parsed wall-clock ``event_time`` when the rows carry it
    (no second parse of the text), else the date of the ``timestamp`` text."""
    if EVENT_TIME in tx.columns and isinstance(tx.schema[EVENT_TIME].dataType, TimestampNTZType):
        return F.col(EVENT_TIME).cast("date")
    return partition_date(F.col("timestamp"))


def with_window_start(tx: DataFrame, cfg: ScreeningConfig = DEFAULT_CONFIG) -> DataFrame:
    """Epoch-aligned tumbling window start; rows without event time are dropped."""
    return (tx.where(F.col(EVENT_TIME).isNotNull())
              .withColumn(WINDOW_START, F.window(F.col(EVENT_TIME), cfg.travel_window).start))


def tumbling_travel_keys(tx: DataFrame, cfg: ScreeningConfig = DEFAULT_CONFIG) -> DataFrame:
    """(user_id, window_start) groups with more than one non-NULL country.

    Pass 1 of the tumbling rule: ``min(country) <> max(country)`` is exactly
    "two or more distinct non-NULL countries". Each row carries only its key
    and country, the aggregation is partial on the map side (a hot user or
    window collapses before the shuffle) and needs one shuffle. NULL users
    form one group, as in the screened system.
    """
    keyed = with_window_start(tx, cfg).select("user_id", WINDOW_START, "country")
    return (keyed.groupBy("user_id", WINDOW_START)
                 .agg(F.min("country").alias("c_min"), F.max("country").alias("c_max"))
                 .where(F.col("c_min") != F.col("c_max"))
                 .select("user_id", WINDOW_START))


def _semi_on_group(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    cond = [rows["user_id"].eqNullSafe(keys["user_id"]), rows[WINDOW_START] == keys[WINDOW_START]]
    return rows.join(keys, on=cond, how=how)


def tumbling_travel_members(tx: DataFrame, cfg: ScreeningConfig = DEFAULT_CONFIG) -> DataFrame:
    """Transactions that belong to a flagged (user, window) group, with ``window_start``.

    The flagged keys are few; adaptive execution broadcasts them when their
    measured size is under the broadcast threshold and otherwise keeps a
    shuffled join, so nothing unbounded is broadcast.
    """
    return members_of(tx, tumbling_travel_keys(tx, cfg), cfg)


def impossible_travel_tumbling(tx: DataFrame, cfg: ScreeningConfig = DEFAULT_CONFIG) -> DataFrame:
    """Rule 2: one alert per (user, tumbling window) seen in more than one country.

    Alert row: member ids and countries joined with ", " (sorted, so output is
    deterministic), and the earliest member's timestamp/amount/currency/
    category. Pass 2 only touches members of flagged groups.
    """
    return travel_alerts_of(tumbling_travel_members(tx, cfg), cfg).drop(WINDOW_START)


def members_of(tx: DataFrame, keys: DataFrame, cfg: ScreeningConfig = DEFAULT_CONFIG) -> DataFrame:
    """Transactions of the (user_id, window_start) groups in ``keys``, with ``window_start``."""
    return _semi_on_group(with_window_start(tx, cfg), keys, "left_semi")


def travel_alerts_of(members: DataFrame, cfg: ScreeningConfig = DEFAULT_CONFIG) -> DataFrame:
    """One alert for each (user_id, window_start) group of flagged ``members``, with ``window_start``."""
    first = earliest_by_time(F.struct("timestamp", "amount", "currency", "merchant_category"))
    grouped = (members.groupBy("user_id", WINDOW_START)
               .agg(F.array_sort(F.collect_set("country")).alias("countries"),
                    F.array_sort(F.collect_set("transaction_id")).alias("ids"),
                    first.alias("first")))
    return grouped.select(
        F.concat_ws(", ", "ids").alias("transaction_id"),
        "user_id",
        F.col("first.timestamp").alias("timestamp"),
        F.col("first.amount").alias("amount"),
        F.col("first.currency").alias("currency"),
        F.col("first.merchant_category").alias("merchant_category"),
        F.concat_ws(", ", "countries").alias("country"),
        F.lit(FRAUD_TYPE_TRAVEL).alias("fraud_type"),
        travel_reason(F.col("countries"), cfg).alias("fraud_reason"),
        WINDOW_START,
    )


def all_alerts(tx: DataFrame, cfg: ScreeningConfig = DEFAULT_CONFIG) -> DataFrame:
    """Both rules, UNION ALL (a high-value travel member is alerted twice)."""
    return high_value_alerts(tx, cfg).unionByName(impossible_travel_tumbling(tx, cfg))


def fraud_lake_rows(alerts: DataFrame) -> DataFrame:
    return alerts.select(*ALERT_COLUMNS, partition_date(F.col("timestamp")).alias("date"))


def valid_excluding_travel(tx: DataFrame, cfg: ScreeningConfig = DEFAULT_CONFIG) -> DataFrame:
    """Valid rows that are not members of a tumbling travel alert (left anti join).

    Joins on the group key rather than exploding alert id lists: the flagged
    key set is small and the big side keeps its scan partitioning.
    """
    keyed = (tx.where(F.col("amount") <= _threshold(cfg))
               .withColumn(WINDOW_START, F.window(F.col(EVENT_TIME), cfg.travel_window).start))
    kept = _semi_on_group(keyed, tumbling_travel_keys(tx, cfg), "left_anti")
    return kept.select(*TRANSACTION_COLUMNS, lake_date(tx).alias("date"))


def drop_landed(batch: DataFrame, landed: DataFrame) -> DataFrame:
    """``batch`` without copies: of rows already in ``landed``, and of one another by ``transaction_id``.

    ``landed`` needs only that column. It is first cut down to the ids of the
    batch, by a semi join whose small side adaptive execution broadcasts, or
    Spark filters by a runtime Bloom filter, where it measures it small: the
    large side is scanned, never shuffled whole. Rows without an id are not
    copies of one another: all pass.
    """
    ids = batch.where(F.col("transaction_id").isNotNull()).select("transaction_id").distinct()
    seen = landed.select("transaction_id").join(ids, "transaction_id", "left_semi").distinct()
    named = batch.where(F.col("transaction_id").isNotNull()).dropDuplicates(["transaction_id"])
    return (named.join(seen, "transaction_id", "left_anti").select(*batch.columns)
            .unionByName(batch.where(F.col("transaction_id").isNull())))


def geo_flags(tx: DataFrame, cfg: ScreeningConfig = DEFAULT_CONFIG) -> DataFrame:
    """Per country: home / foreign / branch flags with transaction count and volume."""
    return (tx.groupBy("country")
              .agg(F.count(F.lit(1)).alias("transactions"), money_sum(F.col("amount")).alias("volume"))
              .select("country",
                      (F.col("country") == F.lit(cfg.home_country)).alias("is_home"),
                      is_foreign_country(F.col("country"), cfg).alias("is_foreign"),
                      is_branch_country(F.col("country"), cfg).alias("is_branch_country"),
                      "transactions", "volume"))
