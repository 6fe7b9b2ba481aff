"""Impossible travel, as documented: trailing window, consecutive hops, sessions.

The tumbling rule in ``rules.py`` reproduces the screened system; the operators
here implement the documented intent ("2+ countries within 10 minutes").

Time slicing (trailing window and hops)
---------------------------------------
A window partitioned by user alone would put a hot user's whole history into
one task. Instead rows are keyed by (user, slice) where a slice is ``W / k`` of
event time (``W`` the travel window, ``k = cfg.travel_slices``). Row-level
context for a slice is only the slice ``k`` positions earlier (shipped once,
shifted by ``W``); the ``k - 1`` slices in between are fully inside every
window that ends in the slice, so they enter as per-slice summaries, combined
with a window over the summary table (one row per user and non-empty slice,
bounded by the time span, not by row count). Every row with a country is
shipped twice, the second time narrow, and no task holds more than two slices
of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerguard.config import DEFAULT_CONFIG, FRAUD_TYPE_TRAVEL, ScreeningConfig
from ledgerguard.functions.expressions import epoch_micros, travel_reason, wall_clock_from_micros
from ledgerguard.schema import EVENT_TIME, TRANSACTION_COLUMNS

_T, _S, _KEY, _ROLE = "_t", "_slice", "_key", "_role"
PROBE, CONTEXT = 0, 1


def slicing(cfg: ScreeningConfig) -> tuple[int, int, int]:
    """(window micros, slices per window, slice micros)."""
    w = cfg.window_seconds * 1_000_000
    k = max(1, int(cfg.travel_slices))
    if w % k:
        raise ValueError(f"travel_slices={k} does not divide the window of {cfg.travel_window}")
    return w, k, w // k


def _sliced_base(tx: DataFrame, cfg: ScreeningConfig) -> DataFrame:
    """Rows with user and event time, plus epoch micros and slice number.

    NULL users are dropped here: they are not one person.
    """
    _, _, g = slicing(cfg)
    t = epoch_micros(tx, EVENT_TIME)
    base = tx.where(F.col("user_id").isNotNull() & F.col(EVENT_TIME).isNotNull()).withColumn(_T, t)
    return base.withColumn(_S, F.expr(f"({_T} - pmod({_T}, {g}L)) div {g}L"))


def _ne(a, b):
    return F.coalesce(a != b, F.lit(False))


def trailing_travel(tx: DataFrame, cfg: ScreeningConfig = DEFAULT_CONFIG,
                    carry: tuple[str, ...] = (), flag_col: str | None = None) -> DataFrame:
    """Transactions preceded (within the window, ties included) by a transaction of
    the same user in another country.

    A row at time ``t`` in country ``c`` is flagged iff some row of the same
    user has ``t - W <= t' <= t`` and a non-NULL country ``!= c``. Exact: the
    window's rows are split into (a) the row's own slice up to ``t``, (b) the
    slice ``k`` back from ``t - W`` on, (c) the whole slices in between.

    ``carry`` columns are passed through. With ``flag_col`` every row with a
    user and an event time is returned, flagged or not, in that boolean column.
    """
    w, k, _ = slicing(cfg)
    base = _sliced_base(tx, cfg)
    out_cols = list(TRANSACTION_COLUMNS) + list(carry)
    probes = base.select(*out_cols, _T, _S, F.col(_T).alias(_KEY),
                         F.lit(PROBE).alias(_ROLE), F.lit(None).cast("string").alias("_ctx_country"))
    context = (base.where(F.col("country").isNotNull())
                   .select(*[F.lit(None).cast(tx.schema[c].dataType).alias(c)
                             if c not in ("user_id",) else F.col(c) for c in out_cols],
                           F.lit(None).cast("long").alias(_T),
                           (F.col(_S) + F.lit(k)).alias(_S),
                           (F.col(_T) + F.lit(w)).alias(_KEY),
                           F.lit(CONTEXT).alias(_ROLE),
                           F.col("country").alias("_ctx_country")))
    rows = probes.unionByName(context)
    part = Window.partitionBy("user_id", _S).orderBy(_KEY)
    upto = part.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # "from here on" as a running frame of the descending order: a frame that
    # ends unbounded is computed anew for each row, quadratic in a slice.
    onward = (Window.partitionBy("user_id", _S).orderBy(F.desc(_KEY))
              .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    own = F.when(F.col(_ROLE) == PROBE, F.col("country"))
    scored = (rows
              .withColumn("_own_min", F.min(own).over(upto))
              .withColumn("_own_max", F.max(own).over(upto))
              .withColumn("_ctx_min", F.min("_ctx_country").over(onward))
              .withColumn("_ctx_max", F.max("_ctx_country").over(onward))
              .where(F.col(_ROLE) == PROBE))
    c = F.col("country")
    hit = (_ne(F.col("_own_min"), c) | _ne(F.col("_own_max"), c)
           | _ne(F.col("_ctx_min"), c) | _ne(F.col("_ctx_max"), c))
    if k > 1:
        # Per-slice country range. Catalyst prunes the windows above out of
        # this branch and aggregates straight from the scan, partially on the
        # map side, so only one row per (user, slice, task) is shuffled. It
        # is then combined over the k-1 slices before each slice with a window
        # over the summary table, and joined back on (user, slice): the
        # probe side is already partitioned that way.
        summary = (scored.groupBy("user_id", _S)
                         .agg(F.min("country").alias("_mn"), F.max("country").alias("_mx")))
        between = Window.partitionBy("user_id").orderBy(_S).rangeBetween(-(k - 1), -1)
        mid = summary.select("user_id", _S, F.min("_mn").over(between).alias("_mid_min"),
                             F.max("_mx").over(between).alias("_mid_max"))
        scored = scored.join(mid, ["user_id", _S], "left")
        hit = hit | _ne(F.col("_mid_min"), c) | _ne(F.col("_mid_max"), c)
    if flag_col:
        return scored.select(*out_cols, (c.isNotNull() & hit).alias(flag_col))
    return scored.where(c.isNotNull() & hit).select(*out_cols)


def travel_hops(tx: DataFrame, cfg: ScreeningConfig = DEFAULT_CONFIG) -> DataFrame:
    """Consecutive transactions of one user in different countries at most W apart.

    One output row per hop: the transaction and its immediate predecessor in
    (event time, transaction id) order. Bounded output (at most one row per
    input row), unlike an all-pairs interval self-join, which is quadratic in
    a busy user's activity.
    """
    w, k, _ = slicing(cfg)
    base = _sliced_base(tx, cfg)
    row = F.struct(F.col(_T).alias("t"), F.col("transaction_id").alias("id"),
                   F.col("country").alias("country"), F.col("timestamp").alias("timestamp"))
    order = Window.partitionBy("user_id", _S).orderBy(_T, "transaction_id")
    seq = base.select("transaction_id", "user_id", "timestamp", "country", _T, _S,
                      row.alias("_row"), F.lag(row).over(order).alias("_prev"))
    # Last row of each non-empty slice, then the nearest one among the k
    # slices before each slice (anything older is more than W back).
    last = seq.groupBy("user_id", _S).agg(F.max_by("_row", F.struct(_T, "transaction_id")).alias("_last"))
    before = Window.partitionBy("user_id").orderBy(_S).rangeBetween(-k, -1)
    carry = last.select("user_id", _S, F.last("_last", ignorenulls=True).over(before).alias("_carry"))
    joined = seq.join(carry, ["user_id", _S], "left")
    prev = F.coalesce(F.col("_prev"), F.col("_carry"))
    hops = joined.select("transaction_id", "user_id", "timestamp", "country", _T, prev.alias("p"))
    gap = F.col(_T) - F.col("p.t")
    return (hops.where(F.col("p").isNotNull() & (gap <= F.lit(w))
                       & F.col("country").isNotNull() & F.col("p.country").isNotNull()
                       & (F.col("country") != F.col("p.country")))
                .select("transaction_id", "user_id", "timestamp", "country",
                        F.col("p.id").alias("prev_transaction_id"),
                        F.col("p.timestamp").alias("prev_timestamp"),
                        F.col("p.country").alias("prev_country"),
                        (gap.cast("double") / 1e6).alias("gap_seconds")))


def impossible_travel_session(tx: DataFrame, cfg: ScreeningConfig = DEFAULT_CONFIG) -> DataFrame:
    """Sessions of activity spanning more than one country.

    A session chains a user's transactions while each follows the previous
    one by at most W (Spark's session-window rule: ``next <= last + W``).
    Rather than ``session_window`` (which ships all of a user's rows to one
    task before merging), rows are first aggregated per (user, W-wide time
    bucket): all rows of one bucket are within W of each other, so each bucket
    is part of a single session, and the aggregation is combined map-side.
    A window over the per-bucket summaries (bounded by the time span, not
    the row count) then chains buckets into sessions.
    """
    w = cfg.window_seconds * 1_000_000
    base = tx.where(F.col("user_id").isNotNull() & F.col(EVENT_TIME).isNotNull())
    t = epoch_micros(tx, EVENT_TIME)
    buckets = (base.withColumn(_T, t)
                   .withColumn("_b", F.expr(f"({_T} - pmod({_T}, {w}L)) div {w}L"))
                   .groupBy("user_id", "_b")
                   .agg(F.min(_T).alias("_first"), F.max(_T).alias("_last"),
                        F.count(F.lit(1)).alias("_n"), F.collect_set("country").alias("_c")))
    order = Window.partitionBy("user_id").orderBy("_b")
    starts = F.when(F.col("_first") > F.lag("_last").over(order) + F.lit(w), 1).otherwise(0)
    chained = buckets.withColumn("_new", starts).withColumn(
        "_sid", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    sess = (chained.groupBy("user_id", "_sid")
                   .agg(F.min("_first").alias("_start"), F.max("_last").alias("_end"),
                        F.sum("_n").alias("transactions"),
                        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_c")))).alias("countries")))
    # Back to the input's time type without going through the session zone.
    ntz = tx.schema[EVENT_TIME].dataType.typeName() == "timestamp_ntz"
    to_ts = wall_clock_from_micros if ntz else F.timestamp_micros
    return (sess.where(F.size("countries") > 1)
                .select("user_id",
                        to_ts(F.col("_start")).alias("session_start"),
                        to_ts(F.col("_end") + F.lit(w)).alias("session_end"),
                        F.col("transactions").cast("long").alias("transactions"),
                        F.concat_ws(", ", "countries").alias("country"),
                        F.lit(FRAUD_TYPE_TRAVEL).alias("fraud_type"),
                        travel_reason(F.col("countries"), cfg).alias("fraud_reason")))
