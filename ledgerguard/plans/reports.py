"""Reconciliation and fraud-analytics reports as DataFrames.

Every report is one lazy aggregation over partitioned Parquet (or over the
rule outputs directly). Nothing is collected to the driver; the results are
small by construction (one row, one row per category/type/day).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, LongType, StringType, StructField, StructType

from ledgerguard import config as C
from ledgerguard.config import (BALANCE_TOLERANCE, BAR_WIDTH, DEFAULT_CONFIG, STATUS_BALANCED,
                                STATUS_DISCREPANCY, STATUS_NO_DATA, ScreeningConfig)
from ledgerguard.functions.expressions import exact, money, no_money, pct_of, ratio, unsummed
from ledgerguard.functions.formatting import bar, fmt_count, fmt_money, fmt_pct, fmt_pct1
from ledgerguard.operators.rules import WINDOW_START
from ledgerguard.schema import EVENT_TIME

VALID, FRAUD = "V", "F"


#: What a lake row adds up to; a cube row holds the sums of many lake rows.
MEASURES = ("n_rows", "n_ids", "n_amounts", "n_unsummed", "volume")
CUBE_KEYS = ("kind", "date", "merchant_category", "fraud_type")


#: A stored cube, one file set for each date.
CUBE_SCHEMA = StructType([StructField("kind", StringType()), StructField("date", DateType()),
                          StructField("merchant_category", StringType()), StructField("fraud_type", StringType()),
                          *[StructField(m, LongType()) for m in MEASURES[:-1]], StructField("volume", DecimalType(38, 6))])


def _is(kind: str) -> Column:
    return F.col("kind") == F.lit(kind)


def _lake_rows(valid: DataFrame | None, fraud: DataFrame | None) -> DataFrame:
    """Lake rows as (``CUBE_KEYS``, ``transaction_id``, ``volume``); category and rule of fraud rows only."""
    def side(df: DataFrame, kind: str) -> DataFrame:
        def key(name: str, kept: bool) -> Column:
            return F.col(name) if kept and name in df.columns else F.lit(None).cast("string").alias(name)
        date = F.col("date") if "date" in df.columns else F.lit(None).cast("date").alias("date")
        return df.select(F.lit(kind).alias("kind"), date, key("merchant_category", kind == FRAUD),
                         key("fraud_type", kind == FRAUD), "transaction_id", exact(F.col("amount")).alias("volume"), unsummed(F.col("amount")).alias("unsummed"))
    sides = [side(df, kind) for df, kind in ((valid, VALID), (fraud, FRAUD)) if df is not None]
    return sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])


def lake_measures(valid: DataFrame | None = None, fraud: DataFrame | None = None) -> DataFrame:
    """Lake rows as (``CUBE_KEYS``, ``MEASURES``).

    Every report sums the measures, so it takes these rows or a ``report_cube``
    of them alike. Unused columns are pruned from the scan.
    """
    return _lake_rows(valid, fraud).select(
        *CUBE_KEYS, F.lit(1).cast("long").alias("n_rows"),
        F.col("transaction_id").isNotNull().cast("long").alias("n_ids"),
        F.col("volume").isNotNull().cast("long").alias("n_amounts"),
        F.col("unsummed").cast("long").alias("n_unsummed"), "volume")


def report_cube(valid: DataFrame | None = None, fraud: DataFrame | None = None,
                keys: tuple[str, ...] = CUBE_KEYS) -> DataFrame:
    """Lakes, read once, summed by ``keys``: kind, date, category and rule, or fewer.

    Every report on these keys follows from the few rows by the same code as
    from the lakes.
    """
    return _lake_rows(valid, fraud).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("transaction_id").alias("n_ids"),
        F.count("volume").alias("n_amounts"), F.count_if("unsummed").alias("n_unsummed"),
        F.sum("volume").alias("volume"))


def _total(kind: str, measure: str) -> Column:
    none = no_money() if measure == "volume" else F.lit(0).cast("long")
    return F.coalesce(F.sum(F.when(_is(kind), F.col(measure))), none)


def _zero_safe(c: Column) -> Column:
    # Rounded values can come out as -0.0; adding 0.0 normalises the sign.
    return c + F.lit(0.0)


def reconciliation_reference(valid: DataFrame, fraud: DataFrame) -> DataFrame:
    """The screened system's reconciliation of two lakes (see ``reconciliation_of``)."""
    return reconciliation_of(lake_measures(valid, fraud))


def reconciliation_of(measures: DataFrame) -> DataFrame:
    """The screened system's reconciliation: ingress := validated + fraud rows.

    One row: counts, volumes (NaN skipped, 0 on no rows), the difference
    ``ingress - validated - fraud``, balance status and rates (fraud rate 0
    and validation rate 100 on no rows). Because ingress is derived from the
    two outputs, the check can only fail through rounding or NaN. Lakes that
    hold no rows give ``NO_DATA``, whether they are absent or empty.
    """
    agg = measures.agg(_total(VALID, "n_rows").alias("validated_count"), _total(VALID, "volume").alias("_vv"),
                       _total(FRAUD, "n_rows").alias("fraud_count"), _total(FRAUD, "volume").alias("_fv"))
    ingress_n = F.col("validated_count") + F.col("fraud_count")
    ingress_v = F.col("_vv") + F.col("_fv")
    diff = ingress_v - F.col("_vv") - F.col("_fv")
    rate = pct_of(F.col("fraud_count"), ingress_n)
    return agg.select(
        ingress_n.alias("ingress_count"),
        money(ingress_v).alias("ingress_volume"),
        "validated_count",
        money(F.col("_vv")).alias("validated_volume"),
        "fraud_count",
        money(F.col("_fv")).alias("fraud_volume"),
        _zero_safe(money(diff)).alias("diff"),
        F.when(ingress_n == 0, F.lit(STATUS_NO_DATA))
         .when(F.abs(diff) < F.lit(BALANCE_TOLERANCE), F.lit(STATUS_BALANCED))
         .otherwise(F.lit(STATUS_DISCREPANCY)).alias("status"),
        rate.alias("fraud_rate"),
        ratio(F.lit(100.0) - rate).alias("validation_rate"),
    )


def breakdown_of(measures: DataFrame, key: str, with_avg: bool) -> DataFrame:
    """Fraud rows per ``key``: count of ids, share, total and, on request, mean amount."""
    aggs = [F.sum("n_ids").alias("count"), F.sum("n_rows").alias("_rows"), F.sum("volume").alias("_v"),
            F.sum("n_amounts").alias("_n")]
    g = measures.where(_is(FRAUD)).groupBy(key).agg(*aggs)
    # Share of *all* fraud rows, NULL keys included, as the screened report
    # computes it. The window runs over the aggregated rows (one per key).
    total = F.sum("_rows").over(Window.partitionBy())
    out = g.withColumn("pct", pct_of(F.col("count"), total)).where(F.col(key).isNotNull())
    cols = [key, "count", "pct", money(F.coalesce("_v", no_money())).alias("total_amount")]
    if with_avg:
        cols.append(ratio(F.when(F.col("_n") > 0, F.col("_v").cast("double") / F.col("_n"))).alias("avg_amount"))
    return out.select(*cols).orderBy(F.desc("count"), F.asc(key))


def _fraud_by(fraud: DataFrame, key: str) -> DataFrame:
    return report_cube(fraud=fraud, keys=(key,)).withColumn("kind", F.lit(FRAUD))


def fraud_by_category(fraud: DataFrame) -> DataFrame:
    """Fraud rows per merchant category: count of ids, share, total and mean amount."""
    return breakdown_of(_fraud_by(fraud, "merchant_category"), "merchant_category", with_avg=True)


def fraud_by_type(fraud: DataFrame) -> DataFrame:
    """Fraud rows per detection rule: count of ids, share and total amount."""
    return breakdown_of(_fraud_by(fraud, "fraud_type"), "fraud_type", with_avg=False)


def unsummed_of(measures: DataFrame) -> DataFrame:
    """(validated_unsummed, fraud_unsummed): rows whose amount no volume holds (infinite, or 1e24 and more)."""
    return measures.agg(_total(VALID, "n_unsummed").alias("validated_unsummed"),
                        _total(FRAUD, "n_unsummed").alias("fraud_unsummed"))


def fraud_summary(fraud: DataFrame) -> DataFrame:
    """One row: fraud row count, volume and average (0 when there are none)."""
    return summary_of(lake_measures(fraud=fraud))


def summary_of(measures: DataFrame) -> DataFrame:
    """``fraud_summary`` of measures."""
    agg = measures.agg(_total(FRAUD, "n_rows").alias("fraud_count"), _total(FRAUD, "volume").alias("_v"))
    return agg.select("fraud_count", money(F.col("_v")).alias("fraud_volume"),
                      ratio(F.when(F.col("fraud_count") > 0, F.col("_v").cast("double") / F.col("fraud_count"))
                            .otherwise(F.lit(0.0))).alias("avg_amount"))


def daily_lake_counts(valid: DataFrame, fraud: DataFrame) -> DataFrame:
    """Per-date counts and volumes of both lakes plus an all-time row (``is_total``).

    A filter on ``date`` before this prunes lake partitions, which makes the
    incremental (daily) report read one day instead of all history.
    """
    return daily_of(lake_measures(valid, fraud))


def daily_of(measures: DataFrame) -> DataFrame:
    """``daily_lake_counts`` of measures."""
    return (measures.rollup("date")
            .agg(F.grouping("date").cast("boolean").alias("is_total"),
                 _total(VALID, "n_rows").alias("validated_count"),
                 money(_total(VALID, "volume")).alias("validated_volume"),
                 _total(FRAUD, "n_rows").alias("fraud_count"),
                 money(_total(FRAUD, "volume")).alias("fraud_volume"))
            .orderBy("is_total", "date"))


def reconciliation_true(parsed: DataFrame, cfg: ScreeningConfig = DEFAULT_CONFIG,
                        malformed: Column | None = None) -> DataFrame:
    """Ingress counted from the parsed input, not from the outputs.

    ``raw = valid + high_value + unrouted`` must hold (unrouted: NULL amount,
    which includes malformed rows). ``reference_ingress - raw`` equals
    ``travel_alerts - unrouted`` and shows the double count of the reference
    reconciliation.

    One pass without a join: counts and sums by route are taken per (user,
    window), with the least and greatest country that tell a flagged group, and
    then over the groups. Rows without time form groups that are never flagged.
    """
    a, t = F.col("amount"), F.lit(float(cfg.high_value_threshold))
    routes = {"valid": a <= t, "high_value": a > t, "unrouted": a.isNull(),
              "malformed": malformed if malformed is not None else F.lit(False)}
    sums = {"raw": F.lit(True), "valid": a <= t, "high_value": a > t}
    # F.window drops rows without time, so only the others go through it
    some_time = F.lit("1970-01-01 00:00:00").cast(parsed.schema[EVENT_TIME].dataType)
    start = F.window(F.coalesce(EVENT_TIME, some_time), cfg.travel_window).start
    groups = (parsed.withColumn(WINDOW_START, start)
              .withColumn(WINDOW_START, F.when(F.col(EVENT_TIME).isNotNull(), F.col(WINDOW_START)))
              .groupBy("user_id", WINDOW_START)).agg(
        F.count(F.lit(1)).alias("raw"), *[F.count_if(c).alias(r) for r, c in routes.items()],
        *[F.sum(F.when(c, exact(a))).alias(f"{r}_sum") for r, c in sums.items()],
        F.min("country").alias("c_min"), F.max("country").alias("c_max"))
    flagged = F.col(WINDOW_START).isNotNull() & (F.col("c_min") != F.col("c_max"))
    n = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("long"))
    agg = groups.withColumn("m", F.coalesce(flagged, F.lit(False))).agg(
        *[n(F.col(r)).alias(f"{r}_count") for r in ("raw", *routes)],
        F.count_if("m").alias("travel_alerts"),
        n(F.when(F.col("m"), F.col("raw"))).alias("travel_members"),
        n(F.when(F.col("m"), F.col("valid"))).alias("travel_members_valid"),
        n(F.when(F.col("m"), F.col("high_value"))).alias("travel_members_high_value"),
        *[money(F.coalesce(F.sum(f"{r}_sum"), no_money())).alias(f"{r}_volume") for r in sums],
    )
    ref_ingress = F.col("valid_count") + F.col("high_value_count") + F.col("travel_alerts")
    routed = F.col("valid_count") + F.col("high_value_count") + F.col("unrouted_count")
    return agg.select(
        "*",
        ref_ingress.alias("reference_ingress_count"),
        (ref_ingress - F.col("raw_count")).alias("ingress_gap"),
        F.when(F.col("raw_count") == 0, F.lit(STATUS_NO_DATA))
         .when(routed == F.col("raw_count"), F.lit(STATUS_BALANCED))
         .otherwise(F.lit(STATUS_DISCREPANCY)).alias("status"),
    )


# ---- report text lines ------------------------------------------------------

def _pad_right(s: Column, w: int) -> Column:
    return F.when(F.length(s) >= w, s).otherwise(F.rpad(s, w, " "))


def _pad_left(s: Column, w: int) -> Column:
    return F.when(F.length(s) >= w, s).otherwise(F.lpad(s, w, " "))


def report_lines(valid: DataFrame, fraud: DataFrame) -> DataFrame:
    """Data lines of both text reports as an ordered (``section``, ``ord``, ``line``) frame."""
    return lines_of(lake_measures(valid, fraud))


def lines_of(measures: DataFrame) -> DataFrame:
    """``report_lines`` of measures.

    One pass: every row is aggregated once per report level (lake total, and
    for fraud rows also category and rule) with map-side partial aggregation. A
    global aggregation then gathers those few rows into a single row, from which
    all lines are rendered with JVM string and array functions. The values equal
    those of the report tables above.
    """
    level = lambda name, key: F.struct(F.lit(name).alias("level"), key.cast("string").alias("key"))
    total = level("total", F.lit(None))
    levels = F.when(_is(FRAUD), F.array(total, level("category", F.col("merchant_category")),
                                        level("type", F.col("fraud_type")))).otherwise(F.array(total))
    per_level = (measures.select("kind", *MEASURES, F.explode(levels).alias("lv"))
                 .groupBy("kind", F.col("lv.level").alias("level"), F.col("lv.key").alias("key"))
                 .agg(F.sum("n_rows").alias("n_rows"), F.sum("n_ids").alias("n_ids"),
                      F.sum("volume").alias("s"), F.sum("n_amounts").alias("n_amt")))
    tot = lambda kind, c: F.coalesce(F.sum(F.when(_is(kind) & (F.col("level") == "total"), F.col(c))),
                                     F.lit(0))
    item = F.struct((-F.col("n_ids")).alias("neg"), F.col("key").alias("key"), F.col("n_ids").alias("n"),
                    F.col("s").alias("s"), F.col("n_amt").alias("n_amt"))
    pick = lambda level: F.collect_list(F.when((F.col("level") == level) & F.col("key").isNotNull(), item))
    g = per_level.agg(tot(VALID, "n_rows").alias("vn"), tot(VALID, "s").cast("double").alias("vs"),
                      tot(FRAUD, "n_rows").alias("fn"), tot(FRAUD, "s").cast("double").alias("fs"),
                      F.sort_array(pick("category")).alias("cats"), F.sort_array(pick("type")).alias("types"))

    vn, vs, fn, fs = F.col("vn"), F.col("vs"), F.col("fn"), F.col("fs")
    ingress_n, ingress_v = vn + fn, vs + fs
    diff = ingress_v - vs - fs
    rate = pct_of(fn, ingress_n)
    status = (F.when(ingress_n == 0, F.lit(STATUS_NO_DATA))
               .when(F.abs(diff) < F.lit(BALANCE_TOLERANCE), F.lit(STATUS_BALANCED))
               .otherwise(F.lit(STATUS_DISCREPANCY)))
    cnt = lambda c, w: _pad_left(fmt_count(c), w)
    mon = lambda c, w: _pad_left(fmt_money(c), w)
    line = lambda section, i, text: F.struct(F.lit(section).alias("section"),
                                             F.lit(i).cast("long").alias("ord"), text.alias("line"))
    rec = [
        F.concat(F.lit("Ingress Count    : "), cnt(ingress_n, C.COUNT_WIDTH)),
        F.concat(F.lit("Ingress Volume   : $"), mon(money(ingress_v), C.VOLUME_WIDTH)),
        F.concat(F.lit("Validated Count  : "), cnt(vn, C.COUNT_WIDTH)),
        F.concat(F.lit("Validated Volume : $"), mon(money(vs), C.VOLUME_WIDTH)),
        F.concat(F.lit("Fraud Count      : "), cnt(fn, C.COUNT_WIDTH)),
        F.concat(F.lit("Fraud Volume     : $"), mon(money(fs), C.VOLUME_WIDTH)),
        F.concat(F.lit(C.LABEL_CHECK), fmt_money(_zero_safe(money(diff)))),
        F.concat(F.lit(C.LABEL_STATUS), F.when(status == STATUS_BALANCED, F.lit(C.MARK_BALANCED))
                 .otherwise(F.lit(C.MARK_DISCREPANCY)), status),
        F.concat(F.lit(C.LABEL_FRAUD_RATE), fmt_pct(rate), F.lit("%")),
        F.concat(F.lit(C.LABEL_VALIDATION_RATE), fmt_pct(ratio(F.lit(100.0) - rate)), F.lit("%")),
    ]
    avg_all = ratio(F.when(fn > 0, fs / fn).otherwise(F.lit(0.0)))
    summ = [
        F.concat(F.lit(C.LABEL_FRAUD_TRANSACTIONS), fmt_count(fn)),
        F.concat(F.lit(C.LABEL_FRAUD_VOLUME), fmt_money(money(fs))),
        F.concat(F.lit(C.LABEL_FRAUD_AVERAGE), fmt_money(avg_all)),
    ]

    def share(x):
        return pct_of(x["n"], fn)

    def cat_line(x, i):
        avg = F.coalesce(ratio(F.when(x["n_amt"] > 0, x["s"] / x["n_amt"])), F.lit(0.0))
        w = C.CATEGORY_WIDTHS
        text = F.concat(F.lit("│ "), _pad_right(x["key"], w[0]), F.lit(" │ "), cnt(x["n"], w[1]), F.lit(" │ "),
                        fmt_pct1(share(x), w[2]), F.lit("%  │ $"),
                        mon(money(F.coalesce(x["s"], F.lit(0.0))), w[3]), F.lit("  │ $"), mon(avg, w[4]),
                        F.lit("  │"))
        return F.struct(F.lit("by_category").alias("section"), (i + 1).cast("long").alias("ord"),
                        text.alias("line"))

    def type_lines(x, i):
        w = C.TYPE_WIDTHS
        l1 = F.concat(_pad_right(x["key"], w[0]), F.lit(" : "), cnt(x["n"], w[1]), F.lit(" ("),
                      fmt_pct1(share(x), w[2]), F.lit("%) │ $"),
                      mon(money(F.coalesce(x["s"], F.lit(0.0))), w[3]))
        l2 = F.concat(F.lit(" " * C.BAR_INDENT), bar(share(x), BAR_WIDTH))
        r = (i + 1).cast("long")
        return F.array(F.struct(F.lit("by_type").alias("section"), (r * 2).alias("ord"), l1.alias("line")),
                       F.struct(F.lit("by_type").alias("section"), (r * 2 + 1).alias("ord"),
                                l2.alias("line")))

    lines = F.concat(
        F.array(*[line("reconciliation", i, t) for i, t in enumerate(rec)]),
        F.array(*[line("summary", i, t) for i, t in enumerate(summ)]),
        F.transform("cats", cat_line),
        F.flatten(F.transform("types", type_lines)),
    )
    order = F.create_map(*[x for i, sec in enumerate(["reconciliation", "summary", "by_category", "by_type"])
                           for x in (F.lit(sec), F.lit(i))])
    out = g.select(F.inline(lines))
    return out.withColumn("_s", order[F.col("section")]).orderBy("_s", "ord").drop("_s")
