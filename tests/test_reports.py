"""Report tables: empty and absent lakes, NaN handling, shares, text lines."""

import math

from pyspark.sql import functions as F

from ledgerguard.config import DEFAULT_CONFIG as CFG
from ledgerguard.operators import rules
from ledgerguard.plans import reports
from ledgerguard.sinks.lakes import write_report, write_report_text
from ledgerguard.sources.lakes import read_fraud_lake, read_valid_lake
from tests.helpers import tx_rows


def test_absent_lakes_read_empty_and_report_no_data(spark, workdir):
    valid = read_valid_lake(spark, f"{workdir}/nope-valid")
    fraud = read_fraud_lake(spark, f"{workdir}/nope-fraud")
    r = reports.reconciliation_reference(valid, fraud).first()
    assert (r.ingress_count, r.ingress_volume, r.fraud_rate, r.validation_rate, r.status) == \
        (0, 0.0, 0.0, 100.0, "NO_DATA")
    s = reports.fraud_summary(fraud).first()
    assert (s.fraud_count, s.fraud_volume, s.avg_amount) == (0, 0.0, 0.0)
    assert reports.fraud_by_category(fraud).count() == 0
    lines = reports.report_lines(valid, fraud)
    write_report_text(lines, f"{workdir}/report_txt")
    assert spark.read.text(f"{workdir}/report_txt").count() == lines.count()


def test_lake_folder_without_data_files_reads_empty(spark, workdir):
    import os
    hollow = f"{workdir}/hollow".replace("file:", "")
    os.makedirs(hollow)
    open(os.path.join(hollow, "_SUCCESS"), "w").close()
    assert read_valid_lake(spark, hollow).count() == 0


def test_nan_skipped_and_shares_use_all_rows(spark, workdir):
    tx = tx_rows(spark, [
        ("a", "u1", "2024-01-01 00:00:00", 9000.0, "Food", "USA"),
        ("b", "u2", "2024-01-01 00:00:00", float("nan"), "Food", "USA"),
        ("c", "u3", "2024-01-01 00:00:00", 6000.0, None, "USA"),
        ("d", "u4", "2024-01-01 00:00:00", 10.0, "Food", "USA"),
    ])
    valid = rules.valid_transactions(tx, CFG)
    fraud = rules.fraud_lake_rows(rules.all_alerts(tx, CFG))
    rec = reports.reconciliation_reference(valid, fraud).first()
    assert (rec.validated_count, rec.fraud_count, rec.fraud_volume) == (1, 3, 15000.0)
    assert rec.status == "BALANCED" and rec.diff == 0.0
    assert math.isclose(rec.fraud_rate, 75.0)
    cat = {r.merchant_category: r for r in reports.fraud_by_category(fraud).collect()}
    assert set(cat) == {"Food"}  # NULL category dropped ...
    assert math.isclose(cat["Food"].pct, 2 / 3 * 100, rel_tol=1e-6)  # ... but still in the share
    assert cat["Food"].total_amount == 9000.0 and cat["Food"].avg_amount == 9000.0
    write_report(reports.fraud_by_category(fraud), f"{workdir}/by_cat")
    assert spark.read.parquet(f"{workdir}/by_cat").count() == 1


def test_daily_rollup_and_partition_pruning(spark, workdir):
    from ledgerguard.sinks.lakes import write_lake
    tx = tx_rows(spark, [
        ("a", "u1", "2024-01-01 00:00:00", 10.0, "Food", "USA"),
        ("b", "u1", "2024-01-02 00:00:00", 20.0, "Food", "USA"),
        ("c", "u2", "2024-01-02 00:00:00", 9000.0, "Food", "USA"),
    ])
    write_lake(rules.valid_transactions(tx, CFG), f"{workdir}/valid")
    write_lake(rules.fraud_lake_rows(rules.all_alerts(tx, CFG)), f"{workdir}/fraud")
    valid = read_valid_lake(spark, f"{workdir}/valid")
    fraud = read_fraud_lake(spark, f"{workdir}/fraud")
    rows = {(r.date.isoformat() if r.date else None, r.is_total): r
            for r in reports.daily_lake_counts(valid, fraud).collect()}
    assert rows[("2024-01-02", False)].validated_count == 1
    assert rows[("2024-01-02", False)].fraud_count == 1
    assert rows[(None, True)].validated_volume == 30.0
    day = valid.where(F.col("date") == F.lit("2024-01-02").cast("date"))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "isnotnull(date" in plan


def test_true_reconciliation_identity(spark):
    tx = tx_rows(spark, [
        ("a", "u1", "2024-01-01 00:01:00", None, "Food", "USA"),
        ("b", "u1", "2024-01-01 00:02:00", 1.0, "Food", "Japan"),
        ("c", "u2", "2024-01-01 00:02:00", 9000.0, "Food", "Japan"),
    ])
    r = reports.reconciliation_true(tx, CFG).first()
    assert (r.raw_count, r.valid_count, r.high_value_count, r.unrouted_count) == (3, 1, 1, 1)
    assert (r.travel_alerts, r.travel_members, r.travel_members_valid) == (1, 2, 1)
    assert r.reference_ingress_count - r.raw_count == r.travel_alerts - r.unrouted_count
    assert r.status == "BALANCED"


def test_true_reconciliation_without_rows_or_times(spark):
    tx = tx_rows(spark, [("a", "u1", "bad", 1.0, "Food", "USA"), ("b", "u1", "worse", 9000.0, "Food", "Japan"),
                         ("c", "u1", "1970-01-01 00:00:00", 1.0, "Food", "UAE")])
    r = reports.reconciliation_true(tx, CFG).first()
    assert (r.raw_count, r.valid_count, r.travel_alerts, r.travel_members) == (3, 2, 0, 0)
    r = reports.reconciliation_true(tx.limit(0), CFG).first()
    assert (r.raw_count, r.travel_members, r.raw_volume, r.status) == (0, 0, 0.0, "NO_DATA")


def test_breakdowns_are_sorted_and_a_cube_gives_the_same_reports(spark):
    rows = [(str(i), f"u{i}", f"2024-01-0{1 + i % 3} 00:00:00", 6000.0 + i, cat, "USA")
            for i, cat in enumerate(["Food", "Travel", "Travel", "Books", None, "Travel", "Art", "Food"])]
    rows.append(("n", "v", "2024-01-01 00:00:00", float("nan"), "Food", "USA"))
    rows.append(("p", "u0", "2024-01-01 00:01:00", 1.0, "Food", "Japan"))
    tx = tx_rows(spark, rows)
    valid, fraud = rules.valid_transactions(tx, CFG), rules.fraud_lake_rows(rules.all_alerts(tx, CFG))
    names = [(r["count"], r.merchant_category) for r in reports.fraud_by_category(fraud).collect()]
    assert names == sorted(names, key=lambda x: (-x[0], x[1])) and len(names) == 4
    assert [r.fraud_type for r in reports.fraud_by_type(fraud).collect()] == ["HIGH_VALUE", "IMPOSSIBLE_TRAVEL"]
    cube = reports.report_cube(valid, fraud)
    raw = reports.lake_measures(valid, fraud)
    for table in (reports.reconciliation_of, reports.summary_of, reports.daily_of, reports.lines_of,
                  lambda m: reports.breakdown_of(m, "merchant_category", True)):
        assert table(cube).collect() == table(raw).collect()
