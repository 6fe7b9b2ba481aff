"""Metamorphic properties: order/partitioning invariance, identities, containment."""

from pyspark.sql import functions as F

from ledgerguard.config import FIXTURE_CONFIG as CFG
from ledgerguard.operators import rules, travel
from ledgerguard.plans import reports
from ledgerguard.sources.fixtures import fixture_transactions
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_results_do_not_depend_on_partitioning(spark):
    tx = fixture_transactions(spark, SF_SMALL, CFG)
    shuffled = tx.repartition(13, F.rand(seed=5)).sortWithinPartitions(F.rand(seed=9))
    for op in (rules.impossible_travel_tumbling, travel.trailing_travel, travel.travel_hops,
               travel.impossible_travel_session):
        assert _rows(op(tx, CFG)) == _rows(op(shuffled, CFG)), op.__name__


def test_raw_equals_routed_plus_unrouted(spark):
    tx = fixture_transactions(spark, SF_SMALL, CFG)
    r = reports.reconciliation_true(tx, CFG).first()
    assert r.valid_count + r.high_value_count + r.unrouted_count == r.raw_count == tx.count()
    assert r.reference_ingress_count - r.raw_count == r.travel_alerts - r.unrouted_count
    rec = reports.reconciliation_reference(rules.valid_transactions(tx, CFG),
                                           rules.fraud_lake_rows(rules.all_alerts(tx, CFG))).first()
    assert rec.ingress_count == r.reference_ingress_count


def test_trailing_contains_tumbling_members_after_other_country(spark):
    """A tumbling member preceded, in its own group, by another country's member
    is within 10 minutes of it, so the trailing rule must flag it."""
    tx = fixture_transactions(spark, SF_SMALL, CFG)
    members = rules.tumbling_travel_members(tx, CFG)
    m = members.alias("a").join(
        members.alias("b"),
        (F.col("a.user_id") == F.col("b.user_id")) & (F.col("a.window_start") == F.col("b.window_start"))
        & (F.col("b.event_time") <= F.col("a.event_time")) & (F.col("b.country") != F.col("a.country")),
        "left_semi").select("transaction_id")
    trailing = travel.trailing_travel(tx, CFG).select("transaction_id")
    assert m.subtract(trailing).count() == 0
    assert m.count() > 0


def test_results_do_not_depend_on_session_time_zone(spark):
    """Wall-clock (TIMESTAMP_NTZ) handling never goes through the session zone."""
    from ledgerguard.sources.fixtures import timestamp_text
    tx = fixture_transactions(spark, SF_SMALL, CFG)
    ops = (rules.impossible_travel_tumbling, travel.impossible_travel_session, rules.valid_transactions)
    before = [_rows(op(tx, CFG)) for op in ops]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert [_rows(op(tx, CFG)) for op in ops] == before
        gap = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00.000100' AS ts")  # DST gap there
        assert gap.select(timestamp_text(gap, "ts").alias("t")).first().t == "2024-03-10 02:30:00.000100"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
