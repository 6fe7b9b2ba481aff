"""One user holding a third of all rows: work is pre-aggregated or split, results stay whole."""

import pytest
from pyspark.sql import functions as F

from ledgerguard.config import FIXTURE_CONFIG as CFG
from ledgerguard.operators import rules, travel
from ledgerguard.plans import reports
from ledgerguard.sources.fixtures import fixture_transactions
from tests.conftest import SF_MID


@pytest.fixture(scope="module")
def skewed(spark):
    tx = fixture_transactions(spark, SF_MID, CFG)
    hot = F.when(F.pmod(F.col("transaction_id").cast("long"), F.lit(3)) == 0, F.lit("hot"))
    return tx.withColumn("user_id", F.coalesce(hot, F.col("user_id")))


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_tumbling_pass1_aggregates_before_shuffle(spark, skewed):
    plan = _plan(rules.tumbling_travel_keys(skewed, CFG))
    # map-side partial aggregate below the single shuffle
    assert "partial_min" in plan and plan.count("Exchange hashpartitioning") == 1
    # Whole results: every flagged group of the hot user is reported.
    hot = rules.impossible_travel_tumbling(skewed, CFG).where("user_id = 'hot'")
    keys = rules.tumbling_travel_keys(skewed, CFG).where("user_id = 'hot'")
    assert hot.count() == keys.count() > 0


def test_session_buckets_pre_aggregate(spark, skewed):
    df = travel.impossible_travel_session(skewed, CFG)
    plan = _plan(df)
    assert "MergingSessions" not in plan and "partial_" in plan
    total = df.agg(F.sum("transactions")).first()[0]
    assert total <= skewed.count()


def test_reports_partial_aggregate(spark, skewed):
    fraud = rules.fraud_lake_rows(rules.all_alerts(skewed, CFG))
    plan = _plan(reports.fraud_by_category(fraud))
    assert "partial_count" in plan
