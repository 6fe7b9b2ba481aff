"""Physical-plan properties the operators are designed for (regression guards)."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerguard.config import FIXTURE_CONFIG as CFG
from ledgerguard.operators import rules, travel
from ledgerguard.sources.fixtures import fixture_transactions
from ledgerguard.sources.json_ingest import parse_transactions
from tests.conftest import SF_SMALL


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def test_json_is_decoded_once_per_message(spark):
    msgs = spark.createDataFrame([('{"transaction_id":"a","amount":1.0,"timestamp":"2024-01-01 00:00:00"}',)],
                                 "value string")
    df = parse_transactions(msgs).where(F.col("event_time").isNotNull() & (F.col("amount") > 0))
    plan = _plan(df)
    assert plan.count("from_json(") == 1


def test_amount_filter_reaches_the_scan(spark):
    plan = _plan(E.queries()["high_value_alerts"](spark, SF_SMALL))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(value,150\.0\)", plan)


def test_tumbling_pass1_single_shuffle_and_narrow_read(spark):
    tx = fixture_transactions(spark, SF_SMALL, CFG)
    plan = _plan(rules.tumbling_travel_keys(tx, CFG))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_min" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,props:string>" in plan


def test_report_lines_single_pass(spark):
    plan = _plan(E.queries()["report_lines"](spark, SF_SMALL))
    # one scan for the valid lake + three for the alert plan (high value, pass 1, pass 2)
    assert plan.count("FileScan") <= 4


def test_trailing_shuffles_rows_once_on_user_and_slice(spark):
    tx = fixture_transactions(spark, SF_SMALL, CFG)
    plan = _plan(travel.trailing_travel(tx, CFG))
    # rows (probes + shifted context) and the per-slice partial summary: keyed by (user, slice)
    assert 1 <= plan.count("Exchange hashpartitioning(user_id, _slice") <= 2
    # the windows run per (user, slice), never per user over raw rows
    assert "windowspecdefinition(user_id, _slice, _key" in plan


def test_true_reconciliation_takes_one_pass(spark):
    plan = _plan(E.queries()["reconciliation_true"](spark, SF_SMALL))
    assert plan.count("from_json(") == 1 and plan.count("FileScan") == 1 and "Join" not in plan
