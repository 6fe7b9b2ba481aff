"""Hand-written edge rows: parse, route and reason semantics."""

import json
import math

from pyspark.sql import functions as F

from ledgerguard.config import DEFAULT_CONFIG as CFG
from ledgerguard.operators import rules
from ledgerguard.sources.json_ingest import parse_transactions, split_malformed
from tests.helpers import messages, tx_rows


def msg(**kw):
    base = {"transaction_id": "t", "user_id": "u1", "timestamp": "2024-01-01 00:00:00",
            "amount": 10.0, "currency": "USD", "merchant_category": "Food", "country": "USA"}
    base.update(kw)
    return json.dumps(base)


def test_high_value_reason_and_strictness(spark):
    tx = tx_rows(spark, [
        ("a", "u1", "2024-01-01 00:09:00", 7500.5, "Food", "USA"),
        ("b", "u1", "2024-01-01 00:11:00", 10.0, "Food", "Japan"),
        ("c", "u1", "2024-01-01 00:12:00", 5000.0, "Food", "UAE"),
        ("d", "u2", "2024-01-01 00:00:00", 12345678.9, "Food", "USA"),
    ])
    hv = {r.transaction_id: r.fraud_reason for r in rules.high_value_alerts(tx, CFG).collect()}
    assert hv == {"a": "Amount $7500.5 exceeds $5000 threshold in USA",
                  "d": "Amount $1.23456789E7 exceeds $5000 threshold in USA"}
    valid = {r.transaction_id for r in rules.valid_transactions(tx, CFG).collect()}
    assert valid == {"b", "c"}  # 5000 is not > 5000


def test_tumbling_window_edge(spark):
    tx = tx_rows(spark, [
        ("a", "u1", "2024-01-01 00:09:00", 7500.5, "Food", "USA"),
        ("b", "u1", "2024-01-01 00:11:00", 10.0, "Travel", "Japan"),
        ("c", "u1", "2024-01-01 00:12:00", 5000.0, "Food", "UAE"),
    ])
    out = rules.impossible_travel_tumbling(tx, CFG).collect()
    assert len(out) == 1  # 00:09 and 00:11 fall in different windows
    r = out[0]
    assert r.transaction_id == "b, c" and r.country == "Japan, UAE"
    assert r.amount == 10.0 and r.merchant_category == "Travel"  # earliest member
    assert r.fraud_reason == "User transacted from 2 countries: Japan, UAE within 10 minutes"


def test_null_user_and_null_country(spark):
    tx = tx_rows(spark, [
        ("a", None, "2024-01-01 00:01:00", 1.0, "Food", "USA"),
        ("b", None, "2024-01-01 00:02:00", 1.0, "Food", "Japan"),
        ("c", "u2", "2024-01-01 00:01:00", 1.0, "Food", "USA"),
        ("d", "u2", "2024-01-01 00:02:00", 1.0, "Food", None),
    ])
    out = rules.impossible_travel_tumbling(tx, CFG).collect()
    assert [(r.user_id, r.country) for r in out] == [(None, "Japan, USA")]


def test_parse_edges(spark):
    vals = [
        "not json", "[1,2]", msg()[:-5], "", None, "{}",
        msg(transaction_id="abc", amount="abc"), msg(transaction_id="q", amount="42.5"),
        msg(transaction_id="nan", amount="NaN"),
        msg(transaction_id="bad-ts", amount=9000, timestamp="bad", country=None),
        json.dumps({**json.loads(msg(transaction_id="extra")), "zzz": 1}),
    ]
    parsed = parse_transactions(messages(spark, vals))
    rows = parsed.collect()
    assert len(rows) == len(vals)  # nothing vanishes at parse time
    clean, bad = split_malformed(parsed)
    reasons = {r.transaction_id: r.reason for r in bad.collect() if r.transaction_id}
    assert reasons == {"abc": "CORRUPT_RECORD", "q": "CORRUPT_RECORD"}
    assert bad.count() == 8
    by_id = {r.transaction_id: r for r in clean.collect()}
    assert set(by_id) == {"nan", "bad-ts", "extra"}
    assert math.isnan(by_id["nan"].amount)
    hv = {r.transaction_id: r for r in rules.high_value_alerts(clean, CFG).collect()}
    assert set(hv) == {"nan", "bad-ts"}  # NaN orders above every number
    assert hv["bad-ts"].fraud_reason is None  # NULL country -> NULL reason
    fraud = rules.fraud_lake_rows(rules.high_value_alerts(clean, CFG))
    assert {r.transaction_id: r.date for r in fraud.collect()}["bad-ts"] is None


def test_null_amount_row_still_counts_for_travel(spark):
    tx = tx_rows(spark, [
        ("a", "u1", "2024-01-01 00:01:00", None, "Food", "USA"),
        ("b", "u1", "2024-01-01 00:02:00", 1.0, "Food", "Japan"),
    ])
    assert rules.impossible_travel_tumbling(tx, CFG).count() == 1
    assert rules.valid_transactions(tx, CFG).count() == 1
    assert rules.high_value_alerts(tx, CFG).count() == 0


def test_geo_predicates(spark):
    tx = tx_rows(spark, [("a", "u", "2024-01-01 00:00:00", 1.0, "Food", "Sri Lanka"),
                         ("b", "u", "2024-01-01 00:00:00", 1.0, "Food", "France")])
    g = {r.country: r for r in rules.geo_flags(tx, CFG).collect()}
    assert g["Sri Lanka"].is_home and not g["Sri Lanka"].is_foreign and g["Sri Lanka"].is_branch_country
    assert g["France"].is_foreign and not g["France"].is_branch_country
    from ledgerguard.functions.expressions import foreign_countries_array
    got = spark.range(1).select(foreign_countries_array(CFG).alias("f")).first().f
    assert got == list(CFG.foreign_countries) and "Sri Lanka" not in got
