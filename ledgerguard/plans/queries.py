"""Registered queries over the given tables, and their DuckDB oracle SQL.

Each query reads the whole ``events`` table of a scale-factor folder, maps it
onto transactions (``sources.fixtures``) and runs one operator of the library.
The oracle SQL computes the same result independently in DuckDB from the same
parquet views. Column names and rounding agree on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerguard.config import FIXTURE_CONFIG as CFG
from ledgerguard.functions.expressions import foreign_countries_array
from ledgerguard.operators import rules, travel
from ledgerguard.plans import reports
from ledgerguard.sources.fixtures import fixture_transactions, read_table
from ledgerguard.sources.json_ingest import encode_transactions, parse_transactions, split_malformed
from ledgerguard.schema import ALERT_COLUMNS, ALERT_SCHEMA, TRANSACTION_COLUMNS
from ledgerguard.sinks.alerts import decode_alerts, encode_alerts

Query = Callable[[SparkSession, str], DataFrame]


def _tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture_transactions(spark, sf_dir, CFG)


def _lakes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    tx = _tx(spark, sf_dir)
    return rules.valid_transactions(tx, CFG), rules.fraud_lake_rows(rules.all_alerts(tx, CFG))


def _wire_with_text_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as producer messages; 'error' events carry their amount as text."""
    tx = _tx(spark, sf_dir)
    return encode_transactions(tx, text_amount=F.col("merchant_category") == F.lit("error"))


def q_high_value_alerts(spark, sf_dir):
    return rules.high_value_alerts(_tx(spark, sf_dir), CFG)


def q_valid_transactions(spark, sf_dir):
    return rules.valid_transactions(_tx(spark, sf_dir), CFG)


def q_impossible_travel_tumbling(spark, sf_dir):
    return rules.impossible_travel_tumbling(_tx(spark, sf_dir), CFG)


def q_all_alerts(spark, sf_dir):
    return rules.all_alerts(_tx(spark, sf_dir), CFG)


def q_alert_json_roundtrip(spark, sf_dir):
    encoded = encode_alerts(rules.all_alerts(_tx(spark, sf_dir), CFG))
    return decode_alerts(encoded)


def q_geo_flags(spark, sf_dir):
    """Transactions by country, with the country predicates and the list of foreign branches."""
    foreign = F.concat_ws(", ", foreign_countries_array(CFG))
    return rules.geo_flags(_tx(spark, sf_dir), CFG).withColumn("foreign_branches", foreign)


def q_reconciliation_reference(spark, sf_dir):
    return reports.reconciliation_reference(*_lakes(spark, sf_dir))


def q_reconciliation_true(spark, sf_dir):
    parsed = parse_transactions(_wire_with_text_amounts(spark, sf_dir))
    bad = F.col("_corrupt_record").isNotNull()
    return reports.reconciliation_true(parsed, CFG, malformed=bad)


def q_fraud_by_category(spark, sf_dir):
    return reports.fraud_by_category(_lakes(spark, sf_dir)[1])


def q_fraud_by_type(spark, sf_dir):
    return reports.fraud_by_type(_lakes(spark, sf_dir)[1])


def q_fraud_summary(spark, sf_dir):
    return reports.fraud_summary(_lakes(spark, sf_dir)[1])


def q_report_lines(spark, sf_dir):
    return reports.report_lines(*_lakes(spark, sf_dir))


def q_daily_lake_counts(spark, sf_dir):
    return reports.daily_lake_counts(*_lakes(spark, sf_dir))


def q_impossible_travel_trailing(spark, sf_dir):
    return travel.trailing_travel(_tx(spark, sf_dir), CFG)


def q_impossible_travel_hops(spark, sf_dir):
    return travel.travel_hops(_tx(spark, sf_dir), CFG)


def q_impossible_travel_session(spark, sf_dir):
    return travel.impossible_travel_session(_tx(spark, sf_dir), CFG)


def q_travel_alert_members(spark, sf_dir):
    members = rules.tumbling_travel_members(_tx(spark, sf_dir), CFG)
    return members.select("user_id", "window_start", "transaction_id", "country", "amount")


def q_valid_excluding_travel(spark, sf_dir):
    return rules.valid_excluding_travel(_tx(spark, sf_dir), CFG)


def q_parsed_transactions(spark, sf_dir):
    clean, _ = split_malformed(parse_transactions(_wire_with_text_amounts(spark, sf_dir)))
    return clean.select(*TRANSACTION_COLUMNS)


def q_malformed_quarantine(spark, sf_dir):
    _, bad = split_malformed(parse_transactions(_wire_with_text_amounts(spark, sf_dir)))
    return bad.select("transaction_id", "user_id", "country", "reason")


def q_lake_roundtrip_daily(spark, sf_dir):
    """Route the whole table as one batch into fresh lakes, read them back, report per day."""
    from ledgerguard.session import fresh_path
    from ledgerguard.sources.lakes import read_fraud_lake, read_valid_lake
    from ledgerguard.streaming.router import BatchRouter
    root = fresh_path(spark, "lakes")
    BatchRouter(valid_path=f"{root}/transactions", fraud_path=f"{root}/fraud", cfg=CFG, cache=False)(
        _tx(spark, sf_dir), 0)
    return reports.daily_lake_counts(read_valid_lake(spark, f"{root}/transactions"),
                                     read_fraud_lake(spark, f"{root}/fraud"))


def q_report_lines_absent_fraud(spark, sf_dir):
    """Both text reports where the valid lake holds the whole table's rows and no fraud lake exists."""
    from ledgerguard.session import fresh_path
    from ledgerguard.sources.lakes import read_fraud_lake
    return reports.report_lines(_lakes(spark, sf_dir)[0], read_fraud_lake(spark, fresh_path(spark, "no-lake")))


QUERIES: dict[str, Query] = {
    "high_value_alerts": q_high_value_alerts,
    "valid_transactions": q_valid_transactions,
    "impossible_travel_tumbling": q_impossible_travel_tumbling,
    "all_alerts": q_all_alerts,
    "alert_json_roundtrip": q_alert_json_roundtrip,
    "geo_flags": q_geo_flags,
    "reconciliation_reference": q_reconciliation_reference,
    "reconciliation_true": q_reconciliation_true,
    "fraud_by_category": q_fraud_by_category,
    "fraud_by_type": q_fraud_by_type,
    "fraud_summary": q_fraud_summary,
    "report_lines": q_report_lines,
    "report_lines_absent_fraud": q_report_lines_absent_fraud,
    "daily_lake_counts": q_daily_lake_counts,
    "impossible_travel_trailing": q_impossible_travel_trailing,
    "impossible_travel_hops": q_impossible_travel_hops,
    "impossible_travel_session": q_impossible_travel_session,
    "valid_excluding_travel": q_valid_excluding_travel,
    "travel_alert_members": q_travel_alert_members,
    "parsed_transactions": q_parsed_transactions,
    "malformed_quarantine": q_malformed_quarantine,
    "lake_roundtrip_daily": q_lake_roundtrip_daily,
}

# ---------------------------------------------------------------------------
# DuckDB oracle. ``tx`` is the same events -> transaction mapping.
# ---------------------------------------------------------------------------

_BRANCHES = "'Sri Lanka', 'USA', 'United Kingdom', 'Singapore', 'Australia', 'Germany', 'Japan', 'UAE'"


# Written out, so that the oracle does not share the engine's templates.
_HV_REASON = "'Amount $' || CAST(amount AS VARCHAR) || ' exceeds $150 threshold in ' || country"
_TRAVEL_REASON = ("'User transacted from ' || CAST(count(DISTINCT country) AS VARCHAR) || ' countries: ' || "
                  "string_agg(DISTINCT country, ', ' ORDER BY country) || ' within 10 minutes'")
_T = 150

TX = f"""tx AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id,
         CAST(user_id AS VARCHAR) AS user_id,
         strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS "timestamp",
         CAST(value AS DOUBLE) AS amount,
         'USD' AS currency,
         event_type AS merchant_category,
         ([{_BRANCHES}])[((TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) % 8) + 8) % 8 + 1] AS country,
         ts AS event_time
  FROM events)"""

_TX_COLS = 'transaction_id, user_id, "timestamp", amount, currency, merchant_category, country'

HIGH = f"""high AS (
  SELECT {_TX_COLS}, 'HIGH_VALUE' AS fraud_type,
         {_HV_REASON} AS fraud_reason
  FROM tx WHERE amount > {_T})"""

TRAVEL = f"""keys AS (
  SELECT user_id, time_bucket(INTERVAL 10 MINUTE, event_time) AS ws
  FROM tx WHERE event_time IS NOT NULL
  GROUP BY ALL HAVING count(DISTINCT country) > 1),
members AS (
  SELECT t.*, k.ws FROM tx t JOIN keys k
    ON t.user_id IS NOT DISTINCT FROM k.user_id
   AND time_bucket(INTERVAL 10 MINUTE, t.event_time) = k.ws),
travel AS (
  SELECT string_agg(DISTINCT transaction_id, ', ' ORDER BY transaction_id) AS transaction_id,
         user_id,
         arg_min_null("timestamp", (event_time, transaction_id)) AS "timestamp",
         arg_min_null(amount, (event_time, transaction_id)) AS amount,
         arg_min_null(currency, (event_time, transaction_id)) AS currency,
         arg_min_null(merchant_category, (event_time, transaction_id)) AS merchant_category,
         string_agg(DISTINCT country, ', ' ORDER BY country) AS country,
         'IMPOSSIBLE_TRAVEL' AS fraud_type,
         {_TRAVEL_REASON} AS fraud_reason
  FROM members GROUP BY user_id, ws)"""

_ALERTS = f"""WITH {TX}, {HIGH}, {TRAVEL},
alerts AS (SELECT * FROM high UNION ALL SELECT * FROM travel)"""

_LAKES = f"""{_ALERTS},
valid AS (SELECT {_TX_COLS}, CAST(TRY_CAST("timestamp" AS TIMESTAMP) AS DATE) AS date
          FROM tx WHERE amount <= {_T}),
fraud AS (SELECT *, CAST(TRY_CAST("timestamp" AS TIMESTAMP) AS DATE) AS date FROM alerts)"""

_NN = "CASE WHEN isnan(amount) THEN NULL ELSE amount END"


def _breakdown_sql(key: str, with_avg: bool) -> str:
    avg = f", round(avg({_NN}), 6) AS avg_amount" if with_avg else ""
    return f"""{_LAKES},
g AS (SELECT {key}, count(transaction_id) AS "count", count(*) AS rows_,
             round(coalesce(sum({_NN}), 0), 2) AS total_amount{avg}
      FROM fraud GROUP BY {key}),
s AS (SELECT *, sum(rows_) OVER () AS total_rows FROM g)
SELECT {key}, "count",
       round(CASE WHEN total_rows > 0 THEN CAST("count" AS DOUBLE) / total_rows * 100.0 ELSE 0.0 END, 6) AS pct,
       total_amount{', avg_amount' if with_avg else ''}
FROM s WHERE {key} IS NOT NULL"""


# Producer messages of 'error' events carry the amount as text, which the
# fixed schema rejects: those rows parse with a NULL amount and are quarantined.
_PARSED = f"""WITH {TX},
parsed AS (SELECT {_TX_COLS}, event_time,
                  CASE WHEN merchant_category = 'error' THEN NULL ELSE amount END AS amount_p,
                  merchant_category = 'error' AS bad FROM tx)"""

ORACLE: dict[str, str] = {
    "lake_roundtrip_daily": None,  # filled below (same as daily_lake_counts)
    "high_value_alerts": f"WITH {TX}, {HIGH} SELECT * FROM high",
    "valid_transactions": f"""WITH {TX}
SELECT {_TX_COLS}, CAST(TRY_CAST("timestamp" AS TIMESTAMP) AS DATE) AS date FROM tx WHERE amount <= {_T}""",
    "impossible_travel_tumbling": f"WITH {TX}, {TRAVEL} SELECT * FROM travel",
    "all_alerts": f"{_ALERTS} SELECT * FROM alerts",
    "alert_json_roundtrip": f"{_ALERTS} SELECT * FROM alerts",
    "geo_flags": f"""WITH {TX}
SELECT country, country = 'Sri Lanka' AS is_home, country <> 'Sri Lanka' AS is_foreign,
       country IN ({_BRANCHES}) AS is_branch_country,
       count(*) AS transactions, round(coalesce(sum({_NN}), 0), 2) AS volume,
       'USA, United Kingdom, Singapore, Australia, Germany, Japan, UAE' AS foreign_branches
FROM tx GROUP BY country""",
    "reconciliation_reference": f"""{_LAKES},
a AS (SELECT (SELECT count(*) FROM valid) AS vc,
             (SELECT coalesce(sum({_NN}), 0.0) FROM valid) AS vv,
             (SELECT count(*) FROM fraud) AS fc,
             (SELECT coalesce(sum({_NN}), 0.0) FROM fraud) AS fv)
SELECT vc + fc AS ingress_count, round(vv + fv, 2) AS ingress_volume,
       vc AS validated_count, round(vv, 2) AS validated_volume,
       fc AS fraud_count, round(fv, 2) AS fraud_volume,
       round((vv + fv) - vv - fv, 2) + 0.0 AS diff,
       CASE WHEN vc + fc = 0 THEN 'NO_DATA' WHEN abs((vv + fv) - vv - fv) < 0.01 THEN 'BALANCED'
            ELSE 'DISCREPANCY DETECTED' END AS status,
       round(CASE WHEN vc + fc > 0 THEN CAST(fc AS DOUBLE) / (vc + fc) * 100.0 ELSE 0.0 END, 6) AS fraud_rate,
       round(100.0 - round(CASE WHEN vc + fc > 0 THEN CAST(fc AS DOUBLE) / (vc + fc) * 100.0 ELSE 0.0 END, 6), 6)
         AS validation_rate
FROM a""",
    "reconciliation_true": f"""{_PARSED},
keys AS (SELECT user_id, time_bucket(INTERVAL 10 MINUTE, event_time) AS ws FROM parsed
         WHERE event_time IS NOT NULL GROUP BY ALL HAVING count(DISTINCT country) > 1),
m AS (SELECT p.*, k.ws IS NOT NULL AS member FROM parsed p LEFT JOIN keys k
        ON p.user_id IS NOT DISTINCT FROM k.user_id AND time_bucket(INTERVAL 10 MINUTE, p.event_time) = k.ws),
a AS (SELECT count(*) AS raw_count,
             count(*) FILTER (WHERE amount_p <= {_T}) AS valid_count,
             count(*) FILTER (WHERE amount_p > {_T}) AS high_value_count,
             count(*) FILTER (WHERE amount_p IS NULL) AS unrouted_count,
             count(*) FILTER (WHERE bad) AS malformed_count,
             (SELECT count(*) FROM keys) AS travel_alerts,
             count(*) FILTER (WHERE member) AS travel_members,
             count(*) FILTER (WHERE member AND amount_p <= {_T}) AS travel_members_valid,
             count(*) FILTER (WHERE member AND amount_p > {_T}) AS travel_members_high_value,
             round(coalesce(sum(CASE WHEN isnan(amount_p) THEN NULL ELSE amount_p END), 0), 2) AS raw_volume,
             round(coalesce(sum(amount_p) FILTER (WHERE amount_p <= {_T}), 0), 2) AS valid_volume,
             round(coalesce(sum(CASE WHEN isnan(amount_p) THEN NULL ELSE amount_p END)
                            FILTER (WHERE amount_p > {_T}), 0), 2) AS high_value_volume
      FROM m)
SELECT *, valid_count + high_value_count + travel_alerts AS reference_ingress_count,
       valid_count + high_value_count + travel_alerts - raw_count AS ingress_gap,
       CASE WHEN raw_count = 0 THEN 'NO_DATA'
            WHEN valid_count + high_value_count + unrouted_count = raw_count THEN 'BALANCED'
            ELSE 'DISCREPANCY DETECTED' END AS status
FROM a""",
    "fraud_by_category": _breakdown_sql("merchant_category", True),
    "fraud_by_type": _breakdown_sql("fraud_type", False),
    "fraud_summary": f"""{_LAKES}
SELECT count(*) AS fraud_count, round(coalesce(sum({_NN}), 0), 2) AS fraud_volume,
       round(CASE WHEN count(*) > 0 THEN coalesce(sum({_NN}), 0) / count(*) ELSE 0.0 END, 6) AS avg_amount
FROM fraud""",
    "daily_lake_counts": f"""{_LAKES},
u AS (SELECT 'V' AS kind, amount, date FROM valid UNION ALL SELECT 'F', amount, date FROM fraud)
SELECT date, CAST(grouping(date) AS BOOLEAN) AS is_total,
       count(*) FILTER (WHERE kind = 'V') AS validated_count,
       round(coalesce(sum({_NN}) FILTER (WHERE kind = 'V'), 0), 2) AS validated_volume,
       count(*) FILTER (WHERE kind = 'F') AS fraud_count,
       round(coalesce(sum({_NN}) FILTER (WHERE kind = 'F'), 0), 2) AS fraud_volume
FROM u GROUP BY ROLLUP (date)""",
    "impossible_travel_trailing": f"""WITH {TX}
SELECT {_TX_COLS} FROM tx a
WHERE a.user_id IS NOT NULL AND a.country IS NOT NULL AND a.event_time IS NOT NULL AND EXISTS (
  SELECT 1 FROM tx b WHERE b.user_id = a.user_id
     AND b.event_time BETWEEN a.event_time - INTERVAL 10 MINUTE AND a.event_time
     AND b.country <> a.country)""",
    "impossible_travel_hops": f"""WITH {TX},
s AS (SELECT transaction_id, user_id, "timestamp", country, event_time,
             lag(transaction_id) OVER w AS prev_transaction_id,
             lag("timestamp") OVER w AS prev_timestamp,
             lag(country) OVER w AS prev_country,
             epoch_us(event_time) - lag(epoch_us(event_time)) OVER w AS gap_us
      FROM tx WHERE user_id IS NOT NULL AND event_time IS NOT NULL
      WINDOW w AS (PARTITION BY user_id ORDER BY event_time, transaction_id))
SELECT transaction_id, user_id, "timestamp", country, prev_transaction_id, prev_timestamp, prev_country,
       gap_us / 1e6 AS gap_seconds
FROM s WHERE prev_country IS NOT NULL AND country IS NOT NULL AND prev_country <> country
  AND gap_us <= 600000000""",
    "impossible_travel_session": f"""WITH {TX},
o AS (SELECT *, lag(event_time) OVER (PARTITION BY user_id ORDER BY event_time, transaction_id) AS prev
      FROM tx WHERE user_id IS NOT NULL AND event_time IS NOT NULL),
s AS (SELECT *, sum(CASE WHEN prev IS NULL OR event_time > prev + INTERVAL 10 MINUTE THEN 1 ELSE 0 END)
                  OVER (PARTITION BY user_id ORDER BY event_time, transaction_id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM o)
SELECT user_id, min(event_time) AS session_start, max(event_time) + INTERVAL 10 MINUTE AS session_end,
       count(*) AS transactions, string_agg(DISTINCT country, ', ' ORDER BY country) AS country,
       'IMPOSSIBLE_TRAVEL' AS fraud_type,
       {_TRAVEL_REASON} AS fraud_reason
FROM s GROUP BY user_id, sid HAVING count(DISTINCT country) > 1""",
    "valid_excluding_travel": f"""WITH {TX},
keys AS (SELECT user_id, time_bucket(INTERVAL 10 MINUTE, event_time) AS ws FROM tx
         WHERE event_time IS NOT NULL GROUP BY ALL HAVING count(DISTINCT country) > 1)
SELECT {_TX_COLS}, CAST(TRY_CAST("timestamp" AS TIMESTAMP) AS DATE) AS date FROM tx t
WHERE amount <= {_T} AND NOT EXISTS (
  SELECT 1 FROM keys k WHERE t.user_id IS NOT DISTINCT FROM k.user_id
     AND time_bucket(INTERVAL 10 MINUTE, t.event_time) = k.ws)""",
    "parsed_transactions": f"""{_PARSED}
SELECT transaction_id, user_id, "timestamp", amount_p AS amount, currency, merchant_category, country
FROM parsed WHERE NOT bad AND transaction_id IS NOT NULL AND amount_p IS NOT NULL""",
    "malformed_quarantine": f"""{_PARSED}
SELECT transaction_id, user_id, country,
       CASE WHEN bad THEN 'CORRUPT_RECORD' WHEN transaction_id IS NULL THEN 'MISSING_TRANSACTION_ID'
            ELSE 'MISSING_AMOUNT' END AS reason
FROM parsed WHERE bad OR transaction_id IS NULL OR amount_p IS NULL""",
}

__all__ = ["QUERIES", "ORACLE", "ALERT_COLUMNS", "ALERT_SCHEMA", "read_table"]
ORACLE["lake_roundtrip_daily"] = ORACLE["daily_lake_counts"]
ORACLE["travel_alert_members"] = f"""WITH {TX}, {TRAVEL}
SELECT user_id, ws AS window_start, transaction_id, country, amount FROM members"""


def _lpad(expr: str, w: int) -> str:
    return f"(CASE WHEN length({expr}) >= {w} THEN {expr} ELSE lpad({expr}, {w}, ' ') END)"


def _rpad(expr: str, w: int) -> str:
    return f"(CASE WHEN length({expr}) >= {w} THEN {expr} ELSE rpad({expr}, {w}, ' ') END)"


def _report_lines_sql() -> str:
    """Report lines rebuilt in DuckDB from the oracle report tables."""
    cnt = lambda c: f"format('{{:,}}', {c})"
    mon = lambda c: f"format('{{:,.2f}}', CAST({c} AS DOUBLE))"
    rec_lines = [
        f"'Ingress Count    : ' || {_lpad(cnt('ingress_count'), 12)}",
        f"'Ingress Volume   : $' || {_lpad(mon('ingress_volume'), 14)}",
        f"'Validated Count  : ' || {_lpad(cnt('validated_count'), 12)}",
        f"'Validated Volume : $' || {_lpad(mon('validated_volume'), 14)}",
        f"'Fraud Count      : ' || {_lpad(cnt('fraud_count'), 12)}",
        f"'Fraud Volume     : $' || {_lpad(mon('fraud_volume'), 14)}",
        f"'Ingress - Validated - Fraud = $' || {mon('diff')}",
        f"'Status: ' || CASE WHEN status = 'BALANCED' THEN '✓ ' "
        f"ELSE '⚠ ' END || status",
        f"'Fraud Rate      : ' || printf('%.2f', fraud_rate) || '%'",
        f"'Validation Rate : ' || printf('%.2f', validation_rate) || '%'",
    ]
    parts = [f"SELECT 'reconciliation' AS section, CAST({i} AS BIGINT) AS ord, {x} AS line FROM rec"
             for i, x in enumerate(rec_lines)]
    parts += [f"SELECT 'summary', CAST({i} AS BIGINT), {x} FROM summ" for i, x in enumerate([
        f"'Total Fraud Transactions : ' || {cnt('fraud_count')}",
        f"'Total Fraud Volume       : $' || {mon('fraud_volume')}",
        f"'Average Fraud Amount     : $' || {mon('avg_amount')}"])]
    pct1 = "printf('%.1f', pct)"
    cw = (15, 7, 7, 12, 10)
    cat_line = (f"'│ ' || {_rpad('merchant_category', cw[0])} || ' │ ' || {_lpad(cnt('count'), cw[1])} || ' │ ' || "
                f"{_lpad(pct1, cw[2])} || '%  │ $' || {_lpad(mon('total_amount'), cw[3])} || "
                f"'  │ $' || {_lpad(mon('coalesce(avg_amount, 0.0)'), cw[4])} || '  │'")
    parts.append(f"SELECT 'by_category', CAST(row_number() OVER (ORDER BY count DESC, merchant_category) "
                 f"AS BIGINT), {cat_line} FROM cat")
    tw = (20, 6, 5, 12)
    typ_line = (f"{_rpad('fraud_type', tw[0])} || ' : ' || {_lpad(cnt('count'), tw[1])} || ' (' || "
                f"{_lpad(pct1, tw[2])} || '%) │ $' || {_lpad(mon('total_amount'), tw[3])}")
    bar_n = f"least(greatest(CAST(floor(pct / 2) AS INTEGER), 0), 50)"
    bar = (f"repeat(' ', 25) || repeat('█', {bar_n}) || "
           f"repeat('░', 50 - {bar_n})")
    parts.append(f"SELECT 'by_type', 2 * r, l1 FROM (SELECT CAST(row_number() OVER "
                 f"(ORDER BY count DESC, fraud_type) AS BIGINT) AS r, {typ_line} AS l1 FROM typ)")
    parts.append(f"SELECT 'by_type', 2 * r + 1, l2 FROM (SELECT CAST(row_number() OVER "
                 f"(ORDER BY count DESC, fraud_type) AS BIGINT) AS r, {bar} AS l2 FROM typ)")
    return (f"WITH rec AS (SELECT * FROM ({ORACLE['reconciliation_reference']})), "
            f"summ AS (SELECT * FROM ({ORACLE['fraud_summary']})), "
            f"cat AS (SELECT * FROM ({ORACLE['fraud_by_category']})), "
            f"typ AS (SELECT * FROM ({ORACLE['fraud_by_type']}))\n" + "\nUNION ALL\n".join(parts))


ORACLE["report_lines"] = _report_lines_sql()
ORACLE["report_lines_absent_fraud"] = ORACLE["report_lines"].replace(
    "date FROM alerts)", "date FROM alerts WHERE false)")
