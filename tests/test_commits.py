"""One commit a batch, compaction, late rows, observed counts, the broker source's bound."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerguard.config import DEFAULT_CONFIG
from ledgerguard.config import FIXTURE_CONFIG as CFG
from ledgerguard.jobs import compact_lakes, screen_table
from ledgerguard.operators import rules
from ledgerguard.schema import TRANSACTION_SCHEMA
from ledgerguard.sinks import commits
from ledgerguard.sinks.alerts import MESSAGE, decode_alerts
from ledgerguard.sources.fixtures import fixture_transactions
from ledgerguard.sources.json_ingest import parse_transactions, screened_form
from ledgerguard.sources.lakes import read_committed, read_fraud_lake, read_valid_lake
from ledgerguard.streaming import router as router_module
from ledgerguard.streaming.router import (LATE_SCHEMA, METRICS_SCHEMA, QUARANTINE_SCHEMA, BatchRouter, batch_watermark_ms,
                                          start_screening)
from ledgerguard.streaming.sources import file_source, kafka_options
from tests.conftest import SF_SMALL
from tests.helpers import messages


def _rows(spark, n, day="2024-01-01", amount=1.0, start=0):
    rows = [(f"{start + i}", f"u{i % 3}", f"{day} 00:00:{i % 60:02d}", amount, "USD", "Food", "USA") for i in range(n)]
    return screened_form(spark.createDataFrame(rows, TRANSACTION_SCHEMA))


def _ids(df):
    return sorted(r.transaction_id for r in df.select("transaction_id").collect())


def test_a_batch_that_fails_between_two_sinks_shows_nothing(spark, workdir, monkeypatch):
    router = BatchRouter(f"{workdir}/valid", f"{workdir}/fraud", CFG, alert_format="json", alert_path=f"{workdir}/alerts",
                         metrics_path=f"{workdir}/metrics")

    def shown():
        return (_ids(read_valid_lake(spark, f"{workdir}/valid")), _ids(read_fraud_lake(spark, f"{workdir}/fraud")),
                _ids(decode_alerts(read_committed(spark, f"{workdir}/alerts", MESSAGE, "json"))),
                sorted((r.batch_id, r.raw) for r in read_committed(spark, f"{workdir}/metrics", METRICS_SCHEMA).collect()))
    batch = _rows(spark, 4).unionByName(_rows(spark, 2, amount=9000.0, start=10))
    fail = monkeypatch.context
    with fail() as m:
        m.setattr(router_module, "valid_transactions", lambda *a: 1 / 0)  # alerts and fraud rows are written by then
        with pytest.raises(ZeroDivisionError):
            router(batch, 0)
    assert spark.read.json(f"{workdir}/alerts").count() == 2
    assert shown() == ([], [], [], [])
    router(batch, 0)
    whole = (["0", "1", "2", "3"], ["10", "11"], ["10", "11"], [(0, 6)])
    assert shown() == whole
    with fail() as m:  # a replay with other rows that does not end: the first try stays, whole
        m.setattr(router_module, "commit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            router(_rows(spark, 9, start=50), 0)
    assert shown() == whole
    router(_rows(spark, 1, start=70), 0)  # one that ends takes its place
    assert shown() == (["70"], [], [], [(0, 1)])
    router(_rows(spark, 1, start=80), 1)
    assert shown()[0] == ["70", "80"] and shown()[3] == [(0, 1), (1, 1)]


def _files(spark, folder):
    return len([f for f in spark.read.parquet(folder).inputFiles()])


def test_compaction_shows_the_same_rows_in_few_files(spark, workdir, monkeypatch):
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    for i in range(6):
        rows = _rows(spark, 20, days[i % 3], start=100 * i).unionByName(_rows(spark, 3, days[i % 3], 9000.0, 100 * i + 50))
        screen_table(spark, rows.unionByName(_rows(spark, 1, "no date", start=100 * i + 90)), workdir, batch_id=i, run_id="r")
    lake, fraud = f"{workdir}/transactions", f"{workdir}/fraud"

    def rows():
        return (sorted(map(tuple, read_valid_lake(spark, lake).select("transaction_id", "date", "batch_id", "run_id").collect()),
                       key=str), _ids(read_fraud_lake(spark, fraud)))
    before = rows()
    assert len(before[0]) == 126 and len(before[1]) == 18
    early = read_valid_lake(spark, lake)  # a reader that began before
    put, seen = commits._put, []
    monkeypatch.setattr(commits, "_put", lambda *a: (seen.append(rows()), put(*a), seen.append(rows())))
    got = compact_lakes(spark, workdir, [*days, commits.NO_DATE, "2030-01-01"])
    monkeypatch.undo()
    assert all(x == before for x in seen) and len(seen) == 16  # day by day, lake by lake, and the counts
    assert got["transactions"] == {d: 1 for d in [*days, commits.NO_DATE]} and got["fraud"] == {d: 1 for d in days}
    assert rows() == before and early.count() == 126
    one = read_valid_lake(spark, lake, days[0])
    assert one.count() == 40 and len({f for f in one.inputFiles()}) == 3  # two old attempts, not deleted yet, and the new one
    assert compact_lakes(spark, workdir, days) == {"transactions": {}, "fraud": {}}  # nothing to do

    # a late batch stays beside, until the day is compacted again; old folders go after their time
    screen_table(spark, _rows(spark, 5, days[0], start=900), workdir, batch_id=9, run_id="r")
    assert read_valid_lake(spark, lake, days[0]).count() == 45
    assert compact_lakes(spark, workdir, days, keep_s=0.0)["transactions"] == {days[0]: 1}
    assert read_valid_lake(spark, lake, days[0]).count() == 45
    assert _files(spark, f"{lake}/date={days[0]}") == 1 and _files(spark, f"{lake}/date={days[1]}") == 1
    after = rows()
    assert [r for r in after[0] if r[2] != 9] == before[0] and after[1] == before[1]
    # markers of batches with nothing left but compacted rows go; rows without a date were still theirs
    def markers():
        return len(commits._markers(spark, f"{workdir}/commits/batches"))
    counts = sorted(map(tuple, read_committed(spark, f"{workdir}/metrics", METRICS_SCHEMA).collect()))
    assert markers() == 6 and len(counts) == 7
    compact_lakes(spark, workdir, [commits.NO_DATE], keep_s=0.0)
    assert markers() == 0 and rows() == after
    assert sorted(map(tuple, read_committed(spark, f"{workdir}/metrics", METRICS_SCHEMA).collect())) == counts
    assert _files(spark, f"{workdir}/metrics") == 1
    screen_table(spark, _rows(spark, 2, days[1], start=990), workdir, batch_id=0, run_id="r2")
    assert len(rows()[0]) == len(after[0]) + 2


def test_compacted_files_are_bounded_by_bytes(spark, workdir):
    tx = spark.range(30_000).select(F.col("id").cast("string").alias("transaction_id"), F.sha2(F.col("id").cast("string"), 256).alias("user_id"),
                                    F.lit("2024-01-01 00:00:00").alias("timestamp"), F.lit(1.0).alias("amount"),
                                    F.lit("USD").alias("currency"), F.lit("Food").alias("merchant_category"), F.lit("USA").alias("country"))
    screen_table(spark, screened_form(tx), workdir)
    size = commits._folder_bytes(spark, f"{workdir}/transactions/date=2024-01-01")
    n = compact_lakes(spark, workdir, ["2024-01-01"], file_bytes=size // 5, keep_s=0.0)["transactions"]["2024-01-01"]
    assert n == 6 and 3 <= _files(spark, f"{workdir}/transactions/date=2024-01-01") <= n
    assert read_valid_lake(spark, f"{workdir}/transactions").select("transaction_id").distinct().count() == 30_000


def test_many_attempts_are_filtered_by_a_join(spark, workdir, monkeypatch):
    for i in range(3):
        screen_table(spark, _rows(spark, 2, start=10 * i), workdir)
    want = _ids(read_valid_lake(spark, f"{workdir}/transactions"))
    monkeypatch.setattr(commits, "LISTED", 1)
    assert _ids(read_valid_lake(spark, f"{workdir}/transactions")) == want and len(want) == 6


def test_backfill_reads_its_input_once_a_sink(spark, workdir):
    """Counts come with a write and messages from the fraud lake: neither costs a scan."""
    n = 50
    scanned = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            scanned.add(len(b))
            yield b
    text = messages(spark, [json.dumps({"transaction_id": str(i), "user_id": "u", "timestamp": "2024-01-01 00:00:00", "amount": 1.0,
                                        "country": "USA"}) for i in range(n - 1)] + ["bad"])
    rows = parse_transactions(text.mapInPandas(count, "value string"))
    screen_table(spark, rows, workdir, alert_format="json")
    # fraud: high value, flagged groups, their members; quarantine with the counts; valid
    assert scanned.value == 5 * n, scanned.value / n
    m = read_committed(spark, f"{workdir}/metrics", METRICS_SCHEMA).first()
    assert (m.raw, m.valid, m.high_value, m.unrouted, m.malformed, m.alerts, m.travel_alerts) == (n, n - 1, 0, 1, 1, 0, 0)
    assert [r.reason for r in read_committed(spark, f"{workdir}/quarantine", QUARANTINE_SCHEMA).collect()] == ["CORRUPT_RECORD"]


def test_counts_of_batches_without_rows_or_alerts(spark, workdir):
    for i, values in enumerate(([], ["bad"], ["{}", "also bad"])):
        screen_table(spark, parse_transactions(messages(spark, values)), workdir, batch_id=i, run_id="r")
    got = sorted(map(tuple, read_committed(spark, f"{workdir}/metrics", METRICS_SCHEMA).collect()))
    assert got == [(0, 0, 0, 0, 0, 0, 0, 0), (1, 1, 0, 0, 1, 1, 0, 0), (2, 2, 0, 0, 2, 2, 0, 0)]


def test_late_rows_are_kept_and_a_replay_splits_them_alike(spark, workdir):
    from tests.test_streaming import _in_batches
    batches = [[("a", "u", "2024-01-01 01:00:00", "USA")], [("b", "u", "2024-01-01 00:57:59", "USA"), ("c", "u", "2024-01-01 00:58:00", "USA"),
                                                            ("d", "u", "2024-01-01 02:00:00.5", "USA"), ("e", None, None, "USA")],
               [("f", "u", "2024-01-01 01:58:00", "USA"), ("g", "u", "2024-01-01 01:58:00.500001", "USA")]]
    router = BatchRouter(f"{workdir}/valid", f"{workdir}/fraud", DEFAULT_CONFIG, late_path=f"{workdir}/late")
    q = start_screening(_in_batches(spark, f"{workdir}/in", batches), router, f"{workdir}/ckpt", available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    late = sorted((r.transaction_id, r.batch_id) for r in read_committed(spark, f"{workdir}/late", LATE_SCHEMA).collect())
    assert late == [("b", 1), ("f", 2)]
    assert _ids(read_valid_lake(spark, f"{workdir}/valid")) == list("abcdefg")  # routed all the same
    assert [batch_watermark_ms(spark, f"{workdir}/ckpt", b) % 3_600_000 for b in (0, 1, 2)] == [0, 3_480_000, 3_480_500]
    # the same batch again, after the query has gone on
    again = screened_form(spark.createDataFrame([(i, u, ts, 1.0, "USD", "Food", c) for i, u, ts, c in batches[1]], TRANSACTION_SCHEMA))
    router(again.withColumn("_instant", F.col("timestamp").cast("timestamp")), 1)
    assert sorted((r.transaction_id, r.batch_id) for r in read_committed(spark, f"{workdir}/late", LATE_SCHEMA).collect()) == late


def test_router_equals_the_rules(spark, workdir):
    tx = fixture_transactions(spark, SF_SMALL, CFG)
    screen_table(spark, tx, workdir, CFG)
    assert _ids(read_valid_lake(spark, f"{workdir}/transactions")) == _ids(rules.valid_transactions(tx, CFG))
    assert _ids(read_fraud_lake(spark, f"{workdir}/fraud")) == _ids(rules.all_alerts(tx, CFG))


def test_the_broker_source_is_bounded():
    assert kafka_options()["maxOffsetsPerTrigger"] == "1000000"
    assert kafka_options(DEFAULT_CONFIG.with_(max_offsets_per_trigger=5))["maxOffsetsPerTrigger"] == "5"
    own = DEFAULT_CONFIG.with_(kafka_options={"maxOffsetsPerTrigger": "7", "kafka.bootstrap.servers": "h:1"})
    assert kafka_options(own)["maxOffsetsPerTrigger"] == "7" and kafka_options(own)["kafka.bootstrap.servers"] == "h:1"


def test_a_second_report_reads_the_changed_days_alone(spark, workdir, monkeypatch):
    from ledgerguard import jobs
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    for i, d in enumerate([*days, "no date"]):
        screen_table(spark, _rows(spark, 5, d, start=100 * i).unionByName(_rows(spark, 2, d, 9000.0, 100 * i + 50)), workdir, batch_id=i)
    read = []
    real = jobs.read_days
    monkeypatch.setattr(jobs, "read_days", lambda spark, path, found, schema: (read.append(real(spark, path, found, schema)), read[-1])[1])

    def report():
        read.clear()
        jobs.run_reports(spark, workdir, f"{workdir}/reports", stamp="s")
        files = sorted({f.rsplit("date=", 1)[1].split("/")[0] for df in read for f in df.inputFiles()})
        rows = [sorted(map(str, df.collect())) for df in (jobs.build_reports(spark, workdir, cube=jobs.read_cube(spark, workdir)).daily,
                                                          jobs.build_reports(spark, workdir).daily)]
        assert rows[0] == rows[1] and len(rows[0]) == len(days) + 2
        return files
    assert report() == [*days, commits.NO_DATE]
    assert report() == []
    screen_table(spark, _rows(spark, 4, days[1], start=900), workdir)
    assert report() == [days[1]]
    screen_table(spark, _rows(spark, 6, days[2], start=950), workdir, batch_id=2, run_id="x")
    screen_table(spark, _rows(spark, 1, days[2], start=980), workdir, batch_id=2, run_id="x")  # in its place
    assert report() == [days[2]]
    compact_lakes(spark, workdir, days[:1])  # the same rows, in other files
    assert report() == days[:1]


def test_copies_are_dropped_by_the_lakes_ids(spark, workdir):
    router = BatchRouter(f"{workdir}/valid", f"{workdir}/fraud", CFG, drop_copies=True)
    router(_rows(spark, 5).unionByName(_rows(spark, 2, amount=9000.0, start=50)).unionByName(_rows(spark, 2)), 0)

    def shown():
        return _ids(read_valid_lake(spark, f"{workdir}/valid")), _ids(read_fraud_lake(spark, f"{workdir}/fraud"))
    want = (["0", "1", "2", "3", "4"], ["50", "51"])
    assert shown() == want
    router(_rows(spark, 7).unionByName(_rows(spark, 3, amount=9000.0, start=50)), 1)  # five and two of them are copies
    assert shown() == (["0", "1", "2", "3", "4", "5", "6"], ["50", "51", "52"])
    router(_rows(spark, 7), 1)  # batch 1 again, with less: its own first try does not make its rows copies
    assert shown() == (["0", "1", "2", "3", "4", "5", "6"], ["50", "51"])
    near = BatchRouter(f"{workdir}/valid", f"{workdir}/fraud", CFG, drop_copies=True, copy_days=2)
    near(_rows(spark, 2, "2024-01-03"), 0)
    assert len(shown()[0]) == 7
    near(_rows(spark, 2, "2024-01-04"), 1)  # beyond the days looked back, as the lake dates copies by their first event
    assert len(shown()[0]) == 9


def test_rows_without_an_id_are_no_copies(spark, workdir):
    rows = parse_transactions(messages(spark, ["bad", "bad", "{}", '{"transaction_id": "a", "amount": 1.0}', '{"transaction_id": "a", "amount": 1.0}']))
    landed = spark.createDataFrame([("z",)], "transaction_id string")
    assert _ids_or_none(rules.drop_landed(rows, landed)) == ["a", None, None, None]
    assert _ids_or_none(rules.drop_landed(rows, spark.createDataFrame([("a",), (None,)], "transaction_id string"))) == [None] * 3


def _ids_or_none(df):
    return sorted((r.transaction_id for r in df.collect()), key=lambda x: (x is None, x))


def test_amounts_that_no_sum_holds_are_counted(spark):
    from ledgerguard.plans import reports
    rows = [("a", 1.5), ("b", float("inf")), ("c", float("-inf")), ("d", 1e25), ("e", float("nan")), ("f", None), ("g", 9.9e23)]
    rows = [(i, "u", "2024-01-01 00:00:00", a, "USD", "Food", "USA") for i, a in rows]
    lake = spark.createDataFrame(rows, TRANSACTION_SCHEMA)
    for measures in (reports.lake_measures(lake, lake.limit(0)), reports.report_cube(lake, lake.limit(0))):
        assert tuple(reports.unsummed_of(measures).first()) == (3, 0)
        assert reports.reconciliation_of(measures).first().validated_count == 7


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_with_a_zone_are_utc_wall_clocks(spark, zone):
    texts = ["2024-01-01 00:10:00", "2024-01-01 00:10:00+05:30", "2024-01-01T00:10:00Z", "2024-01-01 00:10:00.25 UTC", "2024-01-01 00:10:00-0800",
             "2024-01-01 00:10:00 Asia/Tokyo", "2024-03-10 02:30:00", "2024-01-01", "00:10 nonsense", "", None, "2024-01-01 00:10:00 XQ"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = screened_form(spark.createDataFrame([(str(i), "u", t, 1.0, "", "", "") for i, t in enumerate(texts)], TRANSACTION_SCHEMA))
        got = [r.t for r in rows.orderBy(F.col("transaction_id").cast("int")).select(F.col("event_time").cast("string").alias("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == ["2024-01-01 00:10:00", "2023-12-31 18:40:00", "2024-01-01 00:10:00", "2024-01-01 00:10:00.25", "2024-01-01 08:10:00",
                   "2023-12-31 15:10:00", "2024-03-10 02:30:00", "2024-01-01 00:00:00", None, None, None, None]
