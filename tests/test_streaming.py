"""Streams equal the batch operators; replays are idempotent."""

from pyspark.sql import functions as F

from ledgerguard.config import FIXTURE_CONFIG as CFG
from ledgerguard.operators import rules
from ledgerguard.schema import ALERT_COLUMNS, TRANSACTION_COLUMNS
from ledgerguard.sinks.alerts import MESSAGE
from ledgerguard.sources.fixtures import fixture_transactions
from ledgerguard.sources.lakes import read_committed, read_fraud_lake, read_valid_lake
from ledgerguard.streaming import queries as sq
from ledgerguard.streaming.router import METRICS_SCHEMA, BatchRouter
from tests.conftest import SF_SMALL


def _same(a, b):
    return sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_stream_router_equals_batch(spark):
    tx = fixture_transactions(spark, SF_SMALL, CFG)
    base = sq.screen_replay(spark, SF_SMALL)
    fraud = read_fraud_lake(spark, f"{base}/fraud").select(*ALERT_COLUMNS)
    valid = read_valid_lake(spark, f"{base}/valid").select(*TRANSACTION_COLUMNS, "date")
    assert _same(fraud, rules.all_alerts(tx, CFG))
    assert _same(valid, rules.valid_transactions(tx, CFG))
    m = read_committed(spark, f"{base}/metrics", METRICS_SCHEMA)
    assert m.select(F.countDistinct("batch_id")).first()[0] == sq.REPLAY_FILES
    assert m.agg(F.sum("raw")).first()[0] == tx.count()
    alerts = read_committed(spark, f"{base}/alerts", MESSAGE, "json")
    assert alerts.count() == fraud.count()


def test_replayed_batch_is_idempotent(spark, workdir):
    tx = fixture_transactions(spark, SF_SMALL, CFG)
    router = BatchRouter(valid_path=f"{workdir}/valid", fraud_path=f"{workdir}/fraud", cfg=CFG)
    router(tx, 7)
    router(tx, 7)  # the same micro-batch again, e.g. after a failure
    router(tx.where(F.col("amount") > 100), 8)
    valid = read_valid_lake(spark, f"{workdir}/valid")
    n = rules.valid_transactions(tx, CFG).count()
    assert valid.where("batch_id = 7").count() == n
    fraud = read_fraud_lake(spark, f"{workdir}/fraud")
    assert fraud.where("batch_id = 7").count() == rules.all_alerts(tx, CFG).count()


def test_stateful_streams_equal_batch(spark):
    tx = fixture_transactions(spark, SF_SMALL, CFG)
    from ledgerguard.operators import travel
    assert _same(sq.q_stream_travel_stateful(spark, SF_SMALL),
                 rules.impossible_travel_tumbling(tx, CFG))
    assert _same(sq.q_stream_travel_trailing(spark, SF_SMALL), travel.trailing_travel(tx, CFG))
    assert sq.q_stream_dedup(spark, SF_SMALL).count() == tx.count()


def test_per_batch_tumbling_equals_batch_rule_per_chunk(spark, workdir):
    """J5: each micro-batch is screened on its own, so pairs split across
    batches are missed (original behaviour); the stateful rule finds them."""
    from ledgerguard.streaming.replay import write_replay
    from ledgerguard.streaming.sources import file_source
    from ledgerguard.sources.json_ingest import parse_transactions
    from ledgerguard.streaming.router import start_screening
    tx = fixture_transactions(spark, SF_SMALL, CFG)
    # Chunks cut by event_id, not by day: windows straddle chunk boundaries.
    msgs = tx.select(F.to_json(F.struct(*TRANSACTION_COLUMNS)).alias("value"),
                     F.col("transaction_id").cast("long").alias("_replay_date"))
    src = write_replay(msgs, f"{workdir}/src", 5, fmt="text")
    router = BatchRouter(valid_path=f"{workdir}/valid", fraud_path=f"{workdir}/fraud", cfg=CFG)
    q = start_screening(parse_transactions(file_source(spark, src, "text")), router,
                        f"{workdir}/ckpt", available_now=True)
    q.awaitTermination()
    got = read_fraud_lake(spark, f"{workdir}/fraud").where("fraud_type = 'IMPOSSIBLE_TRAVEL'")
    per_chunk = None
    for f in sorted(spark.read.text(src).inputFiles()):
        chunk = parse_transactions(spark.read.text(f))
        part = rules.impossible_travel_tumbling(chunk, CFG)
        per_chunk = part if per_chunk is None else per_chunk.unionByName(part)
    assert _same(got.select(*ALERT_COLUMNS), per_chunk)
    assert got.count() <= rules.impossible_travel_tumbling(tx, CFG).count()


def _messages_of(rows):
    import json
    return [json.dumps({"transaction_id": i, "user_id": u, "timestamp": ts, "amount": 1.0, "currency": "USD",
                        "merchant_category": "Food", "country": c}) for i, u, ts, c in rows]


def _in_batches(spark, folder, batches):
    """Each list of rows is one file, and so one micro-batch."""
    import time
    from ledgerguard.sources.json_ingest import parse_transactions
    from ledgerguard.streaming.sources import file_source
    for rows in batches:
        spark.createDataFrame([(m,) for m in _messages_of(rows)], "value string").coalesce(1).write.mode("append").text(folder)
        time.sleep(0.02)  # files are taken by their times
    return parse_transactions(file_source(spark, folder, "text"))


LATE = [[("R", "u1", "2024-01-01 00:10:00", "USA"), ("Z", "u1", "2024-01-01 00:10:30", "USA"), ("N", None, "2024-01-01 00:10:00", "UAE")],
        [("L", "u1", "2024-01-01 00:09:00", "Japan"), ("O", "u2", "2024-01-01 00:10:00", "UAE")],  # 90 s late
        [("P", "u2", "2024-01-01 00:20:00", "USA"), ("Q", "u2", "2024-01-01 00:20:00.000001", "Japan"), ("C", "u2", "2024-01-01 00:12:00", None)],
        [("end", "u9", "2024-01-01 02:00:00", "UAE")]]


def _collected(rows, workdir, name="q"):
    """[(ids of each micro-batch)], the query."""
    seen = {}
    q = (rows.writeStream.outputMode("append").foreachBatch(
            lambda df, b: seen.update({b: sorted(r.transaction_id for r in df.collect())}))
         .option("checkpointLocation", f"{workdir}/{name}").trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None
    return seen, q


def test_trailing_join_flags_earlier_rows_on_late_arrival(spark, workdir):
    from ledgerguard.config import DEFAULT_CONFIG
    from ledgerguard.operators import travel
    from ledgerguard.streaming.stateful import stateful_trailing_travel
    stream = _in_batches(spark, f"{workdir}/in", LATE)
    seen, q = _collected(stateful_trailing_travel(stream, DEFAULT_CONFIG), workdir)
    got = sorted(i for ids in seen.values() for i in ids)
    from tests.helpers import tx_rows
    rows = [(i, u, ts, 1.0, "Food", c) for batch in LATE for i, u, ts, c in batch]
    want = sorted(r.transaction_id for r in travel.trailing_travel(tx_rows(spark, rows)).collect())
    assert got == want == ["P", "Q", "R", "Z"]
    # all state but that of the last user has expired
    assert sum(op["numRowsTotal"] for op in q.lastProgress["stateOperators"]) <= 4


def test_live_travel_alerts_in_the_batch_of_the_second_row(spark, workdir):
    from ledgerguard.config import DEFAULT_CONFIG
    from ledgerguard.streaming.live import PROVIDER, live_travel, rocksdb
    stream = _in_batches(spark, f"{workdir}/in", LATE)
    before = spark.conf.get(PROVIDER, None)
    with rocksdb(spark):
        seen, q = _collected(live_travel(stream, DEFAULT_CONFIG), workdir)
    assert spark.conf.get(PROVIDER, None) == before
    # R and Z wait for the late L; P meets O of its user; Q meets P
    assert {b: ids for b, ids in seen.items() if ids} == {1: ["R", "Z"], 2: ["P", "Q"]}
    # timers have emptied every bucket but those of the last row: its context in two, itself waiting in one
    last = [p for p in q.recentProgress if p["stateOperators"]][-1]["stateOperators"][0]
    metrics = last["customMetrics"]
    assert last["numRowsTotal"] <= 6, (last["numRowsTotal"], metrics)


def test_live_and_joined_travel_on_random_arrivals(spark, workdir):
    """Rows of a few users, out of order within the watermark delay, ties and equal ids included."""
    import random
    from ledgerguard.config import DEFAULT_CONFIG
    from ledgerguard.operators import travel
    from ledgerguard.streaming.live import live_travel, rocksdb
    from ledgerguard.streaming.stateful import stateful_trailing_travel
    from tests.helpers import tx_rows
    rnd = random.Random(4)
    rows = []
    for n in range(240):
        at = rnd.randrange(0, 5400)
        rows.append((at + rnd.randrange(0, 100), (f"t{rnd.randrange(200)}", rnd.choice(["a", "a", "b", "c"]),
                     f"2024-01-01 {at // 3600:02d}:{at // 60 % 60:02d}:{at % 60:02d}", rnd.choice(["USA", "UAE", "Japan", None]))))
    rows = [r for _, r in sorted(rows, key=lambda x: x[0])]  # arrival: at most 100 s after the event
    batches = [rows[i:i + 60] for i in range(0, 240, 60)] + [[("end", "z", "2024-01-01 05:00:00", "UAE")]]
    cfg = DEFAULT_CONFIG.with_(watermark_delay="10 minutes")
    want = sorted(r.transaction_id for r in travel.trailing_travel(
        tx_rows(spark, [(i, u, ts, 1.0, "Food", c) for i, u, ts, c in rows])).collect())
    joined, _ = _collected(stateful_trailing_travel(_in_batches(spark, f"{workdir}/in", batches), cfg), workdir, "a")
    assert sorted(i for ids in joined.values() for i in ids) == want and len(want) > 40
    from ledgerguard.sources.json_ingest import parse_transactions
    from ledgerguard.streaming.sources import file_source
    with rocksdb(spark):
        live, _ = _collected(live_travel(parse_transactions(file_source(spark, f"{workdir}/in", "text")), cfg), workdir, "b")
    assert sorted(i for ids in live.values() for i in ids) == want


def test_live_travel_calls_its_store_a_few_times_a_group(monkeypatch):
    """However many users and rows a micro-batch has in a shard and bucket; chunks of waiting rows are bounded."""
    import json
    import random
    from pyspark.sql import Row
    from ledgerguard.streaming import live
    calls = []

    class State:
        def __init__(self):
            self.held = {}

        def registerTimer(self, at):
            calls.append("timer")

        def get(self):
            calls.append("get")
            return self.held.get(0)

        def update(self, value):
            calls.append("update")
            self.held[0] = value

        def updateValue(self, key, value):
            calls.append("updateValue")
            assert len(value[0]) <= 300
            self.held[key] = value

        def removeKey(self, key):
            calls.append("removeKey")
            del self.held[key]

        def iterator(self):
            calls.append("iterator")
            return iter(list(self.held.items()))

        def getValueState(self, *a):
            return State()
        getMapState = getValueState

    monkeypatch.setattr(live, "CHUNK", 300)
    w, shards, rnd = 600_000_000, 4, random.Random(1)
    processor = live.TrailingTravelProcessor(w, w // 10, shards)
    processor.init(State())
    rows = [(str(i), f"u{rnd.randrange(500)}", rnd.randrange(6 * w), rnd.choice(["USA", "UAE"])) for i in range(1000)]
    got = []
    for part in (rows[:500], rows[500:]):
        calls.clear()
        messages = [Row(message=json.dumps({"transaction_id": i, "user_id": u, "country": c, "_t": t})) for i, u, t, c in part]
        got += [json.loads(r.message)["transaction_id"] for r in processor.handleInputRows((3,), iter(messages), None)]
        assert len(calls) <= 8, calls
    want = [i for i, u, t, c in rows if any(v == u and t - w <= x <= t and d != c for _, v, x, d in rows)]
    assert sorted(got) == sorted(want) and len(want) > 50


def test_live_travel_gives_back_whole_transactions(spark, workdir):
    """Rows as they came: nulls, amounts that are no number or beyond a float's text, quotes, control and wide characters."""
    from ledgerguard.config import DEFAULT_CONFIG
    from ledgerguard.schema import TRANSACTION_SCHEMA
    from ledgerguard.sources.json_ingest import screened_form
    from ledgerguard.streaming.live import live_travel, rocksdb
    rows = [("a", "u \"1\"", "2024-01-01 00:00:00", 0.1 + 0.2, None, "x\n\u2028\t", "USA"),
            (None, "u \"1\"", "2024-01-01 00:01:00", float("nan"), "", "\\{", "C\u00f4te d'Ivoire"),
            ("c", "u \"1\"", "2024-01-01 00:02:00", float("-inf"), "USD", "\U0001f600", "USA"),
            ("d", "u \"1\"", "2024-01-01 00:03:00", None, "USD", None, "UAE"),
            ("e", "u \"1\"", "2024-01-01 00:04:00", -1.7976931348623157e308, "USD", "Food", "USA")]
    landed = spark.createDataFrame(rows, TRANSACTION_SCHEMA)
    landed.coalesce(1).write.parquet(f"{workdir}/in")
    stream = screened_form(spark.readStream.schema(TRANSACTION_SCHEMA).parquet(f"{workdir}/in"))
    seen = []
    with rocksdb(spark):
        alerts = live_travel(stream, DEFAULT_CONFIG)
        q = (alerts.writeStream.outputMode("append").foreachBatch(lambda df, b: seen.extend(tuple(r) for r in df.collect()))
             .option("checkpointLocation", f"{workdir}/c").trigger(availableNow=True).start())
        q.awaitTermination()
    assert q.exception() is None
    assert sorted(map(repr, seen)) == sorted(map(repr, rows[1:]))
    assert [f.name for f in alerts.schema] == [f.name for f in TRANSACTION_SCHEMA]


def test_sinks_that_emit_nothing_read_back_empty(spark, workdir):
    import json
    from ledgerguard.config import DEFAULT_CONFIG
    from ledgerguard.sources.json_ingest import parse_transactions
    from ledgerguard.sources.lakes import read_parquet_or_empty
    from ledgerguard.streaming.sources import file_source
    from ledgerguard.streaming.stateful import MemberSink, flagged_windows, stateful_session_travel
    msg = lambda i, ts: json.dumps({"transaction_id": i, "user_id": "u", "timestamp": ts, "amount": 1.0,
                                    "currency": "USD", "merchant_category": "Food", "country": "USA"})
    spark.createDataFrame([(msg("a", "2024-01-01 00:00:00"),), (msg("b", "2024-01-01 00:01:00"),)],
                          "value string").coalesce(1).write.text(f"{workdir}/in")
    stream = parse_transactions(file_source(spark, f"{workdir}/in", "text"))
    sink = MemberSink(f"{workdir}/tumble", lambda: parse_transactions(spark.read.text(f"{workdir}/in")))
    q = (flagged_windows(stream, DEFAULT_CONFIG).writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", f"{workdir}/c1").trigger(availableNow=True).start())
    q.awaitTermination()
    assert sink.read(spark).count() == 0
    sess = stateful_session_travel(stream, DEFAULT_CONFIG)
    q = (sess.writeStream.outputMode("append").format("parquet").option("path", f"{workdir}/sess")
         .option("checkpointLocation", f"{workdir}/c2").trigger(availableNow=True).start())
    q.awaitTermination()
    assert read_parquet_or_empty(spark, f"{workdir}/sess", sess.schema).count() == 0


def _replay_rows(spark, folder):
    """Messages of a replay with the file, and so the micro-batch, that holds them."""
    fields = "transaction_id string, user_id string, timestamp string, country string"
    text = spark.read.text(folder).withColumn("file", F.input_file_name())
    return (text.select(F.from_json("value", fields).alias("m"), "file")
            .select("m.*", F.col("m.timestamp").cast("timestamp_ntz").alias("t"), "file"))


def test_replays_split_windows_and_copies_over_batches(spark):
    folder, days = sq._message_replay(spark, SF_SMALL, copies=2, straddle=True)
    rows = _replay_rows(spark, folder).cache()
    split = rows.groupBy("transaction_id").agg(F.countDistinct("file").alias("n"))
    assert split.where("n = 2").count() == split.count()  # a dedup without state keeps every copy
    folder, _ = sq._message_replay(spark, SF_SMALL, straddle=True)
    groups = (_replay_rows(spark, folder).groupBy("user_id", F.window("t", "10 minutes"))
              .agg(F.countDistinct("country").alias("c"), F.countDistinct("file").alias("n")).where("c > 1"))
    assert groups.where("n > 1").count() > 0  # a rule without state misses these
    assert days == 8


def test_stateful_stream_goes_on_from_its_checkpoint(spark, workdir):
    """Stopped between the two halves of a window, the state brings them together; it holds no ids."""
    from ledgerguard.sources.json_ingest import parse_transactions
    from ledgerguard.streaming.stateful import MemberSink, flagged_windows
    sink = MemberSink(f"{workdir}/out", lambda: parse_transactions(spark.read.text(f"{workdir}/in")), CFG)
    batches = [[("t0", "u", "2024-01-01 00:00:00", "USA"), ("x0", "v", "2024-01-01 00:00:00", "USA")],
               [("t1", "u", "2024-01-01 00:01:00", "Japan"), ("x1", "v", "2024-01-01 00:01:00", "USA")],
               [("t2", "u", "2024-01-01 00:02:00", None)]]
    for i, rows in enumerate(batches):
        q = (flagged_windows(_in_batches(spark, f"{workdir}/in", [rows]), CFG).writeStream.outputMode("update").foreachBatch(sink)
             .option("checkpointLocation", f"{workdir}/ckpt").trigger(availableNow=True).start())
        q.awaitTermination()
        assert q.exception() is None
        got = [(r.user_id, r.transaction_id, r.country) for r in sink.read(spark).collect()]
        ids = ", ".join(f"t{n}" for n in range(i + 1))
        assert got == ([("u", ids, "Japan, USA")] if i else [])
    state = spark.read.format("statestore").load(f"{workdir}/ckpt")
    held = {r["key"]["user_id"]: tuple(r["value"]) for r in state.select("key", "value").collect()}
    assert held == {"u": ("Japan", "USA"), "v": ("USA", "USA")}


def test_members_are_fetched_for_flagged_windows_alone(spark, workdir):
    """The landing table is read between the flagged windows: a filter that reaches its scan."""
    from ledgerguard.sources.json_ingest import screened_form
    from ledgerguard.schema import TRANSACTION_SCHEMA
    from ledgerguard.streaming.stateful import MemberSink
    import datetime
    rows = [(str(i), "u", f"2024-01-0{1 + i % 5} 00:0{i % 7}:00", 1.0, "USD", "Food", "USA") for i in range(50)]
    landed = screened_form(spark.createDataFrame(rows, TRANSACTION_SCHEMA)).withColumn("date", F.col("event_time").cast("date"))
    landed.write.partitionBy("date").parquet(f"{workdir}/landed")
    sink = MemberSink(f"{workdir}/out", lambda: spark.read.parquet(f"{workdir}/landed"), CFG)
    part = sink.between(datetime.datetime(2024, 1, 2), datetime.datetime(2024, 1, 2, 0, 10))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert part.count() == 10 and "PartitionFilters: [isnotnull(date" in plan and "GreaterThanOrEqual(event_time" in plan
