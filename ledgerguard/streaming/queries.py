"""Registered streaming queries.

Each one replays the whole ``events`` table (as transaction messages or
screened rows) through a file stream in time order, runs a streaming
operator with ``availableNow``, and reads the sink back as a batch
DataFrame. Work folders are fresh sub-folders of ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerguard.config import FIXTURE_CONFIG as CFG, FRAUD_TYPE_HIGH_VALUE, FRAUD_TYPE_TRAVEL
from ledgerguard.plans import queries as batch_q
from ledgerguard.plans import reports
from ledgerguard.jobs import (TEXT_REPORTS, compact_lakes, read_cube, refresh_cube, run_reports, screen_table,
                              stop_gracefully)
from ledgerguard.schema import ALERT_COLUMNS, EVENT_TIME, TRANSACTION_COLUMNS
from ledgerguard.session import fresh_path
from ledgerguard.sources.fixtures import fixture_transactions
from ledgerguard.sources.json_ingest import parse_transactions
from ledgerguard.sources.lakes import read_committed, read_fraud_lake, read_parquet_or_empty, read_valid_lake
from ledgerguard.streaming.replay import write_replay
from ledgerguard.streaming.router import (LATE_SCHEMA, METRICS_SCHEMA, QUARANTINE_SCHEMA, BatchRouter,
                                          start_screening)
from ledgerguard.streaming.sources import file_source
from ledgerguard.streaming.live import live_travel, rocksdb
from ledgerguard.streaming.stateful import (MemberSink, dedup_transactions, flagged_windows,
                                            stateful_session_travel, stateful_trailing_travel)

#: Files of a replay, at least, and rows of one file, at most (a single day is never split).
REPLAY_FILES, REPLAY_ROWS = 4, 2_000_000


def _run(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def replay_chunks(tx: DataFrame) -> tuple[int, int]:
    """(files, days a file): ``REPLAY_FILES``, more where a file would pass ``REPLAY_ROWS`` rows, whole days each."""
    r = tx.agg(F.count(F.lit(1)).alias("n"), F.min(EVENT_TIME).cast("date").alias("a"),
               F.max(EVENT_TIME).cast("date").alias("b")).first()
    days = (r["b"] - r["a"]).days + 1 if r["a"] else 1
    files = min(days, max(REPLAY_FILES, -(-r["n"] // REPLAY_ROWS)))
    return files, -(-days // files)


def _message_replay(spark: SparkSession, sf_dir: str, copies: int = 1, flush: bool = False,
                    straddle: bool | Column = False) -> tuple[str, int]:
    """(folder of transaction messages as JSON lines in time-ordered files, days a file spans).

    Each file holds whole days. With ``straddle`` every second row (by hash) waits
    for the next file, so that windows, sessions and travel pairs are split over
    micro-batches; ``copies`` of a message then alternate between the two files.
    A column in its place says which rows wait.
    No row is later than the days a file spans. ``flush`` adds one message of a
    user of its own, past the end of all others by more than that: the watermark
    passes every real session, so that append mode emits them all.
    """
    tx = fixture_transactions(spark, sf_dir, CFG)
    files, days = replay_chunks(tx)
    day = F.datediff(F.col(EVENT_TIME), tx.agg(F.min(EVENT_TIME).cast("date")).scalar())
    tx = tx.withColumn("_replay_file", F.coalesce(F.floor(day / days), F.lit(0)).cast("int"))
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    tx = tx.withColumn("_copy", copy)
    waits, straddle = straddle, straddle is not False
    if straddle:
        late = (F.pmod(F.xxhash64("transaction_id") + F.col("_copy"), F.lit(2)) if waits is True else waits).cast("int")
        tx = tx.withColumn("_replay_file", F.col("_replay_file") + late)
    if flush:
        last = (tx.agg((F.max(EVENT_TIME) + F.make_dt_interval(F.lit(2 * days + 1))).alias(EVENT_TIME))
                .withColumn("timestamp", F.substring(F.col(EVENT_TIME).cast("string"), 1, 19))
                .withColumns({"transaction_id": F.lit("flush"), "user_id": F.lit("flush"), "country": F.lit("flush"),
                              "_replay_file": F.lit(files + int(straddle))}))
        tx = tx.unionByName(last, allowMissingColumns=True)
    msgs = tx.select(F.to_json(F.struct(*TRANSACTION_COLUMNS)).alias("value"), "_replay_file")
    n = files + int(straddle) + int(flush)
    return write_replay(msgs, fresh_path(spark, "replay"), n, fmt="text", file_col="_replay_file"), days


def screen_replay(spark: SparkSession, sf_dir: str) -> str:
    """Run the routing stream over the replayed table; returns its work folder."""
    base = fresh_path(spark, "screen")
    stream = parse_transactions(file_source(spark, _message_replay(spark, sf_dir)[0], "text"))
    router = BatchRouter(valid_path=f"{base}/valid", fraud_path=f"{base}/fraud", cfg=CFG,
                         alert_format="json", alert_path=f"{base}/alerts",
                         metrics_path=f"{base}/metrics")
    _run(start_screening(stream, router, f"{base}/checkpoint", available_now=True))
    return base


def q_stream_high_value(spark, sf_dir):
    fraud = read_fraud_lake(spark, f"{screen_replay(spark, sf_dir)}/fraud")
    return fraud.where(F.col("fraud_type") == FRAUD_TYPE_HIGH_VALUE).select(*ALERT_COLUMNS)


def q_stream_travel_tumbling(spark, sf_dir):
    fraud = read_fraud_lake(spark, f"{screen_replay(spark, sf_dir)}/fraud")
    return fraud.where(F.col("fraud_type") == FRAUD_TYPE_TRAVEL).select(*ALERT_COLUMNS)


def q_stream_valid(spark, sf_dir):
    valid = read_valid_lake(spark, f"{screen_replay(spark, sf_dir)}/valid")
    return valid.select(*TRANSACTION_COLUMNS, "date")


def q_stream_metrics(spark, sf_dir):
    m = read_committed(spark, f"{screen_replay(spark, sf_dir)}/metrics", METRICS_SCHEMA)
    return m.agg(*[F.sum(c).cast("long").alias(c) for c in
                   ("raw", "valid", "high_value", "unrouted", "malformed", "alerts", "travel_alerts")])


def _straddling_stream(spark, sf_dir, copies: int = 1, flush: bool = False):
    """(stream whose windows and copies are split over micro-batches, configuration that waits for them)."""
    folder, days = _message_replay(spark, sf_dir, copies, flush, straddle=True)
    return parse_transactions(file_source(spark, folder, "text")), CFG.with_(watermark_delay=f"{days} days")


def q_stream_travel_stateful(spark, sf_dir):
    """Tumbling travel with state: flagged windows first, their members from the replayed files."""
    base = fresh_path(spark, "travel-stateful")
    folder, days = _message_replay(spark, sf_dir, straddle=True)
    cfg = CFG.with_(watermark_delay=f"{days} days")
    sink = MemberSink(f"{base}/out", lambda: parse_transactions(spark.read.text(folder)), cfg)
    keys = flagged_windows(parse_transactions(file_source(spark, folder, "text")), cfg)
    _run(keys.writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    return sink.read(spark).select(*ALERT_COLUMNS)


def _appended(rows: DataFrame, base: str) -> DataFrame:
    """Run an append-mode query into Parquet files to its end and read them back."""
    _run(rows.writeStream.outputMode("append").format("parquet").option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    return read_parquet_or_empty(rows.sparkSession, f"{base}/out", rows.schema)


def q_stream_travel_session(spark, sf_dir):
    stream, cfg = _straddling_stream(spark, sf_dir, flush=True)
    return _appended(stateful_session_travel(stream, cfg), fresh_path(spark, "travel-session"))


def q_stream_dedup(spark, sf_dir):
    stream, cfg = _straddling_stream(spark, sf_dir, copies=2)
    return _appended(dedup_transactions(stream, cfg).select(*TRANSACTION_COLUMNS), fresh_path(spark, "dedup"))


def q_stream_travel_trailing(spark, sf_dir):
    """Left-semi join of the stream with its own slices; a flush message closes the last ones."""
    stream, cfg = _straddling_stream(spark, sf_dir, flush=True)
    return _appended(stateful_trailing_travel(stream, cfg), fresh_path(spark, "travel-trailing"))


def q_stream_travel_live(spark, sf_dir):
    """The same rows from keyed state and timers, without a flush: nothing waits for the watermark."""
    stream, cfg = _straddling_stream(spark, sf_dir)
    with rocksdb(spark):
        return _appended(live_travel(stream, cfg), fresh_path(spark, "travel-live"))


def q_stream_quarantine(spark, sf_dir):
    """Messages, some with text amounts, through the screening stream; the quarantine read back."""
    base = fresh_path(spark, "quarantine")
    messages = batch_q._wire_with_text_amounts(spark, sf_dir)
    messages.repartition(replay_chunks(fixture_transactions(spark, sf_dir, CFG))[0]).write.text(f"{base}/messages")
    router = BatchRouter(valid_path=f"{base}/valid", fraud_path=f"{base}/fraud", cfg=CFG,
                         quarantine_path=f"{base}/bad")
    stream = parse_transactions(file_source(spark, f"{base}/messages", "text"))
    _run(start_screening(stream, router, f"{base}/checkpoint", available_now=True))
    bad = read_committed(spark, f"{base}/bad", QUARANTINE_SCHEMA)
    return bad.select("transaction_id", "user_id", "country", "reason")


def q_lake_many_writers(spark, sf_dir):
    """Three writers into one lake, and one corrected batch: nothing is lost and nothing is left over.

    Two backfills with the same batch id each add half of the table; a third
    first adds all rows with a wrong amount, all of them fraud, and then replaces
    that batch by the rows of valid amount alone.
    """
    root = fresh_path(spark, "writers")
    tx = fixture_transactions(spark, sf_dir, CFG)
    even = F.pmod(F.xxhash64("transaction_id"), F.lit(2)) == 0
    screen_table(spark, tx.where(even), root, CFG)
    screen_table(spark, tx.where(~even), root, CFG)
    run = screen_table(spark, tx.withColumn("amount", F.lit(1e6)), root, CFG)
    screen_table(spark, tx.where(F.col("amount") <= float(CFG.high_value_threshold)), root, CFG, run_id=run)
    valid = read_valid_lake(spark, f"{root}/transactions")
    fraud = read_fraud_lake(spark, f"{root}/fraud").where(F.col("fraud_type") == FRAUD_TYPE_HIGH_VALUE)
    rows = valid.select("transaction_id", F.lit("valid").alias("lake")).union(
        fraud.select("transaction_id", F.lit("fraud").alias("lake")))
    return rows.groupBy("transaction_id", "lake").agg(F.count("*").alias("copies"))


def q_stream_late_rows(spark, sf_dir):
    """Every fifth transaction waits for the next file: those that the watermark has passed by then, as the stream kept them."""
    base = fresh_path(spark, "late")
    folder, _ = _message_replay(spark, sf_dir, straddle=F.col("transaction_id").cast("long") % 5 == 0)
    router = BatchRouter(valid_path=f"{base}/valid", fraud_path=f"{base}/fraud", cfg=CFG, late_path=f"{base}/late")
    _run(start_screening(parse_transactions(file_source(spark, folder, "text")), router, f"{base}/checkpoint", available_now=True))
    return read_committed(spark, f"{base}/late", LATE_SCHEMA).select("transaction_id", "timestamp", "watermark_ms", "batch_id")


def q_lake_compaction(spark, sf_dir):
    """Daily counts of lakes that were compacted, written to again, and compacted again in part."""
    root = fresh_path(spark, "compaction")
    tx = fixture_transactions(spark, sf_dir, CFG)
    third = F.pmod(F.xxhash64("user_id"), F.lit(3))  # a user's rows are screened together
    days = [str(r["d"]) for r in tx.select(F.col(EVENT_TIME).cast("date").alias("d")).distinct().orderBy("d").collect()]
    for i in (0, 1):
        screen_table(spark, tx.where(third == i), root, CFG, batch_id=i, run_id="day")
    compact_lakes(spark, root, days)
    screen_table(spark, tx.where(third == 2), root, CFG)
    compact_lakes(spark, root, days[::2], keep_s=0.0)
    return reports.daily_lake_counts(read_valid_lake(spark, f"{root}/transactions"), read_fraud_lake(spark, f"{root}/fraud"))


def q_report_incremental(spark, sf_dir):
    """Daily counts from a stored cube, brought up to date after each third of the rows; only changed days are read."""
    root = fresh_path(spark, "incremental")
    tx = fixture_transactions(spark, sf_dir, CFG)
    part = F.pmod(F.dayofmonth(EVENT_TIME), F.lit(3))
    for i in range(3):
        screen_table(spark, tx.where(part == i), root, CFG)
        refresh_cube(spark, root)
    return reports.daily_of(read_cube(spark, root))


def q_report_files(spark, sf_dir):
    """The text report files of the whole table's lakes, read back line by line."""
    root = fresh_path(spark, "report-files")
    screen_table(spark, fixture_transactions(spark, sf_dir, CFG), root, CFG)
    out = run_reports(spark, root, f"{root}/reports", stamp="now")
    files = [spark.read.text(f"{out}/{kind}_now").withColumn("file", F.lit(kind)) for kind in TEXT_REPORTS]
    return files[0].union(files[1]).select("file", F.col("value").alias("line"))


def q_stream_dedup_lake(spark, sf_dir):
    """Every message twice, the copy days later and past the watermark: the lakes' own ids drop it."""
    base = fresh_path(spark, "dedup-lake")
    folder, _ = _message_replay(spark, sf_dir, copies=2, straddle=True)
    router = BatchRouter(valid_path=f"{base}/valid", fraud_path=f"{base}/fraud", cfg=CFG, drop_copies=True)
    _run(start_screening(parse_transactions(file_source(spark, folder, "text")), router, f"{base}/checkpoint", available_now=True))
    fraud = read_fraud_lake(spark, f"{base}/fraud").where(F.col("fraud_type") == FRAUD_TYPE_HIGH_VALUE)
    rows = read_valid_lake(spark, f"{base}/valid").select("transaction_id", F.lit("valid").alias("lake")).union(
        fraud.select("transaction_id", F.lit("fraud").alias("lake")))
    return rows.groupBy("transaction_id", "lake").agg(F.count("*").alias("copies"))


def q_stream_restart(spark, sf_dir):
    """A stream on its timed trigger, stopped after a batch or more, and gone on with from its checkpoint."""
    base = fresh_path(spark, "restart")
    folder, _ = _message_replay(spark, sf_dir)
    cfg = CFG.with_(trigger_interval="1 second")

    def start(available_now):
        router = BatchRouter(valid_path=f"{base}/valid", fraud_path=f"{base}/fraud", cfg=cfg)
        return start_screening(parse_transactions(file_source(spark, folder, "text")), router, f"{base}/checkpoint", available_now)
    q = start(False)
    while q.isActive and not q.recentProgress:
        time.sleep(0.1)
    stop_gracefully(q)
    if q.exception() is not None:
        raise q.exception()
    _run(start(True))
    return read_valid_lake(spark, f"{base}/valid").select(*TRANSACTION_COLUMNS, "date")


STREAM_QUERIES = {
    "stream_quarantine": q_stream_quarantine,
    "lake_many_writers": q_lake_many_writers,
    "stream_high_value": q_stream_high_value,
    "stream_travel_tumbling": q_stream_travel_tumbling,
    "stream_valid": q_stream_valid,
    "stream_metrics": q_stream_metrics,
    "stream_travel_stateful": q_stream_travel_stateful,
    "stream_travel_session": q_stream_travel_session,
    "stream_dedup": q_stream_dedup,
    "stream_travel_trailing": q_stream_travel_trailing,
    "stream_travel_live": q_stream_travel_live,
    "stream_late_rows": q_stream_late_rows,
    "lake_compaction": q_lake_compaction,
    "report_incremental": q_report_incremental,
    "report_files": q_report_files,
    "stream_dedup_lake": q_stream_dedup_lake,
    "stream_restart": q_stream_restart,
}

_O = batch_q.ORACLE
STREAM_ORACLE = {
    "lake_many_writers": f"""WITH {batch_q.TX}
SELECT transaction_id, CASE WHEN amount <= 150 THEN 'valid' ELSE 'fraud' END AS lake,
       CAST(CASE WHEN amount <= 150 THEN 2 ELSE 1 END AS BIGINT) AS copies
FROM tx""",
    "stream_high_value": _O["high_value_alerts"],
    "stream_travel_tumbling": _O["impossible_travel_tumbling"],
    "stream_valid": _O["valid_transactions"],
    "stream_metrics": f"""WITH {batch_q.TX}, {batch_q.TRAVEL}
SELECT CAST(count(*) AS BIGINT) AS raw,
       CAST(count(*) FILTER (WHERE amount <= {CFG.threshold_text}) AS BIGINT) AS valid,
       CAST(count(*) FILTER (WHERE amount > {CFG.threshold_text}) AS BIGINT) AS high_value,
       CAST(count(*) FILTER (WHERE amount IS NULL) AS BIGINT) AS unrouted,
       CAST(count(*) FILTER (WHERE transaction_id IS NULL OR amount IS NULL) AS BIGINT) AS malformed,
       CAST(count(*) FILTER (WHERE amount > {CFG.threshold_text}) + (SELECT count(*) FROM travel) AS BIGINT)
         AS alerts,
       CAST((SELECT count(*) FROM travel) AS BIGINT) AS travel_alerts
FROM tx""",
    "stream_travel_stateful": _O["impossible_travel_tumbling"],
    "stream_travel_session": _O["impossible_travel_session"],
    "stream_quarantine": _O["malformed_quarantine"],
    "stream_dedup": f"WITH {batch_q.TX} SELECT {batch_q._TX_COLS} FROM tx",
    "stream_travel_trailing": _O["impossible_travel_trailing"],
    "stream_travel_live": _O["impossible_travel_trailing"],
    "lake_compaction": _O["daily_lake_counts"],
    "report_incremental": _O["daily_lake_counts"],
    "report_files": f"""SELECT CASE WHEN section = 'reconciliation' THEN 'reconciliation' ELSE 'analytics' END AS file, line
FROM ({_O["report_lines"]})""",
    "stream_dedup_lake": f"""WITH {batch_q.TX}
SELECT transaction_id, CASE WHEN amount <= 150 THEN 'valid' ELSE 'fraud' END AS lake, CAST(1 AS BIGINT) AS copies
FROM tx""",
    "stream_restart": _O["valid_transactions"],
    # a file is a batch; a batch begins with the greatest event time before it, in
    # milliseconds, less the delay of two minutes
    "stream_late_rows": f"""WITH {batch_q.TX}, span AS (
  SELECT min(CAST(event_time AS DATE)) AS a, max(CAST(event_time AS DATE)) - min(CAST(event_time AS DATE)) + 1 AS days,
         count(*) AS n FROM tx
), files AS (
  SELECT a, CAST(ceil(days / least(days, greatest(4, ceil(n / 2000000.0)))) AS BIGINT) AS size FROM span
), placed AS (
  SELECT transaction_id, "timestamp", event_time,
         (CAST(event_time AS DATE) - a) // size + CASE WHEN CAST(transaction_id AS BIGINT) % 5 = 0 THEN 1 ELSE 0 END AS batch_id
  FROM tx, files
), batches AS (
  SELECT batch_id, max(epoch_us(event_time) // 1000) AS last FROM placed GROUP BY batch_id
), marks AS (
  SELECT batch_id, coalesce(max(last) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 120000, 0)
         AS watermark_ms FROM batches
)
SELECT transaction_id, "timestamp", CAST(watermark_ms AS BIGINT) AS watermark_ms, CAST(batch_id AS BIGINT) AS batch_id
FROM placed JOIN marks USING (batch_id) WHERE epoch_us(event_time) < watermark_ms * 1000""",
}
