"""Job entry points: the streaming screen and the scheduled report job.

Both take paths and a ``ScreeningConfig``; scheduling (cron, retries) is left
to whatever runs them.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerguard.config import DEFAULT_CONFIG, ScreeningConfig
from ledgerguard.plans import reports
from ledgerguard.session import path_exists
from ledgerguard.sinks.alerts import MESSAGE
from ledgerguard.sinks.commits import (FILE_BYTES, NO_DATE, WHOLE, commit_day, commit_root, compact_days, compact_table,
                                       day_markers, fold_markers, new_attempt, read_days, vacuum, visible_days)
from ledgerguard.sinks.lakes import write_report, write_report_text
from ledgerguard.sources.json_ingest import parse_transactions
from ledgerguard.sources.lakes import (FRAUD_LAKE_SCHEMA, VALID_LAKE_SCHEMA, read_fraud_lake, read_lake,
                                       read_valid_lake)
from ledgerguard.streaming.router import (LATE_SCHEMA, METRICS_SCHEMA, QUARANTINE_SCHEMA, BatchRouter,
                                          start_screening)
from ledgerguard.streaming.sources import kafka_source


def run_screening(spark: SparkSession, lake_root: str, checkpoint: str,
                  cfg: ScreeningConfig = DEFAULT_CONFIG, source: DataFrame | None = None,
                  alert_format: str | None = "kafka", available_now: bool = False) -> StreamingQuery:
    """Start the screening stream: raw messages -> parse -> rules -> sinks.

    ``source`` defaults to the broker topic ``cfg.raw_topic`` (options from
    ``cfg.kafka_options``); any streaming DataFrame with a ``value`` column
    works (e.g. ``streaming.sources.file_source``).
    """
    raw = source if source is not None else kafka_source(spark, cfg)
    router = BatchRouter(valid_path=f"{lake_root}/transactions", fraud_path=f"{lake_root}/fraud",
                         cfg=cfg, alert_format=alert_format,
                         alert_path=f"{lake_root}/alerts" if alert_format != "kafka" else None,
                         metrics_path=f"{lake_root}/metrics", quarantine_path=f"{lake_root}/quarantine",
                         late_path=f"{lake_root}/late")
    return start_screening(parse_transactions(raw), router, checkpoint, available_now)


def screen_table(spark: SparkSession, rows: DataFrame, lake_root: str,
                 cfg: ScreeningConfig = DEFAULT_CONFIG, batch_id: int = 0,
                 alert_format: str | None = None, run_id: str | None = None) -> str:
    """Backfill: screen a table (raw messages in ``value`` or screened rows) in
    batch into the same lakes as the stream, as batch ``batch_id`` of ``run_id``.

    Returns the run id, a new one by default: the rows are then added to what
    the lakes hold. Running again with the same run and batch id replaces all
    rows of that batch, and only those.
    """
    run_id = run_id or f"run-{uuid.uuid4().hex}"
    if "value" in rows.columns and "transaction_id" not in rows.columns:
        rows = parse_transactions(rows)
    BatchRouter(valid_path=f"{lake_root}/transactions", fraud_path=f"{lake_root}/fraud", cfg=cfg,
                alert_format=alert_format,
                alert_path=f"{lake_root}/alerts" if alert_format not in (None, "kafka") else None,
                metrics_path=f"{lake_root}/metrics", quarantine_path=f"{lake_root}/quarantine",
                run_id=run_id, cache=False)(rows, batch_id)
    return run_id


#: Tables of a lake folder beside the lakes: schema and format.
SIDE_TABLES = {"alerts": (MESSAGE, "json"), "quarantine": (QUARANTINE_SCHEMA, "parquet"), "late": (LATE_SCHEMA, "parquet"),
               "metrics": (METRICS_SCHEMA, "parquet")}


def compact_lakes(spark: SparkSession, lake_root: str, days: list[str], file_bytes: int = FILE_BYTES,
                  keep_s: float = 24 * 3600.0) -> dict[str, dict[str, int]]:
    """Compact closed days of both lakes, and the tables beside them.

    Then what compaction replaced ``keep_s`` seconds ago or more is deleted, and
    so are the markers of batches that have no rows of their own any more.
    Returns, by lake, the files of each rewritten day.
    """
    out = {}
    for name in ("transactions", "fraud"):
        out[name] = compact_days(spark, f"{lake_root}/{name}", days, file_bytes)
        for day in days:
            vacuum(spark, f"{lake_root}/{name}", day, keep_s)
    for name, (schema, fmt) in SIDE_TABLES.items():
        compact_table(spark, f"{lake_root}/{name}", schema, fmt, file_bytes)
        vacuum(spark, f"{lake_root}/{name}", WHOLE, keep_s)
    fold_markers(spark, f"{lake_root}/commits", [f"{lake_root}/{t}" for t in (*out, *SIDE_TABLES)])
    return out


def stop_gracefully(query: StreamingQuery, poll_seconds: float = 0.5, timeout: float | None = None) -> None:
    """Stop after the running micro-batch finishes (no half-routed batch).

    With ``timeout`` seconds passed it raises and leaves the query running.
    """
    deadline = None if timeout is None else time.monotonic() + timeout
    while query.isActive and query.status.get("isTriggerActive"):
        if deadline is not None and time.monotonic() >= deadline:
            raise TimeoutError(f"the micro-batch still runs after {timeout} s")
        time.sleep(poll_seconds)
    query.stop()


@dataclass
class ReportSet:
    reconciliation: DataFrame
    fraud_summary: DataFrame
    fraud_by_category: DataFrame
    fraud_by_type: DataFrame
    daily: DataFrame
    lines: DataFrame
    unsummed: DataFrame


def build_reports(spark: SparkSession, lake_root: str, day: str | None = None,
                  cube: DataFrame | None = None) -> ReportSet:
    """All report tables over the lakes; ``day`` ('yyyy-MM-dd') prunes to one partition.

    ``cube`` (a ``report_cube``) stands for the lakes where it is given.
    """
    rows = cube
    if rows is None:
        rows = reports.lake_measures(read_valid_lake(spark, f"{lake_root}/transactions", day),
                                     read_fraud_lake(spark, f"{lake_root}/fraud", day))
    return ReportSet(reports.reconciliation_of(rows), reports.summary_of(rows),
                     reports.breakdown_of(rows, "merchant_category", with_avg=True),
                     reports.breakdown_of(rows, "fraud_type", with_avg=False),
                     reports.daily_of(rows), reports.lines_of(rows), reports.unsummed_of(rows))


def refresh_cube(spark: SparkSession, lake_root: str) -> list[str]:
    """Bring the stored report cube (``lake_root/cube``, by date) up to date; the days that were summed anew.

    A day's marker names the attempts that its cube was made of. Only days whose
    visible attempts have changed since are read, from their own folders; days
    that have left the lakes get an empty cube.
    """
    paths = {"transactions": VALID_LAKE_SCHEMA, "fraud": FRAUD_LAKE_SCHEMA}
    now = {name: visible_days(spark, f"{lake_root}/{name}") for name in paths}
    cube, known = f"{lake_root}/cube", day_markers(spark, f"{lake_root}/cube")

    def source(day: str) -> str:
        return hashlib.sha256(json.dumps([now[name].get(day, []) for name in paths]).encode()).hexdigest()
    days = sorted({*now["transactions"], *now["fraud"], *known})
    changed = [d for d in days if known.get(d, {}).get("source") != source(d)]
    if changed:
        sides = [read_days(spark, f"{lake_root}/{name}", {d: now[name].get(d, []) for d in changed}, schema)
                 for name, schema in paths.items()]
        attempt = new_attempt()
        day = F.coalesce(F.col("date").cast("string"), F.lit(NO_DATE))
        (reports.report_cube(*sides).withColumn("attempt", F.concat(F.lit(f"{attempt}-"), day))
         .repartition("date").write.mode("append").partitionBy("date", "attempt").parquet(cube))
        for d in changed:
            commit_day(spark, cube, d, f"{attempt}-{d}", source=source(d))
    return changed


def read_cube(spark: SparkSession, lake_root: str) -> DataFrame:
    """The stored report cube; a few rows for each day."""
    return read_lake(spark, f"{lake_root}/cube", reports.CUBE_SCHEMA).select(*reports.CUBE_SCHEMA.names)


#: Sections of the report lines in the text file of each kind.
TEXT_REPORTS = {"reconciliation": ("reconciliation",), "analytics": ("summary", "by_category", "by_type")}


def run_reports(spark: SparkSession, lake_root: str, out_root: str, day: str | None = None,
                stamp: str | None = None) -> str:
    """Write every report table (Parquet) and the report lines (text) under ``out_root/<stamp>``.

    All tables follow from a small cube. It is stored by date, and a report of all
    history reads only those days of the lakes that have changed since the last
    one; a report of one ``day`` sums that day. The lines go to ``lines`` and, by
    kind, to ``reconciliation_<stamp>`` and ``analytics_<stamp>``. With no lake
    data the tables say ``NO_DATA``.
    """
    stamp = stamp or time.strftime("%Y%m%d_%H%M%S")
    out = f"{out_root}/{stamp}"
    if day is None and path_exists(spark, commit_root(f"{lake_root}/transactions")):
        refresh_cube(spark, lake_root)
        cube = read_cube(spark, lake_root)
    else:
        cube = reports.report_cube(read_valid_lake(spark, f"{lake_root}/transactions", day),
                                   read_fraud_lake(spark, f"{lake_root}/fraud", day))
    cube.write.mode("overwrite").parquet(f"{out}/cube")
    cube = spark.read.schema(cube.schema).parquet(f"{out}/cube")
    rs = build_reports(spark, lake_root, day, cube)
    for name in ("reconciliation", "fraud_summary", "fraud_by_category", "fraud_by_type", "daily", "unsummed"):
        write_report(getattr(rs, name), f"{out}/{name}")
    write_report_text(rs.lines, f"{out}/lines")
    for kind, sections in TEXT_REPORTS.items():
        write_report_text(rs.lines.where(F.col("section").isin(*sections)), f"{out}/{kind}_{stamp}")
    return out
