"""Command line: ``python -m ledgerguard {screen,backfill,report,compact} ...``.

``screen`` runs the streaming screen (broker topic or a folder of JSON-line
files) into the lakes until stopped; ``backfill`` screens a folder in batch;
``report`` writes the report tables and lines for all history or one day;
``compact`` rewrites closed days of the lakes into few files.
"""

from __future__ import annotations

import argparse

from ledgerguard.config import DEFAULT_CONFIG
from ledgerguard.jobs import compact_lakes, run_reports, run_screening, screen_table, stop_gracefully
from ledgerguard.session import build_session
from ledgerguard.streaming.sources import file_source


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="ledgerguard")
    sub = ap.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("screen", help="stream transactions into the lakes")
    s.add_argument("--lake", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--bootstrap-servers", help="broker address; omit to read --input files")
    s.add_argument("--input", help="folder of JSON-line files (file source)")
    s.add_argument("--alerts", default="kafka", choices=["kafka", "json", "parquet", "none"])
    s.add_argument("--threshold", type=float, default=DEFAULT_CONFIG.high_value_threshold)
    s.add_argument("--once", action="store_true", help="process what is available, then stop")
    s.add_argument("--max-per-trigger", type=int, default=None,
                   help="bound each micro-batch: broker offsets or files per trigger")
    b = sub.add_parser("backfill", help="screen a folder of JSON-line files in batch")
    b.add_argument("--lake", required=True)
    b.add_argument("--input", required=True)
    b.add_argument("--batch-id", type=int, default=0)
    b.add_argument("--run-id", help="replace this run's batch; default: a new run, rows are added")
    b.add_argument("--threshold", type=float, default=DEFAULT_CONFIG.high_value_threshold)
    r = sub.add_parser("report", help="write report tables and lines")
    r.add_argument("--lake", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--day", help="yyyy-MM-dd; default all history")
    c = sub.add_parser("compact", help="rewrite closed days of the lakes into few files")
    c.add_argument("--lake", required=True)
    c.add_argument("--day", required=True, nargs="+", help="yyyy-MM-dd")
    for p in (s, b, r, c):
        p.add_argument("--master", default=None)
    a = ap.parse_args(argv)

    # master and shuffle width are spark-submit's or the cluster's, unless given here
    spark = build_session(a.master, shuffle_partitions=None)
    if a.cmd == "report":
        print(run_reports(spark, a.lake, a.out, day=a.day))
        return
    if a.cmd == "compact":
        print(compact_lakes(spark, a.lake, a.day))
        return
    if a.cmd == "backfill":
        cfg = DEFAULT_CONFIG.with_(high_value_threshold=a.threshold)
        screen_table(spark, spark.read.text(a.input), a.lake, cfg, batch_id=a.batch_id, run_id=a.run_id)
        return
    cfg = DEFAULT_CONFIG.with_(high_value_threshold=a.threshold)
    if a.bootstrap_servers:
        opts = {"kafka.bootstrap.servers": a.bootstrap_servers}
        if a.max_per_trigger:
            opts["maxOffsetsPerTrigger"] = str(a.max_per_trigger)
        cfg = cfg.with_(kafka_options=opts)
        source = None
    elif a.input:
        source = file_source(spark, a.input, "text", max_files_per_trigger=a.max_per_trigger)
    else:
        ap.error("screen needs --bootstrap-servers or --input")
    alerts = None if a.alerts == "none" else a.alerts
    q = run_screening(spark, a.lake, a.checkpoint, cfg, source=source, alert_format=alerts,
                      available_now=a.once)
    try:
        q.awaitTermination()
    except KeyboardInterrupt:
        stop_gracefully(q)


if __name__ == "__main__":
    main()
