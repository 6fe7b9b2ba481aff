"""Command line entry points, in process (the session is reused)."""

import json

from ledgerguard.__main__ import main
from ledgerguard.sources.lakes import read_committed
from ledgerguard.streaming.router import METRICS_SCHEMA, QUARANTINE_SCHEMA


def test_screen_once_then_report(spark, workdir, capsys):
    rows = [("a", "u1", "2024-01-01 00:01:00", 7000.0, "USA"), ("b", "u2", "2024-01-01 00:02:00", 10.0, "Japan"),
            ("c", "u2", "2024-01-01 00:03:00", 20.0, "UAE")]
    msgs = [json.dumps({"transaction_id": i, "user_id": u, "timestamp": t, "amount": a, "currency": "USD",
                        "merchant_category": "Food", "country": c}) for i, u, t, a, c in rows]
    spark.createDataFrame([(m,) for m in msgs], "value string").coalesce(1).write.text(f"{workdir}/in")
    main(["screen", "--lake", f"{workdir}/lake", "--checkpoint", f"{workdir}/ckpt",
          "--input", f"{workdir}/in", "--alerts", "json", "--once"])
    main(["report", "--lake", f"{workdir}/lake", "--out", f"{workdir}/rep"])
    out = capsys.readouterr().out.strip().splitlines()[-1]
    rec = spark.read.parquet(f"{out}/reconciliation").first()
    assert (rec.validated_count, rec.fraud_count, rec.status) == (2, 2, "BALANCED")


def test_backfill_matches_stream(spark, workdir, capsys):
    from ledgerguard.jobs import build_reports
    msgs = [json.dumps({"transaction_id": "x", "user_id": "u", "timestamp": "2024-01-01 00:00:00",
                        "amount": 9000.0, "currency": "USD", "merchant_category": "Food", "country": "USA"}),
            "not json"]
    spark.createDataFrame([(m,) for m in msgs], "value string").coalesce(1).write.text(f"{workdir}/in")
    again = ["backfill", "--lake", f"{workdir}/lake", "--input", f"{workdir}/in", "--batch-id", "3", "--run-id", "night"]
    main(again)
    main(again)
    rec = build_reports(spark, f"{workdir}/lake").reconciliation.first()
    assert (rec.validated_count, rec.fraud_count) == (0, 1)
    m = read_committed(spark, f"{workdir}/lake/metrics", METRICS_SCHEMA).first()
    assert (m.batch_id, m.raw, m.malformed) == (3, 2, 1)
    bad = read_committed(spark, f"{workdir}/lake/quarantine", QUARANTINE_SCHEMA).collect()
    assert [(r.value, r.reason is not None) for r in bad] == [("not json", True)]
    main(again[:-2])  # a run of its own adds its rows, whatever its batch id
    assert build_reports(spark, f"{workdir}/lake").reconciliation.first().fraud_count == 2
    main(["compact", "--lake", f"{workdir}/lake", "--day", "2024-01-01"])
    assert build_reports(spark, f"{workdir}/lake").reconciliation.first().fraud_count == 2
    assert read_committed(spark, f"{workdir}/lake/quarantine", QUARANTINE_SCHEMA).count() == 2
