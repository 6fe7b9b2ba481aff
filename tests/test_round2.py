"""Exact money, report rounding, running frames, dedup of bad rows, safe folders."""

import time

import pytest
from pyspark.sql import functions as F

from ledgerguard.config import DEFAULT_CONFIG
from ledgerguard.functions.formatting import fmt_pct, fmt_pct1
from ledgerguard.operators import travel
from ledgerguard.plans import reports
from ledgerguard.session import shared_dir
from ledgerguard.sources.json_ingest import parse_transactions, screened_form
from ledgerguard.streaming.sources import file_source
from ledgerguard.streaming.stateful import dedup_transactions
from tests.helpers import messages


def test_large_balanced_volumes_balance(spark):
    rows = spark.range(3000).select(F.col("id").cast("string").alias("transaction_id"),
                                    (F.rand(5) * 1e12 + F.lit(0.37)).alias("amount"),
                                    F.lit("Food").alias("merchant_category"), F.lit("HIGH_VALUE").alias("fraud_type"))
    for parts in (1, 7):
        valid, fraud = rows.where("id % 2 = 0").repartition(parts), rows.where("id % 2 = 1").repartition(parts)
        rec = reports.reconciliation_reference(valid, fraud).first()
        assert (rec.status, rec["diff"]) == ("BALANCED", 0.0)


def test_ties_round_to_even(spark):
    row = spark.range(1).select(fmt_pct1(F.lit(12.25)).alias("a"), fmt_pct(F.lit(0.125)).alias("b"),
                                fmt_pct1(F.lit(12.35)).alias("c")).first()
    assert (row.a, row.b, row.c) == ("12.2", "0.12", "12.4")


def _one_slice(spark, n):
    rows = spark.range(n).select(F.col("id").cast("string").alias("transaction_id"), F.lit("u").alias("user_id"),
                                 F.concat(F.lit("2024-01-01 00:00:"), F.format_string("%02d", (F.col("id") % 60).cast("int")),
                                          F.lit("."), F.format_string("%06d", F.col("id"))).alias("timestamp"),
                                 F.lit(1.0).alias("amount"), F.lit("USD").alias("currency"), F.lit("Food").alias("merchant_category"),
                                 F.when(F.col("id") % 1000 == 7, "Japan").otherwise("USA").alias("country"))
    return screened_form(rows)


def test_a_busy_slice_takes_linear_time(spark):
    plan = travel.trailing_travel(_one_slice(spark, 10), DEFAULT_CONFIG)._jdf.queryExecution().toString().lower()
    assert "unboundedfollowing" not in plan
    seconds = []
    for n in (20_000, 80_000):
        t = time.perf_counter()
        assert travel.trailing_travel(_one_slice(spark, n), DEFAULT_CONFIG).count() > n * 0.5
        seconds.append(time.perf_counter() - t)
    assert seconds[1] < 8 * max(1.0, seconds[0])  # the square would be 16 times


def test_slices_must_divide_the_window(spark):
    with pytest.raises(ValueError):
        travel.trailing_travel(_one_slice(spark, 1), DEFAULT_CONFIG.with_(travel_slices=7))


def test_dedup_keeps_every_malformed_row(spark, workdir):
    good = '{"transaction_id": "a", "user_id": "u", "timestamp": "2024-01-01 00:00:00", "amount": 1.0}'
    for i, part in enumerate(([good, "bad one"], [good, "bad two", "bad one"])):  # the copy comes in another batch
        messages(spark, part).coalesce(1).write.mode("append").text(f"{workdir}/in")
        time.sleep(0.01)
    rows = dedup_transactions(parse_transactions(file_source(spark, f"{workdir}/in", "text")))
    q = (rows.writeStream.format("parquet").option("path", f"{workdir}/out").option("checkpointLocation", f"{workdir}/c")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(str(r.transaction_id) for r in spark.read.parquet(f"{workdir}/out").collect()) == ["None"] * 3 + ["a"]


def test_a_day_lists_its_folder_alone(spark, workdir):
    from ledgerguard.jobs import screen_table
    from ledgerguard.sources.lakes import read_valid_lake
    rows = [(str(i), "u", f"2024-01-0{1 + i % 3} 00:00:00", 1.0, "USD", "Food", "USA") for i in range(9)]
    from ledgerguard.schema import TRANSACTION_SCHEMA
    screen_table(spark, screened_form(spark.createDataFrame(rows, TRANSACTION_SCHEMA)), workdir)
    day = read_valid_lake(spark, f"{workdir}/transactions", "2024-01-02")
    assert day.count() == 3 and all("date=2024-01-02" in f for f in day.inputFiles())
    assert read_valid_lake(spark, f"{workdir}/transactions", "2030-01-01").count() == 0


def test_unreadable_lake_is_not_empty(spark, workdir):
    from ledgerguard.sources.lakes import read_valid_lake
    spark.createDataFrame([("x",)], "v string").coalesce(1).write.text(f"{workdir}/lake/date=2024-01-01")
    with pytest.raises(Exception, match="(?i)parquet"):
        read_valid_lake(spark, f"{workdir}/lake").count()


def test_no_local_folder_on_a_cluster(spark):
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(RuntimeError):
        shared_dir(Session())
