"""Configuration helpers and reason templates (no Spark job needed beyond a literal)."""

from pyspark.sql import functions as F

from ledgerguard.config import DEFAULT_CONFIG, FIXTURE_CONFIG, duration_seconds
from ledgerguard.functions.expressions import fill_template


def test_durations_and_threshold_text():
    assert duration_seconds("10 minutes") == 600
    assert duration_seconds("2 minutes 30 seconds") == 150
    assert DEFAULT_CONFIG.threshold_text == "5000"
    assert FIXTURE_CONFIG.threshold_text == "150"
    assert DEFAULT_CONFIG.with_(high_value_threshold=99.5).threshold_text == "99.5"
    assert DEFAULT_CONFIG.foreign_countries[0] == "USA"
    assert DEFAULT_CONFIG.home_country not in DEFAULT_CONFIG.foreign_countries


def test_fill_template_null_propagates(spark):
    df = spark.createDataFrame([("x", "y"), ("x", None)], "a string, b string")
    out = [r.t for r in df.select(fill_template("[{a}-{b}]!", a=F.col("a"), b=F.col("b")).alias("t"))
           .collect()]
    assert out == ["[x-y]!", None]
