from datetime import datetime

from pyspark.sql import functions as F

from ledgerguard.schema import TRANSACTION_SCHEMA
from ledgerguard.sources.json_ingest import screened_form

COLS = [f.name for f in TRANSACTION_SCHEMA.fields]


def tx_rows(spark, rows):
    """rows: (id, user, 'yyyy-MM-dd HH:mm:ss[.ffffff]', amount, category, country)."""
    data = [(i, u, ts, amt, "USD", cat, c) for (i, u, ts, amt, cat, c) in rows]
    return screened_form(spark.createDataFrame(data, TRANSACTION_SCHEMA))


def messages(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def ts(text):
    return datetime.fromisoformat(text)


def collect_sorted(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


__all__ = ["tx_rows", "messages", "ts", "collect_sorted", "F", "COLS"]
