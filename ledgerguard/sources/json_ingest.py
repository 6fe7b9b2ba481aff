"""JSON wire format: encode, decode with a fixed schema, split malformed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerguard.functions.expressions import event_time_from_text
from ledgerguard.schema import CORRUPT_COLUMN, EVENT_TIME, TRANSACTION_COLUMNS, TRANSACTION_SCHEMA

_PARSE_SCHEMA = StructType(TRANSACTION_SCHEMA.fields + [StructField(CORRUPT_COLUMN, StringType(), True)])

REASON_CORRUPT = "CORRUPT_RECORD"
REASON_NO_ID = "MISSING_TRANSACTION_ID"
REASON_NO_AMOUNT = "MISSING_AMOUNT"


def encode_transactions(tx: DataFrame, text_amount: Column | None = None) -> DataFrame:
    """One JSON object per row in column ``value`` (no key), as producers send it.

    ``text_amount``: rows for which it is true carry ``amount`` as a JSON string
    (a common producer bug); the decoder must treat those as malformed.
    """
    cols = [F.col(c) for c in TRANSACTION_COLUMNS]
    value = F.to_json(F.struct(*cols))
    if text_amount is not None:
        as_text = [F.col(c).cast("string").alias(c) if c == "amount" else F.col(c)
                   for c in TRANSACTION_COLUMNS]
        value = F.when(text_amount, F.to_json(F.struct(*as_text))).otherwise(value)
    return tx.select(value.alias("value"))


def parse_transactions(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Decode JSON strings with the fixed schema, PERMISSIVE mode.

    Every input row yields one output row (bad JSON becomes all-NULL fields),
    so downstream rules see exactly what the screened system saw. The raw text
    of rows that failed to parse is kept in ``_corrupt_record``.
    """
    data = F.from_json(F.col(value_col).cast("string"), _PARSE_SCHEMA,
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN})
    # ``inline`` of a one-element array expands the struct in a Generate node.
    # Predicates on the parsed fields cannot be pushed below a generator, so
    # each message is decoded exactly once; with a plain ``select("data.*")``
    # Catalyst copies ``from_json`` into every pushed-down filter.
    return screened_form(raw.select(F.inline(F.array(data))))


def screened_form(parsed: DataFrame) -> DataFrame:
    """Add ``event_time`` parsed from the zone-less timestamp text."""
    return parsed.withColumn(EVENT_TIME, event_time_from_text(F.col("timestamp")))


def malformed_reason() -> Column:
    """Why a parsed row cannot be routed, or NULL when it can.

    The corrupt column alone is not enough: an empty message, a NULL value and
    ``{}`` parse to all-NULL fields without setting it.
    """
    return (F.when(F.col(CORRUPT_COLUMN).isNotNull(), F.lit(REASON_CORRUPT))
            .when(F.col("transaction_id").isNull(), F.lit(REASON_NO_ID))
            .when(F.col("amount").isNull(), F.lit(REASON_NO_AMOUNT)))


def split_malformed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows, quarantined rows with ``reason``); both lazy, one pass each."""
    tagged = parsed.withColumn("reason", malformed_reason())
    clean = tagged.where(F.col("reason").isNull()).drop("reason", CORRUPT_COLUMN)
    quarantine = tagged.where(F.col("reason").isNotNull())
    return clean, quarantine
