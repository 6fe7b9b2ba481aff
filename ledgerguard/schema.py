"""Schemas of the wire format, the screened form and the alert rows."""

from pyspark.sql.types import DoubleType, StringType, StructField, StructType

# Wire/JSON form of one transaction: all nullable, timestamp is zone-less text.
TRANSACTION_SCHEMA = StructType([
    StructField("transaction_id", StringType(), True),
    StructField("user_id", StringType(), True),
    StructField("timestamp", StringType(), True),
    StructField("amount", DoubleType(), True),
    StructField("currency", StringType(), True),
    StructField("merchant_category", StringType(), True),
    StructField("country", StringType(), True),
])

TRANSACTION_COLUMNS = [f.name for f in TRANSACTION_SCHEMA.fields]

# Screened form adds the parsed event time (TIMESTAMP_NTZ in batch, TIMESTAMP
# in streams, where watermarks need an instant).
EVENT_TIME = "event_time"

ALERT_COLUMNS = TRANSACTION_COLUMNS + ["fraud_type", "fraud_reason"]

ALERT_SCHEMA = StructType(TRANSACTION_SCHEMA.fields + [
    StructField("fraud_type", StringType(), True),
    StructField("fraud_reason", StringType(), True),
])

CORRUPT_COLUMN = "_corrupt_record"
