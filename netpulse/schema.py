"""Fixed schemas of the data model.

No schema is ever inferred: every read names its schema.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The log record's field names, in the order of the event documents.
LOG_FIELDS = [
    "src_ip", "timestamp", "unq_dst_ip", "allow", "drop", "frequency",
    "pkts_sent", "pkts_received", "bytesin", "bytesout", "unq_dst_port",
]

# Counter fields of a log record (every field except the key and the time).
METRICS = [f for f in LOG_FIELDS if f not in ("src_ip", "timestamp")]

# Fixed value: the text format of a log timestamp.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Wire form: every field is a string, as on the topic.
LOG_STREAM_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in LOG_FIELDS])

_WIDE = {"bytesin", "bytesout"}  # byte counters pass 2**31 in real logs

# Typed form of a log record.
LOG_SCHEMA = T.StructType(
    [T.StructField("src_ip", T.StringType())]
    + [T.StructField(m, T.LongType() if m in _WIDE else T.IntegerType()) for m in METRICS]
    + [T.StructField("timestamp", T.TimestampNTZType())]
)

# Long series table: one sample per (ip, data_type, ds).
SERIES_SCHEMA = T.StructType([
    T.StructField("ip", T.StringType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("ds", T.TimestampNTZType()),
    T.StructField("value", T.DoubleType()),
])

# Training frame of the forecast.
TRAIN_SCHEMA = T.StructType([
    T.StructField("ip", T.StringType()),
    T.StructField("ds", T.TimestampNTZType()),
    T.StructField("y", T.DoubleType()),
])

# Forecast table, one row per (ip, ds) and run.
FORECAST_SCHEMA = T.StructType([
    T.StructField("ds", T.TimestampNTZType()),
    T.StructField("ip", T.StringType()),
    T.StructField("y", T.DoubleType()),
    T.StructField("yhat", T.DoubleType()),
    T.StructField("yhat_upper", T.DoubleType()),
    T.StructField("yhat_lower", T.DoubleType()),
    T.StructField("training_date", T.DateType()),
])

# Per-source history table.
HISTORY_SCHEMA = T.StructType([
    T.StructField("ip", T.StringType()),
    T.StructField("ds", T.TimestampNTZType()),
    T.StructField("y", T.DoubleType()),
])

# Relational sink of dumped samples: (ip, ds epoch seconds, metric).
DUMP_SCHEMA = T.StructType([
    T.StructField("ip", T.StringType()),
    T.StructField("ds", T.LongType()),
    T.StructField("unq_dst_ip", T.LongType()),  # byte counters pass 2^31
])
