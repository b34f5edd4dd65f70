"""Schemas and column roles of the transaction tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Roles (fixed values of the source pipeline's configuration).
TARGET_COL = "is_fraud"
ID_COL = "TransactionID"
TIME_COL = "TransactionDate"
PREV_TIME_COL = "PreviousTransactionDate"
ACCOUNT_COL = "AccountID"
TEXT_COL = "nlp_text"
RANDOM_SEED = 42
VAL_SIZE = 0.15
TEST_SIZE = 0.15
SEQUENCE_LENGTH = 10
LABEL_SOURCE = "heuristic_v2"

# Timestamps are UTC wall-clock values.  They are kept as TIMESTAMP_NTZ (the
# type the parquet inputs carry); with the session pinned to UTC every
# extraction gives the same result as on a UTC instant.
TS = T.TimestampNTZType()

# Raw table: 16 nullable columns, fixed schema, no inference.
RAW_SCHEMA = T.StructType([
    T.StructField("TransactionID", T.StringType()),
    T.StructField("AccountID", T.StringType()),
    T.StructField("TransactionAmount", T.DoubleType()),
    T.StructField("TransactionDate", TS),
    T.StructField("TransactionType", T.StringType()),
    T.StructField("Location", T.StringType()),
    T.StructField("DeviceID", T.StringType()),
    T.StructField("IP_Address", T.StringType()),
    T.StructField("MerchantID", T.StringType()),
    T.StructField("Channel", T.StringType()),
    T.StructField("CustomerAge", T.LongType()),
    T.StructField("CustomerOccupation", T.StringType()),
    T.StructField("TransactionDuration", T.LongType()),
    T.StructField("LoginAttempts", T.LongType()),
    T.StructField("AccountBalance", T.DoubleType()),
    T.StructField("PreviousTransactionDate", TS),
])
RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]

# Text columns trimmed during curation.
TRIMMED_COLUMNS = ["TransactionType", "Location", "DeviceID", "IP_Address",
                   "MerchantID", "Channel", "CustomerOccupation"]

# Columns concatenated (in this order) into nlp_text.
TEXT_PARTS = ["TransactionType", "Location", "Channel", "MerchantID", "DeviceID", "IP_Address"]

FLAG_COLUMNS = ["flag_high_amount", "flag_high_ratio", "flag_many_logins", "flag_night",
                "flag_rapid_repeat_high", "flag_weekend_high"]

# Curated output: 30 columns in this order.
CURATED_COLUMNS = RAW_COLUMNS + [
    "amt_to_bal", "txn_hour", "is_weekend", "minutes_since_prev",
    *FLAG_COLUMNS, "risk_score", "is_fraud", "nlp_text", "label_source",
]

# Columns that leak the weak label (dropped before modelling).
LEAKY_COLUMNS = FLAG_COLUMNS + ["risk_score"]

# Identifier-like columns removed by the ablation study.
ID_LIKE_COLUMNS = ["DeviceID", "IP_Address", "MerchantID", "Location"]

# Role columns never fed to a model.
ROLE_DROP_COLUMNS = [TARGET_COL, ID_COL, TIME_COL, PREV_TIME_COL, TEXT_COL]

# Scoring request: the raw columns with dates as strings, plus free text.
REQUEST_SCHEMA = T.StructType(
    [T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.TimestampNTZType) else f.dataType)
     for f in RAW_SCHEMA.fields] + [T.StructField("nlp_text", T.StringType())]
)

# Anonymised card dataset: Time, V1..V28, Amount, Class.
CARD_SCHEMA = T.StructType(
    [T.StructField("Time", T.DoubleType())]
    + [T.StructField(f"V{i}", T.DoubleType()) for i in range(1, 29)]
    + [T.StructField("Amount", T.DoubleType()), T.StructField("Class", T.IntegerType())]
)

METRIC_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("roc_auc", T.DoubleType()),
    T.StructField("pr_auc", T.DoubleType()),
    T.StructField("f1", T.DoubleType()),
    T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("cm", T.StructType([T.StructField(k, T.LongType()) for k in ("tn", "fp", "fn", "tp")])),
])
