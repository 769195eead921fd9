"""Schemas of the tables the operators read."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and order of a raw network log.
RAW_LOG = T.StructType([
    T.StructField("Timestamp", T.TimestampNTZType()),
    T.StructField("Source_IP", T.StringType()),
    T.StructField("Destination_IP", T.StringType()),
    T.StructField("Port", T.IntegerType()),
    T.StructField("Request_Type", T.StringType()),
    T.StructField("Protocol", T.StringType()),
    T.StructField("Payload_Size", T.LongType()),
    T.StructField("User_Agent", T.StringType()),
    T.StructField("Status", T.StringType()),
    T.StructField("Intrusion", T.IntegerType()),
    T.StructField("Scan_Type", T.StringType()),
])

# Categorical columns, model features in order, target.
CATEGORICAL_COLUMNS = ["Request_Type", "Protocol", "User_Agent", "Status"]
FEATURE_COLUMNS = [
    "Payload_Size", "hour", "day_of_week", "day", "month", "minute", "is_weekend",
    "is_business_hours", "payload_rolling_mean", "payload_rolling_std", "payload_lag_1",
    "payload_lag_5", "time_since_last", "Request_Type_encoded", "Protocol_encoded",
    "User_Agent_encoded", "Status_encoded",
]
TARGET = "Intrusion"

# Window, lags, split ratio, folds, prototypes, charted features.
ROLLING_WINDOW = 10
LAGS = [1, 5]
TRAIN_RATIO = 0.8
CV_FOLDS = 3
EVAL_FOLDS = 5
PROTOTYPES = 10
INVARIANCE_FEATURE = "Payload_Size"
DEPENDENCE_FEATURES = ["Payload_Size", "hour", "payload_rolling_mean", "time_since_last", "is_business_hours"]

# Fields of a scoring request and the key of the log store.
REQUEST_FIELDS = [
    "timestamp", "source_ip", "destination_ip", "source_port", "destination_port",
    "protocol", "payload_size", "user_agent", "status",
]
STORE_KEY = ["timestamp", "source_ip", "destination_ip"]

REQUEST = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("source_ip", T.StringType()),
    T.StructField("destination_ip", T.StringType()),
    T.StructField("source_port", T.IntegerType()),
    T.StructField("destination_port", T.IntegerType()),
    T.StructField("protocol", T.StringType()),
    T.StructField("payload_size", T.DoubleType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("status", T.StringType()),
])
