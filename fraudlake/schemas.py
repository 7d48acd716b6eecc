"""Schemas, field orders and the fixed values the pipeline depends on."""

from __future__ import annotations

from pyspark.sql import types as T

# Transaction record as it arrives on the wire (11 nullable fields).
TXN = T.StructType(
    [
        T.StructField("step", T.IntegerType(), True),
        T.StructField("type", T.StringType(), True),
        T.StructField("amount", T.DoubleType(), True),
        T.StructField("nameOrig", T.StringType(), True),
        T.StructField("oldbalanceOrg", T.DoubleType(), True),
        T.StructField("newbalanceOrig", T.DoubleType(), True),
        T.StructField("nameDest", T.StringType(), True),
        T.StructField("oldbalanceDest", T.DoubleType(), True),
        T.StructField("newbalanceDest", T.DoubleType(), True),
        T.StructField("isFraud", T.IntegerType(), True),
        T.StructField("isFlaggedFraud", T.IntegerType(), True),
    ]
)
TXN_FIELDS = tuple(f.name for f in TXN.fields)

# --- Fixed values: these must equal the reference pipeline's -------------
# Quality rule field sets, in rule order.
REQUIRED_FIELDS = ("step", "type", "amount", "nameOrig", "nameDest")
BALANCE_FIELDS = ("oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest")
# Quality rule messages.
MSG_MISSING = "missing or null required field: {field}"
MSG_NEGATIVE_AMOUNT = "negative amount"
MSG_NEGATIVE_BALANCE = "negative balance: {field}"
# The five transaction types and the two the model was trained on.
TXN_TYPES = ("PAYMENT", "TRANSFER", "CASH_OUT", "DEBIT", "CASH_IN")
SCORABLE_TYPES = ("CASH_OUT", "TRANSFER")
# Message contract: field -> expected JSON kind (Python type name).
CONTRACT_KINDS = (
    ("step", "int"),
    ("type", "str"),
    ("amount", "float"),
    ("nameOrig", "str"),
    ("oldbalanceOrg", "float"),
    ("newbalanceOrig", "float"),
    ("nameDest", "str"),
    ("oldbalanceDest", "float"),
    ("newbalanceDest", "float"),
    ("isFraud", "int"),
    ("isFlaggedFraud", "int"),
)
ALERT_KINDS = (
    ("txn", "dict"),
    ("fraud_probability", "float"),
    ("threshold", "float"),
    ("model_version", "str"),
)
MSG_NOT_OBJECT_TXN = "transaction is not a dict"
MSG_NOT_OBJECT_ALERT = "alert is not a dict"
MSG_MISSING_FIELD = "missing field: {field}"
MSG_WRONG_KIND = "field {field}: expected {expected}, got {got}"
MSG_UNKNOWN_TYPE = "unknown type: {value}"
# Fan-in window length in steps (1 step = 1 hour), inclusive on both ends.
FAN_IN_WINDOW_STEPS = 24
# Account alias: prefix + first 16 hex characters of HMAC-SHA256(pepper, id).
ALIAS_PREFIX = "ANON_"
ALIAS_HEX_CHARS = 16
# Accepted erasure account ids: one letter followed by 2..31 digits.
ACCOUNT_ID_PATTERN = r"^[A-Za-z][0-9]{2,31}$"
# Default request id when none is supplied: prefix + 8 hex characters.
REQUEST_ID_PREFIX = "req-"
REQUEST_ID_HEX_CHARS = 8
# Threshold matrix: operating points reported beside the best-F1 threshold.
OPERATING_THRESHOLDS = (0.5, 0.9, 0.95, 0.99, 0.999)
F1_EPSILON = 1e-10
# Monitoring: metric rollup periods (seconds) and alarm rules.
WORKLOAD_PERIOD_S = 300
HEARTBEAT_PERIOD_S = 60
# (metric, comparison, threshold, period seconds, evaluation periods, missing = breach)
ALARM_RULES = (
    ("ScorerErrorCount", ">", 5.0, 300, 1, False),
    ("FraudAlertCount", ">", 50.0, 300, 1, False),
    ("ConsumerHeartbeat", "<", 1.0, 60, 3, True),
)
# Boosted trees: 300 rounds, depth 6, rate 0.05, seed 42, 15-round patience.
GBT_MAX_ITER = 300
GBT_MAX_DEPTH = 6
GBT_STEP_SIZE = 0.05
GBT_SEED = 42
GBT_PATIENCE = 15
SPLIT_QUANTILE = 0.80
# --------------------------------------------------------------------------

# Model features, in the frozen order the scorer assembles them.
FEATURES = (
    "amount",
    "has_balance_orig",
    "balance_delta_orig",
    "error_balance_orig",
    "has_balance_dest",
    "balance_delta_dest",
    "error_balance_dest",
    "is_flagged_fraud",
    "fan_in_dest_count_24h",
)

# Silver (19 columns) and Gold (12 columns) layouts.
SILVER_COLUMNS = (
    "step",
    "type",
    "amount",
    "name_orig",
    "old_balance_orig",
    "new_balance_orig",
    "name_dest",
    "old_balance_dest",
    "new_balance_dest",
    "is_fraud",
    "is_flagged_fraud",
    "ingested_at",
    "balance_delta_orig",
    "balance_delta_dest",
    "error_balance_orig",
    "error_balance_dest",
    "has_balance_orig",
    "has_balance_dest",
    "fan_in_dest_count_24h",
)
GOLD_COLUMNS = FEATURES + ("step", "is_fraud", "type")

ERASURE_REQUEST = T.StructType(
    [
        T.StructField("account_id", T.StringType(), True),
        T.StructField("request_id", T.StringType(), True),
    ]
)

REGISTRY = T.StructType(
    [
        T.StructField("account_id", T.StringType(), True),
        T.StructField("account_alias", T.StringType(), True),
        T.StructField("request_id", T.StringType(), True),
        T.StructField("requested_at", T.StringType(), True),
    ]
)

AUDIT = T.StructType(
    [
        T.StructField("timestamp", T.StringType(), True),
        T.StructField("request_id", T.StringType(), True),
        T.StructField("account_alias", T.StringType(), True),
        T.StructField("streaming_purge_published", T.BooleanType(), True),
        T.StructField("rows_anonymized", T.LongType(), True),
    ]
)

ALERT = T.StructType(
    [
        T.StructField("txn", TXN, True),
        T.StructField("fraud_probability", T.DoubleType(), True),
        T.StructField("threshold", T.DoubleType(), True),
        T.StructField("model_version", T.StringType(), True),
    ]
)
