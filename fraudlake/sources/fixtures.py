"""Views of the driver's tables in the transaction data model.

The payment data set itself is not available, so ``events`` is mapped onto the
11-field transaction record by integer rules over ``event_id``: every quality
case (null / negative amount, null destination, negative and null balances,
drained originators as the fraud pattern) appears at a fixed rate, and all
work grows with ``events``. The same views exist as SQL in
``fraudlake.plans.oracle`` for the DuckDB cross-check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixture pepper: never a real one.
FIXTURE_PEPPER = "fixture-pepper"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def account_id(num: Column) -> Column:
    """'C' + id left-padded to 9 digits."""
    return F.concat(F.lit("C"), F.lpad(num.cast("string"), 9, "0"))


# The mapping as SQL expressions: one ``selectExpr`` call builds the whole
# projection in the JVM (building it Column by Column costs hundreds of
# Python-to-JVM round trips per query).
_TXN_EXPRS = (
    "event_id AS seq",
    "(dayofmonth(ts) - 1) * 24 + hour(ts) + 1 AS step",
    "CASE event_type WHEN 'purchase' THEN 'CASH_OUT' WHEN 'error' THEN 'TRANSFER' "
    "WHEN 'view' THEN 'PAYMENT' WHEN 'click' THEN 'CASH_IN' ELSE 'DEBIT' END AS type",
    "CASE WHEN event_id % 103 = 0 THEN CAST(NULL AS DOUBLE) WHEN event_id % 101 = 0 THEN -value ELSE value END AS amount",
    "concat('C', lpad(CAST(event_id AS STRING), 9, '0')) AS nameOrig",
    "CASE WHEN event_id % 3 = 0 THEN 0.0D ELSE value * (event_id % 7 + 1) END AS oldbalanceOrg",
    "CASE WHEN event_id % 3 = 0 OR event_id % 13 = 0 THEN 0.0D ELSE value * (event_id % 7) END AS newbalanceOrig",
    "CASE WHEN event_id % 107 = 0 THEN CAST(NULL AS STRING) ELSE concat('C', lpad(CAST(user_id AS STRING), 9, '0')) END AS nameDest",
    "CASE WHEN event_id % 113 = 0 THEN CAST(NULL AS DOUBLE) ELSE value * (event_id % 5) END AS oldbalanceDest",
    "CASE WHEN event_id % 109 = 0 THEN -1.0D WHEN event_id % 13 = 0 THEN 0.0D ELSE value * (event_id % 5 + 1) END AS newbalanceDest",
    "CASE WHEN event_type IN ('purchase', 'error') AND event_id % 13 = 0 THEN 1 ELSE 0 END AS isFraud",
    "CASE WHEN event_id % 997 = 0 THEN 1 ELSE 0 END AS isFlaggedFraud",
    "ts AS ingested_at",
)


def transactions_from_events(events: DataFrame) -> DataFrame:
    return events.selectExpr(*_TXN_EXPRS)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from_events(table(spark, sf_dir, "events"))


def erasure_requests_from_events(events: DataFrame) -> DataFrame:
    """Requests for every 10th user, a second request for every 20th user."""
    first = (
        events.where(F.col("user_id") % 10 == 0)
        .groupBy("user_id")
        .agg(F.min("event_id").alias("e"), F.min("ts").alias("t"))
    )
    again = (
        events.where(F.col("user_id") % 20 == 0)
        .groupBy("user_id")
        .agg(F.min("event_id").alias("e"), F.min("ts").alias("t"))
    )
    return first.select(
        account_id(F.col("user_id")).alias("account_id"),
        F.concat(F.lit("req-"), F.col("e").cast("string")).alias("request_id"),
        F.col("t").alias("requested_ts"),
    ).unionByName(
        again.select(
            account_id(F.col("user_id")).alias("account_id"),
            F.concat(F.lit("req-dup-"), F.col("e").cast("string")).alias("request_id"),
            (F.col("t") + F.expr("INTERVAL 1 HOUR")).alias("requested_ts"),
        )
    )


def erasure_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return erasure_requests_from_events(table(spark, sf_dir, "events"))


def txn_messages_from_transactions(txn: DataFrame) -> DataFrame:
    """Raw JSON messages (``seq``, ``value``) with drift injected by rule.

    Every 97th message renames ``oldbalanceOrg``, every 89th sends the amount as
    a string, every 83rd an unknown type, every 79th drops ``nameDest``, every
    71st sends ``step`` as a float, every 211th is broken JSON and every 307th a
    JSON string instead of an object.
    """
    s = F.col("seq")
    fields = [
        "step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig",
        "nameDest", "oldbalanceDest", "newbalanceDest", "isFraud", "isFlaggedFraud",
    ]
    cols = {f: F.col(f) for f in fields}
    body = F.to_json(F.struct(*[c.alias(n) for n, c in cols.items()]), {"ignoreNullFields": "false"})
    renamed = F.replace(body, F.lit('"oldbalanceOrg":'), F.lit('"oldbalanceOrig":'))
    amount_str = F.to_json(
        F.struct(*[(F.col(n).cast("string") if n == "amount" else c).alias(n) for n, c in cols.items()]),
        {"ignoreNullFields": "false"},
    )
    unknown = F.to_json(
        F.struct(*[(F.lit("REFUND") if n == "type" else c).alias(n) for n, c in cols.items()]),
        {"ignoreNullFields": "false"},
    )
    no_dest = F.to_json(F.struct(*[c.alias(n) for n, c in cols.items() if n != "nameDest"]), {"ignoreNullFields": "false"})
    float_step = F.to_json(
        F.struct(*[(F.col(n).cast("double") if n == "step" else c).alias(n) for n, c in cols.items()]),
        {"ignoreNullFields": "false"},
    )
    value = (
        F.when(s % 307 == 0, F.to_json(F.struct(F.col("nameOrig").alias("x"))).substr(F.lit(6), F.lit(12)))
        .when(s % 211 == 0, F.substring(body, 1, 40))
        .when(s % 97 == 0, renamed)
        .when(s % 89 == 0, amount_str)
        .when(s % 83 == 0, unknown)
        .when(s % 79 == 0, no_dest)
        .when(s % 71 == 0, float_step)
        .otherwise(body)
    )
    return txn.select("seq", value.alias("value"))
