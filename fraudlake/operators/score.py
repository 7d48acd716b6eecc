"""Scoring chain: quality gate -> type guard -> fan-in -> score -> alert.

The same functions serve the batch twin and the streaming query: a scorer
is any ``DataFrame -> DataFrame`` adding ``fraud_probability`` (NULL when the
row cannot be scored). The scorecard scorer is a plain column expression (a
logistic function of the nine features with literal weights); the boosted
tree scorer wraps an MLlib model (``fraudlake.operators.model``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlake.functions import quality
from fraudlake.functions.features import scoring_features
from fraudlake.operators.fanin import fan_in_arrival
from fraudlake.schemas import FEATURES, SCORABLE_TYPES, TXN_FIELDS

Scorer = Callable[[DataFrame], DataFrame]

# Our stand-in model: logistic weights over the nine features (intercept first).
SCORECARD_WEIGHTS = (
    ("intercept", -3.0),
    ("amount", 0.004),
    ("has_balance_orig", 0.8),
    ("balance_delta_orig", 0.0005),
    ("error_balance_orig", 0.01),
    ("has_balance_dest", 0.3),
    ("balance_delta_dest", -0.001),
    ("error_balance_dest", 0.002),
    ("is_flagged_fraud", 1.5),
    ("fan_in_dest_count_24h", 0.05),
)
SCORECARD_METADATA = {"phase": "scorecard", "num_trees": 0, "decision_threshold": 0.9, "features": list(FEATURES)}


def scorecard_probability(weights=SCORECARD_WEIGHTS, digits: int = 6) -> Column:
    """round(1 / (1 + exp(-(b0 + sum b_i x_i))), digits); NULL if a feature is NULL."""
    margin: Column = F.lit(weights[0][1])
    for name, w in weights[1:]:
        margin = margin + F.lit(w) * F.col(name)
    return F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)), digits)


def scorecard_sql(weights=SCORECARD_WEIGHTS, digits: int = 6) -> str:
    """The scorecard as DuckDB SQL (the oracle's scorer)."""
    m = f"CAST({weights[0][1]!r} AS DOUBLE)"
    for name, w in weights[1:]:
        m = f"({m} + CAST({w!r} AS DOUBLE) * {name})"
    return f"round(CAST(1 AS DOUBLE) / (CAST(1 AS DOUBLE) + exp(-{m})), {digits})"


def scorecard_scorer(weights=SCORECARD_WEIGHTS) -> Scorer:
    return lambda df: df.withColumn("fraud_probability", scorecard_probability(weights))


def model_version(metadata: dict) -> str:
    return f"{metadata['phase']}-t{metadata['num_trees']}"


def score_status(df: DataFrame) -> DataFrame:
    """``dq_rejected`` / ``skipped`` (untrained type) / ``score_error`` / ``scored``."""
    return df.withColumn(
        "status",
        F.when(F.size("reasons") > 0, "dq_rejected")
        .when(~F.col("type").isin(*SCORABLE_TYPES), "skipped")
        .when(F.col("fraud_probability").isNull(), "score_error")
        .otherwise("scored"),
    )


def score_chain(
    txn: DataFrame,
    scorer: Scorer | None = None,
    metadata: dict | None = None,
    fan_in: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Batch twin of the live scorer, over raw transaction rows with ``seq``.

    Every row comes out once with a ``status``; only accepted rows of the
    scorable types get a fan-in (earlier arrivals, as the stream counts them)
    and a probability; rows of other types are out of distribution and are
    never scored.
    """
    scorer = scorer or scorecard_scorer()
    metadata = metadata or SCORECARD_METADATA
    fan_in = fan_in or fan_in_arrival
    reasoned = quality.with_dq(txn)
    ok = (F.size("reasons") == 0) & F.col("type").isin(*SCORABLE_TYPES)
    scorable = fan_in(reasoned.where(ok)).withColumn("fan_in_count", F.col("fan_in_dest_count_24h").cast("long"))
    scored = scorer(scoring_features(scorable))
    rest = reasoned.where(~ok)
    both = scored.unionByName(rest, allowMissingColumns=True)
    thr = float(metadata["decision_threshold"])
    out = score_status(both).withColumns(
        {
            "threshold": F.when(F.col("status").isin("scored", "score_error"), F.lit(thr)),
            "model_version": F.when(F.col("status").isin("scored", "score_error"), F.lit(model_version(metadata))),
            "is_alert": F.coalesce(F.col("fraud_probability") >= F.lit(thr), F.lit(False)),
        }
    )
    return out


def ood_guard(df: DataFrame) -> DataFrame:
    """Flag rows of untrained types instead of scoring them."""
    return df.withColumn(
        "guard", F.when(~F.col("type").isin(*SCORABLE_TYPES), F.lit("out_of_distribution")).otherwise("ok")
    )


def alert_struct(scored: DataFrame) -> Column:
    """Nested alert: the transaction (with its fan-in), probability, threshold, version."""
    fan = "fan_in_count" if "fan_in_count" in scored.columns else "fan_in_dest_count_24h"
    txn = F.struct(*[F.col(c) for c in TXN_FIELDS], F.col(fan).alias("fan_in_dest_count_24h"))
    return F.struct(
        txn.alias("txn"),
        F.col("fraud_probability"),
        F.col("threshold"),
        F.col("model_version"),
    )


def alerts(chain: DataFrame) -> DataFrame:
    """``probability >= threshold`` (inclusive) rows."""
    return chain.where(F.col("is_alert"))


def alert_messages(alert_rows: DataFrame, alias_map: DataFrame | None = None) -> DataFrame:
    """JSON alert messages keyed by destination; registered ids are masked."""
    df = alert_rows
    if alias_map is not None:
        from fraudlake.operators.silver import mask_accounts

        df = mask_accounts(df, alias_map, out_orig="nameOrig", out_dest="nameDest")
    return df.select(F.col("nameDest").alias("key"), F.to_json(alert_struct(df)).alias("value"))
