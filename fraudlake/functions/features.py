"""Row-level feature expressions (balance transitions, scoring defaults)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlake.schemas import FEATURES

# Raw (wire) name -> Silver name for the columns renamed by the Silver view.
SILVER_RENAMES = (
    ("oldbalanceOrg", "old_balance_orig"),
    ("newbalanceOrig", "new_balance_orig"),
    ("oldbalanceDest", "old_balance_dest"),
    ("newbalanceDest", "new_balance_dest"),
    ("isFraud", "is_fraud"),
    ("isFlaggedFraud", "is_flagged_fraud"),
)


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def balance_delta_orig(old: Column | str, new: Column | str) -> Column:
    return _c(old) - _c(new)


def balance_delta_dest(old: Column | str, new: Column | str) -> Column:
    return _c(new) - _c(old)


def error_balance_orig(old: Column | str, new: Column | str, amount: Column | str) -> Column:
    # operand order kept: (old - new) - amount; doubles are not associative
    return _c(old) - _c(new) - _c(amount)


def error_balance_dest(old: Column | str, new: Column | str, amount: Column | str) -> Column:
    return _c(old) + _c(amount) - _c(new)


def has_balance(old: Column | str) -> Column:
    return (_c(old) > F.lit(0)).cast("int")


def balance_features(
    old_orig: str = "old_balance_orig",
    new_orig: str = "new_balance_orig",
    old_dest: str = "old_balance_dest",
    new_dest: str = "new_balance_dest",
    amount: str = "amount",
) -> dict[str, Column]:
    """The six balance-transition features, in Silver column order."""
    return {
        "balance_delta_orig": balance_delta_orig(old_orig, new_orig),
        "balance_delta_dest": balance_delta_dest(old_dest, new_dest),
        "error_balance_orig": error_balance_orig(old_orig, new_orig, amount),
        "error_balance_dest": error_balance_dest(old_dest, new_dest, amount),
        "has_balance_orig": has_balance(old_orig),
        "has_balance_dest": has_balance(old_dest),
    }


def scoring_features(df: DataFrame, fan_in_col: str | None = "fan_in_dest_count_24h") -> DataFrame:
    """Raw transaction columns -> the nine model features as doubles.

    Missing flag counts as 0 and a missing fan-in as 0.0 (no observed fan-in).
    """
    feats = {
        "amount": F.col("amount").cast("double"),
        "has_balance_orig": has_balance("oldbalanceOrg").cast("double"),
        "balance_delta_orig": balance_delta_orig("oldbalanceOrg", "newbalanceOrig"),
        "error_balance_orig": error_balance_orig("oldbalanceOrg", "newbalanceOrig", "amount"),
        "has_balance_dest": has_balance("oldbalanceDest").cast("double"),
        "balance_delta_dest": balance_delta_dest("oldbalanceDest", "newbalanceDest"),
        "error_balance_dest": error_balance_dest("oldbalanceDest", "newbalanceDest", "amount"),
        "is_flagged_fraud": F.coalesce(F.col("isFlaggedFraud"), F.lit(0)).cast("double"),
        "fan_in_dest_count_24h": (
            F.coalesce(F.col(fan_in_col).cast("double"), F.lit(0.0))
            if fan_in_col and fan_in_col in df.columns
            else F.lit(0.0)
        ),
    }
    return df.withColumns(feats)


def feature_map(features=FEATURES) -> Column:
    """Named feature map (name -> double), as returned beside a score."""
    pairs = []
    for name in features:
        pairs += [F.lit(name), F.col(name).cast("double")]
    return F.create_map(*pairs)


def feature_array(features=FEATURES) -> Column:
    """Features as an ordered array in the frozen order."""
    return F.array(*[F.col(n).cast("double") for n in features])
