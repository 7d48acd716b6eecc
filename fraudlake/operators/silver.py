"""Silver: renamed columns, masked account ids, balance features, fan-in.

Masking is a join of the fact with the erasure registry, once on the
originator and once on the destination. The registry is first reduced to one
row per account (the registry is unique per request, so an account with two
requests would otherwise duplicate facts), and is broadcast only after a
bounded size check; beyond it both joins shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake.functions.features import SILVER_RENAMES, balance_features
from fraudlake.operators.fanin import fan_in, fan_in_plain
from fraudlake.schemas import SILVER_COLUMNS


def alias_per_account(registry: DataFrame) -> DataFrame:
    """One (account_id, account_alias) row per account."""
    return registry.groupBy("account_id").agg(F.min("account_alias").alias("account_alias"))


def mask_accounts(
    txn: DataFrame,
    registry: DataFrame | None,
    orig_col: str = "nameOrig",
    dest_col: str = "nameDest",
    out_orig: str = "name_orig",
    out_dest: str = "name_dest",
    broadcast_max_rows: int | None = None,
) -> DataFrame:
    """Replace registered raw ids by their alias in both id columns."""
    if registry is None:
        return txn.withColumnsRenamed({orig_col: out_orig, dest_col: out_dest})
    reg = alias_per_account(registry)
    # the same registry frame joined twice under two aliases: one broadcast
    # exchange, reused for the second join
    o, d = reg.alias("_o"), reg.alias("_d")
    joined = txn.join(o, F.col(orig_col) == F.col("_o.account_id"), "left").join(
        d, F.col(dest_col) == F.col("_d.account_id"), "left"
    )
    return joined.select(
        *[F.col(c) for c in txn.columns if c not in (orig_col, dest_col)],
        F.coalesce(F.col("_o.account_alias"), F.col(orig_col)).alias(out_orig),
        F.coalesce(F.col("_d.account_alias"), F.col(dest_col)).alias(out_dest),
    )


def silver(
    bronze: DataFrame,
    registry: DataFrame | None = None,
    scale_form: bool = True,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Bronze (accepted rows) -> the 19-column Silver layout.

    ``keep`` carries extra Bronze columns (e.g. ``seq``) through.
    """
    masked = mask_accounts(bronze, registry)
    renamed = masked.withColumnsRenamed(dict(SILVER_RENAMES))
    with_feats = renamed.withColumns(balance_features())
    windowed = fan_in(with_feats) if scale_form else fan_in_plain(with_feats)
    return windowed.select(*SILVER_COLUMNS, *keep)


def silver_view(spark, silver_df: DataFrame, name: str = "stg_transactions") -> DataFrame:
    """Silver stays a view: register it and return it."""
    silver_df.createOrReplaceTempView(name)
    return spark.table(name)
