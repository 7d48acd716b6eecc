"""Physical-plan helpers shared by the operators.

Each helper is a composition of DataFrame operators chosen so that no single
task, group or the driver ever holds a share of the data that grows with it:

* ``cumulative_by_order``: exact running totals over a global order without a
  single-partition window (range buckets + per-bucket offsets).
* ``chunked_row_number``: exact arrival rank inside a group, with hot groups
  split into bounded chunks of the ordering key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CHUNK_ROWS_CONF = "fraudlake.chunk.rows"
DEFAULT_CHUNK_ROWS = 1_000_000
PREFIX_BUCKETS_CONF = "fraudlake.prefix.buckets"


def _conf_int(spark: SparkSession, key: str, default: int) -> int:
    return int(spark.conf.get(key, str(default)))


def cumulative_by_order(
    df: DataFrame,
    order_col: str,
    sum_cols: Sequence[str],
    descending: bool = True,
    n_buckets: int | None = None,
    cuts: Sequence[float] | None = None,
    prefix: str = "cum_",
) -> DataFrame:
    """Add ``cum_<c>`` = sum of ``c`` over all rows at or before each row.

    ``df`` must hold one row per distinct ``order_col`` value (aggregate
    first). Rows are cut into range buckets by ``cuts`` (approximate quantiles
    when not given); a running sum runs inside each bucket in parallel, and the
    exclusive prefix of bucket totals (one row per bucket, broadcast) is added.
    The result is exact for any choice of cut points; the cuts only balance
    the work.
    """
    spark = df.sparkSession
    if cuts is None:
        b = n_buckets or _conf_int(spark, PREFIX_BUCKETS_CONF, 64)
        probs = [i / b for i in range(1, b)]
        cuts = df.approxQuantile(order_col, probs, 1.0 / (4 * b)) if b > 1 else []
    cuts = sorted(set(c for c in cuts if c is not None))
    key = F.col(order_col)
    # bucket number increases along the requested order
    bucket: Column = F.lit(0)
    for c in cuts:
        bucket = bucket + F.when(key > F.lit(c), 1).otherwise(0)
    if descending:
        bucket = F.lit(len(cuts)) - bucket
    staged = df.withColumn("_bucket", bucket)
    totals = staged.groupBy("_bucket").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_bucket",
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sum_cols],
    )
    ordering = key.desc() if descending else key.asc()
    inside = Window.partitionBy("_bucket").orderBy(ordering).rowsBetween(Window.unboundedPreceding, 0)
    # offsets hold one row per bucket: bounded by the bucket count
    out = staged.join(F.broadcast(offsets), "_bucket", "left")
    for c in sum_cols:
        out = out.withColumn(f"{prefix}{c}", F.sum(c).over(inside) + F.col(f"_o_{c}"))
    return out.drop("_bucket", *[f"_o_{c}" for c in sum_cols])


def cumulative_by_order_plain(
    df: DataFrame, order_col: str, sum_cols: Sequence[str], descending: bool = True, prefix: str = "cum_"
) -> DataFrame:
    """Single-window form of ``cumulative_by_order`` (small inputs, tests)."""
    key = F.col(order_col)
    w = Window.orderBy(key.desc() if descending else key.asc()).rowsBetween(Window.unboundedPreceding, 0)
    for c in sum_cols:
        df = df.withColumn(f"{prefix}{c}", F.sum(c).over(w))
    return df


def chunked_row_number(
    df: DataFrame,
    group_cols: Sequence[str],
    order_col: str,
    out_col: str = "rn",
    chunk_rows: int | None = None,
) -> DataFrame:
    """Exact ``row_number() over (partition by group order by order_col)``.

    ``order_col`` is an integer key unique inside a group (a sequence number).
    Rows are numbered inside chunks ``floor(order/chunk_rows)``, so no window
    partition holds more than ``chunk_rows`` rows even when one group holds a
    third of the table; chunk offsets come from a window over one row per
    (group, chunk).
    """
    size = chunk_rows or _conf_int(df.sparkSession, CHUNK_ROWS_CONF, DEFAULT_CHUNK_ROWS)
    keys = list(group_cols)
    staged = df.withColumn("_chunk", F.floor(F.col(order_col) / F.lit(size)))
    chunks = staged.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_chunk").alias("_k_chunk"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
    )
    inside = Window.partitionBy(*keys, "_chunk").orderBy(order_col)
    numbered = staged.withColumn("_rn", F.row_number().over(inside))
    cond = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col("_chunk") == F.col("_k_chunk")]
    out = numbered.join(chunks, cond, "left")
    return out.withColumn(out_col, F.col("_off") + F.col("_rn")).drop(
        "_chunk", "_rn", "_off", "_k_chunk", *[f"_k_{k}" for k in keys]
    )
