"""Training extract, temporal split and split summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake.paths import guard_output
from fraudlake.schemas import FEATURES, SCORABLE_TYPES, SPLIT_QUANTILE
from fraudlake.session import checkpoint_root


def extract_training(gold_df: DataFrame, types=SCORABLE_TYPES, keep: tuple[str, ...] = ()) -> DataFrame:
    """Nine features + ``step`` + ``is_fraud`` for the scorable types.

    On a mart written ``partitionBy("type")`` the ``isin`` becomes a partition
    filter and the projection a pruned read schema.
    """
    return gold_df.where(F.col("type").isin(*types)).select(*FEATURES, "step", "is_fraud", *keep)


def label_distribution(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))


def step_quantile(df: DataFrame, q: float = SPLIT_QUANTILE, step: str = "step") -> DataFrame:
    """Exact linear-interpolated quantile of ``step``.

    Reduced first to one row per distinct step (map-side combine), then the
    frequency form of ``percentile``: the aggregation buffer holds one entry
    per distinct step (hours), not one per row.
    """
    counts = df.groupBy(step).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.percentile(F.col(step), F.lit(q), F.col("_n")).alias("split_step"))


def split_cut(df: DataFrame, q: float = SPLIT_QUANTILE) -> float:
    """The cut as a driver scalar (one number); 0 where there are no rows to cut."""
    cut = step_quantile(df, q).first()[0]
    return 0.0 if cut is None else float(cut)


def nested_cuts(df: DataFrame, q: float = SPLIT_QUANTILE, step: str = "step") -> tuple[float, float]:
    """(test cut, validation cut): rows above the first are the test window, those of the
    training period above the second its validation slice. The rows are read once."""
    counts = df.groupBy(step).agg(F.count(F.lit(1)).alias("_n"))  # one row per distinct step
    checkpoint_root(df.sparkSession)
    counts = counts.checkpoint(eager=True)
    cut = counts.agg(F.percentile(F.col(step), F.lit(q), F.col("_n"))).first()[0]
    cut = 0.0 if cut is None else float(cut)
    valid = counts.where(F.col(step) <= cut).agg(F.percentile(F.col(step), F.lit(q), F.col("_n"))).first()[0]
    return cut, cut if valid is None else float(valid)


def temporal_split(df: DataFrame, cut: float, step: str = "step") -> tuple[DataFrame, DataFrame]:
    """``step <= cut`` is train, ``step > cut`` is test."""
    return df.where(F.col(step) <= F.lit(cut)), df.where(F.col(step) > F.lit(cut))


def with_split(df: DataFrame, cut: float, step: str = "step") -> DataFrame:
    return df.withColumn("split", F.when(F.col(step) <= F.lit(cut), "train").otherwise("test"))


def split_summary(labelled: DataFrame, label: str = "is_fraud") -> DataFrame:
    """rows, fraud, fraud rate, legit per split, one pass."""
    return labelled.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col(label)).cast("long").alias("fraud"),
        F.round(F.avg(F.col(label).cast("double")), 6).alias("fraud_rate"),
        F.sum((F.col(label) == 0).cast("long")).alias("legit"),
    )


def class_weight(train: DataFrame, label: str = "is_fraud") -> DataFrame:
    """negatives / positives over training rows (NULL when no positive)."""
    return train.agg(
        F.sum((F.col(label) == 0).cast("long")).alias("negatives"),
        F.sum((F.col(label) == 1).cast("long")).alias("positives"),
    ).withColumn(
        "class_weight",
        F.col("negatives").cast("double") / F.nullif(F.col("positives"), F.lit(0)).cast("double"),
    )


def partition_check(source: DataFrame, labelled: DataFrame) -> DataFrame:
    """train + test rows must equal the source rows (one aggregate, no join)."""
    tagged = source.select(F.lit("source").alias("_part")).unionByName(labelled.select(F.col("split").alias("_part")))
    counts = tagged.agg(
        F.sum((F.col("_part") == "source").cast("long")).alias("source_rows"),
        F.sum((F.col("_part") == "train").cast("long")).alias("train_rows"),
        F.sum((F.col("_part") == "test").cast("long")).alias("test_rows"),
    )
    return counts.withColumn("is_partition", F.col("train_rows") + F.col("test_rows") == F.col("source_rows"))


def write_splits(train: DataFrame, test: DataFrame, train_path: str, test_path: str, sources=()) -> None:
    """Train and test parquet (``step`` dropped, as in the split files)."""
    for p in (train_path, test_path):
        guard_output(p, sources)
    train.drop("step").write.mode("overwrite").parquet(train_path)
    test.drop("step").write.mode("overwrite").parquet(test_path)
