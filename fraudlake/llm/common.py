"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from fraudlake.session import shared_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return shared_path(spark, "llm", f"{label}-{uuid.uuid4().hex}")


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back (cuts lineage)."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def runs_of(sizes, limit: int):
    """Cut a sequence of sizes into runs [lo, hi) of at most ``limit`` in sum (one item at least)."""
    lo = total = 0
    for i, n in enumerate(sizes):
        if i > lo and total + n > limit:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = 2_000_000):
    """Slices of an Arrow batch holding at most ``limit`` bytes of text each (one row at least)."""
    col = batch.column(batch.schema.get_field_index(column))
    sizes = pa.compute.binary_length(col).fill_null(0).to_pylist() if len(col) else []
    for lo, hi in runs_of(sizes, limit):
        yield batch.slice(lo, hi - lo)


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    """0 and the running sums of ``lengths``."""
    out = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores in front where ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
