"""Tables that a stream writes batch by batch, a folder per batch number.

A batch's folder is written by overwrite, so a batch that Spark runs again after a
crash replaces what it wrote before; only complete folders are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fraudlake.paths import list_names, path_exists


def complete_batches(spark: SparkSession, folder: str) -> list[int]:
    names = [n.split("=", 1)[1] for n in list_names(spark, folder) if n.startswith("batch=")]
    return sorted(int(n) for n in names if path_exists(spark, f"{folder}/batch={n}/_SUCCESS"))


def write_batch(rows: DataFrame, folder: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")


def read_batches(spark: SparkSession, folder: str, schema, before: int | None = None, since: int = -1, only: int | None = None) -> DataFrame | None:
    """Rows of the complete batches (``since`` < number < ``before``, or ``only`` one), or None without any."""
    wanted = [b for b in complete_batches(spark, folder) if since < b and (before is None or b < before) and only in (None, b)]
    return spark.read.schema(schema).parquet(*[f"{folder}/batch={b}" for b in wanted]) if wanted else None
