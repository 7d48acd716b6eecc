"""Destination fan-in with purges over a state table, micro-batch by micro-batch.

The keyed state of :mod:`fraudlake.streaming.fanin_state` gives all rows of a key in a
micro-batch to one Python call. Here a micro-batch is a batch job
(:func:`fraudlake.operators.fanin.fan_in_any_order`): a hot destination is cut into
chunks over all tasks, and the state is a table of (key, step, n) in the shared folder.

Every batch writes ``results/batch=<id>`` and ``changes/batch=<id>`` (the counts that the
batch leaves behind), both by overwrite: a batch that Spark runs again after a crash
reads the same state before it and writes the same files. Every ``merge_every`` batches
the live state is written whole as ``merged/batch=<id>``, so a batch reads a bounded
number of folders. Only steps that the batch can reach are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fraudlake.operators.fanin import fan_in_any_order
from fraudlake.schemas import FAN_IN_WINDOW_STEPS
from fraudlake.streaming.batch_tables import complete_batches, read_batches, write_batch

CHANGES = "key string, step int, n long, fresh boolean"


def state_before(spark: SparkSession, root: str, batch_id: int, span: int) -> DataFrame | None:
    """(key, step, n): the live counts that the batches before ``batch_id`` left, or None.

    A batch in which a key was purged makes the counts of earlier batches void."""
    merged = [b for b in complete_batches(spark, f"{root}/merged") if b < batch_id]
    since = merged[-1] if merged else -1
    parts = [f"{root}/merged/batch={since}"] if merged else []
    parts += [f"{root}/changes/batch={b}" for b in complete_batches(spark, f"{root}/changes") if since < b < batch_id]
    if not parts:
        return None
    number = F.regexp_extract(F.input_file_name(), r"/batch=(\d+)/", 1).cast("long")
    rows = spark.read.schema(CHANGES).parquet(*parts).withColumn("_b", number)
    purged = F.max(F.when(F.col("fresh"), F.col("_b"))).over(Window.partitionBy("key"))
    rows = rows.withColumn("_purged", purged).where(F.col("step").isNotNull() & (F.col("_purged").isNull() | (F.col("_b") >= F.col("_purged"))))
    counts = rows.groupBy("key", "step").agg(F.sum("n").alias("n"))
    top = F.max("step").over(Window.partitionBy("key"))
    return counts.withColumn("_top", top).where(F.col("step") >= F.col("_top") - span).drop("_top")


def apply_batch(batch: DataFrame, batch_id: int, root: str, window: int = FAN_IN_WINDOW_STEPS, lateness: int = 0, chunk_rows: int | None = None, merge_every: int = 20) -> None:
    """One micro-batch of control rows (key, seq, kind, step, ...)."""
    spark, span = batch.sparkSession, window + lateness
    write_batch(batch, f"{root}/control", batch_id)  # read more than once below
    rows = read_batches(spark, f"{root}/control", batch.schema, only=batch_id)
    before = state_before(spark, root, batch_id, span)
    if before is not None:  # keys that the batch does not hold keep their state
        met = rows.select(F.col("key").alias("_met")).distinct()
        before = before.join(met, F.col("key").eqNullSafe(F.col("_met")), "left_semi")
    result, after = fan_in_any_order(rows, window, lateness, chunk_rows, before)
    write_batch(result, f"{root}/results", batch_id)
    if before is not None:
        # only what the batch adds: a key without a purge keeps the counts of earlier batches
        old = before.select(F.col("key").alias("_k"), F.col("step").alias("_s"), F.col("n").alias("_old"))
        same = F.col("key").eqNullSafe(F.col("_k")) & (F.col("step") == F.col("_s")) & ~F.col("fresh")
        after = after.join(old, same, "left").select("key", "step", (F.col("n") - F.coalesce("_old", F.lit(0))).alias("n"), "fresh").where(F.col("fresh") | (F.col("n") > 0))
    write_batch(after, f"{root}/changes", batch_id)
    if batch_id % merge_every == merge_every - 1:
        whole = state_before(spark, root, batch_id + 1, span)
        write_batch(whole.withColumn("fresh", F.lit(False)), f"{root}/merged", batch_id)


def start_fan_in(control: DataFrame, root: str, checkpoint: str, trigger: str = "30 seconds", **options):
    """Run :func:`apply_batch` on a control stream; results lie under ``<root>/results``."""
    writer = control.writeStream.foreachBatch(lambda batch, batch_id: apply_batch(batch, batch_id, root, **options)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if trigger == "availableNow" else writer.trigger(processingTime=trigger)).start()


def results(spark: SparkSession, root: str, schema) -> DataFrame:
    found = read_batches(spark, f"{root}/results", schema)
    return spark.createDataFrame([], schema) if found is None else found
