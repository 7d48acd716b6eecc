"""Stream -> Bronze with the quality fork (two sinks, two checkpoints).

Accepted rows go to parquet partitioned by ``type``; rejected rows go to a
separate quarantine with their ``reasons`` and the ``raw`` message, partitioned
by the first reason (a rejected row may have no ``type``). Both queries are
built from one function and each has its own checkpoint, so each sink sees
every micro-batch exactly once (file sink + checkpoint log).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fraudlake.functions import quality
from fraudlake.paths import LakePaths
from fraudlake.sources.txn import decode_txn


def parsed_stream(raw: DataFrame, value_col: str = "value", keep=()) -> DataFrame:
    """Decoded messages with their quality reasons."""
    return quality.with_dq(decode_txn(raw, value_col=value_col, keep=keep))


def _trigger(writer, trigger: str | None):
    if trigger in (None, "availableNow"):
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def start_bronze(
    raw: DataFrame,
    paths: LakePaths,
    trigger: str | None = "30 seconds",
    value_col: str = "value",
    keep=(),
) -> tuple[StreamingQuery, StreamingQuery]:
    """Start the accepted and quarantine queries; returns both handles."""
    paths.check_disjoint()
    parsed = parsed_stream(raw, value_col, keep)
    accepted = parsed.where(F.size("reasons") == 0).drop("reasons", "raw")
    rejected = parsed.where(F.size("reasons") > 0).withColumn(
        "first_reason", F.regexp_replace(F.element_at("reasons", 1), "[^A-Za-z0-9_]+", "_")
    )
    q1 = _trigger(
        accepted.writeStream.format("parquet")
        .option("path", paths.bronze)
        .option("checkpointLocation", paths.bronze_checkpoint)
        .partitionBy("type")
        .outputMode("append"),
        trigger,
    ).start()
    q2 = _trigger(
        rejected.writeStream.format("parquet")
        .option("path", paths.quarantine)
        .option("checkpointLocation", paths.quarantine_checkpoint)
        .partitionBy("first_reason")
        .outputMode("append"),
        trigger,
    ).start()
    return q1, q2


def json_file_stream(spark: SparkSession, folder: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Replay source: a folder of JSON-lines files read as text ``value``.

    New files are picked up per trigger (``maxFilesPerTrigger`` paces the
    replay); the query checkpoint remembers which files were consumed, so a
    restart resumes instead of re-sending from the start.
    """
    return spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger).load(folder)


def replay_table(spark: SparkSession, table: DataFrame, folder: str, seq_col: str = "seq", rows_per_file: int = 1000) -> int:
    """Stage a stored table as JSON-lines files ordered by ``seq`` slices, for
    a paced replay through :func:`json_file_stream`. Returns files written."""
    bounds = table.agg(F.min(seq_col).alias("lo"), F.max(seq_col).alias("hi")).first()
    if bounds["lo"] is None:
        return 0
    payload = table.select(
        (F.floor((F.col(seq_col) - F.lit(bounds["lo"])) / rows_per_file)).alias("_slice"),
        F.col(seq_col).alias("_seq"),
        F.to_json(F.struct(*table.columns)).alias("value"),
    )
    # one file a slice, rows in order; ``seq`` stays in the message
    dealt = payload.repartition("_slice").sortWithinPartitions("_slice", "_seq").drop("_seq")
    dealt.write.mode("overwrite").partitionBy("_slice").text(folder)
    return int((bounds["hi"] - bounds["lo"]) // rows_per_file + 1)
