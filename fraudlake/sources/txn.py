"""Transaction sources: topic, JSON decode, CSV, read-through cache, pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.schemas import ERASURE_REQUEST, TXN

MAX_PAGE = 1000


def read_txn_topic(
    spark: SparkSession,
    bootstrap_servers: str,
    topics: str = "transactions-raw",
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int = 1_000_000,
) -> DataFrame:
    """Streaming topic scan from earliest, rate-capped per trigger.

    Several comma-separated topics may be subscribed at once (transactions and
    erasure requests); each record keeps its ``topic`` for dispatch. Needs the
    Kafka connector on the classpath.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topics)
        .option("startingOffsets", starting_offsets)
        .option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
        .load()
    )


def decode_txn(raw: DataFrame, value_col: str = "value", keep=(), with_ingest_time: bool = True) -> DataFrame:
    """bytes/text -> typed transaction columns (+ ``raw`` text, ``ingested_at``).

    PERMISSIVE: a field of the wrong JSON kind, or a message that is not an
    object, yields NULL fields, which the quality gate then rejects; ``raw``
    keeps the original text for the quarantine.
    """
    text = F.col(value_col).cast("string")
    parsed = raw.select(*keep, text.alias("raw"), F.from_json(text, TXN, {"mode": "PERMISSIVE"}).alias("data"))
    out = parsed.select(*keep, "raw", *[F.col(f"data.{f.name}").alias(f.name) for f in TXN.fields])
    if with_ingest_time:
        out = out.withColumn("ingested_at", F.current_timestamp())
    return out


def read_txn_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header, read with the fixed schema (no inference pass)."""
    return spark.read.schema(TXN).option("header", True).csv(path)


def read_through_cache(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Read the parquet cache if complete (it holds ``_SUCCESS``), else build it, read it back."""
    from fraudlake.paths import path_exists

    if not path_exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def page(df: DataFrame, offset: int, limit: int, seq_col: str = "seq", dense: bool = False) -> DataFrame:
    """Stable ``[offset, offset + limit)`` slice by ``seq``.

    With a dense sequence (0..n-1) the slice is a range filter on ``seq``:
    pushed into the scan, no global sort. Otherwise the global order is
    ``orderBy(seq).offset().limit()``.
    """
    if offset < 0:
        raise ValueError("offset must be >= 0")
    if not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"limit must be within 1..{MAX_PAGE}")
    if dense:
        s = F.col(seq_col)
        return df.where((s >= F.lit(offset)) & (s < F.lit(offset + limit)))
    return df.orderBy(seq_col).offset(offset).limit(limit)


def page_response(df: DataFrame, offset: int, limit: int, seq_col: str = "seq", dense: bool = False) -> dict:
    """``{offset, limit, count, data}``: count is the total row count."""
    rows = page(df, offset, limit, seq_col, dense).orderBy(seq_col).collect()
    return {"offset": offset, "limit": limit, "count": df.count(), "data": [r.asDict() for r in rows]}


def read_erasure_requests(spark: SparkSession, path: str) -> DataFrame:
    """A JSON list (or JSON lines) of ``{account_id, request_id}``."""
    return spark.read.schema(ERASURE_REQUEST).option("multiLine", True).json(path)


def erasure_requests_frame(spark: SparkSession, pairs: list[tuple[str, str | None]]) -> DataFrame:
    return spark.createDataFrame(pairs, ERASURE_REQUEST)
