"""Importance resampling towards a target distribution of hashed n-grams.

Two sets of texts give two distributions over buckets: the documents and the target
texts. Separators collapse to single spaces; an overlapped regex scan with boundary
lookarounds then gives, at every word, the spans of the runs that start there, and the
CRC of each span names its bucket. A text is scanned once: its buckets are written
with its row, both counts and weights read them from there. A document's weight is the
floored mean of its buckets' gains, its score adds Gumbel noise drawn from a hash of
doc_id, and the highest scores are drawn. Ranks come from one range-partitioned order
of small rows with a count per partition, not from a window over all of them.

Words are runs of digits, a-z (A-Z lower-cased) and characters from U+0080 on.

Cases: null and empty texts, and texts without words, have no features and weight 0;
very long texts are scanned whole; target texts may be null or repeat (they count each
time); an empty target has gains from the smoothing alone; rows with one doc_id share
its noise, and rows without doc_id draw theirs from their text; ties go to the smaller
doc_id (null first), then to any order of equal rows; repeated rows count and are drawn
each for itself; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake.llm.common import offsets_of, saved, text_slices

BUCKETS = 10_000
#: Bytes of bucket numbers that a task looks at in one step.
SLICE = 4_000_000
#: Lower-cased text byte -> itself where it belongs to a word, else a space.
WORD_BYTES = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else 32 for b in range(256))
SCANNED = "doc_id long, noise_key string, buckets binary"


def collapse(text: str | None) -> bytes:
    """UTF-8 text in lower case (A-Z only) with single spaces between its words."""
    return b" ".join((text or "").encode().lower().translate(WORD_BYTES).split())


def run_pattern(longest: int):
    """The run of up to ``longest`` words at a word's start; group i ends behind word i."""
    import regex

    more = b""
    for _ in range(longest - 1):
        more = rb"(?:( [^ ]++)" + more + rb")?"
    return regex.compile(rb"(?<![^ ])([^ ]++)" + more + rb"(?![^ ])")


def bucket_numbers(text: str | None, pattern, longest: int, buckets: int) -> list[int]:
    """Buckets of all runs of 1 to ``longest`` words, repeats included."""
    data = collapse(text)
    out, crc = [], zlib.crc32
    for m in pattern.finditer(data, overlapped=True):
        value = 0
        for group in range(1, longest + 1):
            lo, hi = m.span(group)
            if lo < 0:
                break
            value = crc(data[lo:hi], value)
            out.append(value % buckets)
    return out


def number_type(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def scan(rows: DataFrame, longest: int = 2, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, noise_key, buckets) of rows (doc_id, noise_key, text); buckets are unsigned numbers of :func:`number_type`."""

    def task(batches):
        pattern, kind = run_pattern(longest), number_type(buckets)
        for batch in batches:
            for part in text_slices(batch):
                found = [np.array(bucket_numbers(t, pattern, longest, buckets), dtype=kind).tobytes() for t in part.column("text").to_pylist()]
                yield pa.record_batch([part.column("doc_id"), part.column("noise_key"), pa.array(found, pa.binary())], names=["doc_id", "noise_key", "buckets"])

    return rows.select("doc_id", "noise_key", "text").mapInArrow(task, SCANNED)


def _flat(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """All bucket numbers of a binary column and the offsets of its rows."""
    kind = np.dtype(number_type(buckets))
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind), offsets_of(np.array([len(r) // kind.itemsize for r in rows], dtype=np.int64))


def count_buckets(scanned: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows (at most ``buckets`` rows reach the driver)."""

    def task(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in text_slices(batch, "buckets", SLICE):
                total += np.bincount(_flat(part.column("buckets"), buckets)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in scanned.select("buckets").mapInArrow(task, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed ratio of target to raw) of each bucket."""
    size = len(raw)
    s_all, t_all = int(raw.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((int(t) + 1) * (s_all + size) / ((int(s) + 1) * (t_all + size)))) for s, t in zip(raw, target, strict=True)], dtype=np.int64)


def weigh(scanned: DataFrame, gains: np.ndarray) -> DataFrame:
    """(doc_id, noise_key, n_features, weight)."""

    def task(batches):
        for batch in batches:
            for part in text_slices(batch, "buckets", SLICE):
                flat, at = _flat(part.column("buckets"), len(gains))
                sums = offsets_of(gains[flat])
                n = np.diff(at)
                weight = np.where(n > 0, (sums[at[1:]] - sums[at[:-1]]) // np.maximum(n, 1), 0)
                cols = [part.column("doc_id"), part.column("noise_key"), pa.array(n, pa.int64()), pa.array(weight, pa.int64())]
                yield pa.record_batch(cols, names=["doc_id", "noise_key", "n_features", "weight"])

    return scanned.mapInArrow(task, "doc_id long, noise_key string, n_features long, weight long")


def noise(key: str = "noise_key", seed: int = 7):
    """Gumbel noise in thousandths from the first 8 hex digits of sha256(``seed:key``)."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key)), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def draw(scored: DataFrame, percent: int, least_features: int) -> DataFrame:
    """``scored`` (doc_id, n_features, weight, score) with ``rank`` of the drawn rows.

    Of the N rows with ``least_features`` features, floor(percent N / 100) are drawn.
    A written row number makes all sort keys different, so equal rows may lie in
    different partitions; a row's place is its partition's offset and its place inside.
    """
    able = F.col("n_features") >= least_features
    rows = saved(scored.withColumns({"able": able, "row": F.monotonically_increasing_id()}), "target-scored")
    k = rows.where("able").count() * percent // 100
    order = [F.col("able").desc(), F.col("score").desc(), F.col("doc_id").asc(), F.col("row").asc()]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    placed = saved(placed, "target-order")
    part = F.shiftright("place", 33).alias("part")
    sizes = {r.part: r.n for r in placed.groupBy(part).agg(F.count("*").alias("n")).collect()}  # a row a partition
    before, steps = 0, []
    for p in sorted(sizes):
        steps.append((p, before))
        before += sizes[p]
    starts = F.broadcast(scored.sparkSession.createDataFrame(steps, "part long, before long"))  # a row a partition
    rank = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    joined = placed.withColumn("part", F.shiftright("place", 33)).join(starts, "part", "left")
    return joined.select("doc_id", "n_features", "weight", "score", F.when(F.col("able") & (rank <= k), rank).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, longest: int = 2, buckets: int = BUCKETS, seed: int = 7) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; ``target`` has a text column."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.sha2(F.coalesce("text", F.lit("")), 256))
    scanned = saved(scan(docs.select("doc_id", key.alias("noise_key"), "text"), longest, buckets), "target-buckets")
    goal = scan(target.select(F.lit(None).cast("long").alias("doc_id"), F.lit("").alias("noise_key"), "text"), longest, buckets)
    gains = bucket_gains(count_buckets(scanned, buckets), count_buckets(goal, buckets))
    scored = weigh(scanned, gains).withColumn("score", F.col("weight") + noise(seed=seed)).drop("noise_key")
    least = sum(max(0, least_words - n) for n in range(longest))  # features of a text of that many words
    return draw(scored, percent, least)
