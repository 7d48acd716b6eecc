"""Bottom-k sketches of word shingles, in DataFrame functions only.

A text's shingles are its runs of five words (what white space separates; a text
of one to four words has one shingle, of all of them). The sketch is the ``K``
smallest distinct 40-bit hashes of the shingles, ascending. Sketches of parts merge
into the sketch of the whole, and estimate resemblance, containment and the number
of distinct shingles; below ``K`` shingles these are exact.

Cases: a null text counts as empty and has an empty sketch; two empty sketches have
resemblance and containment 1, an empty and a full one 0; rows with a null doc_id
come after all others; rows with one doc_id follow one another by hash of text; very
long texts are sketched whole; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.llm.common import saved, shuffle_width

K = 128
WORDS = 5
RANGE = float(1 << 40)
LAST = -(1 << 63)


def smallest(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = K) -> Column:
    """array<long>: the bottom-k sketch of a text."""

    def hashes(words: Column) -> Column:
        runs = F.sequence(F.lit(0), F.greatest(F.size(words) - WORDS, F.lit(0)))
        # words behind the end are null, which a hash passes over
        shingle = lambda i: F.shiftrightunsigned(F.xxhash64(*[F.get(words, i + j) for j in range(WORDS)]), 24)
        return F.when(F.size(words) > 0, smallest(F.transform(runs, shingle), k)).otherwise(F.expr("array()").cast("array<bigint>"))

    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"\s+"), "")
    return F.transform(F.array(words), hashes)[0]  # binds the words, so they are split once


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: the share of the union's sketch that both have."""

    def share(u: Column) -> Column:
        both = F.size(F.array_intersect(F.array_intersect(u, a), b))
        return F.when(F.size(u) == 0, 1.0).otherwise(both / F.size(u))

    return F.transform(F.array(merge(a, b, k)), share)[0]


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) * RANGE / (F.element_at(a, -1) + 1))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too."""
    union = distinct_shingles(merge(a, b, k), k)
    share = resemblance(a, b, k) * union / distinct_shingles(a, k)
    return F.when(F.size(a) == 0, F.when(F.size(b) == 0, 1.0).otherwise(0.0)).otherwise(F.least(share, F.lit(1.0)))


def as_string(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda h: F.hex(h)), ",")


def merge_parts(parts: DataFrame, key: str, column: str = "sketch", k: int = K, fan: int = 16) -> DataFrame:
    """One sketch a key from the sketches of its parts, about ``fan`` of them at a time."""
    rows = parts.select(F.col(key), F.col(column).alias("sketch"))
    most = rows.groupBy(key).count().agg(F.max("count")).first()[0] or 0
    while True:
        most = -(-most // fan)
        salt = F.pmod(F.xxhash64("sketch", F.rand(7)), F.lit(max(1, most)))
        one = rows.withColumn("salt", salt).groupBy(key, "salt").agg(smallest(F.flatten(F.collect_list("sketch")), k).alias("sketch"))
        rows = saved(one.drop("salt"), "sketch-parts")
        if most <= 1:
            return rows


def _blocks(cuts: list[int]) -> tuple[Column, int]:
    """The block of a row by its key and salt, ascending against the order of rows, and the number of blocks.

    A cut that repeats is a hot key: its rows get a block a repeat, by ranges of the salt.
    """
    times = Counter(cuts)
    values, bases, n = sorted(times), [], 0
    for v in values:
        bases.append(n)
        n += 1 if times[v] == 1 else 1 + times[v]
    bounds = F.array(*[F.lit(v) for v in values])
    at = F.least(F.size(F.filter(bounds, lambda b: b < F.col("key"))), F.lit(len(values) - 1)) + 1
    parts = F.element_at(F.array(*[F.lit(times[v]) for v in values]), at)
    hot = (parts > 1) & (F.element_at(bounds, at) == F.col("key"))
    part = F.least(F.floor((F.col("salt") / 2.0**64 + 0.5) * parts), parts - 1)
    block = F.element_at(F.array(*[F.lit(b) for b in bases]), at) + F.when(hot, parts - part).otherwise(0)
    return block.cast("int"), n


def with_next(rows: DataFrame, columns: list[str], blocks: int | None = None) -> DataFrame:
    """``rows`` with ``next_<column>`` of the row behind it in descending doc_id, the first row behind the last.

    Rows are dealt into blocks of doc_id by quantiles, those of one hot doc_id by hash of
    text; the first row of each block is copied to the end of the block above it, so no
    window reaches over a block. Rows equal in doc_id and text share a block.
    """
    spark = rows.sparkSession
    n = blocks or 4 * shuffle_width(spark)
    keyed = rows.withColumns({"key": F.coalesce("doc_id", F.lit(LAST)), "salt": F.xxhash64("text")})
    cuts = keyed.agg(F.percentile_approx("key", [i / n for i in range(1, n + 1)], 100 * n)).first()[0]  # n numbers
    if cuts is None:
        return rows.select("*", *(F.col(c).alias(f"next_{c}") for c in columns))
    block, _ = _blocks(cuts)
    keyed = keyed.withColumn("block", block)
    first = F.max(F.struct("key", F.bitwise_not("salt").alias("salt"))).alias("first")
    heads = sorted(keyed.groupBy("block").agg(first).collect())  # 2n rows at most
    above = [h.block for h in heads[1:]] + [heads[0].block]
    table = spark.createDataFrame([(h.block, u, *h.first) for h, u in zip(heads, above, strict=True)], "block int, above int, head_key long, head_salt long")
    here = F.struct("block", F.lit(False).alias("copy"))
    there = F.struct(F.col("above").alias("block"), F.lit(True).alias("copy"))
    head = (F.col("key") == F.col("head_key")) & (F.bitwise_not("salt") == F.col("head_salt"))
    dealt = keyed.join(F.broadcast(table), "block").withColumn("at", F.explode(F.when(head, F.array(here, there)).otherwise(F.array(here))))
    order = Window.partitionBy("at.block").orderBy("at.copy", F.col("key").desc(), "salt")
    ahead = dealt.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
    return ahead.where("NOT at.copy").select(*rows.columns, *(f"next_{c}" for c in columns))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, whose last half comes from the next text.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, shingles,
    kept_in_edited, shingles_with_next): also the share of the text's shingles that the edited form keeps, and the
    distinct shingles of the text and the next one together (their merged sketch).
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("sketch", sketch(F.col("text")))
    rows = with_next(rows, ["text", "sketch"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "sketch", "next_sketch", edited.alias("edited"))
    rows = rows.withColumn("edited_sketch", sketch(F.col("edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_string(F.col("sketch")).alias("fingerprint"), as_string(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        distinct_shingles(F.col("sketch")).alias("shingles"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("kept_in_edited"),
        distinct_shingles(merge(F.col("sketch"), F.col("next_sketch"))).alias("shingles_with_next"),
    )
