"""Quality filter by importance resampling.

Two generative models over hashed n-grams (single tokens and token pairs; runs
of letters and digits, and runs of marks, are tokens) are estimated: the raw
model from all documents, the target model from documents labelled good. A
document's log importance weight is the log ratio of the two models over its
n-grams; a token that follows itself counts as the one pair "repeat", whatever the
token. Documents are drawn without replacement in proportion to their weights
by Gumbel top-k: the ``k`` largest sums of log weight and Gumbel noise stay. The
noise is a hash of doc_id, text, the row's number in the scan and a seed: rows that share
an id, or have none, draw for themselves, and a repeated run over the same files draws
the same.

``k`` is either given as a share of the documents or estimated: the number of
documents whose weight passes the cut that separates good from bad labelled
documents best. The k-th largest key is found by counting keys in bins,
finer in each pass; keys equal to it all stay.

Cases: null and empty texts have no n-grams and weight 0, and never stay; very long
texts count whole; rows without doc_id have no label and are drawn like others; labels
may lack documents and may repeat (the lowest one counts); null labels are left
out; without both kinds of labels all documents that have n-grams stay; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from fraudlake.llm.common import free_name, saved, text_slices
from fraudlake.llm.words import BASE, letter_table, mix, word_hashes, words_of

REPEAT = mix(np.array([1], dtype=np.uint64))


def _features(texts: pa.Array, table: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every token and every pair of adjacent tokens."""
    w = words_of(texts, table, lower=False)
    h = word_hashes(w)
    row = np.repeat(np.arange(len(texts)), np.diff(w.first))
    shift = np.uint64(64 - bits)
    if len(h) < 2:
        return (h >> shift).astype(np.int64), row
    inside = row[1:] == row[:-1]
    pair = np.where(h[:-1] == h[1:], REPEAT, mix(h[:-1] * BASE + h[1:]))[inside]
    return (np.concatenate([h, pair]) >> shift).astype(np.int64), np.concatenate([row, row[:-1][inside]])


def labelled(docs: DataFrame, labels: DataFrame, max_labels: int, name: str) -> DataFrame:
    """``docs`` with column ``name`` from a bounded sample of ``labels`` (doc_id, label): the ``max_labels`` smallest hashes."""
    one = labels.where("label is not null and doc_id is not null").groupBy("doc_id").agg(F.min("label").cast("int").alias(name))
    sample = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels)
    return docs.join(F.broadcast(sample), "doc_id", "left").select(*docs.columns, name)


def count_models(rows: DataFrame, label: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of each bucket over all documents and over those labelled 1 (two arrays of 2**bits)."""

    def task(batches):
        table, size = letter_table(digits=True, marks=True), 1 << bits
        raw, good = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            for part in text_slices(batch):
                bucket, row = _features(part.column("text"), table, bits)
                known = part.column(label).fill_null(0).to_numpy(zero_copy_only=False)
                raw += np.bincount(bucket, minlength=size)
                good += np.bincount(bucket[known[row] == 1], minlength=size)
        at = np.flatnonzero(raw)
        yield pa.record_batch([pa.array(at, pa.int32()), pa.array(raw[at]), pa.array(good[at])], names=["bucket", "raw", "good"])

    parts = rows.select("text", label).mapInArrow(task, "bucket int, raw long, good long")
    raw, good = np.zeros(1 << bits), np.zeros(1 << bits)
    for r in parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).collect():  # 2**bits rows at most
        raw[r.bucket], good[r.bucket] = r.raw, r.good
    return raw, good


def log_ratio(raw: np.ndarray, good: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    p = (good + smooth) / (good.sum() + smooth * len(good))
    q = (raw + smooth) / (raw.sum() + smooth * len(raw))
    return np.log(p) - np.log(q)


def weigh(rows: DataFrame, columns: list[str], ratio: np.ndarray, bits: int, names: tuple[str, str]) -> DataFrame:
    """``columns`` of every row, with the number of n-grams and the log weight under ``names``."""
    added = [StructField(names[0], LongType()), StructField(names[1], DoubleType())]

    def task(batches):
        table = letter_table(digits=True, marks=True)
        for batch in batches:
            for part in text_slices(batch):
                bucket, row = _features(part.column("text"), table, bits)
                n = np.bincount(row, minlength=part.num_rows)
                weight = np.bincount(row, weights=ratio[bucket], minlength=part.num_rows)
                yield pa.record_batch([part.column(c) for c in columns] + [pa.array(n), pa.array(weight.astype(np.float64))], names=[*columns, *names])

    return rows.select(*dict.fromkeys([*columns, "text"])).mapInArrow(task, StructType([rows.schema[c] for c in columns] + added))


def best_cut(values: np.ndarray, good: np.ndarray) -> float | None:
    """The cut of ``values`` with the largest sum of both classes' shares on their side."""
    if not good.any() or good.all():
        return None
    order = np.argsort(values, kind="stable")
    v, g = values[order], good[order]
    above_good = 1 - np.concatenate([[0], np.cumsum(g)]) / g.sum()
    below_bad = np.concatenate([[0], np.cumsum(~g)]) / (~g).sum()
    gain = above_good + below_bad
    gain[1:-1][v[1:] == v[:-1]] = -1  # no cut between equal values
    i = int(np.argmax(gain))
    if i in (0, len(v)):
        return float(v[0] if i == 0 else v[-1] + 1)
    return float((v[i - 1] + v[i]) / 2)


def kth_largest(rows: DataFrame, column: str, k: int, bins: int = 4096) -> float:
    """The k-th largest value of a column without nulls, by counts in ever finer bins."""
    lo, hi = rows.agg(F.min(column), F.max(column)).first()
    rest = k
    while lo < hi:
        width = (hi - lo) / bins
        if width == 0 or lo + width == lo:
            return lo
        at = F.least(F.floor((F.col(column) - lo) / width), F.lit(bins - 1)).alias("bin")
        inside = rows.where(F.col(column).between(lo, hi))
        found = inside.groupBy(at).agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).collect()
        for b in sorted(found, key=lambda r: -r.bin):
            if rest <= b.n:
                lo, hi = b.lo, b.hi
                break
            rest -= b.n
    return lo


def gumbel(drawn: str):
    """Standard Gumbel noise from a 64-bit hash."""
    u = (F.shiftrightunsigned(F.col(drawn), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def _drawn(docs: DataFrame, columns: list[str], labels: DataFrame, share: float | None, bits: int, seed: int, max_labels: int) -> tuple[DataFrame, list[str]]:
    """``columns`` of the rows with the working columns (label, n_grams, log_weight, gumbel_key, kept), and their names."""
    label, n_grams, weight, key, kept = names = [free_name(docs, c) for c in ("label", "n_grams", "log_weight", "gumbel_key", "kept")]
    drawn = free_name(docs, "drawn")
    rows = labelled(docs.withColumn(drawn, F.xxhash64("doc_id", "text", F.monotonically_increasing_id(), F.lit(seed))), labels, max_labels, label)
    raw, good = count_models(rows, label, bits)
    scored = weigh(rows, [*columns, label, drawn], log_ratio(raw, good), bits, (n_grams, weight))
    scored = saved(scored.withColumn(key, F.when(F.col(n_grams) > 0, F.col(weight) + gumbel(drawn))).drop(drawn), "resample")
    able = scored.where(F.col(key).isNotNull())
    total = able.count()
    if share is not None:
        k = math.ceil(share * total)
    else:
        one = able.where(F.col(label).isNotNull()).groupBy("doc_id").agg(F.min(weight).alias(weight), F.min(label).alias(label))
        known = one.select(weight, label).toPandas()  # a row a labelled doc_id: max_labels at most
        cut = best_cut(known[weight].to_numpy(), known[label].to_numpy() == 1)
        k = total if cut is None else able.where(F.col(weight) >= cut).count()
    stays = F.lit(False) if k <= 0 or not total else F.coalesce(F.col(key) >= kth_largest(able, key, min(k, total)), F.lit(False))
    return scored.withColumn(kept, stays), names


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, bits: int = 14, seed: int = 1, max_labels: int = 50_000) -> DataFrame:
    """(doc_id, n_grams, log_weight, gumbel_key, kept) of every document.

    ``labels``: doc_id and label (1 good, 0 bad); at most ``max_labels`` of them are read.
    """
    rows, _ = _drawn(docs.select("doc_id", "text"), ["doc_id"], labels, share, bits, seed, max_labels)
    return rows.drop("label")


def accepted(docs: DataFrame, labels: DataFrame, share: float | None = None, bits: int = 14, seed: int = 1, max_labels: int = 50_000) -> DataFrame:
    """The drawn rows of ``docs``, all columns."""
    rows, names = _drawn(docs, docs.columns, labels, share, bits, seed, max_labels)
    return rows.where(names[-1]).drop(*names)
