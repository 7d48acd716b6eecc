"""Best-fit packing of tokenised documents into sequences, in bulk-synchronous rounds.

Each round puts the waiting pieces and the gaps (open sequences with room) into
one order by size, range-partitioned, and sweeps it upwards: every piece looks
for its successor, the smallest gap that is large enough. Where several pieces
have one successor, rank decides: the largest of them gets the gap, the others
go on to the next one (a stack in the sweep). What a partition cannot match is
matched across partitions by rank from the counts each partition has left over
(two numbers a partition). Then the gaps shrink, and the next round starts.

A gap is offered as several slots where it holds several pieces of the largest
waiting size, so short pieces need few rounds. Sequences are opened only as far
as a lower bound demands it: for pieces larger than every gap, and for tokens
beyond the room of all gaps.

Cases: a null text counts as empty (its piece is the end id alone); repeated rows
are packed each for itself; equal sizes are told apart by a hash of the row's
number; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.llm.common import saved, shuffle_width, text_slices
from fraudlake.llm.pieces import kept_in_worker, library_bytes

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
SWEPT = "uid long, size int, sequence_id long, room int, slot int, part int, idx long"


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, with_ids: bool = False) -> DataFrame:
    """Tokenise whole texts, append ``end_id`` and cut what is longer than ``capacity``.

    Only the first piece of a document may be shorter than ``capacity``.
    """

    def task(batches):
        encoder = kept_in_worker(f"bytes {tokenizer}", lambda: library_bytes(tokenizer))
        tail = int(end_id).to_bytes(4, "little")
        for batch in batches:
            for part in text_slices(batch):
                ids = [x + tail for x in encoder.encode(part.column("text").to_pylist())]
                n = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
                count = -(-n // capacity)
                doc = np.repeat(np.arange(len(ids)), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                first = (n - 1) % capacity + 1
                start = np.where(piece > 0, first[doc] + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, first[doc])
                if len(doc) == len(ids):
                    cut = ids
                else:
                    cut = [ids[d][4 * lo : 4 * (lo + size)] for d, lo, size in zip(doc.tolist(), start.tolist(), length.tolist(), strict=True)]
                cols = [part.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(list(map(zlib.crc32, cut)), pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array([np.frombuffer(x, "<i4") for x in cut], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.record_batch(cols, names=names)

    return docs.select("doc_id", "text").mapInArrow(task, PIECES + ", ids array<int>" * with_ids)


def _sweep(batches):
    """One partition in ascending order of size, pieces before gaps of their size."""
    part = TaskContext.get().partitionId()
    uids, sizes = [], []  # the stack: pieces that wait for a gap
    left_gaps = 0
    for batch in batches:
        col = {c: batch.column(c).to_pylist() for c in ("uid", "size", "sequence_id", "room", "slot")}
        out = []
        for uid, size, seq, room, slot in zip(*col.values(), strict=True):
            if uid is not None:
                uids.append(uid)
                sizes.append(size)
            elif uids:
                out.append((uids.pop(), sizes.pop(), seq, room, slot, None, None))
            else:
                out.append((None, size, seq, room, slot, part, left_gaps))
                left_gaps += 1
        if out:
            yield _rows(out)
    for lo in range(0, len(uids), 10_000):
        block = zip(uids[lo : lo + 10_000], sizes[lo : lo + 10_000], strict=True)
        yield _rows([(u, s, None, None, None, part, lo + i) for i, (u, s) in enumerate(block)])


def _rows(rows):
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
    names = [c.split()[0] for c in SWEPT.split(", ")]
    return pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def _across(counts: dict[int, list[int]]) -> list[tuple]:
    """Match what partitions left over: runs (run, piece part, first idx, gap part, first idx, length).

    A partition leaves gaps below all pieces it leaves, so its gaps can only take
    pieces of partitions before it: the latest (largest) of those first.
    """
    stack: list[list[int]] = []  # [part, next idx above the run] of pieces, largest on top
    runs: list[tuple] = []
    for part in sorted(counts):
        pieces, gaps = counts[part]
        at = 0
        while at < gaps and stack:
            top = stack[-1]
            n = min(top[1], gaps - at)
            runs.append((len(runs), top[0], top[1] - n, part, at, n))
            top[1] -= n
            at += n
            if not top[1]:
                stack.pop()
        if pieces:
            stack.append([part, pieces])
    return runs


def best_fit(items: DataFrame, capacity: int) -> DataFrame:
    """Places rows (uid, size), 1 <= size <= capacity: (uid, sequence_id, offset)."""
    spark = items.sparkSession
    full = items.where(F.col("size") == capacity).select("uid", (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).alias("offset"))
    waiting = saved(items.where(F.col("size") < capacity).select("uid", F.col("size").cast("int")), "pack-waiting")
    gaps = spark.createDataFrame([], "sequence_id long, room int")
    opened, placed = 0, [full]
    while True:
        w = waiting.agg(F.count("*").alias("n"), F.sum("size").alias("tokens"), F.max("size").alias("largest"), F.min("size").alias("least")).first()
        if not w.n:
            break
        g = gaps.agg(F.count("*").alias("n"), F.sum("room").alias("room"), F.max("room").alias("largest")).first()
        over = waiting.where(F.col("size") > (g.largest or 0)).agg(
            F.sum((F.col("size") * 2 > capacity).cast("long")).alias("halves"), F.sum("size").alias("tokens")
        ).first()
        more = max(over.halves or 0, -(-(over.tokens or 0) // capacity), -(-(w.tokens - (g.room or 0)) // capacity), 0)
        if more:
            fresh = spark.range(opened, opened + more).select(F.col("id").alias("sequence_id"), F.lit(capacity).alias("room"))
            gaps, opened = gaps.unionByName(fresh), opened + more
        # slots: at most a piece's share more than one a gap
        share = -(-w.n // (g.n + more))
        k = F.greatest(F.lit(1), F.least(F.floor(F.col("room") / w.largest), F.lit(share))).cast("int")
        slots = (
            gaps.withColumn("k", k)
            .select("sequence_id", "room", "k", F.explode(F.sequence(F.lit(1), "k")).alias("slot"))
            .withColumn("size", F.when(F.col("slot") < F.col("k"), F.lit(w.largest)).otherwise(F.col("room") - (F.col("k") - 1) * w.largest).cast("int"))
        )
        both = waiting.withColumn("tie", F.xxhash64("uid")).unionByName(
            slots.select("size", "sequence_id", "room", "slot", F.xxhash64("sequence_id", "slot").alias("tie")), allowMissingColumns=True
        ).withColumn("is_gap", F.col("uid").isNull())
        order = ["size", "is_gap", "tie"]
        swept = saved(
            both.repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order)
            .select("uid", "size", "sequence_id", "room", "slot").mapInArrow(_sweep, SWEPT),
            "pack-swept",
        )
        left = swept.where(F.col("part").isNotNull())
        counts: dict[int, list[int]] = {}
        for r in left.groupBy("part", F.col("uid").isNull().alias("gap")).count().collect():  # two rows a partition
            counts.setdefault(r.part, [0, 0])[r.gap] = r["count"]
        runs = spark.createDataFrame(_across(counts), "run int, p_part int, p_lo long, g_part int, g_lo long, n long")
        p_run = runs.select("run", F.col("p_part").alias("part"), F.col("p_lo").alias("lo"), "n")
        g_run = runs.select("run", F.col("g_part").alias("part"), F.col("g_lo").alias("lo"), "n")

        def ranked(rows, run):
            hit = (rows["part"] == run["part"]) & (rows["idx"] >= run["lo"]) & (rows["idx"] < run["lo"] + run["n"])
            return rows.join(F.broadcast(run), hit, "left").select(rows["*"], "run", (F.col("idx") - F.col("lo")).alias("rank"))

        pieces = ranked(left.where("uid is not null"), p_run)
        spare = ranked(left.where("uid is null"), g_run).where("run is not null").select("run", "rank", "sequence_id", "room", "slot")
        far = pieces.where("run is not null").select("uid", "size", "run", "rank").join(spare, ["run", "rank"])
        matched = swept.where("part is null").select("uid", "size", "sequence_id", "room", "slot").unionByName(far.drop("run", "rank"))
        before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
        done = saved(
            matched.select(
                "uid", "size", "sequence_id",
                (capacity - F.col("room") + F.coalesce(F.sum("size").over(before), F.lit(0))).cast("int").alias("offset"),
            ),
            "pack-placed",
        )
        placed.append(done.select("uid", "sequence_id", "offset"))
        used = done.groupBy("sequence_id").agg(F.sum("size").alias("used"))
        room = (F.col("room") - F.coalesce("used", F.lit(0))).cast("int")
        gaps = saved(gaps.join(used, "sequence_id", "left").select("sequence_id", room.alias("room")).where(F.col("room") >= w.least), "pack-gaps")
        waiting = saved(pieces.where("run is null").select("uid", "size"), "pack-waiting")
    out = placed[0]
    for p in placed[1:]:
        out = out.unionByName(p)
    return out


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 1024, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with ``sequence_id`` and ``offset`` (gapless from 0 in each sequence)."""
    pieces = saved(cut_pieces(docs, tokenizer, end_id, capacity, with_ids).withColumn("uid", F.monotonically_increasing_id()), "pack-pieces")
    places = best_fit(pieces.select("uid", F.col("length").alias("size")), capacity)
    out = pieces.join(places, "uid").drop("uid").withColumn("offset", F.col("offset").cast("long"))
    first = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return out.select(*first, *["ids"] * with_ids)
