"""Hard negatives by a vertical scan of dimensions in each anchor's own order.

Vectors become integers, floor(scale x). Rows and anchors are dealt into blocks; a
pair of an anchor block and a row block is one unit of work. In a unit the rows lie in
vertical layout, a row of the matrix a dimension. An anchor reads the dimensions in
descending magnitude of its own components. What the dimensions not yet read can add
to a score lies between two sums: of the least and of the greatest product of the
anchor's component with the block's minimum and maximum of that dimension. These
bounds shrink a bitmap of candidates:

* positives (same label): a row goes when its upper bound is below the k-th best lower
  bound, or below the floor that an earlier pass has found;
* negatives (another label): each positive opens a window of scores. A row goes when its
  bounds lie outside every window, or when for each window it reaches there are enough
  rows certainly inside it with lower bounds above the row's upper bound (or above the
  floor that an earlier pass has found).

Survivors are compacted after each group of dimensions; what remains is scored whole
and read off window by window. Bounds cross units: first each anchor meets one block
only, whose k-th best scores are floors for the pass over all blocks.

Cases: rows with a null label or vector, or with null or non-finite components, or a
null vec_id take no part; equal rows (vec_id, label, vector) count once; rows that share
a vec_id but differ are rows of their own, and none of them is a partner of another;
missing dimensions count as 0; ties go to the smaller vec_id, then to a hash of the row;
an anchor without positives, or whose windows are empty, has no rows in the result; scores
beyond 64 bits are held at the bounds of a long before they are compared (blocks with
such numbers are scored in Python's integers, without bounds); an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.llm.common import saved, shuffle_width

EXACT = float(1 << 52)
LEAST, MOST = -(1 << 63), (1 << 63) - 1
FOUND = "anchor_id long, anchor_row long, window int, vec_id long, row long, score long"


def labelled_vectors(rows: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, v, row) of the rows that take part: ``v`` whole numbers as doubles, ``row`` a hash of the row."""

    def whole(x):
        y = x.cast("double") * scale
        return F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)  # larger doubles are whole

    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    able = rows.where("vec_id is not null and label is not null and embedding is not null").where(fine)
    able = able.select("vec_id", "label", F.transform("embedding", whole).alias("v")).distinct()
    return able.withColumn("row", F.xxhash64("vec_id", "label", "v"))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column as a matrix, shorter rows filled with zeros."""
    col = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = col.value_lengths().to_numpy(zero_copy_only=False)
    flat = col.flatten().to_numpy(zero_copy_only=False)
    wide = int(lengths.max(initial=0))
    if len(flat) == len(lengths) * wide:
        return flat.reshape(len(lengths), wide)
    out = np.zeros((len(lengths), wide))
    out[np.arange(wide) < lengths[:, None]] = flat
    return out


def _ordered(score: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return np.lexsort((keys, ids, -score))


def _kth(values: np.ndarray, k: int) -> float:
    """The k-th largest value, or minus infinity where there are fewer."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


class Unit:
    """Rows of one block in vertical layout, with the range of each dimension."""

    def __init__(self, cand: np.ndarray, step: int):
        self.tall = np.ascontiguousarray(cand.T)
        self.low, self.high = cand.min(axis=0), cand.max(axis=0)
        self.step = step

    def scan(self, q: np.ndarray, live: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the rows of the bitmap that ``keep(lower, upper)`` leaves to the end."""
        order = np.argsort(-np.abs(q), kind="stable")
        ends = q * self.low, q * self.high
        rest_low = np.concatenate([np.cumsum(np.minimum(*ends)[order][::-1])[::-1], [0]])
        rest_high = np.concatenate([np.cumsum(np.maximum(*ends)[order][::-1])[::-1], [0]])
        at = np.flatnonzero(live)
        part = np.zeros(len(at))
        for lo in range(0, len(order), self.step):
            dims = order[lo : lo + self.step]
            whole = len(at) == self.tall.shape[1]
            part = part + q[dims] @ (self.tall[dims] if whole else self.tall[np.ix_(dims, at)])
            done = min(lo + self.step, len(order))
            stays = keep(part + rest_low[done], part + rest_high[done])
            if not stays.all():
                at, part = at[stays], part[stays]
            if not len(at):
                break
        return at, part


def best_positives(unit: Unit, q, live, floor: float, k: int):
    """(rows, scores) among which the unit's ``k`` best rows of the bitmap at or above ``floor`` are."""
    return unit.scan(q, live, lambda lower, upper: upper >= max(floor, _kth(lower, k)))


def window_rows(unit: Unit, q, live, windows, k: int):
    """(rows, scores) that hold the unit's first ``k`` rows of every window (low, high, floor)."""

    def keep(lower, upper):
        stays = np.zeros(len(lower), dtype=bool)
        for low, high, floor in windows:
            sure = lower[(lower >= low) & (upper <= high)]  # rows that are certainly inside
            stays |= (upper >= max(low, floor, _kth(sure, k))) & (lower <= high)
        return stays

    return unit.scan(q, live, keep)


def exact_scores(q: np.ndarray, cand: np.ndarray) -> np.ndarray:
    """Scores of numbers beyond the exact range of doubles, held at the bounds of a long."""
    whole = [int(x) for x in q]
    return np.array([max(LEAST, min(MOST, sum(a * int(b) for a, b in zip(whole, r, strict=True)))) for r in cand], dtype=object)


def score_window(positive: int, low: int, high: int) -> tuple[int, int]:
    """Whole scores s with low * positive <= 100 s <= high * positive."""
    return -(-low * positive // 100), high * positive // 100


def _solver(k: int, step: int, negatives: bool, low: int, high: int):
    """applyInArrow function of a unit: rows with ``asks`` are its anchors, the others its block."""

    def solve(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        ids, keys, labels = (table.column(c).to_numpy() for c in ("vec_id", "row", "label"))
        out = []
        if asks.any() and not asks.all():
            m = matrix(table.column("v"))
            cand, c_ids, c_keys, c_labels = m[~asks], ids[~asks], keys[~asks], labels[~asks]
            norm = np.sqrt((m * m).sum(axis=1))
            exact = norm[asks].max() * norm[~asks].max() * 100 < EXACT
            unit = Unit(cand, step)
            bounds = table.column("bounds").take(pa.array(np.flatnonzero(asks))).to_pylist()
            for q, i, key, label, limits in zip(m[asks], ids[asks].tolist(), keys[asks].tolist(), labels[asks].tolist(), bounds, strict=True):
                other = c_ids != i
                if negatives:
                    live = other & (c_labels != label)
                    windows = [(*score_window(b["score"], low, high), b["floor"]) for b in limits]
                else:
                    live = other & (c_labels == label)
                    windows = [(LEAST, MOST, limits[0]["floor"] if limits else None)]
                if not live.any() or not windows:
                    continue
                floors = [(lo, hi, LEAST if f is None else f) for lo, hi, f in windows]
                if not exact:
                    at = np.flatnonzero(live)
                    score = exact_scores(q, cand[at])
                elif negatives:
                    at, score = window_rows(unit, q, live, floors, k)
                else:
                    at, score = best_positives(unit, q, live, floors[0][2], k)
                order = _ordered(score, c_ids[at], c_keys[at])
                at, score = at[order], score[order]
                for w, (lo, hi, floor) in enumerate(floors):
                    inside = np.flatnonzero((score >= max(lo, floor)) & (score <= hi))[:k]
                    out += [(i, key, w, int(c_ids[at[j]]), int(c_keys[at[j]]), int(score[j])) for j in inside]
        cols = list(zip(*out, strict=True)) or [[]] * 6
        names = [c.split()[0] for c in FOUND.split(", ")]
        return pa.table([pa.array(list(c), pa.int32() if n == "window" else pa.int64()) for c, n in zip(cols, names, strict=True)], names=names)

    return solve


BOUNDS = "array<struct<score:long,floor:long>>"


def _meet(v: DataFrame, anchors: DataFrame, cols: int, lines: int, first_only: bool, solve) -> DataFrame:
    """Rows found when every anchor meets every block, or one block only."""
    spread = lambda c, parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias(c)
    place = lambda c, parts: F.pmod("row", F.lit(parts)).cast("int").alias(c)
    carried = ["vec_id", "label", "v", "row"]
    asks = anchors.select(place("line", lines), F.lit(True).alias("asks"), *carried, "bounds")
    if first_only:  # the anchors of a line meet the block of the line's number
        served = F.filter(F.sequence(F.lit(0), F.lit(lines - 1)), lambda x: F.pmod(x, F.lit(cols)) == F.pmod("row", F.lit(cols)))
        cand = v.select(F.explode(served).alias("line"), place("col", cols), F.lit(False).alias("asks"), *carried)
        asks = asks.withColumn("col", F.pmod("line", F.lit(cols)).cast("int"))
    else:
        cand = v.select(spread("line", lines), place("col", cols), F.lit(False).alias("asks"), *carried)
        asks = asks.select("*", spread("col", cols))
    units = cand.withColumn("bounds", F.lit(None).cast(BOUNDS)).unionByName(asks)
    return units.repartition(shuffle_width(v.sparkSession), "line", "col").groupBy("line", "col").applyInArrow(solve, FOUND)


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows of each window over all units, with their rank."""
    order = Window.partitionBy("anchor_id", "anchor_row", "window").orderBy(F.col("score").desc(), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _floors(found: DataFrame, k: int) -> DataFrame:
    """Score of the k-th row of each window that has so many."""
    return _first(found, k).where(F.col("rank") == k).select("anchor_id", "anchor_row", "window", F.col("score").alias("floor"))


def mine(
    rows: DataFrame, anchors: str = "vec_id % 100 = 0", positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    scale: int = 256, block: int = 8192, anchor_block: int = 2048, step: int = 8,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows``: vec_id, embedding, label. For each anchor its first ``positives`` rows of the
    same label; for each of those the first ``negatives`` rows of another label with
    low * positive_score <= 100 * negative_score <= high * positive_score.
    """
    v = saved(labelled_vectors(rows, scale), "labelled-vectors")
    asked = v.where(anchors)
    n, m = v.count(), asked.count()
    cols, lines = max(1, -(-n // block)), max(1, -(-m // anchor_block))
    many = cols > 1  # with one block the first pass is the whole pass
    of_anchor = ["anchor_id", "anchor_row"]
    on = [F.col("vec_id") == F.col("anchor_id"), F.col("row") == F.col("anchor_row")]

    plain = asked.withColumn("bounds", F.lit(None).cast(BOUNDS))
    solve = _solver(positives, step, False, low, high)
    if many:
        floors = _floors(_meet(v, plain, cols, lines, True, solve), positives)
        with_floor = floors.select(*of_anchor, F.array(F.struct(F.lit(None).cast("long").alias("score"), "floor")).alias("bounds"))
        plain = asked.join(with_floor, on, "left").drop(*of_anchor)
    best = saved(_first(_meet(v, plain, cols, lines, False, solve), positives), "positives")
    # ``window`` counts from 0 in the order of the positives of an anchor, as _solver numbers them
    best = best.select(*of_anchor, (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))

    def with_windows(floors: DataFrame | None) -> DataFrame:
        one = best.withColumn("floor", F.lit(None).cast("long")) if floors is None else best.join(floors, [*of_anchor, "window"], "left")
        listed = one.groupBy(*of_anchor).agg(F.sort_array(F.collect_list(F.struct("window", F.col("positive_score").alias("score"), "floor"))).alias("b"))  # at most ``positives`` a group
        listed = listed.select(*of_anchor, F.transform("b", lambda b: F.struct(b["score"].alias("score"), b["floor"].alias("floor"))).alias("bounds"))
        return asked.join(listed, on, "inner").drop(*of_anchor)

    solve = _solver(negatives, step, True, low, high)
    floors = _floors(_meet(v, with_windows(None), cols, lines, True, solve), negatives) if many else None
    found = _first(_meet(v, with_windows(floors), cols, lines, False, solve), negatives)
    joined = found.join(best, [*of_anchor, "window"])
    return joined.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
