"""Exact top-k inner products by branch and bound over blocks of dimensions.

Vectors become integers, floor(1024 x). Candidates and queries are dealt into
blocks; each pair of a query block and a candidate block is one unit of work.
In a unit the candidates lie in vertical layout (a row a dimension, the heaviest
first). Scores are accumulated a block of dimensions at a time; what the rest can
add is bounded by the product of the two remaining masses (Cauchy-Schwarz).
A candidate whose upper bound is below the k-th best lower bound, or below the
query's floor, is dropped, and the survivors are compacted before the next block.
Floors cross units: first each query meets one block only, whose k-th best score is
its floor in the pass over all blocks. Each unit gives at most k rows a query; a
window over those takes the best. A block holds as many vectors as ``SIDE_BYTES``
allow, so a vector is copied once per 32 MB of vectors of the other side.

Cases: vectors that are null, or hold null or non-finite components, and rows with a
null vec_id take no part; equal rows count once; a row is never a candidate of a query
with its own vec_id; missing dimensions count as 0; ties go to the smaller vec_id;
scores beyond 64 bits are held at the bounds of a long; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.llm.common import saved, shuffle_width
from fraudlake.llm.hard_negatives import matrix

SIDE_BYTES = 32 << 20
CHUNK = 1 << 21  # scores held at once in a unit
LEAST, MOST = -(1 << 63), (1 << 63) - 1
HITS = "query_id long, vec_id long, score long"
EXACT = float(1 << 52)


def integer_vectors(rows: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, v array<double> of whole numbers) of the vectors that take part."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    big = F.transform("embedding", lambda x: F.when(F.abs(x.cast("double") * scale) < 2.0**62, F.floor(x.cast("double") * scale).cast("double")).otherwise(x.cast("double") * scale))
    whole = F.when(F.exists("embedding", lambda x: F.abs(x.cast("double") * scale) >= 2.0**62), big).otherwise(v)
    return rows.where("vec_id is not null and embedding is not null").where(fine).select("vec_id", whole.alias("v")).distinct()


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -score))[:k]


def unit_top_k(query: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, cand: np.ndarray, ids: np.ndarray, k: int, step: int):
    """Rows (query_id, vec_id, score) of one unit at or above each query's floor; ``query`` and ``cand`` hold whole numbers."""
    order = np.argsort(-(cand * cand).sum(axis=0), kind="stable")
    tall, query = np.ascontiguousarray(cand[:, order].T), query[:, order]
    rest_c = np.sqrt(np.cumsum((tall * tall)[::-1], axis=0)[::-1])
    rest_q = np.sqrt(np.cumsum((query * query)[:, ::-1], axis=1)[:, ::-1])
    dims = len(order)
    together = max(1, CHUNK // len(ids))
    for q in range(len(query)):
        if q % together == 0:
            opening = query[q : q + together, :step] @ tall[:step]
        live = np.flatnonzero(ids != query_ids[q])
        part = opening[q % together, live]
        at = step
        while at < dims and len(live):
            bound = rest_q[q, at] * rest_c[at, live] * (1 + 1e-9) + 1
            floor = floors[q]
            if len(live) > k:
                floor = max(floor, np.partition(part - bound, len(live) - k)[len(live) - k])
            keep = part + bound >= floor
            live, part = live[keep], part[keep]
            part = part + query[q, at : at + step] @ tall[at : at + step, live]
            at += step
        for i in _best(part, ids[live], k):
            if part[i] >= floors[q]:
                yield int(query_ids[q]), int(ids[live[i]]), int(part[i])


def _wide(query, query_ids, cand, ids, k):
    """The same for numbers beyond the exact range of doubles, in Python's integers."""
    whole = np.array([[int(x) for x in r] for r in cand.tolist()], dtype=object)
    for q, row in zip(query_ids, query.tolist(), strict=True):
        score = whole @ np.array([int(x) for x in row], dtype=object)
        order = sorted((-s, i) for s, i in zip(score, ids.tolist(), strict=True) if i != q)[:k]
        for s, i in order:
            yield int(q), i, max(min(-s, MOST), LEAST)


def _solver(k: int, step: int):
    """applyInArrow function of a unit: rows with ``asks`` are its queries, the others its candidates."""

    def solve(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        ids = table.column("vec_id").to_numpy()
        out = []
        if asks.any() and not asks.all():
            m = matrix(table.column("v"))
            norm = np.sqrt((m * m).sum(axis=1))
            if not m.shape[1]:
                out = [(int(q), int(i), 0) for q in ids[asks] for i in sorted(set(ids[~asks].tolist()) - {int(q)})[:k]]
            elif norm[asks].max() * norm[~asks].max() < EXACT:
                floors = table.column("floor").fill_null(LEAST).to_numpy()
                out = list(unit_top_k(m[asks], ids[asks], floors[asks], m[~asks], ids[~asks], k, step))
            else:
                out = list(_wide(m[asks], ids[asks], m[~asks], ids[~asks], k))
        cols = list(zip(*out, strict=True)) or [[], [], []]
        return pa.table([pa.array(list(c), pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])

    return solve


def _meet(v: DataFrame, asked: DataFrame, cols: int, lines: int, first_only: bool, solve) -> DataFrame:
    """Rows found when every query (vec_id, v, floor) meets every block, or one block only."""
    spread = lambda c, parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias(c)
    place = lambda c, parts: F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias(c)
    carried = ["vec_id", "v"]
    asks = asked.select(place("line", lines), F.lit(True).alias("asks"), *carried, "floor")
    if first_only:  # the queries of a line meet the block of the line's number
        served = F.filter(F.sequence(F.lit(0), F.lit(lines - 1)), lambda x: F.pmod(x, F.lit(cols)) == F.pmod(F.xxhash64("vec_id"), F.lit(cols)))
        cand = v.select(F.explode(served).alias("line"), place("col", cols), F.lit(False).alias("asks"), *carried)
        asks = asks.withColumn("col", F.pmod("line", F.lit(cols)).cast("int"))
    else:
        cand = v.select(spread("line", lines), place("col", cols), F.lit(False).alias("asks"), *carried)
        asks = asks.select("*", spread("col", cols))
    units = cand.withColumn("floor", F.lit(None).cast("long")).unionByName(asks)
    return units.repartition(shuffle_width(v.sparkSession), "line", "col").groupBy("line", "col").applyInArrow(solve, HITS)


def _first(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    rows: DataFrame, queries: str = "vec_id % 100 = 0", k: int = 10, block: int | None = None, query_block: int | None = None, step: int = 8
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of all other rows for the rows in ``queries``.

    ``block`` candidates and ``query_block`` queries make a unit: by default what
    ``SIDE_BYTES`` hold, or fewer candidates where tasks would be idle.
    """
    width = shuffle_width(rows.sparkSession)
    v = saved(integer_vectors(rows), "vectors")
    size = v.agg(F.count("*").alias("n"), F.count_if(F.expr(queries)).alias("m"), F.max(F.size("v")).alias("dims")).first()
    held = max(1, SIDE_BYTES // (8 * (size.dims or 1)))
    lines = max(1, -(-size.m // (query_block or held)))
    cols = max(1, -(-size.n // (block or held)))
    if block is None:
        cols = max(cols, min(width, -(-size.n // 1024)))
    asked = v.where(queries).withColumn("floor", F.lit(None).cast("long"))
    solve = _solver(k, step)
    if cols > 1:  # with one block the first pass is the whole pass
        floors = _first(_meet(v, asked, cols, lines, True, solve), k).where(F.col("rank") == k)
        floors = floors.select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
        asked = asked.drop("floor").join(saved(floors, "vector-floors"), "vec_id", "left")
    return _first(_meet(v, asked, cols, lines, False, solve), k).select("query_id", "rank", "vec_id", "score")
