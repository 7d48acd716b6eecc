"""Registered queries that run the erasure jobs on written tables, through crashes and rivals."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from fraudlake.operators import erasure
from fraudlake.plans import pipeline as P
from fraudlake.plans.catalog import register
from fraudlake.plans.oracle import with_views
from fraudlake.session import shared_path
from fraudlake.sources import fixtures
from fraudlake.sources.fixtures import FIXTURE_PEPPER


def _folder(spark, name: str) -> str:
    return shared_path(spark, "fraudlake-erasure", f"{name}-{uuid.uuid4().hex}")


def _facts(spark, sf):
    """Bronze rows with raw ids, as a table that an erasure rewrites."""
    return P.bronze(spark, sf).select("seq", F.col("nameOrig").alias("name_orig"), F.col("nameDest").alias("name_dest"), "amount", "type")


class _Died(RuntimeError):
    pass


CRASHES = (("plain", "staged"), ("plain", "moved aside"), ("plain", "moved in"), ("partitioned", "staged"), ("partitioned", "moved in"))


@register(
    "G1_crash_recovery",
    with_views(
        """SELECT layout, step, account_alias, cells AS rows_anonymized, 0 AS leaked_cells, (SELECT CAST(count(*) AS BIGINT) FROM raw_table) AS rows_after
           FROM cells, (VALUES """ + ", ".join(f"('{a}', '{b}')" for a, b in CRASHES) + ") v(layout, step)",
        "cells",
    ),
)
def q_g1_crash(spark, sf):
    """A rewrite that dies behind each of its steps, and the rerun that completes it."""
    requests = fixtures.erasure_requests(spark, sf).select("account_id", "request_id")
    out = None
    for layout, step in CRASHES:
        path = _folder(spark, "facts")
        w = _facts(spark, sf).write
        (w.partitionBy("type") if layout == "partitioned" else w).parquet(path)
        parts = {path: ["type"]} if layout == "partitioned" else {}

        def die(_, s, step=step):
            if s == step:
                raise _Died(s)

        try:
            erasure.erase_tables(spark, [path], requests, FIXTURE_PEPPER, parts, on_step=die)
        except _Died:
            pass
        done = erasure.erase_tables(spark, [path], requests, FIXTURE_PEPPER, parts)
        after = spark.read.parquet(path)
        left = erasure.erased_cells(after, requests, FIXTURE_PEPPER).select("account_id", F.col("cells").cast("int").alias("leaked_cells"))
        rows = after.agg(F.count(F.lit(1)).alias("rows_after"))
        one = done.join(left, "account_id").join(F.broadcast(rows)).select(F.lit(layout).alias("layout"), F.lit(step).alias("step"), "account_alias", "rows_anonymized", "leaked_cells", "rows_after")
        out = one if out is None else out.unionByName(one)
    return out


@register(
    "K8_concurrent_append",
    with_views("SELECT * FROM registry QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY requested_at, account_id) = 1", "registry"),
)
def q_k8_concurrent(spark, sf):
    """Three writers append overlapping parts of the registry at the same time."""
    rows, path = P.registry(spark, sf), _folder(spark, "registry")
    number = F.pmod(F.xxhash64("request_id"), F.lit(3))
    parts = [rows.where(number != k) for k in range(3)]
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda part: erasure.append_registry(spark, part, path), parts))
    return erasure.read_registry(spark, path)


@register(
    "G2_submit_erasure",
    with_views(
        """SELECT q.account_id, q.request_id, q.status, CAST(CASE WHEN q.status = 'rejected' THEN 0 ELSE coalesce(c.cells, 0) END AS BIGINT) AS rows_anonymized,
                  CAST(CASE WHEN q.status = 'rejected' THEN coalesce(n.n, 0) ELSE 0 END AS BIGINT) AS raw_cells, q.status <> 'rejected' AS audited, q.status <> 'rejected' AS stored
           FROM (SELECT account_id, request_id, 'erasure_requested' AS status FROM erasure_requests WHERE request_id NOT LIKE 'req-dup-%'
                 UNION ALL SELECT 'C' || lpad(CAST(CAST(substr(account_id, 2) AS BIGINT) + 1 AS VARCHAR), 9, '0'), request_id, 'rejected' FROM erasure_requests WHERE request_id LIKE 'req-dup-%') q
           LEFT JOIN cells c ON c.account_id = q.account_id
           LEFT JOIN (SELECT id, count(*) AS n FROM (SELECT name_orig AS id FROM raw_table UNION ALL SELECT name_dest FROM raw_table) GROUP BY id) n ON n.id = q.account_id""",
        "cells",
    ),
)
def q_g2_submit(spark, sf):
    """The whole cascade over a written table. The registry holds the second requests
    already; the batch holds the first ones, and requests of other accounts under the
    stored ids, which must change nothing."""
    facts, reg, audit = (_folder(spark, n) for n in ("facts", "registry", "audit"))
    _facts(spark, sf).write.parquet(facts)
    every = fixtures.erasure_requests(spark, sf)
    second = F.col("request_id").startswith("req-dup-")
    erasure.append_registry(spark, erasure.build_registry(every.where(second), FIXTURE_PEPPER)[0], reg)
    neighbour = fixtures.account_id(F.substring("account_id", 2, 20).cast("long") + 1)
    batch = every.where(~second).unionByName(every.where(second).withColumn("account_id", neighbour))
    results = erasure.submit_erasure(spark, batch, FIXTURE_PEPPER, reg, [facts], audit, lambda messages: None)
    after = spark.read.parquet(facts)
    raw = after.select(F.explode(F.array("name_orig", "name_dest")).alias("account_id")).groupBy("account_id").agg(F.count(F.lit(1)).alias("raw_cells"))
    audited = erasure.read_audit(spark, audit).select("request_id", F.col("account_alias").alias("_a")).distinct().withColumn("audited", F.lit(True))
    stored = erasure.read_registry(spark, reg).select("request_id", "account_id").withColumn("stored", F.lit(True))
    named = batch.select("account_id", "request_id").withColumn("status", F.when(second, "rejected").otherwise("erasure_requested"))
    rows = named.join(results.select("request_id", "status", "account_alias", "rows_anonymized"), ["request_id", "status"])
    rows = rows.join(raw, "account_id", "left").join(stored, ["request_id", "account_id"], "left")
    rows = rows.join(audited, (rows.request_id == audited.request_id) & rows.account_alias.eqNullSafe(audited._a), "left").drop(audited.request_id)
    yes = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    return rows.select("account_id", "request_id", "status", "rows_anonymized", F.coalesce("raw_cells", F.lit(0)).cast("long").alias("raw_cells"), yes("audited"), yes("stored"))
