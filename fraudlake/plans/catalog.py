"""Registered queries: one per operator of the inventory, each with its oracle.

``QUERIES[key] = (spark_fn, oracle_sql or None)``. A spark_fn takes
``(spark, sf_dir)`` and returns a lazy DataFrame over the driver's tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fraudlake.plans import oracle as O
from fraudlake.plans import pipeline as P

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = (fn, sql)
        return fn

    return deco


# --- Medallion slice ------------------------------------------------------------

@register("silver_gold", O.with_views("SELECT * FROM gold", "gold"))
def q_silver_gold(spark, sf_dir):
    """Bronze -> masked Silver with fan-in -> Gold projection (+ seq)."""
    return P.gold(spark, sf_dir)


@register("K6_silver_view", O.with_views("SELECT * FROM silver", "silver"))
def q_silver(spark, sf_dir):
    return P.silver(spark, sf_dir)


from fraudlake.plans import catalog_more, catalog_erasure, catalog_io, catalog_monitor, catalog_stream  # noqa: E402,F401  (register the rest)
