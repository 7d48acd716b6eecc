"""Registered queries that write a source or sink and read it back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fraudlake.operators import erasure
from fraudlake.plans import pipeline as P
from fraudlake.plans.catalog import QUERIES, register
from fraudlake.plans.oracle import with_views
from fraudlake.schemas import FEATURES, TXN_FIELDS
from fraudlake.session import shared_path
from fraudlake.sources import txn as source

_RECORDS = with_views(f"SELECT {', '.join(TXN_FIELDS)} FROM transactions", "transactions")


def _folder(spark, name: str) -> str:
    return shared_path(spark, "fraudlake-io", f"{name}-{uuid.uuid4().hex}")


@register("S4_read_txn_csv", _RECORDS)
def q_s4(spark, sf):
    """The records written as CSV with header and read with the fixed schema."""
    path = _folder(spark, "csv")
    P.transactions(spark, sf).select(*TXN_FIELDS).write.option("header", True).csv(path)
    return source.read_txn_csv(spark, path)


@register("S5_read_through_cache", _RECORDS)
def q_s5(spark, sf):
    """The second read finds the cache: its builder must not run."""
    path = _folder(spark, "cache")
    source.read_through_cache(spark, path, lambda: P.transactions(spark, sf).select(*TXN_FIELDS))

    def never():
        raise AssertionError("the cache was built twice")

    return source.read_through_cache(spark, path, never)


@register("K7_register_external", with_views("SELECT account_id, account_alias, request_id, requested_at FROM registry", "registry"))
def q_k7(spark, sf):
    """The registry appended to its table, registered as an external table and read by name."""
    path, name = _folder(spark, "registry"), f"gdpr_requests_{uuid.uuid4().hex}"
    P.registry(spark, sf).write.parquet(path)
    erasure.register_external(spark, name, path)
    return spark.table(name).select("account_id", "account_alias", "request_id", "requested_at")


@register("K11_save_load_model", None)
def q_k11(spark, sf):
    """The frozen trees saved with their metadata and loaded again give the same probabilities."""
    from fraudlake.operators import model as M
    from fraudlake.plans.catalog_more import _trained

    model, n_trees, _, threshold, test = _trained(spark, sf)
    path = _folder(spark, "model")
    M.save_model(model, {"phase": "gbt", "num_trees": n_trees, "decision_threshold": threshold, "features": list(FEATURES)}, path)
    loaded, meta = M.load_model(path)
    own = M.model_scorer(model)(test).select("seq", F.col("fraud_probability").alias("_p"))
    both = M.model_scorer(loaded)(test).select("seq", "fraud_probability").join(own, "seq", "left")
    same = (F.col("fraud_probability") == F.col("_p")) & F.lit(meta["num_trees"] == n_trees and meta["decision_threshold"] == threshold)
    return both.select("seq", F.coalesce(same, F.lit(False)).alias("agrees"))


# every test row, and each agrees: the SQL of the tree rows' query
QUERIES["K11_save_load_model"] = (q_k11, QUERIES["M3_score_tree_rows"][1])
