"""Registered queries of this folder: ``QUERIES[name] = (function, DuckDB SQL or None)``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from fraudlake.llm import bpe, fingerprints, hard_negatives, language, licences, packing, resampling, secret_scan, similar, sql, target_resampling, token_files, url_filter, vector_search
from fraudlake.llm.common import read_table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict = {}


def register(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = (fn, sql)
        return fn

    return keep


@register("op3_bpe_round_trip")
def op3(spark, sf_dir):
    return bpe.round_trip_digest(read_table(spark, sf_dir, "documents"), BYTE_BPE)


@register("op5_token_files")
def op5(spark, sf_dir):
    return token_files.write_and_read(read_table(spark, sf_dir, "documents"), WORD_BPE, end_id=2)


@register("op2_best_fit_packing")
def op2(spark, sf_dir):
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), BYTE_BPE, end_id=2, capacity=1024)


@register("op1_importance_resampling")
def op1(spark, sf_dir):
    labels = read_table(spark, sf_dir, "labels").selectExpr("doc_id", "quality AS label")
    return resampling.resample(read_table(spark, sf_dir, "documents"), labels)


@register("op4_language_spans")
def op4(spark, sf_dir):
    return language.identify(read_table(spark, sf_dir, "documents"))


@register("op7_chosen_path_join")
def op7(spark, sf_dir):
    return similar.similar_documents(read_table(spark, sf_dir, "documents"))


@register("op8_bottom_k_fingerprints")
def op8(spark, sf_dir):
    return fingerprints.fingerprint_edits(read_table(spark, sf_dir, "documents"))


@register("op10_branch_and_bound_top_k", sql.TOP_K)
def op10(spark, sf_dir):
    return vector_search.top_k(read_table(spark, sf_dir, "embeddings"))


# fixed values: the rules of the query
URL_RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
]


@register("op9_path_template_tree", sql.URL_VERDICTS)
def op9(spark, sf_dir):
    """A page is good when the document that its URL numbers is labelled of quality and not toxic."""
    good = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), 1).otherwise(0)
    labels = read_table(spark, sf_dir, "labels").where("quality is not null and toxic is not null").select("doc_id", good.alias("label"))
    labels = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("label").alias("label"))
    number = F.expr("try_cast(regexp_extract(url, '://[^/?#]*/[^?#]*?([0-9]+)[^0-9/?#]*/?([?#]|$)', 1) AS bigint)")
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", number.alias("doc_id"))
    return url_filter.judge(pages.join(labels, "doc_id", "left"), URL_RULES)


@register("op6_licence_scan", sql.LICENCE_SCAN)
def op6(spark, sf_dir):
    return licences.scan(read_table(spark, sf_dir, "documents"))


@register("op11_secret_scan", sql.SECRET_SCAN)
def op11(spark, sf_dir):
    return secret_scan.digest(read_table(spark, sf_dir, "documents"))


@register("op12_hard_negatives", sql.HARD_NEGATIVES)
def op12(spark, sf_dir):
    """Every seventh row stands under the next label."""
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label")))


@register("op13_target_resampling", sql.TARGET_RESAMPLING)
def op13(spark, sf_dir):
    return target_resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
