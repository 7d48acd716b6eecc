"""The corpus pipeline: language ID, quality filter, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``. All stages but the last return
the columns of ``documents`` for the documents they keep.

Cases: a null or empty text has no letters and goes in the first stage; a stage run by
itself treats it as its operator does; repeated rows are judged each for itself, and of those
with words one stays among near duplicates; very long texts are read whole; columns not named
by an operator are carried along; an empty table gives no rows at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.llm import language, packing, resampling, similar
from fraudlake.llm.common import free_name, read_table, saved
from fraudlake.llm.queries import BYTE_BPE

def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or in which no language holds half of the letters, go."""
    return language.accepted(docs, min_score=0.5)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampling does not draw go."""
    return resampling.accepted(docs, read_table(spark, sf_dir, "labels").selectExpr("doc_id", "quality AS label"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar documents stays: the smallest doc_id's, any one of them
    where rows repeat it; a row without a doc_id only where no row of the group has one."""
    key = free_name(docs, "row_key")
    rows = saved(docs.withColumn(key, F.monotonically_increasing_id()), "pipeline-rows")
    return rows.join(similar.first_of_each_class(rows, key), key, "left_semi").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their places in sequences of 1024 tokens."""
    return packing.pack_documents(docs, BYTE_BPE, end_id=2, capacity=1024)


STAGES = [
    ("language", language_stage),
    ("quality", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]

#: The stages use learned models, sampled paths and a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
