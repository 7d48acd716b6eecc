"""The mart after a refresh of changed steps equals one built anew, and the rest is left alone."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMOKE
from fraudlake.operators.gold import halo, intervals, refresh_gold, write_gold
from fraudlake.plans import pipeline as P


def mart(spark, path):
    return sorted(tuple(sorted(r.asDict().items())) for r in spark.read.parquet(path).collect()) if os.path.exists(path) else []


def test_intervals():
    assert intervals([5, 1, 2, 2, 9, 8]) == [(1, 2), (5, 5), (8, 9)] and intervals([]) == []


def test_refresh_equals_rebuild_and_touches_only_the_steps_behind_a_change(spark, workdir):
    bronze_path, path, whole = (os.path.join(workdir, n) for n in ("bronze", "gold", "whole"))
    P.bronze(spark, SF_SMOKE).withColumn("nameDest", F.concat(F.lit("C00000000"), (F.col("seq") % 9).cast("string"))).write.parquet(bronze_path)
    bronze, reg = spark.read.parquet(bronze_path), P.registry(spark, SF_SMOKE)
    gone = (F.col("step") == 200) & (F.col("seq") % 2 == 0)
    alone = bronze.where("step BETWEEN 600 AND 610").withColumn("step", F.lit(-40)).limit(3)  # rows that Bronze does not hold any more
    write_gold(P.gold_of(bronze.where(~gone).unionByName(alone), reg), path, by_step=True)
    write_gold(P.gold_of(bronze, reg), whole, by_step=True)
    files = lambda: {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    before = files()
    changed = bronze.where(gone).select("step").unionByName(alone.select("step"))
    assert refresh_gold(bronze, reg, changed, path, sources=(bronze_path,), keep=("seq",)) == [(-40, -16), (200, 224)]
    assert mart(spark, path) == mart(spark, whole) and len(mart(spark, path)) == bronze.count()
    step_of = lambda f: int(f.split("step=")[1].split("/")[0])
    kept = {f: t for f, t in before.items() if not (200 <= step_of(f) <= 224 or step_of(f) == -40)}
    assert kept and kept.items() <= files().items()
    assert refresh_gold(bronze, reg, changed.limit(0), path) == []


def test_only_the_halo_is_read(spark, workdir):
    bronze_path = os.path.join(workdir, "bronze")
    P.bronze(spark, SF_SMOKE).write.parquet(bronze_path)
    plan = halo(spark.read.parquet(bronze_path), [(200, 224)])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(step,176)" in plan and "LessThanOrEqual(step,224)" in plan


def test_a_folder_of_the_mart_has_a_file_or_two_however_many_tasks_wrote(spark, workdir):
    path = os.path.join(workdir, "mart")
    rows = spark.range(0, 6000, numPartitions=12).select(F.concat(F.lit("T"), (F.col("id") % 2).cast("string")).alias("type"), (F.col("id") % 30).cast("int").alias("step"), "id")
    write_gold(rows, path, by_step=True)
    files = [(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]
    assert spark.read.parquet(path).count() == 6000 and len({d for d, _ in files}) == 30 and len(files) <= 60
