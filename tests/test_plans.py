"""Scale forms equal their plain forms; plans prune, push down, broadcast."""

import os
import random

from pyspark.sql import functions as F

from conftest import SF_SMOKE
from fraudlake.operators import evaluate as ev
from fraudlake.operators import fanin
from fraudlake.operators.gold import write_gold
from fraudlake.operators.split import extract_training
from fraudlake.plans import pipeline as P
from fraudlake.plans.strategies import (
    chunked_row_number,
    cumulative_by_order,
    cumulative_by_order_plain,
)
from fraudlake.sources.txn import page


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cumulative_buckets_equal_plain(spark):
    rnd = random.Random(7)
    rows = [(float(s), rnd.randint(0, 3), rnd.randint(0, 5)) for s in {rnd.random() for _ in range(500)}]
    df = spark.createDataFrame(rows, "score double, tp long, fp long")
    a = {r.score: (r.cum_tp, r.cum_fp) for r in cumulative_by_order(df, "score", ["tp", "fp"], n_buckets=7).collect()}
    b = {r.score: (r.cum_tp, r.cum_fp) for r in cumulative_by_order_plain(df, "score", ["tp", "fp"]).collect()}
    assert a == b
    # any cut points give the same exact result
    c = {r.score: (r.cum_tp, r.cum_fp) for r in cumulative_by_order(df, "score", ["tp", "fp"], cuts=[0.1, 0.11, 0.9]).collect()}
    assert c == b


def test_chunked_row_number_on_one_hot_group(spark):
    df = spark.range(0, 3000).select(F.lit("hot").alias("k"), F.lit(7).alias("s"), (F.col("id") * 3).alias("seq"))
    out = chunked_row_number(df, ["k", "s"], "seq", out_col="rn", chunk_rows=50)
    got = sorted((r.seq, r.rn) for r in out.collect())
    assert got == [(i * 3, i + 1) for i in range(3000)]


def test_fan_in_scale_forms_equal_plain(spark):
    b = P.bronze(spark, SF_SMOKE)
    masked = b.withColumnsRenamed({"nameDest": "name_dest"})
    a = {r.seq: r.fan_in_dest_count_24h for r in fanin.fan_in(masked).collect()}
    p = {r.seq: r.fan_in_dest_count_24h for r in fanin.fan_in_plain(masked).collect()}
    assert a == p
    s = b.where(F.col("type").isin("CASH_OUT", "TRANSFER"))
    x = {r.seq: r.fan_in_dest_count_24h for r in fanin.fan_in_arrival(s, chunk_rows=3).collect()}
    y = {r.seq: r.fan_in_dest_count_24h for r in fanin.fan_in_arrival_plain(s).collect()}
    assert x == y


def test_page_scan_pushes_range_filter(spark):
    t = spark.read.parquet(f"{SF_SMOKE}/events.parquet").withColumnRenamed("event_id", "seq")
    plan = _plan(page(t, 100, 50, dense=True))
    assert "PushedFilters" in plan and "GreaterThanOrEqual(event_id,100)" in plan


def test_gold_partition_pruning_and_column_pruning(spark, workdir):
    path = os.path.join(workdir, "gold")
    write_gold(P.gold_only(spark, SF_SMOKE), path)
    ex = extract_training(spark.read.parquet(path))
    plan = _plan(ex)
    assert "PartitionFilters" in plan and "CASH_OUT" in plan
    assert "ReadSchema" in plan and "is_fraud" in plan
    assert ex.count() == P.gold_only(spark, SF_SMOKE).where(F.col("type").isin("CASH_OUT", "TRANSFER")).count()


def test_type_filter_stays_above_fan_in_window(spark):
    # fan-in counts all types: the scorable filter must not be pushed under it
    ex = P.extract(spark, SF_SMOKE)
    all_types = P.silver(spark, SF_SMOKE).where(F.col("type").isin("CASH_OUT", "TRANSFER"))
    a = {r.seq: r.fan_in_dest_count_24h for r in ex.collect()}
    b = {r.seq: r.fan_in_dest_count_24h for r in all_types.collect()}
    assert a == b


def test_auc_and_ap_exact_small_example(spark):
    scored = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.8, 1), (0.3, 0), (0.1, 1)], "score double, label int")
    counts = ev.score_counts(scored)
    pts = ev.curve_points(counts, scale_form=True, n_buckets=2)
    m = ev.summary_metrics(pts).first()
    # ranks: positives 0.9, 0.8, 0.1; negatives 0.8, 0.3 -> AUC = (2 + 1.5 + 0) / 6
    assert abs(m.roc_auc - 3.5 / 6) < 1e-9
    # AP = 1/3*1 + 1/3*(2/3) + 1/3*(3/5)
    assert abs(m.pr_auc - (1 / 3 + 2 / 9 + 1 / 5)) < 1e-9
    best = ev.best_threshold(ev.pr_curve(pts)).first()
    # F1 at 0.8 is 2/3; at 0.1 precision 3/5, recall 1 gives 0.75
    assert best.threshold == 0.1


def test_scale_forms_under_a_hot_destination(spark):
    # one destination holds a third of all rows (every third event)
    b = P.bronze(spark, SF_SMOKE).withColumn(
        "nameDest", F.when(F.col("seq") % 3 == 0, F.lit("C000000001")).otherwise(F.col("nameDest"))
    )
    hot = b.where(F.col("nameDest") == "C000000001").count()
    assert hot * 3 >= b.count() - 3
    masked = b.withColumnsRenamed({"nameDest": "name_dest"})
    a = {r.seq: r.fan_in_dest_count_24h for r in fanin.fan_in(masked).collect()}
    p = {r.seq: r.fan_in_dest_count_24h for r in fanin.fan_in_plain(masked).collect()}
    assert a == p
    s = b.where(F.col("type").isin("CASH_OUT", "TRANSFER"))
    x = {r.seq: r.fan_in_dest_count_24h for r in fanin.fan_in_arrival(s, chunk_rows=4).collect()}
    y = {r.seq: r.fan_in_dest_count_24h for r in fanin.fan_in_arrival_plain(s).collect()}
    assert x == y
    # the window of the scale form sees at most one row per (destination, step)
    per = fanin._step_counts(masked, "name_dest", "step").groupBy("name_dest").count()
    assert per.agg(F.max("count")).first()[0] <= masked.select("step").distinct().count()
