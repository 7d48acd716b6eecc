"""Fan-in where steps decrease and erasures come in between, in batch and in micro-batches."""

import os
import random

import pytest
from pyspark.sql import functions as F

from fraudlake.operators import fanin
from fraudlake.streaming import fanin_batches

SCHEMA = "key string, seq long, kind string, step int, tag string"


def slow(rows, window=24, lateness=0):
    """The rules, event by event."""
    out, live, tops = {}, {}, {}
    for key, seq, kind, step, tag in sorted((r for r in rows if r[1] is not None), key=lambda r: r[1]):
        if kind == "purge":
            out[seq] = (None, False, key in tops)
            live.pop(key, None), tops.pop(key, None)
        elif step is None:
            out[seq] = (None, False, False)
        else:
            seen, top = live.setdefault(key, []), tops.get(key)
            floor = step - window if top is None else max(step - window, top - window - lateness)
            out[seq] = (sum(floor <= s <= step for s in seen), top is not None and step < top - window - lateness, False)
            seen.append(step)
            tops[key] = step if top is None else max(top, step)
    return out


def control_rows(n, seed, keys=("a", "b", None, "hot"), disorder=0.3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.4 else rng.choice(keys)
        step = i // 12 + (rng.randrange(-40, 30) if rng.random() < disorder else 0)
        rows.append((key, i, "purge" if rng.random() < 0.03 else "txn", step, f"t{i}"))
    return [(k, s, kind, None if kind == "purge" or s % 97 == 5 else t, g) for k, s, kind, t, g in rows]


def got(df):
    return {r.seq: (r.fan_in_dest_count_24h, r.late, r.purged) for r in df.where("seq IS NOT NULL").collect()}


@pytest.mark.parametrize("disorder, lateness, chunk", [(0.3, 0, 50), (0.3, 3, 7), (0.0, 0, 40), (1.0, 0, 10_000)])
def test_batch_form_equals_event_by_event(spark, disorder, lateness, chunk):
    rows = control_rows(900, 1, disorder=disorder)
    df = spark.createDataFrame([*rows, ("a", None, "txn", 3, "x")], SCHEMA)
    result, _ = fanin.fan_in_any_order(df, lateness=lateness, chunk_rows=chunk)
    assert got(result) == slow(rows, lateness=lateness)
    assert result.count() == 901 and result.columns == ["key", "seq", "kind", "step", "tag", "fan_in_dest_count_24h", "late", "purged"]


def test_batch_form_of_nothing_and_of_purges_alone(spark):
    empty = spark.createDataFrame([], SCHEMA)
    result, state = fanin.fan_in_any_order(empty)
    assert result.count() == 0 and state.count() == 0
    result, state = fanin.fan_in_any_order(spark.createDataFrame([("a", 1, "purge", None, None), ("a", 2, "purge", None, None)], SCHEMA))
    assert got(result) == {1: (None, False, False), 2: (None, False, False)}
    assert [tuple(r) for r in state.collect()] == [("a", None, None, True)]


def test_short_form_is_allowed_where_steps_never_decrease(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("a", 3, 4), ("b", 4, 2)], "nameDest string, seq long, step int")
    assert fanin.steps_never_decrease(df)
    assert not fanin.steps_never_decrease(df.unionByName(spark.createDataFrame([("a", 5, 3)], "nameDest string, seq long, step int")))


def test_micro_batches_equal_event_by_event_and_a_repeated_batch_changes_nothing(spark, workdir):
    rows = control_rows(700, 2)
    for b in range(5):
        part = spark.createDataFrame(rows[140 * b : 140 * (b + 1)], SCHEMA)
        for _ in range(2 if b in (1, 3) else 1):  # Spark runs a batch again when it does not know that it ended
            fanin_batches.apply_batch(part, b, workdir, chunk_rows=30, merge_every=2)
    schema = spark.createDataFrame([], SCHEMA + ", fan_in_dest_count_24h long, late boolean, purged boolean").schema
    assert got(fanin_batches.results(spark, workdir, schema)) == slow(rows)
    assert sorted(os.listdir(os.path.join(workdir, "merged"))) == ["batch=1", "batch=3"]


def test_a_hot_key_is_spread_over_chunks(spark):
    n, size = 3000, 100
    hot = spark.range(n).select(F.lit("hot").alias("key"), F.col("id").alias("seq"), F.lit("txn").alias("kind"), (F.col("id") / 100 - F.col("id") % 7 * 3).cast("int").alias("step"), F.lit("").alias("tag"))
    result, _ = fanin.fan_in_any_order(hot, chunk_rows=size)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # tiny partitions would be put together
    try:
        spread = [r["count"] for r in result.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(spread) == 4 and max(spread) < n * 0.6
    rows = [tuple(r) for r in hot.collect()]
    assert got(result) == slow(rows)
