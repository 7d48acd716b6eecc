"""Heartbeats, rollups with late points and the dead-man's switch on live streams."""

import os
import time

import pytest
from pyspark.sql import functions as F

from fraudlake.operators import monitor
from fraudlake.streaming import monitoring as mon

POINTS = "ts timestamp, metric string, value long"


def points(spark, rows):
    return spark.createDataFrame([(t, m, v) for t, m, v in rows], "t string, metric string, value long").select(F.col("t").cast("timestamp").alias("ts"), "metric", "value")


def put(df, folder):
    df.coalesce(1).write.mode("append").parquet(folder)


def at(minute, second=0):
    return f"2024-01-01 00:{minute:02d}:{second:02d}"


def totals(spark, root):
    return {(str(r.window_start), r.metric): (r.total, r.points, r.corrected) for r in mon.rolled_up(spark, root).collect()}


def test_late_points_are_corrections_and_a_repeated_batch_counts_once(spark, workdir):
    first = points(spark, [(at(1), "ScorerErrorCount", 4), (at(40), "ScorerErrorCount", 1), (None, "ScorerErrorCount", 9)])
    second = points(spark, [(at(2), "ScorerErrorCount", 3), (at(39), "ScorerErrorCount", 2)])
    for batch, df in ((0, first), (0, first), (1, second), (1, second)):
        mon.add_points(df, batch, workdir)
    got = totals(spark, workdir)
    assert got[("2024-01-01 00:00:00", "ScorerErrorCount")] == (7, 2, 1)  # given out before the second batch
    assert got[("2024-01-01 00:35:00", "ScorerErrorCount")] == (2, 1, 0) and got[("2024-01-01 00:40:00", "ScorerErrorCount")] == (1, 1, 0)
    assert got[("None", "ScorerErrorCount")] == (9, 1, 0) and sum(p for _, p, _ in got.values()) == 5
    alarms = {str(r.window_start): r.alarm for r in mon.alarms_of(mon.rolled_up(spark, workdir)).where("window_start IS NOT NULL").collect()}
    assert alarms["2024-01-01 00:00:00"] is True and alarms["2024-01-01 00:40:00"] is False  # 4 + 3 > 5


def test_rollup_stream_survives_a_restart(spark, workdir):
    src, root, ck = (os.path.join(workdir, n) for n in ("src", "root", "ck"))
    for lo in (0, 20):
        put(points(spark, [(at(m), "FraudAlertCount", 1) for m in range(lo, lo + 20)]), src)
        mon.start_rollup(spark.readStream.schema(POINTS).parquet(src), root, ck, trigger="availableNow").awaitTermination()
    assert sum(t for t, _, _ in totals(spark, root).values()) == 40 and len(totals(spark, root)) == 8
    assert mon.rolled_up(spark, os.path.join(workdir, "none")).count() == 0


def test_every_report_is_logged_and_gaps_are_told(spark, workdir):
    src, log = os.path.join(workdir, "src"), os.path.join(workdir, "log")
    for i in range(9):
        put(spark.range(i + 1), src)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(src)
        start = lambda: stream.writeStream.format("noop").option("checkpointLocation", os.path.join(workdir, "ck")).trigger(availableNow=True).start()
        query = mon.watch(spark, start, log, every=1.0)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    beats = mon.heartbeats(spark, log)
    assert len(query.recentProgress) <= 2
    assert sorted(r.input_rows for r in beats.where("batch_id >= 0").collect()) == list(range(1, 10))
    assert [r.missing for r in mon.progress_gaps(beats).collect()] == [0]
    assert [r.missing for r in mon.progress_gaps(beats.where("batch_id NOT IN (3, 4)")).collect()] == [2]
    rows = [tuple(r) for r in spark.read.schema(mon.PROGRESS).parquet(log).collect()]
    assert mon.append_progress(spark, rows, log) == 0  # reports that are there are not added again
    assert mon.heartbeats(spark, os.path.join(workdir, "none")).count() == 0


def run_switch(spark, workdir, waves, **options):
    src, out, ck = (os.path.join(workdir, n) for n in ("src", "out", "ck"))
    for rows in waves:
        df = spark.createDataFrame([(t, "ConsumerHeartbeat", v, tick) for t, v, tick in rows], "t string, metric string, value long, tick boolean")
        put(df.select(F.col("t").cast("timestamp").alias("ts"), "metric", "value", "tick"), src)
        stream = spark.readStream.schema(POINTS + ", tick boolean").parquet(src)
        mon.dead_mans_switch(stream, timers=False, **options).writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination()
    return [(str(r.period_start)[11:16], r.total, r.breach, r.alarm) for r in spark.read.schema(mon.SWITCH).parquet(out).orderBy("late", "period_start").collect()], spark.read.schema(mon.SWITCH).parquet(out)


def test_silent_periods_are_given_out_and_late_points_are_told(spark, workdir):
    waves = [[(at(0, 10), 1, False), (at(0, 50), 2, False), (at(1, 5), 1, False)], [(at(6, 0), 1, False)], [(at(3, 30), 5, False), (at(8, 0), None, True)]]
    got, rows = run_switch(spark, workdir, waves)
    assert got == [
        ("00:00", 3.0, False, False), ("00:01", 1.0, False, False), ("00:02", 0.0, True, False), ("00:03", 0.0, True, False),
        ("00:04", 0.0, True, True), ("00:05", 0.0, True, True), ("00:06", 1.0, False, False), ("00:07", 0.0, True, False),
        ("00:03", 5.0, False, False),
    ]
    assert rows.where("late").count() == 1
    pts = points(spark, [(t, "ConsumerHeartbeat", v or 0) for w in waves[:2] for t, v, _ in w] + [(at(7, 59), "other", 1)]).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    batch = monitor.missing_data_alarm(pts, "ConsumerHeartbeat", 60, 1.0, 3).orderBy("period_start").collect()
    assert [(str(r.period_start)[11:16], r.total, r.breach, r.alarm) for r in batch] == got[:8]


def test_timers_close_periods_without_any_input(spark, workdir):
    src, ck = os.path.join(workdir, "src"), os.path.join(workdir, "ck")
    now = int(time.time())
    df = spark.createDataFrame([(now, "ConsumerHeartbeat", 1, False)], "s long, metric string, value long, tick boolean")
    put(df.select(F.timestamp_seconds("s").alias("ts"), "metric", "value", "tick"), src)
    stream = spark.readStream.schema(POINTS + ", tick boolean").parquet(src)
    query = mon.dead_mans_switch(stream, period_s=1, evaluation_periods=3).writeStream.format("memory").queryName("switch_q").option("checkpointLocation", ck).trigger(processingTime="1 second").start()
    try:
        for _ in range(60):
            time.sleep(1)
            if spark.table("switch_q").where("alarm").count():
                break
    finally:
        query.stop()
        query.awaitTermination(30)
    rows = spark.table("switch_q").orderBy("period_start").collect()
    assert rows[0].total == 1.0 and not rows[0].breach and rows[-1].alarm and all(r.total == 0 for r in rows[1:])


@pytest.mark.parametrize("bad", [[("x", None)], [(None, "m")]])
def test_rows_without_time_or_metric_do_not_reach_the_switch(spark, bad, workdir):
    src = os.path.join(workdir, "src")
    rows = spark.createDataFrame([(None if t is None else at(1), m, 1, False) for t, m in bad], "t string, metric string, value long, tick boolean")
    put(rows.select(F.col("t").cast("timestamp").alias("ts"), "metric", "value", "tick"), src)
    out = os.path.join(workdir, "out")
    stream = spark.readStream.schema(POINTS + ", tick boolean").parquet(src)
    mon.dead_mans_switch(stream, timers=False).writeStream.format("parquet").option("path", out).option("checkpointLocation", os.path.join(workdir, "ck")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.schema(mon.SWITCH).parquet(out).count() == 0
