"""Streaming monitoring: heartbeats, rollups without loss, the dead-man's switch.

Heartbeats come from the query's own progress reports (one per micro-batch and, while
the query idles, one per ``spark.sql.streaming.noDataProgressEventInterval``), so a live
query leaves points even without traffic, and a dead one leaves none. A query keeps only
its last reports; :class:`ProgressLog` listens to all of them and :func:`watch` writes
them to a table.

:func:`start_rollup` counts every point: those of windows that were already given out
go to a corrections table, and both merge by window. :func:`dead_mans_switch` keeps the
open periods of each metric as state and closes them by the clock, with or without input.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from fraudlake.sinks import append_log
from fraudlake.streaming.batch_tables import complete_batches, read_batches, write_batch


def progress_rows(query: StreamingQuery) -> list[tuple]:
    """(timestamp, batch id, input rows, observed counters) per progress report."""
    rows = []
    for p in query.recentProgress:
        observed = {}
        for name, row in (p.observedMetrics or {}).items():
            observed.update({f"{name}.{k}": v for k, v in row.asDict().items()})
        rows.append((p.timestamp, int(p.batchId), int(p.numInputRows), observed))
    return rows


def heartbeat_frame(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """One ``ConsumerHeartbeat`` point per progress report of the query."""
    rows = [(ts, "ConsumerHeartbeat", 1, n) for ts, _, n, _ in progress_rows(query)]
    df = spark.createDataFrame(rows, "ts_text string, metric string, value long, input_rows long")
    return df.select(F.to_timestamp("ts_text").alias("ts"), "metric", "value", "input_rows")


PROGRESS = "run_id string, batch_id long, ts_text string, input_rows long, counters map<string, bigint>"


def append_progress(spark: SparkSession, rows: list[tuple], path: str) -> int:
    """Append the reports (tuples of :data:`PROGRESS`) that the table at ``path`` lacks; returns how many."""
    new = spark.createDataFrame(rows, PROGRESS).dropDuplicates(["run_id", "batch_id", "ts_text"])

    def fresh(table):
        return new if table is None else new.join(table, ["run_id", "batch_id", "ts_text"], "left_anti").select(*new.columns)

    return append_log.append(spark, path, new.schema, fresh)[0] if rows else 0


class ProgressLog(StreamingQueryListener):
    """All reports of all queries, held until :meth:`flush` writes them to the table at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__()
        self.spark, self.path, self.lock, self.rows = spark, path, threading.Lock(), []

    def _hold(self, run_id, batch_id: int, ts: str, n: int, counters: dict) -> None:
        with self.lock:
            self.rows.append((str(run_id), batch_id, ts, n, counters))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        observed = {k: int(v) for row in (p.observedMetrics or {}).values() for k, v in row.asDict().items() if v is not None}
        self._hold(p.runId, int(p.batchId), p.timestamp, int(p.numInputRows), observed)

    def onQueryIdle(self, event) -> None:
        self._hold(event.runId, -1, event.timestamp, 0, {})  # alive, without a batch

    def onQueryTerminated(self, event) -> None:
        pass

    def flush(self) -> int:
        """Write what is held; it stays held when the write fails."""
        with self.lock:
            rows = list(self.rows)
        n = append_progress(self.spark, rows, self.path)
        with self.lock:
            del self.rows[: len(rows)]
        return n


def watch(spark: SparkSession, start, path: str, every: float = 10.0, settle: float = 1.0) -> StreamingQuery:
    """Run the query that ``start()`` starts to its end, logging its reports every ``every`` seconds."""
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    try:
        query = start()
        while not query.awaitTermination(every):
            log.flush()
        last = query.lastProgress
        for _ in range(50):  # reports reach a listener a little later
            if last is None or any(r[1] == int(last.batchId) for r in log.rows if r[0] == str(query.runId)):
                break
            threading.Event().wait(settle / 10)
        return query
    finally:
        log.flush()
        spark.streams.removeListener(log)


def logged_counters(spark: SparkSession, path: str) -> DataFrame:
    """(counter, total): the observed counters of all logged batches."""
    rows = append_log.read(spark, path, PROGRESS)
    if rows is None:
        rows = spark.createDataFrame([], PROGRESS)
    return rows.select(F.explode("counters").alias("counter", "n")).groupBy("counter").agg(F.sum("n").alias("total"))


def heartbeats(spark: SparkSession, path: str) -> DataFrame:
    """One ``ConsumerHeartbeat`` point per logged report."""
    rows = append_log.read(spark, path, PROGRESS)
    if rows is None:
        rows = spark.createDataFrame([], PROGRESS)
    return rows.select("run_id", "batch_id", F.to_timestamp("ts_text").alias("ts"), F.lit("ConsumerHeartbeat").alias("metric"), F.lit(1).cast("long").alias("value"), "input_rows")


def progress_gaps(progress: DataFrame) -> DataFrame:
    """Per run the batches between its first and last report, and how many have no report."""
    per = progress.where("batch_id >= 0").groupBy("run_id").agg(F.min("batch_id").alias("lo"), F.max("batch_id").alias("hi"), F.countDistinct("batch_id").alias("seen"))
    return per.select("run_id", (F.col("hi") - F.col("lo") + 1).alias("batches"), (F.col("hi") - F.col("lo") + 1 - F.col("seen")).alias("missing"))


def windowed_rollup(points: DataFrame, period: str = "5 minutes", delay: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """Streaming Sum per period per metric; the watermark bounds the state
    and lets finished windows be emitted in append mode."""
    return (
        points.withWatermark(ts, delay)
        .groupBy(F.window(ts, period).alias("w"), "metric")
        .agg(F.sum("value").alias("total"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "metric", "total")
    )


def threshold_alarm_stream(points: DataFrame, period: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """Streaming workload alarms: the windowed rollup joined to the alarm
    rules (a literal table; stream-static join) by metric name; a finished
    window is emitted once, with ``alarm`` = its Sum against the threshold."""
    return alarms_of(windowed_rollup(points, period, delay), period)


def _period_seconds(period: str) -> int:
    n, unit = period.split()
    return int(n) * {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600}[unit]


# --- rollup without loss ---------------------------------------------------------------

SUMS = "window_start timestamp, window_end timestamp, metric string, total long, points long"


def add_points(points: DataFrame, batch_id: int, root: str, period: str = "5 minutes", delay: str = "10 minutes", ts: str = "ts") -> None:
    """One micro-batch of points (ts, metric, value): its sums by window, written once.

    A window is given out when the clock (the highest ts of earlier batches) has passed
    its end by ``delay``; points of such windows go to ``corrections``, all others to
    ``sums``. Both are written by overwrite under the batch's number, so a batch that
    runs again counts once. A point without ts counts under a null window."""
    spark = points.sparkSession
    clock = read_batches(spark, f"{root}/clock", "ts timestamp", before=batch_id)
    seen = clock.agg(F.max("ts")).first()[0] if clock is not None else None
    rolled = points.groupBy(F.window(ts, period).alias("w"), "metric").agg(F.sum("value").cast("long").alias("total"), F.count(F.lit(1)).alias("points"), F.max(ts).alias("_hi"))
    untimed = points.where(F.col(ts).isNull()).groupBy("metric").agg(F.sum("value").cast("long").alias("total"), F.count(F.lit(1)).alias("points"))
    none = F.lit(None).cast("timestamp")
    rolled = rolled.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "metric", "total", "points", "_hi").unionByName(
        untimed.select(none.alias("window_start"), none.alias("window_end"), "metric", "total", "points", none.alias("_hi"))
    )
    write_batch(rolled, f"{root}/all", batch_id)
    rolled = read_batches(spark, f"{root}/all", SUMS + ", _hi timestamp", only=batch_id)
    limit = F.lit(seen).cast("timestamp") - F.expr(f"INTERVAL {delay}")
    late = F.coalesce(F.col("window_end") <= limit, F.lit(False))
    write_batch(rolled.where(~late).drop("_hi"), f"{root}/sums", batch_id)
    write_batch(rolled.where(late).drop("_hi"), f"{root}/corrections", batch_id)
    # last: a batch that ended before here is done again against the same clock
    write_batch(rolled.agg(F.max("_hi").alias("ts")).where("ts IS NOT NULL"), f"{root}/clock", batch_id)


def start_rollup(points: DataFrame, root: str, checkpoint: str, trigger: str = "30 seconds", **options) -> StreamingQuery:
    """Run :func:`add_points` on a stream of points."""
    writer = points.writeStream.foreachBatch(lambda batch, batch_id: add_points(batch, batch_id, root, **options)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if trigger == "availableNow" else writer.trigger(processingTime=trigger)).start()


def rolled_up(spark: SparkSession, root: str) -> DataFrame:
    """(window_start, window_end, metric, total, points, corrected): the sums and their corrections merged by window."""
    parts = [
        rows.withColumn("_late", F.lit(late))
        for folder, late in (("sums", False), ("corrections", True))
        if (rows := read_batches(spark, f"{root}/{folder}", SUMS)) is not None
    ]
    if not parts:
        return spark.createDataFrame([], SUMS + ", corrected long")
    every = parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]
    late = F.sum(F.when(F.col("_late"), F.col("points")).otherwise(0)).alias("corrected")
    return every.groupBy("window_start", "window_end", "metric").agg(F.sum("total").alias("total"), F.sum("points").alias("points"), late)


def alarms_of(rolled: DataFrame, period: str = "5 minutes") -> DataFrame:
    """The threshold alarms of merged windows: a correction may raise one, or take it back."""
    from fraudlake.operators.monitor import breaches
    from fraudlake.schemas import ALARM_RULES

    seconds = _period_seconds(period)
    return breaches(rolled, [r for r in ALARM_RULES if r[3] == seconds and r[4] == 1 and not r[5]])


# --- dead-man's switch -------------------------------------------------------------------

SWITCH = "metric string, period_start timestamp, total double, breach boolean, alarm boolean, late boolean"
SWITCH_STATE = "next long, periods array<long>, totals array<double>, run int"


def _partial_sums(period_s: int):
    """Sums by metric and period of what a task holds, so a busy metric sends few rows."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            tick = pdf["tick"].to_numpy()
            pdf["period"] = pdf["at"] // period_s * period_s
            points = pdf[~tick].groupby(["metric", "period"], as_index=False).agg(value=("value", "sum"), at=("at", "max"))
            ticks = pdf[tick].groupby("metric", as_index=False).agg(at=("at", "max"))
            yield points.assign(tick=False)[["metric", "period", "value", "at", "tick"]]
            yield ticks.assign(period=0, value=0.0, tick=True)[["metric", "period", "value", "at", "tick"]]

    return sums


def _switch(period_s: int, threshold: float, evaluation_periods: int, delay_s: int, timers: bool):
    def close(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        start, periods, totals, run = state.get if state.exists else (None, [], [], 0)
        held = dict(zip([int(p) for p in periods], [float(t) for t in totals], strict=True))
        out, horizon = [], None
        if state.hasTimedOut:
            horizon = state.getCurrentProcessingTimeMs() // 1000 - delay_s
        else:
            rows = pd.concat(list(pdfs), ignore_index=True)
            horizon = int(rows["at"].max()) - (0 if rows["tick"].any() and rows.loc[rows["tick"], "at"].max() == rows["at"].max() else delay_s)
            points = rows[~rows["tick"].astype(bool)]
            if len(points) and start is None:
                start = int(points["period"].min())
            for p, v in zip(points["period"].tolist(), points["value"].tolist(), strict=True):
                if p < start:
                    out.append((p, v, False, False, True))  # its period has been judged: reported, not dropped
                else:
                    held[p] = held.get(p, 0.0) + v
        if start is not None:
            start = int(start)
            while start + period_s <= horizon:
                total = held.pop(start, 0.0)
                run = run + 1 if total < threshold else 0
                out.append((start, total, run > 0, run >= evaluation_periods, False))
                start += period_s
            state.update((start, list(held), list(held.values()), run))
            if timers:
                state.setTimeoutDuration(period_s * 1000)
        if out:
            cols = ["period_start", "total", "breach", "alarm", "late"]
            pdf = pd.DataFrame(out, columns=cols)
            pdf["period_start"] = pd.to_datetime(pdf["period_start"], unit="s")
            pdf.insert(0, "metric", key[0])
            yield pdf

    return close


def dead_mans_switch(
    points: DataFrame, period_s: int = 60, threshold: float = 1.0, evaluation_periods: int = 3, delay_s: int = 0, timers: bool = True,
) -> DataFrame:
    """Every period of every metric once it is over: its sum, whether it breaches, and the alarm.

    ``points``: a stream of (ts, metric, value, tick). A period is over when a later point
    of the metric lies ``delay_s`` behind its end, a tick of the metric (a clock row
    without value) reaches its end or, with ``timers``, the processing time does: periods
    without any input are given out too, as long as the query runs. A point of a period
    given out before comes out as a row marked ``late``. Runs over stored data need ticks
    instead of timers (with timers they would never end). The state of a metric are its
    open periods. Rows without ts or metric are left to the caller.
    """
    at = F.unix_seconds(F.col("ts").cast("timestamp")).alias("at")
    rows = points.where("ts IS NOT NULL AND metric IS NOT NULL").select("metric", at, F.coalesce(F.col("value"), F.lit(0)).cast("double").alias("value"), F.coalesce("tick", F.lit(False)).alias("tick"))
    partial = rows.mapInPandas(_partial_sums(period_s), "metric string, period long, value double, at long, tick boolean")
    return partial.groupBy("metric").applyInPandasWithState(
        _switch(period_s, threshold, evaluation_periods, delay_s, timers),
        outputStructType=SWITCH,
        stateStructType=SWITCH_STATE,
        outputMode="append",
        timeoutConf=GroupStateTimeout.ProcessingTimeTimeout if timers else GroupStateTimeout.NoTimeout,
    )
