"""Registered queries that run the live jobs as streams: scoring through a restart,
heartbeats, rollups with late points, the dead-man's switch."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from fraudlake.operators.score import SCORECARD_METADATA, score_chain
from fraudlake.plans import pipeline as P
from fraudlake.plans.catalog import register
from fraudlake.plans.oracle import with_views
from fraudlake.schemas import FEATURES, TXN
from fraudlake.session import shared_path
from fraudlake.streaming import monitoring as mon
from fraudlake.streaming.scoring import score_stream, start_alert_sink, with_counters

WAVES = 4
#: Rows in a file of a staged stream; the number of files follows from the rows.
ROWS_PER_FILE = 100_000


def _folder(spark, name: str) -> str:
    return shared_path(spark, "fraudlake-live", f"{name}-{uuid.uuid4().hex}")


class _Waves:
    """Rows of a table dealt into waves of files, put into a stream's folder wave by wave."""

    def __init__(self, spark, rows, wave, waves: int = WAVES):
        self.spark, self.waves = spark, waves
        self.folder, self.staged = _folder(spark, "waves"), _folder(spark, "staged")
        self.schema = rows.schema
        rows.withColumn("_wave", F.least(F.greatest(wave, F.lit(0)), F.lit(waves - 1)).cast("int")).write.partitionBy("_wave").parquet(self.staged)
        self.table = spark.read.schema(StructType([*rows.schema.fields, StructField("_wave", IntegerType())])).parquet(self.staged)
        most = self.table.groupBy("_wave").count().agg(F.max("count")).first()[0] or 0
        self.files = max(1, min(512, -(-most // ROWS_PER_FILE)))

    def put(self, first: int, last: int) -> None:
        for w in range(first, last):
            self.table.where(F.col("_wave") == w).drop("_wave").repartition(self.files).write.mode("append").parquet(self.folder)

    def stream(self):
        """Read ``files`` files a micro-batch."""
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", self.files).parquet(self.folder)


def _by_rank(rows, column: str, waves: int = WAVES):
    """Wave number by the place of ``column`` between its bounds."""
    lim = rows.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    lo, hi = lim.lo or 0, lim.hi or 0
    return F.floor((F.col(column) - lo) * waves / (hi - lo + 1))


# --- scoring through a restart ---------------------------------------------------------------


def _scored_through_restart(spark, sf, scorer=None, metadata=None):
    """(scored rows, progress log, waves): two waves, the query ends, two more waves, restart from its checkpoint."""
    txn = P.transactions(spark, sf).select("seq", *TXN.fieldNames())
    waves = _Waves(spark, txn, _by_rank(txn, "seq"))
    out, checkpoint, log = _folder(spark, "scored"), _folder(spark, "scored-ck"), _folder(spark, "progress")

    def start():
        chain = with_counters(score_stream(waves.stream(), scorer=scorer, metadata=metadata))
        kept = chain.select("seq", "status", "fan_in_dest_count_24h", "fraud_probability", "is_alert", "threshold", "model_version")
        return kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()

    waves.put(0, 2)
    mon.watch(spark, start, log)
    waves.put(2, WAVES)
    mon.watch(spark, start, log)
    return spark.read.parquet(out), log, waves


@register(
    "X4_X6_score_stream_restart",
    with_views("SELECT seq, status, fan_in_dest_count_24h, fraud_probability, is_alert, threshold, model_version FROM chain", "chain"),
)
def q_x4_stream(spark, sf):
    """The scored stream, stopped after two waves and started again: each row once, as the batch chain scores it."""
    return _scored_through_restart(spark, sf)[0]


@register(
    "A5_X6_observed_counters",
    with_views(
        """SELECT * FROM (
             SELECT CAST(count(*) FILTER (WHERE status = 'scored') AS BIGINT) AS scored, CAST(count(*) FILTER (WHERE is_alert) AS BIGINT) AS alerts,
                    CAST(count(*) FILTER (WHERE status = 'score_error') AS BIGINT) AS score_errors, CAST(count(*) FILTER (WHERE status = 'skipped') AS BIGINT) AS skipped,
                    CAST(count(*) FILTER (WHERE status = 'dq_rejected') AS BIGINT) AS dq_rejected, CAST(count(*) FILTER (WHERE status IN ('scored','score_error')) AS BIGINT) AS fan_in_events
             FROM chain) UNPIVOT (total FOR counter IN (scored, alerts, score_errors, skipped, dq_rejected, fan_in_events))""",
        "chain",
    ),
)
def q_a5_stream(spark, sf):
    """The counters observed by both runs of the scored stream, from the progress log."""
    _, log, _ = _scored_through_restart(spark, sf)
    return mon.logged_counters(spark, log).where(~F.col("counter").startswith("gdpr"))


@register(
    "X4_M3_model_stream",
    with_views("SELECT seq, CASE WHEN status = 'score_error' THEN 'scored' ELSE status END AS status, true AS agrees FROM chain", "chain"),
)
def q_x4_model(spark, sf):
    """The same stream with the boosted trees as scorer, beside the batch chain with the same model."""
    from fraudlake.operators import model as M
    from fraudlake.plans.catalog_more import _trained

    model, n_trees, _, threshold, _ = _trained(spark, sf)
    meta = {"phase": "gbt", "num_trees": n_trees, "decision_threshold": threshold, "features": list(FEATURES)}
    live, _, _ = _scored_through_restart(spark, sf, M.model_scorer(model), meta)
    batch = score_chain(P.transactions(spark, sf), scorer=M.model_scorer(model), metadata=meta)
    same = ["status", "fan_in_dest_count_24h", "is_alert", "threshold", "model_version"]
    both = live.join(batch.select("seq", *[F.col(c).alias(f"_{c}") for c in same], F.col("fraud_probability").alias("_p")), "seq", "left")
    agrees = F.lit(True)
    for c in same:
        agrees = agrees & F.col(c).eqNullSafe(F.col(f"_{c}"))
    p, q = F.col("fraud_probability"), F.col("_p")
    return both.select("seq", "status", (agrees & ((p.isNull() & q.isNull()) | F.coalesce(F.abs(p - q) < 1e-12, F.lit(False)))).alias("agrees"))


@register(
    "K4_alert_sink_stream",
    with_views(
        f"""SELECT coalesce(d.account_alias, c.nameDest) AS key, coalesce(o.account_alias, t.nameOrig) AS name_orig, c.fraud_probability, CAST(c.fan_in_dest_count_24h AS BIGINT) AS fan_in,
                   CAST({SCORECARD_METADATA["decision_threshold"]} AS DOUBLE) AS threshold, c.model_version
            FROM chain c JOIN transactions t USING (seq) LEFT JOIN alias_map d ON d.account_id = c.nameDest LEFT JOIN alias_map o ON o.account_id = t.nameOrig WHERE c.is_alert""",
        "chain",
        "alias_map",
    ),
)
def q_k4(spark, sf):
    """Alerts of the stream as JSON messages, masked by the registry, read back."""
    txn = P.transactions(spark, sf).select("seq", *TXN.fieldNames())
    waves = _Waves(spark, txn, _by_rank(txn, "seq"))
    waves.put(0, WAVES)
    reg = _folder(spark, "registry")
    P.registry(spark, sf).write.parquet(reg)
    out = _folder(spark, "alerts")
    start_alert_sink(score_stream(waves.stream()), out, _folder(spark, "alerts-ck"), registry=spark.read.parquet(reg)).awaitTermination()
    sent = spark.read.schema("key string, value string").json(out)
    body = "txn struct<nameOrig:string,fan_in_dest_count_24h:long>, fraud_probability double, threshold double, model_version string"
    a = sent.select("key", F.from_json("value", body).alias("a"))
    return a.select("key", F.col("a.txn.nameOrig").alias("name_orig"), "a.fraud_probability", F.col("a.txn.fan_in_dest_count_24h").alias("fan_in"), "a.threshold", "a.model_version")


# --- heartbeats ----------------------------------------------------------------------------------

BEATS = 12


@register(
    "X8_heartbeat",
    with_views(
        f"""SELECT batch_id, 'ConsumerHeartbeat' AS metric, CAST(1 AS BIGINT) AS value, CAST(count(*) AS BIGINT) AS input_rows, CAST(0 AS BIGINT) AS missing
            FROM (SELECT CAST(least(floor((seq - lo) * {BEATS} / (hi - lo + 1)), {BEATS - 1}) AS BIGINT) AS batch_id
                  FROM transactions, (SELECT min(seq) AS lo, max(seq) AS hi FROM transactions)) GROUP BY batch_id""",
        "transactions",
    ),
)
def q_x8(spark, sf):
    """A stream with more reports than Spark keeps: every one is in the log, with no gap."""
    rows = P.transactions(spark, sf).select("seq")
    waves, log = _Waves(spark, rows, _by_rank(rows, "seq", BEATS), BEATS), _folder(spark, "beats")
    waves.put(0, BEATS)
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept, "100")
    spark.conf.set(kept, "3")
    try:
        out, checkpoint = _folder(spark, "beat-rows"), _folder(spark, "beat-ck")
        start = lambda: waves.stream().writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        mon.watch(spark, start, log)
    finally:
        spark.conf.set(kept, before)
    beats = mon.heartbeats(spark, log).where("batch_id >= 0 AND input_rows > 0")
    gaps = mon.progress_gaps(beats).select("run_id", F.col("missing").cast("long").alias("missing"))
    return beats.join(gaps, "run_id").select("batch_id", "metric", "value", "input_rows", "missing")


# --- rollups and alarms ----------------------------------------------------------------------------


def _points(spark, sf):
    """Monitoring points (ts, metric, value) with their number by time."""
    return P.metric_points(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))


def _time_wave(points, late: bool):
    """Waves by time; with ``late`` every 50th point comes two waves later."""
    second = F.unix_seconds("ts")
    lim = points.agg(F.min(second).alias("lo"), F.max(second).alias("hi")).first()
    lo, hi = lim.lo or 0, lim.hi or 0
    return F.floor((second - lo) * WAVES / (hi - lo + 1)) + (F.when(F.pmod(F.xxhash64("ts", "metric"), F.lit(50)) == 0, 2).otherwise(0) if late else F.lit(0))


def _rolled_stream(spark, sf):
    points = _points(spark, sf)
    waves, root = _Waves(spark, points, _time_wave(points, late=True)), _folder(spark, "rollup")
    waves.put(0, WAVES)
    mon.start_rollup(waves.stream(), root, _folder(spark, "rollup-ck"), trigger="availableNow").awaitTermination()
    return mon.rolled_up(spark, root)


@register("X9_rollup_stream", with_views("SELECT * FROM rollup5", "rollup5"))
def q_x9_stream(spark, sf):
    """The streamed rollup with points that come two waves late: none is lost."""
    ntz = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return _rolled_stream(spark, sf).select(ntz("window_start"), ntz("window_end"), "metric", "total")


@register(
    "X10_alarm_stream",
    with_views(
        """SELECT metric, window_start, window_end, total, CAST(CASE metric WHEN 'ScorerErrorCount' THEN 5 ELSE 50 END AS DOUBLE) AS threshold,
              total > CASE metric WHEN 'ScorerErrorCount' THEN 5 ELSE 50 END AS alarm
           FROM rollup5 WHERE metric IN ('ScorerErrorCount', 'FraudAlertCount')""",
        "rollup5",
    ),
)
def q_x10_stream(spark, sf):
    """Threshold alarms of the streamed rollup, corrections included."""
    found = mon.alarms_of(_rolled_stream(spark, sf))
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@register("X11_dead_mans_switch_stream", "")
def q_x11_stream(spark, sf):
    """The switch over stored points; a tick of the metric ends the last period."""
    points = _points(spark, sf).withColumn("tick", F.lit(False))
    end = points.agg(F.max("ts").alias("hi")).withColumn("hi", F.timestamp_seconds((F.floor(F.unix_seconds("hi") / 60) + 1) * 60))
    tick = end.select(F.col("hi").alias("ts"), F.lit("ConsumerHeartbeat").alias("metric"), F.lit(0).cast("long").alias("value"), F.lit(True).alias("tick")).where("ts IS NOT NULL")
    rows = points.unionByName(tick)
    waves, out = _Waves(spark, rows, _time_wave(rows, late=False)), _folder(spark, "switch")
    waves.put(0, WAVES)
    found = mon.dead_mans_switch(waves.stream(), 60, 1.0, 3, timers=False)
    found.writeStream.format("parquet").option("path", out).option("checkpointLocation", _folder(spark, "switch-ck")).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    mine = spark.read.schema(mon.SWITCH).parquet(out).where("metric = 'ConsumerHeartbeat' AND NOT late")
    return mine.select(F.col("period_start").cast("timestamp_ntz").alias("period_start"), "total", "breach", "alarm")


def _share_batch_oracle() -> None:
    """The streamed switch is checked by the batch form's SQL."""
    from fraudlake.plans.catalog import QUERIES

    QUERIES["X11_dead_mans_switch_stream"] = (q_x11_stream, QUERIES["X11_W5_dead_mans_switch"][1])


_share_batch_oracle()
