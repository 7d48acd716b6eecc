"""Monitoring: counters, metric rollups, threshold and missing-data alarms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fraudlake.schemas import ALARM_RULES


def stream_counters(chain: DataFrame, erasure_checks: DataFrame | None = None) -> DataFrame:
    """The live scorer's counters as one conditional aggregate over the chain.

    ``erasure_checks`` (optional) has ``bad`` and ``purged`` booleans per
    erasure message.
    """
    s = F.col("status")
    out = chain.agg(
        F.sum((s == "scored").cast("long")).alias("scored"),
        F.sum(F.col("is_alert").cast("long")).alias("alerts"),
        F.sum((s == "score_error").cast("long")).alias("score_errors"),
        F.sum((s == "skipped").cast("long")).alias("skipped"),
        F.sum((s == "dq_rejected").cast("long")).alias("dq_rejected"),
        F.sum(s.isin("scored", "score_error").cast("long")).alias("fan_in_events"),
    )
    if erasure_checks is None:
        return out.withColumns({"gdpr_purges": F.lit(0).cast("long"), "gdpr_bad_payloads": F.lit(0).cast("long")})
    g = erasure_checks.agg(
        F.sum(F.col("purged").cast("long")).alias("gdpr_purges"),
        F.sum(F.col("bad").cast("long")).alias("gdpr_bad_payloads"),
    )
    # two one-row aggregates side by side: tag and pivot through a union
    return _side_by_side(out, g)


def _side_by_side(a: DataFrame, b: DataFrame) -> DataFrame:
    cols_a, cols_b = a.columns, b.columns
    left = a.select(*[F.col(c) for c in cols_a], *[F.lit(None).cast("long").alias(c) for c in cols_b])
    right = b.select(*[F.lit(None).cast("long").alias(c) for c in cols_a], *[F.col(c) for c in cols_b])
    u = left.unionByName(right)
    return u.agg(*[F.max(c).alias(c) for c in cols_a + cols_b])


def skipped_by_type(chain: DataFrame) -> DataFrame:
    return chain.where(F.col("status") == "skipped").groupBy("type").agg(F.count(F.lit(1)).alias("skipped"))


def rollup(points: DataFrame, period_s: int, ts: str = "ts", metric: str = "metric", value: str = "value") -> DataFrame:
    """Sum per period per metric (tumbling windows aligned to the epoch)."""
    w = F.window(F.col(ts), f"{period_s} seconds")
    return points.groupBy(w.alias("w"), F.col(metric)).agg(F.sum(value).alias("total")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), metric, "total"
    )


def rules_frame(spark: SparkSession, rules=ALARM_RULES) -> DataFrame:
    return spark.createDataFrame(
        [tuple(r) for r in rules],
        "metric string, comparison string, threshold double, period_s int, evaluation_periods int, missing_breaches boolean",
    )


def breaches(rolled: DataFrame, rules, on=("metric",)) -> DataFrame:
    """The rolled windows that a rule names, with its threshold and whether it is passed."""
    r = F.broadcast(rules_frame(rolled.sparkSession, rules))  # a row a rule
    breach = (
        F.when(F.col("comparison") == ">", F.col("total") > F.col("threshold"))
        .when(F.col("comparison") == "<", F.col("total") < F.col("threshold"))
        .when(F.col("comparison") == ">=", F.col("total") >= F.col("threshold"))
        .otherwise(F.col("total") <= F.col("threshold"))
    )
    return rolled.join(r, list(on), "inner").select("metric", "window_start", "window_end", "total", "threshold", breach.alias("alarm"))


def threshold_alarm(spark: SparkSession, points: DataFrame, rules=ALARM_RULES) -> DataFrame:
    """Workload alarms: Sum over the rule's period compared with its threshold.

    Rules are rows (a literal table, broadcast: its size is the rule count)
    joined to the rollup by metric name.
    """
    single = [r for r in rules if r[4] == 1 and not r[5]]
    frames = []
    for period in sorted({r[3] for r in single}):
        frames.append(rollup(points, period).withColumn("period_s", F.lit(period)))
    rolled = frames[0]
    for f in frames[1:]:
        rolled = rolled.unionByName(f)
    return breaches(rolled, single, ("metric", "period_s"))


def consecutive_breach(df: DataFrame, partition_cols, order_col: str, breach_col: str, n: int, out: str = "alarm") -> DataFrame:
    """True where the last ``n`` periods (this one included) all breach."""
    w = Window.partitionBy(*partition_cols).orderBy(order_col).rowsBetween(-(n - 1), 0)
    return df.withColumn(out, F.sum(F.col(breach_col).cast("int")).over(w) == F.lit(n))


def consecutive_breach_periods(
    df: DataFrame, keys, ts: str, period_s: int, breach_col: str, n: int, out: str = "alarm"
) -> DataFrame:
    """Distributed form of :func:`consecutive_breach` on a complete period
    spine: period p alarms when p and the ``n - 1`` periods before it breach.

    Each earlier period is found by an equi-join on the shifted period start
    (no window ordered by time alone, so no single-partition step); a period
    missing before the series starts counts as not breaching, as in the
    window form."""
    flags = df.select(*keys, ts, F.col(breach_col).cast("int").alias("_b0"))
    acc = flags
    for k in range(1, n):
        prev = flags.select(
            *keys,
            (F.col(ts) + F.make_dt_interval(secs=F.lit(k * period_s).cast("decimal(18,6)"))).alias(ts),
            F.col("_b0").alias(f"_b{k}"),
        )
        acc = acc.join(prev, [*keys, ts], "left")
    total = sum((F.coalesce(F.col(f"_b{k}"), F.lit(0)) for k in range(n)), F.lit(0))
    alarms = acc.select(*keys, ts, (total == F.lit(n)).alias(out))
    return df.join(alarms, [*keys, ts], "left")


def missing_data_alarm(
    points: DataFrame,
    metric_name: str,
    period_s: int = 60,
    threshold: float = 1.0,
    evaluation_periods: int = 3,
    ts: str = "ts",
    as_of=None,
) -> DataFrame:
    """Dead-man's switch: Sum < threshold in N consecutive periods, where a
    period with no data point counts as 0 (breaching).

    The series runs from the metric's first point to ``as_of`` (a datetime; by
    default the last point of any metric), so a metric that falls silent alarms.

    The period spine is generated in parallel with ``spark.range`` over the
    observed time span, left-joined to the rollup.
    """
    spark = points.sparkSession
    mine = points.where(F.col("metric") == metric_name)
    rolled = rollup(mine, period_s, ts=ts)
    mine_is = F.col("metric") == metric_name
    bounds = points.agg(F.min(F.when(mine_is, F.col(ts))).alias("lo"), F.max(ts).alias("hi")).first()
    if bounds["lo"] is None:
        return spark.createDataFrame([], "period_start timestamp_ntz, total double, breach boolean, alarm boolean")
    day0 = bounds["lo"].replace(hour=0, minute=0, second=0, microsecond=0)
    first_offset = int((bounds["lo"] - day0).total_seconds() // period_s) * period_s
    n = int(((as_of or bounds["hi"]) - day0).total_seconds() // period_s) - first_offset // period_s + 1
    day0_lit = F.lit(day0.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    spine = spark.range(0, n).select(
        (day0_lit + F.make_dt_interval(secs=(F.col("id") * period_s + first_offset).cast("decimal(18,6)"))).alias(
            "period_start"
        )
    )
    joined = spine.join(rolled.select(F.col("window_start").alias("period_start"), "total"), "period_start", "left")
    filled = joined.withColumn("total", F.coalesce(F.col("total"), F.lit(0)).cast("double"))
    flagged = filled.withColumn("breach", F.col("total") < F.lit(threshold))
    return consecutive_breach_periods(flagged, [], "period_start", period_s, "breach", evaluation_periods)


def metric_deltas(cumulative: DataFrame, metric: str = "metric", order: str = "window_start", value: str = "cumulative") -> DataFrame:
    """Cumulative counter -> per-interval delta: ``value - lag(value, 1, 0)``."""
    w = Window.partitionBy(metric).orderBy(order)
    return cumulative.withColumn("delta", F.col(value) - F.lag(F.col(value), 1, 0).over(w))


def cumulative_counts(rolled: DataFrame, metric: str = "metric", order: str = "window_start") -> DataFrame:
    """Running total per metric over periods (what a counter would report)."""
    w = Window.partitionBy(metric).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rolled.withColumn("cumulative", F.sum("total").over(w))
