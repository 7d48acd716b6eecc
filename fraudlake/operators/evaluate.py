"""Classifier evaluation as aggregations.

Everything starts from one aggregate per distinct score (``tp``, ``fp``), built
with map-side combine. Curves need running sums in descending score; they come
from :func:`cumulative_by_order` (range buckets + offsets), never from a
single-partition window over all rows. Threshold statistics are conditional
sums over that per-score aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake.plans.strategies import cumulative_by_order, cumulative_by_order_plain
from fraudlake.schemas import F1_EPSILON, FEATURES, OPERATING_THRESHOLDS


def score_counts(scored: DataFrame, score: str = "score", label: str = "label", by: tuple[str, ...] = ()) -> DataFrame:
    """One row per distinct score (and value of the columns ``by``): positives ``tp`` and negatives ``fp``.

    Rows without a score have a row of their own (score NULL): no threshold ever
    predicts them positive, so their positives are missed at every threshold.
    """
    return (
        scored.groupBy(*by, F.col(score).alias("score"))
        .agg(
            F.sum((F.col(label) == 1).cast("long")).alias("tp"),
            F.sum((F.col(label) != 1).cast("long")).alias("fp"),
        )
    )


def curve_points(counts: DataFrame, scale_form: bool = True, n_buckets: int | None = None) -> DataFrame:
    """Running ``cum_tp``, ``cum_fp`` at each distinct score (descending), with
    the class totals ``P`` and ``N`` (unscored rows included) and the unscored
    rows of each class ``U_tp`` and ``U_fp`` as literal columns (driver scalars
    from one aggregate).

    ``scale_form``: range buckets with offsets; False: one ordered window (tests).
    """
    none = F.col("score").isNull()
    totals = counts.agg(
        F.sum("tp").alias("P"), F.sum("fp").alias("N"), F.sum(F.when(none, F.col("tp"))).alias("U_tp"), F.sum(F.when(none, F.col("fp"))).alias("U_fp")
    ).first()
    scored = counts.where(~none)
    cum = (
        cumulative_by_order(scored, "score", ["tp", "fp"], descending=True, n_buckets=n_buckets)
        if scale_form
        else cumulative_by_order_plain(scored, "score", ["tp", "fp"], descending=True)
    )
    return cum.withColumns({c: F.lit(int(totals[c] or 0)) for c in ("P", "N", "U_tp", "U_fp")})


def pr_curve(points: DataFrame) -> DataFrame:
    """precision and recall at every distinct score used as threshold."""
    prec = F.col("cum_tp").cast("double") / (F.col("cum_tp") + F.col("cum_fp")).cast("double")
    rec = F.col("cum_tp").cast("double") / F.col("P").cast("double")
    return points.select(F.col("score").alias("threshold"), prec.alias("precision"), rec.alias("recall"), "cum_tp", "cum_fp")


def roc_curve(points: DataFrame) -> DataFrame:
    """FPR/TPR at every distinct score (collinear points are kept)."""
    return points.select(
        F.col("score").alias("threshold"),
        (F.col("cum_fp").cast("double") / F.col("N").cast("double")).alias("fpr"),
        (F.col("cum_tp").cast("double") / F.col("P").cast("double")).alias("tpr"),
    )


def average_precision(points: DataFrame) -> DataFrame:
    """sum over thresholds of (R_n - R_(n-1)) * P_n (step-wise, not trapezoid)."""
    term = (F.col("tp").cast("double") / F.col("P").cast("double")) * (
        F.col("cum_tp").cast("double") / (F.col("cum_tp") + F.col("cum_fp")).cast("double")
    )
    return points.agg(F.round(F.sum(term), 9).alias("average_precision"))


def _twice_auc():
    scored = F.sum(F.lit(2) * F.col("tp") * (F.col("N") - F.col("cum_fp")) + F.col("tp") * F.col("fp"))
    return scored + F.first("U_tp") * F.first("U_fp")


def roc_auc(points: DataFrame) -> DataFrame:
    """Rank AUC with ties counted half, from exact integer sums; unscored rows rank last, tied."""
    twice = _twice_auc()
    return points.agg(
        F.round(twice.cast("double") / (F.lit(2.0) * F.first("P").cast("double") * F.first("N").cast("double")), 9).alias(
            "roc_auc"
        )
    )


def summary_metrics(points: DataFrame) -> DataFrame:
    """``pr_auc`` (average precision) and ``roc_auc`` in one aggregate."""
    ap = F.sum((F.col("tp").cast("double") / F.col("P").cast("double")) * (
        F.col("cum_tp").cast("double") / (F.col("cum_tp") + F.col("cum_fp")).cast("double")
    ))
    twice = _twice_auc()
    auc = twice.cast("double") / (F.lit(2.0) * F.first("P").cast("double") * F.first("N").cast("double"))
    return points.agg(F.round(ap, 9).alias("pr_auc"), F.round(auc, 9).alias("roc_auc"))


def f1_column(prec, rec):
    return (F.lit(2.0) * prec * rec) / (prec + rec + F.lit(F1_EPSILON))


def best_threshold(pr: DataFrame) -> DataFrame:
    """Arg-max of F1 over the PR curve; a tie takes the lowest threshold.

    ``orderBy(...).limit(1)`` plans as a distributed top-1 (TakeOrdered).
    """
    with_f1 = pr.withColumn("f1", f1_column(F.col("precision"), F.col("recall")))
    return with_f1.orderBy(F.col("f1").desc(), F.col("threshold").asc()).limit(1).select(
        "threshold", "precision", "recall", "f1"
    )


def threshold_of(best: DataFrame, default: float = 0.5) -> float:
    """The threshold of :func:`best_threshold`'s row, or ``default`` where no row was scored."""
    row = best.first()
    return default if row is None else row["threshold"]


def confusion(scored: DataFrame, threshold: float, score: str = "score", label: str = "label") -> DataFrame:
    """tn, fp, fn, tp at ``score >= threshold``, one pass; no score: predicted negative."""
    pred = F.coalesce(F.col(score) >= F.lit(threshold), F.lit(False))
    pos = F.col(label) == 1
    return scored.agg(
        F.sum((~pred & ~pos).cast("long")).alias("tn"),
        F.sum((pred & ~pos).cast("long")).alias("fp"),
        F.sum((~pred & pos).cast("long")).alias("fn"),
        F.sum((pred & pos).cast("long")).alias("tp"),
    )


def confusion_of_counts(counts: DataFrame, threshold: float) -> DataFrame:
    """:func:`confusion` from the per-score counts, without the scored rows."""
    pred = F.coalesce(F.col("score") >= F.lit(threshold), F.lit(False))
    part = lambda on, c: F.sum(F.when(on, F.col(c)).otherwise(0)).cast("long")
    return counts.agg(part(~pred, "fp").alias("tn"), part(pred, "fp").alias("fp"), part(~pred, "tp").alias("fn"), part(pred, "tp").alias("tp"))


def _safe_div(a, b):
    return F.when(b > 0, a.cast("double") / b.cast("double")).otherwise(F.lit(0.0))


def _f1_plain(p, r):
    return F.when(p + r > 0, F.lit(2.0) * (p * r) / (p + r)).otherwise(F.lit(0.0))


def classification_report(cm: DataFrame) -> DataFrame:
    """Per class precision / recall / F1 / support, accuracy, macro and
    weighted averages, derived from the confusion counts (one row in)."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    p1, r1 = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    p0, r0 = _safe_div(tn, tn + fn), _safe_div(tn, tn + fp)
    s0, s1 = (tn + fp), (tp + fn)
    base = cm.select(
        p0.alias("p0"), r0.alias("r0"), p1.alias("p1"), r1.alias("r1"),
        s0.alias("s0"), s1.alias("s1"), ((tp + tn).cast("double") / (s0 + s1).cast("double")).alias("acc"),
    ).withColumns({"f0": _f1_plain(F.col("p0"), F.col("r0")), "f1": _f1_plain(F.col("p1"), F.col("r1"))})
    s0c, s1c = F.col("s0").cast("double"), F.col("s1").cast("double")
    tot = s0c + s1c

    def row(name, p, r, f, s):
        return F.struct(
            F.lit(name).alias("label"),
            F.round(p, 9).alias("precision"),
            F.round(r, 9).alias("recall"),
            F.round(f, 9).alias("f1_score"),
            s.cast("long").alias("support"),
        )

    none = F.lit(None).cast("double")
    rows = F.array(
        row("0", F.col("p0"), F.col("r0"), F.col("f0"), F.col("s0")),
        row("1", F.col("p1"), F.col("r1"), F.col("f1"), F.col("s1")),
        row("accuracy", none, none, F.col("acc"), F.col("s0") + F.col("s1")),
        row("macro avg", (F.col("p0") + F.col("p1")) / 2.0, (F.col("r0") + F.col("r1")) / 2.0,
            (F.col("f0") + F.col("f1")) / 2.0, F.col("s0") + F.col("s1")),
        row("weighted avg", (F.col("p0") * s0c + F.col("p1") * s1c) / tot, (F.col("r0") * s0c + F.col("r1") * s1c) / tot,
            (F.col("f0") * s0c + F.col("f1") * s1c) / tot, F.col("s0") + F.col("s1")),
    )
    return base.select(F.inline(rows))


def threshold_matrix(counts: DataFrame, best: float, extra=OPERATING_THRESHOLDS) -> DataFrame:
    """precision, recall, F1, FP, FN at each operating threshold.

    Thresholds are literals, so the whole matrix is one aggregate of
    conditional sums over the per-score counts (no row multiplication).
    """
    ths = sorted(set([float(t) for t in extra] + [float(best)]))
    aggs = [F.sum("tp").alias("P"), F.sum("fp").alias("N")]
    for i, t in enumerate(ths):
        aggs.append(F.sum(F.when(F.col("score") >= F.lit(t), F.col("tp")).otherwise(0)).alias(f"tp{i}"))
        aggs.append(F.sum(F.when(F.col("score") >= F.lit(t), F.col("fp")).otherwise(0)).alias(f"fp{i}"))
    wide = counts.agg(*aggs)
    rows = []
    for i, t in enumerate(ths):
        tp, fp = F.col(f"tp{i}"), F.col(f"fp{i}")
        fn = F.col("P") - tp
        p, r = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
        rows.append(
            F.struct(
                F.lit(t).alias("threshold"),
                p.alias("precision"),
                r.alias("recall"),
                _f1_plain(p, r).alias("f1_score"),
                fp.cast("long").alias("fp"),
                fn.cast("long").alias("fn"),
            )
        )
    return wide.select(F.inline(F.array(*rows)))


def cohort(score: str = "score", label: str = "label", threshold: float = 0.5):
    """FN / TP / FP / TN from label and prediction; no score: predicted negative."""
    pred = F.coalesce(F.col(score) >= F.lit(threshold), F.lit(False))
    pos = F.col(label) == 1
    return (
        F.when(pos & ~pred, "FN").when(pos & pred, "TP").when(~pos & pred, "FP").otherwise("TN")
    )


def cohort_means(scored: DataFrame, threshold: float, features=FEATURES, score="score", label="label") -> DataFrame:
    """Mean of each feature per FN / TP / FP cohort, as feature x cohort."""
    tagged = scored.withColumn("cohort", cohort(score, label, threshold))
    tagged = tagged.where(F.col("cohort") != "TN")
    means = tagged.groupBy("cohort").agg(*[F.avg(F.col(f).cast("double")).alias(f) for f in features])
    long = means.unpivot("cohort", list(features), "feature", "mean")
    return (
        long.groupBy("feature")
        .pivot("cohort", ["FN", "TP", "FP"])
        .agg(F.round(F.first("mean"), 6) + F.lit(0.0))  # no negative zero
        .withColumnsRenamed({"FN": "fn_mean", "TP": "tp_mean", "FP": "fp_mean"})
    )


def score_range(scored: DataFrame, score: str = "score") -> DataFrame:
    return scored.agg(F.min(score).alias("min_probability"), F.max(score).alias("max_probability"))


def compare_models(metrics: dict[str, DataFrame]) -> DataFrame:
    """Union of one-row metric frames, tagged by model name."""
    frames = [df.withColumn("model", F.lit(name)) for name, df in metrics.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
