"""Boosted-tree model: train, early stop and freeze, score, save / load.

MLlib's GBTClassifier trains distributed over binned features. Early stopping
watches the area under the precision-recall curve of a validation slice, round by
round. Training goes in stages of ever more rounds, each saved before it is judged; it
ends with the first stage in which ``patience`` rounds brought no gain, and the frozen
model is the prefix of that stage's trees up to the best round (no refit). One pass
over the validation rows gives the margins after every round; they are counted in
fine bins, and the staged average precision is computed from the counts.
"""

from __future__ import annotations

import json
import uuid

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fraudlake.operators import evaluate as ev
from fraudlake.schemas import (
    FEATURES,
    GBT_MAX_DEPTH,
    GBT_MAX_ITER,
    GBT_PATIENCE,
    GBT_SEED,
    GBT_STEP_SIZE,
)
from fraudlake.paths import delete_path, list_names, path_exists, rename_path
from fraudlake.session import checkpoint_root, shared_path


# MLlib trees have no missing-value branch: a missing feature (a null balance
# passes the quality gate) is encoded as a value below every real one, so a
# split can isolate it, identically in training and scoring.
MISSING = -1.0e9


def fill_missing(df: DataFrame, features=FEATURES) -> DataFrame:
    return df.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(MISSING)) for f in features})


def weighted(train: DataFrame, label: str = "is_fraud") -> tuple[DataFrame, float]:
    """Attach ``weight`` = negatives/positives for positives, 1 otherwise."""
    w = train.agg(
        (F.sum((F.col(label) == 0).cast("double")) / F.nullif(F.sum((F.col(label) == 1).cast("double")), F.lit(0.0))).alias("w")
    ).first()["w"]
    w = float(w or 1.0)
    return train.withColumn("weight", F.when(F.col(label) == 1, F.lit(w)).otherwise(F.lit(1.0))), w


def gbt_pipeline(max_iter: int = GBT_MAX_ITER, features=FEATURES, label: str = "is_fraud", max_bins: int = 256) -> Pipeline:
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    gbt = GBTClassifier(
        featuresCol="features",
        labelCol=label,
        weightCol="weight",
        maxIter=max_iter,
        maxDepth=GBT_MAX_DEPTH,
        stepSize=GBT_STEP_SIZE,
        maxBins=max_bins,
        seed=GBT_SEED,
        cacheNodeIds=False,  # a row walks GBT_MAX_DEPTH nodes at most: less than a cached id a level costs
        checkpointInterval=10,
    )
    return Pipeline(stages=[assembler, gbt])


def train_gbt(train: DataFrame, max_iter: int = GBT_MAX_ITER, features=FEATURES, label: str = "is_fraud") -> tuple[PipelineModel, float]:
    """Fit on the training rows; returns (model, class weight)."""
    checkpoint_root(train.sparkSession)  # boosting checkpoints to the shared folder
    data, w = weighted(fill_missing(train.select(*features, label), features), label)
    data = data.withColumn(label, F.col(label).cast("double"))
    return gbt_pipeline(max_iter, features, label).fit(data), w


# --- the trees as rows -------------------------------------------------------------------

TREE_ROWS = "tree int, node int, feature int, threshold double, left int, right int, prediction double, gain double, rows double, weight double"


def tree_rows(spark: SparkSession, saved: str) -> DataFrame:
    """The nodes of a saved pipeline's trees, one row each (:data:`TREE_ROWS`).

    A leaf has ``feature`` -1; rows with feature value <= ``threshold`` go left; ``rows``
    is the weight of the training rows in the node, ``weight`` that of the tree.
    """
    (stage,) = [n for n in list_names(spark, f"{saved}/stages") if "GBT" in n]
    d = "nodeData"
    nodes = spark.read.parquet(f"{saved}/stages/{stage}/data").select(
        F.col("treeID").alias("tree"), F.col(f"{d}.id").alias("node"), F.col(f"{d}.split.featureIndex").alias("feature"),
        F.get(f"{d}.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"), F.col(f"{d}.leftChild").alias("left"), F.col(f"{d}.rightChild").alias("right"),
        F.col(f"{d}.prediction").alias("prediction"), F.col(f"{d}.gain").alias("gain"), F.get(f"{d}.impurityStats", F.lit(0)).alias("rows"),
    )
    weights = spark.read.parquet(f"{saved}/stages/{stage}/treesMetadata").select(F.col("_1").alias("tree"), F.col("_3").alias("weight"))
    return nodes.join(weights, "tree").select(*[c.split()[0] for c in TREE_ROWS.split(", ")])


def scored_by_rows(df: DataFrame, nodes: DataFrame, keys: list[str], depth: int = GBT_MAX_DEPTH, features=FEATURES) -> DataFrame:
    """``keys`` and ``probability`` of every row, by joins with the tree rows alone.

    Each row walks down all trees at once, a join a level: what SQL needs to score the
    model where MLlib is not at hand. ``keys`` must name a row.
    """
    x = fill_missing(df, features).select(*keys, F.array(*features).alias("x"))
    n_trees = nodes.agg(F.coalesce(F.max("tree") + 1, F.lit(0))).first()[0]
    at = x.select("*", F.explode(F.array(*[F.lit(t) for t in range(n_trees)])).alias("tree"), F.lit(0).alias("at"))  # at the root of every tree
    step = nodes.select("tree", F.col("node").alias("at"), "feature", "threshold", "left", "right")
    for _ in range(depth):
        at = at.join(F.broadcast(step), ["tree", "at"])
        down = F.when(F.col("feature") < 0, F.col("at")).when(F.get("x", F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        at = at.select(*keys, "x", "tree", down.alias("at"))
    leaves = nodes.select("tree", F.col("node").alias("at"), (F.col("prediction") * F.col("weight")).alias("part"))
    margin = at.join(F.broadcast(leaves), ["tree", "at"]).groupBy(*keys).agg(F.sum("part").alias("margin"))
    return margin.select(*keys, (1 / (1 + F.exp(-2 * F.col("margin")))).alias("probability"))


def importance_from_rows(nodes: DataFrame, features=FEATURES) -> DataFrame:
    """Feature importances from the tree rows: the gain of each split times its training
    rows, summed by feature over all trees, as a share of the whole."""
    names = F.array(*[F.lit(f) for f in features])
    shares = nodes.where("feature >= 0").groupBy("feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("s"))
    shares = shares.withColumn("importance", F.col("s") / F.sum("s").over(Window.partitionBy()))  # a row a feature
    every = nodes.sparkSession.range(len(features)).select(F.col("id").cast("int").alias("feature"))
    out = every.join(F.broadcast(shares), "feature", "left")
    return out.select(F.get(names, F.col("feature")).alias("feature"), F.coalesce("importance", F.lit(0.0)).alias("importance"))


# --- staged validation ----------------------------------------------------------------------

MARGIN_BINS, MARGIN_SPAN = 1 << 14, 16.0  # bins of the margin from -8 to 8; further out are the outer bins


def margins_by_round(x: np.ndarray, tree: dict[str, np.ndarray], bounds: np.ndarray, depth: int):
    """Margins after each round of rows ``x`` (features in order); node arrays of one tree lie from bounds[t] on."""
    margin = np.zeros(len(x))
    rows = np.arange(len(x))
    for t in range(len(bounds) - 1):
        at = np.full(len(x), bounds[t])
        for _ in range(depth):
            f = tree["feature"][at]
            left = x[rows, np.maximum(f, 0)] <= tree["threshold"][at]
            down = np.where(left, tree["left"][at], tree["right"][at]) + bounds[t]
            at = np.where(f < 0, at, down)
        margin = margin + tree["prediction"][at] * tree["weight"][at]
        yield t, margin


def staged_counts(rows: DataFrame, nodes: DataFrame, features=FEATURES, label: str = "is_fraud", depth: int = GBT_MAX_DEPTH) -> DataFrame:
    """(round, bin, tp, fp): positives and negatives of every round by bin of the margin."""
    listed = nodes.orderBy("tree", "node").toPandas()  # the model: rounds * (2 ** (depth + 1) - 1) rows at most
    arrays = {c: listed[c].to_numpy() for c in ("feature", "threshold", "left", "right", "prediction", "weight")}
    arrays["threshold"] = np.nan_to_num(arrays["threshold"].astype(float))
    trees = listed["tree"].to_numpy()
    bounds = np.append(np.flatnonzero(np.append(True, trees[1:] != trees[:-1])), len(trees))
    if not (listed["node"].to_numpy() == np.arange(len(trees)) - bounds[:-1].repeat(np.diff(bounds))).all():
        raise ValueError("the nodes of a tree are not numbered in order")
    walk, n_bins, span = margins_by_round, MARGIN_BINS, MARGIN_SPAN  # values, not names of this module: executors need not have it
    schema = "round int, bin int, tp long, fp long"

    def task(batches):
        import numpy as np
        import pyarrow as pa

        sums = {}
        for batch in batches:
            x = np.column_stack([batch.column(f).to_numpy(zero_copy_only=False) for f in features])
            y = batch.column(label).to_numpy(zero_copy_only=False) == 1
            for r, margin in walk(x, arrays, bounds, depth):
                at = np.clip(np.floor((margin + span / 2) / span * n_bins), 0, n_bins - 1).astype(np.int64)
                tp, fp = np.bincount(at[y], minlength=n_bins), np.bincount(at[~y], minlength=n_bins)
                if r in sums:
                    sums[r][0][:] += tp
                    sums[r][1][:] += fp
                else:
                    sums[r] = (tp, fp)
        for r, (tp, fp) in sums.items():
            b = np.flatnonzero(tp + fp)
            yield pa.record_batch([pa.array(np.full(len(b), r), pa.int32()), pa.array(b, pa.int32()), pa.array(tp[b], pa.int64()), pa.array(fp[b], pa.int64())], names=["round", "bin", "tp", "fp"])

    staged = fill_missing(rows, features).select(*features, F.col(label).cast("int").alias(label))
    return staged.mapInArrow(task, schema).groupBy("round", "bin").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"))


def staged_average_precision(counts: DataFrame) -> DataFrame:
    """(round, average_precision) from the counts by bin; a round has at most MARGIN_BINS rows."""
    down = Window.partitionBy("round").orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("round")
    ct, cf = F.sum("tp").over(down), F.sum("fp").over(down)
    steps = counts.select("round", (F.col("tp") / F.nullif(F.sum("tp").over(whole), F.lit(0)) * ct / (ct + cf)).alias("s"))
    return steps.groupBy("round").agg(F.coalesce(F.sum("s"), F.lit(0.0)).alias("average_precision"))


def stop_round(scores: list[float], patience: int) -> tuple[int, bool]:
    """(best round, whether ``patience`` later rounds brought no gain)."""
    best = 0
    for i, v in enumerate(scores):
        if v > scores[best]:
            best = i
        elif i - best >= patience:
            return best, True
    return best, False


def prefix_model(model: PipelineModel, n_trees: int) -> PipelineModel:
    """The pipeline with the first ``n_trees`` trees of its ensemble."""
    gbt = model.stages[-1]
    java, spark = gbt._java_obj, SparkSession.getActiveSession()
    gateway, jvm = spark.sparkContext._gateway, spark._jvm
    every, weights = java.trees(), java.treeWeights()
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n_trees)
    kept = gateway.new_array(jvm.double, n_trees)
    for i in range(n_trees):
        trees[i], kept[i] = every[i], weights[i]
    cut = GBTClassificationModel(jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), trees, kept, java.numFeatures(), java.numClasses()))
    cut._resetUid(gbt.uid)
    return PipelineModel([*model.stages[:-1], gbt._copyValues(cut)])


def early_stop_freeze(
    train: DataFrame,
    valid: DataFrame,
    max_iter: int = GBT_MAX_ITER,
    patience: int = GBT_PATIENCE,
    features=FEATURES,
    label: str = "is_fraud",
    store: str | None = None,
) -> tuple[PipelineModel, int, list[float]]:
    """(frozen model, its trees, validation average precision of each round trained).

    The first stage has ``2 * patience`` rounds, each further one twice as many, up to
    ``max_iter``. A stage's ensemble is saved under ``store`` (a folder of one training
    set; default: a fresh one in the shared folder), so a run that died goes on with the
    last stage saved, and a finished training is found again. Without positives in
    ``valid`` every round scores 0 and the first is kept. Rounds count from 0.
    """
    spark = train.sparkSession
    store = store or shared_path(spark, "fraudlake-models", uuid.uuid4().hex)
    rounds = min(max(2 * patience, 1), max_iter)
    while True:
        saved = f"{store}/rounds-{rounds}"
        if not path_exists(spark, saved):
            hidden = f"{store}/_rounds-{rounds}-{uuid.uuid4().hex}"
            train_gbt(train, rounds, features, label)[0].write().save(hidden)
            if not rename_path(spark, hidden, saved) and not path_exists(spark, saved):
                raise RuntimeError(f"could not keep the trained stage {saved}")
            delete_path(spark, hidden)
        staged = staged_average_precision(staged_counts(valid, tree_rows(spark, saved), features, label)).collect()  # a row a round
        scores = [0.0] * rounds
        for r in staged:
            scores[r["round"]] = float(r["average_precision"])
        best, stopped = stop_round(scores, patience)
        if stopped or rounds >= max_iter:
            return prefix_model(PipelineModel.load(saved), best + 1), best + 1, scores
        rounds = min(2 * rounds, max_iter)


def model_scorer(model: PipelineModel):
    """Scorer for the scoring chain: ``fraud_probability`` = P(class 1)."""

    def score(df: DataFrame) -> DataFrame:
        raw = {f: F.col(f) for f in FEATURES}
        out = model.transform(fill_missing(df.withColumns({f"_raw_{f}": c for f, c in raw.items()})))
        out = out.withColumns({f: F.col(f"_raw_{f}") for f in FEATURES}).drop(*[f"_raw_{f}" for f in FEATURES])
        return out.withColumn("fraud_probability", vector_to_array(F.col("probability"))[1]).drop(
            "features", "rawPrediction", "probability", "prediction"
        )

    return score


def feature_importance(model: PipelineModel, features=FEATURES) -> DataFrame:
    """Gain-style importance per feature, sorted descending."""
    spark = SparkSession.getActiveSession()
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = [(f, float(v)) for f, v in zip(features, imp)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc())


def freeze_metadata_frame(counts: DataFrame, points: DataFrame, threshold: float, version: str, features=FEATURES) -> DataFrame:
    """One metadata row: the threshold (picked on rows other than these), PR-AUC, confusion."""
    t, cm = threshold, ev.confusion_of_counts(counts, threshold)
    ap = ev.average_precision(points).first()["average_precision"]
    return cm.select(
        F.lit(float(t)).alias("decision_threshold"),
        F.lit(ap).cast("double").alias("pr_auc"),
        (F.col("tp").cast("double") / (F.col("tp") + F.col("fp")).cast("double")).alias("precision"),
        (F.col("tp").cast("double") / (F.col("tp") + F.col("fn")).cast("double")).alias("recall"),
        F.col("tn").alias("true_negatives"),
        F.col("fp").alias("false_positives"),
        F.col("fn").alias("false_negatives"),
        F.col("tp").alias("true_positives"),
        F.lit(version).alias("model_version"),
        F.lit(",".join(features)).alias("features"),
    )


def save_model(model: PipelineModel, metadata: dict, path: str) -> None:
    """Pipeline model + metadata JSON (written through Spark, so any
    Hadoop-compatible store works)."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(metadata),)], "metadata string").coalesce(1).write.mode("overwrite").text(
        f"{path}/metadata"
    )


def load_model(path: str) -> tuple[PipelineModel, dict]:
    """Load both artifacts; fails loudly when either is absent."""
    spark = SparkSession.getActiveSession()
    for part in ("model", "metadata"):
        if not path_exists(spark, f"{path}/{part}"):
            raise FileNotFoundError(f"frozen model artifact {part!r} not found under {path}")
    model = PipelineModel.load(f"{path}/model")
    meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    return model, meta
