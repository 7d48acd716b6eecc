"""Early stopping by staged average precision, prefixes of an ensemble, trees as rows."""

import os

import pytest
from pyspark.sql import functions as F

from fraudlake.operators import evaluate as ev
from fraudlake.operators import model as M

NAMES = ("a", "b", "c")


@pytest.fixture(scope="module")
def noisy(spark):
    """A table on which more rounds help for a while."""
    rows = spark.range(0, 4000, numPartitions=4).select("id", *[((F.xxhash64("id", F.lit(k)) % 1000) / 500.0).alias(n) for k, n in enumerate(NAMES)])
    odds = F.sin(F.col("a") * 3) + F.col("b") * F.col("c") + ((F.xxhash64("id", F.lit(9)) % 1000) / 700.0)
    rows = rows.withColumn("is_fraud", (odds > 1.2).cast("int")).withColumn("a", F.when(F.col("id") % 50 != 0, F.col("a"))).checkpoint()
    return rows.where("id % 4 < 3"), rows.where("id % 4 = 3")


def test_stop_round_waits_for_patience():
    assert M.stop_round([0.1, 0.3, 0.2, 0.3, 0.2], 3) == (1, True)
    assert M.stop_round([0.1, 0.3, 0.2, 0.3], 3) == (1, False)
    assert M.stop_round([0.1, 0.2, 0.3], 1) == (2, False) and M.stop_round([], 3) == (0, False)
    assert M.stop_round([0.5, 0.1, 0.9], 1) == (0, True)  # later gains are not seen


def test_training_stops_early_and_goes_on_from_saved_stages(spark, noisy, workdir, monkeypatch):
    fit, valid = noisy
    store = os.path.join(workdir, "store")
    model, n_trees, scores = M.early_stop_freeze(fit, valid, max_iter=40, patience=2, features=NAMES, store=store)
    assert n_trees <= len(scores) <= 40 and (len(scores) - n_trees >= 2 or len(scores) == 40)
    assert scores[n_trees - 1] == max(scores[: n_trees + 2]) and len(model.stages[-1].trees) == n_trees
    stages = sorted(os.listdir(store))
    assert all(s.startswith("rounds-") for s in stages) and f"rounds-{len(scores)}" in stages

    def never(*_, **__):
        raise AssertionError("trained again")

    monkeypatch.setattr(M, "train_gbt", never)
    again, n, s = M.early_stop_freeze(fit, valid, max_iter=40, patience=2, features=NAMES, store=store)
    assert (n, s) == (n_trees, scores)
    # the frozen model's own scores give the average precision of its round
    scored = again.transform(M.fill_missing(valid, NAMES)).select(M.vector_to_array("probability")[1].alias("score"), F.col("is_fraud").alias("label"))
    exact = ev.average_precision(ev.curve_points(ev.score_counts(scored))).first()[0]
    assert abs(exact - scores[n_trees - 1]) < 5e-3


def test_prefix_holds_the_first_trees_of_a_longer_ensemble(spark, noisy, workdir):
    fit, valid = noisy
    short, _ = M.train_gbt(fit, 3, NAMES)
    long, _ = M.train_gbt(fit, 6, NAMES)
    cut = M.prefix_model(long, 3)
    score = lambda m: [r[0] for r in m.transform(M.fill_missing(valid, NAMES)).orderBy("id").select(M.vector_to_array("probability")[1]).collect()]
    assert max(abs(a - b) for a, b in zip(score(cut), score(short), strict=True)) < 1e-9
    assert cut.stages[-1].treeWeights == short.stages[-1].treeWeights and cut.stages[-1].numFeatures == 3
    cut.write().save(os.path.join(workdir, "cut"))
    assert max(abs(a - b) for a, b in zip(score(M.PipelineModel.load(os.path.join(workdir, "cut"))), score(cut), strict=True)) == 0


def test_tree_rows_score_and_weigh_features_like_the_model(spark, noisy, workdir):
    fit, valid = noisy
    model, _ = M.train_gbt(fit, 4, NAMES)
    path = os.path.join(workdir, "m")
    model.write().save(path)
    nodes = M.tree_rows(spark, path)
    assert nodes.columns == [c.split()[0] for c in M.TREE_ROWS.split(", ")]
    own = {r.id: r.probability for r in M.scored_by_rows(valid, nodes, ["id"], features=NAMES).collect()}
    want = {r.id: r.p for r in model.transform(M.fill_missing(valid, NAMES)).select("id", M.vector_to_array("probability")[1].alias("p")).collect()}
    assert own.keys() == want.keys() and max(abs(own[i] - want[i]) for i in own) < 1e-12
    weights = dict(M.importance_from_rows(nodes, NAMES).collect())
    mllib = dict(zip(NAMES, model.stages[-1].featureImportances.toArray().tolist(), strict=True))
    assert weights.keys() == mllib.keys() and max(abs(weights[n] - mllib[n]) for n in NAMES) < 1e-9


def test_validation_without_positives_or_rows_keeps_the_first_tree(spark, noisy):
    fit, valid = noisy
    for v in (valid.where("is_fraud = 0"), valid.limit(0)):
        _, n_trees, scores = M.early_stop_freeze(fit, v, max_iter=2, patience=1, features=NAMES)
        assert n_trees == 1 and set(scores) == {0.0}


def test_no_rows_have_a_cut_and_a_threshold(spark):
    from fraudlake.operators import split

    none = spark.createDataFrame([], "step int, score double, label int")
    assert split.split_cut(none) == 0.0
    best = ev.best_threshold(ev.pr_curve(ev.curve_points(ev.score_counts(none))))
    assert ev.threshold_of(best) == 0.5 and ev.confusion(none, ev.threshold_of(best)).count() == 1


def test_trees_are_the_same_with_and_without_cached_node_ids(spark, noisy, monkeypatch):
    fit, _ = noisy
    assert not M.gbt_pipeline().getStages()[-1].getCacheNodeIds()  # shallow trees: the cache costs more than the walk
    plain = M.gbt_pipeline
    trees = lambda: M.train_gbt(fit, 3, NAMES)[0].stages[-1].toDebugString.split("\n", 1)[1]

    def cached(*args):
        pipeline = plain(*args)
        pipeline.getStages()[-1].setCacheNodeIds(True)
        return pipeline

    without = trees()
    monkeypatch.setattr(M, "gbt_pipeline", cached)
    assert without == trees()
