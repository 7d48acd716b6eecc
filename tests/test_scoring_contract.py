"""Scoring contract, wiring, training shapes and counter deltas."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMOKE
from fraudlake.functions.features import feature_array, feature_map, scoring_features
from fraudlake.operators import monitor
from fraudlake.operators.score import SCORECARD_METADATA, model_version, score_chain, scorecard_scorer
from fraudlake.operators.split import extract_training, temporal_split, write_splits
from fraudlake.plans import pipeline as P
from fraudlake.schemas import FEATURES, TXN


def _txn(spark, rows):
    return spark.createDataFrame(rows, T_SEQ)


T_SEQ = "seq long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TXN.fields)


def _row(seq, **kw):
    base = dict(step=1, type="CASH_OUT", amount=181.0, nameOrig="C0000000001", oldbalanceOrg=181.0,
                newbalanceOrig=0.0, nameDest="C0000000002", oldbalanceDest=0.0, newbalanceDest=181.0,
                isFraud=0, isFlaggedFraud=None)
    base.update(kw)
    return (seq, *[base[f.name] for f in TXN.fields])


def test_threshold_version_and_guard_come_from_metadata(spark):
    meta = {"phase": "5b_enriched", "num_trees": 143, "decision_threshold": 0.25, "features": list(FEATURES)}
    df = _txn(spark, [_row(1), _row(2, type="PAYMENT"), _row(3, amount=-1.0)])
    out = {r.seq: r for r in score_chain(df, metadata=meta).collect()}
    assert model_version(meta) == "5b_enriched-t143"
    assert out[1].threshold == 0.25 and out[1].model_version == "5b_enriched-t143"
    assert out[1].is_alert == (out[1].fraud_probability >= 0.25)
    # untrained type: never scored; rejected row: neither scored nor skipped
    assert out[2].status == "skipped" and out[2].fraud_probability is None and out[2].threshold is None
    assert out[3].status == "dq_rejected" and out[3].fraud_probability is None


def test_missing_flag_and_fan_in_default_to_zero(spark):
    df = _txn(spark, [_row(1)])
    feats = scoring_features(df).first()
    assert feats.is_flagged_fraud == 0.0 and feats.fan_in_dest_count_24h == 0.0
    row = scoring_features(df).select(feature_map().alias("m"), feature_array().alias("a")).first()
    assert set(row.m) == set(FEATURES) and row.m["has_balance_orig"] == 1.0
    assert row.a == [row.m[f] for f in FEATURES]  # the array keeps the frozen order


def test_same_scorer_batch_equals_direct(spark):
    df = _txn(spark, [_row(1), _row(2, amount=5000.0, nameDest="C0000000003")])
    chain = {r.seq: r.fraud_probability for r in score_chain(df).collect()}
    direct = {r.seq: r.fraud_probability for r in scorecard_scorer()(scoring_features(df)).collect()}
    assert chain == direct  # first events of each destination: fan-in 0 either way


def test_training_extract_and_split_shapes(spark, workdir):
    g = P.gold_only(spark, SF_SMOKE)
    ex = extract_training(g)
    assert ex.columns == list(FEATURES) + ["step", "is_fraud"]  # 11 columns, no ids
    lab, cut = P.labelled(spark, SF_SMOKE)
    train, test = temporal_split(extract_training(g), cut)
    assert train.count() + test.count() == ex.count()
    assert train.where(F.col("step") > cut).count() == 0 and test.where(F.col("step") <= cut).count() == 0
    tp, sp = os.path.join(workdir, "train"), os.path.join(workdir, "test")
    write_splits(train, test, tp, sp)
    assert len(spark.read.parquet(tp).columns) == 10 and "step" not in spark.read.parquet(sp).columns


def test_counter_deltas_per_metric(spark):
    cum = spark.createDataFrame(
        [("scored", 1, 15), ("alerts", 1, 3), ("score_errors", 1, 1),
         ("scored", 2, 20), ("alerts", 2, 5), ("score_errors", 2, 2)],
        "metric string, window_start int, cumulative long",
    )
    d = {(r.metric, r.window_start): r.delta for r in monitor.metric_deltas(cum).collect()}
    assert (d[("scored", 2)], d[("alerts", 2)], d[("score_errors", 2)]) == (5, 2, 1)


def test_scorecard_metadata_is_frozen_feature_order():
    assert SCORECARD_METADATA["features"] == list(FEATURES)
