"""Driver contract, monitoring and the boosted-tree model path."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMOKE
from fraudlake.operators import model as M
from fraudlake.operators import monitor
from fraudlake.operators.score import score_chain
from fraudlake.plans import pipeline as P


def test_entry_runs_with_stable_schema(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:9] == ["amount", "has_balance_orig", "balance_delta_orig", "error_balance_orig",
                              "has_balance_dest", "balance_delta_dest", "error_balance_dest",
                              "is_flagged_fraud", "fan_in_dest_count_24h"]


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", ["F2_dq_reasons", "W2_fan_in_arrival", "A13_threshold_matrix", "X11_W5_dead_mans_switch"])
def test_oracle_agrees_at_smoke_scale(spark, key):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in ("events", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    cur = con.execute(E.oracle_sql()[key])
    cols = [d[0] for d in cur.description]
    want = sorted(tuple(str(r[cols.index(c)]) for c in sorted(cols)) for r in cur.fetchall())
    df = E.queries()[key](spark, SF_SMOKE)
    got = sorted(tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect())
    assert sorted(df.columns) == sorted(cols)
    assert got == want


def test_heartbeat_missing_periods_breach(spark):
    pts = spark.createDataFrame(
        [("2024-01-01 00:00:10", "ConsumerHeartbeat", 1), ("2024-01-01 00:04:30", "ConsumerHeartbeat", 1)],
        "ts string, metric string, value long",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    out = monitor.missing_data_alarm(pts, "ConsumerHeartbeat", 60, 1.0, 3).orderBy("period_start").collect()
    assert [r.breach for r in out] == [False, True, True, True, False]
    assert [r.alarm for r in out] == [False, False, False, True, False]


def test_metric_deltas_from_counters(spark):
    cum = spark.createDataFrame([("scored", 1, 15), ("scored", 2, 20)], "metric string, window_start int, cumulative long")
    assert [r.delta for r in monitor.metric_deltas(cum).orderBy("window_start").collect()] == [15, 5]


def test_train_freeze_save_load_score(spark, workdir):
    lab, _ = P.labelled(spark, SF_SMOKE)
    train = lab.where(F.col("split") == "train")
    valid = lab.where(F.col("split") == "test")
    model, n_trees, losses = M.early_stop_freeze(train, valid, max_iter=6, patience=3)
    assert 1 <= n_trees <= 6 and len(losses) == 6
    imp = M.feature_importance(model).collect()
    assert len(imp) == 9 and imp[0].importance >= imp[-1].importance
    path = os.path.join(workdir, "model")
    meta = {"phase": "gbt", "num_trees": n_trees, "decision_threshold": 0.5, "features": []}
    M.save_model(model, meta, path)
    loaded, meta2 = M.load_model(path)
    assert meta2["num_trees"] == n_trees
    chain = score_chain(P.transactions(spark, SF_SMOKE), scorer=M.model_scorer(loaded), metadata=meta2)
    scored = chain.where(F.col("status") == "scored")
    assert scored.count() > 0
    assert scored.where((F.col("fraud_probability") < 0) | (F.col("fraud_probability") > 1)).count() == 0
    with pytest.raises(FileNotFoundError):
        M.load_model(os.path.join(workdir, "absent"))


def test_distributed_breach_equals_window(spark):
    import __spark_entry__ as E

    got = E.queries()["X11_W5_dead_mans_switch"](spark, SF_SMOKE)
    plain = monitor.consecutive_breach(got.drop("alarm"), [], "period_start", "breach", 3)
    a = {(r.period_start, r.alarm) for r in got.collect()}
    assert a == {(r.period_start, r.alarm) for r in plain.collect()} and len(a) > 10
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_metric_that_falls_silent_alarms(spark):
    rows = [(f"2024-01-01 00:{m:02d}:00", "ConsumerHeartbeat", 1) for m in range(3)] + [("2024-01-01 00:30:00", "ScoredTransactions", 1)]
    pts = spark.createDataFrame(rows, "ts string, metric string, value long").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    out = monitor.missing_data_alarm(pts, "ConsumerHeartbeat", 60, 1.0, 3).orderBy("period_start").collect()
    assert len(out) == 31 and [i for i, r in enumerate(out) if r.alarm] == list(range(5, 31))


def test_rows_without_a_score_are_missed_positives(spark):
    from fraudlake.operators import evaluate as ev

    scored = spark.createDataFrame([(0.9, 1), (0.8, 0), (None, 1), (0.1, 0), (None, 0)], "score double, label int")
    cm = ev.confusion(scored, 0.5).first()
    assert ev.confusion_of_counts(ev.score_counts(scored), 0.5).first() == cm
    assert (cm.tn, cm.fp, cm.fn, cm.tp) == (2, 1, 1, 1)
    pts = ev.curve_points(ev.score_counts(scored), n_buckets=2)
    assert {r.recall for r in ev.pr_curve(pts).collect()} == {0.5}
    # pairs: 0.9 beats 0.8, 0.1, none; the unscored positive ties with the unscored negative only
    assert abs(ev.roc_auc(pts).first()[0] - 3.5 / 6) < 1e-9


def test_model_queries_train_the_whole_job_each(spark, monkeypatch):
    whole, asked = M.early_stop_freeze, []

    def short(train, valid, max_iter=M.GBT_MAX_ITER, **more):
        asked.append((max_iter, more.get("patience", M.GBT_PATIENCE)))
        return whole(train, valid, max_iter=2, **more)

    monkeypatch.setattr(M, "early_stop_freeze", short)
    for key in ("M1_M2_train_early_stop", "A19_O3_feature_importance"):
        assert E.queries()[key](spark, SF_SMOKE).count() > 0
    assert asked == [(300, 15), (300, 15)]
