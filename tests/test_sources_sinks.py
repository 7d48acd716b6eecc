"""Sources and sinks: CSV, cache, replay, requests, alerts, catalog, JSON, lateness, heartbeats."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMOKE
from fraudlake.functions.alias import account_alias_py
from fraudlake.operators import erasure
from fraudlake.operators.score import alert_messages, alerts, score_chain
from fraudlake.plans import pipeline as P
from fraudlake.schemas import TXN
from fraudlake.sources import txn as S
from fraudlake.streaming.bronze import json_file_stream, replay_table
from fraudlake.streaming.fanin_state import fan_in_state
from fraudlake.streaming.monitoring import heartbeat_frame, windowed_rollup


def test_read_csv_with_fixed_schema(spark, workdir):
    p = os.path.join(workdir, "t.csv")
    with open(p, "w") as f:
        f.write(",".join(TXN.fieldNames()) + "\n")
        f.write("1,CASH_OUT,181.0,C1,181.0,0.0,C2,0.0,181.0,1,0\n")
    df = S.read_txn_csv(spark, p)
    assert df.schema == TXN and df.first().amount == 181.0


def test_read_through_cache_builds_once(spark, workdir):
    path = os.path.join(workdir, "cache")
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    assert S.read_through_cache(spark, path, build).count() == 5
    assert S.read_through_cache(spark, path, build).count() == 5
    assert len(calls) == 1


def test_page_bounds_and_no_overlap(spark):
    t = P.transactions(spark, SF_SMOKE)
    a = [r.seq for r in S.page(t, 0, 100).collect()]
    b = [r.seq for r in S.page(t, 100, 100).collect()]
    assert len(a) == len(b) == 100 and not set(a) & set(b)
    assert sorted(a) == [r.seq for r in S.page(t, 0, 100, dense=True).orderBy("seq").collect()]
    with pytest.raises(ValueError):
        S.page(t, -1, 10)
    with pytest.raises(ValueError):
        S.page(t, 0, 1001)
    resp = S.page_response(t, 10, 5)
    assert resp["count"] == t.count() and [d["seq"] for d in resp["data"]] == list(range(10, 15))


def test_read_erasure_requests_json_list(spark, workdir):
    p = os.path.join(workdir, "req.json")
    with open(p, "w") as f:
        json.dump([{"account_id": "C1", "request_id": "r1"}, {"account_id": "C2", "request_id": "r2"}], f)
    assert sorted(r.account_id for r in S.read_erasure_requests(spark, p).collect()) == ["C1", "C2"]


def test_paced_replay_resumes_from_checkpoint(spark, workdir):
    t = P.transactions(spark, SF_SMOKE)
    folder = os.path.join(workdir, "replay")
    n_files = replay_table(spark, t, folder, rows_per_file=250)
    assert n_files == 4
    ck = os.path.join(workdir, "ck")
    q = (json_file_stream(spark, folder, 1).writeStream.format("memory").queryName("replayed")
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("replayed").count() == t.count()
    assert len([p for p in q.recentProgress if p.numInputRows > 0]) == n_files  # one file per trigger


def test_alert_sink_masks_registered_ids(spark):
    chain = score_chain(P.transactions(spark, SF_SMOKE))
    hits = alerts(chain)
    first = hits.first()
    amap = spark.createDataFrame([(first.nameDest, account_alias_py(first.nameDest, "p"))], "account_id string, account_alias string")
    msgs = alert_messages(hits, amap).collect()
    assert len(msgs) == hits.count()
    assert all(first.nameDest not in m.value for m in msgs)
    parsed = json.loads(msgs[0].value)
    assert set(parsed) == {"txn", "fraud_probability", "threshold", "model_version"}


def test_register_external_table(spark, workdir):
    path = os.path.join(workdir, "reg")
    spark.createDataFrame([("C1", "A", "r1", "t")], "account_id string, account_alias string, request_id string, requested_at string").write.parquet(path)
    erasure.register_external(spark, "gdpr_requests_ext", path)
    assert spark.table("gdpr_requests_ext").count() == 1
    spark.sql("DROP TABLE gdpr_requests_ext")


def test_encode_json_round_trip(spark):
    t = P.transactions(spark, SF_SMOKE).limit(20)
    enc = t.select("seq", F.to_json(F.struct(*TXN.fieldNames())).alias("value"))
    dec = S.decode_txn(enc, keep=("seq",), with_ingest_time=False)
    a = {r.seq: tuple(r[c] for c in TXN.fieldNames()) for r in t.collect()}
    b = {r.seq: tuple(r[c] for c in TXN.fieldNames()) for r in dec.collect()}
    assert a == b


def test_late_events_are_flagged(spark, workdir):
    src = os.path.join(workdir, "late")
    rows = [("A", 1, "txn", 100), ("A", 2, "txn", 130), ("A", 3, "txn", 101)]
    spark.createDataFrame(rows, "key string, seq long, kind string, step int").coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("key string, seq long, kind string, step int").parquet(src)
    q = (fan_in_state(stream, lateness=2).writeStream.format("memory").queryName("late_q")
         .option("checkpointLocation", os.path.join(workdir, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    out = {r.seq: r for r in spark.table("late_q").collect()}
    assert out[3].late is True and out[2].late is False
    assert out[3].fan_in_dest_count_24h == 0  # step 100 was evicted (older than 130-24-2)


def test_heartbeats_from_progress_and_streaming_rollup(spark, workdir):
    src = os.path.join(workdir, "pts")
    spark.createDataFrame(
        [("2024-01-01 00:01:00", "ScorerErrorCount", 1), ("2024-01-01 00:02:00", "ScorerErrorCount", 1),
         ("2024-01-01 00:07:00", "ScorerErrorCount", 1)],
        "ts string, metric string, value long",
    ).withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("ts timestamp, metric string, value long").parquet(src)
    q = (windowed_rollup(stream, "5 minutes", "1 minute").writeStream.format("memory").queryName("rollup_q")
         .outputMode("append").option("checkpointLocation", os.path.join(workdir, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((str(r.window_start), r.total) for r in spark.table("rollup_q").collect())
    assert got[0] == ("2024-01-01 00:00:00", 2)
    hb = heartbeat_frame(spark, q)
    assert hb.count() == len(q.recentProgress) >= 1
    assert hb.where(F.col("metric") == "ConsumerHeartbeat").count() == hb.count()


def test_streaming_threshold_alarm(spark, workdir):
    from fraudlake.streaming.monitoring import threshold_alarm_stream

    src = os.path.join(workdir, "alarm_pts")
    errs = ["00:00:10", "00:01:00", "00:01:30", "00:02:00", "00:03:00", "00:04:00", "00:05:00"]
    rows = [(f"2024-01-01 {t}", "ScorerErrorCount", 1) for t in errs]  # 6 in 00:00-00:05, 1 after
    rows += [("2024-01-01 00:02:00", "FraudAlertCount", 1), ("2024-01-01 00:40:00", "ScorerErrorCount", 1)]
    spark.createDataFrame(rows, "ts string, metric string, value long").withColumn("ts", F.to_timestamp("ts")) \
        .coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("ts timestamp, metric string, value long").parquet(src)
    q = (threshold_alarm_stream(stream, "5 minutes", "1 minute").writeStream.format("memory").queryName("alarm_q")
         .outputMode("append").option("checkpointLocation", os.path.join(workdir, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    out = {(r.metric, str(r.window_start)): (r.total, r.alarm) for r in spark.table("alarm_q").collect()}
    assert out[("ScorerErrorCount", "2024-01-01 00:00:00")] == (6, True)  # > 5 in 5 minutes
    assert out[("ScorerErrorCount", "2024-01-01 00:05:00")] == (1, False)
    assert out[("FraudAlertCount", "2024-01-01 00:00:00")] == (1, False)
