"""Structured Streaming: Bronze fork, keyed fan-in state, purge, scoring."""

import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMOKE
from fraudlake.operators.fanin import fan_in_arrival
from fraudlake.paths import LakePaths
from fraudlake.plans import pipeline as P
from fraudlake.schemas import TXN
from fraudlake.streaming.bronze import start_bronze
from fraudlake.streaming.fanin_state import control_stream, fan_in_state
from fraudlake.streaming.scoring import score_stream, with_counters

CONTROL_SCHEMA = "key string, seq long, kind string, step int"


def _run_to_memory(df, name, checkpoint):
    q = (df.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def _write_control(spark, rows, folder, n_files=1):
    df = spark.createDataFrame(rows, CONTROL_SCHEMA)
    for i in range(n_files):
        part = df.where(F.col("seq") % n_files == i) if n_files > 1 else df
        part.coalesce(1).write.mode("append").parquet(folder)


def _fan(spark, workdir, rows, name):
    src = os.path.join(workdir, "src")
    _write_control(spark, rows, src)
    stream = spark.readStream.schema(CONTROL_SCHEMA).parquet(src)
    _run_to_memory(fan_in_state(stream), name, os.path.join(workdir, "ckpt"))
    return {r.seq: r for r in spark.table(name).collect()}


def test_window_semantics_match_reference(spark, workdir):
    # new key 0; excludes the current event; evicts beyond 24 steps
    rows = [("A", i, "txn", 100 + i) for i in range(25)] + [("A", 25, "txn", 125)]
    rows += [("B", 100, "txn", 7), ("B", 101, "txn", 7), ("B", 102, "txn", 7)]
    rows += [("C", 200, "txn", 5), ("C", 201, "txn", 6), ("D", 300, "txn", 5), ("D", 301, "txn", 6)]
    out = _fan(spark, workdir, rows, "fan_sem")
    assert out[0].fan_in_dest_count_24h == 0
    assert out[25].fan_in_dest_count_24h == 24
    assert [out[s].fan_in_dest_count_24h for s in (100, 101, 102)] == [0, 1, 2]
    assert out[201].fan_in_dest_count_24h == 1 and out[301].fan_in_dest_count_24h == 1


def test_purge_clears_only_that_key(spark, workdir):
    rows = [("A", 1, "txn", 5), ("A", 2, "txn", 6), ("B", 3, "txn", 6), ("A", 4, "purge", None),
            ("Z", 5, "purge", None), ("A", 6, "txn", 7), ("B", 7, "txn", 7)]
    out = _fan(spark, workdir, rows, "fan_purge")
    assert out[4].purged is True and out[5].purged is False
    assert out[6].fan_in_dest_count_24h == 0  # restart after purge
    assert out[7].fan_in_dest_count_24h == 1  # other key untouched


def test_stream_equals_batch_arrival_form(spark, workdir):
    s = P.bronze(spark, SF_SMOKE).where(F.col("type").isin("CASH_OUT", "TRANSFER"))
    src = os.path.join(workdir, "ctl")
    ctl = control_stream(s)
    # three micro-batches by seq range: state carries across batches
    bounds = s.agg(F.min("seq"), F.max("seq")).first()
    edges = [bounds[0] + (bounds[1] - bounds[0] + 1) * i // 3 for i in range(4)]
    for lo, hi in zip(edges, edges[1:]):
        ctl.where((F.col("seq") >= lo) & (F.col("seq") < hi)).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(ctl.schema).option("maxFilesPerTrigger", 1).parquet(src)
    _run_to_memory(fan_in_state(stream), "fan_eq", os.path.join(workdir, "ck"))
    got = {r.seq: r.fan_in_dest_count_24h for r in spark.table("fan_eq").collect()}
    want = {r.seq: r.fan_in_dest_count_24h for r in fan_in_arrival(s).collect()}
    assert got == want and len(got) == s.count()


def _payment(step, kind, cents, dest, seq, **more):
    """A balanced payment record: the originator pays ``cents`` out of a full account."""
    value = cents / 100
    record = {"step": step, "type": kind, "amount": value, "nameOrig": f"C7{seq:08d}", "oldbalanceOrg": value + 12.5,
              "newbalanceOrig": 12.5, "nameDest": dest, "oldbalanceDest": 3.25, "newbalanceDest": 3.25 + value,
              "isFraud": 0, "isFlaggedFraud": 0}
    return {**record, **more}


SHOP, VAULT = "C600000001", "C600000002"
# two destinations: SHOP gets four scorable payments within a day, VAULT one large one
DAY = [
    _payment(10, "CASH_OUT", 4_250, SHOP, 0),
    _payment(12, "PAYMENT", 999, "C600000003", 1),
    _payment(15, "TRANSFER", 73_100, SHOP, 2),
    _payment(15, "TRANSFER", 88_888_800, VAULT, 3),
    _payment(21, "CASH_OUT", 60, SHOP, 4, amount=None),
    _payment(30, "CASH_OUT", 31_415, SHOP, 5),
    _payment(33, "CASH_IN", 2_000, SHOP, 6),
    _payment(34, "TRANSFER", 50, SHOP, 7, oldbalanceOrg=-4.0),
    _payment(36, "CASH_OUT", 12_000, SHOP, 8),
]


def _large_is_fraud(df):
    return df.withColumn("fraud_probability", F.when(F.col("amount") > 500_000, F.lit(0.97)).otherwise(F.lit(0.02)))


META = {"phase": "unit", "num_trees": 3, "decision_threshold": 0.75}


def _counters(q):
    total = {}
    for p in q.recentProgress:
        for row in (p.observedMetrics or {}).values():
            for k, v in row.asDict().items():
                total[k] = total.get(k, 0) + (v or 0)
    return total


def test_scoring_chain_of_one_day(spark, workdir):
    src = os.path.join(workdir, "day")
    os.makedirs(src)
    with open(os.path.join(src, "day.json"), "w") as f:
        f.writelines(json.dumps({**m, "seq": i}) + "\n" for i, m in enumerate(DAY))
    schema = T.StructType(TXN.fields + [T.StructField("seq", T.LongType())])  # a new schema: TXN stays as is
    chain = with_counters(score_stream(spark.readStream.schema(schema).json(src), scorer=_large_is_fraud, metadata=META))
    q = _run_to_memory(chain, "day_chain", os.path.join(workdir, "ck"))
    rows = {r.seq: r for r in spark.table("day_chain").collect()}
    got = {i: rows[i].status for i in rows}
    rejected = {i for i, s in got.items() if s == "dq_rejected"}
    assert {i for i, s in got.items() if s == "skipped"} == {1, 6} and 4 in rejected and len(rows) == len(DAY)
    scored = {i for i, s in got.items() if s == "scored"}
    assert scored | rejected == {0, 2, 3, 4, 5, 7, 8}
    shop = sorted(scored - {3})
    assert [rows[i].fan_in_count for i in shop] == [sum(DAY[i]["step"] - 24 <= DAY[j]["step"] for j in shop if j < i) for i in shop]
    assert [(i, r.fraud_probability, r.threshold) for i, r in rows.items() if r.is_alert] == [(3, 0.97, 0.75)]
    c = _counters(q)
    assert (c["scored"], c["alerts"], c["skipped"], c["dq_rejected"], c["gdpr_purges"]) == (len(scored), 1, 2, len(rejected), 0)


def test_late_rows_of_later_batches_are_flagged_and_never_dropped(spark, workdir):
    src = os.path.join(workdir, "src")
    batches = [[("K", 0, "txn", 50), ("K", 1, "txn", 60)], [("K", 2, "txn", 200), ("L", 3, "txn", 400)],
               [("K", 4, "txn", 51), ("L", 5, "txn", 2)], [("K", 6, "txn", 201)]]
    for rows in batches:
        spark.createDataFrame(rows, CONTROL_SCHEMA).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(CONTROL_SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    q = _run_to_memory(fan_in_state(stream), "late_rows", os.path.join(workdir, "ck"))
    got = {r.seq: (r.fan_in_dest_count_24h, r.late) for r in spark.table("late_rows").collect()}
    assert len([p for p in q.recentProgress if p.numInputRows]) >= 3
    assert got == {0: (0, False), 1: (1, False), 2: (0, False), 3: (0, False), 4: (0, True), 5: (0, True), 6: (1, False)}


def test_bronze_fork_partitions_every_row_and_survives_restart(spark, workdir):
    src = os.path.join(workdir, "in")
    os.makedirs(src)
    msgs = P.transactions(spark, SF_SMOKE).select(F.to_json(F.struct(*[c for c in TXN.fieldNames()])).alias("value"))
    msgs.coalesce(1).write.mode("append").text(src)
    paths = LakePaths(os.path.join(workdir, "lake"))
    stream = spark.readStream.format("text").load(src)
    for q in start_bronze(stream, paths, trigger="availableNow"):
        q.awaitTermination()
    n_in = msgs.count()
    acc, rej = spark.read.parquet(paths.bronze), spark.read.parquet(paths.quarantine)
    assert acc.count() + rej.count() == n_in
    assert rej.where(F.size("reasons") == 0).count() == 0 and rej.where(F.col("raw").isNull()).count() == 0
    # restart with one more file: only the new rows are added (no duplicates)
    extra = msgs.limit(10)
    extra.coalesce(1).write.mode("append").text(src)
    for q in start_bronze(spark.readStream.format("text").load(src), paths, trigger="availableNow"):
        q.awaitTermination()
    assert spark.read.parquet(paths.bronze).count() + spark.read.parquet(paths.quarantine).count() == n_in + 10


def test_purges_of_their_own_topic_take_effect_in_order_of_time(spark, workdir):
    from fraudlake.functions import quality
    from fraudlake.streaming.scoring import ARRIVAL, dispatch_topics, start_alert_sink

    src = os.path.join(workdir, "topics")
    os.makedirs(src)

    def record(topic, partition, offset, second, value):
        return {"topic": topic, "partition": partition, "offset": offset, "timestamp": f"2024-03-01T00:00:{second:02d}Z", "value": json.dumps(value)}

    big = [_payment(40 + i, "TRANSFER", 70_000_000 + i, VAULT, 100 + i) for i in range(4)]
    records = [
        record("transactions-raw", 0, 9100, 1, big[0]),
        record("transactions-raw", 1, 17, 2, big[1]),  # another partition: a small offset, later in time
        record("gdpr-deletion-requests", 0, 3, 3, {"account_id": VAULT, "request_id": "forget-1"}),
        record("gdpr-deletion-requests", 0, 4, 3, {"request_id": "forget-2"}),
        record("transactions-raw", 0, 9101, 4, big[2]),
        record("transactions-raw", 1, 18, 5, big[3]),
    ]
    with open(os.path.join(src, "records.json"), "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in records)
    stream = spark.readStream.schema("topic string, partition int, offset long, timestamp timestamp, value string").json(src)
    txn, er = dispatch_topics(stream)
    chain = with_counters(score_stream(txn, purges=er, scorer=_large_is_fraud, metadata=META, order=ARRIVAL, control_rows=True))
    q = _run_to_memory(chain, "ordered_purge", os.path.join(workdir, "ck"))
    fans = {(r.nameOrig): r.fan_in_count for r in spark.table("ordered_purge").where("status = 'scored'").collect()}
    assert [fans[m["nameOrig"]] for m in big] == [0, 1, 0, 1]  # forgotten between the second and the third
    c = _counters(q)
    assert (c["scored"], c["gdpr_purges"], c["gdpr_bad_payloads"], c["fan_in_events"]) == (4, 1, 1, 4)

    registry = spark.createDataFrame([(VAULT, "anon-vault", "forget-1", "2024-03-01T00:00:03+00:00")], "account_id string, account_alias string, request_id string, requested_at string")
    out_dir = os.path.join(workdir, "alerts")
    chain = score_stream(txn, purges=er, scorer=_large_is_fraud, metadata=META, order=ARRIVAL)
    start_alert_sink(chain, out_dir, os.path.join(workdir, "ck2"), registry=registry).awaitTermination()
    alerts = spark.read.json(out_dir).select("key", "value")
    assert alerts.count() == 4 and alerts.where(F.col("value").contains(VAULT) | (F.col("key") == VAULT)).isEmpty()
    checked = alerts.select(quality.alert_contract("value").alias("a")).collect()
    assert all(r.a == [] for r in checked)


def test_vectorized_run_equals_row_by_row():
    import random

    import numpy as np

    from fraudlake.streaming.fanin_state import _in_order_run, _row_by_row

    rnd = random.Random(3)
    for _ in range(300):
        window, lateness = rnd.choice([24, 3]), rnd.choice([0, 2])
        base = rnd.randint(0, 60)
        pool = range(max(0, base - 40), base + 1)
        live = {s: rnd.randint(1, 3) for s in rnd.sample(pool, min(len(pool), rnd.randint(0, 6)))}
        max_step = max(live) if live else None
        start = base if max_step is None else max_step
        seg = np.array(sorted(start + rnd.randint(0, 50) for _ in range(rnd.randint(1, 40))), dtype=np.int64)
        f1, f2, l2 = [None] * len(seg), [None] * len(seg), [False] * len(seg)
        a = _in_order_run(seg, dict(live), max_step, window, lateness, f1, 0)
        b = _row_by_row(seg, dict(live), max_step, window, lateness, f2, l2, 0)
        assert f1 == f2 and a == b and not any(l2)


def _by_hand(rows, window=24, lateness=0):
    """(fan-in, late, purged) by seq, one row at a time."""
    live, tops, out = {}, {}, {}
    for key, seq, kind, step in sorted(rows, key=lambda r: r[1]):
        if kind == "purge":
            out[seq] = (None, False, key in tops)
            live.pop(key, None)
            tops.pop(key, None)
            continue
        held, top = live.get(key, []), tops.get(key)
        out[seq] = (sum(step - window <= s <= step for s in held), top is not None and step < top - window - lateness, False)
        tops[key] = step if top is None else max(top, step)
        live[key] = [s for s in [*held, step] if s >= tops[key] - window - lateness]
    return out


def test_keys_share_calls_and_state_rows_and_count_like_single_keys(spark, workdir):
    # more keys than buckets; some keys out of order, some purged, one null, over three batches
    rows = [(f"K{i % 2500}", i, "txn", (i // 2500) * 9 + (i * 7919) % 5) for i in range(7500)]
    rows += [("M", 10_000 + i, "purge" if i % 23 == 11 else "txn", None if i % 23 == 11 else (i * 31) % 80 + i) for i in range(120)]
    rows += [("S", 20_000 + i, "purge" if i == 30 else "txn", None if i == 30 else i) for i in range(90)] + [(None, 30_000 + i, "txn", i % 3) for i in range(9)]
    src = os.path.join(workdir, "src")
    for b in range(3):  # by arrival inside each key
        part = [r for r in rows if (r[1] // 2500 if r[1] < 10_000 else r[1] % 10_000 // 40 if r[1] < 30_000 else r[1] % 10 // 3) == b]
        spark.createDataFrame(part, CONTROL_SCHEMA).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(CONTROL_SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    q = _run_to_memory(fan_in_state(stream, lateness=3), "shared_calls", os.path.join(workdir, "ck"))
    got = {r.seq: (r.fan_in_dest_count_24h, r.late, r.purged) for r in spark.table("shared_calls").collect()}
    assert got == _by_hand(rows, lateness=3)
    state_rows = [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.numInputRows]
    assert len(state_rows) == 3 and state_rows[-1] <= 1024 < 2500
