"""Keyed alias, registry, table rewrite, cascade and audits."""

import os

import pytest
from pyspark.sql import functions as F

from fraudlake.functions.alias import account_alias, account_alias_py, hmac_pads
from fraudlake.operators import erasure
from fraudlake.paths import LakePaths, guard_output, name_clash
from fraudlake.sources.txn import erasure_requests_frame

# The reference development pepper and its pinned alias for C0000000001.
DEV_PEPPER = "default-dev-pepper-change-in-prod"
PINNED = ("C0000000001", "ANON_fbad4ba4428e3311")


def _alias(spark, ids, pepper):
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    return [r.a for r in df.select(account_alias("id", pepper).alias("a")).collect()]


def test_pinned_alias(spark):
    assert _alias(spark, [PINNED[0]], DEV_PEPPER) == [PINNED[1]]
    assert account_alias_py(PINNED[0], DEV_PEPPER) == PINNED[1]


def test_alias_deterministic_distinct_and_shaped(spark):
    a = _alias(spark, ["C0000000002", "C0000000002", "C0000000001"], "p")
    assert a[0] == a[1] and a[0] != a[2]
    assert a[0].startswith("ANON_") and len(a[0]) == 21
    int(a[0][5:], 16)


def test_long_pepper_and_unicode_match_python(spark):
    pepper = "x" * 100
    ids = ["C1", "Zürich-7"]
    assert _alias(spark, ids, pepper) == [account_alias_py(i, pepper) for i in ids]


def test_pepper_is_required():
    with pytest.raises(ValueError):
        hmac_pads("")


def test_registry_build_rejects_bad_ids_and_defaults_request_id(spark):
    req = erasure_requests_frame(spark, [("C0000000001", None), ("C12$3", "r2"), ("C0000000003", "r3")])
    good, bad = erasure.build_registry(req.withColumn("requested_ts", F.current_timestamp()), "p")
    rows = {r.account_id: r for r in good.collect()}
    assert set(rows) == {"C0000000001", "C0000000003"}
    assert rows["C0000000001"].request_id.startswith("req-") and len(rows["C0000000001"].request_id) == 12
    assert "T" in rows["C0000000003"].requested_at
    assert [r.account_id for r in bad.collect()] == ["C12$3"]


def test_registry_append_is_idempotent(spark, workdir):
    path = os.path.join(workdir, "registry")
    req = erasure_requests_frame(spark, [("C0000000001", "r1"), ("C0000000002", "r2"), ("C0000000002", "r2")])
    rows, _ = erasure.build_registry(req, "p")
    assert erasure.append_registry(spark, rows, path) == 2
    assert erasure.append_registry(spark, rows, path) == 0
    assert spark.read.parquet(path).count() == 2


def test_erase_tables_counts_cells_and_rewrites(spark, workdir):
    path = os.path.join(workdir, "t")
    spark.createDataFrame(
        [("C0000000001", "C0000000009", 1.0), ("C0000000005", "C0000000001", 2.0), ("C0000000002", "C0000000001", 3.0)],
        "name_orig string, name_dest string, amount double",
    ).write.parquet(path)
    req = erasure_requests_frame(spark, [("C0000000001", "r1")])
    res = erasure.erase_tables(spark, [path], req, "p").collect()
    assert res[0].rows_anonymized == 3
    alias = account_alias_py("C0000000001", "p")
    after = spark.read.parquet(path)
    assert after.count() == 3
    assert after.where((F.col("name_orig") == "C0000000001") | (F.col("name_dest") == "C0000000001")).count() == 0
    assert after.where((F.col("name_orig") == alias) | (F.col("name_dest") == alias)).count() == 3
    # unknown account: a no-op
    res2 = erasure.erase_tables(spark, [path], erasure_requests_frame(spark, [("C0000000077", "r9")]), "p").collect()
    assert res2[0].rows_anonymized == 0


def test_erase_partitioned_table_only_touches_hit_partitions(spark, workdir):
    path = os.path.join(workdir, "p")
    spark.createDataFrame(
        [("C0000000001", "C0000000009", "CASH_OUT"), ("C0000000004", "C0000000005", "PAYMENT")],
        "name_orig string, name_dest string, type string",
    ).write.partitionBy("type").parquet(path)
    before = sorted(os.listdir(os.path.join(path, "type=PAYMENT")))
    req = erasure_requests_frame(spark, [("C0000000001", "r1")])
    erasure.erase_tables(spark, [path], req, "p", partition_cols={path: ["type"]})
    assert sorted(os.listdir(os.path.join(path, "type=PAYMENT"))) == before
    assert spark.read.parquet(path).where(F.col("name_orig") == "C0000000001").count() == 0
    assert spark.read.parquet(path).count() == 2


def test_cascade_and_audit_never_hold_raw_id(spark):
    req = erasure_requests_frame(spark, [("C0000000001", "r1"), ("bad id", "r2")]).withColumn(
        "requested_ts", F.current_timestamp()
    )
    t = spark.createDataFrame([("C0000000001", "C0000000002")], "name_orig string, name_dest string")
    cells = erasure.erased_cells(t, req, "p")
    res = {r.request_id: r for r in erasure.erasure_results(req, cells, published=False).collect()}
    assert res["r1"].status == "erasure_requested" and res["r1"].rows_anonymized == 1
    assert res["r1"].streaming_purge_published is False
    assert res["r2"].status == "rejected"
    audit = erasure.audit_rows(erasure.erasure_results(req, cells)).collect()
    assert len(audit) == 1 and "C0000000001" not in str(audit[0])


def test_duplicate_and_leak_audit(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "k int, n int")
    r = erasure.duplicate_audit(df, ["k", "n"]).first()
    assert (r.rows, r.distinct_keys, r.duplicate_rows) == (3, 2, 1)
    reg = spark.createDataFrame([("C1",)], "account_id string")
    bronze = spark.createDataFrame([("C1", "C2")], "nameOrig string, nameDest string")
    silver = spark.createDataFrame([("ANON_x", "C2")], "name_orig string, name_dest string")
    out = {(r.layer, r.column_name): (r.leaked_rows, r.allowed) for r in erasure.leak_audit(
        {"bronze": (bronze, ["nameOrig", "nameDest"]), "silver": (silver, ["name_orig", "name_dest"])}, reg).collect()}
    assert out[("bronze", "nameOrig")] == (1, True)
    assert out[("silver", "name_orig")] == (0, False)


def test_layer_isolation_guard(tmp_path):
    with pytest.raises(ValueError):
        guard_output("/lake/bronze/transactions/x", ["/lake/bronze/transactions"])
    with pytest.raises(ValueError):
        guard_output("/lake/bronze", ["/lake/bronze/transactions"])
    guard_output("/lake/gold/t", ["/lake/bronze/transactions"])
    assert name_clash({"bronze_transactions", "gdpr_requests"}, {"stg_transactions", "gold_transactions"}) == set()
    LakePaths(str(tmp_path)).check_disjoint()


def test_purge_messages_and_audit_append(spark, workdir):
    import json as _json

    req = erasure_requests_frame(spark, [("C0000000001", "r1"), ("bad id", "r2")])
    msgs = erasure.purge_messages(req).collect()
    assert len(msgs) == 1 and msgs[0].key == "C0000000001"
    assert _json.loads(msgs[0].value) == {"account_id": "C0000000001", "request_id": "r1"}
    req = req.withColumn("requested_ts", F.current_timestamp())
    t = spark.createDataFrame([("C0000000001", "C0000000002")], "name_orig string, name_dest string")
    rows = erasure.audit_rows(erasure.erasure_results(req, erasure.erased_cells(t, req, "p")))
    path = os.path.join(workdir, "audit")
    erasure.append_audit(rows, path)
    erasure.append_audit(rows, path)
    audit = spark.read.parquet(path)
    assert audit.count() == 2 and set(audit.columns) == {
        "timestamp", "request_id", "account_alias", "streaming_purge_published", "rows_anonymized"}


def test_silver_view_is_registered(spark):
    from conftest import SF_SMOKE
    from fraudlake.operators.silver import silver_view
    from fraudlake.plans import pipeline as P

    v = silver_view(spark, P.silver(spark, SF_SMOKE), "stg_transactions_t")
    assert spark.sql("SELECT count(*) AS n FROM stg_transactions_t").first().n == v.count() > 0


def test_erase_leaves_no_staging_or_old_copies(spark, workdir):
    path = os.path.join(workdir, "u")
    spark.createDataFrame([("C0000000001", "C0000000002")], "name_orig string, name_dest string").write.parquet(path)
    erasure.erase_tables(spark, [path], erasure_requests_frame(spark, [("C0000000001", "r1")]), "p")
    assert sorted(os.listdir(workdir)) == ["u"]
    assert spark.read.parquet(path).first().name_orig == account_alias_py("C0000000001", "p")


def test_cascade_masks_null_partitions_and_rejects_what_is_invalid(spark, workdir):
    from fraudlake.operators.erasure import read_registry, submit_erasure

    path = os.path.join(workdir, "facts")
    rows = [(None, "C100000001", "C100000002"), ("a", "C100000003", "C100000001"), ("b", "X", "C100000002")]
    spark.createDataFrame(rows, "type string, name_orig string, name_dest string").write.partitionBy("type").parquet(path)
    requests = spark.createDataFrame(
        [("C100000001", "r1"), ("X", "r2"), ("C100000003", "r1")], "account_id string, request_id string"
    ).withColumn("requested_ts", F.lit("2024-05-01 10:00:00").cast("timestamp"))
    sent = []

    def publish(messages):
        sent.extend(r.key for r in messages.collect())
        raise ConnectionError("broker away")

    reg, audit = os.path.join(workdir, "registry"), os.path.join(workdir, "audit")
    out = submit_erasure(spark, requests, "unit-pepper", reg, [path], audit, publish, {path: ["type"]}).collect()
    assert sorted((r.request_id, r.status, r.rows_anonymized, r.streaming_purge_published) for r in out) == [
        ("r1", "erasure_requested", 2, False), ("r1", "rejected", 0, False), ("r2", "rejected", 0, False),
    ]
    assert [r.account_id for r in read_registry(spark, reg).collect()] == ["C100000001"] and sent == ["C100000001"]
    left = [(r.name_orig, r.name_dest) for r in spark.read.parquet(path).collect()]
    ids = [x for pair in left for x in pair]
    assert "C100000001" not in ids and ids.count("C100000003") == 1 and ids.count("X") == 1 and len(left) == 3
    assert spark.read.parquet(audit).count() == 1


def test_request_id_of_two_accounts_keeps_the_first_and_reports_the_other(spark):
    from fraudlake.operators.erasure import registry_conflicts, registry_new_rows

    rows = spark.createDataFrame(
        [("C2", "a2", "r", "2024-01-02"), ("C1", "a1", "r", "2024-01-03"), ("C3", "a3", "q", "2024-01-01")],
        "account_id string, account_alias string, request_id string, requested_at string",
    )
    assert sorted(r.account_id for r in registry_new_rows(rows, None).collect()) == ["C2", "C3"]
    assert [(r.account_id, r.request_id) for r in registry_conflicts(rows).collect()] == [("C1", "r")]
