"""Rewrites that die and writers that meet: nothing is lost, nothing counts twice."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from fraudlake.functions.alias import account_alias
from fraudlake.operators import erasure
from fraudlake.paths import create_if_absent, list_names, read_text
from fraudlake.schemas import REGISTRY
from fraudlake.sinks import append_log


class Died(RuntimeError):
    pass


def die_at(step, at_path=None):
    def hook(path, s):
        if s == step and at_path in (None, path):
            raise Died(step)

    return hook


def facts(spark, path, partitioned):
    rows = [("a", "C100000001", "C100000002", 1.0), (None, "C100000003", "C100000001", 2.0), ("b", "C100000004", "C100000005", 3.0)]
    w = spark.createDataFrame(rows, "type string, name_orig string, name_dest string, amount double").write
    (w.partitionBy("type") if partitioned else w).parquet(path)


def ids_of(spark, path):
    return sorted(x for r in spark.read.parquet(path).collect() for x in (r.name_orig, r.name_dest))


def requests(spark, *accounts):
    return spark.createDataFrame([(a, f"r-{a}") for a in accounts], "account_id string, request_id string")


@pytest.mark.parametrize("step", ["staged", "moved aside", "moved in", "done"])
@pytest.mark.parametrize("partitioned", [False, True])
def test_a_rerun_completes_a_rewrite_that_died(spark, workdir, step, partitioned):
    if partitioned and step == "moved aside":
        pytest.skip("partitions are swapped in place")
    one, two = os.path.join(workdir, "one"), os.path.join(workdir, "two")
    for p in (one, two):
        facts(spark, p, partitioned)
    req, parts = requests(spark, "C100000001"), {one: ["type"], two: ["type"]} if partitioned else {}
    with pytest.raises(Died):
        erasure.erase_tables(spark, [one, two], req, "p", parts, on_step=die_at(step, two))
    done = erasure.erase_tables(spark, [one, two], req, "p", parts).collect()
    assert [(r.account_id, r.rows_anonymized) for r in done] == [("C100000001", 4)]
    for p in (one, two):
        ids = ids_of(spark, p)
        assert len(ids) == 6 and "C100000001" not in ids and sum(i.startswith("ANON_") for i in ids) == 2
    assert sorted(os.listdir(workdir)) == ["one", "two"]


def test_a_table_that_grew_after_the_crash_is_rewritten_anew(spark, workdir):
    path = os.path.join(workdir, "t")
    facts(spark, path, False)
    with pytest.raises(Died):
        erasure.erase_tables(spark, [path], requests(spark, "C100000001"), "p", on_step=die_at("staged"))
    spark.read.parquet(path).limit(1).select("type", F.lit("C100000009").alias("name_orig"), F.lit("C100000001").alias("name_dest"), "amount").write.mode("append").parquet(path)
    done = erasure.erase_tables(spark, [path], requests(spark, "C100000001"), "p").collect()
    assert done[0].rows_anonymized == 3 and len(ids_of(spark, path)) == 8 and "C100000001" not in ids_of(spark, path)


def test_a_missing_table_raises_and_an_unfinished_copy_is_dropped(spark, workdir):
    with pytest.raises(FileNotFoundError):
        erasure.erase_tables(spark, [os.path.join(workdir, "none")], requests(spark, "C100000001"), "p")
    path = os.path.join(workdir, "t")
    facts(spark, path, False)
    spark.range(3).write.parquet(path + ".__erase__/copy")
    assert erasure.recover_table(spark, path) == "dropped" and erasure.recover_table(spark, path) == "clean"
    assert len(ids_of(spark, path)) == 6


def stamped(df):
    return df.withColumn("requested_ts", F.lit("2024-05-01 10:00:00").cast("timestamp"))


def test_cascade_rejects_an_id_that_the_stored_registry_gives_to_another_account(spark, workdir):
    path, reg, audit = (os.path.join(workdir, n) for n in ("facts", "registry", "audit"))
    facts(spark, path, False)
    sent = []
    publish = lambda m: sent.extend(r.key for r in m.collect())
    first = stamped(spark.createDataFrame([("C100000001", "R1")], "account_id string, request_id string"))
    erasure.submit_erasure(spark, first, "p", reg, [path], audit, publish)
    later = stamped(spark.createDataFrame([("C100000002", "R1"), ("C100000003", "R2"), ("C100000001", "R1")], "account_id string, request_id string"))
    out = erasure.submit_erasure(spark, later, "p", reg, [path], audit, publish).collect()
    assert sorted((r.request_id, r.status, r.rows_anonymized) for r in out) == [("R1", "erasure_requested", 0), ("R1", "rejected", 0), ("R2", "erasure_requested", 1)]
    assert sorted(r.account_id for r in erasure.read_registry(spark, reg).collect()) == ["C100000001", "C100000003"]
    assert sorted(sent) == ["C100000001", "C100000001", "C100000003"]
    ids = ids_of(spark, path)
    assert "C100000002" in ids and "C100000001" not in ids and "C100000003" not in ids
    assert sorted(r.request_id for r in erasure.read_audit(spark, audit).collect()) == ["R1", "R1", "R2"]


def test_default_request_ids_conflict_like_given_ones(spark, workdir):
    ts = F.lit("2024-05-01 10:00:00").cast("timestamp")
    free = spark.createDataFrame([("C100000001",)], "account_id string").withColumns({"request_id": F.lit(None).cast("string"), "requested_ts": ts})
    own_id = erasure.build_registry(free, "p")[0].first().request_id
    taken = free.select(F.lit("C100000009").alias("account_id"), F.lit(own_id).alias("request_id"), "requested_ts")
    reg, path = os.path.join(workdir, "registry"), os.path.join(workdir, "facts")
    facts(spark, path, False)
    rows, _ = erasure.build_registry(taken, "p")
    assert erasure.append_registry(spark, rows, reg) == 1
    out = erasure.submit_erasure(spark, free, "p", reg, [path], os.path.join(workdir, "audit"), lambda m: None).collect()
    assert [(r.status, r.account_alias) for r in out] == [("rejected", None)] and "C100000001" in ids_of(spark, path)


def test_a_cascade_that_died_in_the_rewrite_counts_once_when_submitted_again(spark, workdir):
    one, two, reg, audit = (os.path.join(workdir, n) for n in ("one", "two", "registry", "audit"))
    for p in (one, two):
        facts(spark, p, False)
    req = stamped(requests(spark, "C100000001"))
    with pytest.raises(Died):
        erasure.submit_erasure(spark, req, "p", reg, [one, two], audit, lambda m: None, on_step=die_at("moved in", two))
    out = erasure.submit_erasure(spark, req, "p", reg, [one, two], audit, lambda m: None).collect()
    assert [r.rows_anonymized for r in out] == [4] and [r.rows_anonymized for r in erasure.read_audit(spark, audit).collect()] == [4]
    assert erasure.read_registry(spark, reg).count() == 1 and sorted(os.listdir(workdir)) == ["audit", "one", "registry", "two"]


def registry_rows(spark, ids, account="C10000000{}"):
    rows = [(account.format(i), "x", f"r{i}", "2024-01-01") for i in ids]
    return spark.createDataFrame(rows, REGISTRY).withColumn("account_alias", account_alias("account_id", "p"))


def test_the_slower_of_two_writers_checks_again(spark, workdir):
    path = os.path.join(workdir, "registry")
    other = registry_rows(spark, [2, 3], "C20000000{}")
    again = []

    def meanwhile(step):
        if step == "staged" and not again:
            again.append(erasure.append_registry(spark, other, path))

    n, rejected = erasure.register_requests(spark, registry_rows(spark, [1, 2]), path, on_step=meanwhile)
    assert again == [2] and n == 1
    assert [(r.account_id, r.request_id) for r in rejected.collect()] == [("C100000002", "r2")]
    assert sorted((r.request_id, r.account_id[:2]) for r in erasure.read_registry(spark, path).collect()) == [("r1", "C1"), ("r2", "C2"), ("r3", "C2")]


def test_many_writers_of_overlapping_ids(spark, workdir):
    path, counts = os.path.join(workdir, "registry"), []
    frames = [registry_rows(spark, range(i, i + 4)) for i in range(5)]
    threads = [threading.Thread(target=lambda f=f: counts.append(erasure.append_registry(spark, f, path))) for f in frames]
    [t.start() for t in threads]
    [t.join() for t in threads]
    got = [r.request_id for r in erasure.read_registry(spark, path).collect()]
    assert sorted(got) == [f"r{i}" for i in range(8)] and sum(counts) == 8
    assert spark.read.parquet(path).count() == 8 and list_names(spark, path + "/_staged") == []


@pytest.mark.parametrize("step, rows", [("staged", 1), ("claimed", 3)])
def test_an_append_that_died_is_whole_or_absent(spark, workdir, step, rows):
    path = os.path.join(workdir, "registry")
    erasure.append_registry(spark, registry_rows(spark, [1]), path)

    def die(s):
        if s == step:
            raise Died(s)

    with pytest.raises(Died):
        erasure.register_requests(spark, registry_rows(spark, [2, 3]), path, on_step=die)
    assert erasure.read_registry(spark, path).count() == rows
    assert erasure.append_registry(spark, registry_rows(spark, [2, 3, 4]), path) == 4 - rows
    assert sorted(r.request_id for r in erasure.read_registry(spark, path).collect()) == ["r1", "r2", "r3", "r4"]
    assert append_log.last_number(spark, path) == (2 if step == "staged" else 3)


def test_a_name_is_given_once(spark, workdir):
    p = os.path.join(workdir, "log", "1")
    assert create_if_absent(spark, p, "a") and not create_if_absent(spark, p, "b")
    assert read_text(spark, p) == "a" and list_names(spark, os.path.dirname(p)) == ["1"]


def test_rows_and_cells_come_from_one_pass(spark, workdir, monkeypatch):
    rows = [("C000000001", "C000000002", 1), ("C000000002", None, 2), (None, None, 3), ("C000000003", "C000000001", 4), ("C000000001", "C000000001", 5)]
    table = spark.createDataFrame(rows, "name_orig string, name_dest string, n int")
    amap = spark.createDataFrame([("C000000001", "x"), ("C000000009", "y")], "account_id string, account_alias string")
    assert erasure.rows_and_cells(table, amap) == (5, 4) and erasure.rows_and_cells(table.limit(0), amap) == (0, 0)
    asked = []
    per_account = erasure.erased_cells
    monkeypatch.setattr(erasure, "erased_cells", lambda *a, **k: asked.append(1) or per_account(*a, **k))
    for parts in ([], ["n"]):
        path = os.path.join(workdir, f"facts{len(parts)}")
        (table.write.partitionBy(*parts) if parts else table.write).parquet(path)
        done = erasure.erase_tables(spark, [path], amap, partition_cols={path: parts})
        assert {(r.account_id, r.rows_anonymized) for r in done.collect()} == {("C000000001", 4), ("C000000009", 0)}
        after = {tuple(r) for r in spark.read.parquet(path).select("name_orig", "name_dest", "n").collect()}
        assert after == {tuple("x" if v == "C000000001" else v for v in r) for r in rows}
    assert not asked  # the whole table is counted by account once, with its partitions
