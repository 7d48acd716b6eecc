import hashlib
import re
from collections import Counter, defaultdict
from urllib.parse import urlsplit

import numpy as np
import xxhash
from pyspark.sql import functions as F
from tests.conftest import SF_SMALL
from tests.llm.helpers import frame, odd_rows

from fraudlake.llm import fingerprints, similar, url_filter, vector_search
from fraudlake.llm.common import read_table


def shingle_set(text):
    w = re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(docs, similarity=0.8):
    """[(doc_id, class_id, links)] by comparing all pairs that share a shingle."""
    sets = [shingle_set(t) for _, t in docs]
    inside = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            inside[x].append(i)
    common = Counter((a, b) for rows in inside.values() for n, b in enumerate(rows) for a in rows[:n])
    links, parent = Counter(), list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), n in common.items():
        if n >= similarity * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
            links[a] += 1
            links[b] += 1
            parent[root(a)] = root(b)
    low = {}
    for i, (d, _) in enumerate(docs):
        low[root(i)] = min(low.get(root(i), d), d)
    return sorted((d, low[root(i)], links[i]) for i, (d, _) in enumerate(docs))


def test_join_equals_brute_force(spark):
    table = read_table(spark, SF_SMALL, "documents")
    docs = [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]
    got = sorted((r.doc_id, r.class_id, r.links) for r in similar.similar_documents(table).collect())
    assert got == brute(docs)


def near_copies(n, seed=4):
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in rng.integers(0, 5000, 120)]
    rows = []
    for i in range(n):
        words = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 4)):
            words[at] = f"x{rng.integers(0, 10**6)}"
        rows.append((i, " ".join(words)))
    return rows


def test_hot_group_in_blocks_loses_and_repeats_no_link(spark, monkeypatch):
    monkeypatch.setattr(similar, "SMALL", 8)
    monkeypatch.setattr(similar, "BLOCK_SETS", 40)
    docs = near_copies(220) + [(1000 + i, t) for i, t in near_copies(3, seed=9)] + [(2000, "other words that stand alone here")]
    rows = frame(spark, [(d, t, None, None, None) for d, t in docs])
    got = sorted((r.doc_id, r.class_id, r.links) for r in similar.similar_documents(rows, recall=0.99999).collect())
    assert got == brute(docs)


def test_chain_of_links_is_one_group(spark):
    pairs = [(bytes([i]), bytes([i + 1])) for i in range(60)] + [(b"\xf0", b"\xf1"), (b"\xf1", b"\xf1")]
    got = {bytes(r.sid): bytes(r.label) for r in similar.groups(spark.createDataFrame(pairs, "sid binary, root binary")).collect()}
    assert got == {bytes([i]): b"\x00" for i in range(61)} | {b"\xf0": b"\xf0", b"\xf1": b"\xf0"}


def test_join_of_odd_rows(spark):
    rows = odd_rows()
    got = sorted(map(str, similar.similar_documents(frame(spark, rows)).collect()))
    by_id = {r.doc_id: r for r in similar.similar_documents(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    assert (by_id[60].class_id, by_id[60].links) == (60, 2) and (by_id[170].class_id, by_id[170].links) == (160, 1)
    assert (by_id[0].class_id, by_id[0].links) == (0, 0) and by_id[None].links == 0
    assert similar.similar_documents(frame(spark, rows).limit(0)).collect() == []


def test_words_of_other_scripts_and_marks(spark):
    rng = np.random.default_rng(3)
    words = [f"mot{i}é" for i in range(40)]
    signs = "".join(chr(0x4E00 + int(i)) for i in rng.integers(0, 3000, 200))
    rows = [(1, " ".join(words)), (2, "\u00a0".join(words)), (3, " — ".join(words)), (4, "“" + "” ".join(words))]
    rows += [(5, signs), (6, signs[:150] + "。" + signs[150:]), (7, signs[:196] + "完全不同"), (8, signs[::-1])]
    got = sorted(similar.similar_documents(frame(spark, [(d, t, None, None, None) for d, t in rows])).collect())
    assert [(r.doc_id, r.class_id, r.links) for r in got] == [(i, 1, 3) for i in (1, 2, 3, 4)] + [(5, 5, 2), (6, 5, 2), (7, 5, 2), (8, 8, 0)]


def test_sketches_rarely_lose_a_pair_at_the_threshold():
    floor = similar.sketch_floor(0.8)
    below = np.random.default_rng(0).binomial(similar.COORDS, 0.8, 1_000_000) < floor
    assert below.mean() <= 3e-5 and 0 < floor < 0.8 * similar.COORDS


def test_number_of_runs():
    assert similar.runs_for(0.999, 0.8) > similar.runs_for(0.9, 0.8) >= 1


def words_jaccard(a, b):
    def grams(words):
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    a, b = grams(a.split()), grams(b.split())
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_of_edits(spark):
    rows = [r for r in odd_rows() if r[0] is not None and r[0] != 60 and "\x1f" not in (r[1] or "") and "　" not in (r[1] or "")]
    texts = sorted(((d, t or "") for d, t, *_ in rows), reverse=True)
    got = {r.doc_id: r for r in fingerprints.fingerprint_edits(frame(spark, rows)).collect()}
    for i, (d, t) in enumerate(texts):
        after = texts[(i + 1) % len(texts)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        g = got[d]
        assert (g.n_chars, g.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert abs(g.near_edited - words_jaccard(t, edited)) < 0.2 and abs(g.near_next - words_jaccard(t, after)) < 0.2
    assert got[160].fingerprint == got[170].fingerprint and got[0].fingerprint == ""


def slow_hash(words):
    h = 42
    for w in words:
        h = xxhash.xxh64_intdigest(w.encode(), seed=h)
    return h


def slow_sketch(text, k=128):
    w = [x for x in re.split(r"[ \t\n\x0b\f\r]+", text) if x]
    return sorted({slow_hash(w[i : i + 5]) >> 24 for i in range(max(1, len(w) - 4))})[:k] if w else []


def slow_edits(rows):
    """Every column of fingerprint_edits, by the definitions."""

    def near(a, b):
        u = sorted({*a, *b})[:128]
        return sum(x in a and x in b for x in u) / len(u) if u else 1.0

    def signed(h):
        return h - (1 << 64) if h >> 63 else h

    docs = sorted(((-(1 << 63) if d is None else d, t or "", d) for d, t, *_ in rows), key=lambda r: (-r[0], signed(slow_hash([r[1]]))))
    out = []
    for i, (_, t, d) in enumerate(docs):
        after = docs[(i + 1) % len(docs)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        a, b, c = slow_sketch(t), slow_sketch(edited), slow_sketch(after)
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), *(",".join(f"{x:X}" for x in s) for s in (a, b)), near(a, b), near(a, c)))
    return sorted(out, key=str)


def test_fingerprints_equal_brute_force(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    for rows in ([(r.doc_id, r.text) for r in docs.collect()], [r[:2] for r in odd_rows()]):
        table = spark.createDataFrame(rows, "doc_id long, text string")
        assert sorted(map(tuple, fingerprints.fingerprint_edits(table).select(columns).collect()), key=str) == slow_edits(rows)


def test_hot_and_null_ids_are_dealt_by_text(spark):
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text {i} of {i % 11}") for i in range(900)] + [(7, "twice"), (7, "twice")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = fingerprints.fingerprint_edits(table).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    assert sorted(map(tuple, got.collect()), key=str) == slow_edits(rows)
    keyed = table.selectExpr("coalesce(doc_id, -9223372036854775808) AS key", "xxhash64(text) AS salt")
    cuts = keyed.agg(F.percentile_approx("key", [i / 32 for i in range(1, 33)], 3200)).first()[0]
    most = keyed.groupBy(fingerprints._blocks(cuts)[0].alias("b")).count().agg(F.max("count")).first()[0]
    assert most < 900 / 8  # a third of the rows has one id


def test_merged_and_contained_in_the_result(spark):
    rows = [(2, " ".join(f"a{i}" for i in range(60))), (1, " ".join(f"b{i}" for i in range(40)))]
    got = fingerprints.fingerprint_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.shingles_with_next for r in got} == {56.0 + 36.0}
    assert all(0 < r.kept_in_edited < 1 for r in got)


def test_fingerprints_of_repeated_ids_and_empty_table(spark):
    docs = frame(spark, odd_rows())
    assert fingerprints.fingerprint_edits(docs).count() == len(odd_rows())
    assert fingerprints.fingerprint_edits(docs.limit(0)).collect() == []
    assert fingerprints.fingerprint_edits(docs.where("doc_id = 50")).first().near_next == 1.0


def test_next_row_over_block_borders(spark):
    rows = spark.range(0, 3000, 7).selectExpr("id AS doc_id", "cast(id AS string) AS text")
    got = {r.doc_id: r.next_text for r in fingerprints.with_next(rows, ["text"], blocks=9).collect()}
    ids = sorted(got, reverse=True)
    assert [got[i] for i in ids] == [str(i) for i in [*ids[1:], ids[0]]]


def test_sketches_merge_and_estimate(spark):
    a, b = " ".join(f"a{i}" for i in range(3000)), " ".join(f"a{i}" for i in range(1500, 4500))
    df = spark.createDataFrame([(1, a), (1, b), (2, "x y")], "k int, t string").withColumn("sketch", fingerprints.sketch(F.col("t")))
    whole = spark.createDataFrame([(" ".join(f"a{i}" for i in range(4500)),)], "t string").select(fingerprints.sketch(F.col("t"))).first()[0]
    merged = {r.k: r.sketch for r in fingerprints.merge_parts(df, "k", fan=2).collect()}
    assert merged[1] == whole and len(merged[2]) == 1
    x, y = (r.sketch for r in df.where("k = 1").collect())
    one = spark.createDataFrame([(x, y)], "x array<long>, y array<long>")
    r = one.select(fingerprints.resemblance(F.col("x"), F.col("y")), fingerprints.containment(F.col("x"), F.col("y")), fingerprints.distinct_shingles(F.col("x"))).first()
    assert abs(r[0] - 1 / 3) < 0.15 and abs(r[1] - 0.5) < 0.2 and abs(r[2] - 2996) < 900


def test_host_path_and_rules(spark):
    rules = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
    urls = [
        None, "", "no scheme/path", "http://Example.ORG/en/12?x#y", "http://a.example.org/es/", "https://notexample.org/es/x", "ftp://x.com", "http://x.com/de/1#f",
        "http://x.COM/fr/", "http://h?q=://x/y", "http://h#f/y", "http://ÄB.com/p", "http://a/b://c/d", "http://org/", "http://org",
    ]
    df = spark.createDataFrame([(i, u, None, "clash") for i, u in enumerate(urls)], "page_id long, url string, label int, node string")
    got = {r.page_id: r for r in url_filter.judge(df, rules).collect()}
    for i, u in enumerate(urls):
        rest = (u or "").split("://", 1)[1] if "://" in (u or "") else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
        fit = [(len(r), r, v) for v, r in rules if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])]
        want = max(fit)[1:] if fit else (None, "allow")
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, *want), u
    assert urlsplit(urls[3]).netloc == "Example.ORG"
    assert url_filter.judge(df.limit(0), rules).collect() == []


def test_impure_template_is_rejected_and_alike_ones_merge(spark):
    rows = [(f"http://h/{kind}/{i}", int(i % 10 < good)) for kind, good in (("news", 9), ("blog", 9), ("spam", 1)) for i in range(200)]
    df = spark.createDataFrame([(i, u, g) for i, (u, g) in enumerate(rows)], "page_id long, url string, label int")
    got = url_filter.judge(df, []).groupBy("template", "verdict").count().collect()
    found = {r.template: r.verdict for r in got}
    assert found["h/spam/*"] == "block" and set(found.values()) == {"allow", "block"} and all(v == "allow" for t, v in found.items() if t != "h/spam/*")
    deep = spark.createDataFrame([(1, "http://h/" + "/".join("abcdefghij"), 1)], "page_id long, url string, label int")
    assert url_filter.judge(deep, []).first().template == "h/a/b/c/d/e/f/g/h/i/j"


def slow_top_k(rows, k=10):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            ok[i, tuple(int(np.floor(1024 * float(np.float32(x)))) for x in v)] = 1
    out = []
    for i, v in ok:
        if i % 100 == 0:
            score = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j) for j, w in ok if j != i)[:k]
            out += [(i, r + 1, j, max(min(-s, 2**63 - 1), -(2**63))) for r, (s, j) in enumerate(score)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<float>, col string, v string")


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=24) * rng.exponential(size=24)]) for i in range(450)]
    rows += [(1000 + i, rows[0][1]) for i in range(30)] + [(500, None), (501, [1.0, None]), (502, [float("nan")] * 3), (503, [float("inf")]), (None, [1.0]), (504, [2.0] * 5), (505, []), rows[0]]
    got = sorted(map(tuple, vector_search.top_k(vectors(spark, rows), block=100, query_block=2, step=4).collect()))
    assert got == slow_top_k(rows)


def test_top_k_in_default_blocks_and_in_small_sides(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6) / 4]) for i in range(3000)]  # many ties
    want = slow_top_k(rows)
    assert sorted(map(tuple, vector_search.top_k(vectors(spark, rows)).collect())) == want
    monkeypatch.setattr(vector_search, "SIDE_BYTES", 8 * 6 * 700)
    monkeypatch.setattr(vector_search, "CHUNK", 900)
    assert sorted(map(tuple, vector_search.top_k(vectors(spark, rows)).collect())) == want


def test_top_k_of_few_and_of_huge_numbers(spark):
    few = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1e12, -3.0])]
    assert sorted(map(tuple, vector_search.top_k(vectors(spark, few)).collect())) == slow_top_k(few)
    huge = [(0, [1e30, 1.0]), (1, [1e30, 1.0]), (100, [-1e30, 0.5])]
    assert sorted(map(tuple, vector_search.top_k(vectors(spark, huge)).collect())) == slow_top_k(huge)
    assert vector_search.top_k(vectors(spark, few).limit(0)).collect() == []
