"""Secret scan, hard negatives and target resampling against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from fraudlake.llm import hard_negatives, secret_scan, target_resampling
from tests.llm.helpers import frame, odd_rows

# --- secret scan ----------------------------------------------------------------------

ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
SLOW = {
    "assign": lambda t: [m.span() for m in ASSIGN.finditer(t) if len(m[2]) >= 8],
    "access": lambda t: [m.span() for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16],
    "hex": lambda t: [m.span() for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32],
}


def secret_rows():
    rng = random.Random(5)
    bits = ["password", "PassWord", "api_key", "APIKEY", "token", "Secret", "\u017fecret", "api\u212aey", "=", ": ", " = '", "\":", "abcd1234", "x", "AKIA", "AKIAABCDEFGHIJKL", "AKIAAKIA1234567",
            "0123456789abcdef" * 2, "0123456789abcdef" * 3 + "g", "deadbeef", " ", "\n", "é", "\U0001f600", "日本", "secret=token :abcdefghijk", "token=secret=abcdefghij", "pas", "ssword"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(1, 30))), None, None, None) for i in range(400)]
    return [*rows, *odd_rows(), (900, "word " * 60_000 + "passwd: 'hunter2hunter2' " + "tail " * 60_000, None, None, None)]


def test_secrets_equal_brute_force(spark):
    rows = secret_rows()
    got = sorted((tuple(r) for r in secret_scan.digest(frame(spark, rows)).collect()), key=repr)
    want = []
    for doc_id, text, *_ in rows:
        found = {k: f(text or "") for k, f in SLOW.items()}
        base = sorted((s, list(SLOW).index(k), e, k) for k, spans in found.items() for s, e in spans)
        line = ",".join(f"{k}:{s}:{e}" for s, _, e, k in base)
        want.append((doc_id, *[len(found[k]) for k in SLOW], hashlib.sha256(line.encode()).hexdigest()))
    assert sorted((r[:5] for r in got), key=repr) == sorted(want, key=repr)
    assert sum(len(r[5]) > 0 for r in got) > 100
    assert secret_scan.digest(frame(spark, rows).limit(0)).collect() == []


def test_more_rules_and_redaction(spark):
    key = "ghp_" + "a1B2" * 9
    jwt = "eyJhbGciOiJIUzI1.eyJzdWIiOiIxMjM0.SflKxwRJSMeKKF2QT4"
    texts = {
        1: f"see {key} here", 2: f"Authorization: Bearer {jwt}", 3: "postgres://bob:pw123@db/x", 4: "-----BEGIN RSA PRIVATE KEY-----\nMIIE\n-----END",
        5: "gh_ nothing xoxb-1", 6: "sk_live_" + "Z9" * 12, 7: "AIza" + "x" * 35, 8: "xoxb-" + "1234-" * 5, 9: "password=" + key,
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: {s.kind for s in r.spans} for r in secret_scan.scan(docs).collect()}
    assert got == {1: {"github"}, 2: {"jwt", "bearer"}, 3: {"url_login"}, 4: {"private_key"}, 5: set(), 6: {"stripe"}, 7: {"google"}, 8: {"slack"}, 9: {"assign", "github"}}
    clean = {r.doc_id: r.text for r in secret_scan.redacted(docs).collect()}
    assert clean[1] == "see [secret] here" and clean[5] == texts[5] and clean[9] == "[secret]" and "eyJ" not in clean[2]


def test_trigram_queries_admit_every_match():
    t = secret_scan.trigram
    assert secret_scan.trigram_query("[0-9a-f]+") is True and secret_scan.trigram_query("(abc)?x") is True
    assert secret_scan.trigram_query("AKIA[A-Z]+") == ("and", (t("aki"), t("kia")))
    assert secret_scan.trigram_query("a(bc|de)f") == ("or", (("and", (t("abc"), t("bcf"))), ("and", (t("ade"), t("def")))))
    assert secret_scan.trigram_query("(foo|.*)") is True
    assert secret_scan.trigram_query("(?:abc)+.*xyz$") == ("and", (t("abc"), t("xyz")))
    rng = random.Random(1)
    for rule in secret_scan.RULES:
        query = secret_scan.trigram_query(rule.pattern)
        expr = re.compile(rule.pattern, re.ASCII | (re.IGNORECASE if rule.any_case else 0))
        for _, text, *_ in secret_rows() + [(0, "".join(rng.choice("eyJ.-ghp_xoAIzasklive_r://:@b ") for _ in range(300)), None, None, None)]:
            if text and expr.search(text):
                import pyarrow as pa

                needed = sorted(secret_scan.trigrams_of(query))
                index = secret_scan.postings(pa.array(["", text, None]), needed, secret_scan.slot_table(needed))
                assert 1 in secret_scan.answer(query, index, 3).tolist(), (rule.kind, text)


# --- hard negatives ---------------------------------------------------------------------


def slow_negatives(rows, scale=256):
    ok = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            ok[i, label, tuple(int(np.floor(scale * float(np.float32(x)))) for x in v)] = 1
    clamp = lambda s: max(min(s, 2**63 - 1), -(2**63))
    out = []
    for i, label, v in ok:
        if i % 100:
            continue
        score = [(clamp(sum(a * b for a, b in zip(v, w, strict=False))), j, other) for j, other, w in ok if j != i]
        same = sorted((-s, j) for s, j, other in score if other == label)[:5]
        for minus, p in same:
            inside = sorted((-s, j) for s, j, other in score if other != label and 30 * -minus <= 100 * s <= 90 * -minus)[:10]
            out += [(i, p, r + 1, j, -minus, -s) for r, (s, j) in enumerate(inside)]
    return sorted(out)


def labelled_vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], "vec_id long, embedding array<float>, label int, row string, bounds int")


@pytest.mark.parametrize("block, anchor_block", [(10_000, 10_000), (70, 2)])
def test_negatives_equal_brute_force(spark, block, anchor_block):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(4, 20))
    rows = [(i, [float(x) for x in centre[i % 4] * 0.6 + rng.normal(size=20) * rng.exponential(size=20)], int(i % 4)) for i in range(500)]
    rows += [(1000 + i, rows[0][1], i % 2) for i in range(30)]  # ties
    rows += [(600, None, 1), (601, [1.0, None], 1), (602, [float("nan")] * 20, 0), (603, [float("inf")], 0), (None, [1.0], 0), (604, [2.0] * 5, 2), (605, [], 1), (606, [1.0] * 20, None), rows[0]]
    rows += [(700, [0.5] * 20, 9), (800, [1.0, 0.5], 1)]  # the only row of its label; a short vector
    got = sorted(map(tuple, hard_negatives.mine(labelled_vectors(spark, rows), block=block, anchor_block=anchor_block, step=3).collect()))
    want = slow_negatives(rows)
    assert got == want and len(want) > 50


def test_negatives_of_few_and_of_huge_numbers(spark):
    few = [(0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [0.5, 1.0], 2), (100, [1.0, 0.0], 3)]
    assert sorted(map(tuple, hard_negatives.mine(labelled_vectors(spark, few)).collect())) == slow_negatives(few)
    huge = [(0, [1e12, 1.0], 1), (1, [1e3, 1.0], 1), (3, [1e2, 1.0], 2), (4, [60.0, 1.0], 2), (5, [1e30, 1.0], 2), (6, [30.0, 1.0], 2)]
    want = slow_negatives(huge)
    assert want and sorted(map(tuple, hard_negatives.mine(labelled_vectors(spark, huge)).collect())) == want
    assert hard_negatives.mine(labelled_vectors(spark, few).limit(0)).collect() == []


# --- target resampling --------------------------------------------------------------------


def slow_features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return words, [zlib.crc32(f.encode()) % 10_000 for f in [*words, *map(" ".join, zip(words, words[1:], strict=False))]]


def slow_resample(rows, target, percent=25):
    raw, goal = np.zeros(10_000, int), np.zeros(10_000, int)
    for _, text, *_ in rows:
        np.add.at(raw, slow_features(text)[1], 1)
    for text in target:
        np.add.at(goal, slow_features(text)[1], 1)
    gain = [math.floor(1000 * math.log((t + 1) * (raw.sum() + 10_000) / ((s + 1) * (goal.sum() + 10_000)))) for s, t in zip(raw.tolist(), goal.tolist(), strict=True)]
    out = []
    for doc_id, text, *_ in rows:
        words, feats = slow_features(text)
        weight = sum(gain[f] for f in feats) // len(feats) if feats else 0
        key = hashlib.sha256((text or "").encode()).hexdigest() if doc_id is None else doc_id
        h = int(hashlib.sha256(f"7:{key}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, len(feats), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)))
    able = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    rank = {}
    for place, r in enumerate(able[: percent * len(able) // 100], 1):
        rank.setdefault(r, []).append(place)
    return sorted(((*r[:4], rank[r].pop() if rank.get(r) else None) for r in out), key=repr)


def test_resampling_equals_brute_force(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["Été", "日本", "x_y", "Don't", "UPPER"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 60))), None, None, None) for i in range(300)]
    rows += odd_rows() + [(None, "null id " * 30, None, None, None)] * 7 + [rows[3]] * 5 + [(7, rows[8][1], None, None, None)]
    target = [None, "", *[" ".join(rng.choices(words[:9], k=40)) for _ in range(20)]]
    goal = spark.createDataFrame([(i, t, "x") for i, t in enumerate(target)], "item_id long, text string, buckets string")
    docs = frame(spark, rows)
    got = sorted((tuple(r) for r in target_resampling.resample(docs, goal).collect()), key=repr)
    assert got == slow_resample(rows, target)
    assert [r for r in got if r[4] == 1] and sorted(r[4] for r in got if r[4]) == list(range(1, 1 + sum(r[4] is not None for r in got)))
    empty = target_resampling.resample(docs.limit(0), goal.limit(0))
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_features", "weight", "score", "rank"]


def test_runs_of_words_overlap():
    text = "a  B-c\td"
    got = target_resampling.bucket_numbers(text, target_resampling.run_pattern(3), 3, 10_000)
    want = [zlib.crc32(f) % 10_000 for f in (b"a", b"a b", b"a b c", b"b", b"b c", b"b c d", b"c", b"c d", b"d")]
    assert got == want and target_resampling.bucket_numbers(text, target_resampling.run_pattern(1), 1, 10_000) == [want[0], want[3], want[6], want[8]]
