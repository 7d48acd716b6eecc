"""Language of text spans: script ranges, per-word scores, Viterbi with a switching penalty.

The model is learned from labelled documents: for each language the counts of
hashed byte n-grams of words (1 to 4 bytes, with word ends), and for each script
the share of each language's words in it. A word's script (the range of its first
letter) narrows the candidates to languages with at least ``min_share`` of their own
learned words in it, however small their part of the corpus is. A word's score for a candidate is the mean log
probability of its n-grams times ``WORD_WEIGHT``; a script without candidates
gives no evidence. Over the words of a text, Viterbi finds the labelling with the
best sum of scores where each change of language costs ``penalty``. Runs of equal
labels are the spans; the document's language is the one with most letters, its
score that language's share of the letters.

Cases: null texts and texts without a letter get ``und``, score 0 and no spans;
letters are judged by Unicode for that, and any byte from 0x80 on counts as a
letter inside a word; ties go to the first language in alphabetical order;
without any labelled text every document is ``und`` and has no spans; very long texts are
judged whole, in one piece each; repeated rows give repeated rows; other columns are
not read; an empty table gives no rows.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, StringType, StructField, StructType

from fraudlake.llm.common import free_name, text_slices
from fraudlake.llm.words import BASE, letter_table, mix, word_hashes, words_of

# fixed values: first code points of Unicode script ranges, in order, and the script from there on
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"),
    (0x0B00, "other"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"),
    (0x0D80, "other"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1200, "ethiopic"), (0x13A0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
    (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"),
]
NAMES = sorted({name for _, name in SCRIPTS})
WORD_WEIGHT = 4.0


class Model(NamedTuple):
    langs: list[str]
    log_p: np.ndarray  # (buckets, languages)
    allowed: np.ndarray  # (scripts, languages)
    bits: int


def _scripts(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Index in NAMES of the script of the letter at each start (UTF-8)."""
    pad = np.concatenate([data, np.zeros(4, np.uint8)]).astype(np.int64)
    b0, b1, b2, b3 = (pad[start + i] for i in range(4))
    tail = lambda *bs: sum((b & 0x3F) << (6 * (len(bs) - 1 - i)) for i, b in enumerate(bs))
    code = np.select(
        [b0 < 0x80, b0 < 0xE0, b0 < 0xF0],
        [b0, ((b0 & 0x1F) << 6) | tail(b1), ((b0 & 0x0F) << 12) | tail(b1, b2)],
        ((b0 & 0x07) << 18) | tail(b1, b2, b3),
    )
    at = np.searchsorted([lo for lo, _ in SCRIPTS], code, side="right") - 1
    return np.array([NAMES.index(name) for _, name in SCRIPTS])[at]


#: a run of words of one language: words from 0, bytes of the lower-cased text
SPAN = "struct<lang:string,first_word:long,n_words:long,n_bytes:long>"


class _Distinct(NamedTuple):
    of: np.ndarray  # index of the distinct word of each word
    bucket: np.ndarray  # n-grams of the distinct words
    owner: np.ndarray  # and the distinct word each belongs to
    script: np.ndarray
    n: int


def _distinct(w, bits: int) -> _Distinct:
    _, first, of = np.unique(word_hashes(w), return_index=True, return_inverse=True)
    start, size = w.start[first], (w.end - w.start)[first]
    n = len(first)
    # each distinct word's bytes between two ends (byte 0)
    width = size + 2
    begin = np.cumsum(width) - width
    owner = np.repeat(np.arange(n), width)
    place = np.arange(len(owner)) - begin[owner]
    inner = (place > 0) & (place <= size[owner])
    byte = np.zeros(len(owner), dtype=np.uint64)
    byte[inner] = w.data[(start[owner] + place - 1)[inner]].astype(np.uint64) + np.uint64(1)
    h, buckets, owners = np.zeros(len(byte), np.uint64), [], []
    for k in range(1, 5):
        last = len(byte) - k + 1
        if last <= 0:
            break
        h = h[:last] * BASE + byte[k - 1 :]
        ok = owner[:last] == owner[k - 1 :] if k > 1 else inner
        buckets.append((mix(h[ok] + np.uint64(k)) >> np.uint64(64 - bits)).astype(np.int64))
        owners.append(owner[:last][ok])
    if not buckets:
        return _Distinct(of, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), n)
    return _Distinct(of, np.concatenate(buckets), np.concatenate(owners), _scripts(w.data, start), n)


def train(docs: DataFrame, bits: int = 15, min_share: float = 0.001, smooth: float = 0.5) -> Model:
    """Learn from all rows (text, lang); rows with a null lang or text are left out."""
    rows = docs.where("lang is not null and text is not null").select("text", "lang")
    langs = sorted(r.lang for r in rows.select("lang").distinct().collect())
    size = (1 << bits) + len(NAMES)  # buckets, then one row a script
    schema = ", ".join(["bucket int", *(f"n{i} long" for i in range(len(langs)))])

    def task(batches):
        table, total = letter_table(), np.zeros((size, len(langs)), np.int64)
        for batch in batches:
            for part in text_slices(batch):
                w = words_of(part.column("text"), table)
                d = _distinct(w, bits)
                lang = np.array([langs.index(x) for x in part.column("lang").to_pylist()])
                lang = np.repeat(lang, np.diff(w.first))
                seen = np.bincount(d.of * len(langs) + lang, minlength=d.n * len(langs)).reshape(d.n, len(langs))
                for i in range(len(langs)):
                    count = np.bincount(d.bucket, weights=seen[d.owner, i], minlength=1 << bits)
                    total[: 1 << bits, i] += count.astype(np.int64)
                    total[1 << bits :, i] += np.bincount(d.script, weights=seen[:, i], minlength=len(NAMES)).astype(np.int64)
        at = np.flatnonzero(total.any(axis=1))
        cols = [pa.array(at, pa.int32()), *(pa.array(total[at, i]) for i in range(len(langs)))]
        yield pa.record_batch(cols, names=["bucket", *(f"n{i}" for i in range(len(langs)))])

    total = np.zeros((size, max(1, len(langs))))
    if langs:
        sums = [F.sum(f"n{i}").alias(f"n{i}") for i in range(len(langs))]
        for r in rows.mapInArrow(task, schema).groupBy("bucket").agg(*sums).collect():  # one row a bucket
            total[r.bucket] = r[1:]
    grams, scripts = total[: 1 << bits], total[1 << bits :]
    log_p = np.log((grams + smooth) / (grams.sum(axis=0) + smooth * (1 << bits)))
    share = scripts / np.maximum(scripts.sum(axis=0), 1)
    return Model(langs, log_p, share >= max(min_share, 1e-12), bits)


def word_scores(d: _Distinct, model: Model) -> np.ndarray:
    """(distinct words, languages): scores relative to the word's best candidate."""
    count = np.maximum(np.bincount(d.owner, minlength=d.n), 1)[:, None]
    score = np.stack([np.bincount(d.owner, weights=model.log_p[d.bucket, i], minlength=d.n) for i in range(len(model.langs))], axis=1)
    score = WORD_WEIGHT * score / count
    allowed = model.allowed[d.script]
    score = np.where(allowed, score, -1e6)
    score -= score.max(axis=1, keepdims=True)
    score[~allowed.any(axis=1)] = 0
    return score


def viterbi(score: np.ndarray, of: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """The label of every word; texts advance together, word by word."""
    count = np.diff(first)
    order = np.argsort(-count, kind="stable")
    start, size = first[:-1][order], count[order]
    n, langs = len(of), score.shape[1]
    stay, best = np.ones((n, langs), dtype=bool), np.zeros(n, dtype=np.int16)
    label = np.zeros(n, dtype=np.int16)
    if not n:
        return label
    live = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right")  # texts with more than t words
    value = score[of[start[: live[0]]]]
    ends = [None] * len(live)
    for t in range(1, len(live)):
        m = live[t]
        ends[t - 1] = value[m:].argmax(axis=1)
        value = value[:m]
        at = start[:m] + t
        top = value.argmax(axis=1)
        jump = value[np.arange(m), top][:, None] - penalty
        keep = value >= jump
        stay[at], best[at] = keep, top
        value = np.where(keep, value, jump) + score[of[at]]
    ends[-1] = value.argmax(axis=1)
    now = np.zeros(0, dtype=np.int64)
    for t in range(len(live) - 1, -1, -1):
        m = live[t]
        if t + 1 < len(live):
            behind = start[: live[t + 1]] + t + 1
            now = np.where(stay[behind, now], now, best[behind])
        now = np.concatenate([now, ends[t]])
        label[start[:m] + t] = now
    return label


def _judge(part: pa.RecordBatch, model: Model, penalty: float):
    """Words, labels, and the letters each text has in each language."""
    texts = part.column("text")
    w = words_of(texts, letter_table())
    n, langs = part.num_rows, len(model.langs)
    if not langs or not len(w.start):
        return w, np.zeros(len(w.start), np.int16), np.zeros((n, max(1, langs)))
    d = _distinct(w, model.bits)
    label = viterbi(word_scores(d, model), d.of, w.first, penalty)
    row = np.repeat(np.arange(n), np.diff(w.first))
    letters = np.bincount(row * langs + label, weights=w.end - w.start, minlength=n * langs).reshape(n, langs)
    return w, label, letters


def _result(part: pa.RecordBatch, model: Model, letters: np.ndarray):
    total = letters.sum(axis=1)
    top = letters.argmax(axis=1)
    lettered = np.array([t is not None and any(map(str.isalpha, t)) for t in part.column("text").to_pylist()], dtype=bool)
    known = (total > 0) & lettered if model.langs else np.zeros(part.num_rows, dtype=bool)
    lang = [model.langs[i] if k else "und" for i, k in zip(top, known, strict=True)]
    score = np.where(known, letters.max(axis=1) / np.maximum(total, 1), 0.0)
    return pa.array(lang, pa.string()), pa.array(score)


def _spans(part: pa.RecordBatch, w, label: np.ndarray, model: Model) -> tuple[np.ndarray, dict[str, pa.Array]]:
    """The row of each span, and the spans' fields."""
    if not model.langs:
        label = label[:0]
    edge = np.ones(len(label), dtype=bool)
    edge[1:] = label[1:] != label[:-1]
    if len(label):
        edge[w.first[:-1][np.diff(w.first) > 0]] = True
    cut = np.flatnonzero(edge)
    stop = np.append(cut[1:], len(label))[: len(cut)]
    row = np.searchsorted(w.first, cut, side="right") - 1
    return row, {
        "lang": pa.array(model.langs, pa.string()).take(pa.array(label[cut].astype(np.int64))),
        "first_word": pa.array(cut - w.first[row], pa.int64()),
        "n_words": pa.array(stop - cut, pa.int64()),
        "n_bytes": pa.array(w.end[stop - 1] - w.start[cut], pa.int64()),
    }


def _predicted(docs: DataFrame, columns: list[str], model: Model, penalty: float, names: list[str]) -> DataFrame:
    """``columns`` of the rows, with language, score and, for a third name, spans under ``names``."""
    added = [StructField(n, t) for n, t in zip(names, (StringType(), DoubleType(), ArrayType(DataType.fromDDL(SPAN))), strict=False)]

    def task(batches):
        for batch in batches:
            for part in text_slices(batch):
                w, label, letters = _judge(part, model, penalty)
                out = [part.column(c) for c in columns] + [*_result(part, model, letters)]
                if len(names) > 2:
                    row, fields = _spans(part, w, label, model)
                    held = pa.StructArray.from_arrays(list(fields.values()), names=list(fields))
                    out.append(pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)), pa.int32()), held))
                yield pa.record_batch(out, names=[*columns, *names])

    rows = docs.select(*dict.fromkeys([*columns, "text"]))
    return rows.mapInArrow(task, StructType([docs.schema[c] for c in columns] + added))


def predict(docs: DataFrame, model: Model, penalty: float = 12.0, with_spans: bool = False) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text, and its spans as an array where asked."""
    return _predicted(docs, ["doc_id"], model, penalty, ["lang_pred", "score", "spans"][: 2 + with_spans])


def accepted(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, with a language that scores ``min_score`` at least."""
    names = [free_name(docs, "lang_pred"), free_name(docs, "score")]
    judged = _predicted(docs, docs.columns, train(docs.where(~held_out("doc_id"))), 12.0, names)
    return judged.where((F.col(names[0]) != "und") & (F.col(names[1]) >= min_score)).drop(*names)


def spans(docs: DataFrame, model: Model, penalty: float = 12.0) -> DataFrame:
    """(doc_id, lang, first_word, n_words, n_bytes): the spans of each text, in words from 0."""

    def task(batches):
        for batch in batches:
            for part in text_slices(batch):
                w, label, _ = _judge(part, model, penalty)
                row, fields = _spans(part, w, label, model)
                yield pa.record_batch([part.column("doc_id").take(pa.array(row)), *fields.values()], names=["doc_id", *fields])

    return docs.select("doc_id", "text").mapInArrow(task, "doc_id long, lang string, first_word long, n_words long, n_bytes long")


def held_out(doc_id, folds: int = 5):
    """True for documents kept from training: crc32 of doc_id as text divides by ``folds``."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == 0, F.lit(False))


def identify(docs: DataFrame, train_docs: DataFrame | None = None) -> DataFrame:
    """Learn from the training fold and predict all: (doc_id, held_out, lang_pred, score, spans)."""
    source = docs if train_docs is None else train_docs
    model = train(source.where(~held_out("doc_id")))
    judged = predict(docs, model, with_spans=True)
    return judged.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "spans")
