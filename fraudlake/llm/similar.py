"""Similarity join of texts on word shingles by chosen paths.

A text's set holds the hashes of its runs of five words (lower case, letters, marks
and digits; characters of scripts without spaces are words of their own); texts with equal sets are copies and one class from the start. Classes
with Jaccard similarity of at least 0.8 are linked.

Chosen paths: in every run each set walks down a tree; at a node it goes on to the
children of one or two sampled tokens (smallest token under a hash of the node's
coordinate; 1 / similarity of them on average), so similar sets stay together with
a known probability. Nodes of one set are dropped, nodes of few sets are leaves, the
others are split again down to ``DEPTH``. Leaves are compared by brute force: first
on 64-token sketches (so far below the threshold that a pair at it is lost with a
chance of at most ``SKETCH_MISS``), then exactly on the whole sets. Large leaves are compared in pairs of blocks, so no task holds a whole hot
group. A pair counts in the first leaf that holds it, so nothing is counted twice
and no pair is ever written out: a leaf gives each set its number of partners and
one link to a root of its group. Runs are repeated until the chance that a pair at
the threshold meets at least once reaches the target recall.

Cases: null texts and texts without a word have no shingles, link to nothing and are
classes of their own; a text of one to four words has one shingle; very long texts
are read whole, their sets only where they have a likely partner; repeated rows are
copies; a null doc_id comes after all others, so a class is named null only if it has
no other; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake.llm.common import saved, shuffle_width, text_slices
from fraudlake.llm.words import letter_table, mix, shingles, spaced_words, word_hashes, words_of

DEPTH = 2
SMALL = 64  # sets of a node that is compared at once
BLOCK_SETS, BLOCK_SHINGLES = 1024, 1_000_000
COORDS = 64
SKETCH_MISS = 1e-5


def runs_for(recall: float, similarity: float) -> int:
    """Runs until a pair at the threshold shares a leaf of the full depth with chance ``recall``."""
    extra = 1 / similarity - 1  # chance of a second token at a node
    meet = 1.0
    for _ in range(DEPTH):
        miss = 1 - similarity * meet
        meet = 1 - (1 - extra) * miss - extra * miss * miss
    return math.ceil(math.log(1 - recall) / math.log(1 - meet))


def sketch_floor(similarity: float) -> int:
    """Equal sketch tokens below which a pair at ``similarity`` falls with a chance of at most ``SKETCH_MISS``."""
    below = 0.0
    for n in range(COORDS):
        below += math.comb(COORDS, n) * similarity**n * (1 - similarity) ** (COORDS - n)
        if below > SKETCH_MISS:
            return n
    return COORDS


def _sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    w = words_of(spaced_words(texts), letter_table(digits=True))
    return shingles(word_hashes(w), w.first)


def _set_keys(values: np.ndarray, at: np.ndarray) -> list[bytes | None]:
    """A 16-byte key of each set; None for an empty set."""
    full = np.flatnonzero(np.diff(at))
    keys: list[bytes | None] = [None] * (len(at) - 1)
    if len(full):
        halves = [np.add.reduceat(mix(values ^ np.uint64(c)), at[full]) for c in (0x51ED270B9F1D4A37, 0xD1B54A32D192ED03)]
        both = np.ascontiguousarray(np.stack(halves, axis=1)).view("V16").ravel()
        for i, k in zip(full.tolist(), both.tolist(), strict=True):
            keys[i] = bytes(k)
    return keys


def _sketches(batches):
    odd = mix(np.arange(1, COORDS + 1, dtype=np.uint64)) | np.uint64(1)
    for batch in batches:
        for part in text_slices(batch):
            values, at = _sets(part.column("text"))
            full = np.flatnonzero(np.diff(at))
            sketch = np.zeros((part.num_rows, COORDS), dtype="<u4")
            if len(full):
                for c in range(COORDS):
                    sketch[full, c] = np.minimum.reduceat(mix_fast(values, odd[c]), at[full]) >> np.uint64(32)
            keys = _set_keys(values, at)
            yield pa.record_batch(
                [
                    part.column("doc_id"), part.column("row"), pa.array(keys, pa.binary()), pa.array(np.diff(at)),
                    pa.array([s.tobytes() if k else None for s, k in zip(sketch, keys, strict=True)], pa.binary()),
                ],
                names=["doc_id", "row", "sid", "n", "sketch"],
            )


def mix_fast(values: np.ndarray, odd: np.uint64) -> np.ndarray:
    """One of many hashes of well-mixed 64-bit values (high bits count)."""
    h = values * odd
    h ^= h >> np.uint64(32)
    h *= odd
    return h


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, row, sid, n, sketch): key and size of each text's set, and its smallest tokens."""
    return docs.select("doc_id", "row", "text").mapInArrow(_sketches, "doc_id long, row long, sid binary, n long, sketch binary")


def _place(doc_id: str = "doc_id", row: str = "row"):
    """A row's place among those of its class: by doc_id, null last, then by row."""
    return F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("doc_id"), F.col(row).alias("row"))


def _token(c):
    return F.substring("sketch", 4 * c + 1, 4)


def _sized(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` of nodes with more than one set, with the node's sets and shingles."""
    sizes = rows.groupBy("key").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles")).where("sets > 1")
    return rows.join(saved(sizes, label), "key")


def leaves(classes: DataFrame, runs: int, similarity: float) -> DataFrame:
    """(sid, n, slot, key, sets, shingles): the leaves each set is in; a slot's keys exclude each other."""
    extra = 1 / similarity - 1
    paths = [r for r in range(runs) for _ in range(1 + (math.floor((r + 1) * extra) > math.floor(r * extra)))]
    first = [F.struct(F.lit(p).alias("path"), F.xxhash64(F.lit(p), _token(p)).alias("key")) for p in range(len(paths))]
    rows = classes.select("sid", "n", "sketch", F.explode(F.array(*first)).alias("x")).select("sid", "n", "x.path", "x.key")
    found, width = [], 1 << DEPTH
    rows = rows.withColumn("slot", F.col("path") * width)
    for level in range(1, DEPTH + 1):
        sized = _sized(rows, "similar-nodes")
        if level == DEPTH:
            found.append(sized)
            break
        sized = saved(sized, "similar-level")
        found.append(sized.where(F.col("sets") <= SMALL))
        large = sized.where(F.col("sets") > SMALL).select("sid", "n", "path", "key", "slot")
        large = large.join(classes.select("sid", "sketch"), "sid")
        base = len(paths) * (2 * level - 1)
        picks = [
            F.struct(
                (F.col("slot") + level * 2 - 1 + c).alias("slot"),
                F.xxhash64("key", F.lit(c), F.expr(f"substring(sketch, 4 * ({base} + 2 * path + {c}) + 1, 4)")).alias("key"),
            )
            for c in (0, 1)
        ]
        two = F.pmod(F.xxhash64("key", F.lit("two")), F.lit(1000)) < 1000 * extra
        rows = large.select("sid", "n", "path", F.explode(F.when(two, F.array(*picks)).otherwise(F.array(picks[0]))).alias("x")).select(
            "sid", "n", "path", "x.slot", "x.key"
        )
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.select("sid", "n", "slot", "key", "sets", "shingles")


def _units(rows: DataFrame) -> DataFrame:
    """Rows (sid, ..., leaves) once for each unit of work: leaf ``key`` and its blocks ``i`` <= ``j``."""
    one = rows.withColumn("x", F.explode("leaves")).withColumns({c: F.col(f"x.{c}") for c in ("slot", "key", "blocks")})
    block = F.pmod(F.xxhash64("sid", "key"), F.col("blocks")).cast("int")
    one = one.withColumn("block", block)
    ij = F.expr("transform(sequence(0, blocks - 1), o -> struct(least(o, block) AS i, greatest(o, block) AS j))")
    return one.withColumn("y", F.explode(ij)).withColumns({"i": F.col("y.i"), "j": F.col("y.j")}).drop("x", "y", "blocks")


def _dealt(units: DataFrame, *more: str) -> DataFrame:
    keys = ["key", "i", "j", *more]
    return units.repartition(shuffle_width(units.sparkSession), *keys).sortWithinPartitions(*keys)


def _by_unit(batches, keys: list[str]):
    """Tables of whole units, and the bounds of the units in each."""
    held = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = t if held is None else pa.concat_tables([held, t])
        cut = _bounds(t, keys)
        if len(cut) > 2:
            yield t.slice(0, cut[-2]).combine_chunks(), cut[:-1]
            t = t.slice(cut[-2])
        held = t
    if held is not None and len(held):
        yield held.combine_chunks(), np.array([0, len(held)])


def _bounds(t: pa.Table, keys: list[str]) -> np.ndarray:
    edge = np.ones(len(t) + 1, dtype=bool)
    if len(t):
        edge[1:-1] = np.any([np.diff(t.column(k).to_numpy()) != 0 for k in keys], axis=0)
    return np.flatnonzero(edge)


def _column(t: pa.Table, name: str):
    c = t.column(name)
    return c.chunk(0) if c.num_chunks else pa.array([], c.type)


def _slots(col: pa.Array, slots: int) -> np.ndarray:
    """(rows, slots): the key of each row's leaf in each slot, 0 where it has none."""
    out = np.zeros((len(col), slots), dtype=np.int64)
    flat, at = col.flatten(), np.diff(col.offsets.to_numpy())
    row = np.repeat(np.arange(len(col)), at)
    out[row, flat.field("slot").to_numpy()] = flat.field("key").to_numpy()
    return out


def _new_pairs(a: np.ndarray, b: np.ndarray, slot: int) -> np.ndarray:
    """(rows of a, rows of b): True where the two share no leaf in an earlier slot."""
    met = np.zeros((len(a), len(b)), dtype=bool)
    for s in range(slot):
        x, y = a[:, s], b[:, s]
        if x.any() and y.any():
            met |= (x[:, None] == y[None, :]) & (x != 0)[:, None]
    return ~met


def _families(links: np.ndarray) -> np.ndarray:
    """For a symmetric matrix of links: the smallest index in each row's connected group."""
    n = len(links)
    label = np.arange(n)
    while True:
        low = np.where(links, label[None, :], n).min(axis=1)
        new = np.minimum(label, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _sides(i: int, j: int, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the two sides of a unit (the same rows where it is one block)."""
    if i == j:
        rows = np.arange(len(block))
        return rows, rows
    return np.flatnonzero(block == i), np.flatnonzero(block == j)


def _square(n: int, left: np.ndarray, right: np.ndarray, mask: np.ndarray) -> np.ndarray:
    out = np.zeros((n, n), dtype=bool)
    out[np.ix_(left, right)] = mask
    out |= out.T
    np.fill_diagonal(out, False)
    return out


def _candidates(similarity: float, slots: int):
    """Sketch comparison: keeps the sets of a unit that have a likely partner, by family."""
    floor = sketch_floor(similarity)
    keys = ["key", "i", "j"]

    def task(batches):
        for t, cut in _by_unit(batches, keys):
            sketch = np.frombuffer(b"".join(_column(t, "sketch").to_pylist()), "<u4").reshape(-1, COORDS)
            size, block, slot = (t.column(c).to_numpy() for c in ("n", "block", "slot"))
            ij = [t.column(c).to_numpy() for c in ("i", "j")]
            leaf = _slots(_column(t, "leaves"), slots)
            take, family = [], []
            for lo, hi in zip(cut[:-1], cut[1:], strict=True):
                if hi - lo < 2:
                    continue
                left, right = _sides(ij[0][lo], ij[1][lo], block[lo:hi])
                if not len(left) or not len(right):
                    continue
                same = np.zeros((len(left), len(right)), dtype=np.uint8)
                a, b = sketch[lo:hi][left], sketch[lo:hi][right]
                for c in range(COORDS):
                    same += a[:, c][:, None] == b[:, c][None, :]
                x, y = size[lo:hi][left], size[lo:hi][right]
                ok = same >= floor
                ok &= np.minimum.outer(x, y) >= similarity * np.maximum.outer(x, y) - 1e-9
                if not ok.any():
                    continue
                ok &= _new_pairs(leaf[lo:hi][left], leaf[lo:hi][right], slot[lo])
                links = _square(hi - lo, left, right, ok)
                rows = np.flatnonzero(links.any(axis=1))
                take.append(rows + lo)
                family.append(_families(links)[rows])
            if take:
                kept = t.select(["key", "i", "j", "slot", "block", "sid", "n", "copies", "leaves"]).take(pa.array(np.concatenate(take)))
                kept = kept.append_column("family", pa.array(np.concatenate(family).astype(np.int32)))
                yield from kept.to_batches()

    return task


def _common(a: list[np.ndarray], b: list[np.ndarray], columns: int = 2048) -> np.ndarray:
    """Sizes of the intersections of the sets of ``a`` with those of ``b``."""
    if len(a) == 1 and len(b) == 1:
        return np.array([[len(np.intersect1d(a[0], b[0], assume_unique=True))]])
    flat = np.concatenate([*a, *b])
    row = np.repeat(np.arange(len(a) + len(b)), [len(x) for x in [*a, *b]])
    _, token, seen = np.unique(flat, return_inverse=True, return_counts=True)
    keep = seen[token] > 1
    row, token = row[keep], token[keep]
    order = np.argsort(token, kind="stable")
    row, token = row[order], token[order]
    token = np.cumsum(np.diff(token, prepend=token[:1]) != 0)
    out = np.zeros((len(a), len(b)), dtype=np.float64)
    for lo in range(0, int(token[-1]) + 1 if len(token) else 0, columns):
        s, e = np.searchsorted(token, [lo, lo + columns])
        x = np.zeros((len(a) + len(b), columns), dtype=np.float32)
        x[row[s:e], token[s:e] - lo] = 1
        out += x[: len(a)] @ x[len(a) :].T
    return out


def _verified(similarity: float, slots: int):
    """Exact comparison of a family: each set's partners (as documents) and its group's root."""
    keys = ["key", "i", "j", "family"]

    def task(batches):
        for t, cut in _by_unit(batches, keys):
            values, ends = _column(t, "values"), _column(t, "values").offsets.to_numpy()
            flat = values.values.to_numpy().view(np.uint64)
            sets = [flat[s:e] for s, e in zip(ends[:-1], ends[1:], strict=True)]
            size, block, slot, copies = (t.column(c).to_numpy() for c in ("n", "block", "slot", "copies"))
            ij = [t.column(c).to_numpy() for c in ("i", "j")]
            leaf = _slots(_column(t, "leaves"), slots)
            sid = _column(t, "sid").to_pylist()
            out = []
            for lo, hi in zip(cut[:-1], cut[1:], strict=True):
                left, right = _sides(ij[0][lo], ij[1][lo], block[lo:hi])
                if hi - lo < 2 or not len(left) or not len(right):
                    continue
                x, y = size[lo:hi][left], size[lo:hi][right]
                if len(left) == 2 and ij[0][lo] == ij[1][lo]:
                    n = _common(sets[lo : lo + 1], sets[lo + 1 : hi])
                    common = np.array([[x[0], n[0, 0]], [n[0, 0], x[1]]])
                else:
                    common = _common([sets[lo + r] for r in left], [sets[lo + r] for r in right])
                ok = common >= similarity / (1 + similarity) * np.add.outer(x, y) - 1e-9
                ok &= _new_pairs(leaf[lo:hi][left], leaf[lo:hi][right], slot[lo])
                links = _square(hi - lo, left, right, ok)
                partners = links @ copies[lo:hi]
                root = _families(links)
                out += [(sid[lo + r], sid[lo + root[r]], int(partners[r])) for r in np.flatnonzero(partners)]
            if out:
                cols = zip(*out, strict=True)
                yield pa.record_batch(
                    [pa.array(list(c), k) for c, k in zip(cols, (pa.binary(), pa.binary(), pa.int64()), strict=True)],
                    names=["sid", "root", "links"],
                )

    return task


def _whole_sets(batches):
    for batch in batches:
        for part in text_slices(batch):
            values, at = _sets(part.column("text"))
            keys = _set_keys(values, at)
            col = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values.view(np.int64)))
            ok = pa.array([k == s for k, s in zip(keys, part.column("sid").to_pylist(), strict=True)])
            yield pa.record_batch([part.column("sid"), col], names=["sid", "values"]).filter(ok)


def groups(links: DataFrame) -> DataFrame:
    """Connected groups of rows (sid, root): (sid, label), label the smallest sid of the group."""
    both = saved(links.select("sid", "root").union(links.select("root", "sid")).where("sid != root").distinct(), "similar-links")
    labels = saved(both.groupBy("sid").agg(F.min("root").alias("m")).select("sid", F.least("sid", "m").alias("label")), "similar-labels")
    while True:
        seen = labels.select(F.col("sid").alias("root"), F.col("label").alias("other"))
        near = both.join(seen, "root").groupBy("sid").agg(F.min("other").alias("near"))
        step = saved(labels.join(saved(near, "similar-near"), "sid").select("sid", "label", F.least("label", "near").alias("next")), "similar-step")
        jump = step.select(F.col("sid").alias("next"), F.col("next").alias("after"))
        new = saved(step.join(jump, "next").select("sid", F.least("next", "after").alias("label"), (F.col("label") != F.col("after")).alias("moved")), "similar-labels")
        labels = new.select("sid", "label")
        if new.where("moved").isEmpty():
            return labels


def similar_documents(docs: DataFrame, similarity: float = 0.8, recall: float = 0.999) -> DataFrame:
    """(doc_id, class_id, links) of every document.

    ``class_id``: the smallest doc_id of the connected group of similar documents;
    ``links``: how many other documents are similar to this one, copies included.
    """
    # rows of one doc_id and text hash are told apart by their sets' keys where texts are fetched
    rows = docs.select("doc_id", F.xxhash64("text").alias("row"), "text")
    return _similar(rows, similarity, recall).select("doc_id", "class_id", "links")


def first_of_each_class(docs: DataFrame, key: str) -> DataFrame:
    """(key) of one row of each class: the smallest (doc_id, key), null doc_ids last.

    ``key`` is a long column of ``docs``, different in every row, the same at each read.
    """
    rows = docs.select("doc_id", F.col(key).alias("row"), "text")
    return _similar(rows, 0.8, 0.999).where("first").select(F.col("row").alias(key))


def _similar(docs: DataFrame, similarity: float, recall: float) -> DataFrame:
    """(doc_id, row, class_id, first, links) of rows (doc_id, row, text)."""
    runs = runs_for(recall, similarity)
    slots = 2 * runs << DEPTH
    every = saved(sketches(docs), "similar-sketches")
    classes = saved(
        every.where("sid is not null").groupBy("sid").agg(
            F.min(_place()).alias("rep"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
        ),
        "similar-classes",
    )
    blocks = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    blocks = F.when(F.col("sets") <= SMALL, F.lit(1)).otherwise(blocks)
    paths = leaves(classes, runs, similarity).groupBy("sid").agg(
        F.collect_list(F.struct(F.col("slot").cast("int").alias("slot"), "key", blocks.alias("blocks"))).alias("leaves")
    )
    units = _units(saved(paths, "similar-leaves").join(classes.select("sid", "n", "copies", "sketch"), "sid"))
    schema = "key long, i int, j int, slot int, block int, sid binary, n long, copies long, leaves array<struct<slot:int,key:bigint>>, family int"
    slim = units.withColumn("leaves", F.expr("transform(leaves, x -> struct(x.slot, x.key))"))
    slim = slim.select("key", "i", "j", "slot", "block", "sid", "n", "copies", "sketch", "leaves")
    likely = saved(_dealt(slim).mapInArrow(_candidates(similarity, slots), schema), "similar-likely")
    wanted = saved(likely.select("sid").distinct().join(classes.select("sid", "rep.doc_id", "rep.row"), "sid").toDF("sid", "rep_id", "rep_row"), "similar-wanted")
    # one plan at every size: the few documents to compare are never broadcast
    texts = docs.select(_place().alias("rep"), "text").join(wanted.hint("merge"), F.expr("rep.row = rep_row and rep.doc_id <=> rep_id")).select("sid", "text")
    whole = texts.mapInArrow(_whole_sets, "sid binary, values array<bigint>").dropDuplicates(["sid"])
    found = saved(
        _dealt(likely.join(saved(whole, "similar-sets"), "sid"), "family").mapInArrow(_verified(similarity, slots), "sid binary, root binary, links long"),
        "similar-found",
    )
    labels = groups(found)
    links = found.groupBy("sid").agg(F.sum("links").alias("links"))
    label = labels.join(classes.select("sid", "rep"), "sid")
    least = label.groupBy("label").agg(F.min("rep").alias("least"))
    known = label.join(least, "label").select("sid", "least").join(links, "sid")
    table = saved(classes.select("sid", "rep", "copies").join(known, "sid", "left"), "similar-result")
    least = F.coalesce(F.col("least"), F.col("rep"), _place())
    total = (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).alias("links")
    own = every.select("doc_id", "row", "sid").join(table, "sid", "left")
    return own.select("doc_id", "row", least["doc_id"].alias("class_id"), (least == _place()).alias("first"), total)
