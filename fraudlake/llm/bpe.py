"""BPE encoding and decoding with a pair occurrence index.

The distinct words of a slice of a partition are laid out as one array of
symbols. An index maps the rank of each adjacent pair to all positions at which
the pair occurs. Active ranks are taken in ascending order; applying a rank
merges every position of its list (left to right) and puts the pairs that this
makes into the lists of their own ranks, which are always higher.

Cases: a null text counts as empty (no ids, empty decoded text); equal rows give
equal rows; other columns of the input are not read; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import json
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fraudlake.llm.common import text_slices
from fraudlake.llm.pieces import SpacedPieces, byte_symbols


class PairIndexBpe:
    """A byte-level BPE vocabulary in the tokenizers library's JSON format."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_symbols()
        vocab = spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.byte_id = [vocab[alphabet[b]] for b in range(256)]
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for n, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[vocab[a], vocab[b]] = (n, vocab[a + b])
        by_char = {c: b for b, c in alphabet.items()}
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(by_char[c] for c in token)
        for token, i in self.added.items():
            self.token_bytes[i] = token.encode()
        # fixed value: the public pre-tokenizer pattern of this vocabulary
        self.words = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        )
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        self.known: dict[str, bytes] = {}

    def merge_words(self, words: list[str]) -> list[bytes]:
        """ids of each word as little-endian unsigned 32-bit bytes."""
        rank, byte_id = self.rank, self.byte_id
        sym: list[int] = []
        ends: list[int] = []
        for w in words:
            sym.extend([byte_id[b] for b in w.encode()])
            sym.append(-1)  # ends a word: no pair holds it
            ends.append(len(sym))
        n = len(sym)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        index: dict[int, list[int]] = {}
        rule: dict[int, tuple[int, int, int]] = {}
        for i, pair in enumerate(zip(sym, sym[1:], strict=False)):
            hit = rank.get(pair)
            if hit is not None:
                at = index.get(hit[0])
                if at is None:
                    index[hit[0]] = at = []
                    rule[hit[0]] = (*pair, hit[1])
                at.append(i)
        active = sorted(index)  # a sorted list is a heap
        while active:
            r = heappop(active)
            a, b, made = rule[r]
            for i in sorted(index.pop(r)):
                j = after[i]
                if sym[i] != a or j >= n or sym[j] != b:
                    continue  # a neighbour took part in an earlier merge
                sym[i], sym[j] = made, -2
                k = after[i] = after[j]
                before[k] = i
                for left, right in ((before[i], i), (i, k)):
                    if left < 0:
                        continue
                    pair = (sym[left], sym[right])
                    hit = rank.get(pair)
                    if hit is None:
                        continue
                    at = index.get(hit[0])
                    if at is None:
                        index[hit[0]] = at = []
                        rule[hit[0]] = (*pair, hit[1])
                        heappush(active, hit[0])
                    at.append(left)
        out, lo = [], 0
        ids = np.array(sym, dtype=np.int64)
        whole = np.cumsum(ids >= 0)
        flat = ids[ids >= 0].astype("<u4").tobytes()
        for hi in ends:
            stop = int(whole[hi - 1])
            out.append(flat[4 * lo : 4 * stop])
            lo = stop
        return out

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """ids of texts: special tokens first, then words, then merges."""
        cut = []
        for p in pieces:
            parts = self.special.split(p) if self.special and "<" in p else [p]
            words = []
            for i, part in enumerate(parts):
                words.extend([part] if i % 2 else self.words.findall(part))
            cut.append(words)
        if len(self.known) > 400_000:
            self.known.clear()
        new = list({w for c in cut for w in c} - self.known.keys() - self.added.keys())
        self.known.update(zip(new, self.merge_words(new), strict=True))
        self.known.update({t: i.to_bytes(4, "little") for t, i in self.added.items()})
        return [b"".join(map(self.known.__getitem__, c)) for c in cut]

    def encoder(self) -> SpacedPieces:
        return SpacedPieces(self.encode_pieces)

    def decode(self, ids: bytes) -> str:
        """The text of little-endian unsigned 32-bit ids; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.token_bytes.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


def encode_texts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids array<int>) of every whole text."""

    def task(batches):
        bpe = None
        for batch in batches:
            bpe = bpe or PairIndexBpe(tokenizer)
            encoder = bpe.encoder()
            for part in text_slices(batch):
                ids = encoder.encode(part.column("text").to_pylist())
                yield pa.record_batch(
                    [part.column("doc_id"), pa.array([list(memoryview(x).cast("I")) for x in ids], pa.list_(pa.int32()))],
                    names=["doc_id", "ids"],
                )

    return docs.select("doc_id", "text").mapInArrow(task, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids)."""

    def task(batches):
        bpe = None
        for batch in batches:
            bpe = bpe or PairIndexBpe(tokenizer)
            out = [b"".join(map(bpe.token_bytes.__getitem__, x or ())).decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(task, "doc_id long, text string")


def round_trip_digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Encode and decode every whole text: (doc_id, n_tokens, ids_sha256, decoded_sha256)."""

    def task(batches):
        bpe = encoder = None
        for batch in batches:
            bpe = bpe or PairIndexBpe(tokenizer)
            encoder = encoder or bpe.encoder()
            for part in text_slices(batch):
                ids = encoder.encode(part.column("text").to_pylist())
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                        pa.array([hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in ids], pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        task, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
