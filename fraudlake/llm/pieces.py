"""Encode many texts by pieces between spaces, each distinct piece once.

Both public tokenizers cut a text into words before they merge, and no word
reaches over a space that is followed by a non-space character (the byte-level
pattern gives that space to the word behind it; the word pattern drops it). So
a text may be cut there, each distinct piece encoded once, and the ids joined.
Where tiktoken knows the vocabulary, whole texts are encoded by it instead.

Cases: a null or empty text has no ids; very long texts are encoded whole, in memory
in proportion to the text; the size of the tables of pieces changes no result.
"""

from __future__ import annotations

import json
import re
import sys
import types
from array import array

#: Cut before a space that has a non-space character behind it.
CUT = re.compile(r" (?=\S)")
#: Python counts these as white space, the tokenizers' patterns do not.
SEPARATORS = re.compile("[\x1c-\x1f]")


class PieceTable:
    """Known pieces and their ids in two generations of at most ``keep`` pieces each.

    When the young generation is full it becomes the old one, and pieces still in
    use move on from there: a bound on memory that keeps the common pieces.
    """

    def __init__(self, keep: int):
        self.keep, self.now, self.old = keep, {}, {}

    def learn(self, parts: set[str], lead: str, encode_pieces) -> None:
        """Afterwards ``now`` holds all ``parts``; ``lead`` goes in front of a piece to encode it."""
        need = parts - self.now.keys()
        if len(self.now) + len(need) > self.keep:
            self.now, self.old, need = {}, self.now, parts
        moved = need & self.old.keys()
        self.now.update({p: self.old[p] for p in moved})
        new = list(need - moved)
        self.now.update(zip(new, encode_pieces([lead + p for p in new]), strict=True))


def kept_in_worker(name: str, make):
    """What ``make()`` gives, kept by a Python worker from task to task under ``name``."""
    place = sys.modules.setdefault("_worker_piece_tables", types.ModuleType("_worker_piece_tables")).__dict__
    if name not in place:
        place[name] = make()
    return place[name]


def worker_table(name: str, keep: int) -> PieceTable:
    """A table that a Python worker keeps from task to task."""
    return kept_in_worker(f"{name} {keep}", lambda: PieceTable(keep))


class SpacedPieces:
    """For a tokenizer that keeps the space in front of a word.

    ids of whole texts as little-endian unsigned 32-bit bytes; null counts as empty.
    ``encode_pieces(list of str) -> list of bytes`` gives the ids of pieces.
    """

    def __init__(self, encode_pieces, keep: int = 250_000):
        self.encode_pieces = encode_pieces
        self.first, self.later = PieceTable(keep), PieceTable(keep)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        cut = [t.split(" ") if t else [""] for t in texts]
        heads = [c.pop(0) for c in cut]
        parts = set().union(*cut)
        # a run of white space may not be cut: those texts are cut with more care
        if odd := {p for p in parts - self.later.now.keys() if not p or p[0].isspace()}:
            for i, c in enumerate(cut):
                if not odd.isdisjoint(c):
                    heads[i], *cut[i] = CUT.split(texts[i])
            parts = set().union(*cut)
        self.first.learn(set(heads), "", self.encode_pieces)
        self.later.learn(parts, " ", self.encode_pieces)
        first, later = self.first.now, self.later.now
        return [first[h] + b"".join(map(later.__getitem__, c)) for h, c in zip(heads, cut, strict=True)]


class WordPieces:
    """For a tokenizer that lower-cases and drops white space; ids as above."""

    def __init__(self, encode_pieces, table: PieceTable):
        self.encode_pieces, self.known = encode_pieces, table

    def encode(self, texts: list[str | None]) -> list[bytes]:
        cut = []
        for t in texts:
            t = t or ""
            t = t.lower() if t.isascii() else t
            cut.append(t.split(" ") if SEPARATORS.search(t) else t.split())
        self.known.learn(set().union(*cut), "", self.encode_pieces)
        return [b"".join(map(self.known.now.__getitem__, c)) for c in cut]


def library_words(path: str, keep: int = 600_000, block: int = 256) -> WordPieces:
    """Texts encoded by the tokenizers library with the lower-casing word tokenizer ``path``.

    Pieces are encoded ``block`` at a time in one string, between marks that are a
    word, and a token, of their own.
    """
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import numpy as np
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    mark = "\x01"
    (mark_id,) = tok.encode(mark, add_special_tokens=False).ids

    def encode_pieces(parts):
        if any(mark in p for p in parts):
            return [array("I", e.ids).tobytes() for e in tok.encode_batch_fast(parts, add_special_tokens=False)]
        blocks = [parts[i : i + block] for i in range(0, len(parts), block)]
        out = []
        for e in tok.encode_batch_fast([f" {mark} ".join(b) for b in blocks], add_special_tokens=False):
            ids = np.array(e.ids, dtype="<u4")
            cut = np.flatnonzero(ids == mark_id)
            data, ends = ids.tobytes(), [*cut.tolist(), len(ids)]
            out += [data[4 * lo : 4 * hi] for lo, hi in zip([0, *(cut + 1).tolist()], ends, strict=True)]
        return out

    return WordPieces(encode_pieces, worker_table(path, keep))


def byte_symbols() -> dict[int, str]:
    """The public byte-level alphabet: printable bytes stand for themselves, the rest for code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WholeTexts:
    """Whole texts to ids by tiktoken, with the tokenizers library for what tiktoken refuses."""

    def __init__(self, tok, path: str):
        self.tok, self.path = tok, path
        self.mark = re.compile("|".join(map(re.escape, tok.special_tokens_set)) or "(?!)")

    def encode_pieces(self, parts: list[str]) -> list[bytes]:
        return [self._one(p) for p in parts]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """ids of whole texts as little-endian unsigned 32-bit bytes; null counts as empty."""
        return [self._one(t) if t else b"" for t in texts]

    def _one(self, text: str) -> bytes:
        try:
            allowed = self.tok.special_tokens_set if self.mark.search(text) else set()
            return self.tok.encode_to_numpy(text, allowed_special=allowed, disallowed_special=()).astype("<u4").tobytes()
        except ValueError:  # the pattern runs out of its stack in very long runs of white space
            return array("I", plain_tokenizer(self.path).encode(text, add_special_tokens=False).ids).tobytes()


def plain_tokenizer(path: str):
    """The tokenizers library's own encoder, kept in the worker, without truncation and padding."""
    from tokenizers import Tokenizer

    def make():
        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        return tok

    return kept_in_worker(f"library {path}", make)


def library_bytes(path: str) -> WholeTexts:
    """Texts encoded as the tokenizers library does with the byte-level tokenizer ``path``.

    The file's vocabulary is in the order of its merges, so its ids are ranks; texts
    are merged by tiktoken with them, in a fraction of the time.
    """
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    code = {c: b for b, c in byte_symbols().items()}
    vocab = spec["model"]["vocab"]
    ranks = {bytes(code[c] for c in token): i for token, i in vocab.items()}
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    made = [vocab[a + b] for a, b in merges]
    if made != sorted(made):
        raise ValueError(f"the vocabulary of {path} is not in the order of its merges")
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tok = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return WholeTexts(tok, path)
