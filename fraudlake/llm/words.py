"""Words, n-grams and hashes of many texts at once, on Arrow text buffers.

A text is seen as UTF-8 bytes. Bytes fall into classes; a word is a maximal run
of bytes of one word class inside one text. Every byte from 0x80 on counts as a
letter, so letters of all scripts are kept (and so is non-ASCII punctuation, unless
``spaced_words`` has taken it out).

Cases: a null or empty text has no words; very long texts are read whole, their words
hashed in blocks of bytes; an empty column gives empty arrays.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from fraudlake.llm.common import offsets_of

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
BLOCK = 1 << 19


class Words(NamedTuple):
    data: np.ndarray  # bytes of all texts
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # byte behind each word
    first: np.ndarray  # index of the first word of each text, and the number of words


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the output."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def letter_table(digits: bool = False, marks: bool = False) -> np.ndarray:
    """Class of each byte: 1 letter (and digit), 2 other visible ASCII if ``marks``, else 0."""
    table = np.zeros(256, dtype=np.uint8)
    if marks:
        table[33:127] = 2
        table[48:58] = 0 if not digits else 1
    table[ord("a") : ord("z") + 1] = table[ord("A") : ord("Z") + 1] = 1
    if digits:
        table[48:58] = 1
    table[128:] = 1
    return table


def text_buffers(texts: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; null counts as empty."""
    col = texts.cast(pa.large_string()).fill_null("")
    if lower:
        col = pc.utf8_lower(col)
    _, offsets, data = col.buffers()
    at = np.frombuffer(offsets, np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and len(col) else np.zeros(0, np.uint8)
    return raw, at - at[0]


#: Scripts written without spaces between words.
UNSPACED = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]\p{M}*"


def spaced_words(texts: pa.Array) -> pa.Array:
    """Texts with a space for non-ASCII runs of neither letters, marks nor digits, and around characters of ``UNSPACED``."""
    col = texts.cast(pa.large_string()).fill_null("")
    wide = pc.invert(pc.string_is_ascii(col))
    some = pc.replace_substring_regex(col.filter(wide), r"[^\x00-\x7F\p{L}\p{M}\p{N}]+", " ")
    some = pc.replace_substring_regex(some, f"({UNSPACED})", r" \1 ")
    return pc.replace_with_mask(col, wide, some)


def words_of(texts: pa.Array, table: np.ndarray, lower: bool = True) -> Words:
    data, at = text_buffers(texts, lower)
    kind = table[data]
    edge = np.ones(len(data) + 1, dtype=bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[at] = True
    cut = np.flatnonzero(edge)
    start, end = cut[:-1], cut[1:]
    keep = kind[start] > 0
    start, end = start[keep], end[keep]
    return Words(data, start, end, np.searchsorted(start, at))


def word_hashes(w: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes; memory is bounded by blocks of bytes."""
    out = np.empty(len(w.start), dtype=np.uint64)
    lo = 0
    while lo < len(w.start):
        base = w.start[lo]
        hi = max(lo + 1, int(np.searchsorted(w.end, base + BLOCK, side="right")))
        piece = w.data[base : w.end[hi - 1]].astype(np.uint64) + np.uint64(1)
        n = len(piece)
        power = np.full(n, BASE, dtype=np.uint64)
        inverse = np.full(n, INVERSE, dtype=np.uint64)
        power[0] = inverse[0] = 1
        np.cumprod(power, out=power)
        np.cumprod(inverse, out=inverse)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(piece * power, out=total[1:])
        s, e = w.start[lo:hi] - base, w.end[lo:hi] - base
        out[lo:hi] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64))
        lo = hi
    return out


def chain(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of hashes in order."""
    h = np.zeros(len(parts[0]), dtype=np.uint64)
    for p in parts:
        h = h * BASE + p
    return mix(h + np.uint64(len(parts)))


def shingles(hashes: np.ndarray, first: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of runs of ``n`` words of each text, ascending: (values, offsets).

    A text of 1 to n-1 words has one shingle, of all its words; one without words has none.
    """
    count = np.diff(first)
    rows, values = [], []
    if len(hashes) >= n:
        whole = chain([hashes[i : len(hashes) - n + 1 + i] for i in range(n)])
        owner = np.repeat(np.arange(len(count)), count)
        ok = owner[: len(whole)] == owner[n - 1 :]
        rows.append(owner[: len(whole)][ok])
        values.append(whole[ok])
    for c in range(1, n):
        short = np.flatnonzero(count == c)
        if len(short):
            rows.append(short)
            values.append(chain([hashes[first[:-1][short] + i] for i in range(c)]))
    if not rows:
        return np.zeros(0, np.uint64), np.zeros(len(count) + 1, np.int64)
    row, value = np.concatenate(rows), np.concatenate(values)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    fresh = np.ones(len(row), dtype=bool)
    fresh[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    row, value = row[fresh], value[fresh]
    return value, offsets_of(np.bincount(row, minlength=len(count)))
