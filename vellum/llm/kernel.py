"""Array kernels shared by the Arrow operators of this subpackage.

Everything works on whole texts: a run of documents is laid end to end as one array of code
points with offsets, windows that would cross a document's end are masked out.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
#: Code points handled at once; longer documents make a chunk of their own.
CHUNK = 1 << 18


@lru_cache(1)
def letter_digit_mask() -> np.ndarray:
    """For every code point, whether its Unicode category is L* or N*."""
    keep = np.zeros(0x110000, dtype=bool)
    cat = unicodedata.category
    for cp in range(0x110000):
        if cat(chr(cp))[0] in "LN":
            keep[cp] = True
    return keep


#: Classes of ``character_classes``.
BLANK, LETTER, DIGIT, MARK, SYMBOL, CODE, WIDE = range(7)


@lru_cache(1)
def character_classes() -> np.ndarray:
    """For every code point its class; code symbols and letters of scripts without word blanks apart."""
    table = np.zeros(0x110000, dtype=np.uint8)
    major = {"L": LETTER, "N": DIGIT, "M": MARK, "P": SYMBOL, "S": SYMBOL}
    cat = unicodedata.category
    for cp in range(0x110000):
        table[cp] = major.get(cat(chr(cp))[0], BLANK)
    for c in "{}<>\\=|_#$%^&@~`[]":
        table[ord(c)] = CODE
    for lo, hi in ((0x0E00, 0x0EFF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF)):
        part = table[lo : hi + 1]
        part[part == LETTER] = WIDE
    return table


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def fold_many(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letters and digits of the lower-cased texts, end to end, with the n+1 offsets."""
    low = [t.lower() for t in texts]
    cp = points("".join(low))
    kept = letter_digit_mask()[cp]
    ends = np.cumsum([len(t) for t in low], dtype=np.int64)
    before = np.concatenate([[0], np.cumsum(kept)])
    return cp[kept], np.concatenate([[0], before[ends]]).astype(np.int64)


def raw_many(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return points("".join(texts)), np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)


def mix64(x: np.ndarray) -> np.ndarray:
    """The 64-bit finalizer of SplitMix64; wraps around."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def spread(cp: np.ndarray) -> np.ndarray:
    """A 64-bit value for each code point, far apart for neighbouring code points."""
    return mix64(cp.astype(U64) + U64(BASE))


def _power(n: int) -> np.uint64:
    return U64(pow(BASE, n, 1 << 64))


def window_hashes(values: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash mod 2^64 of every window of ``n`` values, by doubling; len - n + 1 of them."""
    if len(values) < n:
        return np.empty(0, dtype=U64)
    done, acc, step, length = 0, None, values, 1
    bits = n
    while bits:
        if bits & 1:
            if acc is None:
                acc, done = step, length
            else:
                m = len(values) - (done + length) + 1
                acc = acc[:m] * _power(length) + step[done : done + m]
                done += length
        bits >>= 1
        if bits:
            m = len(step) - length
            step = step[:m] * _power(length) + step[length:]
            length *= 2
    return acc


def inside(offsets: np.ndarray, n: int) -> np.ndarray:
    """For windows of ``n`` over the laid-out documents, which stay inside one document."""
    total = int(offsets[-1])
    ok = np.ones(max(0, total - n + 1), dtype=bool)
    for end in offsets[1:-1]:
        ok[max(0, int(end) - n + 1) : int(end)] = False
    return ok


def owner(offsets: np.ndarray) -> np.ndarray:
    """The document's index of each position."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` consecutive values; len - w + 1 of them."""
    length = 1
    while length * 2 <= w:
        x = np.minimum(x[: len(x) - length], x[length:])
        length *= 2
    if length < w:
        x = np.minimum(x[: len(x) - (w - length)], x[w - length :])
    return x


def text_runs(
    batches: Iterator[pa.RecordBatch], id_at: int = 0, text_at: int = 1, limit: int = CHUNK
) -> Iterator[tuple[list[int], list[str]]]:
    """Ids and texts of the rows with a text, a run of about ``limit`` characters at a time."""
    ids: list[int] = []
    texts: list[str] = []
    held = 0
    for batch in batches:
        for key, text in zip(batch.column(id_at).to_pylist(), batch.column(text_at).to_pylist()):
            if text is None or key is None:
                continue
            if ids and held + len(text) > limit:
                yield ids, texts
                ids, texts, held = [], [], 0
            ids.append(key)
            texts.append(text)
            held += len(text)
    if ids:
        yield ids, texts


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def intervals_of(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]
