"""Plain Python counterparts of the text functions for Arrow kernels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import CLOSERS, sentence_terminals

_RUN = regex.compile(r"[\p{L}\p{M}\p{N}]+")
_UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]")
_CLUSTER = regex.compile(r"[^\p{M}ำຳﾞﾟ][\p{M}ำຳﾞﾟ]*|\p{M}")


def word_list(text: str) -> list[str]:
    out: list[str] = []
    for run in _RUN.findall(text):
        out.extend(_CLUSTER.findall(run) if _UNSPACED.search(run) else [run])
    return out


@lru_cache(1)
def _ends() -> regex.Pattern:
    wide = "".join(c for c in sentence_terminals() if ord(c) > 127)
    closers = regex.escape(CLOSERS.replace("\\", ""))
    return regex.compile(rf"\n|[{wide}][{closers}]*|[.!?][{closers}]*(?=\s|\Z)")


def sentence_spans(text: str) -> list[tuple[int, int]]:
    """Start and end of every sentence, without the white space around it."""
    spans, start = [], 0
    for m in [*_ends().finditer(text), None]:
        end = m.end() if m else len(text)
        piece = text[start:end]
        bare = piece.strip()
        if bare:
            lead = len(piece) - len(piece.lstrip())
            spans.append((start + lead, start + lead + len(bare)))
        start = end
    return spans


def sentence_list(text: str) -> list[str]:
    return [text[a:b] for a, b in sentence_spans(text)]


U64 = np.uint64
_FACTOR = U64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """The 64-bit finalizer of SplitMix64."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@lru_cache(1 << 16)
def _word_hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word)


def gram_hashes(words: Sequence[str], n: int) -> np.ndarray:
    """A 64-bit hash of every ``n`` consecutive words; each word is hashed once."""
    m = len(words) - n + 1
    if m <= 0:
        return np.empty(0, dtype=U64)
    h = np.fromiter(map(_word_hash, words), dtype=U64, count=len(words))
    out = np.zeros(m, dtype=U64)
    for k in range(n):
        out = out * _FACTOR + h[k : k + m]
    return mixed(out)


class Bitmap:
    """A Bloom filter of two probes over 64-bit hashes; its size follows their number within bounds.

    Beyond ``MOST`` bits (16 MB) it lets more through; what passes is always checked by a join.
    """

    EACH, LEAST, MOST, SECOND = 16, 1 << 16, 1 << 27, U64(32)

    def __init__(self, table: np.ndarray) -> None:
        self.table, self.last = table, U64(8 * len(table) - 1)

    @classmethod
    def size(cls, n: int) -> int:
        return min(cls.MOST, max(cls.LEAST, 1 << (cls.EACH * max(1, n) - 1).bit_length()))

    def _probe(self, h: np.ndarray) -> np.ndarray:
        at = (h & self.last).astype(np.int64)
        return ((self.table[at >> 3] >> (at & 7).astype(np.uint8)) & 1) > 0

    def may_hold(self, h: np.ndarray) -> np.ndarray:
        """Places in ``h`` of what could be held."""
        hit = np.flatnonzero(self._probe(h))
        return hit[self._probe(h[hit] >> self.SECOND)]


def bitmap_of(hashes: DataFrame, column: str = "h") -> np.ndarray:
    """The table of a ``Bitmap`` over a column of hashes; Spark sets the bits, whole words come back.

    Where there are more hashes than bits a filter is no use: a small one that lets all through is made.
    """
    n = hashes.count()
    bits = Bitmap.size(n)
    if n > bits:
        return np.full(Bitmap.LEAST // 8, 255, dtype=np.uint8)
    both = hashes.select(F.explode(F.array(column, F.shiftrightunsigned(column, int(Bitmap.SECOND)))).alias("h"))
    word, bit = F.expr(f"cast(shiftright(h & {bits - 1}L, 6) as int)"), F.expr("shiftleft(1L, cast(h & 63L as int))")
    words = both.groupBy(word.alias("w")).agg(F.bit_or(bit).alias("b")).toPandas()
    table = np.zeros(bits // 64, dtype=np.int64)
    table[words["w"].to_numpy(dtype=np.int64)] = words["b"].to_numpy(dtype=np.int64)
    return table.view(np.uint8)
