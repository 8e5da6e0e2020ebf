"""Evaluation texts leaking into training text: spaced-seed hashing.

A seed is a window of ``SPAN`` characters of N(text) hashed under a fixed mask that ignores some
of its positions, so a substituted character there does not hide the hit.  Every position of the
test items is indexed, and every ``STEP``-th position of the corpus: an exact run of
``SPAN + STEP - 1`` = 40 characters always holds a probed position.  A Bloom bitmap over the test
hashes, sized by their number, thins out the corpus' probes before the hash join; hits are then
verified around their place, counting substitutions, against the item's whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .kernel import BASE, U64, fold_many, mix64, points, signed, spread, text_runs

SPAN, STEP = 32, 9
#: Blocks (start, length) of the positions that count; the others are ignored.
MASKS = (((0, 8), (12, 8), (24, 8)), ((0, 4), (8, 16), (28, 4)))
#: The bitmap has this many bits for each test hash and is probed twice (1 % false hits), within
#: these bounds; beyond the upper one (64 MB, some 33 million hashes) it only thins out less.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 29
#: The second probe takes the hash from this bit on.
SECOND = 32
#: Characters kept on either side of a probe for the verification; longer overlaps are put
#: together from the hits along them.
CONTEXT = 96
#: Extension: a substitution costs so many matches, and ends it when so far below the best.
COST, DROP = 4, 12


def _seed_hashes(values: np.ndarray, at: np.ndarray, mask: int) -> np.ndarray:
    """Hash under ``MASKS[mask]`` of the windows that start at ``at``."""
    acc = np.full(len(at), BASE + mask + 1, dtype=U64)
    factor = U64(BASE)
    for start, length in MASKS[mask]:
        for k in range(start, start + length):
            acc = acc * factor + values[at + k]
    return mix64(acc)


def _places(offsets: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Document index and start of every ``step``-th window that fits its document."""
    at, doc = [], []
    for d in range(len(offsets) - 1):
        p = np.arange(offsets[d], offsets[d + 1] - SPAN + 1, step)
        at.append(p)
        doc.append(np.full(len(p), d))
    return (np.concatenate(doc).astype(np.int64), np.concatenate(at).astype(np.int64)) if at else (np.empty(0, np.int64),) * 2


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts in text_runs(batches):
        cp, offsets = fold_many(texts)
        values = spread(cp)
        doc, at = _places(offsets, 1)
        keys = np.asarray(ids, dtype=np.int64)
        for mask in range(len(MASKS)):
            h = _seed_hashes(values, at, mask)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(h)), pa.array(keys[doc]), pa.array((at - offsets[doc]).astype(np.int32))],
                ["h", "item_id", "item_pos"],
            )


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts in text_runs(batches):
        cp, offsets = fold_many(texts)
        raw = cp.tobytes()
        out = [raw[4 * a : 4 * b].decode("utf-32-le", "surrogatepass") for a, b in zip(offsets, offsets[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out)], ["item_id", "item_text"])


def _prober(bloom):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bloom.value
        last_bit = U64(8 * len(table) - 1)

        def there(h: np.ndarray) -> np.ndarray:
            at = (h & last_bit).astype(np.int64)
            return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0

        for ids, texts in text_runs(batches):
            cp, offsets = fold_many(texts)
            values = spread(cp)
            doc, at = _places(offsets, STEP)
            keys = np.asarray(ids, dtype=np.int64)
            for mask in range(len(MASKS)):
                h = _seed_hashes(values, at, mask)
                hit = np.flatnonzero(there(h))
                hit = hit[there(h[hit] >> U64(SECOND))]
                if not len(hit):
                    continue
                d, p = doc[hit], at[hit]
                lo = np.maximum(offsets[d], p - CONTEXT)
                hi = np.minimum(offsets[d + 1], p + SPAN + CONTEXT)
                around = [cp[a:b].tobytes().decode("utf-32-le", "surrogatepass") for a, b in zip(lo, hi)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(h[hit])),
                        pa.array(keys[d]),
                        pa.array((p - offsets[d]).astype(np.int64)),
                        pa.array((p - lo).astype(np.int32)),
                        pa.array(around),
                    ],
                    ["h", "doc_id", "doc_pos", "at", "around"],
                )

    return run


def _extend(same: np.ndarray) -> int:
    """How far to go along ``same``: the place of the best score before it drops off."""
    if not len(same):
        return 0
    score = np.cumsum(np.where(same, 1, -COST))
    best = np.maximum.accumulate(score)
    fallen = np.flatnonzero((best - score > DROP) | (score < -DROP))
    stop = fallen[0] if len(fallen) else len(score)
    if not stop:
        return 0
    k = int(np.argmax(score[:stop]))
    return k + 1 if score[k] > 0 else 0


def _longest(same: np.ndarray) -> int:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(np.int8), [0]])))
    return int((edge[1::2] - edge[::2]).max()) if len(edge) else 0


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["item_id", "doc_id", "item_pos", "doc_pos", "at", "around", "item_text"]
    for batch in batches:
        rows = []
        for item, doc, ipos, dpos, at, around, text in zip(*(batch.column(n).to_pylist() for n in names)):
            a, b = points(around), points(text)
            left = min(at, ipos)
            right = min(len(a) - at, len(b) - ipos)
            same = a[at - left : at + right] == b[ipos - left : ipos + right]
            grown_left = _extend(same[:left][::-1])
            grown_right = _extend(same[left + SPAN :])
            lo, hi = left - grown_left, left + SPAN + grown_right
            wrong = (np.flatnonzero(~same[lo:hi]) + (dpos - left + lo)).tolist()
            rows.append((item, doc, dpos - left + lo, hi - lo, len(wrong), _longest(same), dpos - ipos, wrong))
        if rows:
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), *(pa.array(c, pa.int64()) for c in cols[2:7]), pa.array(cols[7], pa.list_(pa.int64()))],
                ["item_id", "doc_id", "start", "length", "substitutions", "exact_run", "diagonal", "wrong"],
            )


VERIFIED = "item_id long, doc_id long, start long, length long, substitutions long, exact_run long, diagonal long, wrong array<long>"
STRETCH = "item_id long, doc_id long, length long, substitutions long, exact_run long"


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hits of each item, document and diagonal, and what those that overlap or touch make together."""
    for batch in batches:
        rows = []
        for item, doc, hits in zip(*(batch.column(n).to_pylist() for n in ("item_id", "doc_id", "hits"))):
            hits.sort(key=lambda x: x["start"])
            whole: list[tuple[int, int, set[int]]] = []
            for x in hits:
                lo, hi = x["start"], x["start"] + x["length"]
                rows.append((item, doc, x["length"], len(x["wrong"]), x["exact_run"]))
                if whole and lo <= whole[-1][1]:
                    whole[-1][2].update(x["wrong"])
                    whole[-1] = (whole[-1][0], max(whole[-1][1], hi), whole[-1][2])
                else:
                    whole.append((lo, hi, set(x["wrong"])))
            for lo, hi, wrong in whole:
                at = [lo - 1, *sorted(wrong), hi]
                rows.append((item, doc, hi - lo, len(wrong), max(b - a - 1 for a, b in zip(at, at[1:]))))
        cols = list(zip(*rows)) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], [f.split()[0] for f in STRETCH.split(", ")])


def overlaps(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Verified overlaps, one row per hit: item_id, doc_id, start and length in N(documents.text),
    substitutions within, exact_run (the longest run of equal characters along the alignment),
    diagonal (position in the document less that in the item), wrong (where the substitutions are).
    A hit is followed for ``CONTEXT`` characters on either side.

    Null and blank texts and items shorter than a seed take no part; an empty table on either
    side gives no rows; repeated rows repeat hits only.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    seeds = materialize(items.mapInArrow(_item_seeds, "h long, item_id long, item_pos int").distinct(), "seeds")
    bloom = documents.sparkSession.sparkContext.broadcast(_bloom(seeds))
    probes = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _prober(bloom), "h long, doc_id long, doc_pos long, at int, around string"
    )
    folded = items.mapInArrow(_folded, "item_id long, item_text string").dropDuplicates(["item_id"])
    hits = probes.join(seeds, "h").dropDuplicates(["doc_id", "doc_pos", "item_id", "item_pos"]).join(folded, "item_id")
    return hits.select("item_id", "doc_id", "item_pos", "doc_pos", "at", "around", "item_text").mapInArrow(_verify, VERIFIED)


def _bloom(seeds: DataFrame) -> np.ndarray:
    """The bitmap as bytes.  Spark sets the bits; at most ``MOST_BITS / 64`` words come back."""
    n = seeds.count()
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * n - 1).bit_length() if n else LEAST_BITS))
    both = seeds.select(F.explode(F.array("h", F.shiftrightunsigned("h", SECOND))).alias("h"))
    words = (
        both.select(
            F.expr(f"cast(shiftright(h & {bits - 1}L, 6) as int)").alias("w"),
            F.expr("shiftleft(1L, cast(h & 63L as int))").alias("b"),
        )
        .groupBy("w")
        .agg(F.bit_or("b").alias("b"))
        .toPandas()
    )
    table = np.zeros(bits // 64, dtype=np.int64)
    table[words["w"].to_numpy(dtype=np.int64)] = words["b"].to_numpy(dtype=np.int64)
    return table.view(np.uint8)


def leaked(documents: DataFrame, benchmark: DataFrame, run: int = SPAN + STEP - 1) -> DataFrame:
    """``(item_id, doc_id)``: some run of at least ``run`` characters of N(item) is in N(document)."""
    if run < SPAN + STEP - 1:
        raise ValueError(f"runs under {SPAN + STEP - 1} characters may hold no seed")
    return overlaps(documents, benchmark).where(F.col("exact_run") >= run).select("item_id", "doc_id").distinct()


def leak_report(documents: DataFrame, benchmark: DataFrame, least: int = 40, tolerated: float = 0.1) -> DataFrame:
    """Per item and document the best overlap with substitutions tolerated: the length of the
    longest one, its substitutions and its share of the item.  Hits along one diagonal that overlap
    count as one.
    """
    hits = overlaps(documents, benchmark).groupBy("item_id", "doc_id", "diagonal").agg(F.collect_set(F.struct("start", "length", "exact_run", "wrong")).alias("hits"))
    good = hits.select("item_id", "doc_id", "hits").mapInArrow(_merged, STRETCH).where((F.col("length") >= least) & (F.col("substitutions") <= tolerated * F.col("length")))
    size = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(_folded, "item_id long, item_text string")
    size = size.dropDuplicates(["item_id"]).select("item_id", F.length("item_text").cast("long").alias("item_length"))
    best = good.groupBy("item_id", "doc_id").agg(
        F.max(F.struct("length", (-F.col("substitutions")).alias("s"))).alias("m"), F.max("exact_run").alias("exact_run")
    )
    return best.join(size, "item_id").select(
        "item_id", "doc_id", F.col("m.length").alias("length"), (-F.col("m.s")).alias("substitutions"), "exact_run", "item_length",
        F.round(F.least(F.lit(1.0), F.col("m.length") / F.col("item_length")), 4).alias("item_share"),
    )
