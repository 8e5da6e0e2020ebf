"""Near-duplicate records with small edits: bit-sliced comparison of one-bit sketches.

A document is the set of the distinct 24-character runs of N(text); documents are alike from a
Jaccard similarity of 0.5 (both are parameters).

1. Documents of equal N(text) collapse to the smallest id before anything is compared.
2. One pass over the text gives a sketch of 512 one-bit minima (one-permutation hashing, empty
   bins filled by rotation) and 32 bucket keys of two minima each.  A pair at the threshold shares
   none of its keys with probability 0.75^32 = 1e-4, at 0.6 with 6e-7.
3. Within a bucket sketches are compared bit-sliced: 64 pairs to a word, one bit plane after the
   other through carry-save adders into vertical counters; words whose lanes are all beyond the
   radius are dropped.  Buckets over ``TILE`` rows are cut into blocks that meet in pairs of
   blocks; in a big block pivots are compared first, and rows already linked not again.
4. The estimate decides where it is more than five standard errors from the threshold.  Pairs
   nearer to it, between documents not yet linked, are decided by their exact run sets.
5. Links become groups by connected components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..session import checkpoint, materialize
from .kernel import BASE, U64, fold_many, inside, mix64, owner, points, signed, spread, text_runs, window_hashes

RUN, THRESHOLD = 24, 0.5
BITS, KEYS, ROWS = 512, 32, 2
TILE, SMALL = 4096, 48
LANES = 1 << 16
NONE = U64(2**64 - 1)
SKETCH = "doc_id long, k1 long, k2 long, n int, keys array<long>, sketch binary"


def _filled(m: np.ndarray) -> np.ndarray:
    """Empty bins take the next filled bin's minimum, made different by the distance."""
    bins = m.shape[1]
    there = np.concatenate([m != NONE] * 2, axis=1)
    at = np.where(there, np.arange(2 * bins, dtype=np.int32), np.int32(4 * bins))
    at = np.minimum.accumulate(at[:, ::-1], axis=1)[:, ::-1][:, :bins]
    away = at - np.arange(bins, dtype=np.int32)
    value = np.take_along_axis(m, at % bins, axis=1)
    return np.where(away > 0, mix64(value + away.astype(U64) * U64(BASE)), value)


def _minima(h: np.ndarray, row: np.ndarray, rows: int, bins: int) -> np.ndarray:
    m = np.full(rows * bins, NONE, dtype=U64)
    np.minimum.at(m, row * bins + (h & U64(bins - 1)).astype(np.int64), h >> U64(16))
    return _filled(m.reshape(rows, bins))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts in text_runs(batches):
        cp, offsets = fold_many(texts)
        sizes = np.diff(offsets)
        enough = np.flatnonzero(sizes >= RUN)
        if not len(enough):
            continue
        h = window_hashes(spread(cp), RUN)
        ok = inside(offsets, RUN)
        at = np.full(len(texts), -1)
        at[enough] = np.arange(len(enough))
        row = at[owner(offsets)[: len(h)][ok]]
        h = mix64(h[ok])
        keys = _minima(mix64(h ^ U64(BASE)), row, len(enough), KEYS * ROWS)
        band = np.arange(KEYS, dtype=U64)[None, :]
        joined = mix64(keys[:, 0::2] * U64(3) + band)
        for r in range(1, ROWS):
            joined = mix64(joined + keys[:, r::ROWS])
        bits = mix64(_minima(h, row, len(enough), BITS)) & U64(1)
        packed = np.packbits(bits.astype(np.uint8), axis=1)
        digests = [hashlib.blake2b(cp[offsets[d] : offsets[d + 1]].tobytes(), digest_size=16).digest() for d in enough]
        whole = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.asarray(ids, dtype=np.int64)[enough]),
                pa.array(np.ascontiguousarray(whole[:, 0])),
                pa.array(np.ascontiguousarray(whole[:, 1])),
                pa.array((sizes[enough] - RUN + 1).astype(np.int32)),
                pa.ListArray.from_arrays(
                    pa.array(np.arange(len(enough) + 1, dtype=np.int32) * KEYS), pa.array(signed(joined.ravel()))
                ),
                pa.array([p.tobytes() for p in packed], pa.binary()),
            ],
            ["doc_id", "k1", "k2", "n", "keys", "sketch"],
        )


# -- bit-sliced distances ---------------------------------------------------------------------


def _planes(xored: np.ndarray) -> np.ndarray:
    """(64 planes, words): bit ``j`` of the 8 bytes of every lane, 64 lanes to a word."""
    bits = np.unpackbits(xored, axis=1)
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(U64)


def _carry_save(levels: list[list[np.ndarray]]) -> None:
    """Full adders until every weight has at most one plane; ``levels[w]`` counts 2**w."""
    w = 0
    while w < len(levels):
        level = levels[w]
        while len(level) >= 3:
            a, b, c = level.pop(), level.pop(), level.pop()
            u = a ^ b
            level.append(u ^ c)
            if w + 1 == len(levels):
                levels.append([])
            levels[w + 1].append((a & b) | (u & c))
        if len(level) == 2:
            a, b = level.pop(), level.pop()
            level.append(a ^ b)
            if w + 1 == len(levels):
                levels.append([])
            levels[w + 1].append(a & b)
        w += 1


def _beyond(levels: list[list[np.ndarray]], radius: int, words: int) -> np.ndarray:
    """Lanes whose counter is greater than ``radius``, as words."""
    over = np.zeros(words, dtype=U64)
    tied = np.full(words, NONE, dtype=U64)
    for w in range(max(len(levels), radius.bit_length()) - 1, -1, -1):
        plane = levels[w][0] if w < len(levels) and levels[w] else np.zeros(words, dtype=U64)
        if radius >> w & 1:
            tied &= plane
        else:
            over |= tied & plane
            tied &= ~plane
    return over


def distances(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Lanes whose sketches differ in at most ``radius`` bits, and their distances.

    ``left`` and ``right`` are (lanes, bytes) arrays.  Planes are laid out 64 at a time; after
    each 64 the words whose 64 lanes are all beyond the radius are given up.
    """
    lanes, width = left.shape
    pad = -lanes % 64
    xored = left ^ right
    if pad:
        xored = np.concatenate([xored, np.full((pad, width), 255, dtype=np.uint8)])
    alive = np.arange(len(xored) // 64)
    levels: list[list[np.ndarray]] = [[]]
    for col in range(0, width, 8):
        lanes_now = xored if len(alive) * 64 == len(xored) else xored.reshape(-1, 64, width)[alive].reshape(-1, width)
        levels[0].extend(_planes(np.ascontiguousarray(lanes_now[:, col : col + 8])))
        _carry_save(levels)
        if (col + 8) * 8 > radius:
            over = _beyond(levels, radius, len(alive))
            keep = np.flatnonzero(over != NONE)
            if len(keep) < len(alive):
                alive = alive[keep]
                levels = [[p[keep] for p in level] for level in levels]
            if not len(alive):
                return np.empty(0, np.int64), np.empty(0, np.int64)
    count = np.zeros(len(alive) * 64, dtype=np.int64)
    for w, level in enumerate(levels):
        for plane in level:
            count += np.unpackbits(plane.view(np.uint8), bitorder="little").astype(np.int64) << w
    lane = (alive[:, None] * 64 + np.arange(64)).ravel()
    good = (count <= radius) & (lane < lanes)
    return lane[good], count[good]


def _margin(n: np.ndarray) -> np.ndarray:
    """Five standard errors of the estimate for documents of ``n`` runs."""
    return np.minimum(0.38, 5 * np.sqrt(0.75 / BITS + 0.25 / np.maximum(n, 1)))


RADIUS = int(BITS * (1 - (1 + THRESHOLD - 0.38) / 2))
LINK = "src long, dst long, sure boolean"


class _Bucket:
    """Compares the rows of one bucket or pair of blocks; keeps links found."""

    def __init__(self) -> None:
        self.src: list[np.ndarray] = []
        self.dst: list[np.ndarray] = []
        self.sure: list[np.ndarray] = []

    def judge(self, ids, n, sketch, ia, ib) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found_a, found_b, found_sure = [], [], []
        for lo in range(0, len(ia), LANES):
            a, b = ia[lo : lo + LANES], ib[lo : lo + LANES]
            lane, dist = distances(sketch[a], sketch[b], RADIUS)
            a, b = a[lane], b[lane]
            like = 1 - 2 * dist / BITS
            margin = _margin(np.minimum(n[a], n[b]))
            keep = like >= THRESHOLD - margin
            found_a.append(a[keep])
            found_b.append(b[keep])
            found_sure.append((like >= THRESHOLD + margin)[keep])
        a, b, sure = np.concatenate(found_a), np.concatenate(found_b), np.concatenate(found_sure)
        return a, b, sure

    def add(self, ids, a, b, sure) -> None:
        self.src.append(np.minimum(ids[a], ids[b]))
        self.dst.append(np.maximum(ids[a], ids[b]))
        self.sure.append(sure)

    def big(self, ids, n, sketch, side) -> None:
        """Pivots against all rows not linked to them yet; ``side`` forbids pairs of one side if two."""
        count = len(ids)
        label = np.arange(count)
        two = len(np.unique(side)) > 1
        order = np.arange(count)
        if two:  # take turns, so that the first pivots of either side come early
            order = np.argsort(np.concatenate([np.arange((side == s).sum()) for s in np.unique(side)])[np.argsort(np.argsort(side, kind="stable"), kind="stable")], kind="stable")
        done = np.zeros(count, dtype=bool)
        open_a, open_b = [], []
        at, step = 0, 1
        while at < count:
            pivots = order[at : at + step]
            others = np.flatnonzero(~done)
            ia = np.repeat(pivots, len(others))
            ib = np.tile(others, len(pivots))
            ok = (label[ia] != label[ib]) & ((side[ia] != side[ib]) if two else True)
            rank = np.empty(count, dtype=np.int64)
            rank[order] = np.arange(count)
            ok &= ~(np.isin(ib, pivots) & (rank[ib] <= rank[ia]))
            if ok.any():
                a, b, sure = self.judge(ids, n, sketch, ia[ok], ib[ok])
                for x, y in zip(a[sure], b[sure]):
                    if label[x] != label[y]:
                        self.add(ids, np.array([x]), np.array([y]), np.array([True]))
                        lo, hi = sorted((label[x], label[y]))
                        label[label == hi] = lo
                open_a.append(a[~sure])
                open_b.append(b[~sure])
            done[pivots] = True
            at += len(pivots)
            step = 1 if at < 4 else 16
            rest = label[~done]
            if len(rest) == 0 or (label == label[0]).all():
                break
        if open_a:
            a, b = np.concatenate(open_a), np.concatenate(open_b)
            apart = label[a] != label[b]
            self.add(ids, a[apart], b[apart], np.zeros(int(apart.sum()), dtype=bool))

    def links(self) -> Iterator[pa.RecordBatch]:
        if self.src:
            rows = np.unique(np.stack([np.concatenate(self.src), np.concatenate(self.dst), np.concatenate(self.sure).astype(np.int64)], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(rows[:, 0])), pa.array(np.ascontiguousarray(rows[:, 1])), pa.array(rows[:, 2].astype(bool))],
                ["src", "dst", "sure"],
            )
        self.__init__()


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (key, tile); every bucket is complete before it is compared."""
    bucket = _Bucket()
    held: list[tuple] = []

    def columns(batch: pa.RecordBatch) -> tuple:
        sketch = np.frombuffer(b"".join(batch.column(5).to_pylist()), dtype=np.uint8).reshape(-1, BITS // 8)
        return (*(batch.column(c).to_numpy(zero_copy_only=False) for c in range(5)), sketch)

    def flush(parts: list[tuple]) -> None:
        key, tile, side, ids, n, sketch = (np.concatenate(x) for x in zip(*parts))
        new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (tile[1:] != tile[:-1])]))
        ends = np.append(new[1:], len(key))
        small_a, small_b = [], []
        for lo, hi in zip(new, ends):
            size = hi - lo
            if size < 2:
                continue
            if size <= SMALL:
                a, b = _upper(size)
                if side[lo] == side[hi - 1] and (side[lo:hi] == side[lo]).all():
                    small_a.append(a + lo)
                    small_b.append(b + lo)
                else:
                    cross = side[lo:hi][a] != side[lo:hi][b]
                    small_a.append(a[cross] + lo)
                    small_b.append(b[cross] + lo)
            else:
                bucket.big(ids[lo:hi], n[lo:hi], sketch[lo:hi], side[lo:hi])
        if small_a:
            a, b = np.concatenate(small_a), np.concatenate(small_b)
            if len(a):
                bucket.add(ids, *bucket.judge(ids, n, sketch, a, b))

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = columns(batch)
        key, tile = cols[0], cols[1]
        last = np.flatnonzero((key != key[-1]) | (tile != tile[-1]))
        cut = last[-1] + 1 if len(last) else 0
        if cut:
            held.append(tuple(c[:cut] for c in cols))
            flush(held)
            yield from bucket.links()
            held = []
        elif held and (held[-1][0][-1] != key[0] or held[-1][1][-1] != tile[0]):
            flush(held)
            held = []
        held.append(tuple(c[cut:] for c in cols))
    if held:
        flush(held)
        yield from bucket.links()


_UPPER: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _upper(size: int) -> tuple[np.ndarray, np.ndarray]:
    if size not in _UPPER:
        _UPPER[size] = np.triu_indices(size, 1)
    return _UPPER[size]


# -- exact decision of the pairs near the threshold ------------------------------------------------


def _fold_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts in text_runs(batches):
        cp, offsets = fold_many(texts)
        raw = cp.tobytes()
        out = [raw[4 * a : 4 * b].decode("utf-32-le", "surrogatepass") for a, b in zip(offsets, offsets[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out)], ["id", "folded"])


def _runs(text: str) -> np.ndarray:
    return np.unique(window_hashes(spread(points(text)), RUN))


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        src, dst, left, right = (batch.column(c).to_pylist() for c in ("src", "dst", "left", "right"))
        keep = []
        last, runs = None, None
        for k, (a, b) in enumerate(zip(left, right)):
            if a != last:
                last, runs = a, _runs(a)
            other = _runs(b)
            common = len(np.intersect1d(runs, other, assume_unique=True))
            if 2 * common >= len(runs) + len(other) - common:
                keep.append(k)
        yield pa.RecordBatch.from_arrays(
            [pa.array([src[k] for k in keep], pa.int64()), pa.array([dst[k] for k in keep], pa.int64())], ["src", "dst"]
        )


def groups(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, class_id)`` for every document with at least one run.

    ``class_id`` is the smallest id among the documents alike with it directly or by way of
    others.  Documents with a null text or under 24 letters and digits do not appear; a repeated
    row counts once; an empty table gives no rows; further columns play no part.
    """
    base = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketched = materialize(base.mapInArrow(_sketches, SKETCH), "sketches")
    reps = sketched.groupBy("k1", "k2").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch")
    )
    reps = materialize(reps, "representatives")
    rows = reps.select(F.explode("keys").alias("key"), F.col("rep").alias("doc"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = rows.join(shared, "key").join(reps.select(F.col("rep").alias("doc"), "n", "sketch"), "doc")
    blocks = F.ceil(F.col("size") / TILE).cast("int")
    block = F.when(blocks > 1, F.pmod(F.xxhash64("doc"), blocks)).otherwise(0).cast("int")
    tiles = F.when(
        blocks > 1,
        F.transform(F.sequence(F.lit(0), blocks - 1), lambda x: F.least(x, block) * F.lit(1 << 15) + F.greatest(x, block)),
    ).otherwise(F.array(F.lit(0)))
    laid = members.select("key", F.explode(tiles).alias("tile"), block.alias("side"), "doc", "n", "sketch")
    links = checkpoint(
        laid.repartition("key", "tile").sortWithinPartitions("key", "tile", "doc").mapInArrow(_compare, LINK).distinct()
    )
    first = checkpoint(connected_components(links.where("sure")))
    a = first.select(F.col("node").alias("src"), F.col("component").alias("ca"))
    b = first.select(F.col("node").alias("dst"), F.col("component").alias("cb"))
    doubtful = (
        links.where("not sure")
        .join(a, "src", "left")
        .join(b, "dst", "left")
        .select("src", "dst", F.coalesce("ca", "src").alias("ca"), F.coalesce("cb", "dst").alias("cb"))
        .where("ca <> cb")
    )
    doubtful = checkpoint(doubtful)
    needed = doubtful.select(F.col("src").alias("doc_id")).union(doubtful.select("dst")).distinct()
    texts = base.join(needed, "doc_id", "left_semi").mapInArrow(_fold_text, "id long, folded string").dropDuplicates(["id"])
    verified = (
        doubtful.select("src", "dst")
        .join(texts.select(F.col("id").alias("src"), F.col("folded").alias("left")), "src")
        .join(texts.select(F.col("id").alias("dst"), F.col("folded").alias("right")), "dst")
        .mapInArrow(_exact, "src long, dst long")
    )
    between = doubtful.join(verified, ["src", "dst"], "left_semi").select("ca", "cb").distinct()
    second = connected_components(between, "ca", "cb").select(F.col("node").alias("class0"), F.col("component").alias("class1"))
    ids = sketched.select("doc_id", "k1", "k2").join(reps.select("k1", "k2", "rep"), ["k1", "k2"])
    return (
        ids.join(first.select(F.col("node").alias("rep"), F.col("component").alias("class0")), "rep", "left")
        .withColumn("class0", F.coalesce("class0", "rep"))
        .join(second, "class0", "left")
        .select("doc_id", F.coalesce("class1", "class0").alias("class_id"))
        .distinct()
    )


def members(documents: DataFrame) -> DataFrame:
    """``(first_id, doc_id)``: every document of a group but its smallest id."""
    return groups(documents).where("doc_id <> class_id").select(F.col("class_id").alias("first_id"), "doc_id")
