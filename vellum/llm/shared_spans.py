"""Long exact spans shared between records: a De Bruijn graph of text tokens, compacted by joins.

The exact question is which windows of ``SPAN`` characters occur in another document; marking all
of them one by one would shuffle a row per character.  Instead:

1. **Tokens.**  In every window of ``SPAN`` characters the ``GRAM``-character run of least hash is
   an anchor (window minimizers, leftmost on ties), so equal windows have equal anchors and every
   window holds one.  The text from an anchor through the next one is a token; two anchors and the
   token between them are an edge of the graph, whose nodes are the anchors.
2. **Compaction.**  Grouping the occurrences of each node over all documents gives the repeated
   nodes, and whether all occurrences leave by the same edge and come by the same edge.  Joined
   back to the sources (those that a bitmap of repeated nodes lets through), runs of such nodes are nonbranching paths: whoever holds one of their
   nodes holds the whole path, so a window that its own anchor's path covers is shared and needs
   no comparison.  The path of an anchor is the same in every document, so all holders of such a
   window leave it out of the comparison alike.
3. **Verification.**  What is left are windows that reach beyond the path of their own anchor
   although that is repeated (without that they cannot be shared).  They are compared in full by
   their source coordinates: grouped by their own anchor, or, where an anchor is held by very many
   rows, as single window hashes in a plain aggregation.
4. The windows' union per document is the result.

Window equality is that of 64-bit polynomial hashes of the whole windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.kernels import Bitmap, bitmap_of
from ..session import materialize
from .kernel import BASE, U64, inside, mix64, raw_many, signed, sliding_min, spread, text_runs

#: A long anchor is seldom repeated where the window around it is not, a short one makes fewer anchors.
SPAN, GRAM = 200, 64
WINDOW = SPAN - GRAM + 1
#: Occurrences from which a node's windows are compared by aggregation instead of in one task.
HOT = 20_000
ROWS = 4_000_000
OCCURRENCE = "g long, doc_id long, pos int, coming long, leaving long"
WORK = "kind int, g long, doc_id long, lo int, hi int, piece string"
_INVERSE = pow(BASE, -1, 1 << 64)


@lru_cache(4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n + 1, U64(BASE), dtype=U64)
    down = np.full(n + 1, U64(_INVERSE), dtype=U64)
    up[0] = down[0] = U64(1)
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class _Laid:
    """Documents laid end to end with hashes of any of their substrings."""

    def __init__(self, texts: list[str]) -> None:
        self.cp, self.offsets = raw_many(texts)
        n = len(self.cp)
        size = 1 << max(18, n.bit_length())
        up, down = _powers(size)
        self.down = down
        self.sums = np.concatenate([np.zeros(1, U64), np.cumsum(spread(self.cp) * up[:n])])

    def windows(self, n: int) -> np.ndarray:
        m = len(self.cp) - n + 1
        return mix64((self.sums[n:] - self.sums[:m]) * self.down[:m]) if m > 0 else np.empty(0, U64)

    def pieces(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix64((self.sums[b] - self.sums[a]) * self.down[a] + (b - a).astype(U64))


def _anchors(laid: _Laid) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the windows that stay in a document, each one's anchor, and the hashes of all grams."""
    grams = laid.windows(GRAM)
    if len(laid.cp) < SPAN:
        return np.empty(0, np.int64), np.empty(0, np.int64), grams
    ranked = (grams & U64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=U64)
    least = sliding_min(ranked, WINDOW)
    x = np.flatnonzero(inside(laid.offsets, SPAN))
    return x, (least[x] & U64(0xFFFFFFFF)).astype(np.int64), grams


def _anchor_table(laid: _Laid, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct anchors in order, and the document of each."""
    at = anchor[np.concatenate([[True], anchor[1:] != anchor[:-1]])] if len(anchor) else anchor
    return at, np.searchsorted(laid.offsets, at, side="right") - 1


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts in text_runs(batches):
        laid = _Laid(texts)
        _, anchor, grams = _anchors(laid)
        at, doc = _anchor_table(laid, anchor)
        if not len(at):
            continue
        begin, end = laid.offsets[doc], laid.offsets[doc + 1]
        first = np.concatenate([[True], doc[1:] != doc[:-1]])
        last = np.concatenate([doc[1:] != doc[:-1], [True]])
        before = np.where(first, begin, np.concatenate([[0], at[:-1]]))
        after = np.where(last, end, np.concatenate([at[1:], [0]]) + GRAM)
        coming = laid.pieces(before, at + GRAM) ^ np.where(first, U64(BASE), U64(0))
        leaving = laid.pieces(at, after) ^ np.where(last, U64(BASE), U64(0))
        keys = np.asarray(ids, dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(signed(grams[at])),
                pa.array(keys[doc]),
                pa.array((at - begin).astype(np.int32)),
                pa.array(signed(coming)),
                pa.array(signed(leaving)),
            ],
            ["g", "doc_id", "pos", "coming", "leaving"],
        )


def _held(table):
    """Documents with some anchor that the bitmap of repeated nodes may hold, and these anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = Bitmap(table.value)
        for ids, texts in text_runs(batches):
            laid = _Laid(texts)
            _, anchor, grams = _anchors(laid)
            at, doc = _anchor_table(laid, anchor)
            hit = bitmap.may_hold(grams[at])
            at, doc = at[hit], doc[hit]
            some = np.unique(doc)
            if not len(some):
                continue
            cuts = np.append(np.searchsorted(doc, some), len(doc)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[d] for d in some], pa.int64()),
                    pa.array([texts[d] for d in some], pa.string()),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(signed(grams[at]))),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array((at - laid.offsets[doc]).astype(np.int32))),
                ],
                ["doc_id", "text", "gs", "at"],
            )

    return run


def _all_up_to(flag: np.ndarray) -> np.ndarray:
    """For each place the last place of the run of true values that it starts, or place - 1."""
    n = len(flag)
    stop = np.where(flag, n, np.arange(n))
    return np.minimum.accumulate(stop[::-1])[::-1] - 1


def _all_from(flag: np.ndarray) -> np.ndarray:
    """For each place the first place of the run of true values that it ends, or place + 1."""
    n = len(flag)
    stop = np.where(flag, -1, np.arange(n))
    return np.maximum.accumulate(stop) + 1


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Direct intervals (kind 0), pieces to compare (1) and window hashes of hot anchors (2)."""
    for batch in batches:
        whole = batch.to_pydict()
        keys_all, texts_all, marks_all = whole["doc_id"], whole["text"], whole["marks"]
        lo = 0
        while lo < len(keys_all):
            hi, held = lo, 0
            while hi < len(keys_all) and (hi == lo or held + len(texts_all[hi]) <= 1 << 18):
                held += len(texts_all[hi])
                hi += 1
            yield from _paths_of(keys_all[lo:hi], texts_all[lo:hi], marks_all[lo:hi])
            lo = hi


def _paths_of(ids, texts, marks) -> Iterator[pa.RecordBatch]:
    laid = _Laid(texts)
    x, anchor, grams = _anchors(laid)
    at, doc = _anchor_table(laid, anchor)
    if not len(at):
        return
    flags = np.zeros(len(at), dtype=np.int8)
    pos = np.concatenate([np.asarray([m["pos"] for m in ms], dtype=np.int64) + laid.offsets[d] for d, ms in enumerate(marks)])
    flag = np.concatenate([np.asarray([m["flag"] for m in ms], dtype=np.int8) for ms in marks])
    flags[np.searchsorted(at, pos)] = flag
    repeated, comes, leaves, hot = (flags & 1) > 0, (flags & 2) > 0, (flags & 4) > 0, (flags & 8) > 0
    s = np.searchsorted(at, x)
    t = np.searchsorted(at, x + WINDOW - 1, side="right") - 1
    keys = np.asarray(ids, dtype=np.int64)
    j = np.searchsorted(at, anchor)
    # the path of the window's own anchor, not of any node in it: other documents may have other
    # nodes at the window's edges, and would then seek partners that withheld it
    direct = (_all_from(leaves)[t] <= j) & (j <= _all_up_to(comes)[s])
    possible = repeated[j] & ~direct

    def runs(mask: np.ndarray, split: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = np.flatnonzero(mask)
        if not len(k):
            return k, k
        new = np.concatenate([[True], (np.diff(x[k]) != 1) | (np.diff(split[k]) != 0)])
        first = np.flatnonzero(new)
        return k[first], k[np.append(first[1:], len(k)) - 1]

    out: list[list] = [[], [], [], [], [], []]

    def put(kind, g, d, a, b, piece) -> None:
        for column, value in zip(out, (kind, g, d, a, b, piece)):
            column.append(value)

    of = np.searchsorted(laid.offsets, x, side="right") - 1
    a, b = runs(direct, of)
    d = of[a]
    n = len(a)
    put(np.zeros(n, np.int32), np.zeros(n, np.int64), keys[d], (x[a] - laid.offsets[d]).astype(np.int32), (x[b] - laid.offsets[d]).astype(np.int32), [None] * n)
    a, b = runs(possible & ~hot[j], j)
    d = of[a]
    n = len(a)
    pieces = [texts[dd][p - o : q - o + SPAN] for dd, o, p, q in zip(d, laid.offsets[d], x[a], x[b])]
    put(np.ones(n, np.int32), signed(grams[anchor[a]]), keys[d], (x[a] - laid.offsets[d]).astype(np.int32), (x[b] - laid.offsets[d]).astype(np.int32), pieces)
    k = np.flatnonzero(possible & hot[j])
    d = of[k]
    n = len(k)
    lo = (x[k] - laid.offsets[d]).astype(np.int32)
    put(np.full(n, 2, np.int32), signed(laid.pieces(x[k], x[k] + SPAN)), keys[d], lo, lo, [None] * n)
    types = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
    arrays = [pa.array(np.concatenate(c), t) for c, t in zip(out[:5], types)]
    yield pa.RecordBatch.from_arrays([*arrays, pa.array(sum(out[5], []), pa.string())], ["kind", "g", "doc_id", "lo", "hi", "piece"])


def _same_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by ``g``; the windows of each anchor are compared together."""
    held: list[pa.RecordBatch] = []
    size = 0

    def compare(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts)
        texts = rows.column("piece").to_pylist()
        keys, lo = rows.column("doc_id").to_numpy(), rows.column("lo").to_numpy()
        hashes, row, at = [], [], []
        start = 0
        while start < len(texts):  # a run at a time, hashes only are kept
            stop, chars = start, 0
            while stop < len(texts) and (stop == start or chars < 1 << 18):
                chars += len(texts[stop])
                stop += 1
            laid = _Laid(texts[start:stop])
            x = np.flatnonzero(inside(laid.offsets, SPAN))
            d = np.searchsorted(laid.offsets, x, side="right") - 1
            hashes.append(laid.windows(SPAN)[x])
            row.append(d + start)
            at.append(x - laid.offsets[d])
            start = stop
        h, r, p = np.concatenate(hashes), np.concatenate(row), np.concatenate(at)
        order = np.argsort(h, kind="stable")
        h, r, p = h[order], r[order], p[order]
        doc = keys[r]
        new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        several = np.maximum.reduceat(doc, new) != np.minimum.reduceat(doc, new)
        keep = np.repeat(several, np.diff(np.append(new, len(h))))
        r, p = r[keep], p[keep]
        if not len(r):
            return
        order = np.lexsort((p, r))
        r, p = r[order], p[order]
        new = np.concatenate([[True], (r[1:] != r[:-1]) | (p[1:] != p[:-1] + 1)])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(r)) - 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[r[first]]), pa.array((lo[r[first]] + p[first]).astype(np.int32)), pa.array((lo[r[last]] + p[last]).astype(np.int32))],
            ["doc_id", "lo", "hi"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        g = batch.column("g").to_numpy()
        if size > ROWS // 200 and held:
            change = np.flatnonzero(g != held[-1].column("g")[held[-1].num_rows - 1].as_py())
            cut = int(change[0]) if len(change) else batch.num_rows
            if cut:
                held.append(batch.slice(0, cut))
            if cut < batch.num_rows or len(change):
                yield from compare(held)
                held, size = [], 0
            batch = batch.slice(cut)
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
    if held:
        yield from compare(held)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            begin = end = None
            for a, b in sorted((s["lo"], s["hi"]) for s in spans):
                if end is not None and a <= end:
                    end = max(end, b + SPAN)
                    continue
                if end is not None:
                    rows.append((doc, begin, end))
                begin, end = a, b + SPAN
            rows.append((doc, begin, end))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int32())],
            ["doc_id", "start_pos", "end_pos"],
        )


def stretches(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """``(doc_id, start_pos, end_pos)``: the unbroken stretches made of windows of 200 characters
    that also occur in another document, 0-based, end exclusive, in code points of the raw text.

    Null texts and texts under 200 characters have none; rows repeated under one id are the same
    document and share nothing with each other; an empty table gives no rows.
    """
    base = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where(
        F.length(text) >= SPAN
    )
    found = base.mapInArrow(_occurrences, OCCURRENCE)
    nodes = (
        found.groupBy("g")
        .agg(
            F.min("doc_id").alias("d0"), F.max("doc_id").alias("d1"),
            F.min("coming").alias("c0"), F.max("coming").alias("c1"),
            F.min("leaving").alias("l0"), F.max("leaving").alias("l1"),
            F.count(F.lit(1)).alias("n"),
        )
        .where("d0 <> d1")
        .select(
            "g",
            F.expr(f"cast(1 + if(c0 = c1, 2, 0) + if(l0 = l1, 4, 0) + if(n > {int(hot)}, 8, 0) as tinyint)").alias("flag"),
        )
    )
    nodes = materialize(nodes, "nodes")
    repeated = documents.sparkSession.sparkContext.broadcast(bitmap_of(nodes, "g"))
    # only documents that may hold a repeated node go on, with their texts and such nodes
    held = materialize(base.mapInArrow(_held(repeated), "doc_id long, text string, gs array<long>, at array<int>"), "held")
    marks = (
        held.select("doc_id", F.explode(F.arrays_zip("gs", "at")).alias("x")).select(F.col("x.gs").alias("g"), "doc_id", F.col("x.at").alias("pos"))
        .join(nodes, "g").groupBy("doc_id").agg(F.collect_set(F.struct("pos", "flag")).alias("marks"))
    )
    work = materialize(
        held.select("doc_id", "text").join(marks, "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "text", "marks").mapInArrow(_paths, WORK), "paths"
    )
    direct = work.where("kind = 0").select("doc_id", "lo", "hi")
    compared = (
        work.where("kind = 1").select("g", "doc_id", "lo", "piece").repartition("g").sortWithinPartitions("g")
        .mapInArrow(_same_windows, "doc_id long, lo int, hi int")
    )
    single = work.where("kind = 2").select("g", "doc_id", "lo", "hi")
    common = single.groupBy("g").agg(F.min("doc_id").alias("d0"), F.max("doc_id").alias("d1")).where("d0 <> d1").select("g")
    counted = single.join(common, "g", "left_semi").select("doc_id", "lo", "hi")
    spans = direct.unionByName(compared).unionByName(counted)
    return spans.groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")).mapInArrow(
        _merge, "doc_id long, start_pos int, end_pos int"
    )


def coverage(documents: DataFrame) -> DataFrame:
    """Per document: length, number of shared stretches, characters they cover and their share."""
    per = stretches(documents).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("stretches"), F.sum(F.col("end_pos") - F.col("start_pos")).alias("shared_chars")
    )
    zero = F.lit(0).cast("long")
    length = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.length("text").cast("long").alias("chars")).where("chars is not null")
    return length.dropDuplicates(["doc_id"]).join(per, "doc_id", "left").select(
        "doc_id", "chars", F.coalesce("stretches", zero).alias("stretches"), F.coalesce("shared_chars", zero).alias("shared_chars"),
        F.when(F.col("chars") > 0, F.round(F.coalesce("shared_chars", zero) / F.col("chars"), 6)).otherwise(0.0).alias("shared_share"),
    )
