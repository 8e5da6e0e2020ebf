"""Repetition inside a single document: a learned decision list over cheap statistics.

One pass computes a few statistics of every text, over all of its short runs.  On a bounded sample
of documents the exact repeated share is computed as the label, and a decision list is learned from
it by sequential covering: rules are conjunctions of thresholds, grown on one part of the sample and
pruned on the other, for the clean class and for the repeating one.  The list is emitted as one
ordered Spark ``CASE`` expression with the verdicts ``clean``, ``repeating`` and ``unsure``.

The first two decide.  Two of the statistics are bounds of the repeated share: ``dup_short`` is at
least ``least_dup`` where the share is reached, and ``dup_long`` never passes the share.  A verdict
holds only on its side of these, so the list decides as the exact share would; what it leaves
unsure, or is beyond the bounds, has its exact share computed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kernel import BASE, U64, fold_many, inside, mix64, owner, spread, text_runs, window_hashes

RUN, SHARE = 30, 0.3
#: Length of the short runs of the statistics.
SHORT = 12
#: Where pieces of text end for the share of repeated pieces.
STOPS = (".", "!", "?", "\n", "。", "！", "？", "।", "؟")
#: Documents that the list is learned from, at most, and how far its thresholds keep from the other class.
SAMPLE, SLACK = 4000, 0.1
FEATURES = ("n", "dup_short", "top_short", "dup_long", "dup_line", "dup_piece", "digit_share")
STATS = "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES)


def _repeated_in_order(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the value has occurred before in the same document."""
    order = np.lexsort((np.arange(len(h)), h, doc))
    again = np.zeros(len(h), dtype=bool)
    d, v = doc[order], h[order]
    again[order[1:]] = (d[1:] == d[:-1]) & (v[1:] == v[:-1])
    return again


def repeated_shares(cp: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per document the number of characters in some run of ``RUN`` that has begun before."""
    n_docs = len(offsets) - 1
    if len(cp) < RUN:
        return np.zeros(n_docs, dtype=np.int64)
    h = window_hashes(spread(cp), RUN)
    doc = owner(offsets)
    start = np.flatnonzero(inside(offsets, RUN))
    own = doc[start]
    key = mix64(h[start] + own.astype(U64) * U64(BASE))  # one sort for all documents of the run
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    later = start[order[1:][same]]
    edge = np.zeros(len(cp) + 1, dtype=np.int32)
    np.add.at(edge, later, 1)
    np.add.at(edge, later + RUN, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(doc[covered], minlength=n_docs)


def _pieces_share(text: str, marks: tuple[str, ...]) -> float:
    """Characters of later copies of the pieces between ``marks``, over all."""
    for m in marks[1:]:
        text = text.replace(m, marks[0])
    seen, again, total = set(), 0, 0
    for piece in text.split(marks[0]):
        piece = piece.strip()
        if not piece:
            continue
        total += len(piece)
        if piece in seen:
            again += len(piece)
        else:
            seen.add(piece)
    return again / total if total else 0.0


def _long_blocks(cp: np.ndarray, offsets: np.ndarray, block: int = 2 * RUN) -> np.ndarray:
    """Per document the characters in whole blocks that have begun before, from any place.

    The blocks lie end to end, so this counts some of the repeated characters and none twice.
    """
    n_docs = len(offsets) - 1
    if len(cp) < block:
        return np.zeros(n_docs, dtype=np.int64)
    own = owner(offsets)
    start = np.flatnonzero(inside(offsets, block))
    doc = own[start]
    key = mix64(mix64(window_hashes(spread(cp), block)[start]) + doc.astype(U64) * U64(BASE))
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(start), dtype=bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    laid = (start - offsets[doc]) % block == 0
    return block * np.bincount(doc[again & laid], minlength=n_docs)


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts in text_runs(batches):
        cp, offsets = fold_many(texts)
        n = np.diff(offsets)
        long = _long_blocks(cp, offsets) / np.maximum(1, n)
        dup = np.zeros(len(ids))
        top = np.zeros(len(ids))
        if len(cp) >= SHORT:
            h = mix64(window_hashes(spread(cp), SHORT))
            at = np.flatnonzero(inside(offsets, SHORT))
            doc = owner(offsets)[at]
            key = mix64(h[at] + doc.astype(U64) * U64(BASE))
            order = np.argsort(key, kind="stable")
            new = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0])) if len(at) else np.empty(0, np.int64)
            size = np.diff(np.append(new, len(at)))
            d = doc[order[new]] if len(at) else np.empty(0, np.int64)
            total = np.maximum(1, np.bincount(doc, minlength=len(ids)))
            dup = np.bincount(d, weights=np.where(size > 1, size - 1, 0), minlength=len(ids)) / total
            np.maximum.at(top, d, size)
            top = np.where(top > 1, top / total, 0.0)
        digit = np.bincount(owner(offsets)[(cp >= 48) & (cp <= 57)], minlength=len(ids)) / np.maximum(1, n) if len(cp) else np.zeros(len(ids))
        line = [_pieces_share(t, ("\n",)) for t in texts]
        piece = [_pieces_share(t, STOPS) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), *(pa.array(np.asarray(x, dtype=np.float64)) for x in (n, dup, top, long, line, piece, digit))],
            ["doc_id", *FEATURES],
        )


def _exact_shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts in text_runs(batches):
        cp, offsets = fold_many(texts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(np.diff(offsets)), pa.array(repeated_shares(cp, offsets).astype(np.int64))],
            ["doc_id", "folded_chars", "repeated_chars"],
        )


EXACT = "doc_id long, folded_chars long, repeated_chars long"


# -- decision lists -----------------------------------------------------------------------------

Condition = tuple[int, str, float]  # feature, "<=" or ">", threshold


class DecisionList:
    """Ordered rules ``(conditions, verdict)`` with a verdict for the rest."""

    def __init__(self, rules: list[tuple[list[Condition], str]], rest: str) -> None:
        self.rules, self.rest = rules, rest

    def column(self, features: tuple[str, ...] = FEATURES) -> Column:
        """The list as one conditional expression; a null statistic meets no condition."""
        expr = None
        for conditions, verdict in self.rules:
            test = F.lit(True)
            for f, op, t in conditions:
                c = F.col(features[f])
                test = test & ((c <= F.lit(float(t))) if op == "<=" else (c > F.lit(float(t))))
            expr = F.when(test, verdict) if expr is None else expr.when(test, verdict)
        return F.lit(self.rest) if expr is None else expr.otherwise(self.rest)

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.rest, dtype=object)
        open_ = np.ones(len(x), dtype=bool)
        for conditions, verdict in self.rules:
            hit = open_ & _covers(conditions, x)
            out[hit] = verdict
            open_ &= ~hit
        return out

    def __str__(self) -> str:
        lines = [" and ".join(f"{FEATURES[f]} {op} {t:.4g}" for f, op, t in c) + f" -> {v}" for c, v in self.rules]
        return "\n".join([*lines, f"else {self.rest}"])


def _covers(conditions: list[Condition], x: np.ndarray, slack: float = 0.0) -> np.ndarray:
    """``slack`` widens every threshold: an upper one by that factor, a lower one by its inverse."""
    ok = np.ones(len(x), dtype=bool)
    for f, op, t in conditions:
        ok &= x[:, f] <= t * (1 + slack) if op == "<=" else x[:, f] > t / (1 + slack)
    return ok


def _grow(x: np.ndarray, y: np.ndarray, slack: float, most: int) -> list[Condition]:
    """Add the condition of the highest information gain until no wrong row is covered."""
    rule: list[Condition] = []
    for _ in range(most):
        right, wrong = _covers(rule, x) & y, _covers(rule, x, slack) & ~y
        if not wrong.any() or not right.any():
            break
        p, n = right.sum(), wrong.sum()
        best, gain = None, 0.0
        for f in range(x.shape[1]):
            for t in np.unique(np.quantile(x[right, f], np.linspace(0, 1, 24))):
                for op in ("<=", ">"):
                    c = [(f, op, float(t))]
                    p1 = (right & _covers(c, x)).sum()
                    n1 = (wrong & _covers(c, x, slack)).sum()
                    if p1 == 0 or (p1 == p and n1 == n):
                        continue
                    g = p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p / (p + n)))
                    if g > gain:
                        best, gain = c[0], g
        if best is None:
            break
        rule.append(best)
    return rule


def _prune(rule: list[Condition], x: np.ndarray, y: np.ndarray, slack: float) -> list[Condition]:
    """Drop last conditions while the worth on the held-back part does not fall."""

    def worth(r: list[Condition]) -> float:
        p, n = (_covers(r, x) & y).sum(), (_covers(r, x, slack) & ~y).sum()
        return (p - 4 * n) / (p + n) if p + n else -1.0

    while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
        rule = rule[:-1]
    return rule


def learn(x: np.ndarray, y: np.ndarray, slack: float = SLACK, max_rules: int = 8, max_conditions: int = 5, seed: int = 7) -> DecisionList:
    """Rules for the clean class first, then for the repeating one; the rest is unsure.

    A rule is kept only if, widened by ``slack``, it covers no row of the other class in the
    whole sample.  The rows of one that fails are set aside for the growing of that class' next
    rules, which goes on.  With fewer than 50 sample rows no rule is learned.
    """
    if len(x) < 50:
        return DecisionList([], "unsure")
    rng = np.random.default_rng(seed)
    grow = rng.random(len(x)) < 2 / 3
    open_ = np.ones(len(x), dtype=bool)
    rules: list[tuple[list[Condition], str]] = []
    for verdict, target in (("clean", ~y), ("repeating", y)):
        aside = np.zeros(len(x), dtype=bool)
        for _ in range(max_rules):
            # rows that an earlier rule took still count against a rule of the other class
            g, held = (open_ & ~aside | ~target) & grow, (open_ | ~target) & ~grow
            if not (g & target).any():
                break
            full = _grow(x[g], target[g], slack, max_conditions)
            rule = _prune(full, x[held], target[held], slack) if full else full
            if rule and (_covers(rule, x, slack) & ~target).any():
                rule = full
            hit = open_ & _covers(rule, x)
            if not rule or hit.sum() < 5:
                break
            if (_covers(rule, x, slack) & ~target).any():
                aside |= hit & target
                continue
            rules.append((rule, verdict))
            open_ &= ~hit
    return DecisionList(rules, "unsure")


def statistics(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_statistics, STATS)


def exact_shares(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_exact_shares, EXACT)


def fit(documents: DataFrame, sample: int = SAMPLE) -> DecisionList:
    """Learn from the ``sample`` documents whose ids have the least hashes.

    Ids are chosen first and without their texts; statistics and labels are then computed where
    the chosen texts lie, and only those (a row of numbers a document) come to the driver.
    """
    base = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null and doc_id is not null")
    some = base.select("doc_id").orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(sample)

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_runs(batches):
            run = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts)], ["doc_id", "text"])
            stats = pa.Table.from_batches(list(_statistics(iter([run]))), _schema_stats())
            exact = pa.Table.from_batches(list(_exact_shares(iter([run]))), _schema_exact())
            for c in ("folded_chars", "repeated_chars"):
                stats = stats.append_column(c, exact.column(c))
            yield from stats.to_batches()

    # at most ``sample`` ids, so the broadcast is bounded
    chosen = base.join(F.broadcast(some), "doc_id", "left_semi")
    rows = chosen.mapInArrow(both, STATS + ", folded_chars long, repeated_chars long").toPandas().sort_values("doc_id")
    x = rows[list(FEATURES)].to_numpy(dtype=np.float64).reshape(-1, len(FEATURES))
    y = ((rows["folded_chars"] > 0) & (rows["repeated_chars"] >= SHARE * rows["folded_chars"])).to_numpy(dtype=bool)
    return learn(x, y)


def _schema_stats() -> pa.Schema:
    return pa.schema([("doc_id", pa.int64()), *((f, pa.float64()) for f in FEATURES)])


def _schema_exact() -> pa.Schema:
    return pa.schema([("doc_id", pa.int64()), ("folded_chars", pa.int64()), ("repeated_chars", pa.int64())])


def least_dup(share: float = SHARE) -> float:
    """What ``dup_short`` is at least in a text of which ``share`` is repeated.

    A repeated run of ``RUN`` starts ``RUN - SHORT + 1`` repeated short runs; where such runs
    overlap or touch, every ``RUN`` characters covered still have as many starts or more.
    """
    return share * (RUN - SHORT + 1) / RUN


def verdict(rules: DecisionList, share: float = SHARE) -> Column:
    """The list's verdict where the bounds allow it, else ``unsure``."""
    said = rules.column()
    in_doubt = (said == "clean") & (F.col("dup_short") >= F.lit(least_dup(share))) & (F.col("n") > 0)
    in_doubt |= (said == "repeating") & ((F.col("dup_long") < F.lit(float(share))) | (F.col("n") == 0))
    return F.when(in_doubt, "unsure").otherwise(said)


def judged(documents: DataFrame, rules: DecisionList | None = None, sample: int = SAMPLE) -> DataFrame:
    """The statistics of every document with a text and the list's ``verdict``."""
    rules = rules or fit(documents, sample)
    return statistics(documents).withColumn("verdict", verdict(rules))


def repeating(documents: DataFrame, rules: DecisionList | None = None, sample: int = SAMPLE, share: float = SHARE) -> DataFrame:
    """``(doc_id)`` of the documents at least ``share`` of whose N(text) is repeated.

    The decision list lets go of what is clean and takes what is repeating; the exact share
    decides the rest.  Null texts and those without letters or digits never count; a repeated row
    counts once; an empty table gives no rows.
    """
    rules = rules or fit(documents, sample)
    base = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    stats = base.mapInArrow(_statistics_with_text, STATS + ", text string").withColumn("verdict", verdict(rules, share))
    left = stats.where("verdict <> 'clean'").select("doc_id", F.when(F.col("verdict") == "unsure", F.col("text")).alias("text"))
    return left.mapInArrow(_settled(share), "doc_id long").distinct()


def _settled(share: float):
    """Ids of rows without a text, which the list has taken, and of those whose exact share suffices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            taken = batch.filter(batch.column(1).is_null())
            if taken.num_rows:
                yield pa.RecordBatch.from_arrays([taken.column(0)], ["doc_id"])
            for got in _exact_shares(iter([batch])):
                n, again = got.column(1).to_numpy(), got.column(2).to_numpy()
                yield pa.RecordBatch.from_arrays([got.column(0).filter(pa.array((n > 0) & (again >= share * n)))], ["doc_id"])

    return run


def _statistics_with_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts in text_runs(batches):
        batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts)], ["doc_id", "text"])
        for got in _statistics(iter([batch])):
            yield pa.RecordBatch.from_arrays([*got.columns, batch.column(1).slice(0, got.num_rows)], [*got.schema.names, "text"])
