"""Per-document text quality statistics, and the rules that tell prose from lists, tables and junk.

One Arrow pass computes counts and ratios of a whole text, repetition among them (duplicate lines
and paragraphs, the character coverage of the dominant word n-gram).  The share of common words is
held against the corpus itself: words that stand in at least one document in a hundred; there can
be no more of them than a hundred times the mean number of different words of a document.  The
kind of a text is one ordered Spark expression over the statistics.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kernel import CODE, DIGIT, LETTER, SYMBOL, WIDE, character_classes, points

#: Least share of documents that a common word stands in, and the least number of documents.
COMMON_SHARE, COMMON_LEAST = 0.01, 3

NAMES = (
    "n_chars", "n_words", "mean_word_length", "letter_ratio", "digit_ratio", "symbol_ratio", "n_lines",
    "line_end_ratio", "bullet_ratio", "tail_number_ratio", "cell_ratio", "cells", "mean_line_length", "stops_per_word",
    "comma_ratio", "mixed_word_ratio", "common_word_ratio", "vowelless_ratio", "wide_ratio", "max_word_length",
    "dup_line_ratio", "dup_line_char_ratio", "dup_para_ratio", "top_2gram_ratio", "top_4gram_ratio", "code_ratio", "lower_start_ratio", "hex_ratio",
)

TERMINAL = ".!?。！？।؟．…。"
_ENDS = re.compile(r"[.!?。！？।؟．…]+[\"'”»’“)\]」』]*\s*$")
_STOPS = re.compile(r"[.!?।؟…](?=[\"'”»’“)\]]*(?:\s|$))|[。！？．]")
_BULLET = re.compile(r"\s*(?:[•◦▪·*‣–+\-]\s+\S|\(?\d{1,3}[.)]\s+\S|\(?[^\W\d_]{1,2}\)\s+\S|[IVXLC]{1,6}[.)]\s)")
_TAIL = re.compile(r"(?:[,;:.…\t ]\s*\d[\d.,\-–]*|[×xX*]\s?\d+(?:\s+\S+){0,3})\s*$")
_HEX = re.compile(r"(?:0x)?[0-9a-fA-F]{2}(?:[0-9a-fA-F]{2})*:?")
_SPLITS = (("\t", re.compile(r"\t")), ("|", re.compile(r"\s*\|\s*")), (";", re.compile(r";")), ("  ", re.compile(r"\s{2,}")))
_MIXED = re.compile(r"[^\W\d_][^\s]*\d|\d[^\s]*[^\W\d_]|[{}<>\\=|_#$%^&@~`\[\]]")
_UNSAYABLE = re.compile(r"[b-df-hj-np-tv-xz]{5}|^[b-df-hj-np-tv-xz]+$")
_EDGE = "\"'“”„«»‚‘’.,;:!?()[]{}*-–—…।؟،؛¿¡|"


def words_of(text: str) -> list[str]:
    """Blank-separated words in lower case without the marks around them."""
    return [w for w in [x.strip(_EDGE) for x in text.lower().split()] if w]


def _cells(lines: list[str]) -> tuple[float, int]:
    """The largest share of lines that fall into one same number (3 or more) of short cells, by one
    mark; rules of marks alone are left out.  Returns the share and that number.
    """
    real = [x.strip().strip("|").strip() if x.strip().startswith("|") else x.strip() for x in lines]
    real = [x for x in real if x and not re.fullmatch(r"[\s|+\-=:]+", x)]
    if not real:
        return 0.0, 0
    best, size = 0.0, 0
    whole = "\n".join(real)
    for mark, split in _SPLITS:
        if mark not in whole:
            continue
        counts: Counter[int] = Counter()
        for x in real:
            parts = split.split(x)
            if len(parts) >= 3 and max(map(len, parts)) <= 40:
                counts[len(parts)] += 1
        if counts:
            n, k = counts.most_common(1)[0]
            if k / len(real) > best:
                best, size = k / len(real), n
    return best, size


def _top_gram(words: list[str], n: int, chars: int) -> float:
    if len(words) < n + 1:
        return 0.0
    counts = Counter(zip(*(words[i:] for i in range(n))))
    gram, k = counts.most_common(1)[0]
    return k * sum(map(len, gram)) / chars if k > 1 and chars else 0.0


def _dup(parts: list[str]) -> tuple[float, float]:
    seen: set[str] = set()
    again = chars = 0
    for p in parts:
        if p in seen:
            again += 1
            chars += len(p)
        else:
            seen.add(p)
    return (again / len(parts), chars / max(1, sum(map(len, parts)))) if parts else (0.0, 0.0)


def describe(text: str, common: frozenset[str] | set[str] = frozenset()) -> tuple[float, ...]:
    """The statistics in the order of ``NAMES``; of a blank text all are 0 but ``n_chars``."""
    n = len(text)
    words = words_of(text)
    lines = [x for x in text.split("\n") if x.strip()]
    if not lines:
        return (float(n), *([0.0] * (len(NAMES) - 1)))
    raw_words = text.split()
    kinds_ = np.bincount(character_classes()[points(text)], minlength=7)
    solid = max(1, sum(map(len, raw_words)))
    letters = int(kinds_[LETTER] + kinds_[WIDE])
    digits, symbols, code = int(kinds_[DIGIT]), int(kinds_[SYMBOL] + kinds_[CODE]), int(kinds_[CODE])
    n_lines, n_words = len(lines), max(1, len(raw_words))
    chars = sum(map(len, words))
    share, cells = _cells(lines) if n_lines >= 2 else (0.0, 0)
    dup_line, dup_line_chars = _dup([x.strip() for x in lines])
    paras = [p.strip() for p in re.split(r"\n\s*\n", text) if p.strip()]
    latin = sum(1 for w in words if len(w) >= 4 and w.isascii())
    unknown = [w for w in words if w not in common]
    odd = sum(1 for w in unknown if len(w) >= 4 and w.isascii() and _UNSAYABLE.search(w))
    mixed = sum(1 for w in raw_words if len(w) >= 5 and not w.isalpha() and _MIXED.search(w))
    hexes = sum(1 for w in raw_words if len(w) % 2 == 0 and _HEX.fullmatch(w)) if digits else 0
    return tuple(
        float(v)
        for v in (
            n, len(words), chars / max(1, len(words)), letters / solid, digits / solid, symbols / solid, n_lines,
            sum(1 for x in lines if _ENDS.search(x)) / n_lines,
            sum(1 for x in lines if _BULLET.match(x)) / n_lines,
            sum(1 for x in lines if _TAIL.search(x)) / n_lines,
            share, cells, sum(map(len, lines)) / n_lines,
            len(_STOPS.findall(text)) / n_words,
            sum(text.count(c) for c in ",،、，") / n_words,
            mixed / n_words,
            1 - len(unknown) / len(words) if words else 0.0,
            odd / max(1, latin),
            int(kinds_[WIDE]) / solid, max(map(len, raw_words)),
            dup_line, dup_line_chars, _dup(paras)[0],
            _top_gram(words, 2, chars), _top_gram(words, 4, chars),
            code / solid,
            sum(1 for x in lines if x.lstrip()[:1].islower()) / n_lines,
            hexes / n_words,
        )
    )


def _word_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of documents for each word of a partition, added up here before the shuffle."""
    counts: Counter[str] = Counter()
    docs = 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text is None:
                continue
            docs += 1
            counts.update(w for w in set(words_of(text)) if len(w) <= 40)
            if len(counts) > 500_000:
                yield _counted(counts)
                counts = Counter()
    counts[""] = docs  # the number of documents goes along under the empty word
    yield _counted(counts)


def _counted(counts: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts.keys()), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "docs"]
    )


def common_words(documents: DataFrame, share: float = COMMON_SHARE) -> set[str]:
    """The words that at least ``share`` of the documents with a text have; a bounded set."""
    counts = documents.select("text").mapInArrow(_word_sets, "word string, docs long").groupBy("word").agg(F.sum("docs").alias("docs"))
    counts = counts.where(F.col("docs") >= COMMON_LEAST)
    total = documents.where("text is not null").count()
    return {r["word"] for r in counts.where(F.col("docs") >= share * total).select("word").collect()} - {""}


def statistics(documents: DataFrame, common: set[str] | None = None) -> DataFrame:
    """``doc_id`` and the statistics ``NAMES`` of every document with a text."""
    common = common_words(documents) if common is None else common
    shared = documents.sparkSession.sparkContext.broadcast(frozenset(common))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            ids, rows = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text is not None:
                    ids.append(key)
                    rows.append(describe(text, words))
            table = np.asarray(rows, dtype=np.float64).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *(pa.array(np.ascontiguousarray(table[:, k])) for k in range(len(NAMES)))], ["doc_id", *NAMES]
            )

    schema = "doc_id long, " + ", ".join(f"{c} double" for c in NAMES)
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


#: The combined rules, first match wins: name, SQL condition over ``NAMES``.
RULES: tuple[tuple[str, str], ...] = (
    ("blank", "n_lines = 0"),
    ("table", "n_lines >= 3 and cell_ratio >= 0.7 and cells >= 3 and line_end_ratio < 0.3 and stops_per_word < 0.05 and comma_ratio < 0.5"),
    ("junk", "hex_ratio > 0.5 and digit_ratio > 0.2 and comma_ratio < 0.1 and n_words > 10"),
    ("junk", "letter_ratio < 0.35 and code_ratio > 0.1"),
    ("junk", "mixed_word_ratio > 0.4 and stops_per_word < 0.1"),
    ("junk", "vowelless_ratio > 0.25 and common_word_ratio < 0.2 and stops_per_word < 0.05"),
    ("junk", "max_word_length > 60 and mean_word_length > 20 and wide_ratio < 0.2 and common_word_ratio < 0.2"),
    ("list", "n_lines >= 3 and bullet_ratio >= 0.7 and line_end_ratio < 0.5"),
    ("list", "n_lines >= 3 and tail_number_ratio >= 0.7 and line_end_ratio < 0.5"),
    ("junk", "comma_ratio > 0.5 and stops_per_word < 0.02 and tail_number_ratio < 0.5"),
)


def kind() -> Column:
    expr = None
    for name, condition in RULES:
        expr = F.when(F.expr(condition), name) if expr is None else expr.when(F.expr(condition), name)
    return expr.otherwise("prose")


def kinds(documents: DataFrame, common: set[str] | None = None) -> DataFrame:
    """The statistics and the ``kind``: prose, list, table, junk or blank."""
    return statistics(documents, common).withColumn("kind", kind())


def not_prose(documents: DataFrame) -> DataFrame:
    """``(doc_id, kind)`` of lists, tables and junk.  Null and blank texts are no case."""
    return kinds(documents).where(F.col("kind").isin("list", "table", "junk")).select("doc_id", "kind").distinct()
