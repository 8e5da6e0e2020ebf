"""Corpus statistics: per-document metrics and their aggregation by group in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import spread


def _ratio_of(items: Column, test) -> Column:
    return X.share(F.size(F.filter(items, test)), F.size(items))


def doc_metrics(t: Column) -> dict[str, Column]:
    n = F.length(t)

    def r(pattern: str) -> Column:
        return X.share(F.regexp_count(t, F.lit(pattern)), n)

    return {
        "length": n.cast("double"),
        "white_space_ratio": r(X.WS),
        "non_alpha_digit_ratio": r(r"[^\p{L}\p{Nd}]"),
        "digit_ratio": r(r"\p{Nd}"),
        "uppercase_ratio": r(r"\p{Lu}"),
        "elipsis_ratio": X.share(3 * F.regexp_count(t, F.lit(r"\.\.\.")) + F.regexp_count(t, F.lit("…")), n),
        "punctuation_ratio": r(X.punctuation_class()),
    }


def _lengths(items: Column, name: str, short: Sequence[int], long: Sequence[int]) -> dict[str, Column]:
    def at_most(k: int) -> Column:
        return _ratio_of(items, lambda x: F.length(x) <= k)

    def at_least(k: int) -> Column:
        return _ratio_of(items, lambda x: F.length(x) >= k)

    return {f"short_{name}_{k}": at_most(k) for k in short} | {f"long_{name}_{k}": at_least(k) for k in long}


def line_metrics(t: Column, lines: Column, short: Sequence[int] = (10, 30), long: Sequence[int] = (2000, 10000)) -> dict[str, Column]:
    n = F.size(lines)
    dup_n, dup_c = X.duplicates(lines)
    out = {"n_lines": n.cast("double"), "avg_line_length": X.share(X.total_length(lines), n)}
    out |= _lengths(lines, "line_ratio_chars", short, long)
    out["lines_ending_with_terminal_mark_ratio"] = _ratio_of(lines, lambda x: x.rlike("[.?!\"']\\z"))
    out["bullet_point_lines_ratio"] = _ratio_of(lines, lambda x: x.rlike(rf"^{X.WS}*[•\-]"))
    out["line_duplicates"] = X.share(dup_n, n)
    out["line_char_duplicates"] = X.share(dup_c, F.length(t))
    return out


def paragraph_metrics(t: Column, paras: Column, short: Sequence[int] = (100,), long: Sequence[int] = (1000,)) -> dict[str, Column]:
    n = F.size(paras)
    dup_n, dup_c = X.duplicates(paras)
    out = {"n_paragraphs": n.cast("double"), "avg_paragraph_length": X.share(X.total_length(paras), n)}
    out |= _lengths(paras, "paragraph_ratio", short, long)
    out["paragraph_duplicates"] = X.share(dup_n, n)
    out["paragraph_char_duplicates"] = X.share(dup_c, X.total_length(paras))
    return out


def sentence_metrics(t: Column, s: Column, short: Sequence[int] = (20,), long: Sequence[int] = (75,)) -> dict[str, Column]:
    n = F.size(s)
    out = {"n_sentences": n.cast("double"), "avg_sentence_length": X.share(X.total_length(s), n)}
    out |= _lengths(s, "sentence_ratio", short, long)
    return out


def word_metrics(t: Column, w: Column, stop_words: Sequence[str], short: Sequence[int] = (3,), long: Sequence[int] = (7,)) -> dict[str, Column]:
    n = F.size(w)
    out = {
        "n_words": n.cast("double"),
        "avg_word_length": X.share(X.total_length(w), n),
        "avg_words_per_line": X.share(n, F.size(X.split_lines(t))),
    }
    out |= _lengths(w, "word_ratio", short, long)
    out["type_token_ratio"] = X.share(F.size(F.array_distinct(w)), n)
    out["uppercase_word_ratio"] = _ratio_of(w, lambda x: x.rlike(r"\p{Lu}") & ~x.rlike(r"[\p{Ll}\p{Lt}]"))
    out["capitalized_word_ratio"] = _ratio_of(w, lambda x: x.rlike(r"^[\p{Lu}\p{Lt}][^\p{Lu}\p{Lt}]*\z"))
    out["stop_word_ratio"] = _ratio_of(w, lambda x: x.isin(*stop_words))
    return out


def contamination_metrics(t: Column, w: Column, words: Sequence[str]) -> dict[str, Column]:
    """Share of simplified words in a list; the list is simplified by the caller."""
    return {f"words_contamination_{words[0]}": _ratio_of(w, lambda x: x.isin(*words))}


def with_metrics(df: DataFrame, metrics: dict[str, Column], *keep: str) -> DataFrame:
    return df.select(*keep, *[c.alias(k) for k, c in metrics.items()])


#: What the metrics of a unit are computed over.
UNITS = {
    "line": X.lines,
    "paragraph": lambda t: F.filter(F.split(t, "\n\n", -1), lambda p: X.strip(p) != ""),
    "sentence": X.sentences,
    "word": X.words,
    "simple_word": lambda t: F.split(X.simplify(t, marks=False), " ", -1),
}


def unit_metrics(df: DataFrame, unit: str, metrics, *keep: str, text: str = "text") -> DataFrame:
    """``metrics(text, items)`` with the items of the unit computed once a row."""
    t = F.col(text)
    made = X.let(UNITS[unit](t), lambda items: F.struct(*[c.alias(k) for k, c in metrics(t, items).items()]))
    return spread(df.select(*keep, text)).select(*keep, made.alias("_m")).select(*keep, "_m.*")


def unpivoted(df: DataFrame, metrics: Sequence[str], *keep: str) -> DataFrame:
    """One row per document and metric."""
    return df.unpivot(list(keep), list(metrics), "stat", "value")


def summary(flat: DataFrame, *groups: str) -> DataFrame:
    """Total, count, mean, extremes and variance of every metric (and group).

    Metrics have six digits, so they are summed as exact decimals: the order of rows does not matter.
    """
    v = F.col("value")
    exact = v.cast("decimal(18,6)")
    sums = flat.groupBy(*groups, "stat").agg(
        F.sum(exact).alias("d"), F.sum(exact * exact).cast("double").alias("q"), F.count(v).alias("n"), F.min(v).alias("min"), F.max(v).alias("max")
    )
    s, q, n = F.col("d").cast("double"), F.col("q"), F.col("n")
    variance = F.when(n > 1, F.greatest(F.lit(0.0), (q - s * s / n) / (n - 1))).otherwise(F.lit(0.0))
    return sums.select(*groups, "stat", F.round("d", 4).cast("double").alias("total"), "n", F.round(s / n, 6).alias("mean"), "min", "max", F.round(variance, 4).alias("variance"))


def host(url: Column) -> Column:
    """The host of an address in small letters, without user, port and last dot; null if there is none."""
    found = F.regexp_extract(F.trim(url), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]+)", 1)
    return F.nullif(F.regexp_replace(F.lower(found), r"\.$", ""), F.lit(""))


def suffix(name: Column, known: Sequence[str] = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "co.jp", "com.br", "co.nz", "co.in", "co.za")) -> Column:
    """A host's suffix: its last two labels where they are listed, else its last one.  No public list is at hand."""
    two = F.regexp_extract(name, r"([^.]+\.[^.]+)$", 1)
    return F.when(two.isin(*known), two).otherwise(F.regexp_extract(name, r"([^.]+)$", 1))


def histogram(flat: DataFrame, length: str, digits: int = 3) -> DataFrame:
    """Documents and their characters at every rounded value of every metric."""
    return flat.groupBy("stat", F.round("value", digits).alias("key")).agg(F.count(F.lit(1)).alias("n"), F.sum(length).alias("chars"))


def top_keys(counts: DataFrame, key: str, n: str = "n", k: int = 100_000) -> DataFrame:
    """The ``k`` most frequent keys, by key among equals."""
    return counts.orderBy(F.col(n).desc(), F.col(key)).limit(k)


def by_level(df: DataFrame, first: str, second: str, value: str) -> DataFrame:
    """Several groupings in one scan: by both keys, by the first, and over all."""
    return df.rollup(first, second).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))


def funnel(df: DataFrame, reason: Column) -> DataFrame:
    """Rows forwarded and dropped, by reason."""
    return df.groupBy(F.coalesce(reason, F.lit("forwarded")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
