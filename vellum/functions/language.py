"""A small offline language guess: scripts decide where they can, frequent words elsewhere."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as X

#: Frequent words of the languages that share the Latin script.
FREQUENT = {
    "en": ("the", "of", "and", "a", "to", "in", "was", "that", "it", "for", "with", "from", "at", "by"),
    "de": ("der", "die", "das", "und", "ein", "eine", "den", "im", "aus", "von", "mit", "des", "dem", "sich"),
    "fr": ("le", "la", "les", "de", "des", "et", "un", "une", "du", "que", "dans", "qui", "au", "sur"),
    "es": ("el", "la", "los", "de", "del", "y", "un", "una", "que", "en", "con", "por", "las", "se"),
}


def _share(c: Column, script: str) -> Column:
    letters = F.greatest(F.lit(1), F.regexp_count(c, F.lit(r"\p{L}")))
    return F.regexp_count(c, F.lit(rf"\p{{Is{script}}}")) / letters


def language_scores(c: Column) -> Column:
    """``map<string, double>`` from language to a score between 0 and 1."""
    return X.let(F.transform(X.words(c), lambda x: F.lower(x)), lambda w: _scores(c, w))


def _among(w: Column, words: tuple[str, ...]) -> Column:
    return F.size(F.filter(w, lambda x: x.isin(*words)))


def _scores(c: Column, w: Column) -> Column:
    hits = {k: _among(w, v) for k, v in FREQUENT.items()}
    total = F.greatest(F.lit(1), reduce(lambda a, b: a + b, hits.values()))
    kana = _share(c, "Hiragana") + _share(c, "Katakana")
    latin = _share(c, "Latin")
    pairs = [(k, latin * v / total) for k, v in hits.items()]
    pairs += [
        ("ru", _share(c, "Cyrillic")), ("ar", _share(c, "Arabic")), ("hi", _share(c, "Devanagari")), ("th", _share(c, "Thai")),
        ("ja", F.when(kana > 0.05, kana + _share(c, "Han")).otherwise(0.0)), ("zh", F.when(kana > 0.05, 0.0).otherwise(_share(c, "Han"))),
    ]
    return F.create_map(*[x for k, v in pairs for x in (F.lit(k), F.round(v.cast("double"), 6))])


def best_language(scores: Column) -> Column:
    """The language of the highest score, the first in alphabetical order of equals; null if all are 0."""
    entries = F.array_sort(F.map_entries(scores), lambda a, b: F.when(a["value"] > b["value"], -1).when(a["value"] < b["value"], 1).when(a["key"] < b["key"], -1).otherwise(1))
    top = F.get(entries, 0)
    return F.when(top["value"] > 0, top["key"])
