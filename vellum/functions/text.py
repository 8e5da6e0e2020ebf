"""Text functions as column expressions; Python only where Spark has no built-in (NFD, NFC)."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as a regex class that Java and RE2 both read.
WS = r"[\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
LINE_BREAK = r"\r\n|[\n-\r\x1C-\x1E\x{85}\x{2028}\x{2029}]"
#: Scripts written without blanks between words.
NO_SPACE = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")
#: One character and what combines with it.
CLUSTER = r"[^\p{M}\x{0E33}\x{0EB3}\x{FF9E}\x{FF9F}][\p{M}\x{0E33}\x{0EB3}\x{FF9E}\x{FF9F}]*|[\p{M}]"
RUN = r"[\p{L}\p{M}\p{N}]+"
NUMBER = r"\p{Nd}+([.,\x{60C}\x{66B}\x{2396}\x{2397}\x{2398}]\p{Nd}+)?"
CLOSERS = "\"'”’»)\\]}"

#: Punctuation that normalisation turns into blanks, besides control characters.
PUNCTUATION_MARKS = "!/—”:％１〈&(、━\\【#%「」，】；+^]~“《„';’{|∶´[=-`*．（–？！：$～«〉,><》)?）。…@_.\"}►»"
CONTROLS = "".join(chr(c) for lo, hi in ((0, 9), (11, 13), (13, 32), (127, 160)) for c in range(lo, hi))
#: What ends a line of prose, an ellipsis, and boilerplate of web pages.
END_MARKS = (".", "?", "!", '"', "'")
ELLIPSES = ("...", "…")


@lru_cache(1)
def sentence_terminals() -> str:
    """The characters with the Unicode property Sentence_Terminal, in order."""
    import regex

    return "".join(regex.findall(r"\p{Sentence_Terminal}", "".join(map(chr, range(0x20, 0x1FFFF)))))


def wide_terminals() -> str:
    return "".join(c for c in sentence_terminals() if ord(c) > 127)


@lru_cache(1)
def terminal_class() -> str:
    """Sentence terminals outside ASCII as the inside of a regex class for Java and RE2."""
    return "".join(f"\\x{{{ord(c):X}}}" for c in sentence_terminals() if ord(c) > 127)


def java_scripts(names: tuple[str, ...] = NO_SPACE) -> str:
    return "[" + "".join(rf"\p{{Is{n}}}" for n in names) + "]"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often the body names it."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), 0)


def java_class(chars: str) -> str:
    """A class of characters whose rare members cost nothing where the text is Latin."""
    low = "".join(f"\\x{{{ord(c):X}}}" for c in chars if ord(c) < 0x100)
    high = "".join(f"\\x{{{ord(c):X}}}" for c in chars if ord(c) >= 0x100)
    return f"[{low}[[\\x{{100}}-\\x{{10FFFF}}]&&[{high}]]]" if high else f"[{low}]"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def lines(c: Column) -> Column:
    return F.split(c, "\n", -1)


def split_lines(c: Column) -> Column:
    """Lines at every kind of break, without an empty one after the last break."""
    return let(F.split(c, LINE_BREAK, -1), lambda p: F.when(F.element_at(p, -1) == "", F.slice(p, 1, F.size(p) - 1)).otherwise(p))


def words(c: Column) -> Column:
    """Runs of letters, marks and digits; runs with a script without blanks, by character clusters."""
    runs = F.regexp_extract_all(c, F.lit(RUN), F.lit(0))
    return F.flatten(F.transform(runs, lambda r: F.when(r.rlike(java_scripts()), F.regexp_extract_all(r, F.lit(CLUSTER), F.lit(0))).otherwise(F.array(r))))


def sentences(c: Column) -> Column:
    """Sentences without a language: ASCII terminals end one before white space only, others always."""
    wide = F.regexp_replace(c, f"({java_class(wide_terminals())}[{CLOSERS}]*)", "$1\n")
    plain = F.regexp_replace(wide, rf"([.!?][{CLOSERS}]*)({WS}|\z)", "$1\n")
    return F.filter(F.transform(F.split(plain, "\n", -1), strip), lambda s: s != "")


def paragraphs(c: Column) -> Column:
    return F.split(strip(c), "\n{2,}", -1)


def _bare(t: str | None) -> str | None:
    if t is None or t.isascii():
        return t
    return "".join(c for c in unicodedata.normalize("NFD", t) if unicodedata.category(c) != "Mn")


@F.pandas_udf(T.ArrayType(T.StringType()))
def without_marks_all(s: pd.Series) -> pd.Series:
    """``without_marks`` over arrays."""
    return s.map(lambda items: None if items is None else [_bare(t) for t in items])


@F.pandas_udf(T.StringType())
def without_marks(s: pd.Series) -> pd.Series:
    """Canonical decomposition without nonspacing marks."""

    return s.map(_bare)


@F.pandas_udf(T.StringType())
def composed(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def punctuation_class() -> str:
    """The punctuation of normalisation as a regex class."""
    return "[" + "".join(f"\\x{{{ord(c):X}}}" for c in PUNCTUATION_MARKS + CONTROLS) + "]"


def simplify(c: Column, marks: bool = True, numbers: bool = True, punctuation: bool = True) -> Column:
    """Normal form for comparing texts: lower case, numbers as 0, punctuation and white space as one
    blank, letters without their marks."""
    x = F.lower(c)
    if numbers:
        x = F.regexp_replace(x, NUMBER, "0")
    if punctuation:
        x = F.translate(x, PUNCTUATION_MARKS + CONTROLS, " " * len(PUNCTUATION_MARKS + CONTROLS))
    x = F.regexp_replace(strip(x), f"{WS}+", " ")
    if marks:
        x = without_marks(x)
    return strip(x)


def ngrams(items: Column, n: int, sep: str = " ") -> Column:
    """Every run of ``n`` consecutive items joined by ``sep``; none if there are fewer."""


    def grams(w: Column) -> Column:
        every = F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), sep))
        return F.when(F.size(w) >= n, every).otherwise(F.array().cast("array<string>"))

    return let(items, grams)


def sha1_64(c: Column) -> Column:
    """The first eight bytes of SHA-1, little endian, as a signed 64-bit number."""
    h = F.sha1(F.encode(c, "UTF-8"))
    swapped = F.concat(*[F.substring(h, i, 2) for i in range(15, 0, -2)])
    return F.conv(swapped, 16, -10).cast("long")


def sha1_32(c: Column) -> Column:
    """The first four bytes of SHA-1, little endian, as an unsigned 32-bit number."""
    h = F.sha1(F.encode(c, "UTF-8"))
    return F.conv(F.concat(*[F.substring(h, i, 2) for i in range(7, 0, -2)]), 16, 10).cast("long")


def xxhash_of(c: Column, bits: int = 64) -> Column:
    """xxHash of 64 or 32 bits with seed 0 (Spark's own has seed 42), as a signed 64-bit number."""

    @F.pandas_udf(T.LongType())
    def run(s: pd.Series) -> pd.Series:
        import xxhash

        digest = xxhash.xxh64_intdigest if bits == 64 else xxhash.xxh32_intdigest

        def one(t: str | None) -> int | None:
            if t is None:
                return None
            h = digest(t.encode())
            return h - (1 << 64) if h >> 63 else h

        return pd.Series([one(t) for t in s], dtype="Int64")

    return run(c)


#: What the normalisation before a language model's perplexity puts for Unicode punctuation.
PLAIN_PUNCTUATION = {
    "，": ",", "。": ".", "、": ",", "„": '"', "”": '"', "“": '"', "«": '"', "»": '"', "１": '"', "」": '"', "「": '"', "《": '"', "》": '"',
    "´": "'", "∶": ":", "：": ":", "？": "?", "！": "!", "（": "(", "）": ")", "；": ";", "–": "-", "—": " - ", "．": ". ", "～": "~", "’": "'",
    "…": "...", "━": "-", "〈": "<", "〉": ">", "【": "[", "】": "]", "％": "%", "►": "-",
}


def perplexity_form(c: Column, accents: bool = True, case: bool = True, numbers: bool = True, punctuation: int = 1) -> Column:
    """The form in which a language model is asked: stripped, lower case, without accents, digits as 0,
    Unicode punctuation as plain one (1), without any (2) or as it is (0), without unprinted characters."""
    x = strip(c)
    x = F.lower(x) if case else x
    x = without_marks(x) if accents else x
    x = F.regexp_replace(x, r"\p{Nd}", "0") if numbers else x
    if punctuation == 1:
        for mark, plain in PLAIN_PUNCTUATION.items():
            x = F.replace(x, F.lit(mark), F.lit(plain))
    elif punctuation == 2:
        x = F.translate(x, "".join(PLAIN_PUNCTUATION), "")
    return F.translate(x, "".join(chr(k) for k in [*range(32), *range(127, 160)]), "")


def parts(c: Column, mode: str = "DOCUMENT") -> Column:
    """The text in parts that make it whole again: the document, its paragraphs (each with the white
    space behind it), its sentences; or its words, which do not."""
    if mode == "DOCUMENT":
        return F.array(c)
    if mode == "WORDS":
        return words(c)
    if mode == "PARAGRAPH":
        # a line with something in it opens a part, but for the first; lines after the last break are dropped
        return F.filter(F.split(F.regexp_replace(c, r"\n\z", ""), rf"(?<=\n)(?=[^\n]*[^\s\x{{A0}}\x{{3000}}])", -1), lambda x: x != "")
    if mode == "SENTENCE":

        @F.pandas_udf(T.ArrayType(T.StringType()))
        def run(s: pd.Series) -> pd.Series:
            from ..operators.kernels import sentence_spans

            def one(t: str | None) -> list[str] | None:
                if t is None:
                    return None
                ends = [b for _, b in sentence_spans(t)]
                return [t[a:b] for a, b in zip([0, *ends[:-1]], [*ends[:-1], len(t)])] if ends else []

            return s.map(one)

        return run(c)
    raise ValueError(f"no such parts: {mode}")


def pages(text: Column, offsets: Column) -> Column:
    """The pages that end at ``offsets`` (ascending); what stands behind the last one is none."""
    begins = F.concat(F.array(F.lit(0)), offsets)
    return F.transform(offsets, lambda end, k: F.substr(text, F.get(begins, k) + 1, end - F.get(begins, k)))


def total_length(items: Column) -> Column:
    return F.aggregate(items, F.lit(0).cast("long"), lambda a, x: a + F.length(x))


def duplicates(items: Column) -> tuple[Column, Column]:
    """How many items repeat an earlier one, and their characters."""
    distinct = F.array_distinct(items)
    return F.size(items) - F.size(distinct), total_length(items) - total_length(distinct)


def share(part: Column, whole: Column) -> Column:
    """A ratio rounded to six digits; 0 where there is nothing."""
    return F.when(whole > 0, F.round(part / whole, 6)).otherwise(F.lit(0.0))


def count_matches(items: Column, pattern: str) -> Column:
    return F.size(F.filter(items, lambda x: x.rlike(pattern)))
