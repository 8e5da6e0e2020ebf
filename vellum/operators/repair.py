"""Repairs of book text with a per-document record of what was done.

The record is a typed struct of counters.  Each repair adds to it and to the evidence from which
``with_metrics`` computes the confidence.  Repairs that column expressions can state are such;
those that depend on what they did before are Arrow kernels over whole texts.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from functools import reduce
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X

#: The fields of the record, in order, and its version.
COUNTERS = (
    "pages_detected", "page_boundaries_detected", "headers_removed", "footers_removed", "page_numbers_removed", "boundary_joins",
    "duplicate_blocks_removed", "image_placeholders_removed", "image_notes_removed", "long_line_loops_removed", "loop_chars_removed",
    "ligatures_normalized", "soft_hyphens_removed", "soft_hyphen_line_joins", "line_end_hyphens_joined", "trailing_whitespace_removed",
    "blank_lines_collapsed",
)
VERSION = "0.4.0"
FIELDS = (*COUNTERS, "unicode_chars_changed", "chars_before")
#: Ligatures and what they stand for.
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}


#: An image in Markdown and in HTML.
IMAGES = (r"!\[[^\]\n]*\]\([^\n)]*\)", r"(?i)<img\b[^>]*>")


def start(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the empty record, one column a field until ``packed`` or ``metrics`` make a struct of them:
    a struct that is taken apart and put together at every step would be inlined each time."""
    zero = F.lit(0).cast("long")
    fresh = {f"_r_{f}": zero for f in FIELDS} | {"_r_chars_before": F.length(text).cast("long"), "_e_weight": F.lit(0.0), "_e_count": zero}
    return df.withColumns(fresh)


def packed(df: DataFrame, *more: Column) -> DataFrame:
    """The record's columns as the struct ``repair``."""
    record = F.struct(*[F.col(f"_r_{f}").alias(f) for f in FIELDS], *more)
    return df.withColumn("repair", record).drop(*[f"_r_{f}" for f in FIELDS], "_e_weight", "_e_count")


def _add(df: DataFrame, counts: dict[str, Column], evidence: Column | None = None, confidence: float = 1.0) -> DataFrame:
    new = {f"_r_{f}": F.col(f"_r_{f}") + F.coalesce(c.cast("long"), F.lit(0).cast("long")) for f, c in counts.items()}
    if evidence is not None:
        n = F.coalesce(evidence.cast("long"), F.lit(0).cast("long"))
        new |= {"_e_weight": F.col("_e_weight") + n * confidence, "_e_count": F.col("_e_count") + n}
    return df.withColumns(new)


def normalize_unicode(df: DataFrame, text: str = "text", max_blank_lines: int | None = 2, dehyphenate: bool = False, nfc: bool = True, ligatures: bool = True, soft_hyphens: bool = True, trim: bool = True) -> DataFrame:
    """Newlines, composition, odd blanks, controls, ligatures, soft hyphens, trailing and empty lines."""
    c = F.col(text)
    x = F.regexp_replace(c, "\r\n?", "\n")
    x = X.composed(x) if nfc else x
    x = F.regexp_replace(F.replace(x, F.lit(" "), F.lit(" ")), "​", "")
    x = F.regexp_replace(x, r"[\x00-\x08\x0B\x0D-\x1F\x7F-\x{9F}]", "")
    df = df.withColumn("_t0", c).withColumn("_t1", x)
    t1 = F.col("_t1")
    counts: dict[str, Column] = {}
    x = t1
    if ligatures:
        counts["ligatures_normalized"] = F.regexp_count(t1, F.lit("[ﬀ-ﬆ]"))
        x = reduce(lambda a, kv: F.replace(a, F.lit(kv[0]), F.lit(kv[1])), LIGATURES.items(), t1)
    df = df.withColumn("_t2", x)
    x = F.col("_t2")
    if soft_hyphens:
        broken = r"(?<=\p{L})\x{AD}[ \t]*\n[ \t]*(?=\p{L})"
        joins = F.regexp_count(x, F.lit(broken))
        counts["soft_hyphen_line_joins"] = joins
        counts["soft_hyphens_removed"] = F.length(x) - F.length(F.replace(x, F.lit("­"), F.lit("")))
        x = F.replace(F.regexp_replace(x, broken, ""), F.lit("­"), F.lit(""))
    df = df.withColumn("_t3", x)
    x = F.col("_t3")
    if dehyphenate:
        visible = r"(\p{L}+)-[ \t]*\n[ \t]*(\p{L}+)"
        counts["line_end_hyphens_joined"] = F.regexp_count(x, F.lit(visible))
        x = F.regexp_replace(x, visible, "$1$2")
    df = df.withColumn("_t4", x)
    x = F.col("_t4")
    if trim:
        trimmed = F.regexp_replace(x, r"[ \t]+(\n|\z)", "$1")
        counts["trailing_whitespace_removed"] = F.length(x) - F.length(trimmed)
        x = trimmed
    df = df.withColumn("_t5", x)
    x = F.col("_t5")
    if max_blank_lines is not None:
        most = max_blank_lines + 1
        collapsed = F.regexp_replace(x, "\n{%d,}" % (most + 1), "\n" * most)
        counts["blank_lines_collapsed"] = F.length(x) - F.length(collapsed)
        x = collapsed
    df = df.withColumn("_t6", x)
    changed = F.abs(F.length("_t0") - F.length("_t6")) + F.when(F.col("_t0") != F.col("_t6"), 1).otherwise(0)
    counts["unicode_chars_changed"] = changed
    return _add(df, counts).withColumn(text, F.col("_t6")).drop("_t0", "_t1", "_t2", "_t3", "_t4", "_t5", "_t6")


def remove_images(df: DataFrame, text: str = "text", markdown: bool = True, tags: bool = True, notes: bool = True) -> DataFrame:
    """Image markup and notes about images that a text corpus does not have."""
    patterns = [p for p, on in zip(IMAGES, (markdown, tags)) if on]

    def note(line: Column) -> Column:
        v = F.lower(X.strip(line))
        said = (v.contains("image") & v.contains("not available")) | (v.contains("image placeholder") & v.contains("text-based"))
        return v.startswith("note:") & said & F.lit(notes)

    def clean(line: Column) -> Column:
        return reduce(lambda a, p: F.regexp_replace(a, p, ""), patterns, line)

    lines = X.lines(F.col(text))
    rest = F.filter(lines, lambda x: ~note(x))
    found = F.aggregate(rest, F.lit(0), lambda a, x: a + sum((F.regexp_count(x, F.lit(p)) for p in patterns), F.lit(0)))
    n_notes = F.size(lines) - F.size(rest)
    kept = F.transform(F.filter(rest, lambda x: (X.strip(clean(x)) != "") | (X.strip(x) == "")), clean)
    df = df.withColumn("_images", found).withColumn("_notes", n_notes).withColumn(text, F.array_join(kept, "\n"))
    return _add(df, {"image_placeholders_removed": F.col("_images"), "image_notes_removed": F.col("_notes")}, F.col("_images") + F.col("_notes")).drop("_images", "_notes")


def metrics(df: DataFrame, text: str = "text", penalty_from: float = 0.20, penalty: float = 0.7) -> DataFrame:
    """Completes the record: lengths, removed fraction, confidence, version."""
    before, after = F.col("_r_chars_before"), F.length(text).cast("long")
    gone = F.when(before > 0, F.greatest(F.lit(0), before - after) / before).otherwise(F.lit(0.0))
    mean = F.when(F.col("_e_count") > 0, F.col("_e_weight") / F.col("_e_count")).otherwise(F.lit(1.0))
    sure = F.lit(0.4) + 0.6 * mean - F.greatest(F.lit(0.0), gone - penalty_from) * penalty
    sure = F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), sure)), 6)
    return packed(
        df, after.alias("chars_after"), F.round(gone, 6).alias("removed_fraction"), sure.alias("repair_confidence"), F.lit(VERSION).alias("repair_version")
    )


# -- kernels ------------------------------------------------------------------------------------


class Tally(Counter):
    """Counters of one text's repair, and the evidence for it."""

    weight, evidence = 0.0, 0

    def note(self, field: str, confidence: float, n: int = 1) -> None:
        self[field] += n
        self.weight += n * confidence
        self.evidence += n


def _apply(df: DataFrame, text: str, fields: tuple[str, ...], fn) -> DataFrame:
    """``fn`` gives the new text and a tally of ``fields``."""
    extra = (T.StructField("_weight", T.DoubleType()), T.StructField("_evidence", T.LongType()))
    kind = T.StructType([T.StructField("text", T.StringType()), *(T.StructField(f, T.LongType()) for f in fields), *extra])

    @F.pandas_udf(kind)
    def run(s: pd.Series) -> pd.DataFrame:
        rows = []
        for t in s:
            new, tally = fn(t) if t is not None else (None, Tally())
            rows.append((new, *(tally[f] for f in fields), tally.weight, tally.evidence))
        return pd.DataFrame(rows, columns=["text", *fields, "_weight", "_evidence"])

    df = df.withColumn("_k", run(F.col(text))).withColumn(text, F.col("_k.text"))
    df = _add(df, {f: F.col(f"_k.{f}") for f in fields})
    return df.withColumns({"_e_weight": F.col("_e_weight") + F.col("_k._weight"), "_e_count": F.col("_e_count") + F.col("_k._evidence")}).drop("_k")


def indel_ratio(a: str, b: str) -> float:
    """100 x 2 x longest common subsequence / summed length, by bit-parallel rows."""
    if not a and not b:
        return 100.0
    where: dict[str, int] = defaultdict(int)
    for i, ch in enumerate(a):
        where[ch] |= 1 << i
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        u = row & where.get(ch, 0)
        row = ((row + u) | (row - u)) & full
    lcs = bin(~row & full).count("1")
    return 200.0 * lcs / (len(a) + len(b))


def furniture_signature(line: str) -> str:
    """Without case, with each run of digits as one 0 and what is no word character as a blank."""
    folded = re.sub(r"\d+", "0", unicodedata.normalize("NFKC", line).casefold())
    return re.sub(r"[^\w]+", " ", folded).strip()


class PageRules:
    """Settings of the page repair."""

    def __init__(
        self, markers: tuple[str, ...] = ("---",), window: int = 2, pages: int = 3, fraction: float = 0.14, fuzzy: float = 86, shortest: int = 20,
        longest: int = 100, join_chars: int = 25, join_words: int = 4,
    ) -> None:
        if not markers or any(not m or "\n" in m or "\f" in m for m in markers):
            raise ValueError("page markers are lines with something in them")
        if window < 1 or pages < 2 or not 0 < fraction <= 1 or not 0 <= fuzzy <= 100:
            raise ValueError("window from 1, pages from 2, a fraction in (0, 1], a likeness in 0..100")
        self.markers, self.window, self.pages, self.fraction, self.fuzzy = tuple(markers), window, pages, fraction, fuzzy
        self.shortest, self.longest, self.join_chars, self.join_words = shortest, longest, join_chars, join_words

    def needed(self, pages: int) -> int:
        """On how many pages a line has to stand."""
        return max(self.pages, math.ceil(pages * self.fraction))

    def near(self, a: str, b: str) -> bool:
        return indel_ratio(a, b) >= self.fuzzy


def split_pages(text: str, markers: tuple[str, ...]) -> list[list[str]]:
    """The lines of every page, empty ones too; a form feed also parts a line."""
    pages: list[list[str]] = [[]]
    lines = text.split("\n")
    for k, line in enumerate(lines):
        if line.strip(" \t") in markers:
            pages.append([])
            if k == len(lines) - 1:
                pages[-1].append("")
            continue
        first, *others = line.split("\f")
        pages[-1].append(first)
        pages.extend([x] for x in others)
    return pages


class Edges:
    """The lines at the pages' edges: which lines are looked at, and what each of them could be."""

    _BARE = re.compile(r"\d{1,4}")
    _TITLED = re.compile(r"(.{4,75}?)[\s.·…-]+(\d{1,4})")

    def __init__(self, pages: list[list[str]], rules: PageRules) -> None:
        self.rules, self.pages = rules, pages
        solid = [[i for i, x in enumerate(page) if x.strip()] for page in pages]
        self.head = [s[: rules.window] for s in solid]
        self.foot = [s[-rules.window :] for s in solid]
        self.number: dict[tuple[int, int], tuple[int, str]] = {}
        for p, i in self.places():
            found = self._numbered(pages[p][i].strip())
            if found:
                self.number[p, i] = found
        self.support = {side: self._furniture(at) for side, at in (("header", self.head), ("footer", self.foot))} if len(pages) >= rules.pages else {"header": {}, "footer": {}}
        self.expected, self.titles = self._sequence()

    def places(self):
        for p, (head, foot) in enumerate(zip(self.head, self.foot)):
            for i in sorted({*head, *foot}):
                yield p, i

    def _numbered(self, line: str) -> tuple[int, str] | None:
        """The page number that a line is, or ends in behind a title, and the title's signature."""
        if self._BARE.fullmatch(line):
            return int(line), ""
        m = self._TITLED.fullmatch(line)
        title = furniture_signature(m[1]) if m else ""
        return (int(m[2]), title) if any(map(str.isalpha, title)) else None

    def _furniture(self, at: list[list[int]]) -> dict[str, float]:
        """Signatures of recurring lines with the share of pages that their kind stands on."""
        rules, need = self.rules, self.rules.needed(len(self.pages))
        on: dict[str, set[int]] = defaultdict(set)
        with_digits: dict[str, dict[tuple, set[int]]] = defaultdict(lambda: defaultdict(set))
        for p, places in enumerate(at):
            for i in places:
                line = self.pages[p][i]
                bare = line.strip()
                if not rules.shortest <= len(bare) <= rules.longest or bare.endswith((".", "!", "?", ";", ":")):
                    continue
                sig = furniture_signature(bare)
                if len(sig.split()) >= 3:
                    on[sig].add(p)
                    with_digits[sig][tuple(re.findall(r"\d+", line))].add(p)
        # a line with numbers in it recurs with the same numbers
        usable = [s for s in on if not any(map(str.isdigit, s)) or max(map(len, with_digits[s].values())) >= need]
        kinds: list[list[str]] = []
        for sig in sorted(usable, key=lambda s: (-len(on[s]), s)):
            own = next((k for k in kinds if abs(len(sig) - len(k[0])) <= max(5, 0.2 * len(k[0])) and rules.near(sig, k[0])), None)
            own.append(sig) if own else kinds.append([sig])
        out: dict[str, float] = {}
        for kind in kinds:
            held = set().union(*(on[s] for s in kind))
            if len(held) >= need:
                out.update(dict.fromkeys(kind, len(held) / len(self.pages)))
        return out

    def _sequence(self) -> tuple[dict[int, int], set[str]]:
        """The number that each page should bear, and the titles that may stand before it.

        Numbers keep their distance to the page's place.  Another distance holds where the first
        lines of several pages in a row keep it (a page was left out or taken together).
        """
        rules, count = self.rules, len(self.pages)
        distance = Counter(n - p for (p, _), (n, _) in self.number.items())
        if not distance:
            return {}, set()
        most = max(distance.values())
        if most < rules.pages:
            return {}, set()
        main = min(d for d, k in distance.items() if k == most)
        on: dict[str, set[int]] = defaultdict(set)
        for (p, _), (_, title) in self.number.items():
            if title:
                on[title].add(p)
        titles = {t for t, held in on.items() if len(held) >= rules.needed(count)}
        expected = {p: p + main for p in range(count)}

        def leading(p: int) -> int | None:
            n, title = self.number.get((p, self.head[p][0]), (None, "")) if self.head[p] else (None, "")
            return n - p if n is not None and (not title or title in titles) else None

        for d, run in groupby(range(count), key=leading):
            held = list(run)
            if d is not None and d != main and len(held) >= rules.pages:
                expected.update({p: p + d for p in held})
        return expected, titles

    def is_number(self, p: int, i: int) -> bool:
        n, title = self.number.get((p, i), (None, ""))
        return n is not None and self.expected.get(p) == n and (not title or title in self.titles)

    def pasted_foot(self, line: str) -> tuple[str, float] | None:
        """What stands before a running foot that follows an ellipsis in its line, and the foot's support."""
        m = re.match(r"^(.*?)(?:\.{2,}|…)[ \t]*([^\n]{20,100})$", line)
        if not m or not m[1].strip():
            return None
        tail = furniture_signature(m[2])
        found = next((share for sig, share in self.support["footer"].items() if self.rules.near(tail, sig)), None)
        return None if found is None else (m[1].rstrip(), found)


def repair_pages(text: str, rules: PageRules | None = None) -> tuple[str, Tally]:
    """Running heads, feet and page numbers go, and pages are put together again.

    Evidence: 0.95 for a number in its sequence, half and half of the support for a running line,
    three quarters and a quarter of it for a pasted foot, 0.9 for a sentence joined over a break.
    """
    rules = rules or PageRules()
    pages = split_pages(text, rules.markers)
    tally = Tally(pages_detected=len(pages), page_boundaries_detected=len(pages) - 1)
    edges = Edges(pages, rules)
    gone: set[tuple[int, int]] = set()
    for p, i in edges.places():
        if edges.is_number(p, i):
            gone.add((p, i))
            tally.note("page_numbers_removed", 0.95)
            continue
        sig = furniture_signature(pages[p][i])
        sides = [side for side, at in (("header", edges.head), ("footer", edges.foot)) if i in at[p]]
        side = next((side for side in sides if sig in edges.support[side]), None)
        if side:
            gone.add((p, i))
            tally.note(f"{side}s_removed", 0.5 + 0.5 * edges.support[side][sig])
        elif "footer" in sides:
            pasted = edges.pasted_foot(pages[p][i])
            if pasted:
                pages[p][i] = pasted[0]
                tally.note("footers_removed", 0.75 + 0.25 * pasted[1])
    out = ""
    for p, page in enumerate(pages):
        body = "\n".join(x for i, x in enumerate(page) if (p, i) not in gone).strip("\n")
        if not body:
            continue
        if not out:
            out = body
        elif _goes_on(out.rsplit("\n", 1)[-1].strip(), body.split("\n", 1)[0].strip(), rules):
            out = f"{out.rstrip()} {body.lstrip()}"
            tally.note("boundary_joins", 0.9)
        else:
            out = f"{out.rstrip()}\n\n{body.lstrip()}"
    return out, tally


def _goes_on(left: str, right: str, rules: PageRules) -> bool:
    """Whether a page's last line, long enough and ending in a letter, goes on in small letters."""
    if len(left) < rules.join_chars or len(left.split()) < rules.join_words or not right:
        return False
    return left[-1].isalpha() and right[0].isalpha() and right[0].islower()


def repair_page_structure(df: DataFrame, text: str = "text", rules: PageRules | None = None) -> DataFrame:
    fields = ("pages_detected", "page_boundaries_detected", "headers_removed", "footers_removed", "page_numbers_removed", "boundary_joins")
    return _apply(df, text, fields, lambda t: repair_pages(t, rules))


def _bare(value: str) -> str:
    return " ".join(value.split())


def repair_spans(text: str, chars: int = 100, words: int = 15, window: int = 6, low: int = 2, high: int = 5, line_window: int = 30) -> tuple[str, Tally]:
    """Long paragraphs that repeat one of the last few, then spans of lines that repeat near ones.

    Blanks do not count.  Paragraphs are put together with one empty line between them.  Spans are
    sought longest first over the whole text, among lines that are still there, each against the
    nearest earlier one.
    """
    blocks, kept, last = re.split(r"\n[ \t]*\n+", text), [], {}
    for i, block in enumerate(blocks):
        key = _bare(block)
        long = len(key) >= chars and len(key.split()) >= words
        if not (long and i - last.get(key, i - window - 1) <= window):
            kept.append(block)
        if long:
            last[key] = i
    removed = len(blocks) - len(kept)

    lines = "\n\n".join(kept).split("\n")
    bare = [_bare(x) for x in lines]
    number: dict[str, int] = {}
    ids = [number.setdefault(x, len(number)) for x in bare]
    weight = np.concatenate([[[0, 0]], np.cumsum([[len(x), len(x.split())] for x in bare], axis=0)])
    there = [bool(x) for x in bare]  # neither empty nor removed
    blank = [not x for x in bare]
    for size in range(high, low - 1, -1):
        at: dict[tuple[int, ...], list[int]] = defaultdict(list)
        long = (weight[size:] - weight[:-size] >= (chars, words)).all(axis=1) if len(lines) >= size else np.empty(0, dtype=bool)
        for k in np.flatnonzero(long).tolist():
            if not all(there[k : k + size]):
                continue
            earlier = at[tuple(ids[k : k + size])]
            if any(k - line_window <= e <= k - size and all(there[e : e + size]) for e in reversed(earlier[-line_window:])):
                there[k : k + size] = [False] * size
                removed += 1
            else:
                earlier.append(k)
    tally = Tally()
    if removed:
        tally.note("duplicate_blocks_removed", 1.0, removed)
    return "\n".join(x for x, ok, empty in zip(lines, there, blank) if ok or empty), tally


def repair_local_spans(df: DataFrame, text: str = "text") -> DataFrame:
    return _apply(df, text, ("duplicate_blocks_removed",), repair_spans)


def _loops(words: list[str], begin: np.ndarray, end: np.ndarray, low: int, high: int, span_chars: int, repeats: int, run_chars: int) -> tuple[np.ndarray, ...]:
    """For every word the most characters that a loop beginning there can lose, with its period and times.

    For each period, how far words equal those one period on is read off for all places at once.
    """
    n = len(words)
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=n)
    gain, period, times = (np.zeros(n, dtype=np.int64) for _ in range(3))
    for p in range(low, min(high, n // repeats) + 1):
        same = ids[:-p] == ids[p:]
        stop = np.minimum.accumulate(np.where(same, len(same), np.arange(len(same)))[::-1])[::-1]
        k = (stop - np.arange(len(same))) // p + 1
        at = np.flatnonzero((k >= repeats) & (end[p - 1 : p - 1 + len(same)] - begin[: len(same)] >= span_chars))
        lost = end[at + k[at] * p - 1] - end[at + p - 1]
        better = (lost >= run_chars) & (lost > gain[at])
        at, lost = at[better], lost[better]
        gain[at], period[at], times[at] = lost, p, k[at]
    return gain, period, times


def repair_loops(text: str, line_chars: int = 1000, low: int = 4, high: int = 40, span_chars: int = 35, repeats: int = 4, run_chars: int = 120) -> tuple[str, Tally]:
    """In very long lines, phrases said many times in a row are said once; spacing stays as it is."""
    tally = Tally()
    out = []
    for line in text.split("\n"):
        found = list(re.finditer(r"\S+", line)) if len(line) >= line_chars else []
        if len(found) < low * repeats:
            out.append(line)
            continue
        begin, end = (np.array([m.span()[k] for m in found]) for k in (0, 1))
        gain, period, times = _loops([m[0] for m in found], begin, end, low, high, span_chars, repeats, run_chars)
        parts, cursor, at = [], 0, 0
        for k in np.flatnonzero(gain).tolist():
            if k < at:
                continue
            p, n = int(period[k]), int(times[k])
            parts.append(line[cursor : end[k + p - 1]])
            cursor, at = int(end[k + p * n - 1]), k + p * n
            tally.note("long_line_loops_removed", 0.98)
            tally["loop_chars_removed"] += int(gain[k])
        out.append("".join([*parts, line[cursor:]]))
    return "\n".join(out), tally


def repair_line_loops(df: DataFrame, text: str = "text") -> DataFrame:
    return _apply(df, text, ("long_line_loops_removed", "loop_chars_removed"), repair_loops)


def repair_book(df: DataFrame, text: str = "text", rules: PageRules | None = None, images: bool = True, loops: bool = True, **unicode_options) -> DataFrame:
    """All repairs in their order, and the completed record."""
    df = normalize_unicode(start(df, text), text, **unicode_options)
    if images:
        df = remove_images(df, text)
    df = repair_local_spans(repair_page_structure(df, text, rules), text)
    if loops:
        df = repair_line_loops(df, text)
    return metrics(df, text)
