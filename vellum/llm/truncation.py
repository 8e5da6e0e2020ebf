"""Text cut off by field limits: length hazards, then incomplete endings.

The hazard of a length is the share of a source's texts that end there among those that reach it.
A field limit makes one length's hazard stand out from its neighbours'; each is tested against the
lengths around it (window functions over the counted lengths, in characters and in bytes), with
the Benjamini-Hochberg rule over all tests.  Whether a text is cut is then read off its ending:
at a significant length any ending without a stop will do, elsewhere (cuts in transfer) the text
must be running language with stops whose last unit has none and is no closing line.  Which lines
close a text (imprints, end marks) is learned from the corpus: a pattern of words that again and
again stands as an unstopped last line after a whole sentence, in texts that are no copies of one
another.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .kernel import fold_many
from .mixing import canonical_source

#: Lengths on either side that a hazard is held against, and the false-discovery rate.
NEIGHBOURS, RATE = 25, 0.001
#: Share of the documents (and least number) that make a last line's pattern a closing line.
CLOSER_SHARE, CLOSER_LEAST = 0.0002, 3

_STOP = ".!?…。！？।؟．۔‥"
_QUOTES = "\"'”»’“)]」』›"
_MID = re.compile(r"(?<![\d\s])[.!?।؟…۔](?=[\"'”»’“)\]]*\s+\S)|[。！？．](?=.)")
_PAGE = re.compile(
    r"^[\W_]*(?:p\.|pp\.|page|s\.|seite|pág\.|pag\.|с\.|стр\.|ص\.?|पृ\.?|頁|页|第)?[\W_]*(?:[0-9lIoOSsBZ|]{1,5}|[ivxlcIVXLC1]{1,8}|\d+\s*(?:頁|页|ページ))[\W_]*$",
    re.I,
)
def _page(line: str) -> bool:
    """A page number and nothing else; such lines are short."""
    return len(line) <= 40 and bool(_PAGE.match(line))


_SIGNED = re.compile(r"^[—–~―-]\s*\S")
_SPACED_STOP = re.compile(r"[\d" + re.escape(_STOP) + "]")
_TAILED = re.compile(r"[.!?…。！？।؟][\"'”»’“)\]]*\s+[—–\-\[(]*\s*\d{1,4}\s*[—–\-\])]*\s*$")
_THAI = re.compile(r"[฀-๿]")
_SPACELESS = re.compile(r"[぀-ヿ㐀-鿿]")
_NAMESEP = re.compile(r"^[—–~―-]?\s*[^\s。，、！？「」『』“”：]{1,12}[・·][^\s。，、！？「」『』“”：]{1,12}$")
ENDING = (
    "doc_id long, source string, chars long, bytes long, last string, pattern string, closer string, "
    "open boolean, running boolean, stops boolean, broken boolean, named boolean, after_stop boolean, "
    "content long"
)


def _ends(line: str) -> bool:
    bare = line.rstrip().rstrip(_QUOTES + "  　")
    return bool(bare) and bare[-1] in _STOP


def _titled(word: str) -> bool:
    return word[:1].isupper()


def pattern_of(line: str) -> str | None:
    """Words with capitals as X, digits as 0, the rest as it is; what could close a text, or None.

    Capitals alone and single words of scripts without capitals stand for themselves; other lines
    need two words in small letters.
    """
    if len(line) > 200:
        return None
    if line.isupper() and sum(map(str.isalpha, line)) >= 3:
        return line
    words = re.sub(r"\d+", "0", line).split()
    if len(words) == 1 and len(line) >= 3 and line.isalpha() and line.lower() == line.upper():
        return line
    small = sum(1 for w in words if w[:1].islower())
    return " ".join("X" if _titled(w.strip("“„«\"'([—-")) else w for w in words) if small >= 2 else None


def ending(text: str) -> tuple | None:
    """What the end of a text looks like; None for a blank text.

    ``last`` is the last line that is not blank, ``closer`` the pattern of the last one but for page
    numbers, if it has no stop and follows a whole sentence, ``open`` whether ``last`` ends without a stop,
    ``running`` whether the text is running language with stops inside its lines or at their ends,
    ``named`` whether the last line is nothing but names, ``broken`` whether the text breaks off
    in a replacement character, a comma or an opening mark.
    """
    lines = [x.strip() for x in text.split("\n")]
    lines = [x for x in lines if x]
    if not lines:
        return None
    last = lines[-1]
    bare = text.rstrip().rstrip(_QUOTES + "  　")
    solid = sum(map(len, text.split()))
    letters = sum(map(str.isalpha, text)) if solid else 0
    thai = len(_THAI.findall(text)) > 0.3 * solid
    mid = len(_MID.findall("\n".join(lines)))
    line_ends = sum(1 for x in lines[:-1] if _ends(x))
    spaceless = len(_SPACELESS.findall(text)) > 0.3 * solid
    words = len(text.split())
    marks = 0.35 if any("ऀ" <= c <= "ॿ" for c in last) else 0.6
    inside = sum(1 for x in lines if _MID.search(x))
    running = (
        not thai
        and letters >= marks * solid
        and (inside >= max(1, 0.15 * len(lines)) or (len(lines) > 1 and line_ends >= 0.6 * (len(lines) - 1)) or (len(lines) <= 2 and mid > 0))
        and (mid + line_ends) * (1 if spaceless else 60) >= (1 if spaceless else words)
    )
    pages = sum(1 for x in lines if _page(x))
    numbered = _page(last) and len(lines) > 1 and (pages > 1 or _ends(lines[-2]))
    open_ = bool(bare) and bare[-1] not in _STOP and not numbered and not _TAILED.search(last[-60:])
    feet = (x for x in reversed(lines) if not _page(x))
    foot, above = next(feet, ""), next(feet, "")
    closer = pattern_of(foot) if foot and not _ends(foot) and _ends(above) else None
    tail = last.rstrip(_QUOTES + " ").lstrip("—–~―- ")
    tail_words = tail.split()
    named = (
        0 < len(tail_words) <= 4 and all(_titled(w) and w.isalpha() and w[1:].islower() for w in tail_words)
        or bool(_NAMESEP.match(last))
        or bool(_SIGNED.match(last)) and len(tail_words) <= 4
        or last.isupper() and len(tail_words) <= 4 and len(last) >= 3
    )
    caseless = last.lower() == last.upper() and not spaceless and all(w.replace("‌", "").isprintable() for w in tail_words)
    if caseless and len(tail_words) == 2 and len(last) <= 25 and not any(c in ",،(" for c in last) and not _SPACED_STOP.search(last):
        named = True
    if spaceless and len(last) <= 6 and not any(c in "、，「（" for c in last):
        named = True
    broken = "�" in text[-3:] or (bool(bare) and bare[-1] in ",،、，;:")
    before = len(lines) > 1 and (_ends(lines[-2]) or _page(lines[-2]))
    repeated = len(last) >= 8 and last in lines[:-1]
    stops = mid + line_ends > 0 and letters >= marks * solid and (running or inside > 0)
    return last, pattern_of(last), closer, open_ and not repeated, running, stops, broken, named and len(lines) > 1, before


def _content(text: str) -> int:
    """A hash of N(text), the same for copies; of the text itself where N(text) is empty."""
    cp, _ = fold_many([text])
    raw = cp.tobytes() if len(cp) else text.encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def _endings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for key, text, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if text is None or key is None:
                continue
            found = ending(text)
            if found is not None:
                rows.append((key, source, len(text), len(text.encode("utf-8", "surrogatepass")), found[0][-200:], *found[1:], _content(text)))
        cols = list(zip(*rows)) if rows else [()] * 14
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), *([pa.bool_()] * 6), pa.int64()]
        names = [f.split()[0] for f in ENDING.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)


def endings(documents: DataFrame) -> DataFrame:
    source = canonical_source(F.col("source")) if "source" in documents.columns else F.lit(None).cast("string")
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", source.alias("source")).mapInArrow(_endings, ENDING)


def length_hazards(ends: DataFrame, neighbours: int = NEIGHBOURS) -> DataFrame:
    """Per source and unit (chars, bytes) every length that some text has: texts that end there,
    texts that reach it, hazard, hazard of the neighbouring lengths, and a bound of the probability
    of so many ends by chance (Chernoff, Poisson).
    """
    long = ends.select(
        F.coalesce("source", F.lit("")).alias("source"),
        F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("chars").alias("length")), F.struct(F.lit("bytes").alias("unit"), F.col("bytes").alias("length")))).alias("m"),
    ).select("source", "m.unit", "m.length")
    counted = long.groupBy("source", "unit", "length").agg(F.count(F.lit(1)).alias("ends"))
    per = Window.partitionBy("source", "unit").orderBy("length")
    reach = F.sum("ends").over(per.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    around = per.rangeBetween(-neighbours, neighbours)
    with_reach = counted.withColumn("reach", reach)
    near = F.sum("ends").over(around) - F.col("ends")
    expected = F.col("reach") * (near + 1) / (F.lit(2.0 * neighbours) * F.max("reach").over(around))
    d = F.col("ends").cast("double")
    mu = F.col("expected")
    tested = with_reach.withColumn("expected", expected)
    return (
        tested.withColumn("hazard", d / F.col("reach"))
        .withColumn("near_hazard", mu / F.col("reach"))
        .withColumn("log_p", F.when(d > mu, -(d * F.log(d / mu) - d + mu)).otherwise(0.0))
        .withColumn("p", F.exp("log_p"))
    )


def limits(ends: DataFrame, rate: float = RATE) -> DataFrame:
    """The significant lengths: Benjamini-Hochberg over all lengths tested.

    A length's rank is the number of tests whose p is no greater, so ties share theirs.  A p above
    ``rate`` cannot pass, whatever its rank; the rest is ranked by its distinct values.
    """
    tests = length_hazards(ends)
    total = tests.agg(F.count(F.lit(1)).alias("tests"))
    some = tests.where(F.col("p") < rate)
    values = some.groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    # one row for each different p of the few lengths that stand out
    ranked = values.withColumn("rank", F.sum("n").over(Window.partitionBy(F.lit(1)).orderBy("p"))).crossJoin(F.broadcast(total))
    last = ranked.where(F.col("p") <= F.col("rank") / F.col("tests") * rate).agg(F.max("p").alias("bar"))
    return some.crossJoin(F.broadcast(last)).where("p <= bar").select("source", "unit", "length", "ends", "reach", "hazard", "near_hazard", "p", "log_p")


def closers(ends: DataFrame, share: float = CLOSER_SHARE, least: int = CLOSER_LEAST) -> DataFrame:
    """Patterns of closing lines: of at most ``1 / share`` patterns, so a bounded table.

    Texts count, not rows: copies of one cut text would else teach its cut line.
    """
    texts = ends.where("closer is not null").select(F.col("closer").alias("pattern"), "content").distinct()
    found = texts.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    total = ends.select("content").distinct().agg(F.count(F.lit(1)).alias("docs"))
    return found.crossJoin(F.broadcast(total)).where((F.col("n") >= least) & (F.col("n") >= share * F.col("docs"))).select("pattern")


def _variants(pattern: Column) -> Column:
    """The pattern and, with four words or more, each of its forms with one small word left open."""
    words = F.split(pattern, " ")
    one_open = F.transform(
        F.sequence(F.lit(0), F.size(words) - 1),
        lambda k: F.array_join(F.transform(words, lambda w, i: F.when((i == k) & (w != "X"), "*").otherwise(w)), " "),
    )
    return F.array_distinct(F.when(F.size(words) >= 4, F.array_union(F.array(pattern), one_open)).otherwise(F.array(pattern)))


def closing_lines(ends: DataFrame) -> DataFrame:
    """``(doc_id, closing)`` of the texts whose open last line is a closing line, one misread word allowed."""
    known = closers(ends).select(F.explode(_variants(F.col("pattern"))).alias("form")).distinct()
    asked = ends.where("open and pattern is not null").select("doc_id", F.explode(_variants(F.col("pattern"))).alias("form"))
    return asked.join(known, "form", "left_semi").select("doc_id").distinct().withColumn("closing", F.lit(True))


def reason() -> Column:
    """Why a text counts as cut, over an ending, ``at_limit`` and ``closing``; null if it does not.

    ``limit``: it ends at a significant length, without a stop.  ``broken``: it breaks off in a
    replacement character, a comma or an opening mark.  ``transfer``: running language that ends
    without a stop and not in a closing line; cuts in transfer have no length in common.
    """
    sentence = F.col("open") & ~F.col("closing")
    at_limit = F.col("at_limit") & sentence & (F.col("running") | F.col("stops"))
    in_transfer = F.col("running") & sentence & ~(F.col("named") & F.col("after_stop"))
    return F.when(at_limit, "limit").when(F.col("broken") & F.col("running"), "broken").when(in_transfer, "transfer")


def judged(documents: DataFrame) -> DataFrame:
    """Every text's ending with ``at_limit``, ``closing``, ``reason`` and ``cut``."""
    from ..session import materialize

    ends = materialize(endings(documents), "endings")
    found = limits(ends).select("source", "unit", "length").distinct()
    wide = F.coalesce("source", F.lit(""))
    chars = found.where("unit = 'chars'").select(F.col("source").alias("s1"), F.col("length").alias("l1"))
    byte = found.where("unit = 'bytes'").select(F.col("source").alias("s2"), F.col("length").alias("l2"))
    return (
        ends.withColumn("s", wide)
        .join(chars, (F.col("s") == F.col("s1")) & (F.col("chars") == F.col("l1")), "left")
        .join(byte, (F.col("s") == F.col("s2")) & (F.col("bytes") == F.col("l2")), "left")
        .join(closing_lines(ends), "doc_id", "left")
        .withColumn("closing", F.coalesce("closing", F.lit(False)))
        .withColumn("at_limit", F.col("l1").isNotNull() | F.col("l2").isNotNull())
        .withColumn("reason", reason())
        .withColumn("cut", F.col("reason").isNotNull())
        .drop("s", "s1", "s2", "l1", "l2", "content")
    )


def truncated(documents: DataFrame) -> DataFrame:
    """``(doc_id)`` of the texts that were cut off.

    Null and blank texts are no case; a repeated row counts once; an empty table gives no rows.
    """
    return judged(documents).where("cut").select("doc_id").distinct()


def rates(documents: DataFrame) -> DataFrame:
    """Per source: texts, texts cut off, their share, and how many for each reason."""

    def number(why: str) -> Column:
        return F.sum((F.coalesce("reason", F.lit("")) == why).cast("long"))

    return (
        judged(documents)
        .groupBy(F.coalesce("source", F.lit("")).alias("source"))
        .agg(
            F.count(F.lit(1)).alias("texts"),
            F.sum(F.col("cut").cast("long")).alias("cut"),
            F.round(F.avg(F.col("cut").cast("double")), 6).alias("cut_rate"),
            number("limit").alias("cut_at_limit"),
            number("broken").alias("cut_broken"),
            number("transfer").alias("cut_in_transfer"),
        )
    )
