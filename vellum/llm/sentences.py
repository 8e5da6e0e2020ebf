"""Sentence boundaries across languages and scripts, in SQL expressions only.

Every step keeps the number of characters: a mark that ends nothing (in decimals, addresses,
initials, abbreviations, speech) is replaced by one private-use character of its own, boundaries are
then set by the terminators of the text's script, and the marks come back by ``translate``.
Positions in the result are therefore positions in the source.

Rules.  An empty line ends a unit, a line break alone does not.  Speech and the words that report it
are one unit: marks inside a closed quotation end nothing, its end does if a new sentence follows.
A pause ends nothing unless a sentence begins after it.  Thai has no stop: its units are parted by
blanks that have no digit beside them.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from ..session import materialize

CUT = "\uf8ff"
MARKS = ".!?…。！？।؟．۔‥"
MASKED = "".join(chr(0xE000 + k) for k in range(len(MARKS)))
DOT = MASKED[0]

#: Abbreviations that never end a sentence, by language of use.
ABBREVIATIONS = (
    "Mr", "Mrs", "Ms", "Messrs", "Dr", "Prof", "Rev", "Hon", "Capt", "Col", "Gen", "Lt", "Sgt", "St", "Mt", "No", "Nos", "vol", "vols",
    "Fig", "fig", "Figs", "figs", "cf", "approx", "ca", "pp", "ed", "eds", "viz", "vs", "ch", "chap", "sec",
    "Nr", "Bd", "Hr", "Fr", "Frl", "vgl", "bzw", "sog", "Abb", "Kap", "Str", "geb", "gest", "evtl", "Hrsg",
    "Mme", "Mlle", "MM", "Mgr", "av", "env", "éd", "n°",
    "Sr", "Sra", "Dra", "Lic", "Ing", "Srta", "Dña", "núm", "pág", "págs", "aprox", "Ud", "Uds", "Av", "Avda",
    "см", "стр", "гл", "рис", "ул", "им", "проф", "акад", "напр", "св", "ср", "тыс",
)
#: Abbreviations of several letters with stops that never end a sentence.
LETTERED = ("z. B", "d. h", "u. a", "o. ä", "i. e", "e. g", "p. ej", "c. à-d", "т. е", "т. к", "т. н", "N. B")
#: Words before a number with a stop that is a day of the month.
BEFORE_DAY = ("am", "Am", "vom", "Vom", "zum", "Zum", "bis", "Bis", "dem", "Dem", "den", "der", "Der", "ab")

_QUOTED = (("„", "“”"), ("“", "”"), ("«", "»"), ("「", "」"), ("『", "』"), ("‹", "›"))
_OPENERS = "„“«「『‹\"¿¡(\\[‘"
_CLOSERS = "”»“」』›\"’)\\]"


def _alternatives(words: tuple[str, ...]) -> str:
    return "|".join(re.escape(w).replace("\\ ", "\\s?") for w in sorted(words, key=len, reverse=True))


def masked(text: Column) -> Column:
    """Marks that end nothing become private-use characters, one for one."""
    x = F.translate(text, CUT + MASKED, " " * (1 + len(MASKED)))
    # addresses
    x = F.regexp_replace(x, r"\.(?=\w)(?<=\w\.)", DOT)
    # Each rule finds the stop first and then looks back, so a text costs little more than its stops.
    alone = r"(?<!\w)"
    # initials, single letters before a stop in Arabic and Devanagari text, and abbreviations
    x = F.regexp_replace(x, rf"(?U)\.(?=\s?\p{{L}}\.)(?<={alone}\p{{Ll}}\.)", DOT)
    initial = rf"(?=\s*[\p{{L}}\d])(?<=(?<![\w{DOT}])[\p{{Lu}}\p{{InArabic}}]\.)"
    x = F.regexp_replace(x, rf"(?U)\.(?:{initial}|(?=\s)(?<={alone}(?:{_alternatives(ABBREVIATIONS)})\.))", DOT)
    # lettered abbreviations; short Devanagari words; page, section, number before a number; days of the month
    lettered = rf"(?=\s)(?<={alone}(?:{_alternatives(LETTERED)})\.)"
    short = rf"(?=\s)(?<={alone}\p{{InDevanagari}}{{1,3}}\.)"
    number = rf"(?=\s*[\d(])(?<={alone}(?:\p{{L}}|no|nos|art|arts|par)\.)"
    day = rf"(?=\s+\p{{L}})(?<=\b(?:{'|'.join(BEFORE_DAY)})\s\d{{1,2}}\.)"
    x = F.regexp_replace(x, rf"(?U)\.(?:{lettered}|{short}|{number}|{day})", DOT)
    # marks inside closed quotations
    spans = "|".join(f"{re.escape(a)}[^{re.escape(a + b)}\\n]*+(?:\\n(?!\\s*\\n)[^{re.escape(a + b)}\\n]*+)*+[{re.escape(b)}]" for a, b in _QUOTED)
    first = "".join(a for a, _ in _QUOTED)
    segments = F.regexp_extract_all(x, F.lit(f"(?s)(?:{spans}|[^{first}]+|.)"), F.lit(0))
    quoted = F.transform(segments, lambda s: F.when(F.length(s) > 1, F.when(F.substring(s, 1, 1).isin(*first), F.translate(s, MARKS, MASKED)).otherwise(s)).otherwise(s))
    return F.when(x.rlike(f"[{first}]"), F.array_join(quoted, "")).otherwise(x)


def restored(x: Column) -> Column:
    return F.translate(x, MASKED, MARKS)


_THAI, _HAN, _CASELESS = r"฀-๿", r"぀-ヿ㐀-鿿豈-﫿", r"؀-ۿݐ-ݿऀ-෿"


def script(text: Column) -> Column:
    """``thai``, ``han`` (Chinese and Japanese), ``caseless`` (Arabic, Devanagari) or ``cased``."""

    def by_share(solid: Column) -> Column:
        def most(kept: str) -> Column:
            return (F.length(text) - F.length(F.regexp_replace(text, f"[{kept}]+", ""))) / F.greatest(F.lit(1), solid) > 0.5

        return F.when(most(_THAI), "thai").when(most(_HAN), "han").when(most(_CASELESS), "caseless").otherwise("cased")

    solid = F.length(F.regexp_replace(text, r"(?U)[\s\d\p{P}]+", ""))
    return F.when(text.rlike(f"[{_THAI}{_HAN}{_CASELESS}]"), let(solid, by_share)).otherwise("cased")


_HAN_CLOSERS = "」』”’）)】》"
_INNER = f"[{MASKED}](?=[ \\u00a0\\u202f]?[”»“」』›\"])"
_TAIL = f"[{_CLOSERS}]*+(?:[ \\u00a0\\u202f][”»›][{_CLOSERS}]*+)?"
#: Words that go on after speech in Chinese, where no blank tells.
_GO_ON = "然后|于是|接着|便|就|并|而|[，、；：]"


def _cuts(x: Column, kind: Column) -> Column:
    """Set the boundary character after each unit."""
    empty_line = F.regexp_replace(x, r"(?U)(?=\s)(?=[^\S\n]*+\n\s*\n)(?<=\S)", CUT)
    cased = F.regexp_replace(
        empty_line,
        rf"(?U)(?=[.!?…{MASKED}])(?<![.!?…])((?:[.!?…]++|{_INNER})+{_TAIL})(?=\s+[{_OPENERS}\s]*[\p{{Lu}}\d])",
        "$1" + CUT,
    )
    caseless = F.regexp_replace(
        empty_line, rf"(?U)(?=[.।؟!?۔{MASKED}])(?<![।؟!?۔])((?:[।؟!?۔]++|(?<![{DOT}\p{{Nd}}])\.|{_INNER}(?=[{_CLOSERS}]+\s+[{_OPENERS}]))+{_TAIL})(?=\s)", "$1" + CUT
    )
    han = F.regexp_replace(empty_line, rf"(?s)(?=[。！？．.!?])(?<![。！？．])((?:[。！？．]++|[.!?](?=\s))+[{_HAN_CLOSERS}]*)(?=.)", "$1" + CUT)
    han = F.regexp_replace(han, rf"(?s)((?<=[：:])“[^”]*[{MASKED}]”)(?!{_GO_ON})(?=.)", "$1" + CUT)
    thai = F.regexp_replace(empty_line, r"(?U)(?<=[^\s\d])(?=\s+[^\s\d])", CUT)
    return F.when(kind == "thai", thai).when(kind == "han", han).when(kind == "caseless", caseless).otherwise(cased)


#: Pieces handled by one inner aggregation; its cost grows with the square of this, not of the text.
BLOCK = 128
_UNIT = "array<struct<end_pos:int,unit:string>>"
#: White space and the byte-order mark, for trimming without a regular expression.
_BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"


def _block_starts(blocks: Column) -> Column:
    """Where each block of pieces starts in the text, and where the last one ends."""
    start = F.struct(F.lit(0).alias("at"), F.array(F.lit(0)).alias("out"))

    def step(acc: Column, block: Column) -> Column:
        to = acc["at"] + F.aggregate(block, F.lit(0), lambda n, piece: n + F.length(piece))
        return F.struct(to.alias("at"), F.array_append(acc["out"], to).alias("out"))

    return F.aggregate(blocks, start, step, lambda acc: acc["out"])


def _block_units(block: Column, at: Column) -> Column:
    start = F.struct(at.alias("at"), F.array().cast(_UNIT).alias("out"))

    def step(acc: Column, piece: Column) -> Column:
        bare = F.rtrim(piece, F.lit(_BLANKS))
        one = F.struct((acc["at"] + F.length(bare)).alias("end_pos"), F.ltrim(bare, F.lit(_BLANKS)).alias("unit"))
        out = F.when(F.length(bare) > 0, F.array_append(acc["out"], one)).otherwise(acc["out"])
        return F.struct((acc["at"] + F.length(piece)).alias("at"), out.alias("out"))

    return F.aggregate(block, start, step, lambda acc: acc["out"])


def units(text: Column, kind: Column) -> Column:
    """``array<struct<end_pos int, unit string>>`` of the text's sentence units, in order.

    The marks are restored in the whole text before it is parted.  Pieces are taken in blocks of
    ``BLOCK`` with the blocks' starts summed up first, as appending to one array for every piece of
    a book would copy it each time.
    """
    pieces = F.split(restored(_cuts(masked(text), kind)), CUT, -1)

    def in_blocks(p: Column) -> Column:
        index = F.sequence(F.lit(0), F.floor((F.size(p) - 1) / BLOCK).cast("int"))
        return F.transform(index, lambda k: F.slice(p, k * BLOCK + 1, F.lit(BLOCK)))

    def from_blocks(blocks: Column) -> Column:
        return let(_block_starts(blocks), lambda starts: F.flatten(F.transform(blocks, lambda block, k: _block_units(block, F.get(starts, k)))))

    return let(pieces, lambda p: let(in_blocks(p), from_blocks))


def _once(documents: DataFrame) -> DataFrame:
    """One row for each id.  Ids alone are counted; only texts of repeated ids are shuffled."""
    doubled = materialize(documents.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "doubled")
    if doubled.isEmpty():
        return documents
    twice = documents.join(doubled, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return documents.join(doubled, "doc_id", "left_anti").unionByName(twice)


def split_sentences(documents: DataFrame) -> DataFrame:
    """``(doc_id, position, end_pos, unit)``: the sentence units of every document.

    ``position`` counts from 0, ``end_pos`` is the number of characters from the text's start
    through the unit's last non-blank one.  Null and blank texts and rows without an id have no
    unit; repeated rows count once; an empty table gives no rows.
    """
    base = _once(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null and doc_id is not null"))
    found = base.withColumn("kind", script(F.col("text"))).select("doc_id", F.posexplode(units(F.col("text"), F.col("kind"))).alias("position", "u"))
    return found.select("doc_id", F.col("position").cast("int").alias("position"), F.col("u.end_pos").alias("end_pos"), F.col("u.unit").alias("unit"))


def sample_ends(documents: DataFrame, sample: DataFrame) -> DataFrame:
    """``(doc_id, end_pos)`` for the documents that ``sample`` names."""
    asked = sample.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    return split_sentences(documents.select("doc_id", "text").join(asked, "doc_id", "left_semi")).select("doc_id", "end_pos")
