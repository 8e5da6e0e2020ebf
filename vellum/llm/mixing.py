"""Mixing sources to target weights.

Every document gets a hash-random key (of its id and the seed, by SHA-1); within its source the keys' order is the order of drawing.
Keys are cut into ranges, each range's size is summed, ranges are summed up within the source
(a table of ``sources x ranges`` rows), and positions inside a range come from a window over that
range alone, so no task holds a whole source.  A source's budget is its share of the total size;
whole epochs come first, the last one is cut where the prefix sum would pass the budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import sha1_64

#: Documents of a range on average; their number follows from it, so no range grows with the corpus.
RANGE_DOCS = 1 << 16


def canonical_source(source: Column) -> Column:
    """Case, outer blanks and blank-or-underscore do not count; nothing left is null."""
    bare = F.regexp_replace(F.lower(source), r"(?U)^\s+|\s+$", "")
    return F.nullif(F.regexp_replace(bare, r"(?U)\s", "_"), F.lit(""))


def sized(documents: DataFrame, size: Column, doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """``(doc_id, source, size)`` of the documents with a source; a null size counts 0."""
    return documents.select(
        F.col(doc_id).alias("doc_id"),
        canonical_source(F.col(source)).alias("source"),
        F.coalesce(size.cast("long"), F.lit(0).cast("long")).alias("size"),
    ).where(F.col("source").isNotNull())


def _range_bits(items: DataFrame) -> int:
    """Keys are hashes, so a range of the leading bits holds its share of a source's documents."""
    return max(4, (items.count() // RANGE_DOCS).bit_length())


def _ranges(items: DataFrame, seed: int) -> DataFrame:
    key = sha1_64(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")))
    return items.withColumn("key", key).withColumn("range", F.shiftrightunsigned("key", 64 - _range_bits(items)))


def _range_sums(keyed: DataFrame) -> DataFrame:
    """Size before each range of each source, and the source's whole size and count."""
    sums = keyed.groupBy("source", "range").agg(F.sum("size").alias("range_size"), F.count(F.lit(1)).alias("range_docs"))
    whole = Window.partitionBy("source")
    upto = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return sums.select(
        "source",
        "range",
        (F.sum("range_size").over(upto) - F.col("range_size")).alias("before"),
        F.sum("range_size").over(whole).alias("own_size"),
        F.sum("range_docs").over(whole).alias("own_docs"),
    )


def plan(items: DataFrame, targets: DataFrame, seed: int = 0) -> DataFrame:
    """One row per target source: own size, budget, whole epochs, the rest to cut, reachability.

    Columns: source, target_share, max_repeats, own_size, own_docs, total, wanted, budget, epochs,
    rest, reachable.  ``items`` are those of :func:`sized`.  A source without documents has size
    0; with an empty item table every total is 0 and every source reachable.  Null share or
    repeats count as 0.
    """
    per = _range_sums(_ranges(items, seed)).groupBy("source").agg(
        F.max("own_size").alias("own_size"), F.max("own_docs").alias("own_docs")
    )
    zero = F.lit(0).cast("long")
    t = targets.select(
        "source",
        F.coalesce("target_share", F.lit(0.0)).alias("target_share"),
        F.coalesce("max_repeats", F.lit(0)).alias("max_repeats"),
    )
    joined = t.join(per, "source", "left").select(
        "source",
        "target_share",
        "max_repeats",
        F.coalesce("own_size", zero).alias("own_size"),
        F.coalesce("own_docs", zero).alias("own_docs"),
    )
    # the table of targets and nothing else is in one window here
    full = joined.withColumn("total", F.sum("own_size").over(Window.partitionBy(F.lit(1))))
    wanted = F.col("target_share") * F.col("total")
    most = (F.col("max_repeats") * F.col("own_size")).cast("double")
    budget = F.floor(F.least(wanted, most)).cast("long")
    return (
        full.withColumn("wanted", wanted)
        .withColumn("reachable", ~(wanted > most))
        .withColumn("budget", budget)
        .withColumn("epochs", F.when(F.col("own_size") > 0, F.floor(F.col("budget") / F.col("own_size"))).otherwise(zero))
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("own_size"))
    )


def mixture(items: DataFrame, targets: DataFrame, seed: int = 0) -> DataFrame:
    """``(source, doc_id, size, position, uses)`` of every document used at least once.

    ``position`` is the size before the document in its source's drawing order.  ``uses`` is the
    number of epochs in which it is taken; no use count passes ``max_repeats`` and no source its
    budget.  Ties of keys are broken by id.  Documents of size 0 are used as often as their place
    in the order is.
    """
    keyed = _ranges(items, seed)
    offsets = _range_sums(keyed).select("source", "range", "before")
    within = (
        Window.partitionBy("source", "range").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = (
        keyed.withColumn("upto", F.sum("size").over(within))
        .join(offsets, ["source", "range"])
        .withColumn("upto", F.col("upto") + F.col("before"))
    )
    p = plan(items, targets, seed).select("source", "epochs", "rest")
    uses = F.col("epochs") + F.when((F.col("upto") <= F.col("rest")) & (F.col("rest") > 0), 1).otherwise(0)
    return (
        placed.join(p, "source")
        .select("source", "doc_id", "size", (F.col("upto") - F.col("size")).alias("position"), uses.cast("long").alias("uses"))
        .where("uses > 0")
    )


def shares(items: DataFrame, targets: DataFrame, seed: int = 0) -> DataFrame:
    """Per target source what the mixture has: docs, uses, size used, the share reached."""
    got = mixture(items, targets, seed).groupBy("source").agg(
        F.count(F.lit(1)).alias("docs_used"),
        F.sum("uses").alias("uses"),
        F.sum(F.col("uses") * F.col("size")).alias("used_size"),
    )
    zero = F.lit(0).cast("long")
    p = plan(items, targets, seed).join(got, "source", "left")
    used = F.coalesce("used_size", zero)
    every = F.sum(used).over(Window.partitionBy(F.lit(1)))
    return p.select(
        "source", "target_share", "max_repeats", "own_size", "own_docs", "wanted", "budget", "reachable",
        F.coalesce("docs_used", zero).alias("docs_used"),
        F.coalesce("uses", zero).alias("uses"),
        used.alias("used_size"),
        F.when(every > 0, used / every).otherwise(F.lit(0.0)).alias("share_reached"),
    )


def unreachable(items: DataFrame, targets: DataFrame) -> DataFrame:
    """``(source)`` of the targets whose share of the total is beyond their capped size.

    They show in the mixture itself: every document is drawn ``max_repeats`` times, and the size
    drawn is still less than wanted.
    """
    drawn = shares(items, targets)
    return drawn.where((F.col("used_size") == F.col("max_repeats") * F.col("own_size")) & (F.col("used_size") < F.col("wanted"))).select("source")
