"""Decontamination: documents that share a word n-gram with evaluation texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import materialize, spread
from .kernels import Bitmap, bitmap_of, gram_hashes


def _words(df: DataFrame, key: str, text: str, marks: bool) -> DataFrame:
    shaped = df.select(key, X.simplify(F.col(text), marks=marks).alias("s"))
    return shaped.select(key, X.words(F.col("s")).alias("w"))


def _grams(df: DataFrame, n: int, key: str, kind: str, bitmap=None) -> DataFrame:
    """``(key, pos, h, ngram)`` of the n-grams, of those that the bitmap may hold if there is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, at, hashes, grams = [], [], [], []
            for k, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h = gram_hashes(w or [], n)
                hit = np.arange(len(h)) if bitmap is None else Bitmap(bitmap.value).may_hold(h)
                keys += [k] * len(hit)
                at += hit.tolist()
                hashes.append(h[hit])
                grams += [" ".join(w[i : i + n]) for i in hit.tolist()]
            flat = np.concatenate(hashes).view(np.int64) if hashes else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema.field(0).type), pa.array(at, pa.int32()), pa.array(flat), pa.array(grams, pa.string())], [key, "pos", "h", "ngram"])

    return df.mapInArrow(run, f"`{key}` {kind}, pos int, h long, ngram string")


def ngram_index(items: DataFrame, key: str = "item_id", text: str = "text", task: str | None = "task", n: int = 12, marks: bool = True) -> DataFrame:
    """``(h, contaminated_task)``: hashes of the items' n-grams; of several tasks the least name.

    Items without a task count under the empty name; null and short texts have no n-gram.
    """
    name = F.coalesce(F.col(task).cast("string"), F.lit("")) if task else F.lit("")
    named = items.select(name.alias("_task"), F.col(text).alias("_text"))
    grams = _grams(_words(named, "_task", "_text", marks), n, "_task", "string")
    return grams.groupBy("h").agg(F.min("_task").alias("contaminated_task"))


def pair_index(
    items: DataFrame, label: str, query: str, key: str = "item_id", task: str | None = "task", n: int = 12, query_grams: bool = False, overlap_grams: bool = True, marks: bool = True
) -> DataFrame:
    """``(h, contaminated_task)`` of questions with answers: n-grams of the label, of the query if
    asked for, and those that begin in the query and end in the label."""
    name = F.coalesce(F.col(task).cast("string"), F.lit("")) if task else F.lit("")
    named = items.select(name.alias("_task"), *[X.words(X.simplify(F.col(c), marks=marks)).alias(a) for c, a in ((label, "l"), (query, "q"))])
    seam = F.concat(F.slice("q", F.greatest(F.lit(1), F.size("q") - n + 2), F.lit(n - 1)), F.slice("l", 1, n - 1))
    texts = [F.col("l"), *([F.col("q")] if query_grams else [])]
    # every n-gram of the seam has words of both sides
    texts += [F.when(F.col("q").isNotNull() & F.col("l").isNotNull(), seam)] if overlap_grams else []
    flat = named.select("_task", F.explode(F.array(*texts)).alias("w"))
    return _grams(flat, n, "_task", "string").groupBy("h").agg(F.min("_task").alias("contaminated_task"))


def contaminated(df: DataFrame, index: DataFrame, key: str = "doc_id", text: str = "text", n: int = 12, marks: bool = True) -> DataFrame:
    """``(key, contaminated_ngram, contaminated_task, filter_reason)``: each document that has an
    n-gram of the index, with the first one in its text.

    A bitmap over the index thins out the corpus' n-grams where they are made, so only hits (and
    one false one in some hundred) are shuffled; the join with the index decides.
    """
    index = materialize(index, "ngram_index")
    bitmap = df.sparkSession.sparkContext.broadcast(bitmap_of(index))
    grams = _grams(_words(spread(df.select(key, text)), key, text, marks), n, key, dict(df.dtypes)[key], bitmap)
    hit = grams.join(index, "h").groupBy(key).agg(F.min(F.struct("pos", "ngram", "contaminated_task")).alias("m"))
    return hit.select(key, F.col("m.ngram").alias("contaminated_ngram"), F.col("m.contaminated_task").alias("contaminated_task"), F.lit("contaminated").alias("filter_reason"))
