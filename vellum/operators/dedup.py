"""Exact, sentence, near (MinHash), first-seen and substring duplicates.

Winners come from partial aggregations (the least of a key by map-side combine) joined back, not
from windows over a key: a key that a third of all rows share is then never one task's work.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..session import spread
from .components import connected_components

# -- exact ---------------------------------------------------------------------------------------


def exact_groups(df: DataFrame, content: Column, order: str = "doc_id", priority: Column | None = None) -> DataFrame:
    """``df`` with the content's hash, the surviving row of it and the number of its rows.

    The survivor has the highest priority, among equals the lowest ``order``.
    """
    rank = F.struct((-(priority if priority is not None else F.lit(1)).cast("long")).alias("p"), F.col(order).alias("o"))
    keyed = df.withColumn("content_hash", X.sha1_64(content))
    best = keyed.groupBy("content_hash").agg(F.min(rank).alias("_best"), F.count(F.lit(1)).alias("_n"))
    return (
        keyed.join(best, "content_hash")
        .withColumn("survivor", F.col("_best.o"))
        .withColumn("group_size", F.col("_n"))
        .drop("_best", "_n")
    )


def exact_dedup(df: DataFrame, content: Column, order: str = "doc_id", priority: Column | None = None) -> DataFrame:
    """The survivors with ``duplicate_count``, how many others had their content.

    Winners are found on hashes and ids alone; rows meet them by id, so no text is shuffled to a
    content that many rows share.  ``order`` names the rows; rows without a name are left out.
    """
    rank = F.struct((-(priority if priority is not None else F.lit(1)).cast("long")).alias("p"), F.col(order).alias("o"))
    best = df.groupBy(X.sha1_64(content).alias("content_hash")).agg(F.min(rank).alias("m"), F.count(F.lit(1)).alias("n"))
    winners = best.select(F.col("m.o").alias("_survivor"), (F.col("n") - 1).alias("duplicate_count"))
    return df.join(winners, F.col(order) == F.col("_survivor")).drop("_survivor")


def hash_index(df: DataFrame, content: Column) -> DataFrame:
    """The distinct content hashes, to be kept as a table and held against later data."""
    return df.select(X.sha1_64(content).alias("content_hash")).distinct()


def exact_dedup_against(df: DataFrame, content: Column, index: DataFrame, only_index: bool = True, order: str = "doc_id") -> DataFrame:
    """Rows whose content the index lacks; duplicates within ``df`` stay unless ``only_index`` is off."""
    fresh = df.withColumn("content_hash", X.sha1_64(content)).join(index, "content_hash", "left_anti").drop("content_hash")
    return fresh if only_index else exact_dedup(fresh, content, order).drop("duplicate_count")


# -- sentences -----------------------------------------------------------------------------------


def sentence_shingles(df: DataFrame, n: int = 3, order: str = "doc_id", text: str = "text", marks: bool = True) -> DataFrame:
    """``(order, sent, h)``: the hash of every ``n`` consecutive simplified sentences that is not blank."""
    simple = F.transform(X.sentences(F.col(text)), lambda x: X.simplify(x, marks=False))
    if marks:
        simple = F.transform(X.without_marks_all(simple), X.strip)

    def grams(items: Column) -> Column:
        every = F.transform(
            F.sequence(F.lit(1), F.size(items) - n + 1), lambda i: F.struct((i - 1).alias("sent"), F.array_join(F.slice(items, i, n), " ").alias("g"))
        )
        return F.when(F.size(items) >= n, every)

    out = df.select(order, F.explode(X.let(simple, grams)).alias("x"))
    return out.where(X.strip(F.col("x.g")) != "").select(order, F.col("x.sent").alias("sent"), X.sha1_64(F.col("x.g")).alias("h"))


def sentence_index(shingles: DataFrame) -> DataFrame:
    """The distinct shingle hashes of a corpus, to be kept as a table and held against later ones."""
    return shingles.select("h").distinct()


def sentence_duplicates(shingles: DataFrame, order: str = "doc_id", index: DataFrame | None = None, only_index: bool = False) -> DataFrame:
    """``(order, sent)`` of each shingle after its first one in order, repeats in one document included;
    with an index also those that it has, or those alone if ``only_index``."""
    if index is not None and only_index:
        return shingles.join(index, "h", "left_semi").select(order, "sent").distinct()
    here = F.struct(F.col(order).alias("o"), F.col("sent").alias("s"))
    first = shingles.groupBy("h").agg(F.min(here).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("h", "first")
    again = shingles.join(first, "h").where(here != F.col("first")).select(order, "sent")
    if index is not None:
        again = again.unionByName(shingles.join(index, "h", "left_semi").select(order, "sent"))
    return again.distinct()


def remove_sentences(text: str, starts: list[int], n: int, min_words_span: int = 0) -> str:
    """The text without the sentences that the shingles starting at ``starts`` cover.

    White space belongs to the sentence it follows.  A removed run of fewer than ``min_words_span``
    words in its first sentence stays.
    """
    from .kernels import sentence_spans, word_list

    spans = sentence_spans(text)
    gone: set[int] = set()
    for s in sorted(set(starts)):
        gone |= set(range(s, s + n))
    edges = [0] + [spans[i][0] for i in range(1, len(spans))] + [len(text)]
    pieces = [text[a:b] for a, b in zip(edges, edges[1:])] if spans else [text]
    out: list[str] = []
    i = 0
    while i < len(pieces):
        if i not in gone:
            out.append(pieces[i])
            i += 1
            continue
        j = i
        while j < len(pieces) and j in gone:
            j += 1
        if len(word_list(pieces[i])) < min_words_span:
            out.append(pieces[i])
        i = j
    return "".join(out).strip()


def sentence_dedup(df: DataFrame, duplicates: DataFrame, n: int = 3, min_words: int = 50, min_sentences: int = 3, min_words_span: int = 0, order: str = "doc_id", text: str = "text") -> DataFrame:
    """``(order, text, removed, filter_reason)``; the length rules ask only documents that changed."""
    hit = duplicates.groupBy(order).agg(F.sort_array(F.collect_set("sent")).alias("starts"))
    joined = df.select(order, text).join(hit, order, "left")
    kind = T.StructType([T.StructField("text", T.StringType()), T.StructField("reason", T.StringType())])
    @F.pandas_udf(kind)
    def apply(t: pd.Series, starts: pd.Series) -> pd.DataFrame:
        from .kernels import sentence_list, word_list

        rows = []
        for x, s in zip(t, starts):
            if x is None or s is None or len(s) == 0:
                rows.append((x, None))
                continue
            new = remove_sentences(x, [int(k) for k in s], n, min_words_span)
            reason = None
            if new != x:
                if min_words and len(word_list(new)) < min_words:
                    reason = "too_few_words"
                elif min_sentences and len(sentence_list(new)) < min_sentences:
                    reason = "too_few_sentences"
            rows.append((new, reason))
        return pd.DataFrame(rows, columns=["text", "reason"])

    done = joined.withColumn("_r", apply(F.col(text), F.col("starts")))
    return done.select(order, F.col("_r.text").alias(text), F.coalesce(F.size("starts"), F.lit(0)).alias("removed"), F.col("_r.reason").alias("filter_reason"))


# -- MinHash -------------------------------------------------------------------------------------

PRIME = (1 << 61) - 1


@lru_cache(8)
def permutations(count: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Factors and offsets of the affine hashes, drawn once from the seed."""
    gen = np.random.RandomState(seed)
    a = gen.randint(1, PRIME, dtype=np.uint64, size=(1, count))
    b = gen.randint(0, PRIME, dtype=np.uint64, size=(1, count))
    return a, b


def shingle_values(words: list[str], n: int) -> np.ndarray:
    """The first eight bytes of the SHA-1 of every different word n-gram."""
    grams = {" ".join(words[i : i + n]) for i in range(len(words) - n + 1)}
    whole = b"".join([hashlib.sha1(g.encode()).digest()[:8] for g in grams])
    return np.frombuffer(whole, dtype="<u8")


def signature(values: np.ndarray, count: int, seed: int = 1) -> np.ndarray:
    """The least value of every affine hash, modulo ``PRIME``, over the shingles' values.

    The remainder by 2**61 - 1 is taken by folding the upper bits; hashes lie one to a row, so that
    each minimum runs along memory.
    """
    a, b = permutations(count, seed)
    prime = np.uint64(PRIME)
    least = np.full(count, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(values), 512):
        x = values[None, at : at + 512] * a.T + b.T
        x = (x & prime) + (x >> np.uint64(61))
        least = np.minimum(least, np.minimum(x, x - prime).min(axis=1))
    return least


def minhash_signatures(df: DataFrame, n: int = 5, buckets: int = 14, rows: int = 8, seed: int = 1, order: str = "doc_id", text: str = "text", marks: bool = True) -> DataFrame:
    """``(order, band, sig)``: per band the ``rows`` minima; documents of under ``n`` words have none."""
    shaped = spread(df.select(order, text)).select(order, X.simplify(F.col(text), marks=marks).alias("simple")).select(order, X.words(F.col("simple")).alias("w"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, bands, sigs = [], [], []
            for key, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if w is None or len(w) < n:  # asked here: as a filter it would have the words computed twice
                    continue
                least = signature(shingle_values(w, n), buckets * rows, seed).reshape(buckets, rows)
                for band in range(buckets):
                    keys.append(key)
                    bands.append(band)
                    sigs.append(least[band].astype(np.int64).tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, batch.schema.field(0).type), pa.array(bands, pa.int32()), pa.array(sigs, pa.list_(pa.int64()))], [order, "band", "sig"]
            )

    kind = dict(df.dtypes)[order]
    return shaped.mapInArrow(run, f"{order} {kind}, band int, sig array<bigint>")


def minhash_links(signatures: DataFrame, order: str = "doc_id") -> DataFrame:
    """``(src, dst)``: every document of a band bucket linked to the bucket's least one.

    A bucket of ``k`` documents gives ``k - 1`` links, which connect it as well as all pairs would.
    Buckets are told apart by a 64-bit hash of band and minima, which is what is shuffled.
    """
    keyed = signatures.select(F.xxhash64("band", "sig").alias("bucket"), order)
    first = keyed.groupBy("bucket").agg(F.min(order).alias("src"), F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket", "src")
    return keyed.join(first, "bucket").where(F.col(order) != F.col("src")).select("src", F.col(order).alias("dst")).distinct()


def minhash_clusters(signatures: DataFrame, order: str = "doc_id") -> DataFrame:
    """``(order, minhash_cluster_id, minhash_cluster_size)`` of the documents in clusters of two or more."""
    found = connected_components(minhash_links(signatures, order))
    sizes = found.groupBy("component").agg(F.count(F.lit(1)).alias("minhash_cluster_size"))
    return found.join(sizes, "component").select(F.col("node").alias(order), F.col("component").alias("minhash_cluster_id"), "minhash_cluster_size")


def minhash_dedup(df: DataFrame, clusters: DataFrame, order: str = "doc_id", known: DataFrame | None = None) -> DataFrame:
    """One document of each cluster (the least id) and all others, with cluster id (-1) and size (1).

    With ``known`` (the ids of :func:`index_matches`) clusters that hold one of these go whole, as
    an earlier corpus has them; so do known documents that are in no cluster.
    """
    if known is not None:
        listed = clusters.select(order, "minhash_cluster_id").join(known.select(order).distinct(), order)
        old = listed.select("minhash_cluster_id").distinct()
        df = df.join(known.select(order).distinct().unionByName(clusters.join(old, "minhash_cluster_id", "left_semi").select(order)).distinct(), order, "left_anti")
    joined = df.join(clusters, order, "left").where(F.col("minhash_cluster_id").isNull() | (F.col("minhash_cluster_id") == F.col(order)))
    return joined.withColumn("minhash_cluster_id", F.coalesce("minhash_cluster_id", F.lit(-1).cast("long"))).withColumn(
        "minhash_cluster_size", F.coalesce("minhash_cluster_size", F.lit(1).cast("long"))
    )


def band_index(signatures: DataFrame) -> DataFrame:
    """The band buckets of a corpus, to be kept as a table and held against later ones."""
    return signatures.select("band", "sig").distinct()


def index_matches(signatures: DataFrame, index: DataFrame, order: str = "doc_id") -> DataFrame:
    """``(order)`` of the documents that share a band bucket with an indexed corpus."""
    keyed = signatures.select(F.xxhash64("band", "sig").alias("bucket"), order)
    return keyed.join(index.select(F.xxhash64("band", "sig").alias("bucket")).distinct(), "bucket", "left_semi").select(order).distinct()


def minhash_dedup_against(df: DataFrame, signatures: DataFrame, index: DataFrame, only_index: bool = False, order: str = "doc_id") -> DataFrame:
    """``df`` without what an indexed corpus has; duplicates within ``df`` stay if ``only_index``."""
    known = index_matches(signatures, index, order)
    if only_index:
        return df.join(known, order, "left_anti")
    return minhash_dedup(df, minhash_clusters(signatures, order), order, known)


# -- first-seen shingles (the exact counterpart of a Bloom filter) ---------------------------------


def first_seen_dedup(df: DataFrame, n: int = 13, threshold: float = 0.8, order: str = "doc_id", text: str = "text", marks: bool = True) -> DataFrame:
    """``(order, shingles, seen, filter_reason)``: drops documents more than ``threshold`` of whose
    word n-grams stand in an earlier document.

    Where a Bloom filter answers with some false hits in the order of arrival, the first document
    of each shingle is computed exactly.  Documents without a shingle stay.
    """
    grams = df.select(order, X.simplify(F.col(text), marks=marks).alias("s")).select(order, X.words(F.col("s")).alias("w"))
    flat = grams.select(order, F.explode(X.ngrams(F.col("w"), n)).alias("g")).select(order, F.xxhash64("g").alias("h"))
    own = flat.groupBy(order, "h").agg(F.count(F.lit(1)).alias("n"))
    first = own.groupBy("h").agg(F.min(order).alias("first"))
    per = own.join(first, "h").groupBy(order).agg(F.sum("n").alias("shingles"), F.sum(F.when(F.col("first") < F.col(order), F.col("n")).otherwise(0)).alias("seen"))
    zero = F.lit(0).cast("long")
    out = df.select(order).join(per, order, "left")
    return out.select(
        order, F.coalesce("shingles", zero).alias("shingles"), F.coalesce("seen", zero).alias("seen"),
        F.when(F.col("seen") > threshold * F.col("shingles"), "bloom_duplicate").alias("filter_reason"),
    )


# -- exact substrings ----------------------------------------------------------------------------


def repeated_token_ranges(df: DataFrame, k: int = 50, order: str = "doc_id", tokens: str = "tokens") -> DataFrame:
    """``(order, start, end)``: maximal ranges covered by windows of ``k`` tokens that occur more than once.

    Window hashes are counted by partial aggregation; ranges are merged per document.
    """
    windows = F.transform(
        F.sequence(F.lit(1), F.size(tokens) - k + 1), lambda i: F.struct((i - 1).alias("at"), F.xxhash64(F.array_join(F.slice(tokens, i, k), "\x01")).alias("h"))
    )
    flat = df.where(F.size(tokens) >= k).select(order, F.explode(windows).alias("x")).select(order, "x.at", "x.h")
    often = flat.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    hits = flat.join(often, "h", "left_semi").groupBy(order).agg(F.sort_array(F.collect_list("at")).alias("ats"))
    start = F.struct(F.lit(-1).alias("lo"), F.lit(-1).alias("hi"), F.array().cast("array<struct<lo:int,hi:int>>").alias("out"))

    def step(acc: Column, at: Column) -> Column:
        joins = (acc["lo"] >= 0) & (at <= acc["hi"])
        closed = F.when(joins | (acc["lo"] < 0), acc["out"]).otherwise(F.array_append(acc["out"], F.struct(acc["lo"].alias("lo"), acc["hi"].alias("hi"))))
        return F.struct(F.when(joins, acc["lo"]).otherwise(at).alias("lo"), (at + k).alias("hi"), closed.alias("out"))

    merged = F.aggregate("ats", start, step, lambda acc: F.array_append(acc["out"], F.struct(acc["lo"].alias("lo"), acc["hi"].alias("hi"))))
    return hits.select(order, F.explode(merged).alias("r")).select(order, F.col("r.lo").alias("start"), F.col("r.hi").alias("end"))
