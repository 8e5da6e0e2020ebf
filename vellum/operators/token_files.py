"""Token streams: documents to ids, shuffling, packing into windows, token files."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.tokens import with_tokens

DOC_INDEX_MAGIC = b"MMIDIDX\x00\x00"


def token_stream(df: DataFrame, order: str = "doc_id", text: str = "text", eos: int | None = 50256, **tokenizer) -> DataFrame:
    """``(order, tokens, n_tokens)`` of the documents with a text."""
    done = with_tokens(df.select(order, text).where(F.col(text).isNotNull()), text, count="n_tokens", ids="tokens", eos=eos, **tokenizer)
    return done.select(order, "tokens", "n_tokens")


def shuffled(df: DataFrame, key: str = "doc_id", seed: int = 0) -> DataFrame:
    """A reproducible order: ``shuffle_key`` is a hash of id and seed."""
    return df.withColumn("shuffle_key", F.xxhash64(F.lit(seed), F.col(key)))


def with_offsets(df: DataFrame, key: str = "doc_id", size: str = "n_tokens", order: str | None = None, ranges: int = 1024) -> DataFrame:
    """``token_start``: tokens before the document in the order of ``order`` (default: ``key``).

    A two-level prefix sum: ranges of the order are summed, then positions inside each range.  The
    range comes from sampled quantiles of the order, whose exactness does not matter.
    """
    by = order or key
    cuts = df.approxQuantile(by, [i / ranges for i in range(1, ranges)], 0.001) if ranges > 1 else []
    cuts = sorted(set(cuts))
    ranged = df.withColumn("_range", F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col(by))) if cuts else F.lit(0))
    sums = ranged.groupBy("_range").agg(F.sum(size).alias("_sum"))
    before = sums.withColumn("_before", F.sum("_sum").over(Window.partitionBy(F.lit(1)).orderBy("_range")) - F.col("_sum")).drop("_sum")
    within = Window.partitionBy("_range").orderBy(by, key)
    return (
        ranged.withColumn("_upto", F.sum(size).over(within)).join(F.broadcast(before), "_range")
        .withColumn("token_start", F.col("_upto") + F.col("_before") - F.col(size)).drop("_range", "_upto", "_before")
    )


def file_of(offsets: DataFrame, max_tokens: int, size: str = "n_tokens") -> DataFrame:
    """``file_id``: files of about ``max_tokens``, documents kept whole."""
    return offsets.withColumn("file_id", F.floor(F.col("token_start") / F.lit(max_tokens)).cast("long"))


def context_windows(df: DataFrame, window: int, key: str = "doc_id", tokens: str = "tokens") -> DataFrame:
    """``(window_id, key, first_pos, last_pos)``: what each document gives to each full window of
    the stream in the order of ``key``; the tail that fills no window is left out."""
    sized = with_offsets(df.select(key, F.size(tokens).cast("long").alias("n_tokens")), key, ranges=64)
    total = sized.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("total"))
    end = F.col("token_start") + F.col("n_tokens")
    parts = sized.where("n_tokens > 0").withColumn("window_id", F.explode(F.sequence(F.floor(F.col("token_start") / window), F.floor((end - 1) / window))))
    full = parts.crossJoin(F.broadcast(total)).where((F.col("window_id") + 1) * window <= F.col("total"))
    lo = F.greatest(F.col("token_start"), F.col("window_id") * window)
    hi = F.least(end, (F.col("window_id") + 1) * window)
    return full.select(
        F.col("window_id").cast("long").alias("window_id"), key, (lo - F.col("token_start")).cast("long").alias("first_pos"), (hi - F.col("token_start") - 1).cast("long").alias("last_pos")
    )


def positions(df: DataFrame, key: str = "doc_id", tokens: str = "tokens") -> DataFrame:
    """``(key, position, token)``, positions starting anew in each document."""
    return df.select(key, F.posexplode(tokens).alias("position", "token"))


def window_order(windows: DataFrame, seed: int = 0) -> DataFrame:
    return windows.withColumn("shuffle_key", F.xxhash64(F.lit(seed), F.col("window_id")))


def write_token_file(path: str, documents: Iterator[list[int]], two_bytes: bool = True) -> tuple[int, int]:
    """Flat little-endian ids in ``path`` and cumulative document ends in ``path.index``."""
    kind = "<u2" if two_bytes else "<u4"
    ends, total = [], 0
    with open(path, "wb") as out:
        for ids in documents:
            out.write(np.asarray(ids, dtype=kind).tobytes())
            total += len(ids)
            ends.append(total)
    with open(path + ".index", "wb") as out:
        out.write(np.asarray(ends, dtype="<u8").tobytes())
    return len(ends), total


def read_token_file(path: str, two_bytes: bool = True) -> list[np.ndarray]:
    ids = np.fromfile(path, dtype="<u2" if two_bytes else "<u4")
    ends = np.fromfile(path + ".index", dtype="<u8").astype(np.int64)
    return [ids[a:b] for a, b in zip(np.concatenate([[0], ends[:-1]]), ends)]


def check_token_file(path: str, eos: int, two_bytes: bool = True) -> bool:
    """Whether every document ends in ``eos`` and the sizes agree."""
    docs = read_token_file(path, two_bytes)
    size = np.fromfile(path, dtype="<u2" if two_bytes else "<u4").size
    return sum(map(len, docs)) == size and all(len(d) and d[-1] == eos for d in docs)


def write_indexed_file(prefix: str, documents: Iterator[list[int]], two_bytes: bool = True) -> None:
    """The ``.bin``/``.idx`` pair: magic, version, type code, counts, lengths, byte pointers, document bounds."""
    kind, code = ("<u2", 8) if two_bytes else ("<i4", 4)
    lengths = []
    with open(prefix + ".bin", "wb") as out:
        for ids in documents:
            out.write(np.asarray(ids, dtype=kind).tobytes())
            lengths.append(len(ids))
    sizes = np.asarray(lengths, dtype="<i4")
    pointers = np.concatenate([[0], np.cumsum(sizes[:-1], dtype=np.int64)]) * np.dtype(kind).itemsize if lengths else np.empty(0)
    with open(prefix + ".idx", "wb") as out:
        out.write(DOC_INDEX_MAGIC + struct.pack("<QBQQ", 1, code, len(lengths), len(lengths) + 1))
        out.write(sizes.tobytes() + pointers.astype("<i8").tobytes() + np.arange(len(lengths) + 1, dtype="<i8").tobytes())


def write_partitions(df: DataFrame, folder: str, tokens: str = "tokens", two_bytes: bool = True) -> DataFrame:
    """One token file for each partition of ``df``; ``(file, documents, tokens)`` of what was written.

    ``folder`` is one that all executors share.  A task that runs again writes its file anew.
    """
    import os

    os.makedirs(folder, exist_ok=True)
    at = df.columns.index(tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        name = f"{TaskContext.get().partitionId():05d}.ds"
        temporary = os.path.join(folder, f".{name}.{TaskContext.get().taskAttemptId()}")
        n, total = write_token_file(temporary, (ids for b in batches for ids in b.column(at).to_pylist() if ids is not None), two_bytes)
        os.replace(temporary, os.path.join(folder, name))
        os.replace(temporary + ".index", os.path.join(folder, name + ".index"))
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64()), pa.array([total], pa.int64())], ["file", "documents", "tokens"])

    return df.mapInArrow(run, "file string, documents long, tokens long")


def word_tokens(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Words as tokens, for streams that need no vocabulary."""
    return df.where(F.col(text).isNotNull()).select(key, X.words(F.col(text)).alias("tokens"))
