"""Duplicates hidden by formatting: recursive radix partitioning of canonical bytes.

1. A row becomes its canonical bytes.  Inside an input partition equal rows collapse at once, in
   a trie with terminal counters, so a content held by a third of all rows leaves each partition
   as a single entry.  The entries are written once, compressed, to the shared folder.
2. Buckets are the byte prefixes of the entries.  A bucket over ``bucket_bytes`` is split by its
   next bytes, twice as many at each level, until each fits or holds nothing but one content.  The
   oversized prefixes are a table in the shared folder that the entries are joined with; only
   numbers of rows and bytes reach the driver.
3. Each bucket is counted in a trie of its own whose terminals hold the smallest id and the count.

Equality is that of the whole canonical bytes; no hash decides.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .kernel import fold_many

#: Bytes of canonical content that one bucket may hold before it is split further.
BUCKET_BYTES = 24 << 20
#: Bytes of a trie's edge; what a row's id counts for in the memory of a partition's trie.
STRIDE, ID_BYTES = 8, 40
ENTRY = "in_table string, first_id long, canon binary, n long, copies array<long>"
CLASS = "in_table string, local_id long, first_id long, n_copies long"


class Trie:
    """A radix trie over byte strings, eight bytes an edge, with a counter at each terminal.

    A subtree of one string is kept as a leaf with the rest of its bytes (path compression).  A
    leaf is split on the first insertion that leaves it.
    """

    __slots__ = ("root", "terminals")

    def __init__(self) -> None:
        self.root: dict = {}
        self.terminals: list[list] = []  # [smallest id, count, what the caller keeps]

    def add(self, data: bytes) -> tuple[int, bool]:
        """The terminal of ``data`` and whether it is new."""
        node, at, size = self.root, 0, len(data)
        while True:
            edge = data[at : at + STRIDE]
            found = node.get(edge)
            if found is None:
                self.terminals.append([None, 0, None])
                node[edge] = (data, at + STRIDE, len(self.terminals) - 1)
                return len(self.terminals) - 1, True
            at += STRIDE
            if type(found) is dict:
                node = found
                if at > size:  # edges shorter than the stride end a string
                    at = size
                continue
            other, _, terminal = found
            if len(other) == size and other == data:
                return terminal, False
            node[edge] = deeper = {}
            deeper[other[at : at + STRIDE]] = (other, at + STRIDE, terminal)
            node = deeper


def _collapse(table: str, rows: Iterator[tuple[list[int], list[bytes]]]) -> Iterator[pa.RecordBatch]:
    """Equal contents of one partition become one entry; the trie is emptied at a size bound."""

    def emit(trie: Trie, contents: list[bytes]) -> pa.RecordBatch:
        t = trie.terminals
        return pa.RecordBatch.from_arrays(
            [
                pa.array([table] * len(t), pa.string()),
                pa.array([min(x[2]) for x in t], pa.int64()),
                pa.array(contents, pa.binary()),
                pa.array([len(set(x[2])) for x in t], pa.int64()),
                pa.array([sorted(set(x[2]) - {min(x[2])}) for x in t], pa.list_(pa.int64())),
            ],
            ["in_table", "first_id", "canon", "n", "copies"],
        )

    trie, contents, held = Trie(), [], 0
    for ids, canons in rows:
        for key, canon in zip(ids, canons):
            if canon is None:
                continue
            k, new = trie.add(canon)
            if new:
                trie.terminals[k][2] = []
                contents.append(canon)
                held += len(canon)
            trie.terminals[k][2].append(key)
        held += ID_BYTES * len(ids)
        if held > 48 << 20:
            yield emit(trie, contents)
            trie, contents, held = Trie(), [], 0
    if contents:
        yield emit(trie, contents)


def _fold_bytes(texts: list[str]) -> list[bytes]:
    cp, offsets = fold_many(texts)
    whole = cp.tobytes()
    return [whole[4 * a : 4 * b].decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass") for a, b in zip(offsets, offsets[1:])]


def _document_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[bytes]]]:
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lo in range(0, len(ids), 256):
            some = [(i, t) for i, t in zip(ids[lo : lo + 256], texts[lo : lo + 256]) if t is not None and i is not None]
            folded = _fold_bytes([t for _, t in some])
            yield [i for i, _ in some], [f or None for f in folded]


def _as_written(value: object) -> str:
    if value is None:
        return ""
    if isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False)


def _not_json(_: str) -> None:
    raise ValueError


def parse_record(raw: str | None) -> tuple[str, str, str, str] | None:
    """Text, title, lang and year of a raw line, or None where the line does not count.

    A line counts if it is a JSON object whose ``text`` is a string that is not blank.  Numbers
    are kept as written; other values than strings and numbers as JSON.
    """
    if raw is None:
        return None
    try:
        row = json.loads(raw, parse_int=_Number, parse_float=_Number, parse_constant=_not_json)
    except (ValueError, RecursionError):
        return None
    if not isinstance(row, dict):
        return None
    text = row.get("text")
    if not isinstance(text, str) or isinstance(text, _Number) or not text.strip():
        return None
    return text, _as_written(row.get("title")), _as_written(row.get("lang")), _as_written(row.get("year"))


class _Number(str):
    """A JSON number as it was written."""


def _record_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[bytes]]]:
    for batch in batches:
        ids, raws = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lo in range(0, len(ids), 256):
            keep = [(i, p) for i, r in zip(ids[lo : lo + 256], raws[lo : lo + 256]) if i is not None and (p := parse_record(r))]
            folded = _fold_bytes([field for _, p in keep for field in p])
            yield [i for i, _ in keep], [b"\x1f".join(folded[4 * k : 4 * k + 4]) for k in range(len(keep))]


def _map_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _collapse("documents", _document_rows(batches))


def _map_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _collapse("records", _record_rows(batches))


def document_entries(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    return documents.select(F.col(doc_id).cast("long"), text).mapInArrow(_map_documents, ENTRY)


def record_entries(records: DataFrame, record_id: str = "record_id", raw: str = "raw") -> DataFrame:
    return records.select(F.col(record_id).cast("long"), raw).mapInArrow(_map_records, ENTRY)


def _first_depth(total: int, bucket_bytes: int) -> int:
    """Bytes of the first level's prefixes: text has some three bits of choice a byte."""
    return 1 + max(0, (max(1, total) // bucket_bytes).bit_length() // 3)


def in_buckets(entries: DataFrame, bucket_bytes: int = BUCKET_BYTES, depth: int | None = None) -> tuple[DataFrame, int]:
    """``entries`` with their ``bucket`` (a byte prefix) after splitting, and all their bytes.

    Level by level: the prefixes of ``depth`` bytes that hold too much become a table, the entries
    under them go on to prefixes of twice the bytes.  A prefix whose entries all have one content
    is not split any more, so the levels end with the longest content at the latest.
    """
    size = F.length("canon").cast("long")
    total = int(entries.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0])
    depth = depth or _first_depth(total, bucket_bytes)
    content = F.xxhash64("canon")  # only for whether to split; contents themselves are compared whole
    open_, settled = entries, []
    while True:
        level = open_.withColumn("bucket", F.substring("canon", 1, depth))
        sizes = level.groupBy("bucket").agg(F.sum(size).alias("b"), F.min(content).alias("lo"), F.max(content).alias("hi"))
        big = materialize(sizes.where((F.col("b") > bucket_bytes) & (F.col("lo") != F.col("hi")) & (F.length("bucket") == depth)).select("bucket"), "big")
        if big.isEmpty():
            settled.append(level)
            break
        settled.append(level.join(big, "bucket", "left_anti").select(*level.columns))
        open_ = level.join(big, "bucket", "left_semi").select(*entries.columns)
        depth *= 2
    whole = settled[0]
    for part in settled[1:]:
        whole = whole.unionByName(part)
    return whole, total


def _count_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by table and bucket; one bucket's trie is held at a time."""
    now: tuple | None = None
    trie, pairs = Trie(), []

    def counted() -> Iterator[pa.RecordBatch]:
        if pairs:
            rows = [(a, *trie.terminals[k][:2]) for a, k in pairs]
            yield pa.RecordBatch.from_arrays(
                [pa.array([now[0]] * len(rows), pa.string()), *(pa.array(x, pa.int64()) for x in zip(*rows))],
                ["in_table", "local_id", "first_id", "n_copies"],
            )

    for batch in batches:
        for table, first, canon, n, bucket in zip(*(batch.column(c).to_pylist() for c in ("in_table", "first_id", "canon", "n", "bucket"))):
            if (table, bucket) != now:
                yield from counted()
                now, trie, pairs = (table, bucket), Trie(), []
            k, _ = trie.add(canon)
            t = trie.terminals[k]
            t[0] = first if t[0] is None else min(t[0], first)
            t[1] += n
            pairs.append((first, k))
    yield from counted()


def content_classes(entries: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, DataFrame]:
    """The entries as written to the shared folder, and ``CLASS`` rows: each entry's content class.

    ``n_copies`` is the terminal's counter: the rows of each input partition that have the content.
    """
    entries = materialize(entries, "entries")
    bucketed, total = in_buckets(entries.select("in_table", "first_id", "canon", "n"), bucket_bytes)
    classes = (
        bucketed.repartition(1 + total // bucket_bytes, "in_table", "bucket")
        .sortWithinPartitions("in_table", "bucket")
        .mapInArrow(_count_bucket, CLASS)
    )
    return entries, classes


def _copies_of(entries: DataFrame, several: DataFrame) -> DataFrame:
    inner = entries.where(F.size("copies") > 0).select("in_table", F.col("first_id").alias("local_id"), "copies")
    within = several.join(inner, ["in_table", "local_id"]).select("in_table", "first_id", F.explode("copies").alias("copy_id"))
    return several.select("in_table", "first_id", F.col("local_id").alias("copy_id")).unionByName(within).where("first_id <> copy_id").distinct()


def copies(entries: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``(in_table, first_id, copy_id)``: each copy with the smallest id of its content.

    Rows that do not count (null or blank content, lines that are no record) do not appear, nor
    do contents that occur once.  A row delivered twice under one id counts once.
    """
    entries, classes = content_classes(entries, bucket_bytes)
    return _copies_of(entries, classes.where("n_copies > 1").select("in_table", "local_id", "first_id"))


def contents(entries: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``(in_table, first_id, n_copies)``: one row for each content, with how many rows have it.

    A row delivered twice under one id counts once, also where its deliveries lie in different
    partitions: contents that occur more than once have their distinct ids counted.
    """
    entries, classes = content_classes(entries, bucket_bytes)
    classes = materialize(classes, "classes")
    more = _copies_of(entries, classes.where("n_copies > 1").select("in_table", "local_id", "first_id"))
    counted = more.groupBy("in_table", "first_id").agg((F.count(F.lit(1)) + 1).alias("n_copies"))
    every = classes.where("local_id = first_id").select("in_table", "first_id").distinct()
    return every.join(counted, ["in_table", "first_id"], "left").select("in_table", "first_id", F.coalesce("n_copies", F.lit(1).cast("long")).alias("n_copies"))
