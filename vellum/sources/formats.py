"""File formats that Spark has no reader for, as Python data sources; a partition is a file."""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def _files(path: str, endings: tuple[str, ...]) -> list[str]:
    p = Path(path)
    if p.is_file():
        return [str(p)]
    return sorted(str(f) for f in p.rglob("*") if f.is_file() and f.name.endswith(endings))


class _FileReader(DataSourceReader):
    endings: tuple[str, ...] = ("",)

    def __init__(self, schema, options) -> None:
        self.schema, self.options = schema, dict(options)

    def partitions(self):
        return [InputPartition(f) for f in _files(self.options["path"], self.endings)]


class ArrowSource(DataSource):
    """Arrow IPC, file or stream format; the schema is the caller's."""

    @classmethod
    def name(cls) -> str:
        return "vellum_arrow"

    def schema(self):
        raise ValueError("give a schema")

    def reader(self, schema):
        return _ArrowReader(schema, self.options)


class _ArrowReader(_FileReader):
    endings = (".arrow", ".ipc", ".feather")

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in self.schema.fields]
        with pa.memory_map(partition.value) as source:
            try:
                reader = pa.ipc.open_file(source)
                batches = (reader.get_batch(i) for i in range(reader.num_record_batches))
            except pa.ArrowInvalid:
                source.seek(0)
                batches = iter(pa.ipc.open_stream(source))
            for batch in batches:
                yield batch.select(names)


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (in lower case) and payload of each record."""
    at = 0
    while True:
        at = data.find(b"WARC/", at)
        if at < 0:
            return
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        head = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head)}
        size = int(headers.get("content-length", 0))
        yield headers, data[end + 4 : end + 4 + size]
        at = end + 4 + size


def warc_document(headers: dict[str, str], payload: bytes) -> tuple | None:
    """Text, address and date of a response or conversion record of a text type."""
    kind = headers.get("warc-type")
    if kind not in ("response", "conversion"):
        return None
    mime, charset = headers.get("content-type", ""), None
    if kind == "response":
        head, _, payload = payload.partition(b"\r\n\r\n")
        lines = head.decode("latin-1").split("\r\n")
        http = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        mime = http.get("content-type", "")
        if http.get("content-encoding") == "gzip":
            payload = gzip.decompress(payload)
    mime = headers.get("warc-identified-payload-type", mime)
    allowed = ("text/html", "application/xhtml+xml") + (("text/plain",) if kind == "conversion" else ())
    if mime.split(";")[0].strip() not in allowed:
        return None
    m = re.search(r"charset=([\w-]+)", mime)
    charset = m[1] if m else None
    for codec in ("utf-8", charset, "cp1252", "latin-1"):
        if not codec:
            continue
        try:
            text = payload.decode(codec)
            break
        except (UnicodeDecodeError, LookupError):
            continue
    url = headers.get("warc-target-uri") or headers.get("uri") or ""
    date = headers.get("warc-date") or headers.get("archive-date") or ""
    return headers.get("warc-record-id", ""), text, url, date, kind


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "vellum_warc"

    def schema(self):
        return "id string, text string, url string, date string, record_type string, file_path string"

    def reader(self, schema):
        return _WarcReader(schema, self.options)


class _WarcReader(_FileReader):
    endings = (".warc", ".warc.gz", ".wet", ".wet.gz")

    def read(self, partition):
        raw = Path(partition.value).read_bytes()
        data = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
        for headers, payload in warc_records(data):
            found = warc_document(headers, payload)
            if found:
                yield (*found, partition.value)


class TokenFileSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "vellum_tokens"

    def schema(self):
        return "file_path string, window_id long, tokens array<int>"

    def reader(self, schema):
        return _TokenReader(schema, self.options)


class _TokenReader(_FileReader):
    endings = (".ds",)

    def read(self, partition):
        kind = "<u2" if self.options.get("two_bytes", "True") == "True" else "<u4"
        window = int(self.options["window"])
        ids = np.memmap(partition.value, dtype=kind, mode="r") if Path(partition.value).stat().st_size else np.empty(0, kind)
        for k in range(len(ids) // window):
            yield (partition.value, k, ids[k * window : (k + 1) * window].astype(int).tolist())


class MediaSource:
    """Bytes at ``(path, offset, length)``: rows sorted by place, so each file is opened once a run."""

    @staticmethod
    def attach(refs: DataFrame, folder: str) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import os

            handle, name = None, None
            for batch in batches:
                out = []
                for path, offset, length in zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "length"))):
                    try:
                        if path != name:
                            if handle:
                                handle.close()
                            handle, name = open(os.path.join(folder, path), "rb"), path
                        handle.seek(offset)
                        out.append(handle.read(length))
                    except (OSError, TypeError):
                        handle, name = None, None
                        out.append(None)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "media_bytes"])

        from pyspark.sql import types as T

        schema = T.StructType([*refs.schema.fields, T.StructField("media_bytes", T.BinaryType())])
        return refs.repartition("path").sortWithinPartitions("path", "offset").mapInArrow(run, schema)

    @staticmethod
    def store(df: DataFrame, folder: str, column: str = "media_bytes") -> DataFrame:
        """Each partition appends its payloads, zstandard-compressed, to one file; the bytes' place comes back."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import os

            import zstandard
            from pyspark import TaskContext

            os.makedirs(folder, exist_ok=True)
            name = f"media-{TaskContext.get().partitionId():05d}-{TaskContext.get().taskAttemptId()}.zst"
            press = zstandard.ZstdCompressor()
            with open(os.path.join(folder, name), "wb") as out:
                for batch in batches:
                    at = batch.schema.get_field_index(column)
                    places = []
                    for data in batch.column(at).to_pylist():
                        frame = press.compress(data) if data is not None else b""
                        places.append((out.tell(), len(frame)))
                        out.write(frame)
                    rest = [i for i in range(batch.num_columns) if i != at]
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(i) for i in rest), pa.array([name] * batch.num_rows), pa.array([p[0] for p in places], pa.int64()), pa.array([p[1] for p in places], pa.int64())],
                        [*(batch.schema.names[i] for i in rest), "path", "offset", "length"],
                    )

        from pyspark.sql import types as T

        fields = [f for f in df.schema.fields if f.name != column]
        schema = T.StructType([*fields, T.StructField("path", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType())])
        return df.mapInArrow(run, schema)


#: First bytes of file types.
MAGIC = (
    (b"\x89PNG\r\n\x1a\n", "image/png"), (b"\xff\xd8\xff", "image/jpeg"), (b"GIF8", "image/gif"), (b"%PDF-", "application/pdf"), (b"PK\x03\x04", "application/zip"),
    (b"RIFF", "audio/wav"), (b"ID3", "audio/mpeg"), (b"OggS", "audio/ogg"), (b"\x1f\x8b", "application/gzip"), (b"\x28\xb5\x2f\xfd", "application/zstd"),
)


def mime_type(data: bytes | None) -> str | None:
    if data is None:
        return None
    return next((m for head, m in MAGIC if data.startswith(head)), "text/plain" if not re.search(rb"[\x00-\x08]", data[:512]) else "application/octet-stream")
