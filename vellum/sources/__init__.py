"""Readers and writers."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .formats import ArrowSource, MediaSource, TokenFileSource, WarcSource

__all__ = ["ArrowSource", "MediaSource", "TokenFileSource", "WarcSource", "read_arrow", "read_csv", "read_jsonl", "read_lines", "read_parquet", "read_tokens", "read_warc", "roots", "write"]


def _options(reader, recursive: bool, glob: str | None):
    reader = reader.option("recursiveFileLookup", str(recursive).lower())
    return reader.option("pathGlobFilter", glob) if glob else reader


def read_lines(spark: SparkSession, paths: str | Sequence[str], recursive: bool = True, glob: str | None = None) -> DataFrame:
    """``(raw, file_path)`` of text files, compressed ones too."""
    return _options(spark.read, recursive, glob).text(paths).select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("file_path"))


def read_jsonl(spark: SparkSession, paths: str | Sequence[str], schema: str | T.StructType | None = None, recursive: bool = True, glob: str | None = None) -> DataFrame:
    """One JSON object a line; malformed lines are left out."""
    reader = _options(spark.read, recursive, glob).option("mode", "DROPMALFORMED")
    return (reader.schema(schema) if schema else reader).json(paths)


def read_csv(spark: SparkSession, paths: str | Sequence[str], recursive: bool = True, glob: str | None = None) -> DataFrame:
    """Columns by header, all of them strings; quoted line breaks allowed."""
    return _options(spark.read, recursive, glob).csv(paths, header=True, multiLine=True, escape='"')


def read_parquet(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None, recursive: bool = True, glob: str | None = None) -> DataFrame:
    """``columns`` only, where given, so that the scan reads no others."""
    df = _options(spark.read, recursive, glob).parquet(*([paths] if isinstance(paths, str) else paths))
    return df.select(*columns) if columns else df


def _registered(spark: SparkSession, source) -> None:
    from ..session import ship

    ship(spark)
    spark.dataSource.register(source)


def read_arrow(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Arrow IPC files or streams under ``path``."""
    _registered(spark, ArrowSource)
    return spark.read.format("vellum_arrow").schema(schema).load(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``(id, text, url, date, record_type, file_path)`` of web archives, plain or gzip."""
    _registered(spark, WarcSource)
    return spark.read.format("vellum_warc").load(path)


def read_tokens(spark: SparkSession, path: str, window: int, two_bytes: bool = True) -> DataFrame:
    """``(file_path, window_id, tokens)``: full windows of token files."""
    _registered(spark, TokenFileSource)
    return spark.read.format("vellum_tokens").option("window", str(window)).option("two_bytes", str(two_bytes)).load(path)


def read_media(spark: SparkSession, folder: str, refs: DataFrame) -> DataFrame:
    """``refs(path, offset, length)`` with ``media_bytes``, reading each file once per run of rows."""
    return MediaSource.attach(refs, folder)


def roots(paths: Sequence[str]) -> dict[str, str]:
    """A label for each input folder, unique and without overlap; raises where one holds another."""
    resolved = [Path(p).resolve() for p in paths]
    for i, a in enumerate(resolved):
        for j, b in enumerate(resolved):
            if i != j and (a == b or a in b.parents):
                raise ValueError(f"input folders overlap: {a} and {b}")
    if len(resolved) == 1:
        return {"": str(resolved[0])}
    labels: dict[str, str] = {}
    for p in resolved:
        name, k = p.name, 2
        while name in labels:
            name, k = f"{p.name}_{k}", k + 1
        labels[name] = str(p)
    return labels


def write(df: DataFrame, path: str, fmt: str = "parquet", by: Sequence[str] = (), rows_per_file: int | None = None, compression: str | None = None, mode: str = "errorifexists") -> None:
    """Parquet, JSON lines or CSV, split by columns and by rows."""
    writer = df.write.mode(mode)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if by:
        writer = writer.partitionBy(*by)
    codec = compression or {"json": "gzip", "parquet": "zstd"}.get(fmt)
    if codec:
        writer = writer.option("compression", codec)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
