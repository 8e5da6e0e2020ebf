"""Reader mapping, input validation, stage routing, unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


def adapt(df: DataFrame, text: str = "text", id_column: str = "id", path: Column | None = None, row: Column | None = None) -> DataFrame:
    """The canonical row: ``id, text, metadata`` (all other columns as JSON); rows without a text go."""
    rest = [c for c in df.columns if c not in (text, id_column)]
    fallback = F.concat_ws("/", path.cast("string"), row.cast("string")) if path is not None and row is not None else F.lit(None).cast("string")
    has_id = F.col(id_column).cast("string") if id_column in df.columns else F.lit(None).cast("string")
    meta = F.to_json(F.struct(*rest)) if rest else F.lit("{}")
    return df.where(F.length(text) > 0).select(F.coalesce(has_id, fallback).alias("id"), F.col(text).alias("text"), meta.alias("metadata"))


def skip_limit(df: DataFrame, order: str, skip: int = 0, limit: int = -1) -> DataFrame:
    """Rows ``skip`` to ``skip + limit`` in a total order."""
    out = df.orderBy(order).offset(skip)
    return out if limit < 0 else out.limit(limit)


def union_all(*frames: DataFrame) -> DataFrame:
    """Sources one after the other; a column that one lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def validate_lines(df: DataFrame, raw: str = "raw", path: str = "ihb_source_relpath", line: str = "ihb_source_line") -> DataFrame:
    """Raw JSON lines with ``reason``: invalid_json, invalid_record, missing_text, or null; ``text``
    is the record's, or the raw line where there is no record; ``uid`` names file and line."""
    v = F.try_parse_json(raw)
    kind = F.schema_of_variant(v)
    field = F.try_variant_get(v, "$.text", "string")
    text_kind = F.schema_of_variant(F.try_variant_get(v, "$.text", "variant"))
    is_object = kind.startswith("OBJECT")
    reason = (
        F.when(v.isNull(), "invalid_json")
        .when(~is_object, "invalid_record")
        .when(F.coalesce(text_kind != "STRING", F.lit(True)) | (X.strip(F.coalesce(field, F.lit(""))) == ""), "missing_text")
    )
    uid = F.sha2(F.concat(F.col(path), F.lit("\x00"), F.col(line).cast("string")), 256)
    return df.withColumn("reason", reason).withColumn("text", F.when(F.col("reason").isin("invalid_json", "invalid_record"), F.col(raw)).otherwise(field)).withColumn("uid", uid)


def route(survivors: DataFrame, eliminated: DataFrame) -> DataFrame:
    """Both outputs with ``category``; write it partitioned by category and source."""
    return union_all(survivors.withColumn("category", F.lit("survive")), eliminated.withColumn("category", F.lit("eliminated")))


def dropped_between(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Rows that a stage removed."""
    return before.join(after.select(key), key, "left_anti")


def final_reason(stage: Column, new: Column, earlier: Column) -> Column:
    """An earlier gate's reason stays unless the stage is a deduplication."""
    return F.when(stage.endswith("_dedup") | earlier.isNull(), new).otherwise(earlier)


def balance(routed: DataFrame, category: str = "category") -> DataFrame:
    """One row: input, survivors, eliminated and whether they add up."""
    n = F.count(F.lit(1))
    kept = F.count(F.when(F.col(category) == "survive", 1))
    gone = F.count(F.when(F.col(category) == "eliminated", 1))
    return routed.agg(n.alias("input"), kept.alias("survive"), gone.alias("eliminated"), (kept + gone == n).alias("balanced"))
