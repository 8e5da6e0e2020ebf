"""The queries of this subpackage: ``pN_found`` as TESTDATA.md defines it, then what else each operator reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from . import format_duplicates, leakage, mixing, near_duplicates, quality, repetition, scanned, sentences, shared_spans, truncation


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return scanned.noisy_lines(table(spark, d, "documents"))


def p1_repaired(spark: SparkSession, d: str) -> DataFrame:
    return scanned.examined(table(spark, d, "documents")).select("doc_id", "paged", "repaired")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return repetition.repeating(table(spark, d, "documents"))


def p2_shares(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    share = F.when(F.col("folded_chars") > 0, F.round(F.col("repeated_chars") / F.col("folded_chars"), 6)).otherwise(0.0)
    return repetition.exact_shares(docs).withColumn("repeated_share", share)


def p2_verdicts(spark: SparkSession, d: str) -> DataFrame:
    return repetition.judged(table(spark, d, "documents"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sample_ends(table(spark, d, "documents"), table(spark, d, "sentence_sample"))


def p3_units(spark: SparkSession, d: str) -> DataFrame:
    return sentences.split_sentences(table(spark, d, "documents"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return shared_spans.stretches(table(spark, d, "documents"))


def p4_coverage(spark: SparkSession, d: str) -> DataFrame:
    return shared_spans.coverage(table(spark, d, "documents"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates.members(table(spark, d, "documents"))


def p5_groups(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates.groups(table(spark, d, "documents"))


def _entries(spark: SparkSession, d: str) -> DataFrame:
    docs = format_duplicates.document_entries(table(spark, d, "documents"))
    return docs.unionByName(format_duplicates.record_entries(table(spark, d, "records")))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return format_duplicates.copies(_entries(spark, d))


def p6_contents(spark: SparkSession, d: str) -> DataFrame:
    return format_duplicates.contents(_entries(spark, d))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return quality.not_prose(table(spark, d, "documents"))


def p7_statistics(spark: SparkSession, d: str) -> DataFrame:
    return quality.kinds(table(spark, d, "documents"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked(table(spark, d, "documents"), table(spark, d, "benchmark"))


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leak_report(table(spark, d, "documents"), table(spark, d, "benchmark"))


def _by_points(spark: SparkSession, d: str) -> DataFrame:
    return mixing.sized(table(spark, d, "documents"), F.length("text"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return mixing.unreachable(materialize(_by_points(spark, d), "sizes"), table(spark, d, "mix_targets"))


def _by_tokens(spark: SparkSession, d: str) -> DataFrame:
    from ..functions.tokens import with_tokens

    counted = with_tokens(table(spark, d, "documents").select("doc_id", "source", "text"), count="token_count")
    return mixing.sized(counted, F.col("token_count"))


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixture(materialize(_by_tokens(spark, d), "sizes"), table(spark, d, "mix_targets"))


def p9_mixture_by_chars(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixture(materialize(_by_points(spark, d), "sizes"), table(spark, d, "mix_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(materialize(_by_tokens(spark, d), "sizes"), table(spark, d, "mix_targets"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncated(table(spark, d, "documents"))


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    return truncation.rates(table(spark, d, "documents"))


def p10_limits(spark: SparkSession, d: str) -> DataFrame:
    found = truncation.limits(truncation.endings(table(spark, d, "documents")))
    digits = [F.round(c, 6).alias(c) for c in ("hazard", "near_hazard")]
    return found.select("source", "unit", "length", "ends", "reach", *digits, F.round("log_p", 4).alias("log_p"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p1_repaired, p2_found, p2_shares, p2_verdicts, p3_found, p3_units, p4_found, p4_coverage, p5_found, p5_groups, p6_found, p6_contents, p7_found, p7_statistics, p8_found, p8_report, p9_found, p9_mixture, p9_mixture_by_chars, p9_shares, p10_found, p10_rates, p10_limits)
}
