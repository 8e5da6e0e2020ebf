"""The folder run: stage and check JSON lines, repair and gate, three deduplications, route.

Every stage ends in a Parquet table under ``work/`` and an entry in ``manifest.json``; a run that
resumes takes up the longest prefix of finished stages, provided that options and input are the
same.  Every input row ends in ``survive/`` or ``eliminated/``, which is checked.
"""

from __future__ import annotations

import argparse
import hashlib
import json
import os
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import dedup, filters, repair, routing
from ..session import build_session, ship
from ..sources import roots

STAGES = ("input", "book_quality", "exact_dedup", "sentence_dedup", "minhash_dedup", "routing")


@dataclass(frozen=True)
class BookOptions:
    page_markers: tuple[str, ...] = ("---",)
    keep_image_placeholders: bool = False
    skip_long_line_loops: bool = False
    dehyphenate_line_breaks: bool = False
    max_consecutive_blank_lines: int = 2
    sentence_n: int = 3
    sentence_span_words: int = 25


def fingerprint(spark: SparkSession, folders: dict[str, str]) -> str:
    """SHA-256 over names, sizes and times of change of all input files, from their listing alone."""
    parts = []
    for label, folder in sorted(folders.items()):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl*").load(folder)
        parts.append(files.select(F.lit(label).alias("label"), "path", "length", F.col("modificationTime").cast("double").alias("changed")))
    listed = routing.union_all(*parts)
    row = listed.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("size"), F.bit_xor(F.xxhash64("label", "path", "length", "changed")).alias("h")).first()
    return hashlib.sha256(f"{row['n']} {row['size']} {row['h']}".encode()).hexdigest()


def numbered_lines(lines: DataFrame) -> DataFrame:
    """``lines`` (relpath, block, at, raw) with each one's number in its file.

    Lines are numbered inside their block of the file; the blocks' line counts, summed up per file,
    go before.  So no task holds a file, however much of the corpus it is.
    """
    sizes = lines.groupBy("relpath", "block").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("relpath").orderBy("block")) - F.col("n")
    inner = F.row_number().over(Window.partitionBy("relpath", "block").orderBy("at"))
    placed = lines.withColumn("inner", inner).join(sizes.select("relpath", "block", before.alias("before")), ["relpath", "block"])
    return placed.withColumn("line", (F.col("before") + F.col("inner")).cast("long")).drop("inner", "before")


class FolderRun:
    def __init__(self, spark: SparkSession, inputs: Sequence[str], output: str, options: BookOptions | None = None, resume: bool = False) -> None:
        self.spark, self.options, self.resume = spark, options or BookOptions(), resume
        self.folders = roots(inputs)
        self.out = Path(output).resolve()
        self.manifest = self.out / "manifest.json"

    # -- state ---------------------------------------------------------------------------------
    def _open(self) -> dict:
        self.out.mkdir(parents=True, exist_ok=True)
        state = {"options": json.loads(json.dumps(asdict(self.options))), "fingerprint": fingerprint(self.spark, self.folders), "done": [], "stats": {}}
        if self.manifest.exists():
            if not self.resume:
                raise FileExistsError(f"{self.manifest} exists; resume, or choose another folder")
            old = json.loads(self.manifest.read_text())
            if old["options"] != state["options"] or old["fingerprint"] != state["fingerprint"]:
                raise ValueError("options or input differ from those of the run to resume")
            if tuple(old["done"]) != STAGES[: len(old["done"])]:
                raise ValueError("finished stages are no prefix of all stages")
            return old
        return state

    def _save(self, state: dict) -> None:
        temporary = self.manifest.with_suffix(".tmp")
        temporary.write_text(json.dumps(state, indent=1, sort_keys=True))
        temporary.replace(self.manifest)

    def _table(self, name: str) -> str:
        return str(self.out / "work" / name)

    def _stage(self, state: dict, name: str, build) -> DataFrame:
        path = self._table(name)
        if name not in state["done"]:
            build().write.mode("overwrite").parquet(path)
            state["done"].append(name)
            self._save(state)
        return self.spark.read.parquet(path)

    # -- stages --------------------------------------------------------------------------------
    def _input(self) -> DataFrame:
        parts = []
        for label, folder in self.folders.items():
            lines = self.spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl*").text(folder)
            rel = F.regexp_replace(F.col("_metadata.file_path"), "^file:/*", "/")
            rel = F.substring(rel, len(str(folder)) + 2, 1 << 20)
            name = F.concat(F.lit(f"{label}/"), rel) if label else rel
            parts.append(lines.select(name.alias("relpath"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("raw")))
        lines = routing.union_all(*parts)
        # written before it is numbered, so that the numbers stand on fixed rows
        staged = self._table("lines")
        lines.write.mode("overwrite").parquet(staged)
        numbered = numbered_lines(self.spark.read.parquet(staged))
        numbered = numbered.where(X.strip(F.col("raw")) != "")
        checked = routing.validate_lines(numbered, "raw", "relpath", "line")
        order = F.concat_ws("#", "relpath", F.lpad(F.col("line").cast("string"), 12, "0"))
        return checked.select("uid", order.alias("doc_ord"), "relpath", "line", "raw", "text", F.col("reason").alias("filter_reason"))

    def run(self) -> dict:
        lock = self.out.with_name(self.out.name + ".lock")
        self.out.parent.mkdir(parents=True, exist_ok=True)
        handle = os.open(lock, os.O_CREAT | os.O_EXCL)
        try:
            return self._run()
        finally:
            os.close(handle)
            lock.unlink()

    def _run(self) -> dict:
        ship(self.spark)
        state = self._open()
        if tuple(state["done"]) == STAGES:
            return state["stats"]
        o = self.options
        staged = self._stage(state, "input", self._input)
        valid = staged.where("filter_reason is null").drop("filter_reason")

        def gate() -> DataFrame:
            fixed = repair.repair_book(
                valid, rules=repair.PageRules(markers=o.page_markers), images=not o.keep_image_placeholders, loops=not o.skip_long_line_loops,
                dehyphenate=o.dehyphenate_line_breaks, max_blank_lines=o.max_consecutive_blank_lines,
            )
            text = F.col("text")
            reason = filters.chain(filters.repeated_lines(text, None, None, 0.5, 0.5), filters.book_quality(text))
            return fixed.withColumn("filter_reason", reason)

        gated = self._stage(state, "book_quality", gate)
        passed = gated.where("filter_reason is null").drop("filter_reason")
        exact = self._stage(state, "exact_dedup", lambda: dedup.exact_dedup(passed, F.col("text"), "doc_ord"))

        def sentence() -> DataFrame:
            dup = dedup.sentence_duplicates(dedup.sentence_shingles(exact, o.sentence_n, "doc_ord"), "doc_ord")
            cleaned = dedup.sentence_dedup(exact, dup, o.sentence_n, min_words_span=o.sentence_span_words, order="doc_ord")
            return exact.drop("text").join(cleaned, "doc_ord")

        sentenced = self._stage(state, "sentence_dedup", sentence)
        kept = sentenced.where("filter_reason is null").drop("filter_reason")

        def near() -> DataFrame:
            ids = kept.withColumn("doc_id", F.xxhash64("doc_ord"))
            clusters = dedup.minhash_clusters(dedup.minhash_signatures(ids))
            # only clustered rows are joined and grouped; all others pass by
            members = ids.select("doc_id", "doc_ord").join(clusters, "doc_id")
            first = members.groupBy("minhash_cluster_id").agg(F.min("doc_ord").alias("first"))
            lost = members.join(first, "minhash_cluster_id").where(F.col("doc_ord") != F.col("first")).select("doc_id")
            kept_ids = ids.join(lost, "doc_id", "left_anti").join(clusters, "doc_id", "left")
            return kept_ids.drop("doc_id")

        survivors = self._stage(state, "minhash_dedup", near)

        def routed() -> DataFrame:
            gone = [
                staged.where("filter_reason is not null").select("uid", "relpath", "line", "text", "filter_reason", F.lit("input").alias("exclusion_stage")),
                gated.where("filter_reason is not null").select("uid", "relpath", "line", "text", "filter_reason", F.lit("book_quality").alias("exclusion_stage")),
            ]
            unsaid = F.lit(None).cast("string")
            for before, after, name, said in (
                (passed, exact, "exact_dedup", unsaid), (sentenced, kept, "sentence_dedup", F.col("filter_reason")), (kept, survivors, "minhash_dedup", unsaid),
            ):
                lost = routing.dropped_between(before, after, "uid")
                reason = routing.final_reason(F.lit(name), F.lit(name), said)
                gone.append(lost.select("uid", "relpath", "line", "text", reason.alias("filter_reason"), F.lit(name).alias("exclusion_stage")))
            none = F.lit(None).cast("string")
            alive = survivors.select("uid", "relpath", "line", "text", none.alias("filter_reason"), none.alias("exclusion_stage"))
            return routing.route(alive, routing.union_all(*gone))

        done = self._stage(state, "routing", routed)
        check = routing.balance(done).first()
        n = staged.count()
        if not check["balanced"] or check["input"] != n:
            raise RuntimeError(f"routed {check['input']} of {n} rows")
        for category in ("survive", "eliminated"):
            part = done.where(F.col("category") == category).drop("category").withColumn("source", F.col("relpath"))
            part.write.mode("overwrite").partitionBy("source").option("compression", "gzip").json(str(self.out / category))
        reasons = {r["filter_reason"]: r["n"] for r in done.where("category = 'eliminated'").groupBy("filter_reason").agg(F.count(F.lit(1)).alias("n")).collect()}
        state["stats"] = {"input": n, "survive": check["survive"], "eliminated": check["eliminated"], "reasons": reasons}
        self._save(state)
        (self.out / "summary.json").write_text(json.dumps(state["stats"], indent=1, sort_keys=True))
        return state["stats"]


def parse_arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="vellum", description="Curate folders of JSON lines.")
    p.add_argument("folders", nargs="*", help="input folders, then the output folder")
    p.add_argument("--input-folders-file", help="a list of input folders, one a line, relative to the list")
    p.add_argument("--resume", action="store_true")
    p.add_argument("--page-marker", action="append", default=None)
    p.add_argument("--keep-image-placeholders", action="store_true")
    p.add_argument("--skip-long-line-loops", action="store_true")
    p.add_argument("--dehyphenate-line-breaks", action="store_true")
    p.add_argument("--max-consecutive-blank-lines", type=int, default=2)
    a = p.parse_args(argv)
    listed: list[str] = []
    if a.input_folders_file:
        base = Path(a.input_folders_file).resolve().parent
        for line in Path(a.input_folders_file).read_text().splitlines():
            line = line.strip()
            if line and not line.startswith("#"):
                listed.append(str((base / line).resolve()))
    if not a.folders or (len(a.folders) < 2 and not listed):
        p.error("give at least one input folder and the output folder")
    a.inputs, a.output = [*a.folders[:-1], *listed], a.folders[-1]
    a.options = BookOptions(
        tuple(a.page_marker or ("---",)), a.keep_image_placeholders, a.skip_long_line_loops, a.dehyphenate_line_breaks, a.max_consecutive_blank_lines
    )
    return a


def main(argv: Sequence[str] | None = None) -> int:
    a = parse_arguments(argv)
    stats = FolderRun(build_session(), a.inputs, a.output, a.options, a.resume).run()
    print(json.dumps(stats, sort_keys=True))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
