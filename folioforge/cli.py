"""Command line: one subcommand for each stage, and `run` for all of them.

    python -m folioforge.cli manifest --lib-root /lib --out /lib/manifest --stats /lib/stats --report /lib/report
    python -m folioforge.cli run --lib-root /lib --out /lib/chunks --max-words 222

A stage runs over its rows once: its counters are taken while it writes.
"""

from __future__ import annotations

import argparse
import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .config import CleaningConfig, ManifestConfig, PagesConfig, PipelineConfig, QualityConfig, SplitConfig
from .operators import cleaning, duplicates, identity, pages, quality, reports, sizes, subchunks, text_reports
from .plans import manifest, pipeline
from .sources import jsonl, text_files
from .streaming import stream

STAGES = ("manifest", "pages", "analyze", "clean", "split", "run", "stream", "duplicates", "sizes", "tokens")
WITH_FILES = ("manifest", "pages", "run", "stream", "duplicates", "sizes", "tokens")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    m, p, q, c, k = ManifestConfig(), PagesConfig(), QualityConfig(), CleaningConfig(), SplitConfig()
    top = argparse.ArgumentParser(prog="folioforge")
    stages = top.add_subparsers(dest="stage", required=True)
    for name in STAGES:
        s = stages.add_parser(name)
        s.add_argument("--out", required=True)
        s.add_argument("--stats", help="also write the stage's counters as a line of JSON")
        s.add_argument("--report", help="also write the stage's text report")
        if name in WITH_FILES:
            s.add_argument("--lib-root", required=True)
        if name == "stream":
            s.add_argument("--checkpoint", required=True)
        if name in ("manifest", "run", "stream"):
            s.add_argument("--context-chars", type=int, default=m.context_chars)
            s.add_argument("--max-udc", type=int, default=m.max_codes)
            s.add_argument("--early-limit", type=int, default=m.early_limit)
            s.add_argument("--year-head-chars", type=int, default=m.year_head_chars)
        if name in ("manifest", "run"):
            s.add_argument("--text-by-stem", action="store_true")
        if name in ("manifest", "tokens"):
            s.add_argument("--e5-small-scan-max-bytes", type=int, default=m.small_scan_max_bytes)
            s.add_argument("--e5-min-search-tokens", type=int, default=m.min_search_tokens)
        if name in ("pages", "analyze", "clean", "split"):
            s.add_argument("--input", required=True, help="JSON lines of the stage before")
        if name in ("pages", "run", "stream"):
            s.add_argument("--min-chars", type=int, default=p.min_chars)
        if name in ("analyze", "run"):
            s.add_argument("--lines-format", choices=("dict", "compact"), default=q.lines_format)
        if name in ("clean", "run"):
            s.add_argument("--min-word-len", type=int, default=c.min_word_len)
        if name in ("split", "run"):
            s.add_argument("--max-words", type=int, default=k.max_words)
            s.add_argument("--overlap-words", type=int, default=k.overlap_words)
    return top.parse_args(argv)


def config(a: argparse.Namespace) -> PipelineConfig:
    of = lambda make, **names: make(**{k: getattr(a, v) for k, v in names.items() if hasattr(a, v)})
    of_manifest = {"context_chars": "context_chars", "max_codes": "max_udc", "early_limit": "early_limit", "year_head_chars": "year_head_chars", "text_by_stem": "text_by_stem", "small_scan_max_bytes": "e5_small_scan_max_bytes", "min_search_tokens": "e5_min_search_tokens"}
    return PipelineConfig(
        of(ManifestConfig, **of_manifest), of(PagesConfig, min_chars="min_chars"), of(QualityConfig, lines_format="lines_format"), of(CleaningConfig, min_word_len="min_word_len"), of(SplitConfig, max_words="max_words", overlap_words="overlap_words"),
    )


def with_text(spark: SparkSession, rows: DataFrame, lib_root: str) -> DataFrame:
    """Manifest rows with their files' text; null where the file is missing."""
    files = text_files.scan(spark, lib_root)
    text = files.select("txt_rel", text_files.decoded(F.col("content"), for_pages=True).alias("text"))
    return rows.join(text, "txt_rel", "left")


class Run:
    """One call: where the result, the counters and the report go."""

    def __init__(self, spark: SparkSession, a: argparse.Namespace) -> None:
        self.spark, self.a, self.c, self.began = spark, a, config(a), time.time()

    def seconds(self) -> float:
        return time.time() - self.began

    def stats(self, values: dict) -> None:
        if self.a.stats:
            jsonl.write_object(self.spark, values, self.a.stats)

    def report(self, made: DataFrame | list[str]) -> None:
        if self.a.report:
            text_reports.write(text_reports.head(self.spark, made) if isinstance(made, list) else made, self.a.report)

    def manifest(self) -> None:
        """Rows are built once, without their texts they are kept until all figures are drawn."""
        a, c = self.a, self.c.manifest
        rows = reports.summary_rows(manifest.from_files(self.spark, a.lib_root, c), c).drop("content").persist(StorageLevel.DISK_ONLY)
        jsonl.write(manifest.table(rows), a.out, "txt_rel")
        if a.stats or a.report:
            summary = reports.summary_of(rows, c, a.lib_root, a.out).first().asDict()
            self.stats(summary)
        if a.report:
            counts: dict[str, dict] = {}
            shown = rows.select("parse_mode", "udc_status", "bbk_status", *[F.when(F.col(x) != "", F.col(f"{x}_zone")).alias(f"{x}_zone") for x in ("udc", "bbk")], *[F.least(F.size(f"{x}_hits"), F.lit(c.max_codes)).cast("string").alias(f"{x}_hits") for x in ("udc", "bbk")])
            for r in reports.frequencies(shown, *shown.columns).where("value is not null").collect():
                counts.setdefault(r["name"], {})[r["value"]] = r["n"]
            top = {x: [(r["value"], r["n"]) for r in reports.top_codes(rows, x, "txt_rel").collect()] for x in ("udc", "bbk")}
            self.report(text_reports.manifest_report(summary, {k: counts.get(k, {}) for k in shown.columns}, top))
        rows.unpersist()

    def pages(self) -> None:
        a, lines, counters = self.a, Observation(), Observation()
        rows = with_text(self.spark, jsonl.read(self.spark, a.input, schemas.MANIFEST, lines), a.lib_root)
        jsonl.write(pages.chunk_pages(rows, self.c.pages, counters), a.out, "sid", "page_start")
        self.stats({**counters.get, "bad_json": lines.get["bad_json"]})
        self.report(text_reports.pages_report(counters.get, a.input, a.out, a.report, self.seconds(), lines.get["bad_json"], self.c.pages))

    def analyze(self) -> None:
        a, lines, counters = self.a, Observation(), Observation()
        jsonl.write(quality.analyze(jsonl.read(self.spark, a.input, schemas.PAGES, lines), self.c.quality, counters), a.out, "chunk_id")
        read, took = {k: lines.get[k] for k in ("bad_json", "empty_lines")}, self.seconds()
        self.stats(text_reports.quality_summary(counters.get, a.input, a.out, a.lines_format, took, **read))
        self.report(text_reports.quality_report(counters.get, a.input, a.out, took, **read))

    def clean(self) -> None:
        a, lines, counters = self.a, Observation(), Observation()
        jsonl.write(cleaning.clean_pages(jsonl.read(self.spark, a.input, schemas.ANALYSED, lines), self.c.cleaning, counters), a.out, "chunk_id")
        summary = text_reports.clean_summary(counters.get, a.input, a.out, a.min_word_len, lines.get["bad_json"])
        self.stats(summary)
        self.report(text_reports.clean_report(summary))

    def split(self) -> None:
        a, lines, counters = self.a, Observation(), Observation()
        jsonl.write(subchunks.split_pages(jsonl.read(self.spark, a.input, schemas.CLEANED, lines), self.c.split, counters), a.out, "chunk_id")
        self.stats({**counters.get, "bad_json": lines.get["bad_json"]})
        self.report(text_reports.split_report(counters.get, a.input, a.out, self.seconds(), lines.get["bad_json"], self.c.split))

    def run(self) -> None:
        counters = {name: Observation() for name in pipeline.STAGES}
        jsonl.write(pipeline.run(self.spark, self.a.lib_root, self.c, counters), self.a.out, "chunk_id")
        found = {name: x.get for name, x in counters.items()}
        self.stats(found)
        self.report(text_reports.pages_report(found["pages"], self.a.lib_root, self.a.out, self.a.report, self.seconds(), 0, self.c.pages))

    def stream(self) -> None:
        self.stats(stream.take_new_files(self.spark, self.a.lib_root, self.a.out, self.a.checkpoint, self.c))

    def named(self, files: DataFrame) -> DataFrame:
        rel = F.col("txt_rel")
        return files.withColumns({"doc_id": identity.doc_id(rel), "sid": identity.doc_id(rel), "uid": identity.uid(rel)})

    def duplicates(self) -> None:
        """Only files that share a size are read, in blocks, so of any size."""
        files = self.named(text_files.listed(self.spark, self.a.lib_root))
        hashed = text_files.hashed(duplicates.same_size(files)).persist(StorageLevel.DISK_ONLY)
        members = duplicates.same_size_same_content(hashed, None)
        jsonl.write(members, self.a.out, "report_group_no", "group_index")
        self.stats(duplicates.size_totals(files).first().asDict())
        if self.a.report:
            self.report(text_reports.duplicates_report(members))
        hashed.unpersist()

    def sizes(self) -> None:
        files, c = text_files.scan(self.spark, self.a.lib_root, with_content=False), self.c.manifest
        jsonl.write(sizes.size_distribution(files), self.a.out, "start_bytes")
        if self.a.stats or self.a.report:
            small, buckets = sizes.small_files(files, c).first().asDict(), [r.asDict() for r in sizes.size_distribution(files).collect()]
            self.stats(small)
            self.report(text_reports.sizes_report(self.spark, buckets, small["rows_total"], small["small_file_count"], c))

    def tokens(self) -> None:
        """Short files; their number of tokens is that of words, in place of a subword tokenizer."""
        c = self.c.manifest
        files = self.named(text_files.scan(self.spark, self.a.lib_root)).withColumns({"src_kind": identity.src_kind(F.col("txt_rel")), "src_rel": F.lit("")})
        small = files.where(F.col("size_bytes") <= c.small_scan_max_bytes).withColumn("text", text_files.decoded(F.col("content"))).drop("content")
        found = sizes.token_report(small, sizes.whitespace_tokenizer, config=c).persist(StorageLevel.DISK_ONLY)
        jsonl.write(found, self.a.out, "size_bytes", "txt_rel")
        if self.a.stats or self.a.report:
            control = sizes.token_report_control(found, c).first().asDict()
            self.stats(control)
            self.report(text_reports.tokens_report(found, control, text_files.listed(self.spark, self.a.lib_root).count(), "whitespace", c))
        found.unpersist()


def main(argv: list[str] | None = None) -> None:
    a = arguments(argv)
    # recording where each expression was written takes about a quarter of the planning; a plan whose result turns out
    # empty would lose its counters
    settings = {"spark.python.sql.dataFrameDebugging.enabled": "false", "spark.sql.adaptive.optimizer.excludedRules": "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"}
    spark = SparkSession.builder.appName(f"folioforge {a.stage}").config(map=settings).getOrCreate()
    getattr(Run(spark, a), a.stage)()


if __name__ == "__main__":
    main()
