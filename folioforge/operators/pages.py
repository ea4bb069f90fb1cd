"""Documents cut into pages at form feeds."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..config import PagesConfig
from ..functions.charclass import SPACE, WORD, let, strip
from ..functions.observing import observed
from ..schemas import PAGES, names

#: What rows say about the programs that made them.
GENERATORS = {"manifest_generator_program": "make_manifest", "manifest_generator_version": "1.0", "manifest_schema_version": "2026-04-04 v4.0", "chunk_generator_program": "make_chunks_full", "chunk_generator_version": "1.0"}
BUCKETS = [(20, 49, "20-49"), (50, 99, "50-99"), (100, 499, "100-499"), (500, 999, "500-999"), (1000, None, "1000+")]


def _where_needed(text: Column, needed: tuple[str, ...], pattern: str, put: str) -> Column:
    """text with the pattern replaced; one of `needed` is in every match, and a literal is sought much faster."""
    there = lambda v: reduce(or_, [F.contains(v, F.lit(x)) for x in needed])
    return let(text, lambda v: F.when(there(v), F.regexp_replace(v, pattern, put)).otherwise(v))


def normalize(text: Column) -> Column:
    """Line feeds only, words joined across hyphens at line ends, no blanks before line feeds, two line feeds at most, stripped."""
    steps = [(("\r",), "\r\n?", "\n"), (("-\n",), f"([{WORD}])-\n([{WORD}])", "$1$2"), ((" \n", "\t\n"), "[ \t]+\n", "\n"), (("\n\n\n",), "\n{3,}", "\n\n")]
    for step in steps:
        text = _where_needed(text, *step)
    return strip(text)


def split_text(text: Column) -> Column:
    """The stripped pages of a text; none if there is no form feed and nothing but white space."""
    pieces = lambda t: F.transform(F.split(t, "\f", -1), strip)
    return let(text, lambda t: F.when(F.contains(t, F.lit("\f")) | (strip(t) != ""), pieces(t)).otherwise(F.array().cast("array<string>")))


def clean_scalar(s: Column) -> Column:
    """Stripped; empty as null."""
    return F.nullif(strip(s), F.lit(""))


def slashes(s: Column) -> Column:
    """Forward slashes, stripped; empty as null."""
    return F.nullif(strip(F.translate(s, "\\", "/")), F.lit(""))


def bucket(n: Column) -> Column:
    """The label of a page's length."""
    out = F.lit("OUT_OF_RANGE")
    for low, high, label in reversed(BUCKETS):
        out = F.when((n >= low) if high is None else n.between(low, high), label).otherwise(out)
    return out


def split(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with their pages, also those too short to keep, in `_pages`; a null text (a missing file) has null."""
    return docs.withColumn("_pages", F.when(F.col(text).isNotNull(), split_text(normalize(F.col(text)))))


def all_pages(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with page_no and, in place of its text, that of each page: also of those too short to keep."""
    return each_page(split(docs, text), text)


def each_page(cut: DataFrame, text: str = "text") -> DataFrame:
    others = [c for c in cut.columns if c not in (text, "_pages")]
    return cut.select(*others, F.posexplode_outer("_pages").alias("page_no", text)).where("page_no is not null").withColumn("page_no", F.col("page_no") + 1)


def with_files(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Manifest rows whose file is among `files` (txt_abs, txt_rel, text), with its text: by absolute path, else by relative path."""
    by_abs = files.select(F.col("txt_abs").alias("_abs"), F.col("text").alias("_t1"))
    by_rel = files.select(F.col("txt_rel").alias("_rel"), F.col("text").alias("_t2"))
    rows = manifest.join(by_abs, slashes(F.col("txt_abs")) == F.col("_abs"), "left").join(by_rel, slashes(F.col("txt_rel")) == F.col("_rel"), "left")
    return rows.withColumn("text", F.coalesce("_t1", "_t2")).where("text is not null").drop("_abs", "_rel", "_t1", "_t2")


def missing_files(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Manifest rows whose file is under neither path."""
    rows = manifest.join(files.select(F.col("txt_abs").alias("_abs")), slashes(F.col("txt_abs")) == F.col("_abs"), "left_anti")
    return rows.join(files.select(F.col("txt_rel").alias("_rel")), slashes(F.col("txt_rel")) == F.col("_rel"), "left_anti")


def chunk_pages(manifest: DataFrame, config: PagesConfig = PagesConfig(), counters: Observation | None = None) -> DataFrame:  # noqa: B008
    """The page table of a manifest with a text column. Pages under min_chars characters are left out but keep their numbers.

    `counters` get the figures of page_stats; rows without a path or a text (whose file is missing) are counted, too.
    """
    have = set(manifest.columns)
    col = lambda name, kind="string": F.col(name).cast(kind) if name in have else F.lit(None).cast(kind)
    stem = F.regexp_extract(slashes(col("txt_rel")), r"([^/]*?)(?:\.[^./]*)?$", 1)
    rows = manifest.select(
        F.coalesce(clean_scalar(col("sid")), stem).alias("sid"), F.coalesce(clean_scalar(col("doc_id")), stem).alias("doc_id"), col("uid").alias("uid"),
        clean_scalar(col("topic")).alias("topic"), clean_scalar(col("txt_sha1")).alias("txt_sha1"), slashes(col("txt_rel")).alias("txt_rel"), slashes(col("txt_abs")).alias("txt_abs"),
        clean_scalar(col("src_kind")).alias("src_kind"), slashes(col("src_rel")).alias("src_rel"), F.coalesce(col("src_exists", "boolean"), F.lit(False)).alias("src_exists"),
        slashes(col("rel_path_stg1")).alias("rel_path_stg1"), *[clean_scalar(col(c)).alias(c) for c in ("authors", "title", "year", "udc", "bbk")], col("size_bytes", "bigint").alias("size_bytes_txt"), "text",
    )
    pages = each_page(observed(split(rows), counters, page_counters(config))).where(F.length("text") >= config.min_chars)
    pages = pages.withColumns({"chunk_id": F.format_string("%s::p%05d", "sid", "page_no"), "page_start": F.col("page_no"), "page_end": F.col("page_no"), **{k: F.lit(v) for k, v in GENERATORS.items()}})
    return pages.select(*names(PAGES))


def page_counters(config: PagesConfig, path: str | None = "txt_rel") -> dict[str, Column]:
    """Aggregates over split texts: rows without a path and without a text, documents, pages seen, kept and short, documents without a kept page, characters and lengths by bucket."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    lengths = F.transform("_pages", F.length)
    kept = F.filter(lengths, lambda n: n >= config.min_chars)
    chars = F.aggregate(kept, F.lit(0).cast("bigint"), lambda s, n: s + n)
    within = lambda low, high: F.size(F.filter(kept, lambda n: (n >= low) if high is None else n.between(low, high)))
    there = F.col("_pages").isNotNull()
    given = F.coalesce(F.col(path), F.lit("")) != "" if path else F.lit(True)
    return {
        "skipped_no_txt_rel": F.count_if(~given), "missing_txt": F.count_if(given & ~there), "docs": F.count_if(there), "pages": total(F.when(there, F.size("_pages"))), "pages_written": total(F.when(there, F.size(kept))),
        "pages_short": total(F.when(there, F.size("_pages") - F.size(kept))), "docs_without_pages": F.count_if(there & (F.size(kept) == 0)), "chars": total(F.when(there, chars)), "min_chars": F.min(F.array_min(kept)), "max_chars": F.max(F.array_max(kept)),
        **{f"len_{low}": total(F.when(there, within(low, high))) for low, high, _ in BUCKETS},
    }


def page_stats(docs: DataFrame, key: str = "doc_id", config: PagesConfig = PagesConfig()) -> DataFrame:  # noqa: B008
    """One row with page_counters of texts and the average characters of a kept page."""
    counted = page_counters(config, None)
    out = split(docs).agg(*[counted[k].alias(k) for k in counted if k not in ("skipped_no_txt_rel", "missing_txt")])
    return out.withColumn("avg_chars", F.when(F.col("pages_written") > 0, F.bround(F.col("chars") / F.col("pages_written"), 6)).otherwise(0.0))
