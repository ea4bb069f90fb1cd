"""Registered queries of the corpus engine and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning, codes, duplicates, identity, names, pages, quality, reports, sizes, subchunks, text_reports
from . import fixtures, manifest, pipeline
from .oracles import ORACLES as ORACLES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(make: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Registers a query; its whole numbers are all bigint, as SQL engines differ on smaller ones."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = make(spark, sf_dir)
        return df.select(*[F.col(c).cast("bigint").alias(c) if t in ("int", "smallint", "tinyint") else F.col(c) for c, t in df.dtypes])

    QUERIES[make.__name__] = run
    return make


@query
def doc_ids(spark, d):
    rel = F.col("txt_rel")
    return fixtures.files(spark, d).select("id", "txt_rel", identity.uid(rel).alias("uid"), identity.doc_id(rel).alias("doc_id"), identity.src_kind(rel).alias("src_kind"), identity.stem(rel).alias("stem"), identity.file_name(rel).alias("file_name"))


@query
def src_kind_counts(spark, d):
    return reports.frequencies(fixtures.files(spark, d).select(identity.src_kind(F.col("txt_rel")).alias("src_kind")), "src_kind")


@query
def human_sizes(spark, d):
    return fixtures.files(spark, d).select("id", identity.human_size(F.col("size_bytes")).alias("size"), identity.human_size(F.col("size_bytes") * 5000).alias("larger"))


@query
def size_histogram(spark, d):
    return sizes.size_distribution(fixtures.files(spark, d))


@query
def exact_duplicates(spark, d):
    rel = F.col("txt_rel")
    rows = fixtures.files(spark, d).withColumns({"doc_id": identity.doc_id(rel), "sid": identity.doc_id(rel), "uid": identity.uid(rel)})
    return duplicates.same_size_same_content(rows, "text")


@query
def size_totals(spark, d):
    return duplicates.size_totals(fixtures.files(spark, d))


@query
def stem_index(spark, d):
    return identity.stem_index(fixtures.colliding(spark, d))


@query
def stem_join(spark, d):
    return identity.stem_join(fixtures.colliding(spark, d), "text").select("id", "txt_rel", "text_rel", F.sha1(F.col("text").cast("binary")).alias("text_sha1"))


@query
def name_fields(spark, d):
    """Names of all documents as files of a library, by every rule of the cascade."""
    return names.parse_names(fixtures.library(spark, d).select("id", "name"))


@query
def library_manifest(spark, d):
    """The whole manifest of a library: real names, codes, years from names or texts, and texts that can't be read."""
    rows = manifest.build(fixtures.library(spark, d).drop("id", "name"))
    return manifest.table(rows, "parse_mode", "udc_status", "bbk_status", "udc_zone")


@query
def path_scalars(spark, d):
    raw = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("  a\\b"), F.col("doc_id").cast("string"), F.lit("\t"))).when(F.col("doc_id") % 4 == 1, " \u00a0 ").when(F.col("doc_id") % 4 == 2, "x\\y/z")
    rows = fixtures.documents(spark, d).select("doc_id", raw.alias("raw"))
    return rows.select("doc_id", pages.slashes(F.col("raw")).alias("slashes"), pages.clean_scalar(F.col("raw")).alias("scalar"), identity.norm(F.col("raw")).alias("norm"))


@query
def manifest_rows(spark, d):
    return manifest.table(manifest.build(fixtures.files(spark, d).drop("id")))


@query
def page_rows(spark, d):
    rows = manifest.build(fixtures.files(spark, d).drop("id"))
    return pages.chunk_pages(rows).withColumn("text", F.sha1(F.col("text").cast("binary")))


@query
def missing_files(spark, d):
    """Files of every tenth document are gone; every third manifest row has only its relative path."""
    rows = fixtures.files(spark, d)
    listed = rows.drop("text").withColumn("txt_abs", F.when(F.col("id") % 3 > 0, F.col("txt_abs")))
    there = rows.where("id % 10 > 0")
    missing = pages.missing_files(listed, there).select("id", F.lit("missing").alias("state"))
    return missing.unionByName(pages.with_files(listed, there).select("id", F.lit("read").alias("state")))


@query
def consistency(spark, d):
    rows = fixtures.files(spark, d).withColumn("doc_id", F.when(F.col("id") % 9 == 0, "wrong").otherwise(identity.doc_id(F.col("txt_rel"))))
    return identity.consistency(rows).select("id", "doc_id_ok", "txt_abs_ok", "txt_rel_ok")


@query
def small_files(spark, d):
    return sizes.small_files(fixtures.files(spark, d))


@query
def duplicate_report(spark, d):
    rel = F.col("txt_rel")
    rows = fixtures.files(spark, d).withColumns({"doc_id": identity.doc_id(rel), "sid": identity.doc_id(rel), "uid": identity.uid(rel)})
    return reports.duplicate_lines(duplicates.same_size_same_content(rows, "text"))


def _coded(spark, d):
    return codes.code_columns(fixtures.coded(spark, d))


@query
def udc_codes(spark, d):
    return _coded(spark, d).select("doc_id", "udc", "udc_zone", "udc_status", F.size("udc_hits").alias("hits"), F.get("udc_hits", F.lit(0))["pos_from_start"].alias("first_pos"))


@query
def udc_hit_rows(spark, d):
    return fixtures.coded(spark, d).select("doc_id", F.explode_outer(codes.udc_hits(F.col("text"), 80)).alias("x")).where("x is not null").select("doc_id", "x.*")


@query
def code_frequencies(spark, d):
    return reports.frequencies(_coded(spark, d), "udc_zone", "udc_status")


@query
def hit_counts(spark, d):
    return reports.hit_counts(_coded(spark, d), "udc_hits")


@query
def hit_listing(spark, d):
    return reports.debug_lines(_coded(spark, d).withColumn("txt_rel", F.col("doc_id").cast("string")))


@query
def bbk_codes(spark, d):
    return _coded(spark, d).select("doc_id", "bbk", "bbk_zone", "bbk_status", F.size("bbk_hits").alias("hits"))


@query
def text_year(spark, d):
    return fixtures.coded(spark, d).select("doc_id", codes.text_year(F.col("text"), 5000).alias("year"))


@query
def merged_year(spark, d):
    named = F.when(F.col("doc_id") % 3 == 0, "1955").when(F.col("doc_id") % 3 == 1, "1111")
    return fixtures.coded(spark, d).select("doc_id", codes.merged_year(named, codes.text_year(F.col("text"), 5000)).alias("year"))


@query
def top_codes(spark, d):
    return reports.top_codes(_coded(spark, d), "udc", "doc_id")


@query
def code_weights(spark, d):
    """Rows only: the similarity of compare forms has no SQL form."""
    rows = fixtures.coded(spark, d).withColumn("hits", codes.udc_hits(F.col("text"), 80)).withColumn("choice", codes.accepted(F.col("hits")))
    return rows.select("doc_id", codes.weight(F.col("choice"), codes.udc_form).alias("weight"))


@query
def normalize_pages(spark, d):
    return fixtures.books(spark, d).select("book", F.sha1(pages.normalize(F.col("text")).cast("binary")).alias("sha1"))


@query
def page_split(spark, d):
    rows = pages.all_pages(fixtures.books(spark, d)).where(F.length("text") >= 20)
    return rows.select("book", "page_no", F.length("text").alias("chars"), F.sha1(F.col("text").cast("binary")).alias("sha1"))


@query
def page_length_buckets(spark, d):
    rows = pages.all_pages(fixtures.books(spark, d)).where(F.length("text") >= 20)
    return rows.groupBy(pages.bucket(F.length("text")).alias("bucket")).agg(F.count("*").alias("n"))


@query
def page_stats(spark, d):
    return pages.page_stats(fixtures.books(spark, d).withColumnRenamed("book", "doc_id"))


def _lines(rows):
    return rows.select("doc_id", F.explode_outer(quality.line_entries(F.col("text"))).alias("x")).where("x is not null").select("doc_id", "x.*")


@query
def line_metrics(spark, d):
    return _lines(fixtures.mutated(spark, d))


@query
def line_class_counts(spark, d):
    return _lines(fixtures.order_tables(spark, d).unionByName(fixtures.mutated(spark, d))).groupBy("line_class", "table_like_score_line").agg(F.count("*").alias("n"))


def _pages(rows):
    """Texts as pages with the path columns that the cleaner asks for."""
    rel = F.concat(F.lit("OCR_TXT"), F.when(F.col("doc_id") % 7 == 0, "/tab").otherwise(""), F.lit("/doc"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return rows.withColumns({"txt_rel": rel, "txt_abs": F.lit(None).cast("string"), "page_start": F.lit(1), "year": F.lit(None).cast("string")})


@query
def page_metrics(spark, d):
    return quality.analyze(fixtures.mutated(spark, d)).drop("text", "lines", "doc_id16")


@query
def table_page_metrics(spark, d):
    return quality.analyze(fixtures.order_tables(spark, d)).drop("text", "lines", "doc_id16")


@query
def junk_flags(spark, d):
    rows = quality.analyze(fixtures.mutated(spark, d))
    return rows.agg(*[F.count_if(f).alias(k) for k, f in quality.junk_flags().items()])


@query
def quality_class_counts(spark, d):
    return quality.analyze(fixtures.mutated(spark, d)).groupBy("quality_class", "junk_score").agg(F.count("*").alias("n"))


@query
def quality_stats(spark, d):
    return quality.quality_stats(quality.analyze(fixtures.mutated(spark, d)))


@query
def compact_lines(spark, d):
    """Line entries in the compact form and back."""
    there = quality.compact(quality.analyze(fixtures.mutated(spark, d)))
    return quality.expand(there).select("doc_id", F.explode_outer("lines").alias("x")).where("x is not null").select("doc_id", "x.line_no", "x.has_digit", "x.line_class", "x.text_len")


@query
def normalize_line(spark, d):
    lines = fixtures.mutated(spark, d).select("doc_id", F.posexplode_outer(cleaning.raw_lines(F.col("text"))).alias("i", "s"))
    return lines.select("doc_id", "i", cleaning.normalize_line(F.col("s")).alias("line"))


@query
def table_line_filter(spark, d):
    lines = fixtures.coded(spark, d).select("doc_id", F.posexplode_outer(cleaning.raw_lines(F.col("text"))).alias("i", "s")).withColumn("line", cleaning.normalize_line(F.col("s")))
    return lines.select("doc_id", "i", cleaning.keep_tokens(F.col("line"), 3).alias("x")).select("doc_id", "i", "x.*")


@query
def tab_page_clean(spark, d):
    rows = fixtures.order_tables(spark, d).unionByName(fixtures.mutated(spark, d))
    return rows.select("doc_id", cleaning.clean_tab(F.col("text")).alias("x")).select("doc_id", "x.*")


def _cleaned(spark, d):
    return cleaning.clean_all(quality.analyze(_pages(fixtures.mutated(spark, d))))


@query
def line_decisions(spark, d):
    return _cleaned(spark, d).where("not is_tab").select("doc_id", F.explode_outer("decisions").alias("x")).select("doc_id", "x.*")


@query
def removal_reasons(spark, d):
    return _cleaned(spark, d).where("not is_tab").select("quality_class", F.explode_outer("decisions").alias("x")).groupBy("quality_class", "x.action", "x.reason").agg(F.count("*").alias("n"))


@query
def clean_pages(spark, d):
    rows = cleaning.clean_pages(quality.analyze(_pages(fixtures.mutated(spark, d))))
    return rows.select("doc_id", "clean_mode", "text_before_clean_len", "text_after_clean_len", "chunk_changed", F.sha1(F.col("text").cast("binary")).alias("sha1"))


@query
def clean_summary(spark, d):
    return cleaning.clean_summary(_cleaned(spark, d))


@query
def subchunk_texts(spark, d):
    rows = fixtures.documents(spark, d).select(F.col("doc_id").cast("string").alias("doc_id"), "text", F.lit(1).alias("page_start"), F.lit("1999").alias("year"), F.lit("x").alias("txt_rel"))
    return subchunks.split_pages(rows)


@query
def subchunk_stats(spark, d):
    return subchunks.split_stats(fixtures.documents(spark, d))


@query
def token_report(spark, d):
    rel = F.col("txt_rel")
    rows = fixtures.files(spark, d).withColumns({"doc_id": identity.doc_id(rel), "sid": identity.doc_id(rel), "uid": identity.uid(rel), "src_kind": identity.src_kind(rel), "src_rel": F.lit("")})
    return sizes.token_report(rows, sizes.whitespace_tokenizer).select("txt_rel", "size_bytes", "token_count_e5", "is_searchable_e5", "error", F.sha1(F.col("text_for_report").cast("binary")).alias("report_sha1"))


@query
def token_report_control(spark, d):
    rel = F.col("txt_rel")
    rows = fixtures.files(spark, d).withColumns({"doc_id": identity.doc_id(rel), "sid": identity.doc_id(rel), "uid": identity.uid(rel), "src_kind": identity.src_kind(rel), "src_rel": F.lit("")})
    return sizes.token_report_control(sizes.token_report(rows, sizes.whitespace_tokenizer))


@query
def manifest_summary(spark, d):
    """The run's summary over a library: its names, codes and years, sizes and contents that files share, stems that recur."""
    return reports.manifest_summary(manifest.build(fixtures.library(spark, d).drop("id", "name")), lib_root="/lib", out="/lib/manifest.jsonl")


@query
def library_pages(spark, d):
    """Pages of books with real names, each with its own number."""
    rows = pages.chunk_pages(manifest.build(fixtures.library_books(spark, d).drop("book")))
    return rows.select("chunk_id", "doc_id", "txt_rel", "src_kind", "page_start", "page_end", F.sha1(F.col("text").cast("binary")).alias("text"), "authors", "title", "year", "udc", "bbk", "size_bytes_txt")


@query
def parse_modes(spark, d):
    """How often each rule gave a name its fields, and each kind of source occurs."""
    rows = fixtures.library(spark, d).select("txt_rel", "name")
    return reports.frequencies(names.parse_names(rows, "name").withColumn("src_kind", identity.src_kind(F.col("txt_rel"))), "parse_mode", "src_kind")


@query
def duplicates_text(spark, d):
    """The report on equal files, line by line, with the places that order it."""
    rel = F.col("txt_rel")
    rows = fixtures.files(spark, d).withColumns({"doc_id": identity.doc_id(rel), "sid": identity.doc_id(rel), "uid": identity.uid(rel)})
    return text_reports.duplicates_report(duplicates.same_size_same_content(duplicates.same_size(rows), "text"))


@query
def line_alignment(spark, d):
    """Which entry each line of a page gets: entries under every column name, in place, by number (some twice), by place among filled lines, or unusable."""
    rows = fixtures.entry_columns(spark, d)
    pairs = cleaning.aligned(cleaning.raw_lines(F.col("text")), cleaning.line_entries_of(rows))
    return rows.select("doc_id", F.posexplode(pairs).alias("i", "x")).select("doc_id", "i", F.col("x.entry.text_len").alias("mark"), F.col("x.entry.token_count_simple").alias("tokens"))


@query
def pipeline_end_to_end(spark, d):
    """All five stages: documents as files, to the final chunks."""
    rows = manifest.build(fixtures.files(spark, d).drop("id"))
    return pipeline.chunks(rows)
