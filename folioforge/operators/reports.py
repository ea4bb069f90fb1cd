"""Corpus counters and text reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ManifestConfig
from ..functions.charclass import words
from . import codes, identity, sizes
from .pages import GENERATORS


def frequencies(df: DataFrame, *columns: str) -> DataFrame:
    """(name, value, n): how often each value of each column occurs."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns]))
    return df.select(pairs.alias("x")).groupBy("x.name", "x.value").agg(F.count("*").alias("n"))


def top_codes(df: DataFrame, value: str, order: str, limit: int = 100) -> DataFrame:
    """(value, n): the most frequent values that aren't empty; of equal counts the one seen first."""
    counted = df.where(F.coalesce(F.col(value), F.lit("")) != "").groupBy(F.col(value).alias("value")).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return counted.orderBy(F.desc("n"), "first").limit(limit).select("value", "n")


def hit_counts(df: DataFrame, hits: str, config: ManifestConfig = ManifestConfig()) -> DataFrame:  # noqa: B008
    """(hits, n): rows by number of hits, capped at max_codes."""
    return df.groupBy(F.least(F.size(hits), F.lit(config.max_codes)).alias("hits")).agg(F.count("*").alias("n"))


def _counted(config: ManifestConfig) -> dict[str, Column]:
    """The summary's counters over single rows of a built manifest, by key."""
    filled = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    read, small = F.col("text").isNotNull(), F.col("size_bytes") <= config.small_scan_max_bytes
    from_name = codes.valid_year(F.col("name_year"))
    from_text = ~from_name & codes.valid_year(F.col("text_year"))
    tokens = F.col("token_count_e5") if config.tokens_given else F.size(words(F.col("text")))
    checks = identity.checks()
    return {
        "doc_id_eq_stem_stg1_ok": checks["doc_id_ok"], "txt_abs_eq_full_path_stg1_ok": checks["txt_abs_ok"], "txt_rel_eq_rel_path_stg1_ok": checks["txt_rel_ok"],
        "mismatch_rows_logged": ~(checks["doc_id_ok"] & checks["txt_abs_ok"] & checks["txt_rel_ok"]), "year_from_stg1": from_name, "year_from_stg2": from_text, "year_fallback_to_raw_stg1": ~from_name & ~from_text,
        "stage1_year_found": F.col("name_year").isNotNull(), "stage1_year_missing": F.col("name_year").isNull(), "stage1_year_unknown_marker_1111": F.col("name_year") == "1111",
        "stage1_authors_found": filled("authors"), "stage1_authors_missing": ~filled("authors"), "text_read_ok": read, "text_not_found": F.lit(False), "text_read_error": ~read, "year_stg2_found_rows": ~from_name & filled("text_year"),
        **{f"{c}_{k}_rows": read & f for c in ("udc", "bbk") for k, f in (("found", filled(c)), ("not_found", ~filled(c)))},
        **{f"src_kind_{k}_rows": F.coalesce(F.col("src_kind"), F.lit("not_determined")) == k for k in ("pdf", "djvu", "not_determined")},
        "small_file_count": F.col("size_bytes") <= config.small_file_max_bytes, "e5_candidate_file_count": small, "e5_analyzed_file_count": small,
        "e5_not_searchable_file_count": small & (tokens < config.min_search_tokens), "e5_searchable_file_count": small & (tokens >= config.min_search_tokens),
    }


def summary_rows(rows: DataFrame, config: ManifestConfig = ManifestConfig()) -> DataFrame:  # noqa: B008
    """rows of a built manifest with what the summary counts, and without their texts: a counter for each key, and `grains`, the groups a row counts in."""
    flags = {k: F.coalesce(f, F.lit(False)).cast("bigint") for k, f in _counted(config).items()}
    grain = lambda name, key: F.struct(F.lit(name).alias("grain"), key.alias("key"))
    content = F.when(F.col("text").isNotNull() & F.col("size_bytes").isNotNull(), F.concat_ws(":", F.col("size_bytes").cast("string"), F.sha1(F.col("text").cast("binary"))))
    grains = F.array(grain("row", F.lit("")), grain("size", F.col("size_bytes").cast("string")), grain("content", content), grain("stem", identity.stem(F.col("txt_rel"))))
    return rows.withColumns({**flags, "grains": grains}).drop("text")


def summary_of(slim: DataFrame, config: ManifestConfig = ManifestConfig(), lib_root: str = "", out: str = "") -> DataFrame:  # noqa: B008
    """One row with the 44 keys, from summary_rows.

    Each row counts for itself, for its size, for its size and content, and for its stem. These groups are counted
    first (a frequent one is combined before the shuffle), then summed up: one pass and two levels for all.
    """
    flags = list(_counted(config))
    each = slim.select(F.explode("grains").alias("g"), *flags).where("g.key is not null").select("g.*", *flags)
    own = F.col("grain") == "row"
    groups = each.groupBy("grain", "key").agg(F.count("*").alias("n"), *[F.sum(F.when(own, F.col(k))).alias(k) for k in flags])
    of = lambda grain: (F.col("grain") == grain) & (F.col("n") > 1)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    made = groups.agg(
        total(F.when(own, F.col("n"))).alias("rows_total"), *[total(k).alias(k) for k in flags], F.count_if(of("stem")).alias("unique_collision_stems"),
        F.count_if(of("content")).alias("same_size_same_content_group_count"), total(F.when(of("content"), F.col("n"))).alias("same_size_same_content_file_count"),
        total(F.when(of("size"), F.col("n"))).alias("total_files_in_size_groups"), F.count_if(of("size")).alias("total_unique_sizes_with_duplicates"),
    )
    about = {"program": GENERATORS["manifest_generator_program"], "version": GENERATORS["manifest_generator_version"], "manifest_schema_version": GENERATORS["manifest_schema_version"], "lib_root": lib_root, "scan_root": f"{lib_root}/OCR_TXT" if lib_root else "", "out_manifest": out}
    limits = {"size_distribution_bucket_count": len(sizes.RANGES), "small_file_max_bytes": config.small_file_max_bytes, "e5_small_scan_max_bytes": config.small_scan_max_bytes, "e5_min_search_tokens": config.min_search_tokens}
    return made.select(*[F.lit(v).alias(k) for k, v in about.items()], *made.columns, *[F.lit(v).cast("bigint").alias(k) for k, v in limits.items()])


def manifest_summary(rows: DataFrame, config: ManifestConfig = ManifestConfig(), lib_root: str = "", out: str = "") -> DataFrame:  # noqa: B008
    """One row with the 44 keys of a run's summary, over a built manifest with its texts.

    A text that can't be read has no content; rows without a size are in no size group. Token counts are of words
    between white space, or those of a column token_count_e5 if config.tokens_given.
    """
    return summary_of(summary_rows(rows, config), config, lib_root, out)


def clock(seconds: float) -> str:
    """HH:MM:SS, to the nearest second."""
    s = max(0, round(seconds))
    return f"{s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d}"


def duplicate_lines(members: DataFrame) -> DataFrame:
    """The report on equal files as lines, in order: a head for each group, then its members."""
    head = F.format_string("[GROUP %d] size_group_no=%d size_bytes=%d files=%d | content_sha1=%s", "report_group_no", "size_group_no", "size_bytes", "group_size", "content_sha1")
    body = F.format_string("  - #%d | size_group_no=%d | size_bytes=%d | content_sha1=%s | doc_id=%s | sid=%s | txt_abs=%s", "group_index", "size_group_no", "size_bytes", "content_sha1", "doc_id", "sid", "txt_abs")
    own = F.struct(F.col("group_index").alias("i"), body.alias("value"))
    first = F.struct(F.lit(0).alias("i"), head.alias("value"))
    rows = members.select("report_group_no", F.explode(F.when(F.col("group_index") == 1, F.array(first, own)).otherwise(F.array(own))).alias("x"))
    return rows.orderBy("report_group_no", "x.i").select("x.value")


def debug_lines(rows: DataFrame) -> DataFrame:
    """`UDK|BBK | file | value | pos` of every hit."""

    def of(name: str, hits: str) -> DataFrame:
        return rows.select("txt_rel", F.explode_outer(hits).alias("h")).where("h is not null").select(F.format_string(f"{name} | %s | %s | %d", "txt_rel", "h.value", "h.pos_from_start").alias("value"))

    return of("UDK", "udc_hits").unionByName(of("BBK", "bbk_hits"))
