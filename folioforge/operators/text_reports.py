"""Text reports of the stages.

A report is rows (section, a, b, c, i, value) whose order is that of these columns: sections with a row for each file or
group come from DataFrames of any size, heads from a stage's counters. `write` sorts by ranges and writes one text file for
each, in order, so no task writes a whole report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ManifestConfig, PagesConfig, SplitConfig
from .pages import BUCKETS, GENERATORS
from .quality import LINE_CLASSES, THRESHOLDS
from .reports import clock

#: What reports say about the programs of the stages.
PROGRAMS = {
    "pages": ("MAKE_CHUNKS_FULL", "2026-04-04 v3.2"), "analyze": ("CHUNKS_ANALYZE_FROM_FULL", "2026-04-04 v1.3"), "clean": ("CLEAR_TAB_FROM_ANALIZ", "2026-04-04 v1.2"), "split": ("MAKE_CHUNKS_512_FROM_CLEANED", "2026-04-05 v1.2"),
}
PLACE = ["section", "a", "b", "c", "i"]
SCHEMA = "section int, a bigint, b bigint, c string, i int, value string"


def write(report: DataFrame, path: str) -> None:
    """The lines in order as text files (part by part)."""
    report.orderBy(*PLACE).select("value").write.mode("errorifexists").text(path)


def head(spark: SparkSession, lines: list[str], section: int = 0) -> DataFrame:
    return spark.createDataFrame([(section, 0, 0, "", i, x) for i, x in enumerate(lines)], SCHEMA)


def rows(df: DataFrame, section: int, value: Column, a: Column, b: Column | None = None, c: Column | None = None, i: int = 0) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return df.select(F.lit(section).alias("section"), a.cast("bigint").alias("a"), (zero if b is None else b.cast("bigint")).alias("b"), (F.lit("") if c is None else c).alias("c"), F.lit(i).alias("i"), value.alias("value"))


def program(stage: str) -> dict[str, str]:
    return dict(zip(("program", "version"), PROGRAMS[stage], strict=True))


def pairs(values: dict, names: dict[str, str] | None = None) -> list[str]:
    """`name: value` of each, under the given names if there are any."""
    return [f"{names[k] if names else k}: {v}" for k, v in values.items() if names is None or k in names]


def titled(title: str) -> list[str]:
    return [title, "=" * len(title), ""]


def ratio(part: int, whole: int) -> float:
    return part / whole if whole else 0.0


def sizes_report(spark: SparkSession, buckets: list[dict], rows_total: int, small: int, config: ManifestConfig = ManifestConfig()) -> DataFrame:  # noqa: B008
    """Sizes of files by range, with their shares."""
    lines = [*titled("make_manifest size distribution report"), f"rows_total: {rows_total}", f"small_file_max_bytes: {config.small_file_max_bytes}", f"small_file_count: {small}", f"small_file_ratio: {ratio(small, rows_total):.6f}", "", "size_distribution:"]
    ordered = sorted(buckets, key=lambda x: x["start_bytes"])
    return head(spark, [*lines, *(f"{x['range_label']}: {x['file_count']} ({ratio(x['file_count'], rows_total):.6f})" for x in ordered)])


def duplicates_report(members: DataFrame) -> DataFrame:
    """Groups of equal files (`duplicates.same_size_same_content`), each with its members and an empty line behind."""
    title = titled("make_manifest same-size same-content report")
    groups, files = F.coalesce(F.max("report_group_no"), F.lit(0)).cast("string"), F.count("*").cast("string")
    lines = F.array(*[F.lit(x) for x in title], F.concat(F.lit("group_count: "), groups), F.concat(F.lit("file_count: "), files), F.lit(""))
    top = members.agg(lines.alias("x")).select(F.posexplode("x").alias("i", "value"))
    top = top.select(F.lit(0).alias("section"), F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"), F.lit("").alias("c"), "i", "value")
    name = F.format_string("[GROUP %d] size_group_no=%d size_bytes=%d files=%d | content_sha1=%s", "report_group_no", "size_group_no", "size_bytes", "group_size", "content_sha1")
    body = F.format_string("  - #%d | size_group_no=%d | size_bytes=%d | content_sha1=%s | doc_id=%s | sid=%s | txt_abs=%s", "group_index", "size_group_no", "size_bytes", "content_sha1", "doc_id", "sid", "txt_abs")
    index = F.col("group_index").cast("bigint")
    each = F.array(*[F.struct(F.when(when, b).alias("b"), v.alias("value")) for when, b, v in ((index == 1, F.lit(0).cast("bigint"), name), (F.lit(True), index, body), (index == F.col("group_size"), index + 1, F.lit("")))])
    lined = members.select("report_group_no", F.explode(each).alias("x")).where("x.b is not null")
    return top.unionByName(rows(lined, 1, F.col("x.value"), F.col("report_group_no"), F.col("x.b")))


def tokens_report(report: DataFrame, control: dict, rows_total: int, tokenizer: str, config: ManifestConfig = ManifestConfig()) -> DataFrame:  # noqa: B008
    """Short files with their token counts and texts: those whose tokens couldn't be counted, those too short for a search, and the others."""
    few, many, all_ = control["not_searchable_file_count"], control["searchable_file_count"], control["candidate_file_count"]
    about = {
        "rows_total": rows_total, "e5_tokenizer_name": tokenizer, "e5_min_search_tokens": config.min_search_tokens, "e5_small_scan_max_bytes": config.small_scan_max_bytes, "e5_small_scan_max_kb": round(config.small_scan_max_bytes / 1024.0, 3), "candidate_file_count": all_, "analyzed_file_count": all_,
        "not_searchable_file_count": few, "searchable_file_count": many, "not_searchable_file_ratio": f"{ratio(few, rows_total):.6f}", "searchable_file_ratio": f"{ratio(many, rows_total):.6f}",
        **{k: control[k] for k in ("max_size_bytes_not_searchable", "min_size_bytes_searchable", "threshold_may_need_review")}, **({"tokenizer_error": control["tokenizer_error"]} if control["tokenizer_error"] else {}),
    }
    spark, failed = report.sparkSession, F.col("error") != ""
    kind, low = F.coalesce("src_kind", F.lit("None")), F.lower("txt_rel")
    shown = F.format_string("size_bytes=%d | size_human=%s | token_count_e5=%d | src_kind=%s | txt_rel=%s | txt_abs=%s\nTEXT_BEGIN\n%s\nTEXT_END\n", "size_bytes", "size_human", "token_count_e5", kind, "txt_rel", "txt_abs", "text_for_report")
    wrong = F.format_string("size_bytes=%d | src_kind=%s | txt_rel=%s | txt_abs=%s | error=%s", "size_bytes", kind, "txt_rel", "txt_abs", "error")
    found = [head(spark, [*titled("make_manifest E5 token-count report"), *pairs(about)])]
    found.append(report.where(failed).limit(1).select(F.lit(1).alias("section"), *[F.lit(0).cast("bigint").alias(x) for x in "ab"], F.lit("").alias("c"), F.lit(0).alias("i"), F.lit("\nanalysis_errors:").alias("value")))
    found.append(rows(report.where(failed), 2, wrong, F.col("size_bytes"), c=low))
    for section, title, which in ((3, "\nDOCUMENTS WITH token_count_e5 < 20 (НЕ ПОПАДУТ В ПОИСК):", ~F.col("is_searchable_e5")), (5, "\nDOCUMENTS WITH token_count_e5 >= 20 (ПОПАДУТ В ПОИСК):", F.col("is_searchable_e5"))):
        found += [head(spark, [title], section), rows(report.where(~failed & which), section + 1, shown, F.col("size_bytes"), F.col("token_count_e5"), low)]
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out


def manifest_report(summary: dict, counts: dict[str, dict], top: dict[str, list[tuple[str, int]]]) -> list[str]:
    """The manifest stage's summary, its frequencies (`parse_mode`, and status, zone and hits of both codes) and the most frequent codes."""
    ordered = lambda name: [f"{k}: {counts[name][k]}" for k in sorted(counts[name])]
    out = [*titled("make_manifest report"), *pairs(summary), "", "parse_modes:", *ordered("parse_mode")]
    for code, label, word in (("udc", "udc", "udk"), ("bbk", "bbk", "bbk")):
        out += ["", "--------------------------------"] if code == "bbk" else []
        out += ["", f"{label}_stage2_status_counts:", *ordered(f"{code}_status"), "", f"{label}_accepted_zone_counts:", *ordered(f"{code}_zone"), "", f"rows_by_total_{label}_found_capped_to_4:", *ordered(f"{code}_hits"), "", f"top_accepted_{word}_values:", *(f"{v}: {n}" for v, n in top[code])]
    return out


def pages_report(s: dict, manifest: str, out: str, report: str, seconds: float, bad_json: int = 0, config: PagesConfig = PagesConfig()) -> list[str]:  # noqa: B008
    """The page stage's counters (pages.page_counters), averages and speed."""
    docs, written = s["docs"], s["pages_written"]
    about = {**program("pages"), **{k: GENERATORS[k] for k in ("manifest_generator_program", "manifest_generator_version", "manifest_schema_version")}}
    counts = {"docs_processed": docs, "pages_total": s["pages"], "written_chunks": written, "missing_txt": s["missing_txt"], "bad_json": bad_json, "skipped_no_txt_rel": s["skipped_no_txt_rel"], "skipped_short_pages": s["pages_short"], "docs_with_zero_written_chunks": s["docs_without_pages"]}
    averages = {
        "avg_pages_per_doc": f"{ratio(s['pages'], docs):.3f}", "avg_chunks_per_doc": f"{ratio(written, docs):.3f}", "chunk_write_ratio": f"{ratio(written, s['pages']):.6f}", "skipped_short_pages_ratio": f"{ratio(s['pages_short'], s['pages']):.6f}",
        "avg_chars_per_written_chunk": f"{ratio(s['chars'], written):.3f}", "min_written_chunk_chars": s["min_chars"] or 0, "max_chunk_chars": s["max_chars"] or 0,
    }
    speed = lambda n: f"{n / seconds if seconds > 0 else 0.0:.3f}"
    buckets = [f"{label}: {s[f'len_{low}']} ({ratio(s[f'len_{low}'], written):.6f})" for low, _, label in BUCKETS]
    under = lambda title, n=0: [title, "-" * (n or len(title))]
    return [
        *titled("MAKE_CHUNKS_FULL statistics"), *pairs(about), "", *pairs({"manifest_path": manifest, "chunks_out_path": out, "stats_txt_path": report, "min_chars_threshold": config.min_chars}), "", *under("COUNTS"), *pairs(counts), "", *under("AVERAGES AND RATIOS"), *pairs(averages), "",
        *under("CHUNK LENGTH BUCKETS (written chunks only)", 41), *buckets, "", *under("PERFORMANCE"), *pairs({"elapsed_seconds": f"{seconds:.3f}", "elapsed_hms": clock(seconds), "docs_per_second": speed(docs), "chunks_per_second": speed(written)}),
    ]


def quality_report(s: dict, source: str, out: str, seconds: float, bad_json: int = 0, empty_lines: int = 0) -> list[str]:
    """The analysis stage's counters (quality.quality_counters) and speed."""
    about = {**program("analyze"), "input": source, "output": out}
    return pairs({**about, **{k: s[k] for k in ("total", "ok", "suspicious", "junk_candidate")}, "bad_json": bad_json, "empty_lines": empty_lines, "time_sec": f"{seconds:.3f}", "speed_chunks_per_sec": f"{s['total'] / seconds if seconds > 0 else 0.0:.3f}"})


#: Labels of the cleaning stage's report, in its order, and the summary's keys they stand for.
CLEAN_LABELS = {
    "program": "Program", "version": "Version", "chunks_in": "Input / вход", "chunks_out": "Output / выход", "total_chunks": "Total chunks / всего чанков", "bad_json": "Bad JSON / битых JSON", "before_total_chars": "Before chars / символов до", "after_total_chars": "After chars / символов после",
    "char_reduction": "Reduction / сокращение", "char_reduction_ratio": "Reduction ratio / доля сокращения", "written_chunks": "Written chunks / записано чанков", "removed_empty_chunks": "Removed empty chunks / удалено пустых чанков", "tab_chunks": "TAB chunks / чанков tab", "other_chunks": "Other chunks / прочих чанков",
    "non_tab_ok_cleaned": "Non-tab ok cleaned / non-tab ok очищено", "non_tab_suspicious_cleaned": "Non-tab suspicious cleaned / non-tab suspicious очищено", "non_tab_junk_cleaned": "Non-tab junk cleaned / non-tab junk очищено",
    "tab_lines_in": "TAB lines in / строк tab до", "tab_lines_out": "TAB lines out / строк tab после", "tab_table_lines": "TAB table lines / табличных строк", "tab_text_lines": "TAB text lines / текстовых строк", "tab_lines_removed": "TAB lines removed / строк tab удалено",
    "tab_tokens_seen": "TAB tokens seen / токенов tab до", "tab_tokens_kept": "TAB tokens kept / токенов tab после", "tab_token_keep_ratio": "TAB token keep ratio / доля сохраненных токенов tab", "tab_numeric_removed": "TAB numeric removed / удалено чисел", "tab_mixed_removed": "TAB mixed removed / удалено смешанных токенов",
    "tab_latin_removed": "TAB latin removed / удалено латиницы", "tab_other_removed": "TAB other removed / удалено прочего",
    **{f"non_tab_{q}_lines_{k}": f"Non-tab {q} lines {k} / non-tab {q} строк {word}" for q in ("ok", "suspicious", "junk") for k, word in (("in", "до"), ("out", "после"), ("removed", "удалено"))},
    "non_tab_separator_removed": "Non-tab separator removed / удалено разделителей", "non_tab_too_short_removed": "Non-tab too short removed / удалено слишком коротких", "non_tab_no_letters_short_removed": "Non-tab no letters short removed / удалено коротких без букв",
    "non_tab_ocr_noise_removed": "Non-tab ocr noise removed / удалено OCR-шума", "non_tab_heavy_numeric_removed": "Non-tab heavy numeric removed / удалено тяжёлых цифровых строк", "non_tab_duplicate_removed": "Non-tab duplicate removed / удалено дублей строк", "non_tab_non_letter_removed": "Non-tab non-letter removed / удалено non-letter строк",
    "non_tab_table_like_removed": "Non-tab table-like removed / удалено table-like строк", "non_tab_normalized_only": "Non-tab normalized only / только нормализовано", "non_tab_whitelist_kept": "Non-tab whitelist kept / сохранено whitelist", "min_word_len_rule": "Rule / правило",
}
#: Which reason of removal each of these keys counts.
REMOVED = {
    "separator": "empty_after_normalize", "too_short": "too_short", "no_letters_short": "short_no_letters", "ocr_noise": "single_char_ocr_noise", "heavy_numeric": "heavy_numeric", "duplicate": "duplicate_short_line", "non_letter": "non_letter_line", "table_like": "table_like_line",
}


def clean_summary(s: dict, source: str, out: str, min_word_len: int, bad_json: int = 0) -> dict:
    """The cleaning stage's summary under its own keys, from cleaning.clean_counters."""
    gone, tab = s["chars_in"] - s["chars_out"], s["pages_tab"]
    return {
        **program("clean"), "chunks_in": source, "chunks_out": out, "total_chunks": s["pages_in"], "bad_json": bad_json, "written_chunks": s["pages_out"], "removed_empty_chunks": s["pages_empty"],
        "min_word_len_rule": f"keep cyrillic words with length > {min_word_len} in table lines", "before_total_chars": s["chars_in"], "after_total_chars": s["chars_out"], "char_reduction": gone, "char_reduction_ratio": round(ratio(gone, s["chars_in"]), 6), "tab_chunks": tab, "other_chunks": s["pages_in"] - tab, "tab_changed": s["tab_changed"],
        "non_tab_ok_cleaned": s["pages_ok"], "non_tab_suspicious_cleaned": s["pages_suspicious"], "non_tab_junk_cleaned": s["pages_junk_candidate"], **{f"tab_{k}": s[f"tab_{k}"] for k in ("lines_in", "lines_out", "table_lines", "text_lines", "lines_removed", "tokens_seen", "tokens_kept")},
        "tab_token_keep_ratio": round(ratio(s["tab_tokens_kept"], s["tab_tokens_seen"]), 6), **{f"tab_{k}_removed": s[f"tab_{k}_removed"] for k in ("numeric", "mixed", "latin", "other")}, **{f"non_tab_{q}_lines_{k}": s[f"{q}_lines_{k}"] for q in ("ok", "suspicious", "junk") for k in ("in", "out", "removed")},
        **{f"non_tab_{k}_removed": s[f"drop_{reason}"] for k, reason in REMOVED.items()}, "non_tab_normalized_only": s["lines_normalize"], "non_tab_whitelist_kept": s["lines_whitelist"],
    }


def quality_summary(s: dict, source: str, out: str, lines_format: str, seconds: float, bad_json: int = 0, empty_lines: int = 0) -> dict:
    """The analysis stage's summary with its thresholds and class codes."""
    return {
        **program("analyze"), "input": source, "output": out, **{k: s[k] for k in ("total", "ok", "suspicious", "junk_candidate")}, "bad_json": bad_json, "empty_lines": empty_lines, "total_non_empty_lines": s["lines"], "time_sec": round(seconds, 6),
        "speed_chunks_per_sec": round(s["total"] / seconds, 6) if seconds > 0 else 0.0, "thresholds": THRESHOLDS, "line_stats_added": True, "lines_format": lines_format, "line_class_codes": LINE_CLASSES, "avg_non_empty_lines_per_chunk": round(ratio(s["lines"], s["total"]), 6),
    }


def clean_report(summary: dict) -> list[str]:
    """The summary under its labels; the number of changed table pages isn't in it."""
    return pairs({k: summary[k] for k in CLEAN_LABELS}, CLEAN_LABELS)


def split_report(s: dict, source: str, out: str, seconds: float, bad_json: int = 0, config: SplitConfig = SplitConfig(), report_every: int = 50000) -> list[str]:  # noqa: B008
    """The split stage's parameters, counters (subchunks.split_counters), averages and speed, in columns."""
    padded = lambda values, width: [f"{k:<{width}}: {v}" for k, v in values.items()]
    speed = lambda n, what: f"{n / seconds if seconds > 0 else 0.0:.2f} {what}/s"
    return [
        "MAKE_CHUNKS_512_FROM_CLEANED REPORT", f"Program: {PROGRAMS['split'][0]}", f"Version: {PROGRAMS['split'][1]}", "", f"Input file : {source}", f"Output file: {out}", "", "PARAMETERS", *padded({"max_words": config.max_words, "overlap_words": config.overlap_words, "report_every": report_every}, 14), "",
        "RESULT", *padded({"total_input_pages": s["pages_in"], "total_output_chunks": s["chunks_out"], "pages_single": s["pages_single"], "pages_split": s["pages_split"], "max_parts_on_page": s["max_parts"], "bad_json": bad_json, "empty_input_text": s["pages_empty"]}, 26), "",
        "AVERAGES", *padded({"avg_input_words_per_page": round(ratio(s["words_in"], s["pages_in"]), 6), "avg_output_words_per_chunk": round(ratio(s["words_out"], s["chunks_out"]), 6)}, 27), "", "PERFORMANCE", *padded({"time_sec": f"{seconds:.6f}", "speed_in": speed(s["pages_in"], "pages"), "speed_out": speed(s["chunks_out"], "chunks")}, 11),
    ]
