"""Counters taken while a stage writes, text reports against literal text, files read in blocks, and files as a stream."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from folioforge import cli
from folioforge.config import ManifestConfig
from folioforge.operators import cleaning, duplicates, pages, quality, subchunks, text_reports
from folioforge.plans import manifest
from folioforge.schemas import ANALYSED, CLEANED, MANIFEST, PAGES
from folioforge.sources import jsonl, text_files
from folioforge.streaming import stream

TEXT = "УДК 621.3 Основы электротехники. М., 1987 г. изд. " + "слово " * 300


def fill(root, files):
    for name, data in files.items():
        path = root / "lib" / "OCR_TXT" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    return str(root / "lib")


def tree(tmp_path, more=None):
    return fill(tmp_path, {
        "pdf_OCR_TXT/Иванов А.Б. Книга (1975).txt": TEXT.encode(), "djvu_OCR_TXT/b.txt": TEXT.encode("cp1251"), "c.txt": b"plain text of a page here\r\nnext line of it\x0cx\x0c\x0cand another page that is long", "tab/d.TXT": b"12 | 34 | 56\n" * 3, "e/c.txt": b" ", "f/x.txt": TEXT.encode(), "short.txt": "несколько слов".encode(), "skip.md": b"x", **(more or {}),
    })


def lines(path):
    return [x for p in sorted(path.glob("part-*")) if not p.name.endswith(".crc") for x in p.read_text(encoding="utf-8").split("\n")[:-1]]


def test_counters_of_a_run_are_those_of_the_batch_queries(spark, tmp_path):
    lib, at = tree(tmp_path), lambda n: str(tmp_path / n)
    stats = lambda n: json.loads(lines(tmp_path / n)[0])
    row = lambda df: df.first().asDict()
    cli.main(["manifest", "--lib-root", lib, "--out", at("m"), "--stats", at("ms"), "--report", at("mr")])
    summary = stats("ms")
    assert len(summary) == 44 and (summary["rows_total"], summary["same_size_same_content_file_count"], summary["unique_collision_stems"], summary["year_from_stg1"], summary["udc_found_rows"]) == (7, 2, 1, 1, 3)
    report = lines(tmp_path / "mr")
    assert report[:4] == ["make_manifest report", "====================", "", "program: make_manifest"] and report[report.index("parse_modes:") + 1 :][:2] == ["initials_from_right: 1", "no_initials: 6"]
    assert report[report.index("top_accepted_udk_values:") + 1] == "621.3: 3" and report[report.index("rows_by_total_bbk_found_capped_to_4:") + 1] == "0: 7"
    # one row's file is gone, one row has no path, one line is no row
    with open(next((tmp_path / "m").glob("part-*.json")), "a") as f:
        f.write('{"txt_rel": "OCR_TXT/gone.txt", "sid": "z"}\n{"sid": "y"}\n{bad\n')
    for crc in (tmp_path / "m").glob(".*.crc"):
        crc.unlink()
    cli.main(["pages", "--lib-root", lib, "--input", at("m"), "--out", at("p"), "--stats", at("ps"), "--report", at("pr")])
    got = stats("ps")
    assert (got["missing_txt"], got["skipped_no_txt_rel"], got["bad_json"]) == (1, 1, 1)
    there = cli.with_text(spark, jsonl.read(spark, at("m"), MANIFEST), lib).where("text is not null")
    want = row(pages.page_stats(there))
    assert {k: got[k] for k in want if k in got} == {k: v for k, v in want.items() if k != "avg_chars"} and got["pages_short"] == 3
    cli.main(["analyze", "--input", at("p"), "--out", at("a"), "--stats", at("as"), "--report", at("ar")])
    want = row(quality.quality_stats(quality.analyze(jsonl.read(spark, at("p"), PAGES))))
    got = stats("as")
    assert {k: got[k] for k in ("total", "ok", "suspicious", "junk_candidate")} == {k: want[k] for k in ("total", "ok", "suspicious", "junk_candidate")} and got["total_non_empty_lines"] == want["lines"]
    assert got["thresholds"]["junk_score"] == 5 and got["line_class_codes"]["non_letter"] == 3
    cli.main(["clean", "--input", at("a"), "--out", at("c"), "--stats", at("cs"), "--report", at("cr")])
    want = row(cleaning.clean_summary(cleaning.clean_all(jsonl.read(spark, at("a"), ANALYSED))))
    got = stats("cs")
    assert (got["total_chunks"], got["written_chunks"], got["removed_empty_chunks"], got["before_total_chars"], got["tab_chunks"]) == tuple(want[k] for k in ("pages_in", "pages_out", "pages_empty", "chars_in", "pages_tab"))
    assert got["char_reduction_ratio"] == want["char_reduction"] and got["non_tab_ok_lines_in"] == want["ok_lines_in"] and got["tab_tokens_seen"] == want["tab_tokens_seen"]
    assert f"TAB chunks / чанков tab: {want['pages_tab']}" in lines(tmp_path / "cr") and len(lines(tmp_path / "cr")) == len(text_reports.CLEAN_LABELS)
    cli.main(["split", "--input", at("c"), "--out", at("k"), "--max-words", "50", "--stats", at("ks"), "--report", at("kr")])
    from folioforge.config import SplitConfig

    want = row(subchunks.split_stats(jsonl.read(spark, at("c"), CLEANED), SplitConfig(50, 10)))
    got = stats("ks")
    assert {k: got[k] for k in got if k != "bad_json"} == {k: v for k, v in want.items() if not k.startswith("avg")}
    cli.main(["run", "--lib-root", lib, "--out", at("r"), "--max-words", "50", "--stats", at("rs")])
    assert stats("rs")["split"]["chunks_out"] == want["chunks_out"] and stats("rs")["clean"]["pages_in"] == stats("as")["total"]


def test_reports_of_files(spark, tmp_path):
    lib, at = tree(tmp_path), lambda n: str(tmp_path / n)
    cli.main(["duplicates", "--lib-root", lib, "--out", at("d"), "--report", at("dr")])
    sha, first, second = hashlib.sha1(TEXT.encode()).hexdigest(), "OCR_TXT/f/x.txt", "OCR_TXT/pdf_OCR_TXT/Иванов А.Б. Книга (1975).txt"
    ids = {x: hashlib.sha1(x.encode()).hexdigest()[:16] for x in (first, second)}
    title, size = "make_manifest same-size same-content report", len(TEXT.encode())
    head = f"size_group_no=1 size_bytes={size} files=2 | content_sha1={sha}"
    members = [f"  - #{i} | size_group_no=1 | size_bytes={size} | content_sha1={sha} | doc_id={ids[x]} | sid={ids[x]} | txt_abs={lib}/{x}" for i, x in ((1, first), (2, second))]
    assert lines(tmp_path / "dr") == [title, "=" * len(title), "", "group_count: 1", "file_count: 2", "", f"[GROUP 1] {head}", *members, ""]
    cli.main(["sizes", "--lib-root", lib, "--out", at("z"), "--report", at("zr")])
    got = lines(tmp_path / "zr")
    assert got[3:8] == ["rows_total: 7", "small_file_max_bytes: 65536", "small_file_count: 7", "small_file_ratio: 1.000000", ""] and "1-255 B: 4 (0.571429)" in got and got[-1] == "> 8 MB: 0 (0.000000)" and len(got) == 27
    cli.main(["tokens", "--lib-root", lib, "--out", at("t"), "--report", at("tr"), "--e5-min-search-tokens", "4"])
    got = lines(tmp_path / "tr")
    assert got[:5] == ["make_manifest E5 token-count report", "===================================", "", "rows_total: 7", "e5_tokenizer_name: whitespace"]
    few, many = (next(i for i, x in enumerate(got) if x.startswith(f"DOCUMENTS WITH token_count_e5 {s}")) for s in ("<", ">="))
    path = f"{lib}/OCR_TXT"
    assert got[few - 1 : many - 1] == [
        "", got[few], f"size_bytes=1 | size_human=1 B | token_count_e5=0 | src_kind=None | txt_rel=OCR_TXT/e/c.txt | txt_abs={path}/e/c.txt", "TEXT_BEGIN", "", "TEXT_END", "",
        f"size_bytes=27 | size_human=27 B | token_count_e5=2 | src_kind=None | txt_rel=OCR_TXT/short.txt | txt_abs={path}/short.txt", "TEXT_BEGIN", "несколько слов", "TEXT_END", "",
    ]
    assert got[many + 1].startswith("size_bytes=39 | size_human=39 B | token_count_e5=15 | src_kind=None | txt_rel=OCR_TXT/tab/d.TXT")


def test_page_and_split_reports_as_text():
    s = {"docs": 2, "pages": 5, "pages_written": 4, "missing_txt": 1, "skipped_no_txt_rel": 0, "pages_short": 1, "docs_without_pages": 0, "chars": 1000, "min_chars": 20, "max_chars": 700, "len_20": 1, "len_50": 1, "len_100": 1, "len_500": 1, "len_1000": 0}
    got = text_reports.pages_report(s, "m", "o", "r", 3661.5)
    assert got[13:23] == ["", "COUNTS", "------", "docs_processed: 2", "pages_total: 5", "written_chunks: 4", "missing_txt: 1", "bad_json: 0", "skipped_no_txt_rel: 0", "skipped_short_pages: 1"]
    assert got[-14:] == ["CHUNK LENGTH BUCKETS (written chunks only)", "-" * 41, "20-49: 1 (0.250000)", "50-99: 1 (0.250000)", "100-499: 1 (0.250000)", "500-999: 1 (0.250000)", "1000+: 0 (0.000000)", "", "PERFORMANCE", "-----------", "elapsed_seconds: 3661.500", "elapsed_hms: 01:01:02", "docs_per_second: 0.001", "chunks_per_second: 0.001"]
    assert "avg_pages_per_doc: 2.500" in got and "chunk_write_ratio: 0.800000" in got and "avg_chars_per_written_chunk: 250.000" in got
    s = {"pages_in": 3, "chunks_out": 4, "pages_single": 1, "pages_split": 1, "max_parts": 3, "pages_empty": 1, "words_in": 10, "words_out": 12}
    got = text_reports.split_report(s, "i", "o", 2.0)
    assert got[:12] == ["MAKE_CHUNKS_512_FROM_CLEANED REPORT", "Program: MAKE_CHUNKS_512_FROM_CLEANED", "Version: 2026-04-05 v1.2", "", "Input file : i", "Output file: o", "", "PARAMETERS", "max_words     : 222", "overlap_words : 10", "report_every  : 50000", ""]
    assert got[12:] == ["RESULT", "total_input_pages         : 3", "total_output_chunks       : 4", "pages_single              : 1", "pages_split               : 1", "max_parts_on_page         : 3", "bad_json                  : 0", "empty_input_text          : 1", "", "AVERAGES", "avg_input_words_per_page   : 3.333333", "avg_output_words_per_chunk : 3.0", "", "PERFORMANCE", "time_sec   : 2.000000", "speed_in   : 1.50 pages/s", "speed_out  : 2.00 chunks/s"]


def test_report_is_written_in_order_by_many_tasks(spark, tmp_path):
    members = spark.range(3000).select(
        (F.col("id") / 3 + 1).cast("int").alias("report_group_no"), F.lit(1).alias("size_group_no"), F.lit(3).alias("group_size"), (F.col("id") % 3 + 1).cast("int").alias("group_index"), F.lit(5).cast("bigint").alias("size_bytes"), *[F.lit(x).alias(x) for x in ("content_sha1", "doc_id", "sid", "txt_abs")],
    ).repartition(7, "doc_id", "group_index")
    text_reports.write(text_reports.duplicates_report(members), str(tmp_path / "r"))
    got = lines(tmp_path / "r")
    assert len(got) == 6 + 5000 and [x.split("]")[0] for x in got if x.startswith("[")] == [f"[GROUP {i}" for i in range(1, 1001)]
    assert [x[:7] for x in got[6:11]] == ["[GROUP ", "  - #1 ", "  - #2 ", "  - #3 ", ""]


def test_large_files_are_hashed_in_blocks(spark, tmp_path):
    """Two sparse files of 3 GB, beyond what a row may hold, one of another content, and one of a size of its own."""
    lib = tree(tmp_path)
    for name, end in (("big1.txt", b"x"), ("big2.txt", b"x"), ("big3.txt", b"y")):
        with open(f"{lib}/OCR_TXT/{name}", "wb") as f:
            f.seek(3 << 30)
            f.write(end)
    files = text_files.listed(spark, lib)
    shared = duplicates.same_size(files)
    assert sorted(r["size_bytes"] for r in shared.select("size_bytes").collect()) == [len(TEXT.encode())] * 2 + [(3 << 30) + 1] * 3
    digest = hashlib.sha1()
    for _ in range(3 << 10):
        digest.update(bytes(1 << 20))
    digest.update(b"x")
    rows = text_files.hashed(shared.where("size_bytes > 1000000").repartition(3)).collect()
    assert {r["txt_rel"][8:]: r["content_sha1"] for r in rows if "big3" not in r["txt_rel"]} == {"big1.txt": digest.hexdigest(), "big2.txt": digest.hexdigest()}
    assert len({r["content_sha1"] for r in rows}) == 2


def test_numbering_runs_nothing_while_planning(spark):
    """No job before the action, and numbers in order for a group that holds nearly all files."""
    rel = F.format_string("OCR_TXT/%06d.txt", F.col("id"))
    files = spark.range(5000).select(rel.alias("txt_rel"), rel.alias("txt_abs"), F.lit(1).cast("bigint").alias("size_bytes"), F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("content"), *[rel.alias(x) for x in ("doc_id", "sid", "uid")])
    spark.sparkContext.setJobGroup("numbering", "numbering")
    found = duplicates.same_size_same_content(files)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("numbering")) == []
    spark.sparkContext.setJobGroup("rest", "rest")
    rows = found.orderBy("report_group_no", "group_index").collect()
    assert len(rows) == 5000 and {r["report_group_no"] for r in rows} == {1, 2}
    for group in (1, 2):
        own = [r for r in rows if r["report_group_no"] == group]
        assert [r["group_index"] for r in own] == list(range(1, len(own) + 1)) and [r["txt_rel"] for r in own] == sorted(r["txt_rel"] for r in own)


def test_files_as_a_stream(spark, tmp_path):
    """Two drops of files give what a batch over both gives; a run without new files writes nothing."""
    lib, out, mark = tree(tmp_path), str(tmp_path / "out"), str(tmp_path / "mark")
    got = stream.take_new_files(spark, lib, out, mark)
    assert got["manifest"]["files"] == 7 and got["pages"]["docs"] == 7
    fill(tmp_path, {"new/Петров В.Г. Оптика.txt": TEXT.encode(), "new/two.txt": b"one page of the text\x0canother page of the text"})
    got = stream.take_new_files(spark, lib, out, mark)
    assert got["manifest"]["files"] == 2 and got["pages"]["pages_written"] == 3
    again = stream.take_new_files(spark, lib, out, mark)
    assert sum(x.get("files", 0) for x in again.values()) == 0
    rows = manifest.from_files(spark, lib)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(spark.read.schema(MANIFEST).json(f"{out}/manifest")) == key(manifest.table(rows))
    files = text_files.scan(spark, lib)
    built = manifest.build(files.withColumn("text", text_files.decoded(F.col("content"))))
    whole = pages.chunk_pages(built.withColumn("text", text_files.decoded(F.col("content"), for_pages=True)))
    read = spark.read.schema(PAGES).json(f"{out}/pages")
    assert key(read.select("chunk_id", "text", "title")) == key(whole.select("chunk_id", "text", "title"))


def test_tokens_report_says_what_failed(spark):
    report = spark.createDataFrame([("OCR_TXT/a.txt", "/a", 5, "5 B", "no text", None, False, "", "pdf")], "txt_rel string, txt_abs string, size_bytes bigint, size_human string, error string, token_count_e5 int, is_searchable_e5 boolean, text_for_report string, src_kind string")
    control = {"candidate_file_count": 1, "not_searchable_file_count": 0, "searchable_file_count": 0, "max_size_bytes_not_searchable": None, "min_size_bytes_searchable": None, "tokenizer_error": "no text", "threshold_may_need_review": False}
    got = [r["value"] for r in text_reports.tokens_report(report, control, 1, "t", ManifestConfig()).orderBy(*text_reports.PLACE).collect()]
    assert "tokenizer_error: no text" in got and got[got.index("\nanalysis_errors:") + 1] == "size_bytes=5 | src_kind=pdf | txt_rel=OCR_TXT/a.txt | txt_abs=/a | error=no text"
    with pytest.raises(KeyError):
        text_reports.tokens_report(report, {}, 1, "t")
