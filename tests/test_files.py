"""Files in, JSON lines out, and the same stages over a stream."""

import json

from pyspark.sql import functions as F

from folioforge.plans import manifest, pipeline
from folioforge.schemas import CHUNKS, MANIFEST
from folioforge.schemas import names as field_names
from folioforge.sources import jsonl, text_files
from folioforge.streaming import stream

TEXT = "УДК 621.3 Основы электротехники. М., 1987 г. изд. " + "слово " * 300


def tree(tmp_path):
    root = tmp_path / "lib" / "OCR_TXT"
    for name, data in {
        "pdf_OCR_TXT/Иванов А.Б. Книга.txt": TEXT.encode(), "djvu_OCR_TXT/b.txt": TEXT.encode("cp1251"), "c.txt": b"\xef\xbb\xbf" + b"plain text of a page here\r\nnext line of it", "tab/d.TXT": b"12 | 34 | 56\n" * 3, "skip.md": b"x",
    }.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(data)
    return str(tmp_path / "lib")


def test_manifest_from_files(spark, tmp_path):
    lib = tree(tmp_path)
    rows = {r.txt_rel: r for r in manifest.from_files(spark, lib).collect()}
    assert set(rows) == {"OCR_TXT/pdf_OCR_TXT/Иванов А.Б. Книга.txt", "OCR_TXT/djvu_OCR_TXT/b.txt", "OCR_TXT/c.txt", "OCR_TXT/tab/d.TXT"}
    first = rows["OCR_TXT/pdf_OCR_TXT/Иванов А.Б. Книга.txt"]
    assert (first.authors, first.title, first.year, first.udc, first.src_kind) == ("Иванов А.Б.", "Книга", "1987", "621.3", "pdf")
    assert rows["OCR_TXT/djvu_OCR_TXT/b.txt"].udc == "621.3"
    assert rows["OCR_TXT/c.txt"].text == "plain text of a page here\nnext line of it"
    assert first.txt_abs.startswith("/") and first.size_bytes == len(TEXT.encode())
    assert manifest.table(manifest.from_files(spark, lib)).columns == field_names(MANIFEST)


def test_byte_order_mark_stays_on_pages(spark, tmp_path):
    files = text_files.scan(spark, tree(tmp_path)).where("txt_rel like '%c.txt'")
    assert files.select(text_files.decoded(F.col("content"), for_pages=True)).first()[0][0] == "﻿"


def test_whole_pipeline_and_stream(spark, tmp_path):
    lib = tree(tmp_path)
    chunks = pipeline.run(spark, lib)
    assert chunks.columns == field_names(CHUNKS)
    batch = {(r.chunk_id, r.text) for r in chunks.collect()}
    assert len(batch) > 3
    rows = manifest.from_files(spark, lib)
    jsonl.write(rows.select(*field_names(MANIFEST), "text"), str(tmp_path / "m"), "txt_rel")
    live = stream.read_manifest(spark, str(tmp_path / "m"), MANIFEST + ", text string")
    stream.write_chunks(live, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(120)
    got = spark.read.schema(CHUNKS).json(str(tmp_path / "out"))
    assert got.count() == pipeline.chunks(rows).count()


def test_jsonl(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"a": 1, "b": "x"}\n\n{bad\n[1]\n{"a": null}\n', encoding="utf-8")
    stats = jsonl.read_stats(spark, str(path), "a int, b string").first().asDict()
    assert stats == {"lines": 5, "rows": 2, "bad_json": 2, "empty_lines": 1}
    rows = jsonl.read(spark, str(path), "a int, b string")
    assert sorted((r.a is None, r.a, r.b) for r in rows.collect()) == [(False, 1, "x"), (True, None, None)]
    jsonl.write(rows, str(tmp_path / "y"), "b")
    lines = [json.loads(x) for p in sorted((tmp_path / "y").glob("part-*.json")) for x in p.read_text().splitlines()]
    assert {"a": None, "b": None} in lines


def test_command_line_stages(spark, tmp_path):
    from folioforge import cli

    lib, at = tree(tmp_path), lambda n: str(tmp_path / n)
    cli.main(["manifest", "--lib-root", lib, "--out", at("m1"), "--stats", at("s1")])
    cli.main(["pages", "--lib-root", lib, "--input", at("m1"), "--out", at("p1")])
    cli.main(["analyze", "--input", at("p1"), "--out", at("a1"), "--stats", at("s2")])
    cli.main(["clean", "--input", at("a1"), "--out", at("c1")])
    cli.main(["split", "--input", at("c1"), "--out", at("k1"), "--max-words", "50"])
    cli.main(["run", "--lib-root", lib, "--out", at("k2"), "--max-words", "50"])
    cli.main(["duplicates", "--lib-root", lib, "--out", at("d1")])
    cli.main(["sizes", "--lib-root", lib, "--out", at("z1")])
    read = lambda n: sorted(map(tuple, spark.read.schema(CHUNKS).json(at(n)).collect()), key=str)
    assert read("k1") == read("k2") and len(read("k1")) > 10
    assert spark.read.json(at("z1")).count() == 18
