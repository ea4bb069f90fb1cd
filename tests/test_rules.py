"""Literal cases, with results worked out by hand from the rules."""

import random

import pytest
from pyspark.sql import functions as F

from folioforge.config import SplitConfig
from folioforge.functions import charclass
from folioforge.operators import cleaning, codes, identity, names, pages, quality, reports, sizes, subchunks
from folioforge.plans import fixtures, pipeline
from folioforge.schemas import ANALYSED, CHUNKS, PAGES
from folioforge.schemas import names as field_names


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()["x"]


def test_names(spark):
    got = {r.name: (r.year, r.authors, r.title, r.parse_mode) for r in names.parse_names(fixtures.file_names(spark)).collect()}
    assert got == {n: tuple(rest) for n, *rest in fixtures.NAMES}


@pytest.mark.parametrize("a, t, mode", [("Петров и др. Теория поля А.Б.", "", "noauthor"), ("", "", "none")])
def test_tail_rules_leave_plain_names(spark, a, t, mode):
    rows = names.authors_and_title(spark.createDataFrame([(a,)], "n string"), F.col("n")).collect()
    assert len(rows) == 1 and rows[0].parse_mode


@pytest.mark.parametrize("n, parts", [(0, []), (1, [1]), (222, [222]), (223, [112, 121]), (424, [212, 222]), (425, [142, 152, 151])])
def test_split(spark, n, parts):
    text = " ".join(f"w{i}" for i in range(n))
    got = one(spark, subchunks.subchunks(F.col("t"), SplitConfig()), t=text)
    assert [len(x.split()) for x in got] == parts


def test_split_covers_every_word(spark):
    rng = random.Random(5)
    for _ in range(12):
        most = rng.randrange(2, 30)
        config = SplitConfig(most, rng.randrange(0, most))
        words = [f"w{i}" for i in range(rng.randrange(1, 200))]
        got = one(spark, subchunks.subchunks(F.col("t"), config), t="\n ".join(words))
        assert max(len(x.split()) for x in got) <= most
        seen = [w for x in got for w in x.split()]
        assert list(dict.fromkeys(seen)) == words


def test_split_rejects_overlap():
    with pytest.raises(ValueError):
        SplitConfig(10, 10)


@pytest.mark.parametrize("text, want", [("a-\nb-\nc", "ab-\nc"), (" a \t\nb\r\n\r\n\r\nc ", "a\nb\n\nc"), ("", ""), (" x ", "x")])
def test_normalize(spark, text, want):
    assert one(spark, pages.normalize(F.col("t")), t=text) == want


def test_page_numbers(spark):
    a, b = "A" * 25, "B" * 25
    rows = spark.createDataFrame([("x", f"{a}\f\f{b}"), ("y", f"\f{a}"), ("z", "  "), ("n", None)], "doc_id string, text string")
    got = sorted((r.doc_id, r.page_start, r.text) for r in pages.chunk_pages(rows).collect())
    assert got == [("x", 1, a), ("x", 3, b), ("y", 1, a)]
    assert pages.chunk_pages(rows).columns == field_names(PAGES)


def test_quality(spark):
    rows = spark.createDataFrame([("a", "12 34 56"), ("b", ""), ("c", None), ("d", "x\x85y \n\nx")], "chunk_id string, text string")
    got = {r.chunk_id: r for r in quality.analyze(rows).collect()}
    line = got["a"].lines[0]
    assert (line.table_like_score_line, line.line_class) == (4, "non_letter")
    assert (got["b"].junk_score, got["b"].quality_class, got["b"].lines) == (2, "ok", [])
    assert got["c"].text == ""
    assert [(x.line_no, x.text, x.is_duplicate_in_chunk) for x in got["d"].lines] == [(1, "x", True), (2, "y", False), (5, "x", True)]


def test_compact_round_trip(spark):
    rows = quality.analyze(spark.createDataFrame([("a", "one two\n1 | 2 | 3\nab")], "chunk_id string, text string"))
    assert quality.expand(quality.compact(rows)).select("lines").collect() == rows.select("lines").collect()


@pytest.mark.parametrize("rel, tab", [("tab/x.txt", False), ("OCR_TXT/tab/x.txt", True), ("a\\TAB\\b", True), (None, False)])
def test_tab_paths(spark, rel, tab):
    assert one(spark, cleaning.is_tab(F.lit(None).cast("string"), F.lit(rel).cast("string"))) is tab


def clean(spark, text, quality_class=None, rel="OCR_TXT/x.txt"):
    rows = quality.analyze(spark.createDataFrame([("a", text, rel)], "chunk_id string, text string, txt_rel string").withColumn("txt_abs", F.lit(None).cast("string")))
    if quality_class:
        rows = rows.withColumn("quality_class", F.lit(quality_class))
    return cleaning.clean_all(rows).first()


def test_whitelist_keeps(spark):
    got = clean(spark, "Рис. 5 — схема | №3")
    assert got.clean_text == "Рис 5 схема 3"
    assert [(d.action, d.reason) for d in got.decisions] == [("keep", "tech_whitelist")]


def test_duplicates_drop_every_copy(spark):
    got = clean(spark, "Общая строка текста\nдругая длинная строка\nОбщая строка текста")
    assert [d.reason for d in got.decisions][::2] == ["duplicate_short_line"] * 2
    assert got.clean_text == "другая длинная строка"


def test_remembered_line_drops_later_variant(spark):
    # the same line in other case isn't a duplicate for the stage before, but is for the cleaner
    got = clean(spark, "Общая строка текста\nОБЩАЯ СТРОКА ТЕКСТА")
    assert [d.reason for d in got.decisions] == ["good_text", "duplicate_short_line"]


def test_decisions_against_a_fold(spark):
    """The set-based duplicate rule agrees with remembering lines one after another."""
    rng = random.Random(3)
    pool = ["Общая строка текста", "ОБЩАЯ строка текста", "рис текста 5", "РИС текста 5", "длинная строка без конца", "12", "a b c d e f g", "", "слово"]
    for _ in range(6):
        text = "\n".join(rng.choice(pool) for _ in range(14))
        rows = clean(spark, text, rng.choice(["ok", "suspicious", "junk_candidate"])).decisions
        seen = set()
        twice = {x for x in text.split("\n") if text.split("\n").count(x) > 1}
        for d, raw in zip(rows, text.split("\n"), strict=True):
            low = d.line.lower()
            if d.action != "drop":
                assert "рис" in low.split() or not (len(d.line) <= 80 and (raw in twice or low in seen))
                seen.add(low)
            elif d.reason == "duplicate_short_line":
                assert raw in twice or low in seen


def test_table_page(spark):
    got = clean(spark, "12 34 слово abc x9\nобычная строка здесь", rel="OCR_TXT/tab/x.txt")
    assert got.clean_mode == "tab" and got.clean_text == "слово\nобычная строка здесь"
    assert (got.tab.tokens_seen, got.tab.numeric_removed, got.tab.mixed_removed, got.tab.latin_removed) == (8, 2, 1, 1)


def test_foreign_line_entries(spark):
    """Entries without line numbers are aligned by place or over lines that aren't blank, others not at all."""
    e = lambda n: "array_repeat(named_struct('line_no', 0, 'text', 'т', 'text_len', 1, 'text_len_stripped', 1, 'token_count_simple', 1, 'letter_ratio', 1d, 'digit_ratio', 0d, 'punct_ratio', 0d, 'space_ratio', 0d, 'single_char_token_ratio', 1d, 'avg_token_len', 1d, 'has_letter', true, 'has_digit', false, 'is_duplicate_in_chunk', false, 'table_like_score_line', 0, 'line_class', 'text_line'), %d)" % n  # noqa: E731, UP031
    raw = F.split(F.lit("a\n\nb"), "\n")
    has = lambda n: [x.entry is not None for x in one(spark, cleaning.aligned(raw, F.expr(e(n))))]
    assert has(3) == [True, True, True] and has(2) == [True, False, True] and has(1) == [False] * 3


@pytest.mark.parametrize("text, want", [("УДК 621.3:004 Основы", ["621.3:004"]), ("УДК: 621.3", ["621.3"]), ("УДК 51", []), ("", []), ("УДК 004.1 УДК 004.2", ["004.1", "004.2"])])
def test_udc(spark, text, want):
    assert [h.value for h in one(spark, codes.udc_hits(F.col("t"), 80), t=text)] == want


def test_udc_positions(spark):
    hit = one(spark, codes.udc_hits(F.col("t"), 3), t="абв УДК 621.3 где")[0]
    assert (hit.pos_from_start, hit.pos_from_end, hit.source_tag) == (4, 13, "exact")
    assert hit.context == "бв УДК 621.3 гд"


@pytest.mark.parametrize("text, want", [("ББК 22.3я73. Авторы", "22.3я73"), ("ББК ISBN 978", None), ("ББК 5", None)])
def test_bbk(spark, text, want):
    got = one(spark, codes.bbk_hits(F.col("t"), 80), t=text)
    assert (got[0].value if got else None) == want


@pytest.mark.parametrize("text, want", [("1999 и 1987 год ", "1987"), ("в 19991 нет", ""), ("1950, 1960", "1950"), ("М., изд. 2001", "2001"), ("", "")])
def test_text_year(spark, text, want):
    assert one(spark, codes.text_year(F.col("t"), 5000), t=text) == want


@pytest.mark.parametrize("a, b, want", [("1999", "2000", "1999"), ("1111", "", "1111"), ("1111", "1950", "1950"), (None, "", None)])
def test_merged_year(spark, a, b, want):
    assert one(spark, codes.merged_year(F.lit(a).cast("string"), F.lit(b))) == want


@pytest.mark.parametrize("n, want", [(0, "0 B"), (1023, "1023 B"), (1152, "1.12 KB"), (1536, "1.50 KB"), (5 * 1024**3, "5.00 GB"), (None, "")])
def test_human_size(spark, n, want):
    assert one(spark, identity.human_size(F.lit(n).cast("bigint"))) == want


def test_python_character_predicates(spark):
    """The classes agree with Python's predicates (characters that this JVM and this Python both know)."""
    chars = [chr(c) for c in range(1, 0x3000) if not 0xD800 <= c < 0xE000]
    rows = spark.createDataFrame([(c,) for c in chars], "c string")
    got = rows.select("c", *[F.col("c").rlike(f"^[{k}]$").alias(n) for n, k in (("space", charclass.SPACE), ("digit", charclass.DIGIT), ("word", charclass.WORD))]).collect()
    import unicodedata

    for r in got:
        if r.c != "\n" and r.c != "\r" and unicodedata.category(r.c) != "Cn":
            assert r.space == r.c.isspace(), hex(ord(r.c))
            if ord(r.c) < 0x530:
                assert r.digit == r.c.isdigit() and r.word == (r.c.isalnum() or r.c == "_"), hex(ord(r.c))


def test_token_report_error(spark):
    def broken():
        raise RuntimeError("no model")

    rows = spark.createDataFrame([("d", "s", 3, "r", "/a/r.txt", "u", None, "", "a b")], "doc_id string, sid string, size_bytes long, txt_rel string, txt_abs string, uid string, src_kind string, src_rel string, text string")
    assert sizes.token_report(rows, broken).first().error == "no model"
    report = sizes.token_report(rows, sizes.whitespace_tokenizer)
    assert (report.first().token_count_e5, report.first().is_searchable_e5, report.first().file_name) == (2, False, "r.txt")
    assert sizes.token_report_control(report).first().not_searchable_file_count == 1


def test_report_text(spark):
    assert one(spark, sizes.report_text(F.lit(" abc\r\ndef "), 4)) == "abc\n\n...[TRUNCATED]..."


def test_clock():
    assert reports.clock(3661.4) == "01:01:01" and reports.clock(3661.9) == "01:01:02"


def test_empty_tables(spark):
    rows = spark.createDataFrame([], "doc_id string, txt_rel string, text string, size_bytes long")
    assert pipeline.chunks(rows).columns == field_names(CHUNKS)
    assert pipeline.chunks(rows).count() == 0
    assert ANALYSED


@pytest.mark.parametrize("sampled", [0, 20, 256])
def test_duplicates_of_a_large_group(spark, monkeypatch, sampled):
    from folioforge.operators import duplicates

    monkeypatch.setattr(duplicates, "SAMPLED", sampled)
    rng = random.Random(2)
    data = [(f"d/{rng.randrange(10**6)}X{i}", rng.choice(["aa", "bb", "cc", "ddd", "eeee" + str(i)])) for i in range(200)]
    rows = spark.createDataFrame([(r, "/" + r, len(c), c, "i", "s", "u") for r, c in data], "txt_rel string, txt_abs string, size_bytes long, content string, doc_id string, sid string, uid string").repartition(5)
    import hashlib

    groups = {}
    for r, c in data:
        groups.setdefault((len(c), hashlib.sha1(c.encode()).hexdigest()), []).append(r)
    shared = sorted({k[0] for k in groups if sum(len(v) for g, v in groups.items() if g[0] == k[0]) > 1})
    large = sorted(k for k, v in groups.items() if len(v) > 1)
    want = sorted((n + 1, shared.index(k[0]) + 1, i + 1, r) for n, k in enumerate(large) for i, r in enumerate(sorted(groups[k], key=str.lower)))
    got = sorted((r.report_group_no, r.size_group_no, r.group_index, r.txt_rel) for r in duplicates.same_size_same_content(rows).collect())
    assert got == want


@pytest.mark.parametrize("values, zone, want", [
    (["621.3"], "early", 1.0), (["621.3", "621.3"], "early", 1.0), (["621.3", "004.5"], "early", 0.895), (["621.3", "004.5", "621.3"], "late", 0.53), (["621.3"], "late", 0.6), ([], "not_found", 0.0),
])
def test_weight_of_a_code(spark, values, zone, want):
    """Base 0.85 or 0.45, a tenth of the mean likeness of all pairs (of 621.3 and 004.5: one character of five, 0.2), a twentieth of the chosen code's share; at most 1."""
    selected = [(v, "", i, 0, "exact") for i, v in enumerate(values)]
    schema = "c struct<value:string,zone:string,selected:array<struct<value:string,context:string,pos_from_start:int,pos_from_end:int,source_tag:string>>>"
    df = spark.createDataFrame([((values[0] if values else "", zone, selected),)], schema)
    assert df.select(codes.weight(F.col("c"), codes.udc_form)).first()[0] == want
