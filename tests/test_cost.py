"""What a page's stages read: every expensive expression stands once in its plan, and the short forms count as the plain ones do."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from folioforge.operators import cleaning, pages, quality
from folioforge.plans import catalog


def plan(df):
    return df._jdf.queryExecution().analyzed().toString()


@pytest.fixture(scope="module")
def page(spark):
    return spark.createDataFrame([("a-\r\nb  \nc", "OCR_TXT/a.txt", None)], "text string, txt_rel string, txt_abs string")


def test_texts_are_normalised_once(page):
    assert plan(pages.split(page)).count("{3,}") == 1


def test_lines_are_measured_once_for_line_and_page(page):
    assert plan(quality.analyze(page)).count("{2,}+") == 1


def test_pages_are_counted_without_line_ratios(page):
    """Ratios and classes of lines belong to their entries only; a page's metrics need counts."""
    assert "_ratio" not in page.select(quality.measured_lines(F.col("text"))).schema.simpleString()


def test_lines_are_judged_once(page):
    made = page.select(cleaning.decisions(F.col("text"), F.lit(None).cast(cleaning.entries_type()), F.lit("ok")).alias("x"))
    assert plan(made).count("exists(") == 2  # technical tokens, and numbered entries


def test_a_library_is_read_once(spark):
    """The manifest's own columns and those beside them come from the same rows, without a join."""
    made = plan(catalog.QUERIES["library_manifest"](spark, "/root/testdata/sf0.001"))
    assert "Join" not in made and made.count("Relation [") == 1


def test_table_tokens_are_sorted_once(page):
    assert plan(page.select(cleaning.keep_tokens(F.col("text"), 3).alias("x"))).count("{4,}") == 1
    assert plan(page.select(cleaning.clean_tab(F.col("text")).alias("x"))).count("{4,}") == 1


def test_numbers_against_plain_python(spark):
    rng = random.Random(6)
    marks = ["a", "Я", "é", "é", "́", "_", "__", "5", "77", "²", "½", "Ⅷ", "٣", "①", "𝟗", "𝒜𝒷", " ", "  ", "\t", " ", "　", "-", ".", "€", "aa", "\n", " ", "字", "​"]
    texts = ["", " ", "a", "aa", "a aa a", "_ __ 5 55"] + ["".join(rng.choice(marks) for _ in range(rng.randrange(1, 40))) for _ in range(400)]
    space = set("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0     　") | {chr(c) for c in range(0x2000, 0x200B)}

    def plain(s):
        kinds = ["L" if unicodedata.category(c)[0] == "L" else "N" if unicodedata.category(c)[0] == "N" else "S" if c in space else "P" for c in s]
        words = "".join(c if k in "LN" or c == "_" else " " for c, k in zip(s, kinds, strict=True)).split(" ")
        words = [w for w in words if w]
        return {"n": len(s), "letters": kinds.count("L"), "digits": sum(c.isdigit() for c in s), "spaces": kinds.count("S"), "puncts": kinds.count("P"), "tokens": len(words), "ones": sum(len(w) == 1 for w in words), "chars": sum(map(len, words))}

    rows = spark.createDataFrame([(t,) for t in texts], "s string").select("s", quality.numbers(F.col("s")).alias("x")).collect()
    for r in rows:
        assert r["x"].asDict() == plain(r["s"]), repr(r["s"])
