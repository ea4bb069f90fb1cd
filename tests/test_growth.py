"""Long pages: results against plain Python, and time that grows with the page and not with its square."""

import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from folioforge.functions import arrays, charclass
from folioforge.operators import cleaning, codes, names, quality


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values))
    return row.select(column.alias("x")).first()["x"]


def test_looked_up(spark):
    rng = random.Random(3)
    for size, table in ((0, 0), (0, 5), (7, 0), (300, 40), (50, 400)):
        keys = [rng.choice([None, *range(60)]) for _ in range(size)]
        known = {k: rng.randrange(1000) for k in rng.sample(range(-10, 500), table)}
        df = spark.createDataFrame([(keys, [(k, v) for k, v in known.items()])], "keys array<int>, t array<struct<key:int,value:int>>")
        assert df.select(arrays.looked_up(F.col("keys"), F.col("t"))).first()[0] == [known.get(k) for k in keys]


@pytest.mark.parametrize("n", [0, 1, 64, 65, 4096, 4097, 30011])
def test_running_before(spark, n):
    rng = random.Random(n)
    values = [rng.randrange(9) for _ in range(n)]
    got = spark.createDataFrame([(values,)], "a array<int>").select(arrays.running_before(F.col("a"))).first()[0]
    assert got == [0, *itertools.accumulate(values)][:n]


def test_empty_parentheses_at_any_depth(spark):
    rng = random.Random(8)
    texts = ["(" * 50 + " " + ")" * 50 + "x", "((a) ())", ")(", "", "( ( )", "a (()(( ))) b"] + ["".join(rng.choice("() a") for _ in range(30)) for _ in range(60)]

    def fixpoint(s):
        import re

        while (t := re.sub(r"\(\s*\)", "", s)) != s:
            s = t
        return s

    rows = spark.createDataFrame([(t,) for t in texts], "s string").select("s", names.without_empty_parens(F.col("s")).alias("x")).collect()
    assert {r["s"]: r["x"] for r in rows} == {t: fixpoint(t) for t in texts}


def test_strip_against_plain_python(spark):
    rng = random.Random(9)
    texts = ["", " ", charclass.SPACES, "a \n", "\u200ba\u200b", "\x00 a"] + ["".join(rng.choice([*charclass.SPACES, "a", "я", "\u200b", "😀"]) for _ in range(rng.randrange(12))) for _ in range(400)]
    rows = spark.createDataFrame([(t,) for t in texts], "s string").select("s", charclass.strip(F.col("s")).alias("x")).collect()
    assert {r["s"]: r["x"] for r in rows} == {t: t.strip(charclass.SPACES) for t in texts} == {t: t.strip() for t in texts}


def blanked(spark, n: int):
    """Lines that begin with a blank and have a run of n blanks inside."""
    return spark.createDataFrame([("\n".join(f" {i}{' ' * n}." for i in range(40)),)], "text string")


def test_blanks_inside_lines_take_linear_time(spark):
    """Stripping by a pattern looked for the end from each blank of a run: sixteen times as long for four times the blanks."""
    took = {}
    for n in (500, 4000, 16_000):
        df = blanked(spark, n).cache()
        df.count()
        plan, best = df.select(F.xxhash64(quality.line_entries(F.col("text")))), 1e9
        for _ in range(2):
            began = time.time()
            plan.collect()
            best = min(best, time.time() - began)
        took[n] = best
        df.unpersist()
    assert took[16_000] < 6 * took[4000] + 0.5, took


def text_of(n: int) -> str:
    rng = random.Random(n)
    return "\n".join(rng.choice(["short line", "", "12 34 | 5", f"a line of its own {i}", f"again {i % 500}"]) for i in range(n))


def page(spark, n: int):
    return spark.createDataFrame([(text_of(n), "OCR_TXT/a.txt", None, "ok")], "text string, txt_rel string, txt_abs string, quality_class string")


def test_repeated_lines_of_a_long_page(spark):
    text = text_of(20_000)
    lines = [s.strip() for s in text.split("\n")]
    count: dict[str, int] = {}
    for s in lines:
        count[s] = count.get(s, 0) + 1
    got = page(spark, 20_000).select(quality.line_entries(F.col("text")).alias("x")).first()["x"]
    assert [(e["line_no"], e["is_duplicate_in_chunk"]) for e in got] == [(i + 1, count[s] > 1) for i, s in enumerate(lines) if s]


def labelled(spark, n: int):
    return spark.createDataFrame([("x УДК 621.3 y " * n,)], "text string")


WORK = {
    "analysed": (page, lambda df: quality.analyze(df).select(F.xxhash64("lines"))),
    "decided": (page, lambda df: cleaning.clean_all(quality.analyze(df)).select(F.xxhash64("decisions"))),
    "labels": (labelled, lambda df: df.select(F.sum(F.aggregate(codes.places(F.col("text"), "УДК", 3), F.lit(0).cast("bigint"), lambda a, x: a + x)))),
}


@pytest.mark.parametrize("name", WORK)
def test_twice_the_page_takes_about_twice_the_time(spark, name):
    """50,000 and 100,000 lines (or labels). The best of two runs each: a square would be fourfold."""
    source, work = WORK[name]
    took = {}
    for n in (2000, 50_000, 100_000):
        df = source(spark, n).cache()
        df.count()
        plan, best = work(df), 1e9
        for _ in range(2):
            began = time.time()
            plan.collect()
            best = min(best, time.time() - began)
        took[n] = best
        df.unpersist()
    assert took[100_000] < 3 * took[50_000] + 0.5, took
    print(name, took)
