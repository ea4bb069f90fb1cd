"""Quality of lines and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..config import QualityConfig
from ..functions.arrays import looked_up
from ..functions.charclass import DIGIT, SPACE, WORD, count, let, ratio, strip
from ..functions.observing import observed
from ..schemas import LINE_FIELDS, METRICS, names

#: Line breaks of one character.
BREAK = r"[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
#: Counts that add up over a page's lines: line breaks and blank lines are white space only, and no token crosses lines.
COUNTS = ("letters", "digits", "puncts", "tokens", "ones", "chars")
#: A page gets a point for each threshold that it crosses.
THRESHOLDS = {"min_letter_ratio": 0.35, "max_digit_ratio": 0.30, "max_punct_ratio": 0.25, "max_single_char_token_ratio": 0.30, "max_non_letter_line_ratio": 0.40, "min_avg_token_len": 3.0, "max_short_line_ratio": 0.30, "max_duplicate_line_ratio": 0.20, "short_line_chars": 3, "junk_score": 5, "suspicious_score": 3}
LINE_CLASSES = {"text_line": 0, "short_text": 1, "table_like": 2, "non_letter": 3}


def numbers(s: Column) -> Column:
    """Counts over a text: characters in all and by kind, tokens, one-character tokens and characters in tokens.

    Runs of letters become two letters each; these, white space and numbers are then taken away one after another, so only
    the first pattern reads the whole text. Tokens of several characters become two letters each in the same way, so
    lengths tell how many there are of them and of single ones; in a text of letters only that is done already.
    """
    gone = lambda x, inside: F.regexp_replace(x, f"[{inside}]+", "")
    unpaired = lambda x: F.replace(x, F.lit("aa"))

    def lengths(y: Column) -> Column:
        return let(F.regexp_replace(unpaired(y), r"\p{L}+", ""), lambda a: let(gone(a, SPACE), lambda b: let(gone(b, r"\p{N}"), lambda c: let(F.length(F.replace(c, F.lit("_"))), lambda rest: F.struct(
            F.length(s).alias("n"), F.length(a).alias("a"), F.length(b).alias("b"), F.length(c).alias("puncts"), (F.length(c) - rest).alias("lows"),
            F.when(F.length(b) == F.length(c), 0).otherwise(count(b, DIGIT)).alias("digits"), tokens(F.when(F.length(b) == rest, y).otherwise(F.regexp_replace(y, f"[{WORD}]{{2,}}+", "aa"))).alias("t"),
        )))))

    def tokens(x: Column) -> Column:
        return let(x, lambda y: F.struct(F.length(y).alias("n"), F.length(unpaired(y)).alias("rest")))

    def counted(k: Column) -> Column:
        spaces, several = k["a"] - k["b"], ((k["t"]["n"] - k["t"]["rest"]) / 2).cast("int")
        chars = k["n"] - spaces - k["puncts"] + k["lows"]
        ones = k["t"]["rest"] - (k["n"] - chars)
        return F.struct(k["n"].alias("n"), (k["n"] - k["a"]).alias("letters"), k["digits"].alias("digits"), spaces.alias("spaces"), k["puncts"].alias("puncts"), (ones + several).alias("tokens"), ones.alias("ones"), chars.alias("chars"))

    return let(let(F.regexp_replace(s, r"\p{L}\p{L}+", "aa"), lengths), counted)


def lines(text: Column) -> Column:
    """The lines that aren't blank, with their numbers among all lines: (line_no, text, stripped)."""
    pieces = F.split(F.replace(text, F.lit("\r\n"), F.lit("\n")), BREAK, -1)
    numbered = F.transform(pieces, lambda s, i: F.struct((i + 1).alias("line_no"), s.alias("text"), strip(s).alias("stripped")))
    return F.filter(numbered, lambda x: x["stripped"] != "")


def repeated(items: Column) -> Column:
    """For each line whether its stripped text occurs more than once: a look into the sorted texts that do."""
    return let(F.transform(items, lambda x: x["stripped"]), lambda t: F.when(F.size(F.array_distinct(t)) == F.size(t), F.transform(t, lambda _: F.lit(False))).otherwise(_among_repeated(t)))


def _among_repeated(texts: Column) -> Column:
    twice = let(F.array_sort(texts), lambda s: F.filter(s, lambda x, i: (i > 0) & (x == F.get(s, i - 1)) & ((i == 1) | (x != F.get(s, i - 2)))))
    return F.transform(looked_up(texts, F.transform(twice, lambda x: F.struct(x.alias("key"), F.lit(True).alias("value")))), lambda v: v.isNotNull())


def line_entry(x: Column) -> Column:
    """The entry of a measured line, with the fields of schemas.LINE."""
    c = x["counts"]
    first = F.struct(
        x["line_no"].cast("int").alias("line_no"), x["text"].alias("text"), c["n"].alias("text_len"), x["text_len_stripped"].alias("text_len_stripped"), c["tokens"].alias("token_count_simple"),
        *[ratio(c[k], c["n"]).alias(f"{name}_ratio") for name, k in (("letter", "letters"), ("digit", "digits"), ("punct", "puncts"), ("space", "spaces"))],
        ratio(c["ones"], c["tokens"]).alias("single_char_token_ratio"), ratio(c["chars"], c["tokens"]).alias("avg_token_len"),
        x["has_letter"].alias("has_letter"), (c["digits"] > 0).alias("has_digit"), x["is_duplicate_in_chunk"].alias("is_duplicate_in_chunk"),
    )

    def graded(m: Column) -> Column:
        flags = [m["digit_ratio"] >= 0.30, m["letter_ratio"] <= 0.50, (m["single_char_token_ratio"] >= 0.40) & (m["token_count_simple"] >= 4), ~m["has_letter"], (m["avg_token_len"] > 0) & (m["avg_token_len"] < 3.0)]
        return let(sum((f.cast("int") for f in flags), F.lit(0)), lambda score: F.struct(
            *[m[f].alias(f) for f in LINE_FIELDS[:-2]], score.alias("table_like_score_line"),
            F.when(~m["has_letter"], "non_letter").when(score >= 2, "table_like").when(m["text_len_stripped"] <= 3, "short_text").otherwise("text_line").alias("line_class"),
        ))

    return let(first, graded)


def line_entries(text: Column) -> Column:
    """Entries of all lines that aren't blank, with the fields of schemas.LINE."""
    return F.transform(measured_lines(text), line_entry)


def measured_lines(text: Column) -> Column:
    """All lines that aren't blank with their counts, and what a page's metrics ask of them; ratios are left to line_entry."""

    def measured(x: Column, twice: Column) -> Column:
        return let(numbers(x["text"]), lambda c: F.struct(x["line_no"], x["text"], F.length(x["stripped"]).alias("text_len_stripped"), twice.alias("is_duplicate_in_chunk"), (c["letters"] > 0).alias("has_letter"), c.alias("counts")))

    return let(lines(text), lambda items: let(repeated(items), lambda twice: F.transform(items, lambda x, i: measured(x, F.get(twice, i)))))


def page_metrics(c: Column, items: Column) -> dict[str, Column]:
    """Metrics of a page from its counts and its measured lines, up to its quality class."""
    rows = F.size(items)
    some = lambda f: F.size(F.filter(items, f))
    return {
        "text_len": c["n"], "line_count": rows, "token_count": c["tokens"], **{f"{name}_ratio": ratio(c[k], c["n"]) for name, k in (("letter", "letters"), ("digit", "digits"), ("punct", "puncts"))},
        "single_char_token_ratio": ratio(c["ones"], c["tokens"]), "non_letter_line_ratio": ratio(some(lambda x: ~x["has_letter"]), rows), "avg_token_len": ratio(c["chars"], c["tokens"]),
        "short_line_ratio": ratio(some(lambda x: x["text_len_stripped"] <= 3), rows), "duplicate_line_ratio": ratio(some(lambda x: x["is_duplicate_in_chunk"]), rows),
    }


def junk_flags() -> dict[str, Column]:
    t = THRESHOLDS
    c = F.col
    return {
        "low_letters": c("letter_ratio") < t["min_letter_ratio"], "high_digits": c("digit_ratio") > t["max_digit_ratio"], "high_punct": c("punct_ratio") > t["max_punct_ratio"],
        "single_chars": c("single_char_token_ratio") > t["max_single_char_token_ratio"], "non_letter_lines": c("non_letter_line_ratio") > t["max_non_letter_line_ratio"], "short_tokens": c("avg_token_len") < t["min_avg_token_len"],
        "short_lines": c("short_line_ratio") > t["max_short_line_ratio"], "duplicate_lines": c("duplicate_line_ratio") > t["max_duplicate_line_ratio"],
    }


def analyze(pages: DataFrame, config: QualityConfig = QualityConfig(), counters: Observation | None = None) -> DataFrame:  # noqa: B008
    """pages with their line entries, metrics, junk score and quality class. A byte order mark before the text goes; null counts as empty. `counters` get the figures of quality_stats."""
    if "doc_id16" not in pages.columns:
        pages = pages.withColumn("doc_id16", F.lit(None).cast("string"))
    rows = pages.withColumn("text", F.regexp_replace(F.coalesce("text", F.lit("")), "^\ufeff+", "")).withColumn("_lines", measured_lines(F.col("text")))
    total = lambda k: F.aggregate("_lines", F.lit(0), lambda a, x: a + x["counts"][k])
    rows = rows.withColumns({"lines": F.transform("_lines", line_entry), "_numbers": F.struct(F.length("text").alias("n"), *[total(k).alias(k) for k in COUNTS])})
    rows = rows.withColumns(page_metrics(F.col("_numbers"), F.col("_lines")))
    rows = rows.withColumn("junk_score", sum((f.cast("int") for f in junk_flags().values()), F.lit(0)))
    kind = F.when(F.col("junk_score") >= THRESHOLDS["junk_score"], "junk_candidate").when(F.col("junk_score") >= THRESHOLDS["suspicious_score"], "suspicious").otherwise("ok")
    rows = rows.withColumn("quality_class", kind)
    others = [c for c in pages.columns if c not in {*names(METRICS), "lines"}]
    rows = observed(rows.select(*others, *names(METRICS), "lines"), counters, quality_counters())
    return compact(rows) if config.lines_format == "compact" else rows


def compact(analysed: DataFrame) -> DataFrame:
    """Line entries as lists in the order of lines_schema, as text: booleans as 0 and 1, classes as numbers."""
    code = F.create_map(*[F.lit(x) for pair in LINE_CLASSES.items() for x in pair])

    def row(x: Column) -> Column:
        flags = {"has_letter", "has_digit", "is_duplicate_in_chunk"}
        return F.array(*[(x[f].cast("int") if f in flags else F.element_at(code, x[f]) if f == "line_class" else x[f]).cast("string") for f in LINE_FIELDS])

    return analysed.withColumn("lines", F.transform("lines", row)).withColumn("lines_schema", F.array(*map(F.lit, LINE_FIELDS)))


def expanded(lines: Column, schema: Column) -> Column:
    """Compact line entries as structs again; an unknown class number becomes `unknown`."""
    from ..schemas import LINE

    kinds = dict(x.split(" ") for x in LINE.split(", "))
    name = F.create_map(*[F.lit(x) for k, v in LINE_CLASSES.items() for x in (str(v), k)])

    def entry(x: Column) -> Column:
        at = lambda f: F.get(x, F.array_position(schema, f).cast("int") - 1)
        made = [F.coalesce(F.try_element_at(name, at(f)), F.lit("unknown")) if f == "line_class" else at(f).cast("int").cast("boolean") if kinds[f] == "boolean" else at(f).cast(kinds[f]) for f in LINE_FIELDS]
        return F.struct(*[m.alias(f) for m, f in zip(made, LINE_FIELDS, strict=True)])

    return F.transform(lines, entry)


def expand(compacted: DataFrame) -> DataFrame:
    """The reverse of compact."""
    return compacted.withColumn("lines", expanded(F.col("lines"), F.col("lines_schema"))).drop("lines_schema")


def quality_counters() -> dict[str, Column]:
    """Aggregates over analysed pages: pages in all and by class, lines that aren't blank."""
    return {"total": F.count("*"), **{k: F.count_if(F.col("quality_class") == k) for k in ("ok", "suspicious", "junk_candidate")}, "lines": F.coalesce(F.sum("line_count"), F.lit(0))}


def quality_stats(analysed: DataFrame) -> DataFrame:
    """One row with quality_counters and the average lines of a page."""
    made = analysed.agg(*[c.alias(k) for k, c in quality_counters().items()])
    return made.withColumn("avg_lines", F.when(F.col("total") > 0, F.bround(F.col("lines") / F.col("total"), 6)).otherwise(0.0))
