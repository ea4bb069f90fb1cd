"""Line-by-line cleaning of pages: table debris and recognition noise go, text stays.

Everything is a projection over the page's own arrays; pages never meet in a shuffle. All functions also run on a
streaming DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import CleaningConfig
from ..functions.arrays import heads, looked_up
from ..functions.charclass import DIGIT, count, let, strip, unmoved, words
from ..functions.observing import observed
from .quality import expanded

#: Technical tokens that keep a line.
TECH_TOKENS = ["ph", "fe", "cu", "zn", "pb", "au", "ag", "ni", "co", "al", "mg", "ca", "na", "k", "мм", "см", "м", "км", "г", "кг", "т", "с", "мс", "а", "в", "кв", "квт", "мпа", "па", "бар", "%", "№", "гост", "ост", "ту", "рис", "рис.", "табл", "табл."]
#: Lines up to this long are dropped as duplicates.
SHORT_LINE = 80
#: Fixed values, by quality: [letter ratio, length] for lines without letters; [score, digits, letters] for table lines; [digits, letters] for numbers.
LIMITS = {"ok": ((0.20, 40), (3, 0.45, 0.30), (0.50, 0.30)), "suspicious": ((0.35, None), (2, None, 0.45), (0.45, 0.35)), "junk": ((0.40, None), (2, None, 0.50), (0.40, 0.40))}
#: Below these letters and token lengths a kept line counts as weak.
WEAK = {"ok": (0.40, 2.8, 0.35), "other": (0.45, 3.0, 0.35)}
TAB_COUNTERS = ["lines_in", "lines_out", "table_lines", "text_lines", "tokens_seen", "tokens_kept", "numeric_removed", "mixed_removed", "latin_removed", "other_removed", "lines_removed"]
REASONS = ["empty_after_normalize", "too_short", "short_no_letters", "duplicate_short_line", "single_char_ocr_noise", "non_letter_line", "table_like_line", "heavy_numeric"]


def is_tab(txt_abs: Column, txt_rel: Column) -> Column:
    """Whether a path goes through a folder named tab."""
    inside = lambda c: F.coalesce(F.contains(F.lower(F.translate(c, "\\", "/")), F.lit("/tab/")), F.lit(False))
    return inside(txt_abs) | inside(txt_rel)


def normalize_line(s: Column) -> Column:
    """Letters and digits; everything else as single spaces between."""
    # most lines have no digits but 0 to 9: for those a class of few parts does
    others = lambda v: F.when(v.rlike(r"[\p{N}&&[^0-9]]"), F.regexp_replace(v, rf"[^\p{{L}}{DIGIT}]+", " ")).otherwise(F.regexp_replace(v, r"[^\p{L}0-9]+", " "))
    return F.trim(let(s, others))


def line_metrics(s: Column) -> Column:
    """Metrics of a normalised line over its blank-separated tokens, not rounded."""

    def made(tokens: Column) -> Column:
        n, k = F.length(s), F.size(tokens)
        part = lambda x, of: F.when(of > 0, x / of).otherwise(0.0)
        chars = F.aggregate(tokens, F.lit(0), lambda a, t: a + F.length(t))

        def counted(rest: Column) -> Column:
            return F.struct(
                part(count(rest, DIGIT), n).alias("digit_ratio"), part(n - F.length(rest), n).alias("letter_ratio"), part(F.size(F.filter(tokens, lambda t: F.length(t) == 1)), k).alias("single_char_token_ratio"),
                k.alias("token_count"), part(chars, k).alias("avg_token_len"), (n > F.length(rest)).alias("has_letter"), F.length(strip(s)).alias("text_len_stripped"),
            )

        return let(F.regexp_replace(s, r"\p{L}+", ""), counted)

    return let(words(s), made)


def is_table_line(m: Column) -> Column:
    return (m["digit_ratio"] >= 0.30) | (m["letter_ratio"] <= 0.50) | ((m["single_char_token_ratio"] >= 0.40) & (m["token_count"] >= 4))


def keep_tokens(s: Column, min_word_len: int) -> Column:
    """Of a table line: (line, tokens_seen, tokens_kept, numeric_removed, mixed_removed, latin_removed, other_removed).

    Only Cyrillic words of more than min_word_len letters stay.
    """
    wanted = rf"^[\u0410-\u042f\u0430-\u044f\u0401\u0451]{{{min_word_len + 1},}}$"

    def made(tokens: Column) -> Column:
        kind = lambda t: F.when(t.rlike(wanted), "kept").when(t.rlike(f"[{DIGIT}]"), F.when(t.rlike(r"\p{L}"), "mixed").otherwise("numeric")).when(t.rlike("[A-Za-z]"), "latin").otherwise("other")

        def counted(kinds: Column) -> Column:
            some = lambda name: F.size(F.filter(kinds, lambda k: k == name))
            kept = F.filter(tokens, lambda _, i: F.get(kinds, i) == "kept")
            return F.struct(F.array_join(kept, " ").alias("line"), F.size(tokens).alias("tokens_seen"), some("kept").alias("tokens_kept"), *[some(x).alias(f"{x}_removed") for x in ("numeric", "mixed", "latin", "other")])

        return let(F.transform(tokens, kind), counted)

    return let(words(s), made)


def raw_lines(text: Column) -> Column:
    return F.split(let(text, lambda t: F.when(F.contains(t, F.lit("\r")), F.regexp_replace(t, "\r\n?", "\n")).otherwise(t)), "\n", -1)


def clean_tab(text: Column, config: CleaningConfig = CleaningConfig()) -> Column:  # noqa: B008
    """(text, and the counters of TAB_COUNTERS) of a table page."""

    def line(s: Column) -> Column:
        def either(table: Column, n: Column) -> Column:
            plain = F.struct(s.alias("line"), n.alias("tokens_seen"), n.alias("tokens_kept"), *[F.lit(0).alias(f"{x}_removed") for x in ("numeric", "mixed", "latin", "other")])
            return F.struct(table.alias("table"), F.when(table, keep_tokens(s, config.min_word_len)).otherwise(plain).alias("x"))

        about = let(line_metrics(s), lambda m: F.struct(is_table_line(m).alias("table"), m["token_count"].alias("n")))
        return let(about, lambda a: either(a["table"], a["n"]))

    def made(raw: Column, seen: Column, out: Column) -> Column:
        total = lambda f: F.aggregate(seen, F.lit(0), lambda a, e: a + e["x"][f])
        tables = F.size(F.filter(seen, lambda e: e["table"]))
        counters = {"lines_in": F.size(raw), "lines_out": F.size(out), "table_lines": tables, "text_lines": F.size(seen) - tables, "lines_removed": F.size(raw) - F.size(out)}
        counters |= {f: total(f) for f in ("tokens_seen", "tokens_kept", "numeric_removed", "mixed_removed", "latin_removed", "other_removed")}
        return F.struct(F.array_join(out, "\n").alias("text"), *[counters[c].alias(c) for c in TAB_COUNTERS])

    filled = lambda raw: F.filter(F.transform(raw, normalize_line), lambda s: s != "")
    out = lambda seen: F.filter(F.transform(seen, lambda e: e["x"]["line"]), lambda s: s != "")
    return let(raw_lines(text), lambda raw: let(F.transform(filled(raw), line), lambda seen: let(out(seen), lambda o: made(raw, seen, o))))


def aligned(raw: Column, entries: Column) -> Column:
    """Of each raw line (text, entry): the entry by place if there are as many, else by line number (of equal numbers the last), else by place among the lines that aren't blank, if there are as many of those; null if none."""

    def made(both: Column) -> Column:
        rows, found = both["raw"], both["entries"]
        numbered = F.transform(found, lambda e, i: F.struct(e["line_no"].alias("key"), (-i).alias("value")))
        last = let(F.array_sort(F.filter(numbered, lambda x: x["key"] >= 1)), lambda s: heads(s))
        spots = F.filter(F.transform(rows, lambda s, i: F.when(strip(s) != "", i)), lambda i: i.isNotNull())
        by_number = F.transform(looked_up(F.transform(rows, lambda _, i: i + 1), last), lambda v: -v)
        by_place = looked_up(F.transform(rows, lambda _, i: i), F.transform(spots, lambda at, i: F.struct(at.alias("key"), i.alias("value"))))
        place = F.when(F.size(found) == F.size(rows), F.transform(rows, lambda _, i: i)).when(F.exists(found, lambda e: e["line_no"] >= 1), by_number).when(F.size(found) == F.size(spots), by_place)
        return let(place, lambda p: F.transform(rows, lambda s, i: F.struct(s.alias("raw"), F.get(found, F.get(p, i)).alias("entry"))))

    found = F.coalesce(entries, F.array().cast(entries_type()))
    return let(F.struct(raw.alias("raw"), found.alias("entries")), made)


#: Columns that may hold line entries, in the order in which they are asked, and other names of their fields.
ENTRY_COLUMNS = ("line_stats", "lines_stats", "text_lines_stats", "per_line_stats", "line_metrics_list", "lines", "analyzed_lines")
OTHER_NAMES = {"token_count_simple": "token_count"}


def _entry(field, kinds: dict[str, str]):
    return lambda x: F.struct(*[field(x, f) for f in kinds])


def line_entries_of(analysed: DataFrame) -> Column:
    """The line entries of each row: compact ones (`lines` with lines_schema) first, else those of the first entry column that has any.

    Columns may have some of an entry's fields only; the others are null, as the cleaner's own measures stand in for them.
    """
    from ..schemas import LINE

    kinds = {k: v for k, v in (x.split(" ") for x in LINE.split(", "))}
    types = {f.name: f.dataType for f in analysed.schema.fields}
    found = []
    if "lines_schema" in types and isinstance(types.get("lines"), T.ArrayType) and isinstance(types["lines"].elementType, T.ArrayType):
        found.append(F.when(F.size("lines_schema") > 0, expanded(F.col("lines"), F.col("lines_schema"))))
    for name in ENTRY_COLUMNS:
        inner = types[name].elementType if isinstance(types.get(name), T.ArrayType) else None
        if not isinstance(inner, T.StructType):
            continue
        named = {f: [k for k in (f, OTHER_NAMES.get(f)) if k in inner.names] for f in kinds}
        field = lambda x, f, named=named: (F.coalesce(*[x[k].cast(kinds[f]) for k in named[f]]) if named[f] else F.lit(None).cast(kinds[f])).alias(f)
        found.append(F.transform(F.filter(name, lambda x: x.isNotNull()), _entry(field, kinds)))
    full = [F.when(F.size(x) > 0, x) for x in found]
    return F.coalesce(*full) if full else F.lit(None).cast(entries_type())


def entries_type() -> str:
    from ..schemas import LINE

    return "array<struct<" + ", ".join(x.replace(" ", ":", 1) for x in LINE.split(", ")) + ">>"


def line_state(x: Column) -> Column:
    """The line as it is judged: normalised text, and numbers of the stage before where there are any."""
    e = x["entry"]
    line = let(normalize_line(e["text"]), lambda theirs: F.when(F.coalesce(theirs, F.lit("")) != "", theirs).otherwise(normalize_line(x["raw"])))
    # the line's own measures are taken only where the entry lacks one
    measures = ("letter_ratio", "digit_ratio", "single_char_token_ratio", "avg_token_len", "has_letter")
    whole = F.coalesce(e["text_len_stripped"], e["text_len"]).isNotNull() & e["token_count_simple"].isNotNull()
    for f in measures:
        whole = whole & e[f].isNotNull()

    def made(s: Column) -> Column:
        return let(
            F.when(~whole, line_metrics(s)),
            lambda m: F.struct(
                s.alias("line"), F.lower(s).alias("low"), F.coalesce(e["text_len_stripped"], e["text_len"], m["text_len_stripped"]).alias("text_len"), F.coalesce(e["token_count_simple"], m["token_count"]).alias("tokens"),
                *[F.coalesce(e[f], m[f]).alias(f) for f in measures],
                F.coalesce(e["is_duplicate_in_chunk"], F.lit(False)).alias("dup"), F.coalesce(e["table_like_score_line"], F.lit(0)).alias("score"), F.coalesce(F.nullif(e["line_class"], F.lit("")), F.lit("unknown")).alias("kind"),
            ),
        )

    return let(line, made)


def _class_rule(st: Column, quality: str) -> Column:
    (letters, length), (score, digits, table_letters), (numbers, few) = LIMITS[quality]
    bare = (st["kind"] == "non_letter") & (st["letter_ratio"] < letters)
    table = (st["score"] >= score) & (st["letter_ratio"] < table_letters)
    bare = bare & (st["text_len"] < length) if length else bare
    table = table & (st["digit_ratio"] > digits) if digits else table
    heavy = (st["digit_ratio"] > numbers) & (st["letter_ratio"] < few)
    return F.when(bare, "non_letter_line").when(table, "table_like_line").when(heavy, "heavy_numeric")


def judged(st: Column, quality: Column) -> Column:
    """The state with `early` (a reason that holds whatever was seen before), `late` (one after the duplicate rule), tech and weak."""
    tech = F.exists(F.split(st["low"], " "), lambda t: t.isin(TECH_TOKENS))
    return let(tech, lambda t: _judged(st, quality, t))


def _judged(st: Column, quality: Column, tech: Column) -> Column:
    ok = quality == "ok"
    early = F.when(st["line"] == "", "empty_after_normalize").when(tech, F.lit(None)).when(st["text_len"] <= 2, "too_short").when(~st["has_letter"] & (st["text_len"] < 25), "short_no_letters")
    noise = (st["tokens"] >= 4) & (st["single_char_token_ratio"] > F.when(ok, 0.60).otherwise(0.50))
    by_class = F.when(ok, _class_rule(st, "ok")).when(quality == "suspicious", _class_rule(st, "suspicious")).otherwise(_class_rule(st, "junk"))
    late = F.when(tech, F.lit(None)).when(noise, "single_char_ocr_noise").otherwise(by_class)
    limit = lambda i: F.when(ok, WEAK["ok"][i]).otherwise(WEAK["other"][i])
    weak = (st["letter_ratio"] < limit(0)) | (st["avg_token_len"] < limit(1)) | (st["single_char_token_ratio"] > limit(2))
    short_twice = (st["text_len"] <= SHORT_LINE) & st["dup"]
    # a line is remembered if it's short and kept; kept lines that aren't technical have passed every other rule
    remembered = lambda r: (F.length(st["low"]) <= SHORT_LINE) & r["early"].isNull() & r["late"].isNull() & (tech | ~short_twice)
    return let(F.struct(early.alias("early"), late.alias("late")), lambda r: F.struct(
        st["line"].alias("line"), st["low"].alias("low"), st["text_len"].alias("text_len"), tech.alias("tech"), r["early"].alias("early"), r["late"].alias("late"), weak.alias("weak"), st["dup"].alias("dup"), remembered(r).alias("remembered"),
    ))


def decisions(text: Column, entries: Column, quality: Column) -> Column:
    """Of each line of a page that isn't a table page: (line_no, line, action, reason).

    A short line is a duplicate if the stage before says so or if the same line, lower-cased, was kept earlier on the
    page: the first place of every remembered line answers that without a fold.
    """

    def made(all_lines: Column) -> Column:
        remembered = F.filter(F.transform(all_lines, lambda x, i: F.struct(x["low"].alias("key"), i.alias("value"), x["remembered"].alias("remembered"))), lambda x: x["remembered"])
        firsts = looked_up(F.transform(all_lines, lambda x: x["low"]), let(F.array_sort(remembered), lambda s: heads(s)))

        def decide(first: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                seen = F.coalesce(F.get(first, i) < i, F.lit(False))
                twice = ~x["tech"] & (x["text_len"] <= SHORT_LINE) & (x["dup"] | seen)
                reason = F.coalesce(x["early"], F.when(twice, "duplicate_short_line"), x["late"])
                action = F.when(reason.isNotNull(), "drop").when(~x["tech"] & x["weak"], "normalize").otherwise("keep")
                why = F.coalesce(reason, F.when(x["tech"], "tech_whitelist").when(x["weak"], "weak_text").otherwise("good_text"))
                return F.struct((i + 1).alias("line_no"), x["line"].alias("line"), action.alias("action"), why.alias("reason"))

            return F.transform(all_lines, one)

        return let(firsts, decide)

    judge = lambda q: F.transform(aligned(raw_lines(text), entries), lambda x: let(line_state(x), lambda st: judged(st, q)))
    return let(let(quality, judge), made)


def clean_all(analysed: DataFrame, config: CleaningConfig = CleaningConfig()) -> DataFrame:  # noqa: B008
    """analysed with the cleaned text in `clean_text`, the columns about it, and `decisions` or the counters of a table page in `tab`.

    A missing or empty quality class counts as ok; any other unknown one is treated as junk.
    """
    quality = F.coalesce(F.nullif("quality_class", F.lit("")), F.lit("ok"))
    text = F.coalesce("text", F.lit(""))
    rows = analysed.withColumn("is_tab", is_tab(F.col("txt_abs"), F.col("txt_rel")))
    rows = rows.withColumn("tab", F.when(F.col("is_tab"), clean_tab(text, config))).withColumn("decisions", F.when(~F.col("is_tab"), decisions(text, line_entries_of(analysed), quality)))
    kept = F.array_join(F.transform(F.filter("decisions", lambda d: d["action"] != "drop"), lambda d: d["line"]), "\n")
    rows = rows.withColumn("clean_text", F.coalesce("tab.text", kept))
    mode = F.when(F.col("is_tab"), "tab").when(quality == "ok", "ok").when(quality == "suspicious", "suspicious").otherwise("junk_candidate")
    return rows.withColumns({
        "clean_mode": mode, "text_before_clean_len": F.length(text), "text_after_clean_len": F.length("clean_text"),
        "chunk_changed": F.col("clean_text") != text, "became_empty_after_clean": unmoved(strip(F.col("clean_text")) == ""),
    })


def clean_pages(analysed: DataFrame, config: CleaningConfig = CleaningConfig(), counters: Observation | None = None) -> DataFrame:  # noqa: B008
    """The pages with text left, their text replaced. Line entries and metrics still tell of the text before. `counters` get the figures of clean_summary, of all pages."""
    rows = observed(clean_all(analysed, config), counters, clean_counters()).where(~F.col("became_empty_after_clean")).withColumn("text", F.col("clean_text"))
    return rows.select(*analysed.columns, "clean_mode", "text_before_clean_len", "text_after_clean_len", "chunk_changed", "became_empty_after_clean")


def clean_counters() -> dict[str, Column]:
    """Aggregates over clean_all: pages, changes, characters, lines by decision, reason and quality, tokens of table pages."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    # "decisions" is null on table pages
    some = lambda field, value: F.coalesce(F.size(F.filter("decisions", lambda d: d[field] == value)), F.lit(0))
    plain, lines = ~F.col("is_tab"), F.size("decisions")
    gone = some("action", "drop")
    by_class = {}
    for name, mode in (("ok", "ok"), ("suspicious", "suspicious"), ("junk", "junk_candidate")):
        of = F.col("clean_mode") == mode
        by_class |= {f"{name}_lines_in": total(F.when(of, lines)), f"{name}_lines_out": total(F.when(of, lines - gone)), f"{name}_lines_removed": total(F.when(of, gone))}
    return {
        "pages_in": F.count("*"), "pages_out": F.count_if(~F.col("became_empty_after_clean")), "pages_empty": F.count_if("became_empty_after_clean"), "pages_changed": F.count_if("chunk_changed"), "tab_changed": F.count_if(F.col("is_tab") & F.col("chunk_changed")),
        "chars_in": total("text_before_clean_len"), "chars_out": total("text_after_clean_len"), **{f"pages_{m}": F.count_if(F.col("clean_mode") == m) for m in ("tab", "ok", "suspicious", "junk_candidate")},
        "lines_in": total(F.when(plain, lines)), **{f"lines_{a}": total(some("action", a)) for a in ("keep", "normalize", "drop")}, "lines_whitelist": total(some("reason", "tech_whitelist")), **by_class,
        **{f"drop_{r}": total(some("reason", r)) for r in REASONS}, **{f"tab_{c}": total(F.col(f"tab.{c}")) for c in TAB_COUNTERS},
    }


def clean_summary(cleaned: DataFrame) -> DataFrame:
    """One row with clean_counters and the shares of characters gone and of table tokens kept."""
    made = cleaned.agg(*[c.alias(k) for k, c in clean_counters().items()])
    return made.withColumns({
        "char_reduction": F.when(F.col("chars_in") > 0, F.bround(1 - F.col("chars_out") / F.col("chars_in"), 6)).otherwise(0.0),
        "tab_token_keep_ratio": F.when(F.col("tab_tokens_seen") > 0, F.bround(F.col("tab_tokens_kept") / F.col("tab_tokens_seen"), 6)).otherwise(0.0),
    })
