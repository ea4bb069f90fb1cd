"""Classification codes (UDC, BBK) and years from texts."""

from __future__ import annotations

from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ManifestConfig
from ..functions.arrays import running_before
from ..functions.charclass import NOT_AFTER, NOT_BEFORE, SPACE, WORD, let, squeeze, strip

S = f"[{SPACE}]"
#: Labels, what follows them, and what ends the place where a code may stand.
UDC_LABEL, UDC_LABEL_MARKED, BBK_LABEL = "УДК", "УДК[:.\\-]", "ББК"
UDC_BLOCK = rf"(?s)^{S}*([0-9][0-9{SPACE}./:;,+()=\[\]\-]{{1,120}})"
_CAP, _LOW = "[А-ЯЁA-Z]", "[а-яёa-z]"
BBK_STOP = rf"(?iu){NOT_AFTER}УДК{NOT_BEFORE}|{NOT_AFTER}ISBN{NOT_BEFORE}|{NOT_AFTER}Авторы?{NOT_BEFORE}|{NOT_AFTER}Рецензент(?:ы)?{NOT_BEFORE}|{NOT_AFTER}Редактор{NOT_BEFORE}|\n{S}*{_CAP}[^\n]{{5,}}|[\u2014\u2013]{S}*{_CAP}{_LOW}"
BBK_SENTENCE = rf"\.{S}+{_CAP}{_LOW}{{2,}}"
_ALPHA = "[А-ЯЁа-яёA-Za-z]"
BBK_VALUE = rf"(?iu)\p{{Nd}}{{1,3}}(?:\.\p{{Nd}}{{1,3}}){{0,3}}(?:{_ALPHA}{{1,3}}\p{{Nd}}{{0,3}})?(?:-\p{{Nd}}{{1,3}})?|\p{{Nd}}{{1,3}}{_ALPHA}{{1,3}}\p{{Nd}}{{0,3}}(?:\.\p{{Nd}}{{1,3}}){{0,2}}(?:-\p{{Nd}}{{1,3}})?"
UDC_WINDOW, BBK_WINDOW = 140, 160
YEAR = r"(?<!\p{Nd})(?:18[6-9]\p{Nd}|19\p{Nd}\p{Nd}|20[0-1]\p{Nd}|202[0-5])(?!\p{Nd})"
_MARK = r"(?:[гГ]\.?|год|ГОД|т\.)"
_EDGE = f"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"
YEAR_AFTER, YEAR_BEFORE = rf"^{S}*{_MARK}{_EDGE}", rf"{_EDGE}{_MARK}{S}*$"
PUBLISHING = r"(?iu)изд\.?|издание|выпуск|тираж|печать|подписано"


def normalize_block(s: Column) -> Column:
    return F.regexp_replace(squeeze(strip(s)), "^[ ,;:-]+|[ ,;:-]+$", "")


def udc_form(s: Column) -> Column:
    """The characters of a UDC code that count when codes are compared."""
    return F.regexp_replace(s, r"[^0-9./:+()\[\]\-]", "")


def bbk_form(s: Column) -> Column:
    return F.regexp_replace(s, r"[^0-9A-Za-zА-Яа-яЁё./:+()\[\]\-]", "")


def plausible_udc(s: Column) -> Column:
    return F.length(F.regexp_replace(udc_form(s), "[^0-9]", "")) >= 3


def plausible_bbk(s: Column) -> Column:
    form = bbk_form(s)
    return (F.length(F.regexp_replace(form, "[^0-9]", "")) >= 2) & F.length(form).between(3, 25)


def places(text: Column, label: str, width: int) -> Column:
    """Positions (from 0) of a label of fixed width, from the lengths of the pieces between its occurrences."""

    def found(pieces: Column) -> Column:
        before = running_before(F.transform(pieces, F.length))
        return F.transform(F.slice(before, 2, F.size(before)), lambda at, i: (at + i * width).cast("int"))

    return F.when(F.contains(text, F.lit(label)) if label.isalpha() else text.rlike(label), let(F.split(text, label, -1), found)).otherwise(F.array().cast("array<int>"))


HIT = "array<struct<value:string,context:string,pos_from_start:int,pos_from_end:int,source_tag:string>>"


def _hits(text: Column, label: str, width: int, find, tag: str, context: int) -> Column:
    """find(window) gives (value, characters used, fine) for the text right after the label."""

    def hit(at: Column) -> Column:
        found = find(F.substr(text, at + width + 1, F.lit(160)))

        def made(f: Column) -> Column:
            left = F.greatest(F.lit(0), at - context)
            right = F.least(F.length(text), at + width + f["used"] + context)
            around = strip(squeeze(F.substr(text, left + 1, right - left)))
            return F.when(f["fine"], F.struct(f["value"].alias("value"), around.alias("context"), at.alias("pos_from_start"), (F.length(text) - at).alias("pos_from_end"), F.lit(tag).alias("source_tag")))

        return let(found, made)

    found = F.filter(F.transform(places(text, label, width), hit), lambda h: h.isNotNull())
    return F.when(text.rlike(label), found).otherwise(F.array().cast(HIT))


def udc_hits(text: Column, context: int) -> Column:
    """Codes after the label; those after the label with a colon, full stop or hyphen only if there are none."""

    def find(window: Column) -> Column:
        raw = F.regexp_extract(F.substring(window, 1, UDC_WINDOW), UDC_BLOCK, 1)
        value = normalize_block(raw)
        return F.struct(value.alias("value"), F.length(raw).alias("used"), ((value != "") & plausible_udc(value)).alias("fine"))

    first = _hits(text, UDC_LABEL, 3, find, "exact", context)
    return let(first, lambda h: F.when(F.size(h) > 0, h).otherwise(_hits(text, UDC_LABEL_MARKED, 4, find, "group1", context)))


def bbk_hits(text: Column, context: int) -> Column:
    def find(window: Column) -> Column:
        part = F.split(F.split(window, BBK_STOP, 2)[0], BBK_SENTENCE, 2)[0]
        value = normalize_block(F.regexp_extract(part, f"({BBK_VALUE})", 1))
        return F.struct(value.alias("value"), F.length(part).alias("used"), ((value != "") & plausible_bbk(value)).alias("fine"))

    return _hits(text, BBK_LABEL, 3, find, "exact", context)


def accepted(hits: Column, config: ManifestConfig = ManifestConfig()) -> Column:  # noqa: B008
    """(value, zone, selected): of the first early hits, or else of the first late ones, the most frequent value; the earlier one of a tie."""

    def made(h: Column) -> Column:
        pick = lambda f: F.slice(F.filter(h, f), 1, config.max_codes)
        early, late = pick(lambda x: x["pos_from_start"] <= config.early_limit), pick(lambda x: x["pos_from_start"] > config.early_limit)

        def best(sel: Column) -> Column:
            count = lambda v: F.size(F.filter(sel, lambda y: y["value"] == v))
            top = F.array_max(F.transform(sel, lambda x: F.struct(count(x["value"]).alias("n"), (-x["pos_from_start"]).alias("p"), x["value"].alias("v"))))
            return F.struct(F.coalesce(top["v"], F.lit("")).alias("value"), F.when(F.size(sel) == 0, "not_found").when(F.size(early) > 0, "early").otherwise("late").alias("zone"), sel.alias("selected"))

        return let(F.when(F.size(early) > 0, early).otherwise(late), best)

    return let(hits, made)


def text_year(text: Column, head_chars: int) -> Column:
    """The best year of the text's beginning as text; empty if there is none.

    Years score by closeness to the start, by markers beside them and by publishing words around; of equal scores the
    earlier wins.
    """
    head = F.substring(text, 1, head_chars)

    def best(pieces: Column) -> Column:
        spots = F.transform(running_before(F.transform(pieces, F.length)), lambda n: n.cast("int"))

        def scored(at: Column) -> Column:
            cut = lambda a, b: F.substr(head, F.greatest(a, F.lit(0)) + 1, b - F.greatest(a, F.lit(0)))
            score = F.greatest(F.lit(0), 2000 - at) / F.lit(2000.0) + F.when(cut(at + 4, at + 16).rlike(YEAR_AFTER), 3.0).otherwise(0.0) + F.when(cut(at - 12, at).rlike(YEAR_BEFORE), 1.5).otherwise(0.0) + F.when(cut(at - 40, at + 44).rlike(PUBLISHING), 0.7).otherwise(0.0)
            return F.struct(score.alias("score"), (-at).alias("p"), cut(at, at + 4).alias("year"))

        years = F.filter(F.transform(spots, scored), lambda x: x["year"].rlike(f"^{YEAR}$"))
        return F.coalesce(F.array_max(years)["year"], F.lit(""))

    # pieces begin where a year begins, so their lengths give its places
    return F.when(head.rlike(YEAR), let(F.split(head, f"(?={YEAR})", -1), best)).otherwise("")


def valid_year(y: Column) -> Column:
    return F.coalesce(y.rlike(r"^\p{Nd}{4}$") & (y != "1111"), F.lit(False))


def merged_year(name_year: Column, found: Column) -> Column:
    """The name's year if it is one, else the text's, else the name's as it is."""
    return F.when(valid_year(name_year), name_year).when(valid_year(found), found).otherwise(name_year)


@F.pandas_udf(T.DoubleType())
def mean_similarity(groups: pd.Series) -> pd.Series:
    """Of each list of compare forms the mean matching-blocks ratio of its pairs; 1 for one, 0 for none. (No built-in function measures this.)"""
    from difflib import SequenceMatcher

    def one(values) -> float:
        values = list(values) if values is not None else []
        if len(values) < 2:
            return float(len(values))
        pairs = [SequenceMatcher(None, a, b).ratio() if a and b else 0.0 for a, b in combinations(values, 2)]
        return sum(pairs) / len(pairs)

    return groups.map(one).astype(float)


def weight(choice: Column, form, early_base: float = 0.85, late_base: float = 0.45) -> Column:
    """How sure an accepted code is: its zone's base, likeness of the selected values, share of the chosen one."""
    sel = choice["selected"]
    forms = F.transform(sel, lambda x: form(x["value"]))
    share = F.size(F.filter(sel, lambda x: x["value"] == choice["value"])) / F.size(sel)
    base = F.when(choice["zone"] == "early", early_base).otherwise(late_base)
    return F.when(F.size(sel) > 0, F.bround(F.least(F.lit(1.0), base + 0.10 * mean_similarity(forms) + 0.05 * share), 3)).otherwise(0.0)


def code_columns(df: DataFrame, text: str = "text", config: ManifestConfig = ManifestConfig()) -> DataFrame:  # noqa: B008
    """df with udc, udc_zone, udc_status, udc_hits, bbk, bbk_zone, bbk_status, bbk_hits and text_year.

    A null text is a read error: codes are empty and the status says so.
    """
    unread = F.col(text).isNull()
    body = F.coalesce(F.col(text), F.lit(""))
    out = df.withColumns({"udc_hits": udc_hits(body, config.context_chars), "bbk_hits": bbk_hits(body, config.context_chars), "text_year": text_year(body, config.year_head_chars)})
    out = out.withColumns({"_udc": accepted(F.col("udc_hits"), config), "_bbk": accepted(F.col("bbk_hits"), config)})
    status = lambda c: F.when(unread, "read_error").when(F.col(f"_{c}.value") == "", "not_found").when(F.get(f"{c}_hits", 0)["source_tag"] == "group1", "found_group1").otherwise("ok")
    return out.withColumns({f"{c}{k}": v for c in ("udc", "bbk") for k, v in (("", F.col(f"_{c}.value")), ("_zone", F.col(f"_{c}.zone")), ("_status", status(c)))}).drop("_udc", "_bbk")
