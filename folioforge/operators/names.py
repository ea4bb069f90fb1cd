"""Year, authors and title from file names.

Rules are data: a pattern over the name or the title, what its groups become, and the mode that reports it. A cascade
tries them in order; each step is one projection over a small struct, so Catalyst keeps every regular expression once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.charclass import NOT_AFTER, NOT_BEFORE, SPACE, strip

S = f"[{SPACE}]"
#: Capitals, letters, and what is cut off the edges of names.
CAPITAL = "[A-ZА-ЯЁ]"
LETTER = "[A-Za-zА-Яа-яЁё]"
EDGE = " ,;:-"
#: Patterns of years, of unknown years and of empty parentheses.
YEAR = r"(?:1[5-9]\p{Nd}{2}|20[0-2]\p{Nd}|2030)"
UNKNOWN_YEAR = rf"(?iu)\(?{S}*год{S}+неизв\.?{S}*\)?"
EMPTY_PARENS = rf"\({S}*\)"
#: File kinds that end a name, and sizes in parentheses.
KINDS = "djvu|pdf|ocr|txt|scan"
#: Beginnings that say that there is no author, markers of editors, and prefixes that stand for an author.
NO_AUTHOR = rf"(?siu)^{S}*(Без{S}+авт\.?|Сборник\.?|Много{S}+авт\.?|Коллектив{S}+авторов\.?){S}*(.*)$"
MARKER = rf"(?siu)^{S}*(\({S}*ред\.?{S}*\)|\({S}*под{S}+ред\.?{S}*\)|\({S}*отв\.{S}*ред\.?{S}*\)|\({S}*ркд{S}*\)|\({S}*сост\.?{S}*\)|и{S}+др\.?){S}*[-\u2013\u2014]?{S}*(.*)$"
PREFIX = rf"(?siu)^{S}*(Альманах\.|Журнал\.|Интернет-журнал\.|Конспекты{S}+лекций\.|Серия\.{S}*Наука\.|Landau_){S}*(.*)$"
UNDERSCORE = rf"(?s)^{S}*({LETTER}{{1,12}}_){S}*(.*)$"
HYPHEN = rf"(?s)^{S}*({LETTER}{{1,12}}(?:{S}+{LETTER}{{1,12}}){{0,2}}){S}-{S}+(.*)$"
DJ = rf"(?s)^{S}*({LETTER}{{1,12}}{S}+Дж\.){S}+(.*)$"
SURNAME = rf"(?s)^{S}*({LETTER}{{1,12}}){S}*[-\u2013\u2014]{S}*(.*)$"
TAIL = rf"(?siu)^(.*?(?:и{S}+др\.?|\({S}*ред{S}*\)))(?:{S}+|[-\u2013\u2014]{S}*)(.+)$"
INITIAL = rf"{CAPITAL}\."
#: The last pair of initials that scanning from the left finds: pairs don't overlap, so a third initial isn't in one.
LAST_PAIR = rf"(?s)^((?:(?:(?!(?:{INITIAL}){{2}}).)*+(?:{INITIAL}){{2}})+)(.*)$"


def tidy(s: Column) -> Column:
    return F.trim(strip(F.regexp_replace(s, f"{S}{{2,}}", " ")))


def trim_edge(s: Column) -> Column:
    return F.regexp_replace(s, f"^[{EDGE}]+|[{EDGE}]+$", "")


def without_empty_parens(s: Column) -> Column:
    """Without pairs of parentheses that hold nothing but white space and such pairs, at any depth.

    Characters go onto a stack of text one by one; a closing one takes its opening one and the space between away.
    """
    opened = rf"\({S}*$"
    put = lambda done, c: F.when((c == ")") & done.rlike(opened), F.regexp_replace(done, opened, "")).otherwise(F.concat(done, c))
    return F.when(s.rlike(EMPTY_PARENS), F.aggregate(F.split(s, ""), F.lit(""), put)).otherwise(s)


def cleanup(s: Column) -> Column:
    """A name without sizes, file kinds and empty parentheses, with tidy spaces, cut at its edges."""
    s = F.regexp_replace(s, rf"(?iu)\({S}*\p{{Nd}}+(?:[.,]\p{{Nd}}+)?{S}*(?:kb|mb|gb){S}*\)", "")
    s = F.regexp_replace(s, rf"(?iu)\({S}*(?:{KINDS}){S}*\)", "")
    s = F.regexp_replace(s, rf"(?iu)[{SPACE}._\-()]*{NOT_AFTER}(?:{KINDS}){NOT_BEFORE}[{SPACE}._\-()]*$", "")
    s = F.regexp_replace(without_empty_parens(s), f"{S}{{2,}}", " ")
    s = F.regexp_replace(s, f"{S}+([.,;:])", "$1")
    return F.regexp_replace(s, r"^[ \-_,;:()\[\]]+|[ \-_,;:()\[\]]+$", "")


def year_and_rest(name: Column) -> tuple[Column, Column]:
    """The last year that scanning from the left finds (1111: said to be unknown; null: none), and the name without it."""
    scan = rf"(?s)^((?:(?:(?!{YEAR}).)*+{YEAR})*)((?:(?!{YEAR}).)*+)({YEAR})((?:(?!{YEAR}).)*+)$"
    part = lambda i: F.regexp_extract(name, scan, i)
    unknown = name.rlike(UNKNOWN_YEAR) | name.rlike(EMPTY_PARENS)
    year = F.when(name.rlike(YEAR), part(3)).when(unknown, "1111")
    rest = F.when(name.rlike(YEAR), cleanup(F.concat(part(1), part(2), part(4)))).when(unknown, cleanup(without_empty_parens(F.regexp_replace(name, UNKNOWN_YEAR, "")))).otherwise(cleanup(name))
    return year, rest


class Cascade:
    """State of the rules over a DataFrame: columns _s (the whole name), _a (authors), _t (title), _mode (null while open)."""

    def __init__(self, df: DataFrame, name: Column) -> None:
        self.df = df.withColumn("_s", F.coalesce(strip(name), F.lit(""))).withColumns({"_a": F.lit(""), "_t": F.lit(""), "_mode": F.lit(None).cast("string"), "_pending": F.lit(None).cast("string")})

    def apply(self, when: Column, authors: Column, title: Column, mode: str | None = None, pending: str | None = None) -> None:
        """Where `when` holds sets authors and title; `mode` closes the cascade, `pending` is the mode if no later rule does."""
        hit = F.coalesce(when & F.col("_mode").isNull(), F.lit(False))
        self.df = self.df.withColumn("_new", F.when(hit, F.struct(authors.alias("a"), title.alias("t"))))
        hit = F.col("_new").isNotNull()
        out = {"_a": F.coalesce("_new.a", "_a"), "_t": F.coalesce("_new.t", "_t")}
        if mode:
            out["_mode"] = F.when(hit, mode).otherwise(F.col("_mode"))
        if pending:
            out["_pending"] = F.when(hit, pending).otherwise(F.col("_pending"))
        self.df = self.df.withColumns(out)

    def move(self, source: str, pattern: str, when: Column, pending: str | None = None, append: bool = False) -> None:
        """Group 1 of the pattern over `source` becomes the authors (or is added to them), group 2 the title."""
        head, rest = strip(F.regexp_extract(source, pattern, 1)), strip(F.regexp_extract(source, pattern, 2))
        authors = F.when(F.col("_a") != "", F.concat_ws(" ", "_a", head)).otherwise(head) if append else head
        self.apply(when & F.col(source).rlike(pattern), tidy(authors), trim_edge(F.regexp_replace(rest, f"{S}{{2,}}", " ")), pending=pending)

    def tail(self, when: Column) -> None:
        """Three rules that give what stands behind the authors back to the title; the first that applies closes."""
        a, t = strip(F.col("_a")), strip(F.col("_t"))
        tail = strip(F.regexp_extract(a, TAIL, 2))
        self.apply(when & (F.length(a) > 10) & a.rlike(TAIL) & (tail != ""), tidy(F.regexp_extract(a, TAIL, 1)), trim_edge(F.regexp_replace(F.when(F.col("_t") != "", strip(F.concat_ws(" ", tail, "_t"))).otherwise(tail), f"{S}{{2,}}", " ")), "author_tail_after_marker_to_title")
        head, rest = trim_edge(F.regexp_extract(a, LAST_PAIR, 1)), trim_edge(F.regexp_extract(a, LAST_PAIR, 2))
        pair = when & (a != "") & a.rlike(LAST_PAIR) & (rest != "")
        self.apply(pair & (t != "") & (F.length(a) > F.length(t)) & a.rlike(rf"{INITIAL}{S}*$"), trim_edge(F.regexp_replace(head, f"{S}{{2,}}", " ")), trim_edge(F.regexp_replace(strip(F.concat_ws(" ", rest, t)), f"{S}{{2,}}", " ")), "fix_title_tail_after_double_initials")
        self.apply(pair & (t == ""), tidy(head), tidy(rest), "move_right_sentence_from_authors_to_title_if_title_empty")


def authors_and_title(df: DataFrame, name: Column) -> DataFrame:
    """df with authors, title and parse_mode, from a name without its year."""
    c = Cascade(df, name)
    named, initials = F.col("_s").rlike(NO_AUTHOR), F.col("_s").rlike(INITIAL)
    c.df = c.df.withColumn("_branch", F.when(named, "none").when(~initials, "plain").otherwise("initials"))
    in_none, plain, with_initials = (F.col("_branch") == b for b in ("none", "plain", "initials"))
    split = rf"(?s)^(.*{INITIAL})(.*)$"
    c.apply(in_none, strip(F.regexp_extract("_s", NO_AUTHOR, 1)), strip(F.regexp_extract("_s", NO_AUTHOR, 2)), pending="noauthor_prefix")
    c.apply(plain, F.lit(""), F.col("_s"), pending="no_initials")
    c.apply(with_initials, trim_edge(F.regexp_extract("_s", split, 1)), trim_edge(F.regexp_extract("_s", split, 2)), pending="initials_from_right")
    c.move("_t", MARKER, F.lit(True), append=True)
    free = F.col("_a") == ""
    c.move("_s", PREFIX, (plain | with_initials) & free)
    c.apply(plain & (F.col("_a") != ""), F.col("_a"), F.col("_t"), pending="empty_author_prefix")
    for pattern, mode in ((UNDERSCORE, "underscore_leading_word"), (HYPHEN, "hyphen_leading_author"), (DJ, "dj_initial_author")):
        c.move("_t", pattern, plain & free, pending=mode)
    surname, rest = strip(F.regexp_extract("_t", SURNAME, 1)), strip(F.regexp_extract("_t", SURNAME, 2))
    pair = (F.length(strip(F.col("_a"))) < 5) & strip(F.col("_a")).rlike(rf"^{INITIAL}{INITIAL}$")
    c.apply(with_initials & pair & F.col("_t").rlike(SURNAME), tidy(F.concat_ws(" ", surname, "_a")), trim_edge(F.regexp_replace(rest, f"{S}{{2,}}", " ")), pending="initials_plus_hyphen_surname")
    c.tail(F.col("_pending") != "no_initials")
    return c.df.withColumns({"authors": F.col("_a"), "title": F.col("_t"), "parse_mode": F.coalesce("_mode", "_pending")}).drop("_s", "_a", "_t", "_mode", "_pending", "_branch", "_new")


def parse_names(df: DataFrame, name: str = "name") -> DataFrame:
    """df with year, authors, title and parse_mode of a file name without its extension."""
    year, rest = year_and_rest(F.coalesce(F.col(name), F.lit("")))
    return authors_and_title(df.withColumns({"year": year, "_rest": rest}), F.col("_rest")).drop("_rest")
