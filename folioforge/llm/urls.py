"""URL filters: pattern rules behind a token index, with DataFrame functions only.

Every rule is a regular expression over host and path, filed under one literal token that any URL it fits must have:
the rarest one in the table at hand. A URL's tokens fetch candidate rules and only those run. Up to LITERAL rules are
part of the expression, so there is no shuffle; more are joined by token.

Site rules name a host and a path prefix; they fit the host and its subdomains. Of those that fit the longest wins.
Where none fits, the method's own spam patterns decide: block if one fits, else allow. URLs that are null or have no
`://` have an empty host and path and are allowed. Repeated rows are judged alike, a null id stays null.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules that may stand in an expression.
LITERAL = 500
#: Words that mark a spam host when they stand between dots or hyphens.
SPAM_WORDS = ["ads", "adserver", "bets", "betting", "casino", "cialis", "clickbait", "gambling", "lottery", "malware", "phishing", "pills", "poker", "porn", "spam", "tracker", "viagra", "warez", "xxx"]


@dataclass(frozen=True)
class Rule:
    rule: str | None  # shown in the result; None: a pattern of the method
    verdict: str
    pattern: str  # over host and path
    tokens: tuple[str, ...]  # literal tokens, all of which a fitting URL has
    weight: int  # of rules that fit the heaviest wins


def site_rule(verdict: str, site: str) -> Rule:
    """`block example.com/de/`: that host, its subdomains and paths that start so."""
    host, slash, path = site.partition("/")
    pattern = rf"^(?:[^/?#]*\.)?{re.escape(host)}{re.escape(slash + path)}"
    # the last bit of a path needn't be a whole token
    tokens = re.findall("[a-z0-9]+", host) + re.findall("[A-Za-z0-9]+", (slash + path).rpartition("/")[0])
    return Rule(site, verdict, pattern, tuple(t.lower() for t in tokens), 1 + len(site))


def spam_rules() -> list[Rule]:
    return [Rule(None, "block", rf"^(?:[^/]*[.-])?{w}(?:[.-]|$|/)", (w,), 0) for w in SPAM_WORDS]


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), upper, lower), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def tokens(host: Column, path: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(F.concat(host, F.lit("/"), path)), "[^a-z0-9]+"), lambda t: t != ""))


def filed(urls: DataFrame, rules: list[Rule]) -> list[tuple[str, Rule]]:
    """Each rule with its rarest token in `urls` (columns host, path)."""
    words = sorted({t for r in rules for t in r.tokens})
    if not words:
        return []
    seen = urls.select(F.explode(F.array_intersect(tokens(F.col("host"), F.col("path")), F.array(*map(F.lit, words)))).alias("token")).groupBy("token").count()
    count = {r["token"]: r["count"] for r in seen.collect()}  # at most one row for each word of the rules
    return [(min(r.tokens, key=lambda t: (count.get(t, 0), t)), r) for r in rules]


def judge(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """All columns of pages and host, path, rule and verdict."""
    if {"host", "path", "rule", "verdict"} & set(pages.columns):
        raise ValueError("pages already has a column host, path, rule or verdict")
    host, path = host_and_path(F.col(url))
    rows = pages.withColumn("host", host).withColumn("path", path)
    index = filed(rows.select("host", "path"), rules)
    fields = "struct<weight:int,rule:string,verdict:string,pattern:string>"
    target = F.concat("host", "path")
    if not index:
        return rows.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit("allow"))
    if len(index) <= LITERAL:
        by_token: dict[str, list[Rule]] = {}
        for token, r in index:
            by_token.setdefault(token, []).append(r)
        as_struct = lambda r: F.struct(F.lit(r.weight), F.lit(r.rule).cast("string"), F.lit(r.verdict), F.lit(r.pattern)).cast(fields)
        table = F.create_map(*[x for t, own in by_token.items() for x in (F.lit(t), F.array(*map(as_struct, own)))])
        known = F.array_intersect(tokens(F.col("host"), F.col("path")), F.array(*map(F.lit, by_token)))
        candidates = F.flatten(F.transform(known, lambda t: F.element_at(table, t)))
        best = F.array_max(F.filter(candidates, lambda c: F.regexp_like(target, c["pattern"])))
        return rows.withColumn("best", best).select(*rows.columns, F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit("allow")).alias("verdict"))
    spark = pages.sparkSession
    table = spark.createDataFrame([(t, r.weight, r.rule, r.verdict, r.pattern) for t, r in index], "token string, weight int, rule string, verdict string, pattern string")
    sites = rows.select("host", "path").distinct()
    hits = sites.withColumn("token", F.explode(tokens(F.col("host"), F.col("path")))).join(table, "token").where(F.regexp_like(target, F.col("pattern")))
    best = hits.groupBy("host", "path").agg(F.max(F.struct("weight", "rule", "verdict")).alias("best"))
    return rows.join(best, ["host", "path"], "left").select(*rows.columns, F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit("allow")).alias("verdict"))
