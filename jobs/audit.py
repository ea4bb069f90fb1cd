"""Audit of a corpus: a ledger of cleaned pages and a report for each source, with a verdict on its quality.

    python -m jobs.audit --documents /data/texts --out /data/audit --config jobs/audit.json

Texts are cut into pages, measured, cleaned and counted in one pass, which writes out/pages (Parquet, partitioned by
source). The reports are an aggregate over that ledger and replace out/report (JSON, partitioned by source): pages by
class, characters before and after cleaning, lines by decision and by reason of removal, tokens of table pages, pages
whose text stands elsewhere in the corpus, and whether the share of junk is within `max_junk_share`.

`sources` limits a run to some sources (none: all); only their partitions of the ledger are replaced, and all reports
are drawn anew, as duplicates cross sources. A run over the same input gives the same tables.

Defined cases: a null source is `unknown`; a null text is empty and has no page; sources that are no longer in the
input keep their pages. Extra columns are ignored. An empty input leaves the ledger as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from folioforge.config import PagesConfig
from folioforge.operators import cleaning, identity, pages, quality

from .common import as_files, existing, log, main, replace_partitions

ACTIONS = ("keep", "normalize", "drop")
COUNTS = {
    **{f"lines_{a}": "bigint" for a in ACTIONS}, **{f"drop_{r}": "bigint" for r in cleaning.REASONS}, "tab_tokens_seen": "bigint", "tab_tokens_kept": "bigint",
}
LEDGER = "chunk_id string, doc_id string, txt_rel string, page_start int, quality_class string, junk_score int, clean_mode string, chars_before int, chars_after int, text_sha1 string, clean_text string, " + ", ".join(f"{k} {t}" for k, t in COUNTS.items()) + ", source string"


def counted() -> dict[str, Column]:
    """Per page: lines by decision and by reason of removal, and the tokens of table pages."""
    some = lambda field, value: F.coalesce(F.size(F.filter("decisions", lambda d: d[field] == value)), F.lit(0))
    out = {f"lines_{a}": some("action", a) for a in ACTIONS} | {f"drop_{r}": some("reason", r) for r in cleaning.REASONS}
    out |= {f"tab_{c}": F.coalesce(F.col(f"tab.{c}"), F.lit(0)) for c in ("tokens_seen", "tokens_kept")}
    return {k: v.cast("bigint") for k, v in out.items()}


def ledger(files: DataFrame, config: dict) -> DataFrame:
    """Rows of LEDGER from files with a source column. No shuffle."""
    rows = files.withColumns({"doc_id": identity.doc_id(F.col("txt_rel")), "sid": identity.doc_id(F.col("txt_rel")), "topic": F.col("source")})
    found = pages.chunk_pages(rows, PagesConfig(config.get("min_chars", 20)))
    made = cleaning.clean_all(quality.analyze(found)).withColumns(counted())
    return made.select("chunk_id", "doc_id", "txt_rel", "page_start", "quality_class", "junk_score", "clean_mode", F.col("text_before_clean_len").alias("chars_before"), F.col("text_after_clean_len").alias("chars_after"), F.sha1(F.col("text").cast("binary")).alias("text_sha1"), "clean_text", *COUNTS, F.col("topic").alias("source"))


def reports(rows: DataFrame, most: float) -> DataFrame:
    """One row per source over the ledger. Equal pages are counted by source and hash first, so a page that many have is combined before the shuffle."""
    total = lambda c: F.sum(c).cast("bigint")
    classes = {k: F.count_if(F.col("quality_class") == k) for k in ("ok", "suspicious", "junk_candidate")}
    sums = rows.groupBy("source").agg(
        F.count("*").alias("pages"), F.count_if(F.col("chars_after") == 0).alias("pages_emptied"), *[v.alias(f"pages_{k}") for k, v in classes.items()], F.count_if(F.col("clean_mode") == "tab").alias("pages_tab"),
        *[total(c).alias(c) for c in ("chars_before", "chars_after", *COUNTS)],
    )
    by_source = rows.groupBy("source", "text_sha1").agg(F.count("*").alias("n"))
    copies = by_source.groupBy("text_sha1").agg(F.sum("n").alias("copies"))
    doubles = by_source.join(copies.where("copies > 1"), "text_sha1").groupBy("source").agg(total("n").alias("pages_doubled"))
    share = F.bround(F.col("pages_junk_candidate") / F.col("pages"), 6)
    return sums.join(doubles, "source", "left").fillna(0, ["pages_doubled"]).withColumns({"junk_share": share, "passed": share <= most})


REPORT = "pages bigint, pages_emptied bigint, pages_ok bigint, pages_suspicious bigint, pages_junk_candidate bigint, pages_tab bigint, chars_before bigint, chars_after bigint, " + ", ".join(f"{k} {t}" for k, t in COUNTS.items()) + ", pages_doubled bigint, junk_share double, passed boolean, source string"


def audit(spark: SparkSession, documents: str, out: str, config: dict) -> dict:
    """Rebuilds the ledger of the chosen sources and all reports; returns what was read and written."""
    docs = spark.read.parquet(documents).withColumn("source", F.coalesce(F.expr(config.get("source", "source")).cast("string"), F.lit("unknown")))
    if config.get("sources"):
        docs = docs.where(F.col("source").isin(config["sources"]))
    read, made = Observation(), Observation()
    files = as_files(docs, config["path"]).select("txt_rel", "txt_abs", "size_bytes", "text", "source")
    files = files.observe(read, F.count(F.lit(1)).alias("texts_read"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes_read"))
    rows = ledger(files, config).observe(made, F.count(F.lit(1)).alias("pages_written"), F.coalesce(F.sum("chars_after"), F.lit(0)).alias("chars_written"))
    replace_partitions(rows, f"{out}/pages", "source")
    found = reports(existing(spark, f"{out}/pages", LEDGER), config.get("max_junk_share", 1.0))
    replace_partitions(found, f"{out}/report", "source", form="json")
    written = spark.read.schema(REPORT).json(f"{out}/report")
    result = {**read.get, **made.get, **written.agg(F.count("*").alias("sources"), F.count_if(~F.col("passed")).alias("sources_failed")).first().asDict()}
    log.info("audit: %s", result)
    return result


if __name__ == "__main__":
    main("audit", audit, ["documents", "out"])
