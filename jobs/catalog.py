"""The jobs as registered queries over the whole documents table, and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators.cleaning import REASONS
from folioforge.plans import oracles as sql

from .audit import LEDGER, REPORT, audit
from .common import new_folder
from .ingest import ingest, latest

#: Documents as files of a library: source kind and table folders by id.
PATH = "concat('OCR_TXT/', CASE doc_id % 3 WHEN 0 THEN 'pdf_OCR_TXT' WHEN 1 THEN 'djvu_OCR_TXT' ELSE 'misc' END, CASE WHEN doc_id % 7 = 0 THEN '/tab' ELSE '' END, '/doc', doc_id, '.txt')"


def job1_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks as they stand after two runs; the second finds nothing new."""
    at = new_folder(spark, "ingest")
    for _ in range(2):
        ingest(spark, f"{sf_dir}/documents.parquet", f"{at}/out", f"{at}/checkpoint", {"path": PATH})
    return latest(spark, f"{at}/out").withColumn("page_start", F.col("page_start").cast("bigint"))


def job2_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger and each source's report after two runs."""
    at = new_folder(spark, "audit")
    for _ in range(2):
        audit(spark, f"{sf_dir}/documents.parquet", at, {"path": PATH, "max_junk_share": 0.05})
    report = spark.read.schema(REPORT).json(f"{at}/report")
    pages = spark.read.schema(LEDGER).parquet(f"{at}/pages").withColumn("clean_sha1", F.sha1(F.col("clean_text").cast("binary"))).drop("clean_text")
    whole = pages.join(report.select(*[F.col(c).alias(c if c == "source" else f"source_{c}") for c in report.columns]), "source")
    return whole.select(*[F.col(c).cast("bigint").alias(c) if t == "int" else F.col(c) for c, t in whole.dtypes])


def _audited() -> str:
    """Pages with their decisions counted, and the sums of each source beside them."""
    whole = f"whole AS (SELECT doc_id, {sql.text_of_page('text')} AS text FROM docs), source AS (SELECT * FROM whole WHERE length(text) >= 20)"
    lines = ["keep", "normalize", "drop"]
    counts = ", ".join([f"count(*) FILTER (action = '{a}') AS lines_{a}" for a in lines] + [f"count(*) FILTER (reason = '{r}') AS drop_{r}" for r in REASONS])
    names = [*(f"lines_{a}" for a in lines), *(f"drop_{r}" for r in REASONS)]
    page = ", ".join(f"coalesce(n.{c}, 0) AS {c}" for c in names)
    sums = [*names, "tab_tokens_seen", "tab_tokens_kept"]
    classes = ", ".join(f"count(*) FILTER (quality_class = '{k}') AS source_pages_{k}" for k in ("ok", "suspicious", "junk_candidate"))
    return sql.with_(
        sql.DOCS, sql.FILES, whole, sql.lines("source"), sql.metrics("source"), sql.tab_clean("source"), sql.decided("source"), f"n AS (SELECT doc_id, {counts} FROM decisions_source GROUP BY 1)",
        f"""ledger AS (SELECT printf('%s::p%05d', substr(sha1(f.txt_rel), 1, 16), 1) AS chunk_id, substr(sha1(f.txt_rel), 1, 16) AS doc_id, f.txt_rel, 1::BIGINT AS page_start, p.quality_class, p.junk_score::BIGINT AS junk_score, c.clean_mode, length(c.before) AS chars_before, length(c.after) AS chars_after, sha1(c.before) AS text_sha1, sha1(c.after) AS clean_sha1,
  {page}, CASE WHEN c.clean_mode = 'tab' THEN t.tokens_seen ELSE 0 END AS tab_tokens_seen, CASE WHEN c.clean_mode = 'tab' THEN t.tokens_kept ELSE 0 END AS tab_tokens_kept, d.source
  FROM cleaned_source c JOIN files f ON c.doc_id = f.id JOIN pages_source p ON c.doc_id = p.doc_id JOIN tab_source t ON c.doc_id = t.doc_id LEFT JOIN n ON c.doc_id = n.doc_id JOIN documents d ON d.doc_id = c.doc_id)""",
        "doubled AS (SELECT *, count(*) OVER (PARTITION BY text_sha1) AS copies FROM ledger)",
        f"""report AS (SELECT source, count(*) AS source_pages, count(*) FILTER (chars_after = 0) AS source_pages_emptied, {classes}, count(*) FILTER (clean_mode = 'tab') AS source_pages_tab, {', '.join(f'sum({c})::BIGINT AS source_{c}' for c in ('chars_before', 'chars_after', *sums))},
  count(*) FILTER (copies > 1) AS source_pages_doubled, round_even(count(*) FILTER (quality_class = 'junk_candidate') / count(*), 6) AS source_junk_share, round_even(count(*) FILTER (quality_class = 'junk_candidate') / count(*), 6) <= 0.05 AS source_passed FROM doubled GROUP BY 1)""",
    ) + "SELECT ledger.*, report.* EXCLUDE (source) FROM ledger JOIN report USING (source)"


QUERIES = {"job1_ingest": job1_ingest, "job2_audit": job2_audit}
_chunks = sql.ORACLES["pipeline_end_to_end"]
ORACLES = {
    "job1_ingest": f"SELECT *, CASE WHEN contains(txt_rel, 'pdf_OCR_TXT') THEN 'pdf' WHEN contains(txt_rel, 'djvu_OCR_TXT') THEN 'djvu' END AS src_kind, 0::BIGINT AS batch FROM ({_chunks})",
    "job2_audit": _audited(),
}
