"""The jobs: two runs over growing input, reruns, changed texts, their queries against SQL, odd inputs, the command line."""

import json
import logging

import duckdb
import pytest
from pyspark.sql import functions as F

from folioforge.plans import manifest, pipeline
from jobs import catalog
from jobs.audit import LEDGER, REPORT, audit
from jobs.common import as_files
from jobs.ingest import ingest, latest, versions

DIR = "/root/testdata/sf0.001"
CONFIG = {"path": catalog.PATH}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_matches_sql(spark, name):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    df = catalog.QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    ours = [tuple(r) for r in df.select(*columns).collect()]
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{DIR}/documents.parquet'")
    theirs = c.execute("SELECT " + ", ".join(f'"{x}"' for x in columns) + f" FROM ({catalog.ORACLES[name]})").fetchall()
    assert ours and sorted(ours, key=str) == sorted(theirs, key=str)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def whole(spark, documents):
    """The chunks that all stages give of a table at once."""
    rows = manifest.build(as_files(documents, catalog.PATH).select("txt_rel", "txt_abs", "size_bytes", "text"))
    return sorted(tuple(r) for r in pipeline.chunks(rows).collect())


def chunks(spark, out):
    return sorted(tuple(r) for r in latest(spark, out).drop("src_kind", "batch").select("chunk_id", "doc_id", "text", "page_start", "year", "txt_rel").collect())


def test_ingest_takes_what_is_new(spark, tmp_path, caplog):
    """A second drop of files: new texts, unchanged ones, one changed, one emptied, one twice with different texts, a null."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    at, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    first = docs.where("doc_id < 60")
    first.repartition(3).write.parquet(at)
    with caplog.at_level(logging.INFO, "folioforge.jobs"):
        assert [r["texts_read"] for r in ingest(spark, at, out, mark, CONFIG)] == [60]
    assert "texts_read" in caplog.text and "chunks_written" in caplog.text
    assert chunks(spark, out) == whole(spark, first)
    files = {p.name for p in tmp_path.glob("out/chunks/*/*/*.parquet")}
    new_text = F.when(F.col("doc_id") == 5, "a changed text that is long enough. " * 30).when(F.col("doc_id") == 6, F.lit(None)).otherwise(F.col("text"))
    second = docs.where("doc_id >= 50 or doc_id in (5, 6)").withColumn("text", new_text)
    second.write.mode("append").parquet(at)
    docs.where("doc_id = 70").withColumn("text", F.lit("another text of that path, also long enough")).write.mode("append").parquet(at)
    (run,) = ingest(spark, at, out, mark, CONFIG)
    total = docs.count()
    assert run["texts_read"] == total - 50 + 3 and run["texts_written"] == total - 60 + 2
    both = second.where("doc_id = 70").select("text").first()[0], "another text of that path, also long enough"
    import hashlib

    kept = min(both, key=lambda t: hashlib.sha1(t.encode()).hexdigest())
    now = docs.withColumn("text", new_text).withColumn("text", F.when(F.col("doc_id") == 70, kept).otherwise(F.col("text")))
    assert chunks(spark, out) == whole(spark, now)
    assert files < {p.name for p in tmp_path.glob("out/chunks/*/*/*.parquet")}  # the first batch's files weren't touched
    assert ingest(spark, at, out, mark, CONFIG) == [] and chunks(spark, out) == whole(spark, now)


def test_ingest_of_one_file_at_a_time(spark, tmp_path):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    docs.repartition(2).write.parquet(str(tmp_path / "in"))
    runs = ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark"), CONFIG | {"files_per_batch": 1})
    assert len(runs) == 2 and chunks(spark, str(tmp_path / "out")) == whole(spark, docs)


def test_batch_that_runs_again(spark, tmp_path):
    """A lost mark: all files come again, in a batch of the same number as before; nothing doubles."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet").where("doc_id < 40")
    docs.write.parquet(str(tmp_path / "in"))
    want = whole(spark, docs)
    for mark in ("m1", "m2"):
        ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / mark), CONFIG)
        assert chunks(spark, str(tmp_path / "out")) == want
    assert versions(spark, str(tmp_path / "out")).count() == 40


SCHEMA = "doc_id long, text string, source string, n_chars long, batch string"


def test_odd_texts(spark, tmp_path):
    rows = [(1, None, "a", 1, "x"), (2, "", None, 1, "x"), (None, "a text without an id", "a", 1, "x"), (3, "long text " * 50000, None, 1, "x"), (4, "equal texts here, long enough", "a", 1, "x"), (5, "equal texts here, long enough", "b", 1, "x")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "in"))
    (run,) = ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark"), CONFIG)
    assert run["texts_written"] == 5 and latest(spark, str(tmp_path / "out")).select("doc_id").distinct().count() == 3
    got = audit(spark, str(tmp_path / "in"), str(tmp_path / "audit"), CONFIG)
    assert got == {"texts_read": 5, "bytes_read": 500058, "pages_written": 3, "chars_written": got["chars_written"], "sources": 3, "sources_failed": 0}
    report = {r["source"]: r for r in spark.read.schema(REPORT).json(str(tmp_path / "audit/report")).collect()}
    assert {k: r["pages_doubled"] for k, r in report.items()} == {"a": 1, "b": 1, "unknown": 0}


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "in"))
    ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark"), CONFIG)
    assert latest(spark, str(tmp_path / "out")).count() == 0
    assert audit(spark, str(tmp_path / "in"), str(tmp_path / "audit"), CONFIG)["sources"] == 0


def test_audit_of_some_sources(spark, tmp_path):
    """Only the chosen sources' pages are replaced; the reports of all are drawn anew; a rerun gives the same."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    docs.write.parquet(str(tmp_path / "v1"))
    junk = F.when((F.col("source") == "src3") | (F.col("source") == "src4"), "1 2 3\n4 5 6\n7 8 9 0 1 2 3 4").otherwise(F.col("text"))
    docs.withColumn("text", junk).write.parquet(str(tmp_path / "v2"))
    out = str(tmp_path / "out")
    read = lambda: {r["source"]: r for r in spark.read.schema(REPORT).json(f"{out}/report").collect()}
    audit(spark, str(tmp_path / "v1"), out, CONFIG | {"max_junk_share": 0.05})
    before = read()
    assert all(r["passed"] for r in before.values())
    config = CONFIG | {"max_junk_share": 0.05, "sources": ["src3"]}
    for _ in range(2):
        got = audit(spark, str(tmp_path / "v2"), out, config)
        after = read()
        assert got["sources_failed"] == 1 and not after["src3"]["passed"] and after["src3"]["pages_junk_candidate"] == after["src3"]["pages"]
        assert {k: r["chars_before"] for k, r in after.items() if k != "src3"} == {k: r["chars_before"] for k, r in before.items() if k != "src3"}
    assert spark.read.schema(LEDGER).parquet(f"{out}/pages").count() == docs.where("length(trim(text)) >= 20").count()


def test_command_line(spark, tmp_path, monkeypatch):
    """The command line makes a session and stops it; here it is the tests' own, which stays."""
    import jobs.common
    from jobs.audit import audit as job

    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    config = tmp_path / "c.json"
    config.write_text(json.dumps(CONFIG))
    jobs.common.main("audit", job, ["documents", "out"], ["--documents", f"{DIR}/documents.parquet", "--out", str(tmp_path / "out"), "--config", str(config)])
    assert spark.read.schema(REPORT).json(str(tmp_path / "out/report")).count() > 0
