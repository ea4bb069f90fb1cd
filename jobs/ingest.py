"""Incremental build of retrieval chunks: only new or changed texts are worked on.

    python -m jobs.ingest --documents /data/texts --out /data/release --checkpoint /data/release-mark --config jobs/ingest.json

A file stream over a folder of Parquet files (doc_id, text and what the path is made of) takes the files that its
checkpoint doesn't know, in batches, until nothing is left. Of a batch, texts whose path has that content already go
no further; the others pass all stages, to manifest rows in out/manifest and chunks in out/chunks, both Parquet,
partitioned by batch and source kind. A batch that is run again after a failure replaces its own partitions and looks
only at batches before it, so it writes what it wrote. `latest` reads each path's newest chunks.

Defined cases: a text that comes again unchanged is not written; one that changed replaces its former chunks (also by
none, if it has no page now). If a path has several texts in one batch, the one with the least content hash holds. A
null text is empty: a manifest row without chunks. An empty folder of files gives no batch. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.config import PagesConfig, PipelineConfig, SplitConfig
from folioforge.operators import identity
from folioforge.plans import manifest, pipeline
from folioforge.schemas import CHUNKS, MANIFEST, names

from .common import as_files, existing, log, main, replace_partitions

VERSIONS = f"{MANIFEST}, content_sha1 string, batch bigint"
PARTS = f"{CHUNKS}, src_kind string, batch bigint"


def versions(spark: SparkSession, out: str) -> DataFrame:
    """Manifest rows of all batches, former versions of a path among them."""
    return existing(spark, f"{out}/manifest", VERSIONS)


def newest(rows: DataFrame) -> DataFrame:
    """(txt_rel, content_sha1, batch) of each path's last version."""
    return rows.groupBy("txt_rel").agg(F.max(F.struct("batch", "content_sha1")).alias("v")).select("txt_rel", "v.content_sha1", "v.batch")


def latest(spark: SparkSession, out: str) -> DataFrame:
    """The chunks as they stand: of each path those of its last version."""
    return existing(spark, f"{out}/chunks", PARTS).join(newest(versions(spark, out)), ["txt_rel", "batch"], "left_semi")


def changed(files: DataFrame, before: DataFrame) -> DataFrame:
    """One row of each path, unless that content is its last version already.

    Of the earlier versions only those of the batch's paths are looked at; both joins have slim right sides, which
    Spark broadcasts when they are small and shuffles otherwise.
    """
    rows = files.groupBy("txt_rel").agg(F.min_by(F.struct("txt_abs", "size_bytes", "text", "content_sha1"), "content_sha1").alias("f")).select("txt_rel", "f.*")
    touched = newest(before.join(files.select("txt_rel"), "txt_rel", "left_semi"))
    return rows.join(touched, ["txt_rel", "content_sha1"], "left_anti")


def pattern(path: str) -> str:
    """A pattern that only this path matches: a stream reads folders, and whatever a pattern matches, so also one file."""
    path = path.rstrip("/")
    return path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]"


def ingest(spark: SparkSession, documents: str, out: str, checkpoint: str, config: dict) -> list[dict]:
    """Takes the files that are new since the last run; returns what each batch read and wrote."""
    stages = PipelineConfig(pages=PagesConfig(config.get("min_chars", 20)), split=SplitConfig(config.get("max_words", 222), config.get("overlap_words", 10)))
    runs: list[dict] = []

    def batch(docs: DataFrame, number: int) -> None:
        session = docs.sparkSession
        files = as_files(docs, config["path"]).select("txt_rel", "txt_abs", "size_bytes", "text", "content_sha1")
        texts = changed(files, versions(session, out).where(F.col("batch") < number)).persist(StorageLevel.DISK_ONLY)
        rows = manifest.build(texts, stages.manifest)
        own = F.lit(number).cast("bigint").alias("batch")
        chunks = pipeline.chunks(rows, stages).select("*", identity.src_kind(F.col("txt_rel")).alias("src_kind"), own)
        table = rows.select(*names(MANIFEST), "content_sha1", own)
        # chunks count only once the manifest names their batch, so it comes last
        replace_partitions(chunks, f"{out}/chunks", "batch", "src_kind")
        replace_partitions(table, f"{out}/manifest", "batch", "src_kind")
        texts.unpersist()
        # counts that files' footers tell
        new, made = (existing(session, f"{out}/{name}", kind).where(F.col("batch") == number).count() for name, kind in (("manifest", VERSIONS), ("chunks", PARTS)))
        runs.append({"batch": number, "texts_read": docs.count(), "texts_written": new, "chunks_written": made})
        log.info("ingest: %s", runs[-1])

    schema = spark.read.parquet(documents).schema
    stream = spark.readStream.schema(schema)
    if config.get("files_per_batch"):
        stream = stream.option("maxFilesPerTrigger", config["files_per_batch"])
    query = stream.parquet(pattern(documents)).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    log.info("ingest: %d new batches from %s to %s", len(runs), documents, out)
    return runs


if __name__ == "__main__":
    main("ingest", ingest, ["documents", "out", "checkpoint"])
