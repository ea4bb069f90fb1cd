"""The same projections under Structured Streaming: no stage keeps state, so there is no watermark to set."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..config import PipelineConfig
from ..operators import pages
from ..plans import manifest
from ..plans.pipeline import chunks
from ..sources import text_files


class Counters(StreamingQueryListener):
    """Adds up what streams count as they run: of a name `min_...` the least value, of `max_...` the greatest, of others the sum."""

    def __init__(self) -> None:
        self.values: dict[str, dict] = {}
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        with self.changed:
            for name, row in event.progress.observedMetrics.items():
                known = self.values.setdefault(name, {})
                for k, v in row.asDict().items():
                    given = [x for x in (known.get(k), v) if x is not None]
                    known[k] = (min(given) if k.startswith("min_") else max(given) if k.startswith("max_") else sum(given)) if given else None

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self.changed:
            self.ended.add(str(event.id))
            self.changed.notify_all()

    def wait(self, queries: list[StreamingQuery], seconds: float = 30) -> None:
        """Until the ends of these queries have been told, so that all their progress was."""
        with self.changed:
            self.changed.wait_for(lambda: {str(q.id) for q in queries} <= self.ended, seconds)


def read_manifest(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    """New JSON-lines files of manifest rows with a text column."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def written(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes a stream's rows as JSON lines, each once, and stops when nothing is left."""
    return rows.writeStream.format("json").option("path", path).option("ignoreNullFields", "false").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def write_chunks(rows: DataFrame, path: str, checkpoint: str, config: PipelineConfig = PipelineConfig()) -> StreamingQuery:  # noqa: B008
    """Writes the final chunks of a stream of manifest rows."""
    return written(chunks(rows, config), path, checkpoint)


def take_new_files(spark: SparkSession, lib_root: str, out: str, checkpoint: str, config: PipelineConfig = PipelineConfig(), files_per_trigger: int | None = None) -> dict[str, dict]:  # noqa: B008
    """Files that are new below lib_root since the last run: their manifest rows go to out/manifest, their pages to out/pages.

    Two streams with a checkpoint each; both read a new file. Returns the counters of this run: `manifest` (files and
    bytes) and `pages` (those of pages.page_counters). Codes are read from the file itself, as a stream can't look for the
    first file with a stem.
    """
    counters = Counters()
    spark.streams.addListener(counters)
    try:
        files = text_files.scan_stream(spark, lib_root, files_per_trigger=files_per_trigger)
        rows = manifest.build(files.withColumn("text", text_files.decoded(F.col("content"))), config.manifest)
        counted = rows.observe("manifest", F.count("*").alias("files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes"))
        found = pages.chunk_pages(rows.withColumn("text", text_files.decoded(F.col("content"), for_pages=True)), config.pages, "pages")
        queries = [written(manifest.table(counted), f"{out}/manifest", f"{checkpoint}/manifest"), written(found, f"{out}/pages", f"{checkpoint}/pages")]
        for query in queries:
            query.awaitTermination()
        counters.wait(queries)
        return counters.values
    finally:
        spark.streams.removeListener(counters)
