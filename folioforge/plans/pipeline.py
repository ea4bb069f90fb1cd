"""The five stages in one lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions.parallel import spread
from ..operators import cleaning, pages, quality, subchunks
from ..sources import text_files
from . import manifest


#: The stages whose counters a run can take.
STAGES = ("pages", "analyze", "clean", "split")


def chunks(manifest_rows: DataFrame, config: PipelineConfig = PipelineConfig(), counters: dict[str, Observation] | None = None) -> DataFrame:  # noqa: B008
    """The final chunks of manifest rows with their text. No stage shuffles. `counters` get each stage's figures, by name."""
    of = (counters or {}).get
    found = pages.chunk_pages(manifest_rows, config.pages, of("pages"))
    analysed = quality.analyze(found, counters=of("analyze"))
    return subchunks.split_pages(cleaning.clean_pages(analysed, config.cleaning, of("clean")), config.split, of("split"))


def run(spark: SparkSession, lib_root: str, config: PipelineConfig = PipelineConfig(), counters: dict[str, Observation] | None = None) -> DataFrame:  # noqa: B008
    """The final chunks of all text files below lib_root."""
    files = spread(text_files.scan(spark, lib_root))
    rows = manifest.build(files.withColumn("text", text_files.decoded(F.col("content"))), config.manifest)
    # pages keep the byte order mark that the manifest drops
    return chunks(rows.withColumn("text", text_files.decoded(F.col("content"), for_pages=True)), config, counters)
