"""The manifest: one row for each text file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ManifestConfig
from ..operators import codes, identity
from ..operators.names import parse_names
from ..schemas import MANIFEST, names
from ..sources import text_files


def build(files: DataFrame, config: ManifestConfig = ManifestConfig()) -> DataFrame:  # noqa: B008
    """The manifest with code columns, name_year and parse_mode, from (txt_rel, txt_abs, size_bytes, text).

    With text_by_stem codes and years come from the first file with the same stem.
    """
    rows = identity.stem_join(files, "text") if config.text_by_stem else files
    rel = F.col("txt_rel")
    rows = rows.withColumns({
        "uid": identity.uid(rel), "sid": identity.doc_id(rel), "doc_id": identity.doc_id(rel), "src_kind": identity.src_kind(rel), "src_rel": F.lit(""), "src_exists": F.lit(False), "rel_path_stg1": rel, "_name": identity.stem(rel),
    })
    rows = parse_names(rows, "_name").withColumnRenamed("year", "name_year")
    rows = codes.code_columns(rows, "text", config)
    # the text's year is looked for only where the name has none
    return rows.withColumn("year", codes.merged_year(F.col("name_year"), F.when(~codes.valid_year(F.col("name_year")), F.col("text_year")))).drop("_name")


def from_files(spark: SparkSession, lib_root: str, config: ManifestConfig = ManifestConfig()) -> DataFrame:  # noqa: B008
    files = text_files.scan(spark, lib_root)
    return build(files.withColumn("text", text_files.decoded(F.col("content"))).drop("content"), config)


def table(rows: DataFrame, *more: str) -> DataFrame:
    """Only the manifest's own columns, and those in `more`."""
    return rows.select(*names(MANIFEST), *more)
