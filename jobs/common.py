"""What the jobs share: texts as files of a library, their command line, and folders of registered runs."""

from __future__ import annotations

import argparse
import json
import logging
import tempfile
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger("folioforge.jobs")


def as_files(docs: DataFrame, path: str) -> DataFrame:
    """Rows of texts with txt_rel (the SQL expression `path` over their columns), txt_abs, size_bytes, text and content_sha1.

    A null text counts as empty; rows whose path is null are left out.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.withColumn("txt_rel", F.expr(path)).where("txt_rel is not null").withColumn("text", text)
    return rows.withColumns({"txt_abs": F.concat(F.lit("/"), "txt_rel"), "size_bytes": F.octet_length("text").cast("bigint"), "content_sha1": F.sha1(F.col("text").cast("binary"))})


def existing(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at a path; an empty one if nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def replace_partitions(rows: DataFrame, path: str, *columns: str, form: str = "parquet") -> None:
    """Writes rows so that only the partitions they belong to are replaced; the session's settings stay."""
    rows.write.format(form).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).save(path)


def main(name: str, run: Callable, paths: list[str], argv: list[str] | None = None) -> None:
    """The command line of a job: its paths and a JSON config file, which may all be remote. Creates a session and stops it."""
    parser = argparse.ArgumentParser(prog=name, description=run.__doc__)
    for path in paths:
        parser.add_argument(f"--{path}", required=True)
    parser.add_argument("--config", required=True)
    a = vars(parser.parse_args(argv))
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    # recording where each expression was written takes about a quarter of the planning
    spark = SparkSession.builder.appName(name).config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate()
    try:
        config = json.loads(spark.read.option("wholetext", True).text(a.pop("config")).first()[0])
        run(spark, **a, config=config)
    finally:
        spark.stop()


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for a registered run, where driver and executors share it. Only a local session without one gets a temporary folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="folioforge-jobs-")
    return f"{shared}/{name}-{uuid.uuid4().hex}"
