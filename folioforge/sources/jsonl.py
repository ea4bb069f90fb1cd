"""JSON lines."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.observing import observed


def read(spark: SparkSession, path: str, schema: str, counters: Observation | None = None) -> DataFrame:
    """Rows of the schema; empty lines, malformed lines and lines that aren't objects are left out. `counters` get the figures of read_stats."""
    return observed(parsed(spark, path, schema), counters, line_counters()).where("state = 'row'").select("row.*")


def line_counters() -> dict[str, Column]:
    state = F.col("state")
    return {"lines": F.count("*"), "rows": F.count_if(state == "row"), "bad_json": F.count_if(state == "bad"), "empty_lines": F.count_if(state == "empty")}


def parsed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(state, row): state is row, bad or empty."""
    lines = spark.read.text(path).select(F.regexp_replace("value", "^\ufeff", "").alias("value"))
    whole = F.try_parse_json("value")
    rows = lines.select("value", F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("row"), F.coalesce(F.startswith(F.schema_of_variant(whole), F.lit("OBJECT")), F.lit(False)).alias("fine"))
    empty = F.regexp_replace("value", "[\\s\u00a0]+", "") == ""
    return rows.select(F.when(empty, "empty").when(F.col("fine"), "row").otherwise("bad").alias("state"), "row")


def read_stats(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row: lines, rows, bad_json and empty_lines."""
    return parsed(spark, path, schema).agg(*[c.alias(k) for k, c in line_counters().items()])


def write(df: DataFrame, path: str, *order: str) -> None:
    """One object per line, keys in column order, nulls written; sorted by `order` if given.

    A sort by ranges looks at its input twice: once for the ranges. It finds the rows in a shuffle by the first key, so the
    stage behind them runs once.
    """
    df = df.repartition(order[0]).orderBy(*order) if order else df
    df.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def write_object(spark: SparkSession, values: dict, path: str) -> None:
    """One object, such as a stage's summary, as a line of JSON."""
    text = json.dumps(values, ensure_ascii=False, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("errorifexists").text(path)
