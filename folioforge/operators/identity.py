"""Identifiers and paths of files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.charclass import strip


def norm(s: Column) -> Column:
    """Forward slashes, stripped; null as empty."""
    return F.coalesce(strip(F.translate(s, "\\", "/")), F.lit(""))


def uid(txt_rel: Column) -> Column:
    return F.sha1(txt_rel.cast("binary"))


def doc_id(txt_rel: Column) -> Column:
    """The first 16 hex digits of the relative path's hash."""
    return F.substring(uid(txt_rel), 1, 16)


def src_kind(txt_rel: Column) -> Column:
    """pdf or djvu, as the path says; else null."""
    s = F.lower(F.translate(txt_rel, "\\", "/"))
    return F.when(F.contains(s, F.lit("pdf_ocr_txt")), "pdf").when(F.contains(s, F.lit("djvu_ocr_txt")), "djvu")


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    """The file name without its last extension."""
    return F.regexp_extract(file_name(path), r"^(.+?)(?:\.[^.]*)?$", 1)


def human_size(n: Column) -> Column:
    """Bytes in the largest unit up to TB; null as empty."""
    value = n.cast("double")
    shown = lambda unit, power: F.format_string(f"%.2f {unit}", F.bround(value / 1024.0**power, 2))  # noqa: E731  halves go to even digits
    out = shown("TB", 4)
    for power, unit in ((3, "GB"), (2, "MB"), (1, "KB")):
        out = F.when(value / 1024.0**power < 1024.0, shown(unit, power)).otherwise(out)
    return F.when(n.isNull(), "").when(value < 1024.0, F.format_string("%d B", n.cast("bigint"))).otherwise(out)


def stem_index(files: DataFrame) -> DataFrame:
    """Of each stem the first file (by lower-cased path) and how many more there are: stem, txt_rel, collisions.

    An aggregate, so a frequent stem is combined before the shuffle.
    """
    first = F.min_by("txt_rel", F.struct(F.lower("txt_rel"), F.col("txt_rel")))
    return files.groupBy(stem(F.col("txt_rel")).alias("stem")).agg(first.alias("txt_rel"), (F.count("*") - 1).alias("collisions"))


def stem_join(files: DataFrame, content: str) -> DataFrame:
    """files with `text_rel` and, of the first file with the same stem, its `content` in place of their own."""
    index = stem_index(files).select(F.col("stem").alias("_stem"), F.col("txt_rel").alias("text_rel"))
    source = files.select(F.col("txt_rel").alias("_rel"), F.col(content).alias("_content"))
    first = index.join(source, F.col("text_rel") == F.col("_rel")).drop("_rel")
    return files.drop(content).join(first, stem(F.col("txt_rel")) == F.col("_stem"), "left").withColumnRenamed("_content", content).drop("_stem")


def checks() -> dict[str, Column]:
    """Whether a row's id, absolute and relative path are what the relative path says."""
    return {"doc_id_ok": F.col("doc_id") == doc_id(F.col("txt_rel")), "txt_abs_ok": F.endswith(F.translate("txt_abs", "\\", "/"), F.col("txt_rel")), "txt_rel_ok": norm(F.col("txt_rel")) == F.col("txt_rel")}


def consistency(rows: DataFrame) -> DataFrame:
    """The rows that fail one of the checks (none, by construction)."""
    return rows.withColumns(checks()).where("not (doc_id_ok and txt_abs_ok and txt_rel_ok)")


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """`line`: the place in the given order, for reports of bounded size."""
    return df.withColumn("line", F.row_number().over(Window.orderBy(*order)))
