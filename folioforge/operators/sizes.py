"""Size histogram and the report on very short files."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ManifestConfig
from ..functions.charclass import strip
from .identity import file_name, human_size

#: First byte count of each range and its label; a range ends where the next begins.
RANGES = [(0, "0 B"), (1, "1-255 B"), (256, "256-1023 B"), (1024, "1-2 KB"), (2048, "2-4 KB"), (4096, "4-8 KB"), (8192, "8-16 KB"), (16384, "16-32 KB"), (32768, "32-64 KB"), (65536, "64-128 KB"), (131072, "128-192 KB"), (196608, "192-256 KB"), (262144, "256-512 KB"), (524288, "512 KB-1 MB"), (1048576, "1-2 MB"), (2097152, "2-4 MB"), (4194304, "4-8 MB"), (8388608, "> 8 MB")]


def size_distribution(files: DataFrame) -> DataFrame:
    """Files by size range, also of the empty ranges: range_label, start_bytes, end_bytes, file_count, ratio to all rows.

    One aggregate with a column for each range, so there is nothing to join and no key to shuffle on.
    """
    ends = [b - 1 for b, _ in RANGES[1:]] + [None]
    inside = [(F.col("size_bytes") >= low) & (F.lit(True) if high is None else F.col("size_bytes") <= high) for (low, _), high in zip(RANGES, ends, strict=True)]
    counts = files.agg(F.count("*").alias("rows"), *[F.count_if(c).alias(f"c{i}") for i, c in enumerate(inside)])
    each = F.array(*[F.struct(F.lit(label).alias("range_label"), F.lit(low).cast("bigint").alias("start_bytes"), F.lit(high).cast("bigint").alias("end_bytes"), F.col(f"c{i}").alias("file_count")) for i, ((low, label), high) in enumerate(zip(RANGES, ends, strict=True))])
    out = counts.select("rows", F.explode(each).alias("x")).select("x.*", "rows")
    return out.withColumn("ratio", F.when(F.col("rows") > 0, F.bround(F.col("file_count") / F.col("rows"), 6)).otherwise(0.0)).drop("rows")


def small_files(files: DataFrame, config: ManifestConfig = ManifestConfig()) -> DataFrame:  # noqa: B008
    """One row: files in all and files up to small_file_max_bytes."""
    return files.agg(F.count("*").alias("rows_total"), F.count_if(F.col("size_bytes") <= config.small_file_max_bytes).alias("small_file_count"))


def report_text(text: Column, most: int) -> Column:
    """Line feeds only, stripped, cut at `most` characters with a marker; null as empty."""
    s = strip(F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n?", "\n"))
    return F.when(F.length(s) > most, F.concat(F.substring(s, 1, most), F.lit("\n...[TRUNCATED]..."))).otherwise(s)


def whitespace_tokenizer() -> Callable[[str], int]:
    """Stands in for a subword tokenizer: words between white space."""
    return lambda text: len(text.split())


def token_report(files: DataFrame, make_tokenizer: Callable[[], Callable[[str], int]], text: str = "text", config: ManifestConfig = ManifestConfig()) -> DataFrame:  # noqa: B008
    """Files up to small_scan_max_bytes with their token count and whether a search would find them.

    make_tokenizer is called once in each task that has such files; if it fails, every row says why and has no count.
    """
    shape = "token_count_e5 int, error string"

    @F.pandas_udf(shape)
    def counted(texts: pd.Series) -> pd.DataFrame:
        try:
            tokens = make_tokenizer()
        except Exception as e:  # the report is made even without a tokenizer
            return pd.DataFrame({"token_count_e5": pd.array([None] * len(texts), "Int32"), "error": [str(e) or "tokenizer not loaded"] * len(texts)})
        n, errors = [], []
        for t in texts:
            try:
                n.append(None if t is None else tokens(t))
                errors.append("no text" if t is None else "")
            except Exception as e:
                n.append(None)
                errors.append(str(e))
        return pd.DataFrame({"token_count_e5": pd.array(n, "Int32"), "error": errors})

    small = files.where(F.col("size_bytes") <= config.small_scan_max_bytes).withColumn("x", counted(F.col(text)))
    found = F.col("error") == ""
    return small.select(
        "doc_id", "sid", "size_bytes", human_size(F.col("size_bytes")).alias("size_human"), "txt_rel", "txt_abs", "uid", "src_kind", "src_rel", file_name(F.col("txt_abs")).alias("file_name"),
        F.col("x.token_count_e5").alias("token_count_e5"), F.coalesce(F.col("x.token_count_e5") >= config.min_search_tokens, F.lit(False)).alias("is_searchable_e5"), F.col("x.error").alias("error"), F.col(text).alias("_text"),
    ).withColumn("text_for_report", F.when(found, report_text(F.col("_text"), config.report_text_chars)).otherwise("")).drop("_text")


def token_report_control(report: DataFrame, config: ManifestConfig = ManifestConfig()) -> DataFrame:  # noqa: B008
    """One row: files analysed, searchable and not, the largest not and the smallest searchable size, and whether the size limit should be reviewed."""
    fine = F.col("error") == ""
    missing, found = fine & ~F.col("is_searchable_e5"), fine & F.col("is_searchable_e5")
    out = report.agg(
        F.count("*").alias("candidate_file_count"), F.count_if(missing).alias("not_searchable_file_count"), F.count_if(found).alias("searchable_file_count"),
        F.max(F.when(missing, F.col("size_bytes"))).alias("max_size_bytes_not_searchable"), F.min(F.when(found, F.col("size_bytes"))).alias("min_size_bytes_searchable"), F.coalesce(F.max(F.nullif("error", F.lit(""))), F.lit("")).alias("tokenizer_error"),
    )
    review = F.coalesce(F.col("max_size_bytes_not_searchable") >= config.small_scan_max_bytes, F.lit(False)) | F.coalesce(F.col("min_size_bytes_searchable") >= config.small_scan_max_bytes, F.lit(False))
    return out.withColumn("threshold_may_need_review", review)
