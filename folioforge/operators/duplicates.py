"""Files with the same size and the same content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .identity import file_name

COLUMNS = ["report_group_no", "size_group_no", "group_size", "group_index", "size_bytes", "content_sha1", "doc_id", "sid", "txt_rel", "txt_abs", "uid", "file_name"]
#: Paths drawn from all files, in expectation, at which groups are cut, so that no task orders a large one.
SAMPLED = 256


def same_size(files: DataFrame) -> DataFrame:
    """The files whose size another has, too: all that need hashing."""
    sizes = files.where("size_bytes is not null").groupBy("size_bytes").agg(F.count("*").alias("_n")).where("_n > 1")
    return files.join(sizes.select("size_bytes"), "size_bytes", "left_semi")


def same_size_same_content(files: DataFrame, content: str | None = "content") -> DataFrame:
    """Members of every group of files with equal size and content, numbered by size, then by hash.

    Without a content column the files have their content_sha1 (see text_files.hashed). Nothing runs before the result
    is asked for, and there's one way for groups of all sizes.

    The content is never shuffled: each file is hashed where it is read, and only its hash goes on. Sizes are counted
    from size_bytes alone. Numbers are sums of offsets: of the
    sizes before (distinct sizes are few, whatever the number of files), of the hash beginnings before, and of the place
    within those; so no task orders all files, and none a large group of copies.
    """
    sizes = files.where("size_bytes is not null").groupBy("size_bytes").agg(F.count("*").alias("_n")).where("_n > 1")
    shared = sizes.select("size_bytes", F.row_number().over(Window.orderBy("size_bytes")).alias("size_group_no"))
    known = files.withColumn("content_sha1", F.sha1(F.col(content).cast("binary"))).drop(content) if content else files
    hashed = known.where("content_sha1 is not null").join(shared, "size_bytes")
    groups = hashed.groupBy("size_bytes", "content_sha1").agg(F.count("*").alias("group_size")).where("group_size > 1")
    rows = hashed.join(numbered(groups), ["size_bytes", "content_sha1"])
    return placed(rows, files).withColumn("file_name", file_name(F.col("txt_abs"))).select(*COLUMNS)


def before(*partition: str, order: str, count: str = "_c") -> Column:
    """The sum of the counts before a row."""
    w = Window.partitionBy(*partition).orderBy(order) if partition else Window.orderBy(order)
    return F.coalesce(F.sum(count).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def numbered(groups: DataFrame) -> DataFrame:
    """groups with report_group_no: their number by size and hash."""
    keyed = groups.withColumn("_head", F.substring("content_sha1", 1, 2))
    sizes = groups.groupBy("size_bytes").agg(F.count("*").alias("_c")).select("size_bytes", before(order="size_bytes").alias("_sizes"))
    heads = keyed.groupBy("size_bytes", "_head").agg(F.count("*").alias("_c")).select("size_bytes", "_head", before("size_bytes", order="_head").alias("_heads"))
    place = F.row_number().over(Window.partitionBy("size_bytes", "_head").orderBy("content_sha1"))
    rows = keyed.withColumn("_place", place).join(heads, ["size_bytes", "_head"]).join(sizes, "size_bytes")
    return rows.withColumn("report_group_no", (F.col("_sizes") + F.col("_heads") + F.col("_place")).cast("int")).select(*groups.columns, "report_group_no")


def placed(rows: DataFrame, files: DataFrame) -> DataFrame:
    """rows with group_index: their number in their group by lower-cased path.

    Groups are cut at paths drawn from all files by a hash of the path (the same ones whenever a task runs again); a
    row's number is its place in its piece after all rows of the pieces before.
    """
    keys = ["size_bytes", "content_sha1"]
    order = [F.lower("txt_rel"), F.lower("txt_abs"), F.col("txt_rel")]
    total = files.agg(F.count("*")).scalar()
    drawn = files.where(F.pmod(F.xxhash64("txt_rel"), F.lit(1 << 30)) < F.lit((1 << 30) * SAMPLED) / total)
    borders = drawn.agg(F.array_sort(F.collect_set(F.lower("txt_rel")))).scalar()
    cut = rows.withColumn("_borders", borders).withColumn("_cut", F.size(F.filter("_borders", lambda b: b <= F.lower("txt_rel")))).drop("_borders")
    counts = cut.groupBy(*keys, "_cut").agg(F.count("*").alias("_c")).select(*keys, "_cut", before(*keys, order="_cut").alias("_before"))
    own = cut.withColumn("_place", F.row_number().over(Window.partitionBy(*keys, "_cut").orderBy(*order)))
    return own.join(counts, [*keys, "_cut"]).withColumn("group_index", (F.col("_before") + F.col("_place")).cast("int")).drop("_cut", "_place", "_before")


def size_totals(files: DataFrame) -> DataFrame:
    """One row: sizes that several files share, and those files."""
    sizes = files.where("size_bytes is not null").groupBy("size_bytes").agg(F.count("*").alias("n")).where("n > 1")
    return sizes.agg(F.count("*").alias("total_unique_sizes_with_duplicates"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_files_in_size_groups"))
