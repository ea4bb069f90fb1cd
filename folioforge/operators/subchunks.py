"""Pages cut into balanced, overlapping parts of limited word count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..config import SplitConfig
from ..functions.charclass import let, words
from ..functions.observing import observed


def part_count(n: Column, config: SplitConfig) -> Column:
    """1 for up to max_words words, else the least number of parts whose share and overlap fit; 0 for none."""
    room = config.max_words - config.overlap_words
    return F.when(n == 0, 0).when(n <= config.max_words, 1).otherwise(F.greatest(F.lit(2), F.ceil(n / room))).cast("int")


def balanced_ranges(n: Column, parts: Column) -> Column:
    """Of each part its first word and the one after its last; the first n mod parts have one word more."""
    base, more = F.floor(n / parts).cast("int"), (n % parts).cast("int")
    start = lambda i: i * base + F.least(i, more)
    return F.transform(F.sequence(F.lit(0), parts - 1), lambda i: F.struct(start(i).alias("start"), start(i + 1).alias("end")))


def subchunks(text: Column, config: SplitConfig) -> Column:
    """The parts' texts: words joined by single spaces, each part after the first with the words before it."""
    return parts(words(text), config)


def parts(words: Column, config: SplitConfig) -> Column:

    def cut(ws: Column) -> Column:
        n = F.size(ws)
        ranges = balanced_ranges(n, F.greatest(part_count(n, config), F.lit(1)))

        def part(r: Column, i: Column) -> Column:
            # an overlap reaches back into the part before at most
            before = F.get(ranges, i - 1)
            overlap = F.when(i > 0, F.least(F.lit(config.overlap_words), before["end"] - before["start"])).otherwise(0)
            return F.array_join(F.slice(ws, r["start"] - overlap + 1, r["end"] - r["start"] + overlap), " ")

        return F.when(n == 0, F.array().cast("array<string>")).otherwise(F.transform(ranges, part))

    return let(words, cut)


def split_pages(pages: DataFrame, config: SplitConfig = SplitConfig(), counters: Observation | None = None) -> DataFrame:  # noqa: B008
    """The final chunks: chunk_id, doc_id, text, page_start, year, txt_rel. A page without words has none. `counters` get the figures of split_stats."""
    kept = ["doc_id", "page_start", "year", "txt_rel"]
    cut = pages.select(*kept, words(F.col("text")).alias("words")).select(*kept, F.size("words").alias("n"), parts(F.col("words"), config).alias("parts"))
    cut = observed(cut.withColumn("k", F.size("parts")), counters, split_counters(config))
    each = cut.select(*kept, "k", F.posexplode_outer("parts").alias("i", "text")).where("i is not null")
    key = F.format_string("%s::p%05d::w%02dof%02d", "doc_id", "page_start", F.col("i") + 1, "k")
    return each.select(key.alias("chunk_id"), "doc_id", "text", "page_start", "year", "txt_rel")


def split_counters(config: SplitConfig) -> dict[str, Column]:
    """Aggregates over pages with their words' number n and their parts' number k."""
    n, k = F.coalesce("n", F.lit(0)), F.col("k")
    # the overlaps of a page add overlap_words for each part but the first, as parts are never shorter than that unless cut so
    base, more = F.floor(n / F.greatest(k, F.lit(1))), n % F.greatest(k, F.lit(1))
    after = F.greatest(k - 1, F.lit(0))
    longer = F.least(more, after)
    overlap = longer * F.least(F.lit(config.overlap_words), base + 1) + (after - longer) * F.least(F.lit(config.overlap_words), base)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return {"pages_in": F.count("*"), "chunks_out": total(k), "pages_single": F.count_if(k == 1), "pages_split": F.count_if(k > 1), "max_parts": F.coalesce(F.max(k), F.lit(0)), "pages_empty": F.count_if(k == 0), "words_in": total(n), "words_out": total(n + overlap)}


def split_stats(pages: DataFrame, config: SplitConfig = SplitConfig()) -> DataFrame:  # noqa: B008
    """One row: pages in, parts out, pages kept whole, split and empty, most parts, words in and out, average words of a page and of a part."""
    counted = pages.select(F.size(words(F.col("text"))).alias("n")).withColumn("k", part_count(F.col("n"), config))
    return counted.agg(*[c.alias(k) for k, c in split_counters(config).items()]).withColumns({
        "avg_words_in": F.when(F.col("pages_in") > 0, F.bround(F.col("words_in") / F.col("pages_in"), 6)).otherwise(0.0),
        "avg_words_out": F.when(F.col("chunks_out") > 0, F.bround(F.col("words_out") / F.col("chunks_out"), 6)).otherwise(0.0),
    })
