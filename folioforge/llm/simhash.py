"""SimHash near-duplicates by multi-index hashing.

A 64-bit fingerprint is cut into two segments of 32 bits. Two fingerprints that differ in at most two bits either
differ in at most one bit of the high segment or agree in the whole low segment. So a table holds both segments of
every distinct fingerprint, each fingerprint probes it with the Hamming ball of radius 1 around its high segment
(only the flips from 0 to 1: the other side makes the reverse) and with its low segment, and each match is verified on
all 64 bits.

A segment value that more than HOT fingerprints share would pair them quadratically. Its members are linked through
their common neighbours instead: two low (or high) segments differ in at most two bits exactly if their radius-1
balls meet, so grouping by (segment value, ball element) yields groups of at most 65 fingerprints, all mutually
linked, of which a star of links is enough. No link is lost either way and none is capped.

Nulls: a null text has no words (fingerprint zero), a null id gets a component but is never its name. Equal rows are
linked like any others. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Scratch, annotate

#: Distinct fingerprints with one segment value above which links go through common neighbours.
HOT = 32
#: Nodes up to which one task's union-find may hold them (about 250 bytes each); beyond that it starts afresh.
LOCAL_EDGES = 100_000
#: Rows of one key, and one part in so many of all, above which it's joined by broadcast; there are at most so many.
MANY = 100_000
#: Ids of up to 16 bytes up to which a table is broadcast; larger ones are joined by shuffle.
FEW = 2_000_000
_LOW = (1 << 32) - 1


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of UTF-8 text: A-Z lower-cased, ASCII white space between words, XXH64 with seed 42 per shingle."""
    words = text.lower().split()  # on bytes, lower() touches A-Z only and split() just the six ASCII white spaces
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)], ">u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        block = hashes[at : at + 65536]
        ones += np.unpackbits(block.view(np.uint8).reshape(len(block), 8), axis=1).sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 5) -> DataFrame:
    """(id, fp): the signed 64-bit fingerprint of each row."""

    def make():
        def work(texts: pa.Array) -> list:
            from .shared import byte_view

            data, offsets = byte_view(texts)
            raw = data.tobytes()
            at = offsets.tolist()
            return [np.array([fingerprint(raw[a:b], shingle) for a, b in zip(at, at[1:], strict=False)], np.uint64).view(np.int64)]

        return work

    return annotate(docs, text, [id_col], [T.StructField("fp", T.LongType(), False)], make).withColumnRenamed(id_col, "id")


def links(nodes: DataFrame) -> DataFrame:
    """(a, b), a < b: links between the representatives of distinct fingerprints that differ in one or two bits.

    nodes: (fp, rep), one row per fingerprint. Links that connect the same nodes through others may be left out.
    """
    high, low = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(_LOW)
    # keys: the high segment as it is, the low one above 2^32
    held = nodes.select("fp", "rep", F.explode(F.array(high, low + (1 << 32))).alias("key"))
    flips = F.filter(F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: high.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))), lambda k: k != high)
    probes = nodes.select(F.col("fp").alias("fp2"), F.col("rep").alias("rep2"), F.explode(F.concat(F.array(high, low + (1 << 32)), flips)).alias("key"))
    hot = held.groupBy("key").count().where(F.col("count") > HOT).select("key")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= 2
    own = F.when(F.col("key") < (1 << 32), F.shiftrightunsigned("fp2", 32) == F.col("key")).otherwise(F.lit(True))
    cool = (
        held.join(hot, "key", "left_anti").alias("t").join(probes, "key").where(near & (F.col("fp") != F.col("fp2")) & (~own | (F.col("fp") < F.col("fp2")))).select(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b"))
    )
    # in a hot segment value: members give the ball around their other segment, those one flip away their low segment itself
    rest = F.when(F.col("key") < (1 << 32), F.col("fp").bitwiseAND(_LOW)).otherwise(F.shiftrightunsigned("fp", 32))
    ball = F.concat(F.array(rest), F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: rest.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))
    members = held.join(hot, "key", "left_semi").select("key", "rep", F.explode(ball).alias("spot"))
    beside = probes.join(hot, "key", "left_semi").where(~own).select("key", F.col("rep2").alias("rep"), F.col("fp2").bitwiseAND(_LOW).alias("spot"))
    met = members.unionByName(beside).groupBy("key", "spot").agg(F.min("rep").alias("a"), F.collect_set("rep").alias("all")).where(F.size("all") > 1)
    stars = met.select("a", F.explode("all").alias("b")).where("a < b")
    return cool.unionByName(stars).distinct()


def _forest(batches):
    """Union-find over one partition's links: (node, root) for each node that isn't its own root."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(x, x)) != top:
            parent[x], x = top, up
        return top

    def flush():
        rows = [(x, r) for x in parent if (r := find(x)) != x]
        parent.clear()
        return pa.RecordBatch.from_arrays([pa.array([r for _, r in rows], pa.int64()), pa.array([x for x, _ in rows], pa.int64())], names=["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
                parent.setdefault(min(a, b), min(a, b))
        if len(parent) > LOCAL_EDGES:
            yield flush()
    yield flush()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component): the smallest reachable node of each node that has a link to a smaller one.

    Alternating large-star and small-star rounds after each partition has reduced its links to a forest; every round is
    written to the shared folder, so lineage stays short and a lost executor costs one round.
    """
    pair = "a long, b long"
    old = scratch.write(edges.mapInArrow(_forest, pair))
    while True:
        n = old.count()
        both = old.unionByName(old.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count("*").alias("rows"))
        large = labelled(both.where("b > a"), least, "a", n, scratch).select(F.col("m").alias("a"), "b").where("a < b").distinct()
        low = large.groupBy("b").agg(F.min("a").alias("m"), F.count("*").alias("rows"))
        small = labelled(large, low, "b", n, scratch).select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y")).where("x < y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
        new = scratch.write(small)
        same = new.count() == n and new.exceptAll(old).isEmpty()
        scratch.drop(old)
        old = new
        if same:
            return old.select(F.col("b").alias("node"), F.col("a").alias("component"))


def labelled(rows: DataFrame, labels: DataFrame, key: str, total: int, scratch: Scratch) -> DataFrame:
    """rows joined with labels, which have one row for each key and in `rows` how many rows have it.

    Keys of more than MANY rows, and of more than one in MANY of all, are joined by broadcast: there are at most MANY
    such keys, whatever the input. All others are too small to skew a shuffle.
    """
    if total <= MANY:
        return rows.join(labels.drop("rows"), key)
    labels = scratch.write(labels)
    hot = labels.where(F.col("rows") > max(MANY, total // MANY)).drop("rows")
    if hot.isEmpty():
        return rows.join(labels.drop("rows"), key)
    cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(labels.drop("rows"), key)
    return rows.join(F.broadcast(hot), key).unionByName(cold)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 5) -> DataFrame:
    """(id, fp, component, root): one row per row of docs; component is the smallest id reachable over links.

    `root` tells components apart even where none of their rows has an id.
    """
    scratch = Scratch(docs.sparkSession)
    prints = scratch.write(fingerprints(docs, id_col, text, shingle))
    # ids may be null or repeat: each fingerprint stands for its smallest id (or, if all are null, for none)
    nodes = scratch.write(prints.groupBy("fp").agg(F.min("id").alias("rep"), F.count("*").alias("rows")))
    found = components(links(nodes.select("fp", F.col("fp").alias("rep"))), scratch)
    return named(prints, nodes, found, "fp", scratch)


def named(held: DataFrame, nodes: DataFrame, found: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """held's (id, key) rows with the component and root of their node: nodes (key, rep, rows), found (node, component)."""
    joined = scratch.write(nodes.join(found, F.col(key) == F.col("node"), "left").select(key, "rep", "rows", F.coalesce("component", key).alias("root")))
    names = joined.groupBy("root").agg(F.min("rep").alias("component"), F.count("*").alias("rows"))
    total = joined.agg(F.count("*"), F.sum("rows")).first()
    labels = labelled(joined.withColumnRenamed("rows", "held"), names, "root", total[0], scratch).select(key, "component", "root", F.col("held").alias("rows"))
    return labelled(held.select("id", key), labels, key, total[1] or 0, scratch).select("id", F.col(key).alias("fp"), "component", "root")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 5) -> DataFrame:
    """One row of each component: that with the smallest id, of several such that with the smallest fingerprint."""
    return keep_one(docs, near_duplicates(docs, id_col, text, shingle), lambda: _fp_maker(shingle), id_col, text)


def keep_one(docs: DataFrame, groups: DataFrame, make, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of docs for each root of groups (id, fp, root); `make` gives a function from texts to fp.

    The row with the smallest id stays (rows without an id come last), decided by (id, fp), since an id may stand in
    several components. Rows whose id stands once are told by the id alone; only of the others fp is made again.
    """
    scratch = Scratch(docs.sparkSession)
    groups = scratch.write(groups.select("id", "fp", "root"))
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "fp")).alias("x"))
    stay = scratch.write(first.select("x.id", "x.fp"))
    counts = scratch.write(groups.where("id is not null").groupBy("id").agg(F.count("*").alias("n")))
    again = counts.where("n > 1").select(F.col("id").alias("__id"))
    gone = scratch.write(counts.where("n = 1").select("id").join(stay, "id", "left_anti").select(F.col("id").alias("__id")))
    small = lambda df: F.broadcast(df) if df.count() <= FEW else df
    at = F.col(id_col) == F.col("__id")
    kept = docs.join(small(gone), at, "left_anti")
    repeated, free = not again.isEmpty(), not groups.where("id is null").isEmpty()
    if not repeated and not free:
        return kept
    again = small(again)
    odd = docs.join(again, at, "left_semi").unionByName(docs.where(F.col(id_col).isNull()))
    odd = annotate(odd.select(F.col(id_col).alias("__id"), F.col(text).alias("__text"), F.struct(*docs.columns).alias("__row")), "__text", ["__id", "__row"], [T.StructField("__fp", T.LongType(), False)], make)
    # of rows that agree in id and fp one is left in each partition before any is shuffled
    one = odd.groupBy("__id", "__fp").agg(F.first("__row").alias("__row")).join(small(stay.where("id is null").unionByName(stay.join(again, F.col("id") == F.col("__id"), "left_semi"))), F.col("__id").eqNullSafe(F.col("id")) & (F.col("__fp") == F.col("fp")), "left_semi")
    return kept.join(again, at, "left_anti").where(F.col(id_col).isNotNull()).unionByName(one.select("__row.*"))


def _fp_maker(shingle: int):
    return lambda texts: [np.array([fingerprint(x.encode(), shingle) for x in texts.to_pylist()], np.uint64).view(np.int64)]
