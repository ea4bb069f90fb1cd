"""Near-duplicates by the Jaccard similarity of word shingles, exactly.

Two texts are linked if the sets of their shingles (normalised as for SimHash) have at least PERCENT hundredths of
their union in common. Sets are ordered by one order of all shingles; two such sets share a shingle in their first
fifths (prefix filter: of the larger set n - ceil(t n) + 1 shingles, of the smaller one n - ceil(2 t n / (1 + t)) + 1).
Pairs that share one, and whose sizes and places allow the similarity, are compared by sketches (of each place the parity
of the shingles that fall there, two to four places a shingle): as many places as differ, so many shingles at least are
in one set only. Pairs that this doesn't rule out are compared as whole sets, so only near links move sets.

The order is that of the hashes, but shingles found in more than HOT prefixes come last, so that common lines make no
pairs. Texts that consist of such shingles still meet in large buckets. There each is compared with a few members of its
bucket that have most in common with others, which links most near copies. Afterwards members of different components
are compared with each other, by sizes, places and sketches of fixed size, in blocks of bounded size that are dealt over
tasks; only pairs that none of these rules out become rows. No link that joins components is lost.

Nulls and texts without words have the empty set, and equal sets are one node. Ids may be null or repeat.

`near` adds the links of op 1: texts whose SimHash fingerprints differ in two bits at most, found by multi-index hashing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import simhash
from .shared import Scratch, annotate, byte_view, give_back, small_batches
from .simhash import components, keep_one, labelled, named

#: Hundredths of the union that two sets must share.
PERCENT = 80
#: Sets with one shingle in their prefixes above which it comes last; rounds of counting; shingles that come last at most.
HOT, ROUNDS, LAST = 32, 3, 200_000
#: Shingles or pairs up to which they are broadcast (4 MB of numbers).
BROADCAST = 250_000
#: Bytes of a row group of the tables on the way: sets are long, and tasks hold a group while they write or read it.
GROUP = 8 << 20
#: Sets whose prefixes are made at once; shingles that are hashed at once.
ROWS, BLOCK = 500, 1 << 16
#: Members of a hot shingle's bucket that all others are compared with first.
HUBS = 8
#: Words of the shortest sketch, to which all are folded in hot buckets; members of such a bucket in one block, and words
#: that are compared at once.
WORDS, MEMBERS, AT_ONCE = 16, 2048, 1 << 19


def shingles(text: bytes, shingle: int) -> np.ndarray:
    """The distinct shingles' hashes in ascending order."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.int64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    digest, found = xxhash.xxh64_intdigest, np.empty(len(words) - k + 1, np.uint64)
    del words
    for at in range(0, len(found), BLOCK):
        block = zip(starts[at : at + BLOCK].tolist(), ends[at + k - 1 : at + k - 1 + BLOCK].tolist(), strict=False)
        some = [digest(joined[a:b], 42) for a, b in block]
        found[at : at + len(some)] = some
    return np.unique(found.view(np.int64))


def set_key(hashes: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), 42)).astype(np.int64))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Parities of the shingles at each place, a place being the hash's last bits: as many words as a power of two."""
    words = max(WORDS, 1 << max(0, (2 * len(hashes) - 1).bit_length() - 6))
    return np.packbits((np.bincount(hashes & (64 * words - 1), minlength=64 * words) & 1).astype(np.uint8), bitorder="little").view(np.int64)


def _sets(shingle: int, near: int | None = None):
    def work(texts: pa.Array) -> list:
        data, offsets = byte_view(texts)
        raw, at = data.tobytes(), offsets.tolist()
        found = [shingles(raw[a:b], shingle) for a, b in zip(at, at[1:], strict=False)]
        n = np.fromiter(map(len, found), np.int32, len(found))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()), pa.array(np.concatenate(found), pa.int64()))
        sketches = [sketch(x) for x in found]
        ends = np.concatenate(([0], np.cumsum([len(x) for x in sketches]))).astype(np.int32)
        prints = [] if near is None else [np.array([simhash.fingerprint(raw[a:b], near) for a, b in zip(at, at[1:], strict=False)], np.uint64).view(np.int64)]
        return [np.array([set_key(x) for x in found], np.int64), n, lists, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sketches), pa.int64())), *prints]

    return work


def print_links(marks: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b), a < b: links between the keys of marks (key, fp) whose fingerprints are equal or differ in one or two bits."""
    marks = scratch.write(marks.distinct())
    nodes = scratch.write(marks.groupBy("fp").agg(F.min("key").alias("rep"), F.count("*").alias("rows")))
    equal = labelled(marks, nodes, "fp", marks.count(), scratch).select(F.col("rep").alias("a"), F.col("key").alias("b"))
    return simhash.links(nodes.select("fp", "rep")).unionByName(equal).where("a < b")


def prefixes(sets: DataFrame, percent: int, last: np.ndarray) -> DataFrame:
    """(h, key, n, at, short): the prefix of each set, the shingles in `last` (ascending) after all others.

    `short` tells whether the place is also in the shorter prefix that does for the smaller set of a pair.
    """
    small_batches(sets.sparkSession)
    shared = sets.sparkSession.sparkContext.broadcast(last)

    def run(batches):
        late = shared.value
        give_back()
        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            keys, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            values, ends = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)
            common = late[np.minimum(np.searchsorted(late, values), len(late) - 1)] == values if len(late) else np.zeros(len(values), bool)
            n = np.diff(ends)
            long = np.where(n > 0, n + (-percent * n // 100) + 1, 0)
            short = np.where(n > 0, n + (-2 * percent * n // (100 + percent)) + 1, 0)
            parts = []
            for a, b, p in zip(ends[:-1].tolist(), ends[1:].tolist(), long.tolist(), strict=True):
                own, c = values[a:b], common[a:b]
                parts.append(np.concatenate((own[~c], own[c]))[:p] if c.any() else own[:p])
            at = np.arange(long.sum()) - np.repeat(np.cumsum(long) - long, long)
            h = np.concatenate([np.zeros(0, np.int64), *parts])
            columns = [pa.array(h), pa.array(np.repeat(keys, long)), pa.array(np.repeat(n, long), pa.int32()), pa.array(at, pa.int32()), pa.array(at < np.repeat(short, long))]
            yield pa.RecordBatch.from_arrays(columns, names=["h", "key", "n", "at", "short"])

    return sets.select("key", "hashes").mapInArrow(run, "h long, key long, n int, at int, short boolean")


def _possible(x: Column, y: Column, percent: int) -> Column:
    """Whether x may be the smaller set of a similar pair, by sizes and by the places of the shingle both have."""
    n, m = x["n"].cast("long"), y["n"].cast("long")
    left = F.least(n - x["at"], m - y["at"]) + F.least(x["at"], y["at"])
    return x["short"] & ((n < m) | ((n == m) & (x["key"] < y["key"]))) & (100 * n >= percent * m) & ((100 + percent) * left >= percent * (n + m))


def _folded(words: Column, size: Column) -> Column:
    """A sketch of `size` or twice as many words with `size` words."""
    xor = lambda x, y: x.bitwiseXOR(y)
    return F.when(F.size(words) <= size, words).otherwise(F.zip_with(F.slice(words, F.lit(1), size), F.slice(words, size + 1, size), xor))


def not_ruled_out(pairs: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) whose sketches allow the similarity."""
    brief = sets.select("key", F.col("n").cast("long").alias("n"), "sketch")
    first = brief.withColumnRenamed("key", "a").join(pairs.groupBy("a").agg(F.count("*").alias("rows")), "a")
    rows = pairs.join(brief.select(F.col("key").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("other")), "b")
    rows = labelled(rows, first, "a", pairs.count(), scratch)
    size = F.least(F.size("sketch"), F.size("other"))
    differ = F.aggregate(F.zip_with(_folded(F.col("sketch"), size), _folded(F.col("other"), size), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0).cast("long"), lambda s, k: s + k)
    # of the union at most so many hundredths may be in one set only; twice the shared ones are n + m less those
    return rows.where((100 + percent) * (F.col("n") + F.col("m") - differ) >= 2 * percent * (F.col("n") + F.col("m"))).select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar. A set may be the first of very many pairs (`labelled`)."""
    pairs = scratch.write(not_ruled_out(pairs, sets, percent, scratch))
    total = pairs.count()
    known = F.broadcast(pairs) if total <= BROADCAST else pairs  # then only the sets in pairs are shuffled
    right = sets.select(F.col("key").alias("b"), F.col("n").alias("m"), F.col("hashes").alias("other")).join(known, "b")
    counts = pairs.groupBy("a").agg(F.count("*").alias("rows"))
    left = sets.select(F.col("key").alias("a"), "n", "hashes").join(F.broadcast(counts) if total <= BROADCAST else counts, "a")
    both = F.size(F.array_intersect("hashes", "other")).cast("long")
    return labelled(right, left, "a", total, scratch).where((100 + percent) * both >= percent * (F.col("n").cast("long") + F.col("m"))).select("a", "b")


def hub_pairs(hot: DataFrame, few: bool) -> DataFrame:
    """(a, b): each member of a hot shingle's bucket with up to HUBS others, those with most hot shingles for their size.

    Of each HUBS-th part of a bucket one is taken, so that buckets are reduced before they are shuffled.
    """
    weighed = hot.join(hot.groupBy("key").agg(F.count("*").alias("times")), "key").select("h", "key", F.struct(F.col("times") / F.col("n"), "key").alias("x"))
    hubs = weighed.groupBy("h", F.pmod(F.xxhash64("key"), F.lit(HUBS)).alias("part")).agg(F.max("x").alias("x")).select("h", F.col("x.key").alias("a"))
    return hot.select("h", "key").join(F.broadcast(hubs) if few else hubs, "h").where("a <> key").select("a", F.col("key").alias("b")).distinct()


def apart(members: DataFrame, percent: int, few: bool) -> DataFrame:
    """(a, b): pairs of one bucket and different components that sizes, places and sketches allow; a pair may recur.

    members: (h, root, n, key, at, short, sketch), sketches of WORDS words. A bucket's largest component isn't compared
    with itself. The others' members are dealt to blocks and those of the largest to more blocks; each two blocks of which
    one holds others meet in a group of at most about twice MEMBERS rows.
    """
    sizes = members.groupBy("h", "root").agg(F.count("*").alias("rows")).groupBy("h").agg(F.max(F.struct("rows", "root")).alias("x"), F.sum("rows").alias("rows"))
    parts = lambda rows: F.ceil(rows / MEMBERS).cast("int")
    dealt = sizes.where(F.col("rows") > F.col("x.rows")).select("h", F.col("x.root").alias("main"), parts(F.col("rows") - F.col("x.rows")).alias("others"), parts(F.col("x.rows")).alias("mains"))
    rows = members.join(F.broadcast(dealt) if few else dealt, "h")
    main, part = F.col("root") == F.col("main"), lambda k: F.pmod(F.xxhash64("key"), F.col(k)).cast("int")
    rows = rows.withColumn("block", F.when(main, F.col("others") + part("mains")).otherwise(part("others")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(main, F.col("others")).otherwise(F.col("others") + F.col("mains")) - 1)))
    rows = rows.select("h", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "root", "n", "key", "at", "short", "sketch")
    return rows.groupBy("h", "i", "j").applyInArrow(_compared(percent), "a long, b long")


def _compared(percent: int):
    def run(group: pa.Table) -> pa.Table:
        take = lambda name: group.column(name).to_numpy()
        order = np.lexsort((take("key"), take("n")))  # of a pair the first is the smaller one
        key, n, at, root, short, block = (take(name)[order] for name in ("key", "n", "at", "root", "short", "block"))
        n, at, words = n.astype(np.int64), at.astype(np.int64), group.column("sketch").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, WORDS)[order]
        across = group.column("i")[0].as_py() != group.column("j")[0].as_py()
        end, step = np.searchsorted(n, 100 * n // percent, "right"), max(1, AT_ONCE // (WORDS * len(n)))
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a in range(0, len(n), step):
            x, y = slice(a, a + step), slice(a + 1, end[min(a + step, len(n)) - 1])
            both = n[x, None] + n[y]
            shared = np.minimum((n - at)[x, None], (n - at)[y]) + np.minimum(at[x, None], at[y])
            fit = short[x, None] & (root[x, None] != root[y]) & (100 * n[x, None] >= percent * n[y]) & ((100 + percent) * shared >= percent * both)
            fit &= np.arange(a, min(a + step, len(n)))[:, None] < np.arange(a + 1, a + 1 + fit.shape[1])
            if across:
                fit &= block[x, None] != block[y]
            if fit.any():
                differ = np.bitwise_count(words[x, None] ^ words[None, y]).sum(2, dtype=np.int64)
                i, j = np.nonzero(fit & ((100 + percent) * (both - differ) >= 2 * percent * both))
                left.append(key[a + i])
                right.append(key[a + 1 + j])
        return pa.table({"a": np.concatenate(left), "b": np.concatenate(right)})

    return run


def _brief(words: Column) -> Column:
    """A sketch folded to WORDS words."""
    part = lambda k: F.aggregate(F.filter(words, lambda _, i: i % WORDS == k), F.lit(0).cast("long"), lambda x, y: x.bitwiseXOR(y))
    return F.array(*[part(k) for k in range(WORDS)])


def links(sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(a, b): links between similar sets, enough to connect all that are.

    sets: (key, n, hashes, sketch), keys being distinct.
    """
    last = np.zeros(0, np.int64)
    for left in reversed(range(ROUNDS)):
        rows = prefixes(sets, percent, last)
        counts = scratch.write(rows.groupBy("h").count().where("count > 1"))
        full = counts.where(F.col("count") > HOT)
        new = np.array([r.h for r in full.orderBy(F.desc("count"), "h").limit(LAST).select("h").collect()], np.int64)
        grown = np.union1d(last, new)
        if not left or len(grown) == len(last):
            break
        last = grown
    few = full.count()
    full = full.select("h")
    full = F.broadcast(full) if few <= BROADCAST else full
    place = F.struct("n", "key", "at", "short")
    # most shingles stand in one prefix only: only rows of the others are gathered, and if these are few only their rows are shuffled
    met = counts.where(F.col("count").between(2, HOT)).select("h")
    cool = rows.join(F.broadcast(met) if counts.count() <= BROADCAST else met, "h", "left_semi")
    lists = cool.groupBy("h").agg(F.collect_list(place).alias("all")).where(F.size("all") > 1)
    met = lists.select(F.explode("all").alias("x"), "all").select("x", F.explode(F.filter("all", lambda y: _possible(F.col("x"), y, percent))).alias("y"))
    pairs = scratch.write(met.select(F.col("x.key").alias("a"), F.col("y.key").alias("b")).distinct())
    found = scratch.write(verified(pairs, sets, percent, scratch))
    if not few:
        return found
    hot = scratch.write(rows.join(full, "h", "left_semi"))
    pairs = scratch.write(hub_pairs(hot, few <= BROADCAST // HUBS))
    found = scratch.write(found.unionByName(verified(pairs, sets, percent, scratch)))
    roots = components(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), scratch)
    keys = scratch.write(hot.select("key").distinct())
    keys = F.broadcast(keys) if keys.count() <= BROADCAST else keys
    brief = sets.join(keys, "key", "left_semi").select("key", _brief(F.col("sketch")).alias("sketch"))
    members = brief.join(roots, F.col("key") == F.col("node"), "left").select("key", "sketch", F.coalesce("component", "key").alias("root"))
    pairs = scratch.write(apart(scratch.write(hot.join(members, "key")), percent, few <= BROADCAST).distinct())
    return found.unionByName(verified(pairs, sets, percent, scratch))


def groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = PERCENT, near: int | None = None) -> DataFrame:
    """(id, fp, component, root): one row per row of docs; fp tells equal sets, component is the smallest id reachable over links.

    `near`: words of a shingle in the fingerprints whose links count, too (None: no fingerprints).
    """
    scratch = Scratch(docs.sparkSession, GROUP)
    fields = [T.StructField("key", T.LongType(), False), T.StructField("n", T.IntegerType(), False), *(T.StructField(name, T.ArrayType(T.LongType(), False), False) for name in ("hashes", "sketch"))]
    fields += [] if near is None else [T.StructField("fp", T.LongType(), False)]
    held = annotate(docs.select(F.col(id_col).alias("id"), F.col(text).alias("__text")), "__text", ["id"], fields, lambda: _sets(shingle, near))
    held = scratch.write(held.withColumn("row", F.monotonically_increasing_id()))
    nodes = scratch.write(held.groupBy("key").agg(F.min("id").alias("rep"), F.min("row").alias("first"), F.count("*").alias("rows")))
    # of equal sets one row is compared
    again = scratch.write(held.select("key", "row").join(nodes.where("rows > 1").select("key", "first"), "key").where("row <> first").select("row"))
    sets = held.join(F.broadcast(again) if again.count() <= BROADCAST else again, "row", "left_anti").select("key", "n", "hashes", "sketch")
    found = links(sets, percent, scratch).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    if near is not None:
        found = found.unionByName(print_links(held.select("key", "fp"), scratch))
    roots = components(found, scratch)
    return named(held.select("id", "key"), nodes, roots, "key", scratch)


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = PERCENT, near: int | None = None) -> DataFrame:
    """One row of each component: that with the smallest id, of several such that with the smallest fp."""
    make = lambda: lambda texts: [np.array([set_key(shingles(x.encode(), shingle)) for x in texts.to_pylist()], np.int64)]
    return keep_one(docs, groups(docs, id_col, text, shingle, percent, near), make, id_col, text)
