"""Benchmark decontamination by winnowing.

Every run of K words has a hash; of each window of SPAN - K + 1 neighbouring hashes the smallest is a fingerprint. A
passage of SPAN words that stands in both a document and a benchmark item has the same smallest hash in both, so
joining fingerprints finds every such passage. A matching fingerprint is then extended: the SPAN-word windows around
it are looked up, whole and as text, among the benchmark's. Items shorter than SPAN words are a single window each and
are looked up by the hash of their length.

A benchmark of up to BROADCAST_BYTES of text is a broadcast index, and documents are not shuffled. Beyond that the
fingerprints are joined by shuffle: a bit table of fixed size, filled from all fingerprints and windows of the
benchmark, tells which windows of the documents may be among them; those are joined with the benchmark's as text, and
only the rows they come from are shuffled. Both ways give the same results; neither holds more of the benchmark in one
place than its bound.

Long texts are read in pieces of about PIECE bytes that overlap by SPAN - 1 words.

Words: A-Z are lower-cased; digits, a-z and everything beyond ASCII make words. Nulls have no words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Scratch, annotate, byte_view, keep_rows, slices
from .simhash import labelled

SPAN, K = 13, 5
#: Text of a benchmark that is broadcast (the index takes about 8 times as much in each worker); bytes of a long text read at once.
BROADCAST_BYTES, PIECE = 8 << 20, 1 << 20
#: Bits of the table that tells which windows may be the benchmark's: 16 for each up to the second power of two.
LEAST_BITS, MOST_BITS = 20, 27

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE, _STEP = 0x100000001B3, np.uint64(0xD6E8FEB86659FD93)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_CODE = _mixed(np.arange(1, 257, dtype=np.uint64) * _MIX)


def powers(n: int) -> list[np.ndarray]:
    """Powers of an odd number modulo 2^64 and of its inverse."""
    if len(_powers[0]) < n:
        n = max(n, 1 << 16)
        for i, x in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            _powers[i] = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n - 1, x, np.uint64))), dtype=np.uint64)
    return _powers


@dataclass
class Words:
    """The words of many texts: places in the lower-cased bytes, hashes, and of each text its first word."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # len + 1

    def grams(self, n: int) -> np.ndarray:
        """Hashes of the runs of n words that start at each word (also across texts)."""
        m = max(len(self.hash) - n + 1, 0)
        out = np.zeros(m, np.uint64)
        for i in range(n):
            out = out * _STEP + self.hash[i : m + i]
        return _mixed(out)

    def text(self, at: int, n: int) -> bytes:
        return b" ".join([self.data[a:b].tobytes() for a, b in zip(self.start[at : at + n].tolist(), self.end[at : at + n].tolist(), strict=True)])


def words(texts: pa.Array) -> Words:
    return words_in(*byte_view(texts))


def words_in(data: np.ndarray, offsets: np.ndarray) -> Words:
    data = _LOWER[data]
    inside = _WORD[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edge = offsets[:-1][np.diff(offsets) > 0]  # words end with their text
    begins[edge] = inside[edge]
    stops[edge[1:] - 1] = inside[edge[1:] - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    up, down = powers(len(data) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_CODE[data] * up[: len(data)], dtype=np.uint64)))
    return Words(data, start, end, _mixed((total[end] - total[start]) * down[start]), np.searchsorted(start, offsets))


def winnowed(w: Words, hashes: np.ndarray) -> np.ndarray:
    """Places of the fingerprints among the K-word hashes."""
    window, n = SPAN - K + 1, len(w.hash)
    whole = n - SPAN + 1
    if whole <= 0:
        return np.zeros(0, np.int64)
    least = hashes[:whole].copy()
    for i in range(1, window):
        np.minimum(least, hashes[i : whole + i], out=least)
    sizes = np.diff(w.first)
    good = np.zeros(n + 1, np.int32)  # windows within one text
    long = sizes >= SPAN
    np.add.at(good, w.first[:-1][long], 1)
    np.add.at(good, w.first[1:][long] - SPAN + 1, -1)
    least[np.cumsum(good)[:whole] == 0] = 0
    most = np.zeros(len(hashes), np.uint64)
    for i in range(window):
        np.maximum(most[i : whole + i], least, out=most[i : whole + i])
    return np.flatnonzero((hashes == most) & (most > 0))


def pieces(texts: pa.Array) -> Iterator[tuple[Words, int]]:
    """The texts' words, and how many words of the (then only) text stand before them: a long text comes in pieces."""
    data, offsets = byte_view(texts)
    if len(texts) != 1 or len(data) <= 2 * PIECE:
        yield words_in(data, offsets), 0
        return
    at, done, before = 0, 0, 0
    while done < len(data):
        to = min(done + PIECE, len(data))
        while to < len(data) and _WORD[_LOWER[data[to]]]:  # a piece ends between words, however long they are
            gap = np.flatnonzero(~_WORD[_LOWER[data[to : to + PIECE]]])
            to = to + int(gap[0]) if len(gap) else min(to + PIECE, len(data))
        w = words_in(data[at:to], np.array([0, to - at]))
        yield w, before
        kept = min(SPAN - 1, len(w.start))
        before += len(w.start) - kept
        at, done = at + int(w.start[len(w.start) - kept]) if kept else to, to


class Index:
    """A benchmark held whole: its words, its fingerprints, and for each length its windows by hash."""

    def __init__(self, items: list[tuple[str, str]]) -> None:
        self.names = [name for name, _ in items]
        self.w = w = words(pa.array([t or "" for _, t in items], pa.large_string()))
        self.prints = np.unique(w.grams(K)[winnowed(w, w.grams(K))])
        self.windows = {}
        for n, at in windows(w):
            hashes = w.grams(n)[at]
            order = np.argsort(hashes, kind="stable")
            self.windows[n] = hashes[order], at[order]
        self.item = np.repeat(np.arange(len(items)), np.diff(w.first))
        self.sieves = {n: sieve(x, 1 << LEAST_BITS) for n, x in {0: self.prints, **{n: h for n, (h, _) in self.windows.items()}}.items()}

    def known(self, n: int, x: np.ndarray) -> np.ndarray:
        """Places of the hashes that a fingerprint (n = 0) or a window of n words has."""
        held = self.prints if n == 0 else self.windows[n][0]
        at = np.flatnonzero(self.sieves[n][(x >> np.uint64(64 - LEAST_BITS)).astype(np.int64)])
        return at[held[np.minimum(np.searchsorted(held, x[at]), len(held) - 1)] == x[at]] if len(held) else at[:0]

    def items(self, n: int, hash_: np.uint64, text: bytes) -> tuple:
        """Names of the items that have this window, compared as text."""
        hashes, at = self.windows[n]
        a, b = np.searchsorted(hashes, hash_), np.searchsorted(hashes, hash_, "right")
        return tuple({self.names[self.item[i]] for i in at[a:b].tolist() if self.w.text(i, n) == text})


def sieve(hashes: np.ndarray, size: int) -> np.ndarray:
    bits = np.zeros(size, bool)
    bits[(hashes >> np.uint64(64 - (size.bit_length() - 1))).astype(np.int64)] = True
    return bits


def windows(w: Words) -> list[tuple[int, np.ndarray]]:
    """Of each text the first words of its windows, by length: all of SPAN words, or the whole of a shorter text."""
    sizes, found = np.diff(w.first), []
    for n in np.unique(np.minimum(sizes, SPAN)).tolist():
        if n == SPAN:
            starts = [np.arange(a, a + k - SPAN + 1) for a, k in zip(w.first[:-1].tolist(), sizes.tolist(), strict=True) if k >= SPAN]
            found.append((n, np.concatenate(starts)))
        elif n:
            found.append((n, w.first[:-1][sizes == n]))
    return found


def hits(w: Words, lengths: list[int], known: Callable) -> Iterator[tuple[int, int, np.uint64]]:
    """(first word, length, hash) of the runs of words that `known` may have: known(n, hashes) gives the places of those it has."""
    for n in lengths:
        if len(w.hash) < n:
            continue
        if n == SPAN:
            grams = w.grams(K)
            at = winnowed(w, grams)
            at = at[known(0, grams[at])]
            near = np.unique((at[:, None] - np.arange(SPAN - K + 1)[None, :]).ravel())  # extend each hit to the windows around it
            near = near[(near >= 0) & (near + SPAN <= len(w.hash))]
            full = np.zeros(len(near), np.uint64)
            for i in range(SPAN):
                full = full * _STEP + w.hash[near + i]
            full = _mixed(full)
            own = known(n, full)
            at, full = near[own], full[own]
        else:
            full = w.grams(n)
            at = known(n, full)
            full = full[at]
        doc = np.searchsorted(w.first, at, "right") - 1
        inside = at + n <= w.first[doc + 1]
        yield from zip(at[inside].tolist(), [n] * int(inside.sum()), full[inside], strict=True)


def benchmark_rows(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    return benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text")).where("item is not null and text is not null")


def contamination(docs: DataFrame, benchmark: DataFrame, carry: list[str], text: str = "text", item_id: str = "item_id") -> DataFrame:
    """`carry` and n_words, n_hit, spans (hit words as [from, to) ranges) and items (ids as text, sorted).

    Item rows without an id or a text are ignored; an id that repeats has all its texts' windows.
    """
    index = held(benchmark, text, item_id)
    if index is None:
        return by_shuffle(docs, benchmark, carry, text, item_id)
    return annotate(docs, text, carry, FOUND.fields, lambda: lambda texts: matched(index.value, texts))


FOUND = T.StructType([T.StructField("n_words", T.LongType(), False), T.StructField("n_hit", T.LongType(), False), T.StructField("spans", T.ArrayType(T.LongType(), False), False), T.StructField("items", T.ArrayType(T.StringType(), False), False)])


def held(benchmark: DataFrame, text: str, item_id: str):
    """The broadcast index; None if the benchmark is too large for one."""
    rows = benchmark_rows(benchmark, item_id, text)
    if (rows.agg(F.sum(F.octet_length("text") + F.octet_length("item") + 64)).first()[0] or 0) > BROADCAST_BYTES:
        return None
    return benchmark.sparkSession.sparkContext.broadcast(Index([(r[0], r[1]) for r in rows.collect()]))


def merged(spans: list[tuple[int, int]]) -> tuple[list[int], int]:
    """Sorted, disjoint ranges as one list, and how many words they hold."""
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out, sum(out[1::2]) - sum(out[::2])


def matched(index: Index, texts: pa.Array) -> list[list]:
    spans: list[list] = [[] for _ in range(len(texts))]
    items: list[set] = [set() for _ in range(len(texts))]
    n_words = np.zeros(len(texts), np.int64)
    for w, before in pieces(texts):
        n_words[: len(w.first) - 1] = before + np.diff(w.first)
        seen: dict[bytes, tuple] = {}
        for i, n, hash_ in hits(w, list(index.windows), index.known):
            window = w.text(i, n)
            names = seen.get(window)
            if names is None:
                names = seen[window] = index.items(n, hash_, window)
            if names:
                doc = int(np.searchsorted(w.first, i, "right")) - 1
                at = before + i - int(w.first[doc])
                spans[doc].append((at, at + n))
                items[doc].update(names)
    flat = [merged(x) for x in spans]
    return [n_words, [n for _, n in flat], [x for x, _ in flat], [sorted(x) for x in items]]


def by_shuffle(docs: DataFrame, benchmark: DataFrame, carry: list[str], text: str, item_id: str) -> DataFrame:
    """The same for a benchmark of any size."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)

    def cut(batches):
        for batch in batches:
            for part, texts in slices(batch, "text"):
                w, names = words(texts), part.column(part.schema.get_field_index("item")).to_pylist()
                kinds = [(0, w.grams(K)[winnowed(w, w.grams(K))], None, None)]
                for n, at in windows(w):
                    owner = (np.searchsorted(w.first, at, "right") - 1).tolist()
                    kinds.append((n, w.grams(n)[at], [w.text(i, n).decode() for i in at.tolist()], [names[i] for i in owner]))
                for n, hashes, own, items in kinds:
                    none = pa.nulls(len(hashes), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hashes), n, np.int32)), pa.array(hashes.view(np.int64)), pa.array(own, pa.string()) if own else none, pa.array(items, pa.string()) if items else none], names=["n", "hash", "window", "item"])

    cuts = scratch.write(benchmark_rows(benchmark, item_id, text).mapInArrow(cut, "n int, hash long, window string, item string"))
    lengths = sorted(r.n for r in cuts.where("n > 0").select("n").distinct().collect())
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * cuts.count()).bit_length()))
    slot = F.shiftrightunsigned("hash", 64 - bits)
    # at most 2^MOST_BITS bits, 64 in a row, come to the driver
    filled = cuts.select(F.shiftright(slot, 6).alias("at"), F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int")).alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(1 << bits >> 6, np.int64)
    table[filled.column("at").to_numpy()] = filled.column("bits").to_numpy()
    shared = spark.sparkContext.broadcast(np.unpackbits(table.view(np.uint8), bitorder="little") if bits == LEAST_BITS else table)

    def make():
        packed = shared.value

        def known(_: int, x: np.ndarray) -> np.ndarray:
            at = (x >> np.uint64(64 - bits)).astype(np.int64)
            return np.flatnonzero(packed[at] if packed.dtype == np.uint8 else packed[at >> 6] >> (at & 63) & 1)

        def work(texts: pa.Array) -> list:
            n_words, found = np.zeros(len(texts), np.int64), [[] for _ in range(len(texts))]
            for w, before in pieces(texts):
                n_words[: len(w.first) - 1] = before + np.diff(w.first)
                for i, n, _ in hits(w, lengths, known):
                    doc = int(np.searchsorted(w.first, i, "right")) - 1
                    found[doc].append({"at": before + i - int(w.first[doc]), "n": n, "window": w.text(i, n).decode()})
            return [n_words, found]

        return work

    fields = [T.StructField("n_words", T.LongType(), False), T.StructField("__may", T.ArrayType(T.StructType.fromDDL("at long, n int, window string"), False), False)]
    rows = scratch.write(annotate(docs, text, carry, fields, make).withColumn("__row", F.monotonically_increasing_id()))
    may = rows.select("__row", F.explode("__may").alias("x")).select("__row", "x.*").distinct()
    total = may.count()
    items = cuts.where("n > 0").groupBy("window").agg(F.collect_set("item").alias("items"))
    sure = labelled(may, items.join(may.groupBy("window").agg(F.count("*").alias("rows")), "window"), "window", total, scratch)

    def merge(batches):
        for batch in batches:
            flat = [merged([(x["at"], x["at"] + x["n"]) for x in own]) for own in batch.column(1).to_pylist()]
            items = [sorted({x for one in own for x in one}) for own in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for _, n in flat], pa.int64()), pa.array([x for x, _ in flat], pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))], names=["__row", "n_hit", "spans", "items"])

    found = sure.groupBy("__row").agg(F.collect_list(F.struct("at", "n")).alias("own"), F.collect_set("items").alias("all")).mapInArrow(merge, T.StructType([T.StructField("__row", T.LongType()), *FOUND.fields[1:]]))
    free = rows.where(F.size("__may") == 0).select(*carry, "n_words", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<long>").alias("spans"), F.array().cast("array<string>").alias("items"))
    hit = rows.where(F.size("__may") > 0).join(found, "__row", "left")
    none = {"n_hit": F.lit(0).cast("long"), "spans": F.array().cast("array<long>"), "items": F.array().cast("array<string>")}
    return free.unionByName(hit.select(*carry, "n_words", *[F.coalesce(x, y).alias(x) for x, y in none.items()]))


def is_contaminated(n_hit, n_words):
    """The rule: some word is hit, and at least one in twenty."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """The rows of docs that aren't contaminated, whole."""
    index = held(benchmark, text, item_id)
    if index is None:
        rows = docs.select(F.struct(*docs.columns).alias("__doc"), F.col(text).alias("__text"))
        rows = by_shuffle(rows, benchmark.withColumnRenamed(text, "__text"), ["__doc"], "__text", item_id)
        return rows.where(~is_contaminated(F.col("n_hit"), F.col("n_words"))).select("__doc.*")

    def make():
        def work(texts: pa.Array) -> np.ndarray:
            n, hit, _, _ = matched(index.value, texts)
            return ~is_contaminated(np.array(hit), n)

        return work

    return keep_rows(docs, text, make)
