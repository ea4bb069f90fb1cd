"""Document fingerprints by a homomorphic multiset hash, with DataFrame functions only.

A document is the multiset of its paragraphs (lines that aren't empty). Every paragraph is hashed to a wide vector and
a document's fingerprint is the sum of its paragraphs' vectors, each lane modulo a power of two. So it doesn't depend
on their order, equal texts have equal fingerprints, and paragraphs are inserted or deleted by adding or subtracting
their vectors (`combine`).

A paragraph's vector has two parts. Four lanes of 32 bits, cut from two 64-bit hashes of the paragraph, tell equality.
The others tell likeness: the paragraph's runs of three words each have a 64-bit hash, and lane i counts the runs with
bit i set. These 64 lanes, and the number of runs, are kept modulo 2^32 each, two lanes in one number, and no lane
carries into another: a Spark string has fewer than 2^31 runs, and `combine` adds lane by lane. With n runs a lane's
bias is 2 * count - n, and the cosine of two documents' biases estimates that of their multisets of word runs; below 0
counts as 0.

A null text is empty. Empty documents have the zero fingerprint and are wholly like each other and unlike any other.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Numbers with two lanes each; runs counted in lanes of 8 bits (7 in the highest) before these are widened.
NUMBERS, NARROW = 32, 127
_BYTES, _PAIR = 0x0101010101010101, 0x000000FF000000FF
_WORD = (1 << 32) - 1
#: Bytes of text in a stretch of neighbouring documents; stretches at most; rows sampled for their borders.
STRETCH_BYTES, STRETCHES, SAMPLED = 8 << 20, 200_000, 400_000
#: Stretches in a task, about.
TOGETHER = 4


def vector(text: Column) -> Column:
    """The fingerprint as an array of numbers: 4 equality lanes, the number of runs, 32 pairs of likeness lanes."""
    paragraphs = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda p: p != "")
    zero = F.lit(0).cast("long")

    def exact(p: Column) -> list[Column]:
        one, two = F.xxhash64(p), F.xxhash64(F.lit(7), p)
        return [one.bitwiseAND(_WORD), F.shiftrightunsigned(one, 32), two.bitwiseAND(_WORD), F.shiftrightunsigned(two, 32)]

    lanes = F.aggregate(
        F.transform(paragraphs, lambda p: F.struct(*[x.alias(f"e{i}") for i, x in enumerate(exact(p))])),
        F.struct(*[zero.alias(f"e{i}") for i in range(4)]),
        lambda acc, x: F.struct(*[(acc[f"e{i}"] + x[f"e{i}"]).bitwiseAND(_WORD).alias(f"e{i}") for i in range(4)]),
        lambda acc: F.array(*[acc[f"e{i}"] for i in range(4)]),
    )
    runs = F.flatten(F.transform(F.transform(paragraphs, lambda p: F.split(p, " ")), lambda ws: F.transform(ws, lambda w, i: F.xxhash64(w, F.get(ws, i + 1), F.get(ws, i + 2)))))
    # so few runs at once that bytes don't overflow: eight lanes of a number at one addition
    narrow = lambda part: F.aggregate(
        part,
        F.struct(*[zero.alias(f"c{s}") for s in range(8)]),
        lambda acc, h: F.struct(*[(acc[f"c{s}"] + F.shiftrightunsigned(h, s).bitwiseAND(_BYTES)).alias(f"c{s}") for s in range(8)]),
    )
    # whichever of the arrays is wanted is made once: transform binds the runs to a variable
    counts = F.transform(
        F.array(runs),
        lambda hs: F.concat(
            F.array(F.size(hs).cast("long")),
            F.aggregate(
                F.transform(F.sequence(F.lit(0), F.floor(F.size(hs) / NARROW).cast("int")), lambda i: narrow(F.slice(hs, i * NARROW + 1, NARROW))),
                F.struct(*[zero.alias(f"w{i}") for i in range(NUMBERS)]),
                lambda acc, c: F.struct(*[(acc[f"w{4 * s + k}"] + F.shiftrightunsigned(c[f"c{s}"], 8 * k).bitwiseAND(_PAIR)).alias(f"w{4 * s + k}") for s in range(8) for k in range(4)]),
                lambda acc: F.array(*[acc[f"w{i}"] for i in range(NUMBERS)]),
            ),
        ),
    )[0]
    return F.concat(lanes, counts)


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint of two texts' paragraphs together (sign 1), or of a's without b's (sign -1)."""
    low = lambda x: x.bitwiseAND(_WORD)
    high = lambda x: F.shiftrightunsigned(x, 32)
    return F.zip_with(a, b, lambda x, y: low(low(x) + sign * low(y)).bitwiseOR(F.shiftleft(low(high(x) + sign * high(y)), 32)))


def hexed(v: Column) -> Column:
    """The fingerprint as text: 8 hex digits for each of the first five numbers, 16 for the others."""
    return F.lower(F.concat(*[F.lpad(F.hex(v[i]), 8, "0") for i in range(5)], F.array_join(F.transform(F.slice(v, 6, NUMBERS), lambda x: F.lpad(F.hex(x), 16, "0")), "")))


def biases(v: Column) -> Column:
    """Of a fingerprint the 64 lanes' biases."""
    numbers = F.slice(v, 6, NUMBERS)
    return F.flatten(F.transform(numbers, lambda x: F.transform(F.array(x.bitwiseAND(_WORD), F.shiftrightunsigned(x, 32)), lambda c: (2 * c - v[4]).cast("double"))))


def likeness(v: Column, w: Column, bv: Column, bw: Column) -> Column:
    """0 to 1, from two fingerprints and their biases."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, t: s + t)
    norm = F.sqrt(dot(bv, bv) * dot(bw, bw))
    return F.when(v == w, 1.0).when((v[4] == 0) | (w[4] == 0) | (norm == 0), 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), dot(bv, bw) / norm)))


def borders(keys: DataFrame, parts: int, rows: int) -> list:
    """Up to parts - 1 keys (id, hash, row) that cut the rows into stretches of about as many bytes.

    They come from a sample of about SAMPLED rows, as those of any range sort do, and decide only which task gets a row.
    """
    drawn = F.pmod(F.xxhash64("id", "hash", "row"), F.lit(1 << 40)) < int((1 << 40) * min(1.0, SAMPLED / max(rows, 1)))
    sample = sorted(keys.where(drawn).collect(), key=lambda r: (r.id is not None, r.id if r.id is not None else 0, r.hash, r.row))
    share, held, cuts = sum(r.bytes for r in sample) / parts, 0, []
    for r in sample:
        if held >= share * (len(cuts) + 1):
            cuts.append({"id": r.id, "hash": r.hash, "row": r.row})
        held += r.bytes
    return cuts


def neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, vector, next_text, next_vector): each document and the next by ascending id; after the last comes the first.

    Null ids stand first; equal ids in order of their texts' hashes, so that an id that many rows have is cut as well, and
    rows equal in id and text by their place in the input. Ids are integers or strings (of strings in byte order); others
    raise a TypeError. The rows are cut into stretches of about STRETCH_BYTES (more if there were over STRETCHES of them);
    the first document of each stretch also goes, as a ghost, to the end of the stretch before. So there is one shuffle.
    """
    kind = docs.schema[doc_id].dataType
    if not isinstance(kind, (T.IntegralType, T.StringType)):
        raise TypeError(f"ids must be integers or strings, not {kind.simpleString()}")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("place"))
    key = F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"), F.xxhash64("place").alias("row"))
    rows = rows.withColumn("key", key).drop("place")
    spark = docs.sparkSession
    keys = rows.select("key.*", (F.octet_length("text") + 64).cast("long").alias("bytes"))
    n, total = keys.agg(F.count("*"), F.sum("bytes")).first()
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = min(STRETCHES, max(TOGETHER * shuffled, (total or 0) // STRETCH_BYTES))
    cuts = borders(keys, parts, n)
    side = max(1, round(len(cuts) ** 0.5))
    fields = f"array<struct<id:{kind.simpleString()},hash:bigint,row:bigint>>"

    def literal(value: list, schema: str) -> Column:
        return F.from_json(F.lit(json.dumps(value)), schema)

    table = [cuts[i : i + side] for i in range(0, len(cuts), side)]
    block = F.size(F.filter(literal([b[-1] for b in table], fields), lambda x: x <= F.col("key")))
    inside = F.coalesce(F.get(literal(table, f"array<{fields}>"), F.col("block")), F.array().cast(fields))
    rows = rows.withColumn("block", block).withColumn("stretch", F.col("block") * side + F.size(F.filter(inside, lambda x: x <= F.col("key")))).drop("block")
    # at most STRETCHES rows come to the driver: of each stretch the first id and hash
    firsts = {r.stretch: {"id": r.first.id, "hash": r.first.hash} for r in rows.groupBy("stretch").agg(F.min(F.struct("key.id", "key.hash")).alias("first")).collect()}
    order = sorted(firsts)
    before = {s: order[i - 1] for i, s in enumerate(order)}
    known = [{"before": before[s], **firsts[s]} if s in firsts else None for s in range(order[-1] + 1 if order else 0)]
    at = F.get(literal(known, f"array<struct<before:int,id:{kind.simpleString()},hash:bigint>>"), F.col("stretch"))
    rows = rows.withColumn("at", at)
    is_first = F.struct("at.id", "at.hash") == F.struct("key.id", "key.hash")
    own = F.struct(F.col("stretch"), F.lit(False).alias("ghost"), F.lit(False).alias("wraps"))
    ghost = F.struct(F.col("at.before").alias("stretch"), F.lit(True).alias("ghost"), (F.col("stretch") == (order[0] if order else 0)).alias("wraps"))
    placed = rows.select("doc_id", "text", "key", F.explode(F.when(is_first, F.array(own, ghost)).otherwise(F.array(own))).alias("to")).select("doc_id", "text", F.col("key.hash").alias("hash"), "to.*")
    # ghosts carry a text as long as any; they are as few as the stretches, but for equal rows
    placed = placed.repartition(max(shuffled, len(order) // TOGETHER), "stretch").withColumn("vector", vector(F.col("text")))
    window = Window.partitionBy("stretch").orderBy("wraps", F.asc_nulls_first("doc_id"), "hash", "text", "ghost")
    following = F.lead(F.struct("text", "vector")).over(window)
    return placed.withColumn("next", following).where(~F.col("ghost")).select("doc_id", "text", "vector", F.col("next.text").alias("next_text"), F.col("next.vector").alias("next_vector"))


def edited(text: Column, other: Column) -> Column:
    """The text with its last floor(n/2) characters replaced by the first as many (or all) of the other."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.length(text) - half), F.substr(other, F.lit(1), half))
