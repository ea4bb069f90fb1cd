"""Quality scores of documents from their passages: attention-based multiple-instance learning.

A text is cut into passages of PASSAGE bytes. Each is encoded: what shapes follow each other (triples of letters by
case, digits, signs of each kind, white space), which words it holds, by hash, and how much it repeats itself. A
layer makes a vector of that; gated attention weighs the passages of a document, and the weighted vector is scored. The
weights are learned from the labels of whole documents alone, on a sample of them that is bounded (SAMPLE_ROWS rows, in
expectation, of SAMPLE_BYTES, drawn by a hash of the id).

A passage is any run of bytes, so a text needs no white space. Of a long text the passages come in blocks, and the
attention's sums run on, so memory doesn't follow the text. Null counts as empty; an empty text is one empty passage.
Without labels of both values the score is the labels' mean (0.5 without any). A row without an id is never learned
from; null labels don't count; of ids that repeat in the labels the highest label holds.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import annotate, byte_view, keep_rows, strings

#: Labelled rows and bytes of their texts learned from at most, in expectation.
SAMPLE_ROWS, SAMPLE_BYTES = 4000, 12_000_000
#: Bytes of a passage, passages handled at once.
PASSAGE, BLOCK = 400, 2048
#: Buckets of shape triples and of words; measures of repetition; width of a passage's vector and of its attention.
SHAPES, WORDS, MEASURES, WIDTH, GATE = 384, 128, 6, 24, 12
FEATURES = SHAPES + WORDS + MEASURES
EPOCHS, AT_ONCE, RATE, DECAY = 24, 64, 0.01, 1e-3
THRESHOLD = 0.3


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept away from learning: crc32 of the id's text modulo 5 is 0 (null: of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _shapes() -> np.ndarray:
    """Classes of bytes: other control characters, white space, line breaks, digits, capitals, small letters, bytes of longer characters, and each sign by itself."""
    kind = np.zeros(256, np.int64)
    kind[[9, 32]], kind[[10, 13]] = 1, 2
    kind[48:58], kind[65:91], kind[97:123], kind[128:] = 3, 4, 5, 6
    signs = [b for b in range(33, 127) if not chr(b).isalnum()]
    kind[signs] = np.arange(7, 7 + len(signs))
    return kind


_KIND = _shapes()
#: What parts words.
_GAP = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def mixed(x: np.ndarray, buckets: int) -> np.ndarray:
    return ((x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % buckets


def encoded(data: np.ndarray) -> np.ndarray:
    """The passages of one text (or of a block of it) as rows of FEATURES numbers."""
    n = max(1, -(-len(data) // PASSAGE))
    out = np.zeros((n, FEATURES), np.float32)
    if not len(data):
        return out
    where = np.arange(len(data)) // PASSAGE
    lengths = np.bincount(where, minlength=n)
    kind = _KIND[data]
    if len(data) > 2:
        # runs of small letters tell nothing by their length; no triple lies in two passages
        triple = (kind[:-2] * 64 + kind[1:-1]) * 64 + kind[2:]
        told = (triple != (5 * 64 + 5) * 64 + 5) & (where[:-2] == where[2:])
        cell = where[:-2][told] * SHAPES + mixed(triple[told], SHAPES)
        out[:, :SHAPES] = np.sqrt(np.bincount(cell, minlength=n * SHAPES).reshape(n, SHAPES) / lengths[:, None])
    gap = _GAP[data]
    starts = np.flatnonzero(~gap & (np.concatenate(([True], gap[:-1])) | (np.arange(len(data)) % PASSAGE == 0)))
    if len(starts):
        place = np.zeros(len(data), np.uint64)
        place[starts[0] :] = np.arange(starts[0], len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
        part = np.where(gap, np.uint64(0), (data.astype(np.uint64) + np.uint64(1)) * (np.uint64(2) * (place * np.uint64(0xD6E8FEB86659FD93)) + np.uint64(0x2545F4914F6CDD1D)))
        hashes = np.add.reduceat(part, starts)
        home = where[starts]
        words = np.bincount(home, minlength=n)
        some = np.maximum(words, 1)
        out[:, SHAPES : SHAPES + WORDS] = np.sqrt(np.bincount(home * WORDS + mixed(hashes, WORDS), minlength=n * WORDS).reshape(n, WORDS) / some[:, None])
        at = SHAPES + WORDS
        for lag in (1, 2, 3):
            again = np.zeros(len(starts), bool)
            again[lag:] = (hashes[lag:] == hashes[:-lag]) & (home[lag:] == home[:-lag])
            out[:, at + lag - 1] = np.bincount(home[again], minlength=n) / some
        order = np.lexsort((hashes, home))
        new = np.ones(len(starts), bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (home[order][1:] != home[order][:-1])
        out[:, at + 3] = np.bincount(home[order][new], minlength=n) / some
        out[:, at + 4] = np.bincount(home, weights=np.add.reduceat((~gap).astype(np.int64), starts), minlength=n) / some / 20
    out[:, -1] = lengths / PASSAGE
    return out


@dataclass
class Model:
    """Weights of the encoder, the gated attention and the score; `mean` is the score where nothing could be learned."""

    mean: float = 0.5
    weights: dict[str, np.ndarray] | None = None

    def vectors(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of passages their vectors and the logarithms of their attention."""
        w = self.weights
        h = np.tanh(x @ w["W"] + w["b"])
        gated = np.tanh(h @ w["V"]) / (1 + np.exp(-(h @ w["U"])))
        return h, gated @ w["a"]

    def blocks(self, data: np.ndarray):
        for at in range(0, max(1, len(data)), PASSAGE * BLOCK):
            yield at, self.vectors(encoded(data[at : at + PASSAGE * BLOCK]))

    def score(self, data: np.ndarray) -> float:
        if self.weights is None:
            return self.mean
        top, total, z = -np.inf, 0.0, 0.0
        for _, (h, e) in self.blocks(data):
            new = max(top, float(e.max()))
            p, old = np.exp(e - new), np.exp(top - new)
            total, z, top = total * old + float(p.sum()), z * old + p @ h, new
        return float(1 / (1 + np.exp(-np.clip(z / total @ self.weights["w"] + self.weights["c"][0], -30, 30))))

    def attention(self, data: np.ndarray) -> np.ndarray:
        """How much each passage counts; they add up to 1."""
        e = np.concatenate([e for _, (_, e) in self.blocks(data)])
        p = np.exp(e - e.max())
        return p / p.sum()


def fit(bags: list[np.ndarray], y: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """Weights by Adam over batches of documents; a document's passages lie together. Both labels weigh the same in all, by the root of their counts."""
    rng = np.random.default_rng(seed)
    w = {
        "W": rng.normal(0, 0.5 / np.sqrt(8), (FEATURES, WIDTH)), "b": np.zeros(WIDTH), "V": rng.normal(0, WIDTH**-0.5, (WIDTH, GATE)), "U": rng.normal(0, WIDTH**-0.5, (WIDTH, GATE)),
        "a": np.zeros(GATE), "w": rng.normal(0, WIDTH**-0.5, WIDTH), "c": np.zeros(1),
    }
    first, second, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    share = np.array([np.mean(y == 0), np.mean(y == 1)])
    weight = (share**-0.5 / (share**0.5).sum())[y.astype(int)]
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), AT_ONCE):
            batch = order[at : at + AT_ONCE]
            x = np.concatenate([bags[i] for i in batch]).astype(float)
            sizes = np.array([len(bags[i]) for i in batch])
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            owner = np.repeat(np.arange(len(batch)), sizes)
            h = np.tanh(x @ w["W"] + w["b"])
            v, u = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
            e = (v * u) @ w["a"]
            p = np.exp(e - np.maximum.reduceat(e, starts)[owner])
            p /= np.add.reduceat(p, starts)[owner]
            z = np.add.reduceat(p[:, None] * h, starts)
            s = 1 / (1 + np.exp(-np.clip(z @ w["w"] + w["c"][0], -30, 30)))
            ds = weight[batch] * (s - y[batch]) / len(batch)
            dz = ds[:, None] * w["w"]
            dp = (dz[owner] * h).sum(1)
            de = p * (dp - np.add.reduceat(p * dp, starts)[owner])
            dvu = de[:, None] * w["a"]
            dv, du = dvu * u * (1 - v * v), dvu * v * u * (1 - u)
            dh = p[:, None] * dz[owner] + dv @ w["V"].T + du @ w["U"].T
            dx = dh * (1 - h * h)
            g = {"W": x.T @ dx, "b": dx.sum(0), "V": h.T @ dv, "U": h.T @ du, "a": (v * u).T @ de, "w": z.T @ ds, "c": np.array([ds.sum()])}
            step += 1
            for k in w:
                first[k] += 0.1 * (g[k] - first[k])
                second[k] += 0.001 * (g[k] ** 2 - second[k])
                w[k] -= RATE * (first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8) + (DECAY * w[k] if k not in "bc" else 0))
    return {k: v.astype(np.float32) for k, v in w.items()}


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality") -> Model:
    """The model of the labelled documents that aren't held out."""
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).where(F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("id"))).groupBy("id").agg(F.max("y").alias("y"))
    # what is counted over all rows is ids and lengths; texts move only for the sample
    sizes = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.octet_length(text), F.lit(0)).alias("bytes")).join(known, "id")
    size = sizes.agg(F.count("*").alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.avg("y").alias("mean"), F.count_distinct("y").alias("kinds")).first()
    if not size["n"]:
        return Model()
    if size["kinds"] < 2:
        return Model(float(min(1, max(0, size["mean"]))))
    part = min(1.0, SAMPLE_ROWS / size["n"], SAMPLE_BYTES / max(1, size["bytes"]))
    chosen = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(part * (1 << 30))
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).where(chosen)
    drawn = rows.join(known.where(chosen), "id").select("id", "text", "y").toArrow().sort_by("id")
    y = np.array([min(1, max(0, x)) for x in drawn.column("y").to_pylist()], float)
    if len(set(y)) < 2:
        return Model(float(min(1, max(0, size["mean"]))))
    data, offsets = byte_view(strings(drawn.column("text")))
    return Model(float(y.mean()), fit([encoded(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], y))


def scores(model: Model, texts: pa.Array) -> np.ndarray:
    data, offsets = byte_view(texts)
    return np.array([model.score(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], float)


def score(docs: DataFrame, model: Model, carry: list[str], text: str = "text") -> DataFrame:
    """`carry` and score (0 to 1, higher: better)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return annotate(docs, text, carry, [T.StructField("score", T.DoubleType(), False)], lambda: lambda texts: [scores(shared.value, texts)])


def passages(docs: DataFrame, model: Model, carry: list[str], text: str = "text") -> DataFrame:
    """`carry` and attention: how much each passage of PASSAGE bytes counts in its document's score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def of(texts: pa.Array) -> list[np.ndarray]:
        data, offsets = byte_view(texts)
        return [shared.value.attention(data[a:b]).tolist() if shared.value.weights is not None else [] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]

    return annotate(docs, text, carry, [T.StructField("attention", T.ArrayType(T.FloatType(), False), False)], lambda: lambda texts: [of(texts)])


def drop_poor(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows that score THRESHOLD or more, whole."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, text, doc_id))
    return keep_rows(docs, text, lambda: lambda texts: scores(shared.value, texts) >= THRESHOLD)
