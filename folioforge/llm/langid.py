"""Language identification by prediction by partial matching (PPM).

Each language has a byte context tree of variable order (0 to ORDER bytes). A byte b after a context of which N
occurrences with q distinct successors were seen has probability n_b / (N + q) if it was seen n_b times there, else the
escape probability q / (N + q) times its probability after the next shorter context; below order 0 all 256 bytes are
alike (escape method C). The statistics are frozen after learning, so the code length of every (deepest context, byte)
is a fixed number, and a text's exact code length under each language is a sum of them, taken with numpy for many bytes
at once. The trees of all languages are flattened into one table of code lengths if it takes at most TABLE_BYTES; else
each tree is kept as what it has seen, with escape costs, and is walked down from the deepest context. The language with
the shortest code wins; the score is its posterior probability under equal priors.

Text is folded first: lower case, and every byte of ASCII that isn't a letter counts as a space, of a run of which
only the first is coded. Nulls and texts without a letter are `und` with score 0. Rows with a null lang aren't learned
from. With no labelled row at all every text is `und`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import annotate, byte_view, held_out, keep_rows, slices, small_batches

ORDER = 3
#: Bytes of text learned from per language, and of all languages; rows are drawn by a hash of their id, whole, at least one of each.
SAMPLE_BYTES, SAMPLED = 3_000_000, 90_000_000
#: Bytes up to which the trees are one table; text bytes whose code is taken at once (each takes about 100 bytes meanwhile).
TABLE_BYTES, PIECE = 64 << 20, 1 << 17
#: Languages a model may have; more is an error, not a silent cut.
MOST_LANGUAGES = 256

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[97:123] = True


@dataclass
class Model:
    """One table of code lengths."""

    languages: list[str]
    symbols: np.ndarray  # of each byte its symbol; 0: never seen
    deepest: np.ndarray  # of three symbols the row of the deepest context known
    bits: np.ndarray  # [row, symbol, language]: code length

    def cost(self, four: np.ndarray) -> np.ndarray:
        """[byte, language]: the last byte's code length after the three before it, of four bytes in one number."""
        size = self.bits.shape[1]
        a, b, c, d = (self.symbols[four >> s & 255] for s in (24, 16, 8, 0))
        return self.bits[self.deepest[(a * size + b) * size + c], d]


@dataclass
class Trees:
    """Of each language and order, deepest first: contexts with escape costs, and contexts with a byte and its cost."""

    languages: list[str]
    levels: list[list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]]

    def cost(self, four: np.ndarray) -> np.ndarray:
        out = np.zeros((len(four), len(self.levels)), np.float32)
        for i, levels in enumerate(self.levels):
            left = np.arange(len(four))
            for order, (contexts, escape, keys, bits) in zip(range(ORDER, -1, -1), levels, strict=True):
                x = four[left] & (1 << 8 * (order + 1)) - 1
                at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
                seen = keys[at] == x
                out[left[seen], i] += bits[at[seen]]
                left, x = left[~seen], x[~seen] >> 8
                at = np.minimum(np.searchsorted(contexts, x), len(contexts) - 1)
                known = contexts[at] == x
                out[left[known], i] += escape[at[known]]
            out[left, i] += 8
        return out


def fold(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = byte_view(pc.utf8_lower(texts))
    return _FOLD[data], offsets


def _grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Four folded bytes in one number for each coded byte (before a text stand spaces), and how often."""
    data, offsets = fold(texts)
    keys = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        x = np.concatenate((np.full(3, 32, np.uint8), data[a:b])).astype(np.uint32)
        key = x[:-3] << 24 | x[1:-2] << 16 | x[2:-1] << 8 | x[3:]
        keys.append(key[(x[3:] != 32) | (x[2:-1] != 32)])
    return np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.uint32), np.zeros(0, np.int64))


def _count(batches):
    for batch in batches:
        for part, texts in slices(batch, "text"):
            lang = part.column(part.schema.get_field_index("lang"))
            for one in pc.unique(lang).to_pylist():
                key, n = _grams(texts.filter(pc.equal(lang, one)))
                yield pa.RecordBatch.from_arrays([pa.array([one] * len(key), pa.string()), pa.array(key.astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "key", "n"])


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Model | Trees | None:
    """Learns from labelled rows that aren't held out, up to SAMPLE_BYTES of text per language (all of it if less)."""
    small_batches(docs.sparkSession)
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & ~held_out(F.col(doc_id))).select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    drawn = F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(1 << 20))
    sizes = rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes"), F.min(drawn).alias("first")).limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not sizes:
        return None
    most, share = F.lit(None).cast("double"), min(SAMPLE_BYTES, SAMPLED // len(sizes))
    for row in sizes:
        most = F.when(F.col("lang") == row["lang"], F.lit(max(float(row["first"]), float(1 << 20) * share / max(row["bytes"], 1)))).otherwise(most)
    counted = rows.where(drawn <= most).select("text", "lang").mapInArrow(_count, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n")).toPandas()
    if not len(counted):
        return None
    return build({name: (part["key"].to_numpy(np.int64), part["n"].to_numpy(np.float64)) for name, part in counted.groupby("lang")})


def trees(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Trees:
    """The trees from each language's counts of four-byte sequences."""
    levels = []
    for name in sorted(counts):
        four, n = counts[name]
        own = []
        for order in range(ORDER, -1, -1):
            keys, at = np.unique(four & (1 << 8 * (order + 1)) - 1, return_inverse=True)
            seen = np.bincount(at, n, len(keys))
            contexts, at = np.unique(keys >> 8, return_inverse=True)
            kinds = np.bincount(at, minlength=len(contexts))
            total = np.bincount(at, seen, len(contexts)) + kinds
            own.append((contexts, -np.log2(kinds / total), keys, -np.log2(seen / total[at])))
        levels.append(own)
    return Trees(sorted(counts), levels)


def build(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model | Trees:
    """The model from each language's counts of four-byte sequences; languages without any are left out."""
    counts = {name: x for name, x in counts.items() if len(x[0])}
    names = sorted(counts)
    seen = len(set().union(*(np.unique(k >> s & 255).tolist() for k, _ in counts.values() for s in (0, 8, 16, 24)), {32})) + 1
    contexts = len(np.unique(np.concatenate([k >> 8 for k, _ in counts.values()])))
    if 4 * len(names) * seen * (seen**2 + contexts) + 4 * seen**3 > TABLE_BYTES:
        return trees(counts)
    seen = np.unique(np.concatenate([np.concatenate([counts[x][0] >> s & 255 for s in (0, 8, 16, 24)]) for x in names] + [np.array([32])]))
    symbols = np.zeros(256, np.int64)
    symbols[seen] = np.arange(1, len(seen) + 1)
    size, langs = len(seen) + 1, len(names)
    four = {x: (symbols[k >> 24 & 255], symbols[k >> 16 & 255], symbols[k >> 8 & 255], symbols[k & 255], n) for x, (k, n) in counts.items()}
    contexts = np.unique(np.concatenate([(a * size + b) * size + c for a, b, c, _, _ in four.values()]))
    deepest = np.tile(np.arange(size * size, dtype=np.int32), size)
    deepest[contexts] = size * size + np.arange(len(contexts), dtype=np.int32)
    bits = np.empty((size * size + len(contexts), size, langs), np.float32)

    def mixed(table: np.ndarray, shorter: np.ndarray) -> np.ndarray:
        total, kinds = table.sum(-1, keepdims=True), (table > 0).sum(-1, keepdims=True)
        most = np.maximum(total + kinds, 1)
        return np.where(total == 0, shorter, np.where(table > 0, table / most, kinds / most * shorter))

    for i, x in enumerate(names):
        a, b, c, d, n = four[x]
        zero = np.bincount(d, n, size)
        one = np.bincount(c * size + d, n, size**2).reshape(size, size)
        two = np.bincount((b * size + c) * size + d, n, size**3).reshape(size, size, size)
        p0 = mixed(zero, np.full(size, 1 / 256))
        p2 = mixed(two, mixed(one, p0[None, :])[None, :, :]).reshape(size * size, size)
        row = np.searchsorted(contexts, (a * size + b) * size + c)
        three = np.bincount(row * size + d, n, len(contexts) * size).reshape(-1, size)
        bits[: size * size, :, i] = -np.log2(p2)
        bits[size * size :, :, i] = -np.log2(mixed(three, p2[contexts % (size * size)]))
    return Model(names, symbols.astype(np.int32), deepest, bits)


def code_lengths(model: Model | Trees, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: bits under each language, bytes coded, and whether it has an ASCII letter. Long texts are read in pieces."""
    data, offsets = fold(texts)
    n = len(texts)
    total, count, letters = np.zeros((n, len(model.languages))), np.zeros(n, np.int64), np.zeros(n, bool)
    low = 0
    while low < len(data):
        # cut between texts where it can be, so that a text's sums don't depend on what stands beside it
        to = int(offsets[np.searchsorted(offsets, low + PIECE, "right") - 1])
        at = np.arange(low, to if to > low else min(low + PIECE, len(data)))
        low += len(at)
        doc = np.searchsorted(offsets, at, "right") - 1
        letters[doc[_ASCII_LETTER[data[at]]]] = True
        # three spaces stand before each text
        before = [np.where(at - k >= offsets[doc], data[np.maximum(at - k, 0)], 32).astype(np.int64) for k in (1, 2, 3)]
        coded = (data[at] != 32) | (before[0] != 32)
        cost = model.cost((before[2] << 24 | before[1] << 16 | before[0] << 8 | data[at])[coded])
        doc = doc[coded]
        count += np.bincount(doc, minlength=n)
        for i in range(cost.shape[1]):
            total[:, i] += np.bincount(doc, cost[:, i], n)
    return total, count, letters


def predict(docs: DataFrame, model: Model | Trees | None, carry: list[str], text: str = "text") -> DataFrame:
    """`carry`, lang_pred, score and bits_per_byte (of the best language; null for `und`)."""
    fields = [T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False), T.StructField("bits_per_byte", T.DoubleType(), True)]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return annotate(docs, text, carry, fields, lambda: lambda texts: judged(shared.value, texts))


def judged(model: Model | Trees | None, texts: pa.Array) -> list[list]:
    if model is None:
        return [["und"] * len(texts), [0.0] * len(texts), [None] * len(texts)]
    total, count, letters = code_lengths(model, texts)
    best = total.argmin(1)
    least = total[np.arange(len(best)), best]
    score = 1 / np.exp2(-np.minimum(total - least[:, None], 1000)).sum(1)
    letters = lettered(letters, texts)
    return [
        [model.languages[k] if ok else "und" for k, ok in zip(best, letters, strict=True)],
        np.where(letters, score, 0.0),
        [b / c if ok else None for b, c, ok in zip(least.tolist(), count.tolist(), letters, strict=True)],
    ]


def lettered(ascii_letters: np.ndarray, texts: pa.Array) -> np.ndarray:
    found = ascii_letters.copy()
    for i in np.flatnonzero(~found):
        found[i] = any(map(str.isalpha, texts[int(i)].as_py()))
    return found


#: A text whose best code takes more bits for each coded byte than this, and SLACK bits besides, is in none of the learned
#: languages. On sf0.1 texts of a language left out of learning take 4.0 to 7.3 (99 % of each), held-out ones of learned
#: languages at most 3.1.
FOREIGN_BITS, SLACK = 4.0, 160


def is_foreign(model: Model | Trees | None, texts: pa.Array) -> np.ndarray:
    """Whether a text is in no learned language: it has no letter, or its best code is too long."""
    if model is None:
        return np.ones(len(texts), bool)
    total, count, letters = code_lengths(model, texts)
    return ~lettered(letters, texts) | (total.min(1) > FOREIGN_BITS * count + SLACK)


def drop_foreign(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """The rows in a learned language."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, text, lang, doc_id))
    return keep_rows(docs, text, lambda: lambda texts: ~is_foreign(model.value, texts))
