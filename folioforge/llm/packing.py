"""Token-id output: documents packed into matrices of fixed width.

Each text becomes token ids and one end-of-text id. Documents longer than a row are cut into pieces of a row's width
(nothing is lost: piece numbers tell how to join them); pieces are placed by best fit decreasing: longest first, each
into the fullest row that still has room, found by a segment tree over free widths. Packing runs in blocks of about
BLOCK_TOKENS tokens of neighbouring rows, so it needs no shuffle, bounded memory, and a lost task is simply run again
on the same rows.

A row has ids (little-endian unsigned 32-bit, padded to the width with the end-of-text id), the cumulative segment
lengths (starting with 0), the places where positions restart, and of each segment its document and its first token's
number in that document. Nulls and empty texts are a lone end-of-text id. Documents without an id keep a null id.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import slices

WIDTH = 2048
BLOCK_TOKENS = 2_000_000
SCHEMA = "n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, doc_ids array<long>, starts array<long>"


class Rooms:
    """Rows by free width; `fit(n)` finds the smallest free width of at least n by a segment tree over widths."""

    def __init__(self, width: int) -> None:
        self.size = 1 << width.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(width + 1)]

    def add(self, free: int, row: int) -> None:
        self.rows[free].append(row)
        self._change(free, 1)

    def take(self, free: int) -> int:
        self._change(free, -1)
        return self.rows[free].pop()

    def _change(self, free: int, by: int) -> None:
        at = free + self.size
        while at:
            self.count[at] += by
            at >>= 1

    def fit(self, n: int) -> int:
        """The smallest free width of at least n that some row has; -1: none."""
        count, at = self.count, n + self.size
        if count[at]:
            return n
        while at > 1:
            if not at & 1 and count[at + 1]:  # the nearest subtree to the right that isn't empty
                at += 1
                while at < self.size:
                    at = 2 * at if count[2 * at] else 2 * at + 1
                return at - self.size
            at >>= 1
        return -1


def best_fit(lengths: list[int], width: int) -> list[list[int]]:
    """Rows of piece numbers; pieces of equal length keep their order."""
    rooms, rows = Rooms(width), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        free = rooms.fit(lengths[i])
        row = len(rows) if free < 0 else rooms.take(free)
        if free < 0:
            rows.append([])
            free = width
        rows[row].append(i)
        rooms.add(free - lengths[i], row)
    return rows


@lru_cache(1)
def encoder(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), len(ranks)


def pack(docs: DataFrame, vocabulary: str, width: int = WIDTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Packed rows of SCHEMA. The end-of-text id is the first one above the vocabulary."""
    if width < 1:
        raise ValueError("width must be positive")

    def block(pieces: list[tuple]) -> pa.RecordBatch:
        out: list[list] = [[] for _ in range(6)]
        for row in best_fit([len(x[0]) for x in pieces], width):
            ids = np.full(width, pieces[row[0]][3], "<u4")
            edges = np.concatenate(([0], np.cumsum([len(pieces[i][0]) for i in row]))).tolist()
            for i, a, b in zip(row, edges, edges[1:], strict=False):
                ids[a:b] = pieces[i][0]
            for x, value in zip(out, (edges[-1], ids.tobytes(), edges, edges[:-1], [pieces[i][1] for i in row], [pieces[i][2] for i in row]), strict=True):
                x.append(value)
        types = [pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types, strict=True)], names=["n_tokens", "ids", "cu_seqlens", "position_resets", "doc_ids", "starts"])

    def run(batches):
        own, end = encoder(vocabulary)
        pieces, tokens = [], 0
        for batch in batches:
            for part, texts in slices(batch, text):
                for doc, x in zip(part.column(part.schema.get_field_index(doc_id)).to_pylist(), texts.to_pylist(), strict=True):
                    ids = np.array([*own.encode_ordinary(x), end], "<u4")
                    for at in range(0, len(ids), width):
                        pieces.append((ids[at : at + width], doc, at, end))
                    tokens += len(ids)
                if tokens >= BLOCK_TOKENS:
                    yield block(pieces)
                    pieces, tokens = [], 0
        if pieces:
            yield block(pieces)

    return docs.select(F.col(doc_id).cast("long").alias(doc_id), text).mapInArrow(run, SCHEMA)


def write(packed: DataFrame, path: str) -> None:
    """Writes the packed rows as Parquet in a folder that all executors reach."""
    packed.write.mode("errorifexists").parquet(path)
