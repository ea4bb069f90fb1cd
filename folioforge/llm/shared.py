"""What the operators of this subpackage share: tables, materialised steps and Arrow batches."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Documents are handled in slices of about so many bytes, so that memory doesn't follow the batch.
SLICE_BYTES = 1 << 18
#: Rows and bytes that go to a Python worker at once (a longer row goes alone).
BATCH_ROWS, BATCH_BYTES = 1000, 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept away from learning: crc32 of the id's text modulo 4 is 2 (null: of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    On a cluster it must be named in spark.checkpoint.dir; only a local session gets one of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    spark.conf.set("spark.checkpoint.dir", made := "file://" + tempfile.mkdtemp(prefix="folioforge-"))
    return made


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark deletes each query's shuffle files when the query ends, not when the driver's garbage is collected."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


_scopes: list[list[Scratch]] = []


@contextmanager
def temporary() -> Iterator[None]:
    """On leaving, deletes all scratch tables made inside: for results that have been written by then."""
    made: list[Scratch] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        for scratch in made:
            scratch.clear()


class Scratch:
    """Parquet tables in the shared folder: a step written once is read back with no lineage behind it.

    `group`: bytes of a row group, which tasks hold while they write or read one (Parquet's default: 128 MB).
    """

    def __init__(self, spark: SparkSession, group: int | None = None) -> None:
        self.spark, self.group = spark, group
        self.root = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
        self.made = 0
        if _scopes:
            _scopes[-1].append(self)

    def write(self, df: DataFrame) -> DataFrame:
        self.made += 1
        path = f"{self.root}/{self.made:04d}"
        writer = df.write if self.group is None else df.write.option("parquet.block.size", self.group)
        with swept(self.spark):
            writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *dfs: DataFrame) -> None:
        """Deletes tables that nothing reads any more."""
        for df in dfs:
            for file in df.inputFiles()[:1]:
                self._delete(self.spark._jvm.org.apache.hadoop.fs.Path(file).getParent())

    def clear(self) -> None:
        self._delete(self.spark._jvm.org.apache.hadoop.fs.Path(self.root))

    def _delete(self, path) -> None:
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def strings(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The column as one array of large strings, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def byte_view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of large strings without copying, and the len + 1 offsets into them."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    low = int(offsets[0]) if len(offsets) else 0
    return whole[low : int(offsets[-1])] if len(texts) else whole[:0], offsets - low


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Runs of whole rows with about `most` bytes of text each (a longer text comes alone)."""
    texts = strings(batch.column(batch.schema.get_field_index(text)))
    if not len(texts):
        return
    _, offsets = byte_view(texts)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        to = min(to, len(texts))
        yield batch.slice(at, to - at), texts.slice(at, to - at)
        at = to


def small_batches(spark: SparkSession) -> None:
    """Lets Arrow batches have BATCH_ROWS rows and about BATCH_BYTES bytes, unless the session's settings were changed.

    Both sides hold a batch of texts at once, and the JVM keeps the memory of its largest batches, in a pool for each
    of twice as many threads as there are cores.
    """
    for name, default, value in (("maxRecordsPerBatch", "10000", BATCH_ROWS), ("maxBytesPerBatch", "67108864b", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        if spark.conf.get(name, None) == default:
            spark.conf.set(name, str(value))


_kept: dict[object, object] = {}
_asked = False


def kept(key: object, make: Callable[[], object]) -> object:
    """What `make` gives, kept in this Python worker while its tasks ask for it; there is one such thing at a time."""
    global _asked
    _asked = True
    if key not in _kept:
        if _kept:
            _kept.clear()
            give_back()  # else what comes is made beside what goes
        _kept[key] = make()
    return _kept[key]


def started(make: Callable[[], Callable]) -> Callable:
    """make()'s function; what earlier tasks of this worker kept goes unless it is asked for again."""
    global _asked
    _asked = False
    work = make()
    if not _asked:
        _kept.clear()
    give_back()
    return work


def give_back() -> None:
    """Returns freed memory to the system: workers live on, and other stages' tasks need it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def annotate(df: DataFrame, text: str, carry: list[str], fields: list[T.StructField], make: Callable[[], Callable]) -> DataFrame:
    """The `carry` columns and, computed from the text of each row, the new `fields`.

    `make` is called once in each task and returns a function from an array of texts to one list or array per field.
    Rows keep their partition; there is no shuffle.
    """
    if len({*carry, *(f.name for f in fields)}) < len(carry) + len(fields):
        raise ValueError(f"columns clash: {carry} and {[f.name for f in fields]}")
    small_batches(df.sparkSession)
    schema = T.StructType([*(f for name in carry for f in df.schema.fields if f.name == name), *fields])
    narrow = df.select(*dict.fromkeys([*carry, text]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = started(make)
        target = None
        for batch in batches:
            for part, texts in slices(batch, text):
                if target is None:
                    from pyspark.sql.pandas.types import to_arrow_type

                    target = [to_arrow_type(f.dataType) for f in fields]
                new = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(work(texts), target, strict=True)]
                kept = [part.column(part.schema.get_field_index(name)) for name in carry]
                yield pa.RecordBatch.from_arrays([*kept, *new], names=[*carry, *(f.name for f in fields)])
                del part, texts, new, kept
        batch = None
        give_back()

    return narrow.mapInArrow(run, schema)


def keep_rows(df: DataFrame, text: str, make: Callable[[], Callable]) -> DataFrame:
    """Rows, whole and with all their columns, whose text passes; `make()` gives a function from texts to booleans."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = started(make)
        for batch in batches:
            for part, texts in slices(batch, text):
                yield part.filter(pa.array(np.asarray(work(texts), bool)))
                del part, texts
        batch = None
        give_back()

    return df.mapInArrow(run, df.schema)
