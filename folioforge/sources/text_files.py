"""Trees of text files in several encodings."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Encodings in the order in which they are tried, for the two places that read files.
MANIFEST_ENCODINGS = ("utf-8-sig", "utf-8", "cp1251", "cp866", "latin-1")
PAGE_ENCODINGS = ("utf-8", "utf-8-sig", "cp1251")


#: Bytes of a file read at once.
BLOCK = 1 << 20
#: What the file scan yields, for a stream to be told.
BINARY = "path string, modificationTime timestamp, length bigint, content binary"


def scan(spark: SparkSession, lib_root: str, folder: str = "OCR_TXT", with_content: bool = True) -> DataFrame:
    """(txt_rel, txt_abs, size_bytes, content) of every .txt file below lib_root/folder. Spark's file sources pass over empty files."""
    return _named(_source(spark.read).load(f"{lib_root.rstrip('/')}/{folder}"), folder, with_content)


def listed(spark: SparkSession, lib_root: str, folder: str = "OCR_TXT") -> DataFrame:
    """(txt_rel, txt_abs, size_bytes, uri) of the same files, of any size: none is opened."""
    files = _source(spark.read).load(f"{lib_root.rstrip('/')}/{folder}")
    return _named(files, folder, False, uri=True)


def hashed(files: DataFrame, uri: str = "uri") -> DataFrame:
    """files with content_sha1, read in blocks where the task runs, so that neither a row nor a task holds a file. Null if it can't be read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [_sha1(x) for x in batch.column(batch.schema.get_field_index(uri)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=[*batch.schema.names, "content_sha1"])

    return files.mapInArrow(run, T.StructType([*files.schema.fields, T.StructField("content_sha1", T.StringType())]))


def _sha1(uri: str | None) -> str | None:
    if uri is None:
        return None
    local = uri.removeprefix("file:") if uri.startswith("file:") else None
    try:
        system, path = (fs.LocalFileSystem(), "/" + unquote(local).lstrip("/")) if local is not None else fs.FileSystem.from_uri(uri)
        digest = hashlib.sha1()
        with system.open_input_stream(path, compression=None) as stream:
            while block := stream.read(BLOCK):
                digest.update(block)
    except OSError:
        return None
    return digest.hexdigest()


def scan_stream(spark: SparkSession, lib_root: str, folder: str = "OCR_TXT", files_per_trigger: int | None = None) -> DataFrame:
    """The same rows as a stream: each run takes the files that its checkpoint doesn't know."""
    reader = _source(spark.readStream).schema(BINARY)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return _named(reader.load(f"{lib_root.rstrip('/')}/{folder}"), folder, True)


def _source(reader):
    return reader.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[tT][xX][tT]")


def _named(files: DataFrame, folder: str, with_content: bool, uri: bool = False) -> DataFrame:
    path = F.regexp_replace("path", "^[a-z][a-z0-9+.-]*:(?://(?=/))?", "")
    at = F.instr(path, f"/{folder}/")
    return files.select(F.substr(path, at + 1).alias("txt_rel"), path.alias("txt_abs"), F.col("length").alias("size_bytes"), *(["content"] if with_content else []), *([F.col("path").alias("uri")] if uri else []))


@F.pandas_udf(T.StringType())
def _decode_manifest(content: pd.Series) -> pd.Series:
    return content.map(lambda b: _first(b, MANIFEST_ENCODINGS))


@F.pandas_udf(T.StringType())
def _decode_pages(content: pd.Series) -> pd.Series:
    return content.map(lambda b: _first(b, PAGE_ENCODINGS))


def _first(content: bytes | None, encodings: tuple[str, ...]) -> str | None:
    if content is None:
        return None
    for name in encodings:
        try:
            return bytes(content).decode(name)
        except UnicodeDecodeError:
            pass
    return bytes(content).decode("utf-8", "ignore")


def decoded(content: Column, for_pages: bool = False) -> Column:
    """The text of a file, line feeds only. UTF-8 is decoded natively; only other bytes meet Python.

    For the manifest a byte order mark goes, for pages it stays.
    """
    valid = F.is_valid_utf8(content.cast("string"))
    native = content.cast("string")
    if not for_pages:
        native = F.regexp_replace(native, "^\ufeff", "")
    other = F.when(~valid, content)  # Python sees null for what is valid
    text = F.when(valid, native).otherwise((_decode_pages if for_pages else _decode_manifest)(other))
    return F.regexp_replace(text, "\r\n?", "\n")
