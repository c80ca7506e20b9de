"""What the training-data operators share: text columns, durable intermediate tables, hashing of words and shingles."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.durable import durable, shared_dir, tidy
from tidemark.session import ship

__all__ = ["durable", "shared_dir"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The bytes 0x20 and 0x09 to 0x0D, which part words.
SPACE = b" \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Texts of ASCII alone take the fast built-in."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


class Scratch:
    """Parquet tables in the shared folder for one operator's run, for what is too large for row-wise checkpoints."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.folder = spark, f"{shared_dir(spark).rstrip('/')}/tidemark-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        with tidy(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that nothing will read again; without names, all of them."""
        jvm = self.spark.sparkContext._jvm
        for name in names or ("",):
            path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}".rstrip("/"))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def small_side(df: DataFrame, limit_rows: int) -> DataFrame:
    """df with a broadcast hint if it is proven to hold limit_rows rows at most; else df, for a shuffled join. df should be cheap to count."""
    return F.broadcast(df) if df.limit(limit_rows + 1).count() <= limit_rows else df


# -- Python on the executors

#: Rows of an Arrow batch: whole texts, so a batch of Spark's default of 10,000 rows would hold tens of megabytes at both ends.
BATCH_ROWS = 1000
_RESIDENT: dict[tuple, object] = {}


def resident(key: tuple, make: Callable):
    """What a worker process keeps from one task to the next: one model, until another kind of work needs the memory."""
    if key not in _RESIDENT:
        _RESIDENT.clear()
        _RESIDENT[key] = make()
    return _RESIDENT[key]


def trim() -> None:
    """Give free memory back to the system: workers live on between tasks, beside other workers of the executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def mapped(df: DataFrame, run: Callable, schema: str | StructType, keeps: bool = False) -> DataFrame:
    """df.mapInArrow in tasks that hold small batches and leave no memory behind. keeps: run uses the resident model."""
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def lean(batches):
        if not keeps and _RESIDENT:
            _RESIDENT.clear()
            trim()
        try:
            yield from run(batches)
        finally:
            trim()

    return df.mapInArrow(lean, schema)


# -- hashing of words, for whole Arrow batches at once ------------------------------------------------

MASK = (1 << 64) - 1
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACE)] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of text that are hashed at once, which bounds the memory of a task whatever the texts' lengths add up to.
BLOCK_BYTES = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words that spreads every bit (the finaliser of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=1)
def _byte_codes() -> np.ndarray:
    return mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _STEP)


@lru_cache(maxsize=4)
def _powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, 0xD6E8FEB86659FD93, np.uint64)]))


def word_hashes(texts: list[bytes], fold: bool = True, places: bool = False) -> tuple[np.ndarray, ...]:
    """64-bit hashes of the words `[^\\x20\\x09-\\x0D]+` of the texts, A-Z lower-cased if fold, and where each text's words start (len(texts) + 1 offsets);
    with places also where each word begins in the texts joined by line ends."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    if fold:
        data = _FOLD[data]
    space = _IS_SPACE[data]
    ends = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    if not space[0]:
        starts = np.concatenate([[0], np.flatnonzero(space[:-1] & ~space[1:]) + 1])
    else:
        starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    text_ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    offsets = np.concatenate([[0], np.searchsorted(starts, text_ends)])
    if not len(starts):
        return (np.zeros(0, np.uint64), offsets, starts) if places else (np.zeros(0, np.uint64), offsets)
    lengths = ends - starts
    inside = ~space
    at = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    longest = int(lengths.max())
    codes = _byte_codes()[data[inside]] * _powers(1 << max(6, (longest - 1).bit_length()))[at]
    hashes = mix(np.add.reduceat(codes, np.cumsum(lengths) - lengths) + lengths.astype(np.uint64) * _STEP)
    return (hashes, offsets, starts) if places else (hashes, offsets)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-word shingles; of fewer words, one of the whole sequence; of none, none. Repeats stay."""
    n = len(words)
    if not n:
        return words
    width = min(k, n)
    got = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        got = got * np.uint64(0xD1B54A32D192ED03) + words[i : n - width + 1 + i]
    return mix(got)


def blocks(ids: list, texts: list[bytes | None]) -> list[tuple[list, list[bytes]]]:
    """Rows in blocks of about BLOCK_BYTES of text; null texts are empty."""
    out, mine, own, size = [], [], [], 0
    for i, text in zip(ids, texts, strict=True):
        data = text or b""
        if own and size + len(data) > BLOCK_BYTES:
            out.append((mine, own))
            mine, own, size = [], [], 0
        mine.append(i)
        own.append(data)
        size += len(data)
    if own:
        out.append((mine, own))
    return out


def text_blocks(batches):
    """(ids, texts as bytes) blocks of Arrow batches whose first two columns are an id and a text."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            yield from blocks(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist())


def whole_groups(batches, key: str, rows: int = 4096):
    """Tables of about `rows` rows of batches sorted by `key`, with all rows of each key in one table."""
    held, n = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = table.column(key).to_numpy()
        last = int(np.searchsorted(keys == keys[-1], True))
        if last:
            yield table.slice(0, last)
            table = pa.Table.from_batches(table.slice(last).to_batches())
        held, n = table.to_batches(), table.num_rows
        rows = max(rows, 2 * n)  # a long group isn't put together again for every batch
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """An Arrow list column of arrays."""
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
