"""Tables every operator of this folder reads and writes, and words in bulk."""
from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from panelwise.session import write_and_read

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Largest piece of text, in bytes, that is held as arrays of numbers at a time (a longer document is its own piece).
PIECE_BYTES = 2 << 20
#: Partitions of a shuffle whose results are written to one file.
MERGED = 8
_STEP = 1 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: list[np.ndarray] = []


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is its check, absent where SQL cannot express the result."""

    def add(func: Query) -> Query:
        QUERIES[name] = func
        if sql is not None:
            SQL[name] = sql
        return func

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def merged(df: DataFrame) -> DataFrame:
    """``df``, the result of a shuffle, in an eighth of the shuffle's partitions, four for each core at least.

    A file costs about as much time as the few thousand rows that such a partition often holds; the number still grows
    with the partitions that the session is given for larger tables. A task works on its partitions one after another.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fewer = max(-(-partitions // MERGED), 4 * spark.sparkContext.defaultParallelism)
    return df.coalesce(fewer) if fewer < partitions else df


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back. The shuffle files of the finished phase are given up: Spark
    deletes them once the driver has collected the plans that own them, which would otherwise happen late or never."""
    spark = df.sparkSession
    out = write_and_read(df, name)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return out


def _powers() -> list[np.ndarray]:
    if not _POWERS:
        for base in (0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)):
            p = np.full(_STEP + 1, base, dtype=np.uint64)
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash of two, in this order."""
    return mix(a * np.uint64(0xD6E8FEB86659FD93) + mix(b + np.uint64(0x9E3779B97F4A7C15)))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text", size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``size`` bytes of text, one row at least."""
    if not batch.num_rows:
        return
    _, offsets = buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each text the number of the first word (one more at the end)."""
    solid = ~_SPACE[raw]
    begins = offsets[:-1][offsets[:-1] < len(raw)]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    first[begins] = solid[begins]
    last[:-1] &= ~solid[1:]
    inner = begins[begins > 0]
    last[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; it depends on these bytes alone."""
    out = np.empty(len(starts), dtype=np.uint64)
    if not len(starts):
        return out
    up, down = _powers()
    long = np.flatnonzero(ends - starts > _STEP)
    cuts = np.unique(np.concatenate([[0], long, long + 1, [len(starts)]]))
    for a, b in zip(cuts[:-1], cuts[1:]):
        if ends[a] - starts[a] > _STEP:
            out[a] = xxhash.xxh64_intdigest(raw[starts[a] : ends[a]].tobytes())
            continue
        while a < b:
            to = max(a + 1, int(np.searchsorted(ends[:b], starts[a] + _STEP, side="right")))
            s, e = starts[a:to] - starts[a], ends[a:to] - starts[a]
            sums = np.zeros(e[-1] + 1, dtype=np.uint64)
            np.cumsum((raw[starts[a] : ends[to - 1]].astype(np.uint64) + np.uint64(1)) * up[: e[-1]], out=sums[1:])
            out[a:to] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
            a = to
    return out


def hashed_words(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text (split at the bytes 9-13 and 32), and where each text's words begin."""
    raw, offsets = buffers(column)
    if lower:
        raw = _LOWER[raw]
    starts, ends, begins = word_spans(raw, offsets)
    return hash_spans(raw, starts, ends), begins


def lower_bytes(raw: np.ndarray) -> np.ndarray:
    """A-Z to a-z; other bytes stay."""
    return _LOWER[raw]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
