"""Exact top-k inner products from an impact-ordered index, read score-at-a-time."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from panelwise.session import write_and_read

#: Vectors of an index block; one block of postings and one of queries are in memory at a time.
BLOCK_ROWS = 8192
QUERY_ROWS = 512
#: Lower ends of the quantised impacts, largest first: a posting with |value| at least 16 is in segment 0, and so on.
IMPACTS = (16, 8, 4, 1)
#: Within this bound all partial sums are exact in doubles.
_EXACT = 1 << 20

_ROW = StructType([StructField("row", LongType()), StructField("vec_id", LongType()), StructField("vector", ArrayType(LongType()))])


def _dense(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, ids and a matrix; shorter vectors end in zeros."""
    vectors = batch.column("vector")
    ends = np.asarray(vectors.offsets, dtype=np.int64)
    sizes, flat = np.diff(ends), np.asarray(vectors.flatten(), dtype=np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), dtype=np.int64)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = flat
    return np.asarray(batch.column("row")), np.asarray(batch.column("vec_id")), out


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= size:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=size)
            yield from whole[:-1]
            held = whole[-1:]
            if held[0].num_rows == size:
                yield held.pop()
    if held and sum(b.num_rows for b in held):
        yield from pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=size)


_SEGMENT = "block long, segment int, rows binary, ids binary, width int, starts binary, postings binary, values binary, rest binary"
_QUERIES = "block long, rows binary, ids binary, width int, vectors binary"


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each (block, segment): for each component the postings of that impact, and what is left below it."""
    part = TaskContext.get().partitionId() << 32
    for k, batch in enumerate(_blocks(batches, BLOCK_ROWS)):
        rows, ids, x = _dense(batch)
        out, upper = [], None
        for s, lower in enumerate(IMPACTS):
            held = np.abs(x) >= lower
            if upper is not None:
                held &= np.abs(x) < upper
            where, who = np.nonzero(held.T)  # ordered by component, then by vector
            rest = (np.where(np.abs(x) < lower, x, 0).astype(np.float64) ** 2).sum(axis=1)
            starts = np.searchsorted(where, np.arange(x.shape[1] + 1)).astype(np.int64)
            first = s == 0
            out.append((part + k, s, rows.tobytes() if first else None, ids.tobytes() if first else None, x.shape[1], starts.tobytes(), who.astype(np.int32).tobytes(), x.T[held.T].tobytes(), rest.tobytes()))
            upper = lower
        names = [c.split()[0] for c in _SEGMENT.split(", ")]
        types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), *[pa.binary()] * 4]
        for row in out:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)


def _query_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId() << 32
    for k, batch in enumerate(_blocks(batches, QUERY_ROWS)):
        rows, ids, x = _dense(batch)
        yield pa.RecordBatch.from_arrays(
            [pa.array([part + k], pa.int64()), pa.array([rows.tobytes()]), pa.array([ids.tobytes()]), pa.array([x.shape[1]], pa.int32()), pa.array([x.tobytes()])],
            names=[c.split()[0] for c in _QUERIES.split(", ")],
        )


def search_block(segments: list[dict], queries: np.ndarray, query_rows: np.ndarray, k: int, enough: int = 4) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each query, (its number, ordinals, scores) of its ``k`` best vectors of a block; ties to smaller ids.

    Segments are processed by descending impact. After each, a vector's final score lies within ||query|| times the
    norm of its components that are still unread. Vectors whose upper end is below the k-th best lower end can not be
    members. Reading stops when at most ``enough * k`` vectors may be members, or at the end of the index; those are
    scored exactly and ranked.
    """
    rows, ids = np.frombuffer(segments[0]["rows"], dtype=np.int64), np.frombuffer(segments[0]["ids"], dtype=np.int64)
    n, width = len(rows), max(segments[0]["width"], queries.shape[1])
    large = np.abs(queries).max(initial=0) >= _EXACT
    wide = np.zeros((n, width), dtype=np.int64)
    asked = np.zeros((len(queries), width), dtype=np.int64)
    asked[:, : queries.shape[1]] = queries
    floats, norms = asked.astype(np.float64), np.sqrt((asked.astype(np.float64) ** 2).sum(axis=1))
    own = rows[None, :] == query_rows[:, None]
    sums = np.zeros((len(queries), n))
    open_, members = np.arange(len(queries)), {}
    for at, seg in enumerate(segments):
        starts, values = np.frombuffer(seg["starts"], dtype=np.int64), np.frombuffer(seg["values"], dtype=np.int64)
        who = np.frombuffer(seg["postings"], dtype=np.int32)
        large = large or np.abs(values).max(initial=0) >= _EXACT
        step = np.zeros((width, n))
        dims = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        step[dims, who] = values
        wide[who, dims] = values
        last = at == len(segments) - 1
        if large and not last:
            continue
        if large:
            members.update({int(q): np.flatnonzero(~own[q]) for q in open_})
            break
        sums[open_] += floats[open_] @ step
        slack = norms[open_, None] * np.sqrt(np.frombuffer(seg["rest"], dtype=np.float64))[None, :] * (1 + 1e-9)
        high, low = sums[open_] + slack, sums[open_] - slack
        high[own[open_]] = low[own[open_]] = -np.inf
        if n > k:
            bar = np.partition(low, n - k, axis=1)[:, n - k]
        else:
            bar = np.full(len(open_), -np.inf)
        possible = (high >= bar[:, None] - 1e-6) & ~own[open_]
        ends = last | (possible.sum(axis=1) <= enough * k)
        for q, may in zip(open_[ends], possible[ends]):
            members[int(q)] = np.flatnonzero(may)
        open_ = open_[~ends]
        if not len(open_):
            break
    out = []
    rest = segments[at + 1 :]
    for seg in rest:  # rescoring needs every component
        starts = np.frombuffer(seg["starts"], dtype=np.int64)
        dims = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        wide[np.frombuffer(seg["postings"], dtype=np.int32), dims] = np.frombuffer(seg["values"], dtype=np.int64)
    for q in sorted(members):
        may = members[q]
        scores = wide[may] @ asked[q]
        best = np.lexsort((ids[may], -scores))[:k]
        out.append((q, may[best], scores[best]))
    return out


def _search(k: int):
    names = ["query_row", "query_id", "row", "vec_id", "score"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                asked = np.frombuffer(row["vectors"], dtype=np.int64).reshape(-1, row["width"]) if row["width"] else np.zeros((len(row["query_rows"]) // 8, 0), dtype=np.int64)
                query_rows, query_ids = np.frombuffer(row["query_rows"], dtype=np.int64), np.frombuffer(row["query_ids"], dtype=np.int64)
                segments = sorted(row["segments"], key=lambda s: s["segment"])
                rows, ids = np.frombuffer(segments[0]["rows"], dtype=np.int64), np.frombuffer(segments[0]["ids"], dtype=np.int64)
                found = search_block(segments, asked, query_rows, k)
                size = [len(m) for _, m, _ in found]
                q = np.repeat(np.array([q for q, _, _ in found], dtype=np.int64), size)
                m = np.concatenate([m for _, m, _ in found]) if found else np.zeros(0, dtype=np.int64)
                s = np.concatenate([s for _, _, s in found]) if found else np.zeros(0, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (query_rows[q], query_ids[q], rows[m], ids[m], s)], names=names)

    return search


def quantise(df: DataFrame, id_column: str, vector: str, scale: int = 64) -> DataFrame:
    """(row, vec_id, vector) with floor(scale * x) for each component. Left out: null ids, null vectors, and vectors with
    a null or non-finite component. A component's floor must fit in 28 bits, so that scores fit in a long."""
    x = F.col(vector)
    usable = F.col(id_column).isNotNull() & x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    return df.where(usable).select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("vector"))


def top_k(vectors: DataFrame, is_query, k: int = 20) -> DataFrame:
    """The ``k`` best other rows of each query row: query_id, rank (from 1), vec_id, score.

    ``vectors`` is a result of ``quantise``; ``is_query`` a condition on ``vec_id``. Ties go to the smaller vec_id.
    Repeated ids are separate rows, and each query row gets its own list. Fewer than ``k`` others: all of them. Empty
    vectors score 0, shorter ones count as ending in zeros. Blocks of queries meet blocks of the index by an equi-join on
    groups of index blocks; each meeting keeps k rows per query, and those are ranked together.
    """
    stored = write_and_read(vectors, "vectors")
    index = write_and_read(stored.mapInArrow(_index, _SEGMENT), "impact-index")
    whole = index.groupBy("block").agg(F.collect_list(F.struct(*[c.split()[0] for c in _SEGMENT.split(", ")][1:])).alias("segments"))
    groups = max(1, index.where("segment = 0").count() // 4)
    asked = stored.where(is_query).mapInArrow(_query_blocks, _QUERIES)
    left = whole.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)))
    right = asked.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group"), F.col("rows").alias("query_rows"), F.col("ids").alias("query_ids"), "width", "vectors")
    met = left.join(right, "group").select("segments", "query_rows", "query_ids", "width", "vectors")
    found = met.mapInArrow(_search(k), "query_row long, query_id long, row long, vec_id long, score long")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
