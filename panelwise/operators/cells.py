"""Exact nearest neighbours in a table of points, by a tree of cells.

A balanced tree over a sample cuts space into cells. Every cell is searched in its own task first, through small leaves
with boxes; a point's k-th distance there bounds its neighbours, and it only asks the other cells whose boxes that
distance reaches. Leaves are skipped by the same rule, so a row is compared with few points whatever their number.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwise.session import write_and_read

#: Points of a cell, and the most cells there are; beyond that cells have more points.
CELL, CELLS = 20_000, 4096
#: Sample points per cell that the tree is fitted on: at most ``CELLS`` times as many reach the driver.
SAMPLE = 32
#: Points of a leaf, and rows that search together.
LEAF = 8
#: Rows that ask one cell in a task; a cell that more rows ask is read by several.
ASKS = 100_000
#: Widens bounds by far more than the rounding of distances.
_SLACK = 1 + 1e-9

_NEAR = "array<struct<d:double,pid:bigint,copies:bigint,x:array<double>>>"
_NEAR_TYPE = pa.list_(pa.struct([("d", pa.float64()), ("pid", pa.int64()), ("copies", pa.int64()), ("x", pa.list_(pa.float64()))]))


def fit_tree(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(dimension, cut) of the nodes of a complete tree: the median along the widest dimension of a node's points."""
    nodes = (1 << depth) - 1
    dims, cuts = np.zeros(nodes, dtype=np.int64), np.full(nodes, np.inf)
    held = {0: sample}
    for i in range(nodes):
        x = held.pop(i, sample[:0])
        if len(x) > 1 and (np.ptp(x, axis=0) > 0).any():
            dims[i] = int(np.ptp(x, axis=0).argmax())
            values = np.unique(x[:, dims[i]])
            cuts[i] = values[min(np.searchsorted(values, np.median(x[:, dims[i]])), len(values) - 2)]
        right = x[:, dims[i]] > cuts[i] if len(x) else np.zeros(0, dtype=bool)
        held[2 * i + 1], held[2 * i + 2] = x[~right], x[right]
    return dims, cuts


def cell_of(x: np.ndarray, dims: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    at = np.zeros(len(x), dtype=np.int64)
    for _ in range((len(dims) + 1).bit_length() - 1):
        at = 2 * at + 1 + (x[np.arange(len(x)), dims[at]] > cuts[at])
    return at - len(dims)


class Leaves:
    """Points in leaves of at most ``LEAF``, each with its box."""

    def __init__(self, x: np.ndarray) -> None:
        parts, todo = [], [np.arange(len(x))] if len(x) else []
        while todo:
            ids = todo.pop()
            if len(ids) <= LEAF:
                parts.append(ids)
                continue
            along = x[ids, int(np.ptp(x[ids], axis=0).argmax())]
            order = np.argpartition(along, len(ids) // 2)
            todo += [ids[order[: len(ids) // 2]], ids[order[len(ids) // 2 :]]]
        self.parts = parts
        self.low = np.array([x[p].min(axis=0) for p in parts]).reshape(len(parts), x.shape[1])
        self.high = np.array([x[p].max(axis=0) for p in parts]).reshape(len(parts), x.shape[1])

    def gaps(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Distance from a box to each leaf."""
        gap = np.maximum(np.maximum(self.low - high, low - self.high), 0.0)
        return np.sqrt((gap * gap).sum(axis=1))


def nearest(x: np.ndarray, pid: np.ndarray, rows: np.ndarray, own: np.ndarray, bound: np.ndarray, k: int, leaves: Leaves | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row the k nearest points within its bound other than itself: (distance, place in ``x`` or -1, compared points).

    Equal distances are settled by ``pid``.
    """
    leaves = leaves or Leaves(x)
    best, place = np.full((len(rows), k), np.inf), np.full((len(rows), k), -1)
    compared = np.zeros(len(rows), dtype=np.int64)
    ids = np.append(pid, np.iinfo(np.int64).max)  # -1 is the last
    for group in Leaves(rows).parts:
        q = rows[group]
        gaps = leaves.gaps(q.min(axis=0), q.max(axis=0))
        order = np.argsort(gaps, kind="stable")
        at, step = 0, 8
        while at < len(order):
            reach = float(np.minimum(best[group, -1], bound[group]).max()) * _SLACK
            some = order[at : at + step]
            some = some[gaps[some] <= reach]
            if not len(some):
                break
            among = np.concatenate([leaves.parts[i] for i in some])
            d = np.sqrt(((q[:, None, :] - x[None, among, :]) ** 2).sum(axis=2))
            d[(own[group, None] == pid[None, among]) | (d > bound[group, None] * _SLACK)] = np.inf
            both = np.concatenate([best[group], d], axis=1)
            where = np.concatenate([place[group], np.broadcast_to(among, d.shape)], axis=1)
            where[np.isinf(both)] = -1
            top = np.lexsort((ids[where], both), axis=1)[:, :k]
            best[group], place[group] = np.take_along_axis(both, top, axis=1), np.take_along_axis(where, top, axis=1)
            compared[group] += len(among)
            at += step
            step = min(2 * step, 64)
    return best, place, compared


def _lists(best: np.ndarray, place: np.ndarray, pid: np.ndarray, copies: np.ndarray, x: np.ndarray) -> pa.Array:
    kept = place >= 0
    flat = place[kept]
    coordinates = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * x.shape[1], pa.int32()), pa.array(x[flat].ravel()))
    rows = pa.StructArray.from_arrays([pa.array(best[kept]), pa.array(pid[flat]), pa.array(copies[flat]), coordinates], names=["d", "pid", "copies", "x"])
    ends = np.concatenate([[0], np.cumsum(kept.sum(axis=1))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows).cast(_NEAR_TYPE)


def needed(best: np.ndarray, place: np.ndarray, own: np.ndarray, copies: np.ndarray, k: int) -> np.ndarray:
    """Distance up to which neighbours must be known: the other copies of a row come first, then its neighbours."""
    found = np.where(place >= 0, copies[np.maximum(place, 0)] if len(copies) else 0, 0)
    total = (own - 1)[:, None] + np.cumsum(found, axis=1)
    enough = total >= k
    out = np.where(enough.any(axis=1), np.take_along_axis(best, enough.argmax(axis=1)[:, None], axis=1)[:, 0], np.inf)
    return np.where(own - 1 >= k, 0.0, out)


def _coordinates(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def nearest_points(points: DataFrame, dim: int, k: int, cell: int = CELL) -> DataFrame:
    """(pid, near, compared) for each of ``points`` (pid, x, copies; distinct x of ``dim`` numbers).

    ``near`` has the k nearest other points, nearest first (ties by pid), exact; only as many are exact as the row's copies
    and theirs leave open of k. ``compared`` counts the points a row was compared with.
    """
    total = points.count()
    depth = max(0, min(CELLS, -(-total // cell)) - 1).bit_length()
    wanted = SAMPLE << depth
    part = min(1.0, 4.0 * wanted / max(total, 1))
    sample = points.select("x").where(F.xxhash64("pid") % 1_000_000 < int(part * 1_000_000) if part < 1 else F.lit(True)).limit(4 * wanted).collect() if depth else []
    dims, cuts = fit_tree(np.array([r[0] for r in sample], dtype=np.float64).reshape(-1, dim), depth)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("pid", "x", "copies")], pa.array(cell_of(_coordinates(b.column("x"), dim), dims, cuts))], names=["pid", "x", "copies", "cell"])

    placed = write_and_read(points.select("pid", "x", "copies").mapInArrow(assign, "pid bigint, x array<double>, copies bigint, cell bigint"), "cells")

    def at_home(rows: pa.Table) -> pa.Table:
        x, pid, copies = _coordinates(rows.column("x"), dim), rows.column("pid").to_numpy(), rows.column("copies").to_numpy()
        best, place, compared = nearest(x, pid, x, pid, np.full(len(x), np.inf), k)
        return pa.table({"pid": pid, "x": rows.column("x"), "cell": rows.column("cell"), "near": _lists(best, place, pid, copies, x), "needed": needed(best, place, copies, copies, k), "compared": compared})

    home = write_and_read(placed.groupBy("cell").applyInArrow(at_home, f"pid bigint, x array<double>, cell bigint, near {_NEAR}, needed double, compared bigint"), "neighbours-at-home")
    if not depth:
        return home.select("pid", "near", "compared")

    sides = [f(F.col("x")[i]).alias(f"{n}{i}") for n, f in (("low", F.min), ("high", F.max)) for i in range(dim)]
    boxes = placed.groupBy("cell").agg(*sides).orderBy("cell").collect()  # CELLS rows at most
    names = np.array([b["cell"] for b in boxes])
    low, high = (np.array([[b[f"{n}{i}"] for i in range(dim)] for b in boxes]).reshape(len(boxes), dim) for n in ("low", "high"))

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                x, far = _coordinates(b.column("x"), dim), b.column("needed").to_numpy()
                gap = np.maximum(np.maximum(low[None] - x[:, None], x[:, None] - high[None]), 0.0)
                asked = np.sqrt((gap * gap).sum(axis=2)) <= far[:, None] * _SLACK
                asked &= (names[None] != b.column("cell").to_numpy()[:, None]) & (far > 0)[:, None]
                row, box = np.nonzero(asked)
                yield pa.RecordBatch.from_arrays([pa.array(names[box]), b.column("pid").take(pa.array(row)), b.column("x").take(pa.array(row)), pa.array(far[row])], names=["cell", "pid", "x", "needed"])

    asks = write_and_read(home.select("pid", "x", "cell", "needed").mapInArrow(reach, "cell bigint, pid bigint, x array<double>, needed double"), "asks")
    turns = {r["cell"]: 1 + r["count"] // ASKS for r in asks.groupBy("cell").count().collect()}  # CELLS rows at most
    if not turns:
        return home.select("pid", "near", "compared")
    of_cell = F.element_at(F.create_map(*[F.lit(v) for c, t in turns.items() if t > 1 for v in (c, t)]), F.col("cell")) if any(t > 1 for t in turns.values()) else F.lit(None).cast("bigint")
    turn = F.coalesce(of_cell.cast("bigint"), F.lit(1).cast("bigint"))
    held = placed.where(F.col("cell").isin(list(turns))) if len(turns) < 1000 else placed
    held = held.select("cell", F.explode(F.sequence(F.lit(0).cast("bigint"), turn - 1)).alias("turn"), F.lit(0).alias("kind"), "pid", "x", "copies", F.lit(0.0).alias("needed"))
    asking = asks.select("cell", F.pmod(F.xxhash64("pid"), turn).alias("turn"), F.lit(1).alias("kind"), "pid", "x", F.lit(0).cast("bigint").alias("copies"), "needed")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows: the points of a cell, which are held, then the rows that ask it, as they come."""
        now, parts, tree = None, [], None
        x = pid = copies = None
        for b in batches:
            keys = np.stack([b.column(c).to_numpy() for c in ("cell", "turn", "kind")], axis=1)
            cuts_ = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]]) if len(keys) else [0]
            for a, z in zip(cuts_[:-1], cuts_[1:]):
                piece = b.slice(a, z - a)
                if tuple(keys[a, :2]) != now:
                    now, parts, tree = tuple(keys[a, :2]), [], None
                if keys[a, 2] == 0:
                    parts.append(piece)
                    continue
                if tree is None:
                    own = pa.Table.from_batches(parts) if parts else piece.slice(0, 0)
                    x, pid, copies = _coordinates(own.column("x"), dim), own.column("pid").to_numpy(), own.column("copies").to_numpy()
                    tree = Leaves(x)
                best, place, compared = nearest(x, pid, _coordinates(piece.column("x"), dim), piece.column("pid").to_numpy(), piece.column("needed").to_numpy(), k, tree)
                yield pa.RecordBatch.from_arrays([piece.column("pid"), _lists(best, place, pid, copies, x), pa.array(compared)], names=["of", "near", "compared"])

    order = ["cell", "turn", "kind"]
    late = held.unionByName(asking).repartition("cell", "turn").sortWithinPartitions(*order).mapInArrow(answer, f"of bigint, near {_NEAR}, compared bigint")
    late = write_and_read(late, "late-neighbours")
    counts = late.groupBy("of").agg(F.sum("compared").alias("_compared"))
    # Spark keeps k rows per point in every task before it shuffles.
    each = late.select("of", F.explode("near").alias("n"))
    best = each.withColumn("_at", F.row_number().over(W.partitionBy("of").orderBy("n.d", "n.pid"))).where(F.col("_at") <= k)
    found = best.groupBy("of").agg(F.collect_list("n").alias("_late")).join(counts, "of", "right")
    joined = home.join(found, home["pid"] == found["of"], "left")
    near = F.slice(F.array_sort(F.concat("near", F.coalesce("_late", F.array().cast(_NEAR)))), 1, k)
    return joined.select("pid", near.alias("near"), (F.col("compared") + F.coalesce("_compared", F.lit(0))).alias("compared"))
