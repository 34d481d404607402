"""Synthetic minority rows: each lies between a minority row and one of its nearest minority neighbours.

Equal rows are one point with a count, so copies cost nothing; ``cells`` finds the neighbours of the points.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwise.operators.cells import CELL, nearest_points
from panelwise.operators.ranking import running_totals
from panelwise.operators.skew import col
from panelwise.operators.splits import SEED
from panelwise.session import write_and_read

NEIGHBOURS = 5
_CHUNK = 10_000  # synthetic rows made from one row of the plan


def points_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct points (pid, x, copies, upto), numbered from 1 in the order of their coordinates; ``upto`` counts the rows so
    far. Stored, so that numbers stay the same wherever they are read."""
    copies = df.groupBy(*[col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)]).agg(F.count(F.lit(1)).alias("copies"))
    x = F.array(*[F.col(f"x{i}") for i in range(len(columns))])
    counted = copies.select(x.alias("x"), "copies", F.lit(1).cast("bigint").alias("one"))
    ranked = running_totals(counted, {"pid": "one", "upto": "copies"}, "x")
    return write_and_read(ranked.select("pid", "x", "copies", "upto"), "points")


def neighbours(points: DataFrame, columns: int, k: int = NEIGHBOURS, cell: int = CELL) -> DataFrame:
    """Points with ``near``: their k nearest other points, exact."""
    found = nearest_points(points, columns, k, cell)
    return points.join(found, "pid")


def _slots(k: int) -> Column:
    """Coordinates of the k nearest rows: own copies first, then each neighbour as often as it has copies."""
    own = F.array_repeat(F.col("x"), F.least(F.col("copies") - 1, F.lit(k)).cast("int"))
    others = F.flatten(F.transform("near", lambda n: F.array_repeat(n["x"], F.least(n["copies"], F.lit(k)).cast("int"))))
    return F.slice(F.concat(own, others), 1, k)


def oversample(df: DataFrame, columns: Sequence[str], label: str, k: int = NEIGHBOURS, seed: int = SEED) -> DataFrame:
    """``columns`` and ``label`` of all rows, plus as many synthetic minority rows as make both classes equal.

    Every minority row is the base of the same number of synthetic rows (one more for the first of the order where
    it does not divide); rows with a missing value are no base and no neighbour. Neighbour and place on the way to it come from a hash of row, number and seed.
    """
    counts = {r[0]: r[1] for r in df.groupBy(col(label)).count().collect()}
    data = df.select(*[col(c).cast("double").alias(c) for c in columns], col(label))
    if len(counts) < 2 or len(set(counts.values())) == 1:
        return data
    minority = min(counts, key=counts.get)
    whole = col(label) == minority
    for c in columns:
        whole = whole & col(c).isNotNull() & ~F.isnan(col(c).cast("double"))
    small = df.filter(whole).count()
    if small < 2:
        raise ValueError("the minority class needs at least two rows without missing values")
    missing = max(counts.values()) - counts[minority]
    each, more = divmod(missing, small)
    known = neighbours(points_of(df.filter(whole), columns), len(columns), k)
    before = F.col("upto") - F.col("copies")
    extra = F.greatest(F.least(F.col("upto"), F.lit(more)) - F.least(before, F.lit(more)), F.lit(0))
    wanted = known.select("pid", "x", _slots(k).alias("slots"), (F.col("copies") * each + extra).cast("bigint").alias("wanted"))
    chunks = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("wanted") - 1) / _CHUNK)))
    spread = wanted.filter("wanted > 0").select("*", chunks.alias("chunk"))
    # A point of many copies has many chunks; they go to different tasks.
    spread = spread.repartition(F.col("pid"), F.col("chunk"))
    first, last = F.col("chunk") * _CHUNK, F.least((F.col("chunk") + 1) * _CHUNK, F.col("wanted")) - 1
    made = spread.select("pid", "x", "slots", F.explode(F.sequence(first, last)).alias("number"))
    digest = F.md5(F.concat_ws("|", "pid", "number", F.lit(str(seed))))
    pick = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.size("slots")
    way = F.conv(F.substring(digest, 9, 8), 16, 10).cast("double") / F.lit(float(2**32))
    made = made.select("x", F.element_at("slots", (pick + 1).cast("int")).alias("to"), way.alias("way"))
    point = made.select(F.zip_with("x", "to", lambda a, b: F.struct(a.alias("a"), b.alias("b"))).alias("pairs"), "way")
    place = lambda i: F.col("pairs")[i]["a"] + F.col("way") * (F.col("pairs")[i]["b"] - F.col("pairs")[i]["a"])
    synthetic = point.select(*[place(i).alias(c) for i, c in enumerate(columns)], F.lit(minority).cast(df.schema[label].dataType).alias(label))
    return data.unionByName(synthetic)
