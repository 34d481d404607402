"""Uniform shuffle into shards of exact sizes through a hypergeometric communication matrix."""
from __future__ import annotations

from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwise.session import write_and_read

#: Blocks of partitions; the driver draws one row of the matrix for each, whatever the number of partitions.
BLOCKS = 256
#: Rows that are put in order in one task. A shard with more is ordered in several buckets.
BUCKET_ROWS = 32_768
_PART_BITS = 33  # of monotonically_increasing_id


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` without replacement are good."""
    if draws == 0 or good == 0:
        return 0
    if bad == 0:
        return draws
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, draws))
    total = good + bad  # beyond numpy's range: inversion over 40 standard deviations around the mean
    mean = draws * good / total
    wide = 40 * (mean * (bad / total) * ((total - draws) / (total - 1))) ** 0.5 + 40
    lo, hi = max(0, draws - bad, int(mean - wide)), min(good, draws, int(mean + wide) + 1)
    x = np.arange(lo, hi, dtype=np.float64)
    steps = np.log((good - x) / (x + 1)) + np.log((draws - x) / (bad - draws + x + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.cumsum(np.exp(logs - logs.max()))
    return lo + int(np.searchsorted(weights, rng.random() * weights[-1], side="right"))


def draw_matrix(rng: np.random.Generator, rows: list[int], columns: list[int]) -> np.ndarray:
    """Counts with these row and column sums, as a uniform permutation of all items would give them."""
    left, out = [int(c) for c in columns], np.zeros((len(rows), len(columns)), dtype=np.int64)
    for i, need in enumerate(rows):
        rest = sum(left)
        for j, have in enumerate(left):
            rest -= have
            take = _hypergeometric(rng, have, rest, need)
            out[i, j], left[j], need = take, have - take, need - take
    return out


def shuffle_into_shards(df: DataFrame, shards: int, seed: int = 7, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """All rows of ``df`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard).

    Every assignment of rows to (shard, slot) is equally likely, and the sizes of two shards differ by one row at
    most. Steps: each partition is put into a random order and stored; the counts that go from each partition to each
    shard are drawn; a partition's first rows go to shard 0, the next to shard 1, and so on; each shard is put into a
    random order again, in buckets of about ``bucket_rows`` rows. Rows are told apart by their place in the stored
    table, so repeated rows, nulls and a key that owns a third of all rows change nothing. No rows: no rows. Columns
    ``shard`` and ``slot`` of ``df``, if any, are replaced.
    """
    rows = df.select(F.struct(*[c for c in df.columns if c.lower() not in ("shard", "slot")]).alias("row"))
    stored = write_and_read(rows.withColumn("order", F.rand(seed)).sortWithinPartitions("order").select("row", F.monotonically_increasing_id().alias("place")), "sharding")
    part = F.shiftright("place", _PART_BITS)
    counts = stored.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    blocks = {r["block"]: r["n"] for r in counts.groupBy(F.pmod("part", F.lit(BLOCKS)).alias("block")).agg(F.sum("n").alias("n")).collect()}  # 256 rows at most
    total = sum(blocks.values())
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    keys = sorted(blocks)
    drawn = draw_matrix(np.random.default_rng(seed), [blocks[b] for b in keys], sizes)
    share = {int(b): drawn[i].tolist() for i, b in enumerate(keys)}

    def rows_of_block(key: tuple[Any, ...], frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("part")
        matrix = draw_matrix(np.random.default_rng([seed, int(key[0]) + 1]), frame["n"].tolist(), share[int(key[0])])
        return pd.DataFrame({"from": frame["part"].to_numpy(), "upto": matrix.cumsum(axis=1).tolist()})

    drawn_rows = counts.groupBy(F.pmod("part", F.lit(BLOCKS)).alias("block")).applyInPandas(rows_of_block, "from long, upto array<long>")
    matrix = write_and_read(drawn_rows, "matrix")  # a table of known size: while it is small, the rows need no shuffle to meet it
    turn = F.expr(f"place & {(1 << _PART_BITS) - 1}")
    buckets = max(1, -(-total // (shards * bucket_rows)))
    placed = (
        stored.withColumn("part", part)
        .join(matrix, F.col("part") == F.col("from"))
        .withColumn("shard", F.size(F.filter("upto", lambda x: x <= turn)))
        .select("row", "place", "shard", F.pmod(F.xxhash64("place", F.lit(seed)), F.lit(buckets)).alias("bucket"))
    )
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n")).select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "bucket").orderBy(F.xxhash64(F.lit(seed + 1), "place"), "place")
    ranked = placed.withColumn("turn", F.row_number().over(inside)).join(starts, ["shard", "bucket"])
    return ranked.select("row.*", "shard", (F.col("start") + F.col("turn") - 1).cast("long").alias("slot"))
