"""Helpers that keep one frequent key from landing in one task.

Any key may own a large share of the rows. Aggregations are safe on their own, since Spark combines map-side
before it shuffles. Joins and whole-group windows are not, so they go through this module.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

#: How many keys the broadcast side of ``attach`` may hold; the bound on what it ships to each executor.
FREQUENT_KEYS = 1000

def col(name: str) -> Column:
    """A column by its literal name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def names(value: str | Sequence[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def bounded_rows(df: DataFrame, limit: int) -> list[Row] | None:
    """The rows of ``df`` if there are at most ``limit``, else None. At most ``limit + 1`` rows reach the driver."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def frequent_keys(df: DataFrame, keys: str | Sequence[str], k: int = FREQUENT_KEYS) -> DataFrame:
    """The ``k`` most frequent keys. Every other key then holds at most 1/k of the rows."""
    on = names(keys)
    counts = df.groupBy(*[col(x) for x in on]).agg(F.count(F.lit(1)).alias("_n"))
    return counts.orderBy(F.desc("_n"), *[col(x) for x in on]).limit(k).select(*[col(x) for x in on])


def _same(left: DataFrame, right: DataFrame, on: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in on:
        cond = cond & left[f"`{k}`"].eqNullSafe(right[f"`{k}_r`"])
    return cond


def _renamed(table: DataFrame, on: Sequence[str]) -> DataFrame:
    return table.withColumnsRenamed({k: f"{k}_r" for k in on})


def attach(
    rows: DataFrame, table: DataFrame, on: str | Sequence[str], weight: str | None = None, k: int = FREQUENT_KEYS
) -> DataFrame:
    """Left-join ``table`` (one row per key) to ``rows``, null keys matching each other.

    ``weight`` is the column of ``table`` that says how many rows each key has; it is dropped. Without it the keys
    of ``rows`` are counted. The ``k`` heaviest keys are joined map-side from a broadcast of at most ``k`` rows, so
    their rows never move; what is left has at most 1/k of the rows per key and takes an ordinary shuffled join.
    ``rows`` is read twice.
    """
    on = names(on)
    keep = [c for c in table.columns if c not in on and c != weight]
    out = [col(c) for c in rows.columns] + [col(c) for c in keep]
    if weight is None:
        right = _renamed(table, on)
        heavy = frequent_keys(rows, on, k).withColumnsRenamed({x: f"{x}_h" for x in on})
        same = F.lit(True)
        for x in on:
            same = same & heavy[f"`{x}_h`"].eqNullSafe(right[f"`{x}_r`"])
        top = heavy.join(right, same, "left").drop(*[f"{x}_r" for x in on])
        top = F.broadcast(top.withColumnsRenamed({f"{x}_h": f"{x}_r" for x in on}))
    else:
        # The filter keeps the weight in both uses of the table, so that they share one exchange.
        right = _renamed(table.filter(col(weight) > 0), on)
        top = F.broadcast(right.orderBy(F.desc(weight), *[col(f"{x}_r") for x in on]).limit(k))
    frequent = rows.join(top, _same(rows, top, on), "inner").select(*out)
    rest = rows.join(top, _same(rows, top, on), "left_anti")
    rare = rest.join(right, _same(rest, right, on), "left").select(*out)
    return frequent.unionByName(rare)


def keep_members(rows: DataFrame, members: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``members``; null matches nothing. Spark chooses the join, and splits a frequent key of
    ``rows``: both sides meet it straight from their shuffle, so ``members`` may repeat keys."""
    on = names(on)
    return rows.join(members.select(*[col(x) for x in on]), on, "left_semi")


def lookup(rows: DataFrame, table: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left-join a table of one row per key, null matching null. Spark broadcasts a small table by its size; otherwise both
    sides meet straight from their shuffles, where it splits the rows of a frequent key over several tasks."""
    on = names(on)
    right = _renamed(table, on)
    keep = [c for c in table.columns if c not in on]
    return rows.join(right, _same(rows, right, on), "left").select(*[col(c) for c in [*rows.columns, *keep]])
