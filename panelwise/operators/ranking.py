"""Running totals, ranks and quantiles over a global order, without ordering everything in one task.

For totals and ranks the rows are range-sorted into a table in the shared folder. Its files are consecutive ranges of the order, so a
window per (group, file) and the totals of the files before it give the result. There is no limit on groups or files.
"""
from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwise.operators.skew import col
from panelwise.session import write_and_read


def running_totals(
    df: DataFrame, sums: Mapping[str, str], order: str, group: Sequence[str] = (), leading: Sequence[str] = (), descending: bool = False
) -> DataFrame:
    """Add, per ``sums`` entry ``{out: column}``, the running total of the column up to and including the row, and
    as ``{out}_total`` its total over the group.

    The order is ``leading`` (columns, if any), then ``order``, which must be distinct within (group, leading). Groups may
    be few and large, or many. The sorted table is written before the result is read, so ``df`` is computed once.
    """

    def by(c: str) -> Column:
        return col(c).desc() if descending else col(c).asc()

    in_order = [*[by(c) for c in leading], by(order)]
    stored = write_and_read(df.orderBy(*[col(g) for g in group], *in_order), "ranking")
    placed = stored.select("*", F.col("_metadata.file_path").alias("_file"))
    cells = [col(g) for g in group]
    place = F.struct(*[col(c) for c in [*leading, order]])
    totals = placed.groupBy(*cells, "_file").agg((F.max if descending else F.min)(place).alias("_first"), *[F.sum(col(src)).alias(out) for out, src in sums.items()])
    whole = W.partitionBy(*cells)
    first = F.col("_first").desc() if descending else F.col("_first").asc()
    before = whole.orderBy(first).rowsBetween(W.unboundedPreceding, -1)  # files of a group
    offsets = totals.select(
        *[col(g).alias(f"{g}_o") for g in group],
        F.col("_file").alias("_file_o"),
        *[F.sum(col(out)).over(before).alias(f"{out}_o") for out in sums],
        *[F.sum(col(out)).over(whole).alias(f"{out}_total") for out in sums],
    )
    inside = W.partitionBy(*cells, "_file").orderBy(*in_order).rowsBetween(W.unboundedPreceding, W.currentRow)
    within = placed.select("*", *[F.sum(col(src)).over(inside).alias(out) for out, src in sums.items()])
    match = _same_cell(within, offsets, group, "_o") & (within["_file"] == offsets["_file_o"])
    parts = [(o, within[f"`{o}`"], offsets[f"`{o}_o`"]) for o in sums]
    return within.join(offsets, match, "inner").select(
        *[col(c) for c in df.columns],
        # Null as long as no value has been seen, like a sum.
        *[F.coalesce(here + earlier, here, earlier).alias(o) for o, here, earlier in parts],
        *[col(f"{o}_total") for o in sums],
    )


def _same_cell(left: DataFrame, right: DataFrame, cells: Sequence[str], suffix: str) -> Column:
    same = F.lit(True)
    for c in cells:
        same = same & left[f"`{c}`"].eqNullSafe(right[f"`{c}{suffix}`"])
    return same


#: Rank error of the sketch is a share of 1 / ``ACCURACY``; brackets reach ``MARGIN`` times that to either side.
ACCURACY, MARGIN = 10_000, 2
#: Values of a bracket that are counted exactly; a bracket with more is cut by a sketch of what is inside it.
BRACKET = 1_000_000


def _number(c: str) -> Column:
    value = col(c).cast("double")
    return F.when(~F.isnan(value), value)


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Mapping[str, float]) -> DataFrame:
    """One row per column with values: ``name``, ``n`` and each ``{out: p}`` quantile, linearly interpolated.

    Nothing is sorted: a mergeable sketch brackets the wanted ranks, a second aggregate counts what lies below and inside
    each bracket, and only the values inside are counted one by one. A bracket that misses its rank (the counts tell) is
    opened on that side, one of more than ``BRACKET`` values is cut again by a sketch of its own values; so results are
    exact whatever the sketch says. Null and NaN don't count.
    """
    names, marks = list(columns), [float(p) for p in probs.values()]
    spread = MARGIN / ACCURACY
    edges = [min(max(p + s, 0.0), 1.0) for p in marks for s in (-spread, spread)]
    if not names or not marks:
        return df.sparkSession.createDataFrame([], ", ".join(["name string", "n bigint", *[f"`{o}` double" for o in probs]]))
    row = df.agg(*[x for c in names for x in (F.count(_number(c)), F.percentile_approx(_number(c), edges, ACCURACY))]).first()
    sizes = {c: row[2 * i] for i, c in enumerate(names) if row[2 * i]}
    brackets, ranks = {}, {}
    for i, c in enumerate(names):
        for k, p in enumerate(marks if c in sizes else []):
            place = p * (sizes[c] - 1)
            ranks[c, k] = (math.floor(place), math.ceil(place))
            brackets[c, k] = (row[2 * i + 1][2 * k], row[2 * i + 1][2 * k + 1])
    below, opened = {}, set()
    todo = list(brackets)
    while todo:
        cells = []
        for c, k in todo:
            (lo, hi), v = brackets[c, k], _number(c)
            inside = F.when((v >= lo) & (v <= hi), v)
            cells += [F.count_if(v < lo), F.count(inside), F.percentile_approx(inside, [x / 64 for x in range(65)], ACCURACY)]
        counted, again = df.agg(*cells).first(), []
        for i, (c, k) in enumerate(todo):
            under, inside, cuts = counted[3 * i : 3 * i + 3]
            (lo, hi), (first, last) = brackets[c, k], ranks[c, k]
            if first < under or last >= under + inside:  # the sketch missed
                brackets[c, k] = (lo if first >= under else -math.inf, hi if last < under + inside else math.inf)
                again.append((c, k))
                opened.add((c, k))
                continue
            below[c, k] = under
            if inside > BRACKET and lo < hi and (c, k) not in opened:
                share = lambda r: (r - under) / max(inside - 1, 1) * 64  # noqa: E731, B023
                tight = (cuts[max(0, math.floor(share(first)) - 1)], cuts[min(64, math.ceil(share(last)) + 1)])
                if tight != (lo, hi):
                    brackets[c, k] = tight
                    again.append((c, k))
        todo = again
    found = _values_at(df, brackets, below, ranks)
    rows = []
    for c, n in sizes.items():
        values = []
        for k, p in enumerate(marks):
            lo, hi = found[c, k]
            values.append(lo if lo == hi else lo + (hi - lo) * (p * (n - 1) - math.floor(p * (n - 1))))
        rows.append((c, n, *values))
    return df.sparkSession.createDataFrame(rows, ", ".join(["name string", "n bigint", *[f"`{o}` double" for o in probs]]))


def _values_at(df: DataFrame, brackets: Mapping, below: Mapping, ranks: Mapping) -> dict:
    """The values at the two ranks of each bracket. Values are counted map-side; a window adds up what a bracket holds."""
    if not brackets:
        return {}
    keys = list(brackets)
    cells = []
    for i, (c, k) in enumerate(keys):
        (lo, hi), v = brackets[c, k], _number(c)
        cells.append(F.struct(F.lit(i).alias("at"), F.when((v >= lo) & (v <= hi), v).alias("value")))
    counts = df.select(F.inline(F.array(*cells))).filter(F.col("value").isNotNull()).groupBy("at", "value").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(W.partitionBy("at").orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow))
    wanted = F.create_map(*[F.lit(x) for i, key in enumerate(keys) for x in (i, below[key])])
    first = F.create_map(*[F.lit(x) for i, key in enumerate(keys) for x in (i, ranks[key][0])])
    last = F.create_map(*[F.lit(x) for i, key in enumerate(keys) for x in (i, ranks[key][1])])
    ranked = counts.withColumn("upto", upto + wanted[F.col("at")])
    picks = ranked.groupBy("at").agg(
        F.min(F.when(F.col("upto") > first[F.col("at")], F.col("value"))).alias("lo"), F.min(F.when(F.col("upto") > last[F.col("at")], F.col("value"))).alias("hi")
    )
    return {keys[r["at"]]: (r["lo"], r["hi"]) for r in picks.collect()}  # one row for each column and quantile
