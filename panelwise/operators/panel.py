"""Features of an entity x period panel.

Rows are reduced map-side to moments per entity or per (entity, period); windows run over these, at most one row for each
of an entity's periods, and the result meets the rows in one join. No entity's rows are ever gathered in one task.
``windows=True`` asks for the other plan, in which all windows share one shuffle on the entity: right for panels whose
entities are known to be small. Both give the same rows.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwise.operators.ranking import running_totals
from panelwise.operators.skew import attach, bounded_rows, col, keep_members, lookup
from panelwise.session import write_and_read

STATS = ("mean", "std", "min", "max")
ROLLING = ("mean", "std", "min", "max", "count")
# fixed values: columns the features are computed for by default
NUMERIC_COLUMNS = (
    "age", "bmi", "systolic_bp", "diastolic_bp", "heart_rate", "temperature", "glucose", "cholesterol_total", "hdl",
    "ldl", "triglycerides", "creatinine", "hemoglobin", "white_blood_cells", "platelets", "num_encounters",
    "num_medications", "num_lab_tests",
)

_WEIGHT = "_rows"


def _stat(name: str, value: Column) -> Column:
    return {
        "mean": F.avg,
        "std": F.stddev_samp,
        "min": F.min,
        "max": F.max,
        "count": F.count,
    }[name](value)


def _years(w: WindowSpec, first: int, last: int) -> WindowSpec:
    return w.rangeBetween(first, last)


# --- whole-entity statistics --------------------------------------------------------------------------------------


def entity_table(df: DataFrame, entity: str, columns: Sequence[str], stats: Sequence[str] = STATS) -> DataFrame:
    """One row per entity with ``{column}_{stat}``."""
    return df.groupBy(col(entity)).agg(*[_stat(s, col(c)).alias(f"{c}_{s}") for c in columns for s in stats])


def join_entity_table(df: DataFrame, entity: str, columns: Sequence[str], stats: Sequence[str] = STATS) -> DataFrame:
    """Entity statistics joined back to every row as ``{column}_patient_{stat}``."""
    table = df.groupBy(col(entity)).agg(
        F.count(F.lit(1)).alias(_WEIGHT),
        *[_stat(s, col(c)).alias(f"{c}_patient_{s}") for c in columns for s in stats],
    )
    return attach(df, table, entity, _WEIGHT)


def entity_stats(
    df: DataFrame, entity: str, columns: Sequence[str], stats: Sequence[str] = STATS, windows: bool = False
) -> DataFrame:
    """``{column}_patient_{stat}`` of the row's entity on every row; the deviation of one value is null."""
    if not windows:
        table = df.groupBy(col(entity)).agg(*[_stat(s, col(c)).alias(f"{c}_patient_{s}") for c in columns for s in stats])
        return lookup(df, table, entity)
    w = W.partitionBy(col(entity))
    return df.select("*", *[_stat(s, col(c)).over(w).alias(f"{c}_patient_{s}") for c in columns for s in stats])


# --- frames of years --------------------------------------------------------------------------------------------


def _rolling_name(column: str, stat: str, years: int) -> str:
    return f"{column}_rolling_{stat}_{years}y"


def _delta_name(column: str, years: int) -> str:
    return f"{column}_delta_{years}y"


def _cell(c: str) -> Column:
    """Moments of a column's values in one period of an entity: count, mean, squared deviations, least, greatest."""
    value = col(c)
    return F.struct(
        F.count(value).alias("n"),
        F.avg(value).cast("double").alias("mean"),
        (F.var_pop(value) * F.count(value)).cast("double").alias("m2"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
    )


def _added(parts: Sequence[Column]) -> Column:
    total = F.lit(0.0)
    for x in parts:
        total = total + F.coalesce(x, F.lit(0.0))
    return total


def _merged(states: Sequence[Column]) -> tuple[Column, Column, Column, Column]:
    """(count, mean, least, greatest) of the values of several cells, null where there are none."""
    n = states[0]["n"]
    for s in states[1:]:
        n = n + F.coalesce(s["n"], F.lit(0))
    if len(states) == 1:
        return n, states[0]["mean"], states[0]["low"], states[0]["high"]
    mean = F.when(n > 0, _added([s["n"] * s["mean"] for s in states]) / n)
    return n, mean, F.least(*[s["low"] for s in states]), F.greatest(*[s["high"] for s in states])


def _deviation(n: Column, m2: Column) -> Column:
    return F.when(n > 1, F.sqrt(m2 / (n - 1)))


def _by_cells(
    df: DataFrame,
    entity: str,
    period: str,
    columns: Sequence[str],
    stats: Sequence[str],
    rolling_columns: Sequence[str],
    years: Sequence[int],
    rolling: Sequence[str],
    lags: Sequence[int],
) -> DataFrame:
    """All features from the moments of (entity, period) cells, which meet the rows in one join.

    Rows are reduced to cells map-side. An entity has one cell for each of its periods, so the windows over them are short
    whatever its rows. Cells merge by Chan's rule: squared deviations add up, plus those of the cells' means. Rows
    without a period are one cell, which no frame of years reaches.
    """
    used = list(dict.fromkeys([*columns, *rolling_columns]))
    at = {c: f"_{i}" for i, c in enumerate(used)}
    cells = df.groupBy(col(entity), col(period)).agg(F.struct(*[_cell(c).alias(at[c]) for c in used]).alias("_0y"))
    ordered = W.partitionBy(col(entity)).orderBy(col(period))
    reach = max([0, *[w - 1 for w in years if rolling_columns], *lags])
    earlier = [F.first("_0y").over(_years(ordered, -k, -k)).alias(f"_{k}y") for k in range(1, reach + 1)]
    # The whole-entity frame is ordered too, so that one sort serves every window.
    whole = ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    of_entity = []
    for c in columns:
        cell = F.col("_0y")[at[c]]
        n = F.sum(cell["n"]).over(whole)
        mean = F.when(n > 0, F.sum(cell["n"] * cell["mean"]).over(whole) / n)
        found = {"n": n, "mean": mean, "low": F.min(cell["low"]).over(whole), "high": F.max(cell["high"]).over(whole)}
        of_entity += [v.alias(f"{at[c]}_{k}") for k, v in found.items()]
    cells = cells.select(col(entity), col(period), "_0y", *earlier, *of_entity)

    added: dict[str, Column] = {}
    for c in columns:
        e, cell = lambda k: F.col(f"{at[c]}_{k}"), F.col("_0y")[at[c]]  # noqa: E731, B023
        if "std" in stats:
            m2 = F.sum(cell["m2"] + cell["n"] * (cell["mean"] - e("mean")) * (cell["mean"] - e("mean"))).over(whole)
        values = {"mean": e("mean"), "min": e("low"), "max": e("high"), "count": e("n")}
        added |= {f"{c}_patient_{s}": _deviation(e("n"), m2) if s == "std" else values[s] for s in stats}
    # Merged moments become columns first, so that deviations refer to them instead of repeating them.
    frames, sums = {}, []
    for c in rolling_columns:
        states = [F.col(f"_{k}y")[at[c]] for k in range(reach + 1)]
        for w in years:
            # A null period is its own frame, which must not be merged with itself.
            frames[c, w] = [states[0], *[F.when(col(period).isNotNull(), s) for s in states[1:w]]]
            sums += [v.alias(f"{at[c]}_{w}y_{k}") for k, v in zip(("n", "mean", "low", "high"), _merged(frames[c, w]))]
        # Without a period the frame of exactly k years before is that of the rows without one, as for a window.
        added |= {f"{_delta_name(c, k)}_from": states[k]["low"] for k in lags}
    cells = cells.select("*", *sums) if sums else cells
    for (c, w), frame in frames.items():
        n, mean, low, high = [F.col(f"{at[c]}_{w}y_{k}") for k in ("n", "mean", "low", "high")]
        if "std" in rolling:
            m2 = frame[0]["m2"] if w == 1 else _added([x["m2"] + x["n"] * (x["mean"] - mean) * (x["mean"] - mean) for x in frame])
        values = {"mean": mean, "min": low, "max": high, "count": n}
        added |= {_rolling_name(c, s, w): _deviation(n, m2) if s == "std" else values[s] for s in rolling}
    table = cells.select(col(entity), col(period), *[v.alias(k) for k, v in added.items()])
    wide = lookup(df, table, [entity, period])
    deltas = {_delta_name(c, k): _change(col(c), col(f"{_delta_name(c, k)}_from")) for c in rolling_columns for k in lags}
    return wide.withColumns(deltas).drop(*[f"{d}_from" for d in deltas]) if deltas else wide


def _change(value: Column, earlier: Column) -> Column:
    return F.coalesce(value - earlier, F.lit(0)).cast("double")


def rolling_years(
    df: DataFrame,
    entity: str,
    period: str,
    columns: Sequence[str],
    years: Sequence[int] = (1, 2, 3),
    stats: Sequence[str] = ROLLING,
    windows: bool = False,
) -> DataFrame:
    """``{column}_rolling_{stat}_{w}y`` over the row's year and the ``w - 1`` years before it, gaps included."""
    if not windows:
        return _by_cells(df, entity, period, (), (), columns, years, stats, ())
    w = W.partitionBy(col(entity)).orderBy(col(period))
    return df.select(
        "*",
        *[_stat(s, col(c)).over(_years(w, 1 - n, 0)).alias(_rolling_name(c, s, n)) for n in years for c in columns for s in stats],
    )


def year_deltas(
    df: DataFrame, entity: str, period: str, columns: Sequence[str], lags: Sequence[int] = (1, 2), windows: bool = False
) -> DataFrame:
    """``{column}_delta_{k}y``: change against exactly ``k`` years before, 0 if that year or a value is missing."""
    if not windows:
        return _by_cells(df, entity, period, (), (), columns, (), (), lags)
    w = W.partitionBy(col(entity)).orderBy(col(period))
    return df.select(
        "*", *[_change(col(c), F.min(col(c)).over(_years(w, -k, -k))).alias(_delta_name(c, k)) for k in lags for c in columns]
    )


def panel_features(
    df: DataFrame,
    entity: str,
    period: str,
    columns: Sequence[str] = NUMERIC_COLUMNS,
    stats: Sequence[str] = STATS,
    rolling_columns: Sequence[str] = (),
    years: Sequence[int] = (1, 2, 3),
    rolling: Sequence[str] = ROLLING,
    lags: Sequence[int] = (),
    windows: bool = False,
) -> DataFrame:
    """Entity statistics, rolling frames and changes together."""
    if not windows:
        if rolling_columns:
            return _by_cells(df, entity, period, columns, stats, rolling_columns, years, rolling, lags)
        return entity_stats(df, entity, columns, stats) if columns else df
    ordered = W.partitionBy(col(entity)).orderBy(col(period))
    # The whole-entity frame is ordered too, so that one sort serves every window.
    whole = ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing) if rolling_columns else W.partitionBy(col(entity))
    added = [_stat(s, col(c)).over(whole).alias(f"{c}_patient_{s}") for c in columns for s in stats]
    for c in rolling_columns:
        added += [_stat(s, col(c)).over(_years(ordered, 1 - n, 0)).alias(_rolling_name(c, s, n)) for n in years for s in rolling]
        added += [_change(col(c), F.min(col(c)).over(_years(ordered, -k, -k))).alias(_delta_name(c, k)) for k in lags]
    return df.select("*", *added)


def feature_names(
    columns: Sequence[str], stats: Sequence[str] = STATS, rolling_columns: Sequence[str] = (), years: Sequence[int] = (1, 2, 3), rolling: Sequence[str] = ROLLING, lags: Sequence[int] = ()
) -> list[str]:
    """Names of the columns that ``panel_features`` adds for these arguments."""
    names = [f"{c}_patient_{s}" for c in columns for s in stats]
    names += [_rolling_name(c, s, n) for c in rolling_columns for n in years for s in rolling]
    return names + [_delta_name(c, k) for c in rolling_columns for k in lags]


def zero_fill_features(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Nulls of the named feature columns become 0; other columns keep theirs."""
    return df.na.fill(0, [n for n in names if n in df.columns])


# --- row order within an entity -----------------------------------------------------------------------------------


def running_sum(df: DataFrame, entity: str, period: str, tiebreak: str, column: str, out: str) -> DataFrame:
    """Sum of ``column`` over the entity's rows so far, ordered by period and the unique numeric ``tiebreak``."""
    return running_totals(df, {out: column}, tiebreak, group=[entity], leading=[period]).drop(f"{out}_total")


def rolling_rows(df: DataFrame, entity: str, period: str, tiebreak: str, columns: Sequence[str], rows: int = 3) -> DataFrame:
    """Mean and maximum of the last ``rows`` rows of the entity (fewer at its start), same order as above.

    Rows are numbered across tasks; then a frame of rows is a frame of numbers, aggregated where it ends.
    """
    one = df.withColumn("_one", F.lit(1).cast("bigint"))
    numbered = running_totals(one, {"_at": "_one"}, tiebreak, group=[entity], leading=[period]).drop("_one", "_at_total")
    numbered = write_and_read(numbered, "numbered-rows")  # read twice below
    steps = F.explode(F.array(*[F.lit(i) for i in range(rows)])).alias("_step")
    moved = numbered.select(col(entity), F.col("_at").alias("_from"), *[col(c) for c in columns], steps)
    table = (
        moved.withColumn("_at", F.col("_from") + F.col("_step"))
        .groupBy(col(entity), F.col("_at"))
        .agg(
            F.count_if(F.col("_step") == 0).alias(_WEIGHT),
            *[_stat(s, col(c)).alias(f"{c}_rolling_{s}") for c in columns for s in ("mean", "max")],
        )
    )
    return attach(numbered, table, [entity, "_at"], _WEIGHT).drop("_at")


def advance(df: DataFrame, entity: str, period: str, base: str, out: str) -> DataFrame:
    """The entity's value in its first period plus the periods passed since then (age progression).

    If the first period has several rows the smallest value counts.
    """
    first = F.min(F.struct(col(period).alias("_p"), col(base).cast("double").alias("_b")))

    def value(start: Column) -> Column:
        return start["_b"] + (col(period) - start["_p"])

    table = df.groupBy(col(entity)).agg(F.count(F.lit(1)).alias(_WEIGHT), first.alias("_start"))
    return attach(df, table, entity, _WEIGHT).withColumn(out, value(F.col("_start"))).drop("_start")


# --- scaffold -----------------------------------------------------------------------------------------------------


def densify(df: DataFrame, entity: str, period: str, first: int, last: int) -> DataFrame:
    """Every entity in every period first..last, with the data of the panel where it has a row.

    ``(entity, period)`` is the grain, so the left join has distinct keys on its left side.
    """
    scaffold = df.select(col(entity)).distinct().withColumn(period, F.explode(F.sequence(F.lit(first), F.lit(last))))
    return scaffold.join(df, [entity, period], "left")


def new_rows_with_history(
    history: DataFrame,
    incoming: DataFrame,
    entity: str,
    period: str,
    columns: Sequence[str],
    years: Sequence[int] = (1, 2, 3),
    lags: Sequence[int] = (1, 2),
) -> DataFrame:
    """Features of incoming rows computed over their entity's stored history and themselves.

    Only the history of incoming entities is read into the windows. An entity without history gets mean = current
    value, deviation 0 and change 0 from the same code.
    """
    past = keep_members(history, incoming, entity).withColumn("_new", F.lit(False))
    both = past.unionByName(incoming.withColumn("_new", F.lit(True)))
    wide = panel_features(both, entity, period, columns, rolling_columns=columns, years=years, lags=lags)
    return zero_fill_features(wide.filter("_new").drop("_new"), feature_names(columns, rolling_columns=columns, years=years, lags=lags))


def unseen_entities(incoming: DataFrame, history: DataFrame, entity: str) -> DataFrame:
    """Distinct incoming entities the history does not have."""
    return incoming.select(col(entity)).distinct().join(history.select(col(entity)).distinct(), entity, "left_anti")


def small_distinct(df: DataFrame, column: str, limit: int) -> list | None:
    """Sorted distinct non-null values if there are at most ``limit``, else None."""
    rows = bounded_rows(df.select(col(column)).filter(col(column).isNotNull()).distinct(), limit)
    return None if rows is None else sorted(r[0] for r in rows)
