"""Panel features of arriving records, from moments that are kept per entity as state."""
from __future__ import annotations

import math
import sys
from array import array
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from panelwise.operators.panel import ROLLING, STATS, feature_names
from panelwise.operators.skew import col

_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


_FEATURES = "_features"
#: Moments of no number: count, mean, squared deviations, least, greatest.
_NONE = (0.0, 0.0, 0.0, math.inf, -math.inf)


def _known(value: float | None) -> bool:
    return value is not None and value == value


def moments(values: Sequence[float | None]) -> tuple[float, ...]:
    """(count, mean, squared deviations, least, greatest) of the numbers among the values."""
    known = [v for v in values if _known(v)]
    if not known:
        return _NONE
    mean = sum(known) / len(known)
    return float(len(known)), mean, sum((v - mean) * (v - mean) for v in known), min(known), max(known)


def merged(parts: Sequence[Sequence[float]]) -> Sequence[float]:
    """Moments of several parts together (Chan's rule)."""
    out = parts[0]
    for b in parts[1:]:
        if not (out[0] and b[0]):
            out = out if out[0] else b
            continue
        n, apart = out[0] + b[0], b[1] - out[1]
        share = b[0] / n
        out = n, out[1] + apart * share, out[2] + b[2] + apart * apart * out[0] * share, min(out[3], b[3]), max(out[4], b[4])
    return out


def _named(m: Sequence[float], stats: Sequence[str]) -> list[float]:
    """The statistics of a column, 0 where there is none."""
    n, mean, m2, low, high = m
    values = {"mean": mean, "std": math.sqrt(m2 / (n - 1)) if n > 1 else 0.0, "min": low, "max": high, "count": n}
    return [values[s] if n else 0.0 for s in stats]


def _change(value: float | None, past: Sequence[float] | None) -> float:
    """Against the least value of the past, 0 if there is none; as finite as ``numpy.nan_to_num`` makes it."""
    if not _known(value) or past is None or not past[0]:
        return 0.0
    by = value - past[3]
    return max(-sys.float_info.max, min(sys.float_info.max, by)) if by == by else 0.0


class EntityFeatures(StatefulProcessor):
    """Keeps the moments of each period of an entity; rows get the features of all that has arrived with them or before.

    The rows of an entity in one micro-batch are in memory together, which the trigger bounds; its state has one entry for each
    of its periods, whatever its rows. Rows without a period are one entry, which no frame of years reaches. Most entities have
    a few rows, so their numbers are plain ones, and their state is read once and written once for each micro-batch.
    """

    def __init__(self, names: Sequence[str], period: str, columns: Sequence[str], years: Sequence[int], lags: Sequence[int]) -> None:
        self.names, self.period, self.columns, self.years, self.lags = list(names), period, list(columns), list(years), list(lags)

    def init(self, handle: StatefulProcessorHandle) -> None:
        #: The periods, and for each of them the moments of every column, as doubles in a row.
        self.cells = handle.getValueState("entity_cells", "periods array<bigint>, moments binary")
        self.row = Row(*self.names, _FEATURES)
        self.at = [self.names.index(c) for c in self.columns]

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        when, held = self.names.index(self.period), {}  # by period: the moments of each column
        if (kept := self.cells.get()) is not None:
            size, numbers = 5 * len(self.columns), array("d", kept[1])
            for i, p in enumerate(kept[0]):
                cell = numbers[i * size : (i + 1) * size]
                held[p] = [cell[j : j + 5] for j in range(0, size, 5)]
        arrived: dict[int | None, list[list]] = {}
        for r in rows:
            values = [x if not isinstance(x, float) or x == x else None for x in r]
            arrived.setdefault(None if values[when] is None else int(values[when]), []).append(values)
        for p, mine in arrived.items():
            new = [moments([r[i] for r in mine]) for i in self.at]
            held[p] = [merged(pair) for pair in zip(held[p], new)] if p in held else new
        self.cells.update((list(held), array("d", [x for cell in held.values() for m in cell for x in m]).tobytes()))
        whole = [x for j in range(len(self.columns)) for x in _named(merged([cell[j] for cell in held.values()]), STATS)]
        for p, mine in arrived.items():
            back = lambda k: held.get(p - k) if p is not None else held[None]  # noqa: E731, B023
            shared = list(whole)
            frames = [[x for k in range(w if p is not None else 1) if (x := back(k)) is not None] for w in self.years]
            for j in range(len(self.columns)):
                for frame in frames:
                    shared += _named(merged([cell[j] for cell in frame]), ROLLING)
            past = [back(k) for k in self.lags]
            for r in mine:
                deltas = [_change(r[i], cell and cell[j]) for j, i in enumerate(self.at) for cell in past]
                yield self.row(*r, [x if x == x else None for x in shared] + deltas)


@contextmanager
def _state_store(spark: SparkSession):
    before = {k: spark.conf.get(k, None) for k in _STORE}
    for k, v in _STORE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stream_features(
    records: DataFrame, entity: str, period: str, columns: Sequence[str], out: str, checkpoint: str, years: Sequence[int] = (1, 2, 3), lags: Sequence[int] = (1, 2)
) -> StreamingQuery:
    """Write everything available to ``out`` with the features of ``new_rows_with_history`` (as doubles, nulls filled with 0), then stop.

    What arrived in earlier micro-batches, also of earlier runs with this checkpoint, is the history; only its moments are kept.
    """
    spark = records.sparkSession
    wide = records.select(*[col(c).cast("double").alias(c) if c in columns else col(c) for c in records.columns])
    names = feature_names(columns, rolling_columns=columns, years=years, lags=lags)
    # The features travel as one column: a record batch is written for each entity, and its columns are what it costs.
    schema = StructType([*wide.schema.fields, StructField(_FEATURES, ArrayType(DoubleType()))])
    featured = wide.groupBy(col(entity)).transformWithState(
        statefulProcessor=EntityFeatures(wide.columns, period, columns, years, lags), outputStructType=schema, outputMode="Append", timeMode="None"
    ).select(*[col(c) for c in wide.columns], *[F.col(_FEATURES)[i].alias(n) for i, n in enumerate(names)])
    with _state_store(spark):
        return featured.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def stored_features(spark: SparkSession, out: str) -> DataFrame:
    """What the stream has written, counts as whole numbers."""
    df = spark.read.parquet(out)
    return df.withColumns({c: F.col(c).cast("bigint") for c in df.columns if "_rolling_count_" in c})
