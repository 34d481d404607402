"""User functions over batches of rows."""
from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def map_frames(df: DataFrame, func: Callable[..., pd.DataFrame], schema: StructType | str, chunk_size: int | None = None, **kwargs) -> DataFrame:
    """Apply ``func(frame, **kwargs)`` to chunks of every partition and put the results together.

    Chunks have ``chunk_size`` rows, but for the last of a partition; a task holds one. Without it they are Arrow batches
    (``spark.sql.execution.arrow.maxRecordsPerBatch``). ``func`` must not depend on where a chunk begins.
    """
    if chunk_size is not None and chunk_size < 1:
        raise ValueError("chunk_size is at least 1")

    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = [], 0
        for batch in batches:
            while rows + len(batch) >= chunk_size:
                cut = chunk_size - rows
                yield pd.concat([*held, batch.iloc[:cut]], ignore_index=True)
                batch, held, rows = batch.iloc[cut:], [], 0
            if len(batch):
                held.append(batch)
                rows += len(batch)
        if held:
            yield pd.concat(held, ignore_index=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches if chunk_size is None else chunks(batches):
            yield func(batch, **kwargs)

    return df.mapInPandas(run, schema)
