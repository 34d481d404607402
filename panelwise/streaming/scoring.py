"""Validate and score records as they arrive; rejects go to their own table."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from panelwise.functions.validation import REQUEST_RANGES
from panelwise.operators.scoring import validate_and_score


def score_stream(
    records: DataFrame, out: str, checkpoint: str, threshold: float, rules=REQUEST_RANGES, prepare: Callable[[DataFrame], DataFrame] | None = None
) -> StreamingQuery:
    """Process everything available to ``out/scored`` and ``out/rejected``, then stop.

    Each micro-batch replaces its own ``batch`` folder, so a batch that is run again after a failure leaves no
    duplicates. The same function scores batch and stream.
    """

    def store(batch: DataFrame, number: int) -> None:
        kept = batch.persist()  # both outputs read the batch; its source is read once
        try:
            scored, rejected = validate_and_score(prepare(kept) if prepare else kept, threshold, rules)
            scored.write.mode("overwrite").parquet(f"{out}/scored/batch={number}")
            rejected.write.mode("overwrite").parquet(f"{out}/rejected/batch={number}")
        finally:
            kept.unpersist()

    writer = records.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
