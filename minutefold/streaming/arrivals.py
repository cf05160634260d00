"""Files that arrive in a folder, applied as numbered batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def apply_arrivals(
    stream: DataFrame,
    apply: Callable[[DataFrame, str], None],
    checkpoint: str,
    prefix: str = "arrivals",
) -> None:
    """Apply every file that has arrived since the last call, then return.

    ``stream`` comes from ``spark.readStream`` on a folder. ``apply`` gets each batch
    with a run id that a retry repeats, so a step that replaces its own run's rows
    is applied exactly once.
    """
    (
        stream.writeStream.foreachBatch(lambda df, n: apply(df, f"{prefix}-{n:08d}"))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
