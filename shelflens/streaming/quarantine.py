"""Row rules on a stream: valid rows to one table, quarantined rows to another.

The rules look at single rows, so the batch functions work on a stream as they
are; masters are joined as static tables. Deduplication and reconciliation need
whole days and stay with the batch run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from shelflens.functions.rules import is_invalid, is_valid, render_all
from shelflens.operators.inventory import quarantine


def split_stream(
    stream: DataFrame, tag: Callable[[DataFrame], DataFrame], dataset: str, out: str, checkpoint: str
) -> DataStreamWriter:
    """Tag every micro-batch and write it split by status; the caller starts the writer.

    A batch goes to a folder of its own and replaces it, so a batch that is
    repeated after a failure leaves no row twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        tagged = tag(batch).persist()  # one micro-batch, used twice
        parts = {
            "staging": tagged.filter(is_valid()),
            "quarantine": quarantine(tagged.filter(is_invalid()), dataset),
        }
        for layer, rows in parts.items():
            path = f"{out}/{layer}/{dataset}/batch={number}"
            render_all(rows, "validation_errors").write.mode("overwrite").parquet(path)
        tagged.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
