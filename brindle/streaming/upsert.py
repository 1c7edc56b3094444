"""The incremental upsert as a stream that ends when its source is read.

The checkpoint replaces the high-water mark, so late rows aren't lost; the batch operator stays the default. Each
micro-batch is merged by key, so a batch that is repeated after a crash changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from brindle.operators.incremental import dedup_latest, merge_into, overwrite, target_exists
from brindle.operators.joins import merge_columns


def stream_upsert(stream: DataFrame, target: str, key_columns, watermark: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Read what is there (availableNow) and merge it into the target; returns when done."""

    def merge(batch: DataFrame, _: int) -> None:
        keys, updates = merge_columns(batch, key_columns)
        latest = dedup_latest(batch, keys, watermark)
        if target_exists(batch.sparkSession, target):
            merge_into(latest, target, keys, updates, fmt)
        else:
            overwrite(latest, target, keys, fmt)

    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
