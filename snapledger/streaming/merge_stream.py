"""Incremental latest-wins merge of files as they arrive.

Each micro-batch is merged into the last version of the state and written as the
next one; the pointer moves after the write, and a batch that is delivered again
after a failure finds its own version and changes nothing: at-least-once
delivery with an idempotent merge.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.merge import merge_latest_wins
from ..sources.tables import children, get_text, put_text, remove_tree


class MergedState:
    """State of a merge stream under ``root`` (a folder all executors share)."""

    def __init__(self, spark: SparkSession, root: str, key: str, order: Sequence[Column]):
        self.spark, self.root, self.key, self.order = spark, root.rstrip("/"), key, list(order)

    def version(self) -> int:
        text = get_text(self.spark, f"{self.root}/pointer.json")
        return json.loads(text)["batch"] if text else -1

    def current(self) -> DataFrame | None:
        v = self.version()
        return self.spark.read.parquet(f"{self.root}/v{v}") if v >= 0 else None

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        if batch_id <= self.version():
            return
        state = self.current()
        empty = self.spark.createDataFrame([], batch.schema)
        merged = merge_latest_wins(state if state is not None else empty, batch, self.key, self.order)
        merged.write.mode("overwrite").parquet(f"{self.root}/v{batch_id}")
        before = self.version()
        put_text(self.spark, f"{self.root}/pointer.json", json.dumps({"batch": batch_id}))
        # readers of the last version may still be at work; what lies before it has none
        for name in children(self.spark, self.root):
            if name[:1] == "v" and name[1:].isdigit() and int(name[1:]) < before:
                remove_tree(self.spark, f"{self.root}/{name}")

    def run(self, source: str, schema: T.StructType, files_per_batch: int = 1) -> DataFrame | None:
        """Drain what lies in ``source`` now (``availableNow``) and give the merged state."""
        stream = self.spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
        query = (
            stream.writeStream.foreachBatch(self.apply).option("checkpointLocation", f"{self.root}/checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return self.current()
