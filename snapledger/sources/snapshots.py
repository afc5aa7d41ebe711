"""Versioned snapshots: write a new version, then move the pointer.

A table is a Parquet directory under ``root/snapshots/<version>/<table>``; the
``latest`` pointer is a small file written last, so readers see either the old
or the new version.  A FAILED run leaves the pointer where it is.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..operators.audit import FAILED
from ..operators.merge import aligned, union_columns
from .tables import children, get_text, path_exists, put_text, remove_tree


class SnapshotStore:
    """Works on any file system Spark can write (paths go through Hadoop's interface)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def latest(self) -> str | None:
        """Version the pointer names; None if there is none or it cannot be read."""
        text = get_text(self.spark, f"{self.root}/latest.json")
        try:
            return json.loads(text)["version"] if text else None
        except (ValueError, KeyError):
            return None

    def commit(self, version: str, tables: Mapping[str, DataFrame], status: str, metadata: Mapping[str, Any] | None = None) -> bool:
        """Write all tables and move the pointer; a FAILED run writes its metadata only."""
        base = f"{self.root}/snapshots/{version}"
        note = {"version": version, "status": status, "previous": self.latest(), **(metadata or {})}
        if status == FAILED:
            put_text(self.spark, f"{self.root}/failed/{version}.json", json.dumps(note))
            return False
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{base}/{name}")
        put_text(self.spark, f"{base}/metadata.json", json.dumps(note))
        put_text(self.spark, f"{self.root}/latest.json", json.dumps(note))
        return True

    def read(self, name: str, version: str | None = None) -> DataFrame | None:
        version = version or self.latest()
        path = f"{self.root}/snapshots/{version}/{name}"
        return self.spark.read.parquet(path) if version and path_exists(self.spark, path) else None

    def metadata(self, version: str | None = None) -> dict[str, Any]:
        text = get_text(self.spark, f"{self.root}/snapshots/{version or self.latest()}/metadata.json")
        try:
            return json.loads(text) if text else {}
        except ValueError:
            return {}

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove all versions but the newest ``keep`` and the one the pointer names; what was removed."""
        latest = self.latest()
        old = [v for v in children(self.spark, f"{self.root}/snapshots") if v != latest]
        gone = old[: max(0, len(old) - max(0, keep - (latest is not None)))]
        for v in gone:
            remove_tree(self.spark, f"{self.root}/snapshots/{v}")
        return gone

    def append(self, name: str, df: DataFrame) -> None:
        """Append to a log whose columns may grow; readers merge the schemas."""
        df.write.mode("append").parquet(f"{self.root}/logs/{name}")

    def read_log(self, name: str) -> DataFrame | None:
        path = f"{self.root}/logs/{name}"
        return self.spark.read.option("mergeSchema", "true").parquet(path) if path_exists(self.spark, path) else None


def evolve(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Old and new rows in the union of their columns, absent ones NULL."""
    if old is None:
        return new
    columns = union_columns(old, new)
    kinds = {f.name: f.dataType.simpleString() for df in (new, old) for f in df.schema.fields}
    return aligned(old, columns, kinds).unionByName(aligned(new, columns, kinds))


def all_text(df: DataFrame, none_text: str | None = None) -> DataFrame:
    """Every column as text, as raw layers keep it; NULL stays NULL unless a text for it is given."""
    from pyspark.sql import functions as F

    cols = [F.col(f"`{c}`").cast("string") for c in df.columns]
    return df.select([(F.coalesce(c, F.lit(none_text)) if none_text else c).alias(n) for c, n in zip(cols, df.columns, strict=True)])
