"""What changed between consecutive full snapshots.

The index of the last snapshot is a table of two narrow columns, key and hash,
bucketed and sorted on the key.  A new snapshot is brought into the same
buckets, probed against it with one merge of equal buckets (no shuffle), and
then takes its place: the old index is dropped.  Old and new values are fetched
for the keys that changed only, from where the snapshots lie.

A history is replayed snapshot by snapshot, so its plans stay the same however
many snapshots it has; it is cut by snapshot once, without a shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import remove_tree, scratch_path
from .satellites import hash_diff

CHANGES = "extract_date string, key string, change_kind string"


def buckets_for(rows: int, rows_per_bucket: int = 1_000_000, least: int = 1) -> int:
    """A power of two, so that the buckets of a grown table fall together with those of the last one."""
    wanted = max(least, -(-rows // rows_per_bucket))
    return 1 << (wanted - 1).bit_length()


class SnapshotIndex:
    """Key-to-hash index of the last snapshot; ``advance`` gives what changed and swaps it.

    ``close`` drops the index; used as a context manager it leaves no table behind.  Snapshots come as
    ``key, seen_at, row_hash`` (see :func:`snapshot_rows`).  Rows without a key are left out; of several
    rows of a key the newest ``seen_at`` counts, of equally new ones the highest hash, so repeated rows
    change nothing.  The first snapshot gives no changes; an empty one removes every key.
    """

    def __init__(self, spark: SparkSession, rows_per_bucket: int = 1_000_000):
        self.spark = spark
        self.rows_per_bucket = rows_per_bucket
        self.day: str | None = None
        self._name: str | None = None
        self._place: str | None = None
        self._buckets = 0

    def __enter__(self) -> SnapshotIndex:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    def _write(self, rows: DataFrame, n_rows: int) -> tuple[str, str]:
        name = f"snapshot_index_{uuid.uuid4().hex}"
        place = scratch_path(self.spark, name)
        self._buckets = max(self._buckets, buckets_for(n_rows, self.rows_per_bucket, self.spark.sparkContext.defaultParallelism))
        newest = (  # the aggregate keeps the partitioning, so the rows move once
            rows.filter(F.col("key").isNotNull()).select("key", "seen_at", "row_hash").repartition(self._buckets, "key")
            .groupBy("key").agg(F.max(F.struct("seen_at", "row_hash"))["row_hash"].alias("row_hash"))
        )
        newest.write.bucketBy(self._buckets, "key").sortBy("key").option("path", place).saveAsTable(name)
        return name, place

    def advance(self, day: str, rows: DataFrame, n_rows: int | None = None) -> DataFrame | None:
        """Changes against the snapshot before, written out; None for the first one.

        ``n_rows`` saves the count that chooses the number of buckets.
        """
        if self.day is not None and day <= self.day:
            raise ValueError(f"snapshot {day} is not after {self.day}")
        name, place = self._write(rows, rows.count() if n_rows is None else n_rows)
        out = None
        if self._name is not None:
            path = scratch_path(self.spark, "changes")
            self._probe(self._name, name, day).write.parquet(path)
            out = self.spark.read.schema(CHANGES).parquet(path)
        self.close()
        self.day, self._name, self._place = day, name, place
        return out

    def _probe(self, old: str, new: str, day: str) -> DataFrame:
        a = self.spark.table(old).select("key", F.col("row_hash").alias("old_hash"))
        b = self.spark.table(new).select("key", F.col("row_hash").alias("new_hash"))
        kind = (
            F.when(F.col("old_hash").isNull(), F.lit("added"))
            .when(F.col("new_hash").isNull(), F.lit("removed"))
            .when(F.col("old_hash") != F.col("new_hash"), F.lit("changed"))
        )
        return (
            a.join(b.hint("merge"), "key", "full").withColumn("change_kind", kind).filter(F.col("change_kind").isNotNull())
            .select(F.lit(day).alias("extract_date"), "key", "change_kind")
        )

    def close(self) -> None:
        """Drop the index, from the catalog and from the shared folder."""
        if self._name is not None:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name}")
            remove_tree(self.spark, self._place)
            self._name = None


def snapshot_rows(df: DataFrame, *, key: Column, snapshot: Column, seen_at: Column, values: dict[str, Column]) -> DataFrame:
    """``snapshot, key, seen_at, row_hash`` and the values in their canonical text, of any table."""
    rows = df.select(snapshot.alias("snapshot"), key.alias("key"), seen_at.alias("seen_at"), *[c.alias(n) for n, c in values.items()])
    return rows.withColumn("row_hash", hash_diff(list(values)))


class History:
    """Full snapshots that lie in one table, cut apart by their day.

    The cut is one pass without a shuffle; a column that no one asks for is not read again.  Rows
    without a snapshot or key are left out.
    """

    def __init__(self, rows: DataFrame, values: Sequence[str] = ()):
        self.spark = rows.sparkSession
        self.values = list(values)
        cut = rows.filter(F.col("snapshot").isNotNull() & F.col("key").isNotNull()).select("snapshot", "key", "seen_at", "row_hash", *self.values)
        path = scratch_path(self.spark, "snapshots")
        cut.write.partitionBy("snapshot").parquet(path)
        # the folders' names are texts: what looks like a date stays one
        self.rows = self.spark.read.schema(cut.schema).parquet(path)
        self.sizes = {r["snapshot"]: r["count"] for r in self.rows.groupBy("snapshot").count().collect()}  # a row per snapshot

    @property
    def days(self) -> list[str]:
        return sorted(self.sizes)

    def of(self, day: str) -> DataFrame:
        return self.rows.filter(F.col("snapshot") == F.lit(day))

    def replay(self, rows_per_bucket: int = 1_000_000) -> Iterator[tuple[str, str, DataFrame]]:
        """``(day before, day, changes)`` of each snapshot after the first, through one index."""
        before = None
        with SnapshotIndex(self.spark, rows_per_bucket) as index:
            for day in self.days:
                changes = index.advance(day, self.of(day), self.sizes[day])
                if changes is not None:
                    yield before, day, changes
                before = day

    def changes(self) -> DataFrame:
        parts = [c for _, _, c in self.replay()]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], CHANGES)

    def values_of(self, day: str, keys: DataFrame, name: str) -> DataFrame:
        """``key, field_name, <name>``: the values a snapshot has for the given keys, one row per key and field.

        The row is the one the index took: the newest, then the one of the highest hash.
        """
        got = self.of(day).join(keys, "key", "left_semi").groupBy("key").agg(F.max(F.struct("seen_at", "row_hash", *self.values)).alias("b"))
        return got.select("key", *[F.col(f"b.{v}").alias(v) for v in self.values]).unpivot(["key"], self.values, "field_name", name)

    def changed_values(self) -> DataFrame:
        """``extract_date, key, field_name, old_value, new_value`` of each changed field."""
        parts = []
        for before, day, changes in self.replay():
            keys = changes.filter("change_kind = 'changed'").select("key")
            both = self.values_of(before, keys, "old_value").join(self.values_of(day, keys, "new_value"), ["key", "field_name"])
            differing = both.filter(~F.col("old_value").eqNullSafe(F.col("new_value"))).select(
                F.lit(day).alias("extract_date"), "key", "field_name", "old_value", "new_value"
            )
            path = scratch_path(self.spark, "changed-values")
            differing.write.parquet(path)
            parts.append(self.spark.read.schema(differing.schema).parquet(path))
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame(
            [], "extract_date string, key string, field_name string, old_value string, new_value string"
        )
