"""Merging a new extract into the latest snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import composite_key


def aligned(df: DataFrame, columns: Sequence[str], kinds: dict[str, str] | None = None) -> DataFrame:
    """``df`` in the given columns and order (any letter case); absent ones are NULL."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        [F.col(f"`{have[c.lower()]}`").alias(c) if c.lower() in have else F.lit(None).cast((kinds or {}).get(c, "string")).alias(c) for c in columns]
    )


def union_columns(*frames: DataFrame) -> list[str]:
    """All columns in the order of first appearance, letter case ignored."""
    seen: dict[str, str] = {}
    for df in frames:
        for c in df.columns:
            seen.setdefault(c.lower(), c)
    return list(seen.values())


def with_extract(df: DataFrame, day: str, at: str) -> DataFrame:
    """Extract columns put first; those the frame already has are replaced."""
    rest = [c for c in df.columns if c.upper() not in ("EXTRACT_DATE", "EXTRACT_DATETIME_UTC")]
    return df.select(F.lit(day).alias("EXTRACT_DATE"), F.lit(at).alias("EXTRACT_DATETIME_UTC"), *rest)


def merge_snapshot(prev: DataFrame, stage: DataFrame, key: Sequence[str], complete: bool) -> DataFrame:
    """COMPLETE: the staged rows are the snapshot.  PARTIAL: they are joined by the previous rows of unseen keys.

    Physical duplicates stay; missing key parts count as ''.
    """
    if complete:
        return stage
    columns = union_columns(stage, prev)
    kinds = {f.name: f.dataType.simpleString() for df in (prev, stage) for f in df.schema.fields}
    seen = stage.select(composite_key(list(key)).alias("__k")).distinct()
    kept = prev.withColumn("__k", composite_key(list(key))).join(seen, "__k", "left_anti")
    return aligned(stage, columns, kinds).unionByName(aligned(kept, columns, kinds))


def merge_latest_wins(prev: DataFrame, new: DataFrame, key: str, order: Sequence[Column], tie: Column | None = None) -> DataFrame:
    """One row per key: the greatest in ``order``; between equals the new row wins, then the greater ``tie``.

    Rows without a key are all kept.
    """
    both = prev.withColumn("__src", F.lit(0)).unionByName(new.withColumn("__src", F.lit(1)), allowMissingColumns=True)
    names = [c for c in both.columns if c != "__src"]
    by = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], "__src", *([tie.alias("tie")] if tie is not None else []))
    # a combinable maximum (NULL lowest), so a hot key is no hot task
    keyed = both.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(F.max_by(F.struct(*names), by).alias("r")).select("r.*")
    return keyed.unionByName(both.filter(F.col(key).isNull()).select(*names))


def merge_accounting(prev: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """One row: previous, received, inserted, refreshed and retained keys, from one full join of distinct keys."""
    a = prev.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("__a", F.lit(True))
    b = new.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("__b", F.lit(True))
    return a.join(b, key, "full").agg(
        F.count("__a").alias("previous_keys"), F.count("__b").alias("received_keys"),
        F.count_if(F.col("__a").isNull()).alias("inserted"), F.count_if(F.col("__a") & F.col("__b")).alias("refreshed"),
        F.count_if(F.col("__b").isNull()).alias("retained"),
    )


def freshness(df: DataFrame, stamp: str, value: str) -> DataFrame:
    """One row: rows stamped with this run, and the rest."""
    fresh = F.coalesce(F.col(stamp) == F.lit(value), F.lit(False))
    return df.agg(F.count_if(fresh).alias("refreshed_rows"), F.count_if(~fresh).alias("stale_rows"))
