"""Edges, existence filters and label lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_LABELS = 100_000  #: rows up to which a code list is broadcast


def edges(df: DataFrame, item: str, ends: Sequence[tuple[str, str]], distinct: bool = True) -> DataFrame:
    """``item, role, actor`` for each (role, column) with a value, from one pass over the rows.

    Without ``distinct`` an item with the same actor in two roles counts twice.
    """
    made = df.select(item, F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.col(c).cast("string").alias("actor")) for r, c in ends])).alias("e"))
    out = made.select(item, "e.role", "e.actor").filter("actor IS NOT NULL")
    return out.dropDuplicates([item, "actor"]).select(item, "actor") if distinct else out


def prefix_or_known(df: DataFrame, columns: Sequence[str], prefix: str, known: DataFrame, key: str) -> DataFrame:
    """Rows where any column starts with the prefix or is a known key; each row stays one row."""
    keys = known.select(F.col(key).cast("string").alias("__k")).filter("__k IS NOT NULL").distinct()
    hit = F.lit(False)
    out = df
    for i, c in enumerate(columns):
        out = out.join(keys.select(F.col("__k").alias(f"__k{i}")), F.col(c).cast("string") == F.col(f"__k{i}"), "left")
        hit = hit | F.coalesce(F.col(c).cast("string").startswith(prefix), F.lit(False)) | F.col(f"__k{i}").isNotNull()
    return out.filter(hit).select(*df.columns)


def code_labels(codes: DataFrame, code: str, label: str, where: Column | None = None) -> DataFrame:
    """One label per code, the lowest, so that a lookup never multiplies rows."""
    rows = codes if where is None else codes.filter(where)
    return rows.filter(F.col(code).isNotNull()).groupBy(code).agg(F.min(label).alias(label))


def with_label(df: DataFrame, column: Column, labels: DataFrame, code: str, label: str, name: str) -> DataFrame:
    """``df`` and the label of a code; broadcast only if the code list, counted, is small."""
    table = labels.select(F.col(code).cast("string").alias("__code"), F.col(label).alias(name))
    if labels.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:
        table = F.broadcast(table)
    return df.join(table, column.cast("string") == F.col("__code"), "left").drop("__code")
