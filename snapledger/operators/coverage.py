"""How far two sources cover the same keys and columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_missing


def key_set(df: DataFrame, key: Column) -> DataFrame:
    """Distinct keys that are not missing."""
    return df.select(key.cast("string").alias("key_value")).filter(~is_missing("key_value")).distinct()


def overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row of counts and percentages for two key sets: one full join."""
    joined = left.withColumn("__a", F.lit(True)).join(right.withColumn("__b", F.lit(True)), "key_value", "full")
    both = F.count_if(F.col("__a") & F.col("__b"))
    counts = joined.agg(
        F.count("__a").alias("left_keys"), F.count("__b").alias("right_keys"), both.alias("common_keys"),
        F.count_if(F.col("__b").isNull()).alias("left_only"), F.count_if(F.col("__a").isNull()).alias("right_only"),
    )

    def percent(a: str, b: str) -> Column:
        return F.round(F.try_divide(F.col(a).cast("double") * 100, F.col(b).cast("double")), 4)

    return counts.select("*", percent("common_keys", "left_keys").alias("left_coverage_pct"), percent("common_keys", "right_keys").alias("right_coverage_pct"))


def samples(left: DataFrame, right: DataFrame, n: int) -> DataFrame:
    """The first ``n`` keys on one side only, and of those in common."""
    parts = [("left_only", left.join(right, "key_value", "left_anti")), ("right_only", right.join(left, "key_value", "left_anti")), ("common", left.join(right, "key_value"))]
    out = None
    for name, df in parts:
        one = df.select("key_value").orderBy("key_value").limit(n).select(F.lit(name).alias("sample"), "key_value")
        out = one if out is None else out.unionByName(one)
    return out


def sample_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in an order, all for -1, none for 0: a report that is the same at every run."""
    return df.orderBy(*order) if n < 0 else df.orderBy(*order).limit(n)


def missing_rows(left: DataFrame, right: DataFrame, left_key: Column, right_key: Column, n: int = 1000) -> DataFrame:
    """Whole rows of ``left`` whose key ``right`` lacks, the first ``n`` by key then content, with ``key_value`` before them."""
    keyed = left.select(left_key.cast("string").alias("key_value"), *left.columns).filter(~is_missing("key_value"))
    alone = keyed.join(key_set(right, right_key), "key_value", "left_anti")
    return sample_rows(alone, ["key_value", *left.columns], n)


def presence(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, present_rows, total_rows`` of non-missing values, all columns in one pass."""
    one = df.agg(F.count(F.lit(1)).alias("total_rows"), *[F.count_if(~is_missing(F.col(f"`{c}`").cast("string"))).alias(c) for c in columns])
    return one.unpivot(["total_rows"], list(columns), "column_name", "present_rows").select("column_name", "present_rows", "total_rows")


def compare_presence(left: DataFrame, right: DataFrame) -> DataFrame:
    """Presence of the columns both sides have, by difference then name."""
    shared = {c.upper(): c for c in left.columns}
    pairs = [(shared[c.upper()], c) for c in right.columns if c.upper() in shared]
    a = presence(left, [x for x, _ in pairs]).select(F.upper("column_name").alias("column_name"), F.col("present_rows").alias("left_present"))
    b = presence(right, [y for _, y in pairs]).select(F.upper("column_name").alias("column_name"), F.col("present_rows").alias("right_present"))
    joined = a.join(b, "column_name").withColumn("difference", F.col("left_present") - F.col("right_present"))
    return joined.orderBy(F.abs("difference").desc(), "column_name")


def column_sets(left: Sequence[str], right: Sequence[str]) -> dict[str, list[str]]:
    """Column names in both and on one side only, letter case ignored."""
    a, b = {c.upper() for c in left}, {c.upper() for c in right}
    return {"common": sorted(a & b), "left_only": sorted(a - b), "right_only": sorted(b - a)}


def choose_table(rows: Mapping[str, int], wanted: Sequence[str], unwanted: Sequence[str] = ("audit", "log", "inventory", "metadata", "reference")) -> str | None:
    """The table whose name fits best (wanted parts count up, unwanted down), then the largest, then by name."""
    def points(name: str) -> int:
        low = name.lower()
        return 10 * (low in wanted) + sum(w in low for w in wanted) - 5 * sum(u in low for u in unwanted)

    return min(rows, key=lambda n: (-points(n), -rows[n], n)) if rows else None


def choose_key(left: Sequence[str], right: Sequence[str], preferred: Sequence[str]) -> tuple[str, str] | None:
    """The first preferred name both sides have, in each side's own writing."""
    a, b = {c.upper(): c for c in left}, {c.upper(): c for c in right}
    hit = next((p.upper() for p in preferred if p.upper() in a and p.upper() in b), None)
    return (a[hit], b[hit]) if hit else None
