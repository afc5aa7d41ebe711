"""Which version of a record is current, what to fetch next, and the queue of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean

# The names of the modes.
MODES = ("full", "full_current", "full_historical", "incremental", "incremental_current", "incremental_historical")


def base_mode(mode: str) -> str:
    """A mode without its resume prefix, short names spelled out."""
    name = mode.removeprefix("resume_")
    name = {"current": "full_current", "historical": "full_historical"}.get(name, name)
    if name not in MODES:
        raise ValueError(f"unknown mode {mode}")
    return name


def truthy(c: str) -> Column:
    return F.coalesce(F.lower(clean(F.col(c).cast("string"))) == "true", F.lit(False))


def int_or_minus(c: str) -> Column:
    """The value as a whole number, or -1."""
    return F.coalesce(clean(F.col(c).cast("string")).try_cast("double").try_cast("bigint"), F.lit(-1).cast("bigint"))


def identity_key(columns: Sequence[str]) -> Column:
    """The first of the columns that is not missing."""
    return F.coalesce(*[clean(F.col(c).cast("string")) for c in columns])


def newest_per_key(df: DataFrame, key: str, ulid: str = "ulid", version: str = "version_number") -> DataFrame:
    """One row per key: highest ulid, then version; of full ties the greatest row. Rows without a key are left out."""
    rest = [F.col(c).cast("string") for c in df.columns if c not in (key, ulid, version)]
    by = F.struct(*[c.alias(f"o{i}") for i, c in enumerate([F.coalesce(F.col(ulid), F.lit("")), int_or_minus(version), *rest])])
    rows = df.filter(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    return rows.groupBy(F.col(key).alias("__key")).agg(F.max_by(F.struct(*df.columns), by).alias("r")).select("r.*")


def current_versions(df: DataFrame, identity: Column, key: str, latest: str = "latest_version", version: str = "version_number", ulid: str = "ulid") -> DataFrame:
    """One current row per identity: marked latest, then version, ulid and key, all descending.

    A combinable maximum of structs rather than a window, so a hot identity is no hot task.
    """
    best = F.max_by(F.struct(*df.columns), F.struct(truthy(latest).cast("int"), int_or_minus(version), F.coalesce(F.col(ulid), F.lit("")), F.col(key)))
    return df.filter(F.col(key).isNotNull()).groupBy(identity.alias("__identity")).agg(best.alias("r")).filter("__identity IS NOT NULL").select("r.*")


def candidates(df: DataFrame, existing: DataFrame, mode: str, identity: Column, key: str) -> DataFrame:
    """Rows to fetch under a mode, with ``is_current`` and ``already_there``."""
    mode = base_mode(mode)
    current = current_versions(df, identity, key).select(key).distinct().withColumn("is_current", F.lit(True))
    there = existing.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("already_there", F.lit(True))
    rows = (
        df.join(current, key, "left").join(there, key, "left")
        .withColumn("is_current", F.coalesce("is_current", F.lit(False)))
        .withColumn("already_there", F.coalesce("already_there", F.lit(False)))
    )
    keep = F.lit(True)
    if mode.startswith("incremental"):
        keep = keep & ~F.col("already_there")
    if mode.endswith("_current"):
        keep = keep & F.col("is_current")
    if mode.endswith("_historical"):
        keep = keep & ~F.col("is_current")
    return rows.filter(keep)


def build_queue(df: DataFrame, existing: DataFrame, mode: str, identity: Column, key: str, last_extract: str, tail: Sequence[str] = ()) -> DataFrame:
    """The work queue: priority 1 for current versions, then 2, with ``queue_source`` and ``status``.

    ``existing`` holds ``key`` and ``last_extract``.  ``order_key`` columns come in the order of the mode: full
    modes take the oldest extract first, incremental ones the lowest ulid.
    """
    mode = base_mode(mode)
    stamps = existing.groupBy(key).agg(F.max(last_extract).alias("last_detail_extract"))
    rows = candidates(df, existing, mode, identity, key).join(stamps, key, "left")
    kind = mode.split("_")[0].upper()
    return rows.select(
        *df.columns, F.when(F.col("is_current"), f"{kind}_CURRENT").otherwise(f"{kind}_HISTORICAL").alias("queue_source"),
        F.when(F.col("is_current"), 1).otherwise(2).cast("bigint").alias("priority"), F.lit("pending").alias("status"),
        F.lit(0).cast("bigint").alias("attempt_count"), "last_detail_extract",
    )


def queue_order(mode: str, key: str, code: str | None = None, ulid: str = "ulid", version: str = "version_number") -> list[Column]:
    first = [F.col("priority")]
    if base_mode(mode).startswith("full"):
        return [*first, F.coalesce(F.col("last_detail_extract").cast("string"), F.lit("0000")), *([F.coalesce(F.col(code), F.lit(""))] if code else []), F.col(key)]
    return [*first, F.coalesce(F.col(ulid), F.lit("")), int_or_minus(version), F.col(key)]


def apply_results(queue: DataFrame, results: DataFrame, key: str, at: str) -> DataFrame:
    """The queue after a batch: ``results`` (key, ok, status_code, error), the last attempt of a key counts.

    Attempted rows become done, or failed (which a resumed run takes up again) with their error.
    """
    last = results.groupBy(key).agg(F.max_by(F.struct("ok", "status_code", "error"), F.struct(F.col("ok").cast("int"), "status_code")).alias("__r"), F.count(F.lit(1)).alias("__tries"))
    rows = queue.join(last, key, "left")
    tried = F.col("__r").isNotNull()
    return rows.select(
        *[c for c in queue.columns if c not in ("status", "attempt_count")],
        F.when(tried & F.col("__r.ok"), "done").when(tried, "failed").otherwise(F.col("status")).alias("status"),
        (F.col("attempt_count") + F.coalesce("__tries", F.lit(0))).cast("bigint").alias("attempt_count"),
        F.col("__r.status_code").alias("last_status_code"), F.col("__r.error").alias("last_error"), F.when(tried, F.lit(at)).alias("last_attempt_at_utc"),
    )


def remaining(queue: DataFrame) -> DataFrame:
    """Rows a resumed run takes up: pending and failed ones."""
    return queue.filter(F.col("status").isin("pending", "failed"))
