"""References to records that are missing, deleted or not there yet.

Plan: references are pre-aggregated to (key, day) with map-side combine, so a
key holding a third of all rows shrinks to its distinct days before anything
is shuffled on the key.  Keys that still hold a large share are at most
``1 / heavy_share`` many (they are shares of one total); their parents' spans
are broadcast under that bound.  All other keys go through a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialise


def heavy_keys(per_key: DataFrame, key: str, weight: str, share: float) -> list[str]:
    """Keys holding at least ``share`` of the summed weight: never more than ``1 / share`` of them.

    The filter comes before anything is sent to the driver, so what is collected is bounded by the
    arithmetic, not by a limit.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be in (0, 1]")
    sums = per_key.groupBy(key).agg(F.sum(weight).alias("w"))
    seen = sums.agg(F.sum("w").alias("total"), F.max("w").alias("top")).first()
    if not seen["total"] or seen["top"] < share * seen["total"]:
        return []
    return [r[key] for r in sums.filter(F.col("w") >= F.lit(share * seen["total"])).collect()]


def reference_problems(
    references: DataFrame,
    parents: DataFrame,
    *,
    ref_key: Column,
    ref_day: Column,
    parent_key: Column,
    parent_first: Column,
    parent_last: Column,
    heavy_share: float = 0.01,
) -> DataFrame:
    """Rows ``ref_key, ref_day, kind, n_refs`` of the references that do not hold.

    ``kind`` is ``missing`` (key in no parent row), ``late`` (day before the parent's first day) or
    ``deleted`` (day after its last day); each (key, day) comes once with its number of rows.

    NULL keys are no references and are left out; a parent without a key is no parent.  A reference
    without a day can only be ``missing``.  A parent without a first (last) day is open at that end;
    where a day is both before the first and after the last day it is ``late``.  Repeated rows count
    in ``n_refs``.  Empty inputs give an empty result (empty parents: everything is missing).
    """
    pre = materialise(
        references.select(ref_key.alias("ref_key"), ref_day.alias("ref_day"))
        .filter(F.col("ref_key").isNotNull())
        .groupBy("ref_key", "ref_day")
        .agg(F.count(F.lit(1)).alias("n_refs")),
        "references",
    )
    spans = (
        parents.select(parent_key.alias("ref_key"), parent_first.alias("first_day"), parent_last.alias("last_day"))
        .filter(F.col("ref_key").isNotNull())
        .groupBy("ref_key")
        .agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"), F.lit(True).alias("known"))
    )
    # what meets in a task are the key's days, so they are what makes a key heavy
    heavy = heavy_keys(pre.withColumn("days", F.lit(1)), "ref_key", "days", heavy_share)
    if heavy:
        spans = materialise(spans, "parents")  # both ways read it
    is_heavy = F.col("ref_key").isin(heavy) if heavy else F.lit(False)

    def judge(refs: DataFrame, found: DataFrame) -> DataFrame:
        kind = (
            F.when(F.col("known").isNull(), F.lit("missing"))
            .when(F.col("ref_day") < F.col("first_day"), F.lit("late"))
            .when(F.col("ref_day") > F.col("last_day"), F.lit("deleted"))
        )
        return (
            refs.join(found, "ref_key", "left")
            .withColumn("kind", kind)
            .filter(F.col("kind").isNotNull())
            .select("ref_key", "ref_day", "kind", "n_refs")
        )

    light_part = judge(pre.filter(~is_heavy), spans.filter(~is_heavy))
    if not heavy:
        return light_part
    # at most 1 / heavy_share rows are broadcast
    heavy_part = judge(pre.filter(is_heavy), F.broadcast(spans.filter(is_heavy)))
    return light_part.unionByName(heavy_part)


def problem_report(problems: DataFrame, month: Column | None = None) -> DataFrame:
    """Counts per table and month: ``table_name, ref_month, kind, n_keys, n_refs``.

    ``problems`` holds ``table_name`` beside the columns of :func:`reference_problems`.  References
    without a day fall under the month ``''``.
    """
    month = F.coalesce(F.substring("ref_day", 1, 7), F.lit("")) if month is None else month
    return problems.groupBy("table_name", month.alias("ref_month"), "kind").agg(
        F.count_distinct("ref_key").alias("n_keys"), F.sum("n_refs").cast("bigint").alias("n_refs")
    )
