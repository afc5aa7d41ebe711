"""Top categories, ranked profiles, shares and previous-value comparisons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def category_counts(df: DataFrame, group: str, category: str, item: str) -> DataFrame:
    """``group, category, n``: distinct items, NULL categories left out."""
    return df.filter(F.col(category).isNotNull() & F.col(group).isNotNull()).groupBy(group, category).agg(F.count_distinct(item).alias("n"))


def top_category(counts: DataFrame, group: str, category: str, *, ranks: Mapping[str, int] | None = None, oldest: bool = False) -> DataFrame:
    """The category with the highest rank (or count) per group; ties go to the count, then the lowest label.

    A combinable maximum over the aggregated counts: the group's rows are as many as its categories.
    With ``oldest`` the lowest rank is taken.
    """
    rows = counts
    if ranks is not None:
        label = F.lit(None).cast("int")
        for code, rank in ranks.items():
            label = F.when(F.col(category) == code, rank).otherwise(label)
        rows = rows.withColumn("rank", label).filter("rank IS NOT NULL")
        lead = [-F.col("rank") if not oldest else F.col("rank"), -F.col("n"), F.col(category)]
    else:
        rows = rows.withColumn("rank", F.lit(None).cast("int"))
        lead = [-F.col("n"), F.col(category)]
    best = F.min_by(F.struct(category, "n", "rank"), F.struct(*lead)).alias("b")
    return rows.groupBy(group).agg(best).select(group, f"b.{category}", "b.n", "b.rank")


def top_entities(df: DataFrame, keys: Sequence[str], n: int, count: Column | None = None) -> DataFrame:
    """The ``n`` groups with the most rows, numbered; ties by key.  Only ``n`` rows meet in the numbering window."""
    counted = df.groupBy(*keys).agg((F.count(F.lit(1)) if count is None else count).alias("n"))
    order = [F.col("n").desc(), *[F.col(k).asc_nulls_last() for k in keys]]
    return counted.orderBy(*order).limit(n).withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def share_score(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole of two sums of conditions; NULL where the whole is 0."""
    return F.round(F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double")), digits)


def flag_sum(condition: Column) -> Column:
    """Rows meeting a condition as BIGINT; 0 rather than NULL for no rows."""
    return F.count_if(condition).cast("bigint")


def previous_delta(cur: DataFrame, prev: DataFrame, key: str, metrics: Sequence[str], null_as_zero: bool = False) -> DataFrame:
    """Each metric with its previous value and the change; the change is NULL where either is, unless zeros are asked for."""
    old = prev.select(key, *[F.col(m).alias(f"{m}_previous") for m in metrics])
    joined = cur.join(old, key, "left")
    out: list[Column] = [F.col(key)]
    for m in metrics:
        a, b = F.col(m), F.col(f"{m}_previous")
        change = F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0)) if null_as_zero else a - b
        out += [a, b, change.alias(f"{m}_change")]
    return joined.select(out)


def update_from(df: DataFrame, patch: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``df`` with the columns replaced where ``patch`` has the key and a value.  Patch keys must be distinct."""
    named = patch.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    joined = df.join(named, key, "left")
    return joined.select([F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns])


def metric_star(base: DataFrame, key: str, parts: Sequence[DataFrame], zero: Sequence[str] = ()) -> DataFrame:
    """Base rows with every part left-joined on the key; the ``zero`` columns are 0 where a part has no row.

    All joins are on one key, so base and parts are shuffled on it once at most and small parts broadcast by size.
    """
    out = base
    for p in parts:
        out = out.join(p, key, "left")
    return out.select([F.coalesce(F.col(c), F.lit(0)).alias(c) if c in zero else F.col(c) for c in out.columns])


def distribution(df: DataFrame, category: str) -> DataFrame:
    """Rows per category; NULL is a category."""
    return df.groupBy(category).agg(F.count(F.lit(1)).alias("n"))


def ladder_span(counts: DataFrame, group: str, ladder: Mapping[str, str]) -> DataFrame:
    """``group, newest, oldest``: the first and the last rung of a ladder (label to count column, newest first) with a count above 0."""
    rungs = [(label, F.col(c) > 0) for label, c in ladder.items()]

    def first(of: Sequence[tuple[str, Column]]) -> Column:
        return F.coalesce(*[F.when(held, F.lit(label)) for label, held in of])

    return counts.select(group, first(rungs).alias("newest"), first(rungs[::-1]).alias("oldest"))


def top_profiles(counts: DataFrame, group: str, category: str, profiles: Mapping[str, tuple[Mapping[str, int] | None, bool]]) -> DataFrame:
    """Several top categories of each group in one aggregate: ``group, <name>, <name>_count, <name>_rank`` for each profile.

    A profile is its ranks (only ranked categories count; None: the most frequent one) and whether the lowest
    rank is taken rather than the highest.  Ties go to the count, then the lowest label; a group without a
    category of the profile has NULLs.
    """
    out: list[Column] = []
    for name, (ranks, lowest) in profiles.items():
        rank = F.lit(0)
        if ranks is not None:
            rank = F.lit(None).cast("int")
            for code, r in ranks.items():
                rank = F.when(F.col(category) == code, r).otherwise(rank)
        order = F.when(rank.isNotNull(), F.struct((rank if lowest else -rank).alias("r"), (-F.col("n")).alias("n"), F.col(category).alias("c")))
        out.append(F.min_by(F.struct(F.col(category).alias("c"), F.col("n").alias("n"), (rank if ranks is not None else F.lit(None).cast("int")).alias("r")), order).alias(name))
    best = counts.groupBy(group).agg(*out)
    return best.select(group, *[x for n in profiles for x in (F.col(f"{n}.c").alias(n), F.col(f"{n}.n").alias(f"{n}_count"), F.col(f"{n}.r").alias(f"{n}_rank"))])
