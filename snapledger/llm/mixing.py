"""Mixing sources to target weights by hierarchical budgeting.

The leaves of a tree (domain, language, source) are the combinations of the
level columns that occur.  A source's target is spread over its leaves by
their tokens, and every node weighs what its leaves weigh together.  The token
budget goes down the tree: at each node it is split by the children's weights;
what a child cannot hold, even with its documents repeated as often as allowed,
goes to its siblings first and only then, as a smaller capacity of the node, to
the node's own siblings.  Each leaf takes whole epochs of its documents and
then the prefix of a seeded order that fits the rest.

All of it is column arithmetic: a level is one window over the children of each
node, sorted by how soon they are full, and prefixes are found in two steps
(sums per slice of the seeded order, then one slice per leaf in order), so no
task sorts a whole leaf and the driver plans nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import materialise

SLICES = 4096


def water_fill(children: DataFrame, parent: Sequence[str], child: str) -> DataFrame:
    """``children`` with ``got``: the parent's ``budget`` split by ``weight``, none above its ``room``.

    What exceeds a child's room goes to those with room left, by weight again.  Children of weight 0 get a
    share (by room) only when all weighted ones are full.  What fits nowhere stays.
    """
    node = Window.partitionBy(*parent)
    soon = node.orderBy(F.try_divide("room", "weight").asc_nulls_last(), child)
    before = F.coalesce(F.sum("room").over(soon.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(soon.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    placed = children.withColumns({"__unit": F.try_divide(F.col("budget") - before, after), "__free": F.sum(F.when(F.col("weight") == 0, F.col("room"))).over(node)})
    placed = placed.withColumn("__full", F.col("room") <= F.col("__unit") * F.col("weight"))
    placed = placed.withColumns({
        "__level": F.max(F.when((F.col("weight") > 0) & ~F.col("__full"), F.col("__unit"))).over(node),
        "__left": F.greatest(F.lit(0.0), F.col("budget") - F.coalesce(F.sum(F.when(F.col("weight") > 0, F.col("room"))).over(node), F.lit(0.0))),
    })
    weighted = F.when(F.col("__full"), F.col("room")).otherwise(F.greatest(F.lit(0.0), F.col("__level") * F.col("weight")))
    rest = F.least("room", F.coalesce(F.try_divide(F.col("room") * F.col("__left"), F.col("__free")), F.lit(0.0)))
    return placed.withColumn("got", F.when(F.col("weight") > 0, weighted).otherwise(rest)).drop("__unit", "__free", "__full", "__level", "__left")


def budgets(leaves: DataFrame, levels: Sequence[str], total: Column) -> DataFrame:
    """``leaves`` (``levels..., weight, room``) with the ``budget`` of each, from the root's down the tree."""
    out = leaves.withColumn("budget", total.cast("double"))
    for depth, level in enumerate(levels):
        path = [*levels[: depth + 1]]
        nodes = out.groupBy(*path).agg(F.sum("weight").alias("weight"), F.sum("room").alias("room"), F.max("budget").alias("budget"))
        split = water_fill(nodes, levels[:depth], level).select(*path, F.col("got").alias("budget"))
        out = out.drop("budget").join(split, path)
    return out


def choose(
    docs: DataFrame, key: str, tokens: str, levels: Sequence[str], targets: DataFrame, source: str, *, total: float | None = None, seed: int = 0
) -> DataFrame:
    """``key, levels..., tokens, repeats``: the chosen documents and how often each is taken.

    ``targets`` holds ``source, target_share, max_repeats``, one row per source; ``source`` is one of
    ``levels``; documents of other sources are not mixed.  ``total`` is the size in tokens, by default that
    of the documents that may be mixed.  Rows with the same key are one document (the one of most tokens);
    rows without a key or with a NULL level are left out.  A leaf's last epoch ends before the first
    document that no longer fits, so no leaf exceeds its budget.  Documents without tokens ride along.  The
    order depends on the seed and the keys only.
    """
    levels = list(levels)
    order = F.xxhash64(F.lit(seed), F.col(key))
    base = materialise(
        docs.select(key, *levels, F.col(tokens).cast("bigint").alias("tokens")).na.drop(subset=[key, *levels])
        .join(targets.select(source), source, "left_semi")
        .groupBy(key).agg(F.max(F.struct("tokens", *levels)).alias("x")).select(key, "x.*")
        .withColumn("__o", order).withColumn("__slice", F.pmod("__o", F.lit(SLICES)).cast("int")),
        "mixable",
    )
    sums = materialise(base.groupBy(*levels, "__slice").agg(F.sum("tokens").alias("t")), "slices")
    by_leaf = sums.groupBy(*levels).agg(F.sum("t").alias("leaf_tokens"))
    by_source = by_leaf.groupBy(source).agg(F.sum("leaf_tokens").alias("source_tokens"))
    leaves = by_leaf.join(by_source, source).join(targets.select(source, "target_share", "max_repeats"), source).select(
        *levels, "leaf_tokens", "max_repeats",
        F.coalesce(F.col("target_share") * F.try_divide(F.col("leaf_tokens").cast("double"), F.col("source_tokens").cast("double")), F.lit(0.0)).alias("weight"),
        (F.col("leaf_tokens") * F.col("max_repeats")).cast("double").alias("room"),
    )
    size = (by_leaf.agg(F.sum("leaf_tokens").alias("t")).first()["t"] or 0) if total is None else total
    budget = F.floor(F.col("budget") + 1e-6).cast("bigint")
    epochs = F.least("max_repeats", F.coalesce(F.floor(F.try_divide(budget.cast("double"), F.col("leaf_tokens").cast("double"))), F.lit(0)).cast("bigint"))
    planned = materialise(
        budgets(leaves, levels, F.lit(float(size))).withColumn("__epochs", epochs)
        .select(*levels, "__epochs", F.when(F.col("__epochs") >= F.col("max_repeats"), F.lit(0)).otherwise(budget - F.col("__epochs") * F.col("leaf_tokens")).alias("__rest")),
        "plan",
    )
    w = Window.partitionBy(*levels).orderBy("__slice")  # SLICES rows per leaf
    cut = sums.withColumn("__end", F.sum("t").over(w)).join(planned, levels).select(
        *levels, "__slice", "__epochs", "__rest", (F.col("__end") - F.col("t")).alias("__start"), (F.col("__end") <= F.col("__rest")).alias("__whole")
    )
    placed = base.join(cut, [*levels, "__slice"])
    border = placed.filter(~F.col("__whole") & (F.col("__start") <= F.col("__rest")))
    inside = border.withColumn(
        "__more", (F.col("__start") + F.sum("tokens").over(Window.partitionBy(*levels, "__slice").orderBy("__o", key)) <= F.col("__rest")).cast("int")
    )
    clear = placed.filter(F.col("__whole") | (F.col("__start") > F.col("__rest"))).withColumn("__more", F.col("__whole").cast("int"))
    return (
        clear.unionByName(inside)
        .withColumn("repeats", (F.col("__epochs") + F.when((F.col("__rest") > 0), F.col("__more")).otherwise(0)).cast("bigint"))
        .filter("repeats > 0")
        .select(key, *levels, "tokens", "repeats")
    )


def shares(chosen: DataFrame, targets: DataFrame, level: str) -> DataFrame:
    """``level, target_share, max_repeats, actual_tokens, actual_share, shortfall_tokens, n_docs`` of every target.

    The shortfall is what the source lacks to its share of all chosen tokens, never below 0.
    """
    per = chosen.groupBy(level).agg(F.sum(F.col("tokens") * F.col("repeats")).alias("actual_tokens"), F.count(F.lit(1)).alias("n_docs"))
    joined = targets.join(per, level, "left").withColumn("all_tokens", F.coalesce(F.sum("actual_tokens").over(Window.partitionBy()), F.lit(0)))  # a row per target
    actual = F.coalesce("actual_tokens", F.lit(0)).cast("bigint")
    return joined.select(
        level, "target_share", "max_repeats", actual.alias("actual_tokens"),
        F.round(F.coalesce(F.try_divide(actual.cast("double"), F.col("all_tokens").cast("double")), F.lit(0.0)), 6).alias("actual_share"),
        F.greatest(F.lit(0), F.floor(F.col("target_share") * F.col("all_tokens")) - actual).cast("bigint").alias("shortfall_tokens"),
        F.coalesce("n_docs", F.lit(0)).cast("bigint").alias("n_docs"),
    )
