"""Histories of changing attributes as insert-only satellites.

Attributes are split by the rate at which they change, so that a fast one does
not multiply the slow ones' rows.  Each group has a satellite: two tables that
are only ever appended to.  ``seen`` has each distinct observation once;
``rows`` has a row per change of the group's hash diff, and a row that corrects
an earlier one where late observations demand it.  End dates are not stored but
come from a view with ``lead``.

An entity's rows meet in one window, all of them after one shuffle on the
entity.  A hot entity (a share of all rows, so there are few by arithmetic) is
cut by day instead: neighbours are found within (entity, day), and only one row
per day meets in the entity's own window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import path_exists
from .orphans import heavy_keys


def hash_diff(cols: Sequence[str]) -> Column:
    """128-bit hash of the attributes; NULL and the text '' differ (a length is hashed with each value)."""
    parts = [F.coalesce(F.concat_ws(":", F.length(F.col(c).cast("string")), F.col(c).cast("string")), F.lit("-")) for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def hot_entities(df: DataFrame, entity: str, share: float = 0.01) -> list[str]:
    """Entities with at least ``share`` of the rows: never more than ``1 / share`` of them."""
    counts = df.filter(F.col(entity).isNotNull()).groupBy(entity).agg(F.count(F.lit(1)).alias("n"))
    return heavy_keys(counts, entity, "n", share)


def _apart(df: DataFrame, entity: str, hot: Sequence[str], usual, cut) -> DataFrame:
    """``usual`` of the rows of usual entities and ``cut`` of those of hot ones."""
    if not hot:
        return usual(df)
    is_hot = F.col(entity).isin(list(hot))
    return usual(df.filter(~is_hot)).unionByName(cut(df.filter(is_hot)))


def neighbour(
    df: DataFrame, entity: str, cut: str, order: Sequence[str], value: Column, name: str, ahead: bool = False, hot: Sequence[str] = ()
) -> DataFrame:
    """``df`` with ``name``: ``value`` (never NULL) in the entity's row before, or after if ``ahead``.

    ``cut`` divides the rows of ``hot`` entities into stretches that follow each other in ``order`` (NULL first).
    """
    by = [F.col(c).asc_nulls_first() for c in order]
    step = F.lead if ahead else F.lag

    def usual(rows: DataFrame) -> DataFrame:
        return rows.withColumn(name, step(value).over(Window.partitionBy(entity).orderBy(*by)))

    def stretched(rows: DataFrame) -> DataFrame:
        edge = (F.min_by if ahead else F.max_by)(value, F.struct(*order)).alias("__edge")
        far = rows.groupBy(entity, cut).agg(edge).select(
            F.col(entity).alias("__e"), F.col(cut).alias("__c"), step("__edge").over(Window.partitionBy(entity).orderBy(F.col(cut).asc_nulls_first())).alias("__far")
        )
        near = rows.withColumn(name, step(value).over(Window.partitionBy(entity, cut).orderBy(*by)))
        joined = near.join(far, (F.col(entity) == F.col("__e")) & F.col(cut).eqNullSafe(F.col("__c")), "left")
        return joined.withColumn(name, F.coalesce(name, "__far")).drop("__e", "__c", "__far")

    return _apart(df, entity, hot, usual, stretched)


def carried(df: DataFrame, entity: str, cut: str, order: Sequence[str], marks: Sequence[str], hot: Sequence[str] = ()) -> DataFrame:
    """``df`` with each column of ``marks`` filled from the last row before that has it."""
    by = [F.col(c).asc_nulls_first() for c in order]

    def filled(rows: DataFrame, *parts: str) -> DataFrame:
        so_far = Window.partitionBy(*parts).orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumns({m: F.last(m, ignorenulls=True).over(so_far) for m in marks})

    def stretched(rows: DataFrame) -> DataFrame:
        far = rows.groupBy(entity, cut).agg(*[F.max_by(m, F.when(F.col(m).isNotNull(), F.struct(*order))).alias(m) for m in marks])
        before = Window.partitionBy(entity).orderBy(cut).rowsBetween(Window.unboundedPreceding, -1)
        far = far.select(F.col(entity).alias("__e"), F.col(cut).alias("__c"), *[F.last(m, ignorenulls=True).over(before).alias(f"__far_{m}") for m in marks])
        joined = filled(rows, entity, cut).join(far, (F.col(entity) == F.col("__e")) & (F.col(cut) == F.col("__c")), "left")
        return joined.withColumns({m: F.coalesce(m, f"__far_{m}") for m in marks}).drop("__e", "__c", *[f"__far_{m}" for m in marks])

    return _apart(df, entity, hot, lambda rows: filled(rows, entity), stretched)


# --------------------------------------------------------------------------- rates


def change_rates(df: DataFrame, entity: str, order: Sequence[str], attributes: Sequence[str], cut: Column | None = None) -> DataFrame:
    """``attribute, changes, steps, rate``: how often each attribute differs from the entity's row before.

    NULL counts as a value.  ``cut`` (by default the first of ``order``) divides an entity's rows into
    stretches that follow each other, so that a hot entity is no single window.  No step gives rate 0.
    """
    full_order = list(dict.fromkeys([*order, *attributes]))
    known = df.filter(F.col(entity).isNotNull()).select(entity, *full_order, (F.col(order[0]) if cut is None else cut).alias("__cut"))
    hot = hot_entities(known, entity)
    if not hot:
        known = known.drop("__cut")
    prev = neighbour(known, entity, "__cut", full_order, F.struct(*attributes), "__p", hot=hot).filter(F.col("__p").isNotNull())
    sums = prev.agg(F.count(F.lit(1)).alias("steps"), *[F.count_if(~F.col(c).eqNullSafe(F.col(f"__p.{c}"))).alias(c) for c in attributes])
    return sums.unpivot(["steps"], list(attributes), "attribute", "changes").select(
        "attribute",
        "changes",
        "steps",
        F.round(F.coalesce(F.try_divide(F.col("changes").cast("double"), F.col("steps")), F.lit(0.0)), 4).alias("rate"),
    )


def split_by_rate(rates: DataFrame, threshold: float = 0.5) -> dict[str, list[str]]:
    """Attribute names in ``slow`` and ``fast`` (one row per attribute is collected: the width of the table)."""
    groups: dict[str, list[str]] = {"slow": [], "fast": []}
    for r in rates.collect():
        groups["fast" if r["rate"] > threshold else "slow"].append(r["attribute"])
    return {k: sorted(v) for k, v in groups.items()}


# --------------------------------------------------------------------------- satellites


class Satellite:
    """One group of attributes of all entities, in a folder of the shared file system.

    ``append`` takes observations: ``entity_key, version_key, day``, ``first_seen`` (may be NULL), the columns
    of ``order`` and the group's ``attributes``, one row each time a state was seen, in any order and as
    often as one likes.  Without ``attributes`` the version key is the only one.

    A row begins where the hash diff differs from the entity's observation before; a state that returns after
    another is a new row; gaps end nothing.  ``valid_from`` is the earliest of the row's days and those
    ``first_seen`` that are not after their own row's day and are after the last day of the version before.

    Observations without entity, version or day are left out; repeated ones change nothing.  Of two states
    on one day the lower version key comes first (or what ``order`` says).  Late observations may split a
    row, begin one earlier or make one void: the entity's rows are derived again, and those that differ from
    what is stored are appended; the newest batch stands.  Nothing stored is ever changed.  A batch that
    failed half-way can be appended again.
    """

    def __init__(self, spark: SparkSession, path: str, *, attributes: Sequence[str] = (), order: Sequence[str] = ("day", "version_key")):
        self.spark, self.path = spark, path
        self.attributes = list(attributes)
        self.order = [*order, "hash_diff"]
        self.key = list(dict.fromkeys(["entity_key", "day", "version_key", *self.order]))
        self._schemas: dict[str, T.StructType] = {}
        self._hot: list[str] | None = None  #: of the observations last derived from
        self._one_batch = False

    def _table(self, what: str) -> DataFrame | None:
        if not path_exists(self.spark, f"{self.path}/{what}"):
            return None
        reader = self.spark.read.schema(self._schemas[what]) if what in self._schemas else self.spark.read
        return reader.parquet(f"{self.path}/{what}")

    def append(self, observations: DataFrame) -> None:
        seen, stored = self._table("seen"), self._table("rows")
        batch = 0 if stored is None else (stored.agg(F.max("batch").alias("b")).first()["b"] or 0) + 1
        valid = observations.filter(F.col("entity_key").isNotNull() & F.col("version_key").isNotNull() & F.col("day").isNotNull())
        first = F.when(F.col("first_seen") <= F.col("day"), F.col("first_seen"))
        found = valid.withColumn("hash_diff", F.unhex(hash_diff(list(dict.fromkeys(["version_key", *self.attributes]))))).select(
            *self.key, F.coalesce(first, F.lit("")).alias("first_seen")
        )
        fresh = found if seen is None else found.distinct().join(seen, found.columns, "left_anti")
        fresh.write.mode("append").parquet(f"{self.path}/seen")
        seen = self.spark.read.schema(found.schema).parquet(f"{self.path}/seen")
        if stored is None:
            rows = self._derive(seen)
        else:
            touched = found.select("entity_key").distinct()
            latest = self._latest(stored.join(touched, "entity_key", "left_semi")).withColumnRenamed("valid_from", "__was").withColumn("__stored", F.lit(True))
            now = self._derive(seen.join(touched, "entity_key", "left_semi")).withColumn("__now", F.lit(True))
            both = now.join(latest, self.key, "full")
            # what begins no row any more is void: a row without valid_from
            rows = both.filter(F.col("__stored").isNull() | ~F.col("valid_from").eqNullSafe(F.col("__was"))).select(*self.key, "valid_from")
        rows = rows.withColumn("batch", F.lit(batch).cast("bigint"))
        rows.write.mode("append").parquet(f"{self.path}/rows")
        self._schemas, self._one_batch = {"seen": found.schema, "rows": rows.schema}, stored is None

    def _derive(self, seen: DataFrame) -> DataFrame:
        hot = self._hot = hot_entities(seen, "entity_key")
        # one shuffle for all that follows; hot entities go by (entity, day)
        states = (seen if hot else seen.repartition("entity_key")).groupBy(*self.key).agg(F.collect_set(F.nullif(F.col("first_seen"), F.lit(""))).alias("first_seen"))
        order = self.order if self.order[0] == "day" else ["day", *self.order]
        at = neighbour(states, "entity_key", "day", order, F.struct("day", "version_key", "hash_diff"), "__prev", hot=hot)
        begins = F.col("__prev").isNull() | (F.col("__prev.hash_diff") != F.col("hash_diff"))
        new_version = F.col("__prev").isNull() | (F.col("__prev.version_key") != F.col("version_key"))
        at = at.withColumn("__row", F.when(begins, F.struct(*[F.col(c) for c in self.key if c != "entity_key"])))
        at = at.withColumn("__version", F.when(new_version, F.struct(F.col("__prev.day").alias("before"))))
        runs = carried(at, "entity_key", "day", order, ["__row", "__version"], hot)
        before = F.col("__version.before")
        earliest = F.array_min(F.filter("first_seen", lambda f: before.isNull() | (f > before)))
        return runs.groupBy("entity_key", "__row").agg(F.min(F.least("day", earliest)).alias("valid_from")).select("entity_key", "__row.*", "valid_from").select(*self.key, "valid_from")

    def _latest(self, stored: DataFrame) -> DataFrame:
        newest = F.max(F.struct("batch", "valid_from"))["valid_from"].alias("valid_from")
        return stored.groupBy(*self.key).agg(newest).filter("valid_from IS NOT NULL")

    def rows(self) -> DataFrame:
        """What stands of the stored rows: the newest of each beginning that is not void."""
        stored = self._table("rows")
        if self._one_batch:  # it has no beginning twice
            return stored.drop("batch")
        return self._latest(stored)

    def history(self) -> DataFrame:
        """``entity_key, version_key, valid_from, valid_to``: the end is the next version's start, '' if none."""
        order = self.order if self.order[0] == "day" else ["day", *self.order]
        rows = self.rows()
        # an entity has no more rows than observations, so one that is not hot there is no large task here
        hot = hot_entities(rows, "entity_key") if self._hot is None or not self._one_batch else self._hot
        if not hot:
            rows = rows.repartition("entity_key")
        if self.attributes:  # several rows may belong to one version
            at = neighbour(rows, "entity_key", "day", order, F.struct("version_key"), "__prev", hot=hot)
            new = F.col("__prev").isNull() | (F.col("__prev.version_key") != F.col("version_key"))
            at = at.withColumn("__start", F.when(new, F.struct(*[c for c in self.key if c != "entity_key"])))
            runs = carried(at, "entity_key", "day", order, ["__start"], hot)
            rows = runs.groupBy("entity_key", "__start").agg(F.min("valid_from").alias("valid_from")).select("entity_key", "__start.*", "valid_from")
        out = neighbour(rows, "entity_key", "day", order, F.struct("valid_from"), "__next", ahead=True, hot=hot)
        return out.select("entity_key", "version_key", "valid_from", F.coalesce("__next.valid_from", F.lit("")).alias("valid_to"))
