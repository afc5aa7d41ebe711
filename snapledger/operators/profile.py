"""Column-level quality: exact base aggregates and a classifier two-sample test between loads.

If a classifier can tell the rows of two loads apart on held-out data, their
distributions differ; the discrimination lost when a column is taken out of
the model says which column it is.

``load_shifts`` does this on rows.  ``fill_breaks`` does it on counts, as
inventories hold them: the records of one field in one load are two weighted
rows (filled or not).  A logistic regression is trained for every load against
the nearest levels of its field, where the field's loads lie; what decides is
its discrimination of the fold it has not seen and the loss without the column.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator, Mapping, Sequence
from math import exp, log, log1p, sqrt

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean
from ..session import ship
from ..sources.tables import materialise


def base_profile(df: DataFrame, columns: Sequence[str] | None = None, patterns: Mapping[str, str] | None = None) -> DataFrame:
    """Exact aggregates per column: rows, nulls, distinct values, range, lengths, pattern violations.

    Values are taken as text, NULL and the texts of a null as missing.  The table is turned into
    (column, value) and counted with map-side combine, so a hot value travels once per task and exact
    distinct counts need no second pass.  ``patterns`` names a regular expression per column; other
    columns have NULL violations.  An empty table gives one row per column with zero counts.
    """
    columns = list(columns or df.columns)
    patterns = dict(patterns or {})
    text = df.select([clean(F.col(f"`{c}`").cast("string")).alias(f"c{i}") for i, c in enumerate(columns)])
    pairs = text.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"c{i}").alias("v")) for i in range(len(columns))])).alias("p"))
    counted = pairs.groupBy(F.col("p.i").alias("i"), F.col("p.v").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    broken = F.lit(None).cast("boolean")
    for name, pattern in patterns.items():
        broken = F.when(F.col("i") == columns.index(name), ~F.col("v").rlike(pattern)).otherwise(broken)
    spark = df.sparkSession
    names = spark.createDataFrame([(i, c) for i, c in enumerate(columns)], "i int, column_name string")
    stats = counted.withColumn("broken", broken).groupBy("i").agg(
        F.sum("n").alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("n"))), F.lit(0)).alias("non_null_rows"),
        F.count("v").alias("distinct_values"),
        F.min("v").alias("min_value"),
        F.max("v").alias("max_value"),
        F.min(F.length("v")).cast("bigint").alias("min_length"),
        F.max(F.length("v")).cast("bigint").alias("max_length"),
        F.sum(F.when(F.col("broken").isNotNull(), F.when(F.col("broken"), F.col("n")).otherwise(0))).alias("pattern_violations"),
    )
    zero = {c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("total_rows", "non_null_rows", "distinct_values")}
    return names.join(stats, "i", "left").select(
        "column_name", *zero.values(),
        F.round(F.coalesce(F.try_divide((F.col("total_rows") - F.col("non_null_rows")).cast("double"), F.col("total_rows").cast("double")), F.lit(0.0)), 6).alias("null_rate"),
        "min_value", "max_value", "min_length", "max_length", "pattern_violations",
    )


# --------------------------------------------------------------------------- counts


def inventory_fields(df: DataFrame, feed: str = "feed", load: str = "load_no", table: str = "table_name", field: str = "field_name") -> DataFrame:
    """One row per (feed, load, table, field): names trimmed in lower case, repeated rows merged.

    Rows without a feed, load, table or field are left out.  Where repeated rows disagree the one with the
    largest total, then the most filled rows stands whole (missing is lowest).
    """
    return (
        df.select(
            clean(feed).alias("feed"), F.col(load).cast("bigint").alias("load_no"), F.lower(clean(table)).alias("table_name"),
            F.lower(clean(field)).alias("field_name"), F.col("non_null_rows").cast("bigint").alias("nn"), F.col("total_rows").cast("bigint").alias("tot"),
        )
        .na.drop(subset=["feed", "load_no", "table_name", "field_name"])
        .groupBy("feed", "load_no", "table_name", "field_name")
        .agg(F.max(F.struct("tot", "nn")).alias("c"))
        .select("feed", "load_no", "table_name", "field_name", "c.nn", "c.tot")
    )


def contradictions(fields: DataFrame) -> DataFrame:
    """``fields`` with ``usual_total`` and ``contradicts``.

    A count contradicts itself (below zero, more filled rows than rows) or the other fields of its
    load and table: a total other than the one most of them give.  Totals on which no two fields agree,
    or two totals given equally often, accuse nobody.  Missing counts are no contradiction.
    """
    by = ["feed", "load_no", "table_name"]
    totals = fields.filter(F.col("tot").isNotNull()).groupBy(*by, "tot").agg(F.count(F.lit(1)).alias("n"))
    # one row per distinct total, then one per table and load: nothing larger than that meets in a task
    usual = (
        totals.groupBy(*by)
        .agg(F.max(F.struct("n", "tot")).alias("m"), F.min(F.struct(-F.col("n"), "tot")).alias("m2"))
        .select(*by, F.when(F.col("m.tot") == F.col("m2.tot"), F.col("m.tot")).alias("usual_total"))
    )
    own = (F.col("nn") < 0) | (F.col("tot") < 0) | (F.col("nn") > F.col("tot"))
    others = (F.col("tot") != F.col("usual_total")) | (F.col("nn") > F.col("usual_total"))
    flag = F.coalesce(own, F.lit(False)) | F.coalesce(others, F.lit(False))
    return fields.join(usual, by, "left").withColumn("contradicts", flag)


def fit_logistic(filled: Sequence[float], steps: int = 25, ridge: float = 1e-4) -> tuple[float, float]:
    """Intercept and slope of a logistic regression on one yes-or-no column.

    ``filled`` holds the shares of yes of the old and the new records; both weigh alike.  Newton's method
    on the penalised likelihood, with the steps halved where they overshoot; shares of 0 and 1 are no trouble.
    """
    cells = [(0.0, 0.0, (1 - filled[0]) / 2), (1.0, 0.0, filled[0] / 2), (0.0, 1.0, (1 - filled[1]) / 2), (1.0, 1.0, filled[1] / 2)]

    def loss(a: float, b: float) -> float:
        return sum(w * (log1p(exp(-abs(a + b * x))) + max(a + b * x, 0.0) - y * (a + b * x)) for x, y, w in cells) + ridge * (a * a + b * b) / 2

    a = b = 0.0
    now = loss(a, b)
    for _ in range(steps):
        ga, gb, haa, hab, hbb = ridge * a, ridge * b, ridge, 0.0, ridge
        for x, y, w in cells:
            p = 1 / (1 + exp(-max(-500.0, min(500.0, a + b * x))))
            ga, gb = ga + w * (p - y), gb + w * (p - y) * x
            haa, hab, hbb = haa + w * p * (1 - p), hab + w * p * (1 - p) * x, hbb + w * p * (1 - p) * x * x
        det = haa * hbb - hab * hab
        da, db, scale = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det, 1.0
        while loss(a - scale * da, b - scale * db) > now + 1e-12 and scale > 1e-4:
            scale /= 2
        a, b = a - scale * da, b - scale * db
        before, now = now, loss(a, b)
        if before - now < 1e-9:
            break
    return a, b


def two_sample(share: float, level_folds: Sequence[float]) -> tuple[float, float]:
    """Cross-fitted discrimination (AUC) of a load's records from a level's, and the log loss per record without the column.

    The level's loads fall in two folds; the regression is trained on the load and one fold and judged on
    the load and the other, both ways.
    """
    auc = gain = 0.0
    for train, held in ((0, 1), (1, 0)):
        a, b = fit_logistic((level_folds[train], share))
        slope = (b > 0) - (b < 0)
        auc += (0.5 + slope * (share - level_folds[held]) / 2) / 2
        for x, y, w in ((0, 0, 1 - level_folds[held]), (1, 0, level_folds[held]), (0, 1, 1 - share), (1, 1, share)):
            s = a + b * x
            gain += w / 4 * (log(2) - (log1p(exp(-abs(s))) + max(s, 0.0) - y * s))
    return auc, gain


class _Level:
    """Loads of one share: their counts in two folds."""

    def __init__(self):
        self.nn, self.tot, self.loads = [0.0, 0.0], [0.0, 0.0], 0

    def add(self, nn: float, tot: float) -> None:
        fold = self.loads % 2
        self.nn[fold] += nn
        self.tot[fold] += tot
        self.loads += 1

    @property
    def all(self) -> tuple[float, float]:
        return sum(self.nn), sum(self.tot)

    def folds(self) -> list[float]:
        whole = sum(self.nn) / sum(self.tot)
        return [n / t if t else whole for n, t in zip(self.nn, self.tot, strict=True)]


class _Field:
    """What is known of one field while its loads pass in order: its levels by share and its usual swing."""

    def __init__(self, swing: float, swing_weight: float):
        self.levels: list[_Level] = []
        self.shares: list[float] = []
        self.squares, self.weight = swing * swing * swing_weight, swing_weight

    def nearest(self, share: float) -> list[_Level]:
        at = bisect_left(self.shares, share)
        return self.levels[max(0, at - 1) : at + 1]

    def compare(self, nn: float, tot: float, level: _Level) -> tuple[float, float, float, float]:
        """``z`` of the cross-fitted discrimination, AUC, loss without the column, level."""
        share, (lnn, ltot) = nn / tot, level.all
        auc, gain = two_sample(share, level.folds())
        p, q = (lnn + 0.5) / (ltot + 1.0), (nn + 2.0) / (tot + 4.0)
        variance = max(p * (1 - p), q * (1 - q)) / tot + p * (1 - p) / ltot + self.squares / self.weight
        return max(2 * auc - 1 - 0.5 / tot, 0.0) / sqrt(variance), auc, gain, lnn / ltot

    def join(self, nn: float, tot: float, level: _Level) -> None:
        lnn, ltot = level.all
        p = (lnn + nn + 1) / (ltot + tot + 2)
        chance = p * (1 - p) * (1 / tot + 1 / ltot)
        self.squares = max(0.0, self.squares + ((nn / tot - lnn / ltot) ** 2 - chance) / (1 + 1 / level.loads))
        self.weight += 1
        self._place(level, nn, tot)

    def begin(self, nn: float, tot: float) -> None:
        self._place(_Level(), nn, tot)

    def _place(self, level: _Level, nn: float, tot: float) -> None:
        if level.loads:
            at = next(i for i, known in enumerate(self.levels) if known is level)
            del self.levels[at], self.shares[at]
        level.add(nn, tot)
        share = level.all[0] / level.all[1]
        at = bisect_left(self.shares, share)
        self.levels.insert(at, level)
        self.shares.insert(at, share)


_BREAK = "feed string, load_no bigint, table_name string, field_name string, share double, level double, auc double, ablation_loss double, z double"


def fill_breaks(fields: DataFrame, *, z_min: float = 6.0, swing: float = 0.009, swing_weight: float = 3.0, same_z: float = 2.5) -> DataFrame:
    """Loads whose share of filled rows is off the level of the field's earlier loads in its feed.

    ``fields``: ``feed, load_no, table_name, field_name, nn, tot`` with counts that hold (see
    :func:`contradictions`).  The loads of a field pass in order.  Each is told from the nearest levels the
    field has had by a cross-fitted logistic regression (:func:`two_sample`).  It belongs to the level it is
    told from least if its discrimination is within ``same_z`` standard errors, and begins a level of its
    own otherwise.  It is a case if even from that level it is told by ``z_min`` standard errors, and if
    without the column the held-out loss would be higher.  So only the first load of a lasting shift is a
    case, and a return to any earlier level is none.

    The standard error has the chance of both samples and the field's usual swing: the variance of its
    loads about their level beyond chance, drawn towards ``swing`` (a share) with the weight of
    ``swing_weight`` loads.  Small loads follow the same rule and weigh by their rows.  Loads with no rows
    are skipped; a field's first load is never a case.

    Result: the keys, ``share``, ``level``, ``auc``, ``ablation_loss`` and ``z``.  A field's loads pass
    through a task one by one; what is kept of them are its levels.
    """
    ship(fields.sparkSession)
    keys = ["feed", "table_name", "field_name"]
    rows = fields.filter((F.col("tot") > 0) & (F.col("nn") >= 0) & (F.col("nn") <= F.col("tot"))).select(*keys, "load_no", "nn", "tot")
    ordered = rows.repartition(*keys).sortWithinPartitions(*keys, "load_no")

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, field = None, _Field(swing, swing_weight)
        for b in batches:
            out = []
            for feed, table, name, load, nn, tot in zip(b["feed"], b["table_name"], b["field_name"], b["load_no"], b["nn"], b["tot"], strict=True):
                if key != (feed, table, name):
                    key, field = (feed, table, name), _Field(swing, swing_weight)
                found = [(*field.compare(nn, tot, level), level) for level in field.nearest(nn / tot)]
                if not found:
                    field.begin(nn, tot)
                    continue
                z, auc, gain, share_of, level = min(found, key=lambda f: (f[0], -f[4].loads))
                if z <= same_z:
                    field.join(nn, tot, level)
                    continue
                if z >= z_min and gain > 0:
                    out.append((feed, load, table, name, nn / tot, share_of, auc, gain, z))
                field.begin(nn, tot)
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _BREAK.split(", ")])

    return ordered.mapInPandas(run, _BREAK)


def quality_breaks(inventory: DataFrame, **settings: float) -> DataFrame:
    """``feed, load_no, table_name, field_name, reason`` of all broken counts: contradictions and share breaks.

    A load whose count contradicts is left out of the levels.  ``settings`` go to :func:`fill_breaks`.
    """
    checked = materialise(contradictions(inventory_fields(inventory)), "checked-counts")
    keys = ["feed", "load_no", "table_name", "field_name"]
    bad = checked.filter("contradicts").select(*keys, F.lit("contradiction").alias("reason"))
    off = fill_breaks(checked.filter(~F.col("contradicts")).select(*keys, "nn", F.coalesce("tot", "usual_total").alias("tot")), **settings)
    return bad.unionByName(off.select(*keys, F.lit("share").alias("reason")))


# --------------------------------------------------------------------------- rows


def load_shifts(
    df: DataFrame, load: str, columns: Sequence[str], *, unit: str | None = None, buckets: int = 64, iterations: int = 25, bins: int = 1000, parallel: int = 3
) -> DataFrame:
    """Which columns tell each load from the one before: ``load, prev_load, column_name, auc, auc_without, ablation``.

    Every pair of consecutive values of ``load`` is tested, so a break shows at its load and its end at
    the load of the return.  Each column gives a missing flag, its (scaled) number if it reads as one,
    and hashed indicators of its value in ``buckets`` classes.  Rows are split in two folds by a hash of
    their ``unit``, if they have one, else of their content (with keys or times among the columns a unit is
    needed: split over both folds, its old row would speak against its new one); a logistic regression per pair is trained on each fold (distributed, both loads
    weighted alike) and scores the other.  ``ablation`` is the held-out AUC lost when a column's terms are
    left out of the score.

    Equal rows of a load are counted once for all pairs; ``parallel`` pairs are trained at a time, and all
    models score in one pass, their coefficients (pairs x 2 x columns x buckets) broadcast.  Scores are
    counted in ``bins`` bins per column before ranking, so nothing but counts meets in a task.  Rows
    without a load are left out; a pair of which a fold lacks either load gives no rows; a column that is
    constant has ablation 0.  Repeated rows fall in one fold.
    """
    from multiprocessing.pool import ThreadPool

    from pyspark import inheritable_thread_target
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import OneHotEncoder, VectorAssembler

    spark, kind = df.sparkSession, df.schema[load].dataType.simpleString()
    n_cols = range(len(columns))
    flags, numbers, slots, hots = ([f"{p}{i}" for i in n_cols] for p in ("flag", "number", "slot", "hot"))
    text = df.filter(F.col(load).isNotNull()).select(
        F.col(load).alias("load"), (F.col(unit) if unit else F.lit(None)).cast("string").alias("unit"), *[clean(F.col(f"`{c}`").cast("string")).alias(f"t{i}") for i, c in enumerate(columns)]
    )
    # only what may read as a number is cast: a failed cast costs far more than the look at it, and most hashes and uuids begin with a digit
    like = r"^[+-]?([0-9.][0-9.eE+-]*[dDfF]?[\x00-\x20]*$|0[xX]|(?i:inf|nan))"
    number = [F.when(F.col(f"t{i}").rlike(like), F.coalesce(F.col(f"t{i}").try_cast("double"), F.lit(0.0))).otherwise(0.0) for i in n_cols]
    known = [F.coalesce(F.col(f"t{i}"), F.lit("\x00")) for i in n_cols]
    featured = text.select(
        "load", F.pmod(F.when(F.col("unit").isNotNull(), F.xxhash64("unit")).otherwise(F.xxhash64(*known)), F.lit(2)).cast("int").alias("fold"),
        *[F.col(f"t{i}").isNull().cast("double").alias(flags[i]) for i in n_cols],
        *[(F.signum(number[i]) * F.log1p(F.abs(number[i])) / 10).alias(numbers[i]) for i in n_cols],
        *[F.pmod(F.xxhash64(known[i]), F.lit(buckets)).cast("int").alias(slots[i]) for i in n_cols],
    )
    # equal rows of a load are one row with a weight; kept in parts by load and fold, so that a model reads those of its loads only
    combos = featured.groupBy("load", "fold", *flags, *numbers, *slots).agg(F.count(F.lit(1)).cast("double").alias("n"))
    combos = combos.withColumn("part", F.pmod(F.xxhash64("load", "fold"), F.lit(64)).cast("int"))
    # every class has its place whether it occurs or not, so the encoder needs no look at the rows
    encoder = OneHotEncoder(inputCols=slots, outputCols=hots, dropLast=False, handleInvalid="error").fit(
        spark.range(buckets).select(*[F.col("id").cast("int").alias(c) for c in slots])
    )
    width = 2 + buckets
    inputs = [x for i in n_cols for x in (flags[i], numbers[i], hots[i])]
    vectors = VectorAssembler(inputCols=inputs, outputCol="features").transform(encoder.transform(combos.sortWithinPartitions("part", "load", "fold")))
    data = materialise(vectors.drop(*hots), "load-vectors", by=["part"])
    counts = data.groupBy("load", "fold", "part").agg(F.sum("n").alias("n")).collect()
    sizes, parts = ({(r["load"], r["fold"]): r[c] for r in counts} for c in ("n", "part"))
    loads = sorted({at for at, _ in sizes})
    wanted = [
        (old, new, fold) for old, new in zip(loads, loads[1:], strict=False) if all((x, f) in sizes for x in (old, new) for f in (0, 1)) for fold in (0, 1)
    ]
    if not wanted:
        return spark.createDataFrame([], f"load {kind}, prev_load {kind}, column_name string, auc double, auc_without double, ablation double")
    def trained(pair: tuple) -> list[list[float]]:
        """Coefficients per column: missing flag, number, value classes."""
        old, new, fold = pair
        a, b = sizes[old, fold], sizes[new, fold]
        is_new = F.col("load") == F.lit(new)
        own_parts = F.col("part").isin(parts[old, fold], parts[new, fold])
        part = data.filter(own_parts & F.col("load").isin(old, new) & (F.col("fold") == fold)).select(
            is_new.cast("double").alias("label"), (F.col("n") * F.when(is_new, (a + b) / (2 * b)).otherwise((a + b) / (2 * a))).alias("w"), "features"
        )
        model = LogisticRegression(weightCol="w", regParam=0.01, maxIter=iterations, standardization=False).fit(part)
        beta = [float(v) for v in model.coefficients]
        return [beta[width * i : width * (i + 1)] for i in n_cols]

    pool = ThreadPool(min(parallel, len(wanted)))
    try:
        betas = pool.map(inheritable_thread_target(spark)(trained), wanted, chunksize=1)
    finally:
        pool.terminate()
    models = spark.createDataFrame(
        [(at, 1 - fold, label, new, old, beta) for (old, new, fold), beta in zip(wanted, betas, strict=True) for at, label in ((old, 0.0), (new, 1.0))],
        f"load {kind}, fold int, label double, new_load {kind}, prev_load {kind}, beta array<array<double>>",
    )
    own = [
        F.col(flags[i]) * F.col("beta")[i][0] + F.col(numbers[i]) * F.col("beta")[i][1]
        + F.coalesce(F.try_element_at(F.col("beta")[i], F.col(slots[i]) + 3), F.lit(0.0))
        for i in n_cols
    ]
    # a row is scored once as new and once as old, by the models that were not trained on its fold
    scored = data.join(F.broadcast(models), ["load", "fold"]).select("new_load", "prev_load", "fold", "label", "n", *[t.alias(f"s{i}") for i, t in enumerate(own)])
    total = sum((F.col(f"s{i}") for i in n_cols), F.lit(0.0))
    variants = [F.struct(F.lit("").alias("c"), total.alias("s"))] + [
        F.struct(F.lit(c).alias("c"), (total - F.col(f"s{i}")).alias("s")) for i, c in enumerate(columns)
    ]
    counted = (
        scored.select("new_load", "prev_load", "fold", "label", "n", F.explode(F.array(*variants)).alias("v"))
        .groupBy("new_load", "prev_load", "fold", F.col("v.c").alias("c"), F.floor(F.tanh(F.col("v.s") / 4) * (bins / 2)).alias("bin"))
        .agg(F.sum(F.when(F.col("label") == 1.0, F.col("n")).otherwise(0.0)).alias("p"), F.sum(F.when(F.col("label") == 0.0, F.col("n")).otherwise(0.0)).alias("n"))
    )
    w = Window.partitionBy("new_load", "fold", "c").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counted.withColumn("below", F.coalesce(F.sum("n").over(w), F.lit(0)))
    by = ["new_load", "prev_load", "c"]
    aucs = ranked.groupBy(*by, "fold").agg((F.sum(F.col("p") * (F.col("below") + F.col("n") / 2)) / (F.sum("p") * F.sum("n"))).alias("auc"))
    mean = aucs.groupBy(*by).agg(F.avg("auc").alias("auc"))
    full = F.max(F.when(F.col("c") == "", F.col("auc"))).over(Window.partitionBy("new_load"))  # a row per column
    return (
        mean.withColumn("full", full).filter("c <> ''")
        .select(
            F.col("new_load").alias("load"), "prev_load", F.col("c").alias("column_name"), F.round("full", 6).alias("auc"),
            F.round("auc", 6).alias("auc_without"), F.round(F.col("full") - F.col("auc"), 6).alias("ablation"),
        )
    )


def load_shift(old: DataFrame, new: DataFrame, columns: Sequence[str], **settings: int) -> DataFrame:
    """Which columns tell two loads apart: ``column_name, auc, auc_without, ablation`` (see :func:`load_shifts`)."""
    rows = [df.select(F.lit(at).alias("__load"), *[F.col(f"`{c}`").cast("string") for c in columns]) for at, df in enumerate((old, new))]
    return load_shifts(rows[0].unionByName(rows[1]), "__load", columns, **settings).drop("load", "prev_load")
