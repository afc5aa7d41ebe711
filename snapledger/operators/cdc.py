"""Change classification of a snapshot against the state kept from the one before.

``compare`` needs one shuffle of each side on the business key.  Rows without a
key never match and go past the join.  Everything is column arithmetic, so the
join's output stays in one code-generated stage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import changed_columns, is_missing, labelled_key, normalise_id, row_hash, token_count

# The tracking columns put before the columns of a state table.
TRACKING = (
    "EXTRACT_DATE", "EXTRACT_DATETIME_UTC", "FIRST_SEEN_DATE", "FIRST_SEEN_DATETIME_UTC", "LAST_SEEN_DATE", "LAST_SEEN_DATETIME_UTC",
    "CHANGE_TYPE", "CHANGED_COLUMNS", "CHANGED_COLUMNS_COUNT", "CHANGE_SUMMARY", "BUSINESS_KEY", "ENTITY_VARIANT_KEY", "ROW_HASH",
)


@dataclass(frozen=True)
class CdcSpec:
    """What identifies an entity and how its changes are named.

    ``changes``: (change type, columns) by priority, the first with a differing column names the change.
    ``severities`` by change type; ``raised``: (change type, column, ranks): where the new value's rank is
    higher than the old one's, the severity is HIGH.  ``summaries``: (column, label) by priority.
    """

    key: Sequence[str]
    variant: Sequence[str] = ()
    variant_change: str | None = None
    changes: Sequence[tuple[str, Sequence[str]]] = ()
    severities: Mapping[str, str] = field(default_factory=lambda: {"KEY_MISSING": "HIGH", "UPDATED": "LOW"})
    raised: tuple[str, str, Mapping[str, int]] | None = None
    summaries: Sequence[tuple[str, str]] = ()


def source_columns(df: DataFrame) -> list[str]:
    """The frame's own columns without tracking ones, whatever their letter case."""
    skip = {t.upper() for t in TRACKING} | {"KEY_MISSING_FLAG"}
    return [c for c in df.columns if c.upper() not in skip]


def key_missing(df: DataFrame, key: Sequence[str]) -> Column:
    """TRUE where a key part is missing, and for every row if a key column is absent."""
    have = {c.upper() for c in df.columns}
    out = F.lit(False)
    for k in key:
        out = out | (is_missing(k) if k.upper() in have else F.lit(True))
    return out


def _built_keys(df: DataFrame, spec: CdcSpec) -> dict[str, Column]:
    missing = key_missing(df, spec.key)
    present = {c.upper() for c in df.columns}
    key = labelled_key([k for k in spec.key if k.upper() in present])
    variant = labelled_key([k for k in (spec.variant or spec.key) if k.upper() in present])
    return {
        "BUSINESS_KEY": F.when(~missing, key), "ENTITY_VARIANT_KEY": F.when(~missing, variant), "ROW_HASH": row_hash(source_columns(df)),
    }


def with_keys(df: DataFrame, spec: CdcSpec) -> DataFrame:
    """``df`` with BUSINESS_KEY (NULL if a part is missing), ENTITY_VARIANT_KEY, ROW_HASH, KEY_MISSING_FLAG."""
    built = [c.alias(n) for n, c in _built_keys(df, spec).items()]
    return df.select(*source_columns(df), key_missing(df, spec.key).alias("KEY_MISSING_FLAG"), *built)


def one_per_key(keyed: DataFrame) -> DataFrame:
    """The row with the lowest (hash, variant) of each key, as a combinable minimum; rows without a key stay, but exact copies of one."""
    rest = [c for c in keyed.columns if c not in ("BUSINESS_KEY", "ROW_HASH", "ENTITY_VARIANT_KEY", "KEY_MISSING_FLAG")]
    order = F.struct(F.col("ROW_HASH").isNull(), "ROW_HASH", F.col("ENTITY_VARIANT_KEY").isNull(), "ENTITY_VARIANT_KEY", *rest)
    first = keyed.filter("NOT KEY_MISSING_FLAG").groupBy("BUSINESS_KEY").agg(F.min_by(F.struct(*keyed.columns), order).alias("r")).select("r.*")
    return first.unionByName(keyed.filter("KEY_MISSING_FLAG").dropDuplicates())


def duplicate_groups(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The key and ``n`` of groups with more than one row."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def duplicate_keys(keyed: DataFrame) -> DataFrame:
    """``BUSINESS_KEY, n`` of keys with more than one distinct row."""
    return duplicate_groups(keyed.filter("NOT KEY_MISSING_FLAG").dropDuplicates(), ["BUSINESS_KEY"])


def latest_rows(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Each key's row that is greatest in ``order`` (NULL lowest), as a combinable maximum; rows without a key are left out."""
    best = F.max_by(F.struct(*df.columns), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]))
    return df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(best.alias("r")).select("r.*")


def previous_state(prev: DataFrame, spec: CdcSpec) -> DataFrame:
    """The latest row of each key of a kept state; key and hash are rebuilt where an older state lacks them."""
    have = {c.upper(): c for c in prev.columns}
    built = {n: F.coalesce(F.col(have[n]), c) if n in have else c for n, c in _built_keys(prev, spec).items()}
    days = {n: F.col(have[n]) if n in have else F.lit(None).cast("string") for n in ("FIRST_SEEN_DATE", "LAST_SEEN_DATE")}
    rows = prev.select(*source_columns(prev), *[c.alias(n) for n, c in (built | days).items()])
    # of equal days the row of the lowest hash, so the day goes first and then a combinable minimum
    lowest = F.min_by(F.struct(*rows.columns), F.struct(F.col("ROW_HASH").isNull(), "ROW_HASH", "ENTITY_VARIANT_KEY"))
    newest = rows.filter("BUSINESS_KEY IS NOT NULL").groupBy("BUSINESS_KEY", "LAST_SEEN_DATE").agg(lowest.alias("r")).select("r.*")
    return latest_rows(newest, "BUSINESS_KEY", [F.col("LAST_SEEN_DATE")])


def comparable(cur: DataFrame, prev: DataFrame) -> bool:
    """Whether the old state has a row hash and every current column; otherwise a match is UNCHANGED."""
    have = {c.upper() for c in prev.columns}
    return "ROW_HASH" in have and all(c.upper() in have for c in source_columns(cur))


def compare(cur: DataFrame, prev: DataFrame, spec: CdcSpec, day: str, *, removed: bool = False) -> DataFrame:
    """State rows of ``cur`` classified against ``prev``: tracking columns, severity and the source columns.

    NEW, UNCHANGED, one of the spec's changes, UPDATED or KEY_MISSING; with ``removed`` also the rows of
    keys that are gone, as REMOVED.  An empty ``prev`` makes everything NEW, an empty ``cur`` gives no rows.
    Changed columns are named in the order of their names.  First-seen days are carried over; a match
    without one keeps today's.
    """
    own = source_columns(cur)
    same_schema = comparable(cur, prev)
    now = one_per_key(with_keys(cur, spec))
    old = previous_state(prev, spec)
    shared = [c for c in own if c in old.columns]
    before = old.select(
        "BUSINESS_KEY", F.col("ENTITY_VARIANT_KEY").alias("__v"), F.col("ROW_HASH").alias("__h"), F.col("FIRST_SEEN_DATE").alias("__first"),
        F.lit(True).alias("__known"), *[F.col(c).alias(f"__o_{c}") for c in shared],
    )
    joined = now.join(before, "BUSINESS_KEY", "full" if removed else "left")
    text = {c: (normalise_id(c), normalise_id(f"__o_{c}")) for c in shared}

    def differs(columns: Sequence[str]) -> Column:
        out = F.lit(False)
        for c in columns:
            if c in text:
                out = out | ~text[c][0].eqNullSafe(text[c][1])
        return out

    kind = F.when(F.col("KEY_MISSING_FLAG"), "KEY_MISSING").when(F.col("__known").isNull(), "NEW")
    if removed:
        kind = F.when(F.col("KEY_MISSING_FLAG").isNull(), "REMOVED").when(F.col("KEY_MISSING_FLAG"), "KEY_MISSING").when(F.col("__known").isNull(), "NEW")
    if not same_schema:
        kind = kind.otherwise("UNCHANGED")
    else:
        kind = kind.when(F.col("ROW_HASH") == F.col("__h"), "UNCHANGED")
        if spec.variant_change:
            kind = kind.when(~F.col("ENTITY_VARIANT_KEY").eqNullSafe(F.col("__v")), spec.variant_change)
        for name, columns in spec.changes:
            kind = kind.when(differs(columns), name)
        kind = kind.otherwise("UPDATED")
    updated = F.col("CHANGE_TYPE").startswith("UPDATED")
    names = F.when(updated, changed_columns([(c, F.col(c).cast("string"), F.col(f"__o_{c}").cast("string")) for c in sorted(shared)]))
    severity = F.lit(None).cast("string")
    for name, level in spec.severities.items():
        severity = F.when(F.col("CHANGE_TYPE") == name, level).otherwise(severity)
    if spec.raised and spec.raised[1] in text:
        name, column, ranks = spec.raised
        severity = F.when((F.col("CHANGE_TYPE") == name) & (rank_of(text[column][0], ranks) > rank_of(text[column][1], ranks)), "HIGH").otherwise(severity)
    summary = F.lit(None).cast("string")
    for column, label in reversed(list(spec.summaries)):
        if column in text:
            said = F.concat(F.lit(f"{label}: "), F.coalesce(text[column][1], F.lit("")), F.lit(" -> "), F.coalesce(text[column][0], F.lit("")))
            summary = F.when(updated & differs([column]), said).otherwise(summary)
    return (
        joined.withColumn("CHANGE_TYPE", kind)
        .withColumn("CHANGED_COLUMNS", names)
        .select(
            F.lit(day).alias("EXTRACT_DATE"), F.coalesce("__first", F.lit(day)).alias("FIRST_SEEN_DATE"), F.lit(day).alias("LAST_SEEN_DATE"),
            "CHANGE_TYPE", (severity if same_schema else F.lit(None).cast("string")).alias("CHANGE_SEVERITY"), "CHANGED_COLUMNS",
            F.coalesce(token_count("CHANGED_COLUMNS"), F.lit(0)).cast("bigint").alias("CHANGED_COLUMNS_COUNT"),
            summary.alias("CHANGE_SUMMARY"), "BUSINESS_KEY", F.coalesce("ENTITY_VARIANT_KEY", "__v").alias("ENTITY_VARIANT_KEY"),
            F.coalesce("ROW_HASH", "__h").alias("ROW_HASH"), F.col("__h").alias("OLD_ROW_HASH"), *own,
        )
    )


def rank_of(value: Column, ranks: Mapping[str, int]) -> Column:
    """Rank of a normalised id; NULL if it has none."""
    out = F.lit(None).cast("int")
    for code, rank in ranks.items():
        out = F.when(value == code, rank).otherwise(out)
    return out


def events_of(compared: DataFrame, first_run: bool) -> DataFrame:
    """Rows for the event log: what is not UNCHANGED; on a first run only updates, as everything is new then."""
    return compared.filter(F.col("CHANGE_TYPE").startswith("UPDATED") if first_run else F.col("CHANGE_TYPE") != "UNCHANGED")


def run_statistics(compared: DataFrame) -> DataFrame:
    return compared.groupBy("CHANGE_TYPE").agg(F.count(F.lit(1)).alias("n"))


def run_report(cur: DataFrame, compared: DataFrame, spec: CdcSpec, first_run: bool) -> DataFrame:
    """One row: rows read, keys that came more than once, rows without a key, state rows and events to append."""
    keyed = with_keys(cur, spec)
    read = keyed.agg(F.count(F.lit(1)).alias("source_rows"), F.count_if("KEY_MISSING_FLAG").alias("key_missing_rows"))
    twice = duplicate_groups(keyed.filter("NOT KEY_MISSING_FLAG"), ["BUSINESS_KEY"]).agg(F.count(F.lit(1)).alias("duplicate_keys"))
    kept = compared.agg(F.count(F.lit(1)).alias("state_rows"))
    events = events_of(compared, first_run).agg(F.count(F.lit(1)).alias("appended_events"))
    out = read.withColumn("__j", F.lit(1))
    for one in (twice, kept, events):  # one row each
        out = out.join(F.broadcast(one.withColumn("__j", F.lit(1))), "__j")
    return out.drop("__j")


def first_seen_history(pages: DataFrame, history: DataFrame, hash_col: str, day: str) -> DataFrame:
    """Page rows tagged NEW or UNCHANGED by whether their hash was seen before, with the first day carried over."""
    seen = history.filter(F.col(hash_col).isNotNull()).groupBy(hash_col).agg(F.min("FIRST_SEEN_DATE").alias("__first"))
    joined = pages.join(seen, hash_col, "left")
    return joined.select(
        *pages.columns, F.coalesce("__first", F.lit(day)).alias("FIRST_SEEN_DATE"), F.lit(day).alias("LAST_SEEN_DATE"),
        F.when(F.col("__first").isNull(), "NEW").otherwise("UNCHANGED").alias("CHANGE_TYPE"),
    )


def without_events(log: DataFrame, days: Sequence[str], kinds: Sequence[str], day_col: str = "EVENT_DATE", kind_col: str = "CHANGE_TYPE") -> DataFrame:
    """The log without the rows of the given days and change types; rows where either is NULL stay."""
    hit = F.coalesce(F.col(day_col).isin(*days) & F.col(kind_col).isin(*kinds), F.lit(False))
    return log.filter(~hit)
