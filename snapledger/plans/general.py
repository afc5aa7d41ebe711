"""Queries of the general data problems (p1 to p4, p6, p7), each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import clean, code_key, day_of, number_text, ulid_day, ulid_millis, uuid_key
from ..operators import copy_diff, drift, orphans, profile, satellites, snapshot_diff
from ..sources.tables import scratch_path, table, together

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: SQL forms of the key and null rules, put before the oracles that use them.
_NN = "CASE WHEN lower(trim({0}, ' \t\n\r')) IN ('', 'none', 'nan', 'nat') THEN NULL ELSE trim({0}, ' \t\n\r') END"


def nn(expr: str) -> str:
    return _NN.format(expr)


def uu(expr: str) -> str:
    hexed = f"replace(lower({nn(expr)}), '-', '')"
    return f"substr({hexed},1,8)||'-'||substr({hexed},9,4)||'-'||substr({hexed},13,4)||'-'||substr({hexed},17,4)||'-'||substr({hexed},21,12)"


def dd(expr: str) -> str:
    text = nn(expr)
    return (
        f"CASE WHEN regexp_full_match({text}, '[0-9]{{8}}') THEN substr({text},1,4)||'-'||substr({text},5,2)||'-'||substr({text},7,2) "
        f"ELSE substr({text},1,10) END"
    )


def num(expr: str) -> str:
    return f"coalesce(try_cast({nn(expr)} AS DECIMAL(38,10))::VARCHAR, {nn(expr)})"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


# --------------------------------------------------------------------------- p1


def _actor_references(spark: SparkSession, d: str) -> DataFrame:
    refs, actors = table(spark, d, "actor_dk_intel"), table(spark, d, "actors")
    return orphans.reference_problems(
        refs, actors,
        ref_key=code_key("ACTOR_ID"), ref_day=F.coalesce(day_of("EXTRACT_DATE"), day_of("EXTRACT_DATETIME_UTC")),
        parent_key=code_key("ACTOR_ID"), parent_first=day_of("FIRST_SEEN_DATE"), parent_last=day_of("LAST_SEEN_DATE"),
    ).withColumn("table_name", F.lit("actor_dk_intel"))


def _device_references(spark: SparkSession, d: str) -> DataFrame:
    queue, udi = table(spark, d, "udi_details_queue"), table(spark, d, "udi")
    return orphans.reference_problems(
        queue, udi,
        ref_key=uuid_key("primary_di_uuid"), ref_day=day_of("queued_at_utc"),
        parent_key=uuid_key("uuid"), parent_first=day_of("EXTRACT_DATE"),
        parent_last=F.when(code_key("version_state") == "DISCARDED", day_of("last_update_date")),
    ).withColumn("table_name", F.lit("udi_details_queue"))


def _reference_problems(spark: SparkSession, d: str) -> DataFrame:
    return _actor_references(spark, d).unionByName(_device_references(spark, d))


_P1 = f"""
WITH a AS (SELECT upper({nn('ACTOR_ID')}) k, min({dd('FIRST_SEEN_DATE')}) f, max({dd('LAST_SEEN_DATE')}) l FROM actors GROUP BY 1),
u AS (SELECT {uu('uuid')} k, min({dd('EXTRACT_DATE')}) f,
             max(CASE WHEN version_state = 'DISCARDED' THEN {dd('last_update_date')} END) l FROM udi GROUP BY 1),
r AS (
  SELECT 'actor_dk_intel' table_name, upper({nn('ACTOR_ID')}) k, coalesce({dd('EXTRACT_DATE')}, {dd('EXTRACT_DATETIME_UTC')}) d FROM actor_dk_intel
  UNION ALL SELECT 'udi_details_queue', {uu('primary_di_uuid')}, {dd('queued_at_utc')} FROM udi_details_queue),
p AS (SELECT table_name, k, f, l, true known FROM a CROSS JOIN (SELECT 'actor_dk_intel' table_name)
      UNION ALL SELECT 'udi_details_queue', k, f, l, true FROM u),
j AS (SELECT r.table_name, r.k, r.d, CASE WHEN p.known IS NULL THEN 'missing' WHEN r.d < p.f THEN 'late' WHEN r.d > p.l THEN 'deleted' END kind
      FROM r LEFT JOIN p ON r.table_name = p.table_name AND r.k = p.k WHERE r.k IS NOT NULL)
"""


@query("p1_found", _P1 + "SELECT DISTINCT table_name, k ref_key, coalesce(substr(d,1,7),'') ref_month, kind FROM j WHERE kind IS NOT NULL")
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """References that do not hold, one row per table, key, month and kind."""
    month = F.coalesce(F.substring("ref_day", 1, 7), F.lit("")).alias("ref_month")
    return _reference_problems(spark, d).select("table_name", "ref_key", month, "kind").distinct()


@query(
    "p1_orphan_counts",
    _P1 + "SELECT table_name, coalesce(substr(d,1,7),'') ref_month, kind, count(DISTINCT k)::BIGINT n_keys, count(*)::BIGINT n_refs FROM j WHERE kind IS NOT NULL GROUP BY ALL",
)
def p1_orphan_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts of such references per table and month."""
    return orphans.problem_report(_reference_problems(spark, d))


# --------------------------------------------------------------------------- p2


@query("p2_found")
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Field counts that break with the feed's other loads or cannot be true."""
    found = profile.quality_breaks(table(spark, d, "field_inventory"))
    return found.select("feed", "load_no", "table_name", "field_name").distinct()


@query("p2_breaks")
def p2_breaks(spark: SparkSession, d: str) -> DataFrame:
    """The share breaks with level, cross-fitted AUC, ablation loss and z."""
    checked = profile.contradictions(profile.inventory_fields(table(spark, d, "field_inventory")))
    good = checked.filter(~F.col("contradicts"))
    return profile.fill_breaks(good.select("feed", "load_no", "table_name", "field_name", "nn", F.coalesce("tot", "usual_total").alias("tot")))


_FI = f"""
WITH f AS (SELECT {nn('feed')} feed, load_no, lower({nn('table_name')}) table_name, lower({nn('field_name')}) field_name,
                  non_null_rows nn, total_rows tot FROM field_inventory
           QUALIFY row_number() OVER (PARTITION BY {nn('feed')}, load_no, lower({nn('table_name')}), lower({nn('field_name')}) ORDER BY total_rows DESC NULLS LAST, non_null_rows DESC NULLS LAST) = 1),
c AS (SELECT feed, load_no, table_name, tot, count(*) n FROM f WHERE tot IS NOT NULL GROUP BY ALL),
t AS (SELECT feed, load_no, table_name, CASE WHEN count(*) FILTER (n = mx) = 1 THEN max(tot) FILTER (n = mx) END usual
      FROM (SELECT *, max(n) OVER (PARTITION BY feed, load_no, table_name) mx FROM c) GROUP BY ALL)
"""


@query(
    "p2_contradictions",
    _FI + """SELECT f.feed, f.load_no, f.table_name, f.field_name, f.nn non_null_rows, f.tot total_rows, t.usual usual_total
FROM f LEFT JOIN t USING (feed, load_no, table_name)
WHERE coalesce(nn < 0 OR tot < 0 OR nn > tot, false) OR coalesce(tot <> usual OR nn > usual, false)""",
)
def p2_contradictions(spark: SparkSession, d: str) -> DataFrame:
    """Counts that contradict themselves or the other fields of their load and table."""
    found = profile.contradictions(profile.inventory_fields(table(spark, d, "field_inventory"))).filter("contradicts")
    return found.select("feed", "load_no", "table_name", "field_name", F.col("nn").alias("non_null_rows"), F.col("tot").alias("total_rows"), "usual_total")


_PROFILED = {
    "UUID": r"^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$", "MF_SRN": r"^[A-Z]{2}-[A-Z]{2}-\d{9}$", "AR_SRN": r"^[A-Z]{2}-AR-\d{9}$",
    "RISK_CLASS_ID": r"^-\d+$", "STATUS_ID": r"^-\d+$", "CURRENT_EXTRACT_DATE": r"^\d{4}-\d{2}-\d{2}$",
}
def _profile_sql(columns: list[str]) -> str:
    parts = []
    for c in columns:
        bad = f"count(*) FILTER (NOT regexp_matches(v, '{_PROFILED[c]}'))::BIGINT" if c in _PROFILED else "NULL::BIGINT"
        parts.append(
            f"SELECT '{c}' column_name, count(*)::BIGINT total_rows, count(v)::BIGINT non_null_rows, count(DISTINCT v)::BIGINT distinct_values, "
            f"round((count(*)-count(v))::DOUBLE/count(*)::DOUBLE,6) null_rate, min(v) min_value, max(v) max_value, min(length(v))::BIGINT min_length, "
            f"max(length(v))::BIGINT max_length, {bad} pattern_violations FROM (SELECT {nn(c)} v FROM udi_change_events)"
        )
    return " UNION ALL ".join(parts)


_EVENT_COLUMNS = [
    "EVENT_DATE", "EVENT_DATETIME_UTC", "PREVIOUS_EXTRACT_DATE", "PREVIOUS_EXTRACT_DATETIME_UTC", "CURRENT_EXTRACT_DATE", "CURRENT_EXTRACT_DATETIME_UTC",
    "CHANGE_TYPE", "CHANGE_SEVERITY", "CHANGED_COLUMNS", "CHANGED_COLUMNS_COUNT", "CHANGE_SUMMARY", "BUSINESS_KEY", "ENTITY_VARIANT_KEY", "ROW_HASH",
    "OLD_ROW_HASH", "OLD_ENTITY_VARIANT_KEY", "OLD_RISK_CLASS_ID", "NEW_RISK_CLASS_ID", "OLD_LEGISLATION_ID", "NEW_LEGISLATION_ID", "OLD_STATUS_ID",
    "NEW_STATUS_ID", "OLD_DEVICE_STATUS_TYPE_ID", "NEW_DEVICE_STATUS_TYPE_ID", "UUID", "MF_SRN", "MF_NAME", "AR_SRN", "RISK_CLASS_ID",
    "APPLICABLE_LEGISLATION_ID", "STATUS_ID", "DEVICE_STATUS_TYPE_ID", "DEVICE_NAME",
]


@query("p2_profile", _profile_sql(_EVENT_COLUMNS))
def p2_profile(spark: SparkSession, d: str) -> DataFrame:
    """Exact profile of every column of the change log."""
    return profile.base_profile(table(spark, d, "udi_change_events"), None, _PROFILED)


#: They name the snapshot, so they tell any two apart and are not tested.
_LOAD_COLUMNS = ("CURRENT_EXTRACT_DATE", "CURRENT_EXTRACT_DATETIME_UTC")
_TIME_COLUMNS = ("EVENT_DATE", "EVENT_DATETIME_UTC", "PREVIOUS_EXTRACT_DATE", "PREVIOUS_EXTRACT_DATETIME_UTC")
_ID_COLUMNS = (
    "CHANGED_COLUMNS_COUNT", "OLD_RISK_CLASS_ID", "NEW_RISK_CLASS_ID", "OLD_LEGISLATION_ID", "NEW_LEGISLATION_ID", "OLD_STATUS_ID", "NEW_STATUS_ID",
    "OLD_DEVICE_STATUS_TYPE_ID", "NEW_DEVICE_STATUS_TYPE_ID",
)


def _seconds_since(c: str, start: str) -> Column:
    """Seconds from the start of a day to a date or time text; a text that names no day stays as it is."""
    clock = F.regexp_extract(c, r"[T ](\d{2}:\d{2}:\d{2})", 1)
    hours, minutes, seconds = (F.substring(clock, at, 2).cast("bigint") for at in (1, 4, 7))
    days = F.datediff(day_of(c).cast("date"), F.col(start).cast("date")).cast("bigint")
    return F.coalesce((days * 86_400 + F.when(clock == "", 0).otherwise(hours * 3_600 + minutes * 60 + seconds)).cast("string"), clean(c))


@query("p2_load_shift")
def p2_load_shift(spark: SparkSession, d: str) -> DataFrame:
    """Classifier two-sample test between each snapshot of the change log and the one before, row by row, over all columns.

    Only the two columns that name the snapshot are not tested.  Three models share the others: the source
    columns, what the log says of the row, and what it says of the change since the snapshot before (empty in
    the first one), so that neither a copy nor a gap of one kind hides a break of another.  Times count from
    the snapshot's day, those of the snapshot before from its day: that they move on is no break.  Models
    with keys and times are trained on other devices than they are judged on.
    """
    day = F.coalesce(day_of("CURRENT_EXTRACT_DATE"), day_of("CURRENT_EXTRACT_DATETIME_UTC"))
    events = table(spark, d, "udi_change_events")
    tested = [c for c in events.columns if c not in _LOAD_COLUMNS]
    source = [c for c in tested if c in _EVENT_VALUES]
    change = [c for c in tested if c not in source and c.startswith(("PREVIOUS_", "CHANGE", "OLD_"))]
    row = [c for c in tested if c not in source and c not in change]
    device = _device_key() if {"UUID", "BUSINESS_KEY"} <= set(tested) else F.lit(None)
    dated = events.withColumns({"__day": day, "__unit": device})
    # one row per snapshot
    days = dated.select("__day").distinct().na.drop().withColumn("__prev", F.lag("__day").over(Window.orderBy("__day")))

    def value(c: str) -> Column:
        if c in _TIME_COLUMNS:
            return _seconds_since(c, "__prev" if c.startswith("PREVIOUS_") else "__day").alias(c)
        return number_text(c).alias(c) if c in _ID_COLUMNS or _EVENT_VALUES.get(c) is number_text else F.col(c)

    def shifts(columns: list[str]) -> DataFrame:
        rows = dated.join(F.broadcast(days), "__day") if any(c.startswith("PREVIOUS_") for c in columns) else dated
        unit = None if columns is source else "__unit"
        return profile.load_shifts(rows.select("__day", "__unit", *map(value, columns)), "__day", columns, unit=unit, buckets=32)

    return reduce(DataFrame.unionByName, [shifts(g) for g in (source, row, change) if g])


# --------------------------------------------------------------------------- p3


_PAGE_ATTRIBUTES = ["PAGE_HASH", "NEXT_LINK_HASH", "ROWS_COUNT", "REQUEST_DURATION_MS"]


def _page_observations(spark: SparkSession, d: str) -> DataFrame:
    """Page states: failed fetches show none.  The key is fixed text, so NULL parts leave no entity."""
    links = table(spark, d, "nextlinks").filter(F.col("STATUS_CODE") == 200)
    return links.select(
        F.concat(clean("ENDPOINT"), F.lit("|"), clean("LABEL"), F.lit("|"), F.col("PAGE").cast("string")).alias("entity_key"),
        clean("PAGE_HASH").alias("version_key"),
        F.coalesce(day_of("LAST_SEEN_DATE"), day_of("EXTRACT_DATE")).alias("day"),
        day_of("FIRST_SEEN_DATE").alias("first_seen"),
        clean("PAGE_HASH").alias("PAGE_HASH"), clean("NEXT_LINK_HASH").alias("NEXT_LINK_HASH"), "ROWS_COUNT", "REQUEST_DURATION_MS",
    )


def _page_rates(spark: SparkSession, d: str) -> DataFrame:
    known = _page_observations(spark, d).filter("entity_key IS NOT NULL AND version_key IS NOT NULL AND day IS NOT NULL")
    return satellites.change_rates(known, "entity_key", ["day"], _PAGE_ATTRIBUTES)


def _version_observations(spark: SparkSession, d: str) -> DataFrame:
    """Queued device versions, one row per candidate: what any of its rows knows of code and time."""
    queue = table(spark, d, "udi_details_queue")
    per = (
        queue.select(
            uuid_key("candidate_uuid").alias("version_key"), code_key("primary_di_code").alias("code"),
            F.upper(clean("ulid")).alias("ulid"), clean("ulid_datetime_utc").alias("at"),
        )
        .filter(F.col("version_key").isNotNull())
        .groupBy("version_key")
        .agg(F.max("code").alias("code"), F.max("ulid").alias("ulid"), F.max("at").alias("at"))
    )
    at = F.regexp_replace(F.regexp_replace("at", "T", " "), "( UTC|Z)$", "")
    millis = F.coalesce(ulid_millis("ulid"), F.unix_millis(F.concat(at, F.lit("+00:00")).try_cast("timestamp")))
    return per.select(
        F.coalesce("code", "version_key").alias("entity_key"), "version_key", millis.alias("at_ms"), F.coalesce("ulid", F.lit("")).alias("ulid"),
        F.coalesce(ulid_day("ulid"), day_of("at")).alias("day"), F.lit(None).cast("string").alias("first_seen"),
    )


def _histories(spark: SparkSession, d: str) -> dict[str, satellites.Satellite]:
    """A satellite of the page attributes that change as the page hash does, and one of the device versions."""
    versions = satellites.Satellite(spark, scratch_path(spark, "versions"), order=("at_ms", "ulid", "version_key"))

    def pages() -> satellites.Satellite:
        groups = satellites.split_by_rate(_page_rates(spark, d))
        with_hash = next(g for g in groups.values() if "PAGE_HASH" in g)
        made = satellites.Satellite(spark, scratch_path(spark, "pages"), attributes=[c for c in with_hash if c != "PAGE_HASH"])
        made.append(_page_observations(spark, d))
        return made

    made, _ = together(spark, pages, lambda: versions.append(_version_observations(spark, d)))
    return {"nextlinks": made, "udi_details_queue": versions}


_ULID_MS = "(" + " + ".join(f"(strpos('0123456789ABCDEFGHJKMNPQRSTVWXYZ', substr(ulid,{i + 1},1))-1)::BIGINT * {32 ** (9 - i)}" for i in range(10)) + ")"

_P3 = f"""
WITH o AS (SELECT ENDPOINT||'|'||LABEL||'|'||PAGE k, PAGE_HASH h, coalesce({dd('LAST_SEEN_DATE')}, {dd('EXTRACT_DATE')}) d, {dd('FIRST_SEEN_DATE')} f
           FROM nextlinks WHERE STATUS_CODE = 200),
s AS (SELECT k, h, d, list(f) FILTER (f <= d) fs FROM o WHERE k IS NOT NULL AND h IS NOT NULL AND d IS NOT NULL GROUP BY ALL),
l AS (SELECT *, lag(h) OVER (PARTITION BY k ORDER BY d, h) ph, lag(d) OVER (PARTITION BY k ORDER BY d, h) pd FROM s),
r AS (SELECT *, sum(CASE WHEN ph IS DISTINCT FROM h THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY d, h) run FROM l),
b AS (SELECT *, max(CASE WHEN ph IS DISTINCT FROM h THEN pd END) OVER (PARTITION BY k, run) bd FROM r),
v AS (SELECT k, run, min(h) h, least(min(d), coalesce(min(list_min(list_filter(fs, lambda x: bd IS NULL OR x > bd))), min(d))) vf FROM b GROUP BY k, run),
c AS (SELECT {uu('candidate_uuid')} c, max(upper({nn('primary_di_code')})) code, max(upper({nn('ulid')})) ulid, max({nn('ulid_datetime_utc')}) ats FROM udi_details_queue GROUP BY 1),
m AS (SELECT coalesce(code, c) k, c h, ulid, CASE WHEN ulid IS NOT NULL THEN {_ULID_MS} ELSE epoch_ms(ats::TIMESTAMP) END ms FROM c)
SELECT 'nextlinks' table_name, k entity_key, h version_key, vf valid_from, coalesce(lead(vf) OVER (PARTITION BY k ORDER BY run), '') valid_to FROM v
UNION ALL
SELECT 'udi_details_queue', k, h, strftime(make_timestamp(ms*1000), '%Y-%m-%d'),
       coalesce(strftime(make_timestamp(lead(ms) OVER (PARTITION BY k ORDER BY ms, coalesce(ulid,''), h)*1000), '%Y-%m-%d'), '') FROM m WHERE ms IS NOT NULL
"""


@query("p3_found", _P3)
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Versions of pages and devices with the period in which each was valid."""
    views = together(spark, *[lambda t=t, s=s: s.history().withColumn("table_name", F.lit(t)) for t, s in _histories(spark, d).items()])
    return views[0].unionByName(views[1]).select("table_name", "entity_key", "version_key", "valid_from", "valid_to")


_RATED = ["version_number", "latest_version", "status", "attempt_count", "last_status_code", "queue_source"]
_RATE_ORDER = ", ".join(f"{c} NULLS FIRST" for c in ("queued_at_utc", "candidate_uuid", *_RATED))
_P3R = (
    f"WITH q AS (SELECT coalesce(upper({nn('primary_di_code')}), {uu('candidate_uuid')}) k, queued_at_utc, candidate_uuid, {', '.join(_RATED)} FROM udi_details_queue), "
    f"l AS (SELECT *, row_number() OVER w n, {', '.join(f'lag({c}) OVER w p_{c}' for c in _RATED)} FROM q WHERE k IS NOT NULL WINDOW w AS (PARTITION BY k ORDER BY {_RATE_ORDER})) "
) + " UNION ALL ".join(
    f"SELECT '{c}' attribute, (count(*) FILTER ({c} IS DISTINCT FROM p_{c}))::BIGINT changes, count(*)::BIGINT steps, "
    f"round((count(*) FILTER ({c} IS DISTINCT FROM p_{c}))::DOUBLE / count(*)::DOUBLE, 4) rate FROM l WHERE n > 1"
    for c in _RATED
)


@query("p3_change_rates", _P3R)
def p3_change_rates(spark: SparkSession, d: str) -> DataFrame:
    """How often each attribute of the queue changes between a device's rows: what goes into which satellite."""
    queue = table(spark, d, "udi_details_queue").withColumn("entity_key", F.coalesce(code_key("primary_di_code"), uuid_key("candidate_uuid")))
    day = F.substring("queued_at_utc", 1, 10)
    return satellites.change_rates(queue.filter("entity_key IS NOT NULL"), "entity_key", ["queued_at_utc", "candidate_uuid", *_RATED], _RATED, day)


_PAGE_RATE_ORDER = ", ".join(f"{c} NULLS FIRST" for c in ("day", *_PAGE_ATTRIBUTES))
_P3P = (
    f"WITH q AS (SELECT ENDPOINT||'|'||LABEL||'|'||PAGE k, coalesce({dd('LAST_SEEN_DATE')}, {dd('EXTRACT_DATE')}) \"day\", {', '.join(_PAGE_ATTRIBUTES)} FROM nextlinks WHERE STATUS_CODE = 200), "
    f"l AS (SELECT *, row_number() OVER w n, {', '.join(f'lag({c}) OVER w p_{c}' for c in _PAGE_ATTRIBUTES)} FROM q "
    f"WHERE k IS NOT NULL AND PAGE_HASH IS NOT NULL AND \"day\" IS NOT NULL WINDOW w AS (PARTITION BY k ORDER BY {_PAGE_RATE_ORDER})) "
) + " UNION ALL ".join(
    f"SELECT '{c}' attribute, (count(*) FILTER ({c} IS DISTINCT FROM p_{c}))::BIGINT changes, count(*)::BIGINT steps, "
    f"round((count(*) FILTER ({c} IS DISTINCT FROM p_{c}))::DOUBLE / count(*)::DOUBLE, 4) rate FROM l WHERE n > 1"
    for c in _PAGE_ATTRIBUTES
)


@query("p3_page_rates", _P3P)
def p3_page_rates(spark: SparkSession, d: str) -> DataFrame:
    """How often each attribute of a page changes from one fetch to the next."""
    return _page_rates(spark, d)


# --------------------------------------------------------------------------- p4

_EVENT_VALUES = {
    "MF_SRN": code_key, "MF_NAME": clean, "AR_SRN": code_key, "RISK_CLASS_ID": number_text, "APPLICABLE_LEGISLATION_ID": number_text,
    "STATUS_ID": number_text, "DEVICE_STATUS_TYPE_ID": number_text, "DEVICE_NAME": clean,
}


def _device_key() -> Column:
    return F.coalesce(uuid_key("UUID"), uuid_key(F.regexp_extract(clean("BUSINESS_KEY"), r"\|(.*)$", 1)))


def _snapshots(spark: SparkSession, d: str, values: bool = False) -> snapshot_diff.History:
    events = table(spark, d, "udi_change_events")
    rows = snapshot_diff.snapshot_rows(
        events,
        key=_device_key(),
        snapshot=F.coalesce(day_of("CURRENT_EXTRACT_DATE"), day_of("CURRENT_EXTRACT_DATETIME_UTC")),
        seen_at=clean("CURRENT_EXTRACT_DATETIME_UTC"),
        values={n: f(n) for n, f in _EVENT_VALUES.items()},
    )
    return snapshot_diff.History(rows, list(_EVENT_VALUES) if values else ())


_EV = ", ".join(
    f"{('upper(' + nn(n) + ')') if f is code_key else nn(n) if f is clean else num(n)} {n}" for n, f in _EVENT_VALUES.items()
)
_P4 = f"""
WITH e AS (SELECT coalesce({uu('UUID')}, {uu("regexp_extract(BUSINESS_KEY, '[|](.*)$', 1)")}) k,
                  coalesce({dd('CURRENT_EXTRACT_DATE')}, {dd('CURRENT_EXTRACT_DATETIME_UTC')}) d, {nn('CURRENT_EXTRACT_DATETIME_UTC')} t, {_EV} FROM udi_change_events),
s AS (SELECT * FROM e WHERE k IS NOT NULL AND d IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY k, d ORDER BY t DESC NULLS LAST, md5(concat_ws('|', {', '.join(f"coalesce(length({n})||':'||{n}, '-')" for n in _EVENT_VALUES)})) DESC) = 1),
days AS (SELECT d, lag(d) OVER (ORDER BY d) pd, lead(d) OVER (ORDER BY d) nd FROM (SELECT DISTINCT d FROM s))
"""


@query(
    "p4_found",
    _P4 + f"""
SELECT b.d extract_date, b.k uuid, CASE WHEN a.k IS NULL THEN 'added' ELSE 'changed' END change_kind
FROM s b JOIN days ON b.d = days.d LEFT JOIN s a ON a.k = b.k AND a.d = days.pd
WHERE days.pd IS NOT NULL AND (a.k IS NULL OR {' OR '.join(f'a.{n} IS DISTINCT FROM b.{n}' for n in _EVENT_VALUES)})
UNION ALL
SELECT days.nd, a.k, 'removed' FROM s a JOIN days ON a.d = days.d LEFT JOIN s b ON b.k = a.k AND b.d = days.nd WHERE days.nd IS NOT NULL AND b.k IS NULL""",
)
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """What was really added, removed or changed between consecutive snapshots."""
    return _snapshots(spark, d).changes().withColumnRenamed("key", "uuid")


@query(
    "p4_changed_values",
    _P4 + " UNION ALL ".join(
        f"SELECT b.d extract_date, b.k uuid, '{n}' field_name, a.{n} old_value, b.{n} new_value FROM s b JOIN days ON b.d = days.d JOIN s a ON a.k = b.k AND a.d = days.pd WHERE a.{n} IS DISTINCT FROM b.{n}"
        for n in _EVENT_VALUES
    ),
)
def p4_changed_values(spark: SparkSession, d: str) -> DataFrame:
    """Old and new value of each changed field, fetched for the changed keys only."""
    return _snapshots(spark, d, values=True).changed_values().withColumnRenamed("key", "uuid")


# --------------------------------------------------------------------------- p6


@query("p6_found")
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Fields added, removed, renamed or retyped since the feed's last delivery of the table."""
    return drift.schema_changes(drift.fields_of_loads(table(spark, d, "field_inventory")))


_QUEUE_COLUMNS = [
    "candidate_uuid", "primary_di_code", "primary_di_uuid", "ulid", "ulid_datetime_utc", "latest_version", "version_number", "queue_source", "priority", "status",
    "attempt_count", "last_status_code", "last_error", "queued_at_utc", "last_attempt_at_utc", "completed_at_utc", "last_detail_extract_datetime_utc",
]
_READ_AS = {
    "latest_version": "CASE WHEN lower(trim(latest_version)) IN ('t','true','y','yes','1') THEN true WHEN lower(trim(latest_version)) IN ('f','false','n','no','0') THEN false END",
    "version_number": "CASE WHEN regexp_full_match(trim(version_number), '[+-]?[0-9]+') THEN try_cast(trim(version_number) AS BIGINT) END",
}


@query(
    "p6_unified",
    f"SELECT {', '.join(f'{_READ_AS[c]} {c}' if c in _READ_AS else c for c in _QUEUE_COLUMNS)} FROM candidate_inventory UNION ALL SELECT {', '.join(_QUEUE_COLUMNS)} FROM udi_details_queue",
)
def p6_unified(spark: SparkSession, d: str) -> DataFrame:
    """The two deliveries of the queue, whose types drifted apart, read into one table by their edit script."""
    return drift.unify([table(spark, d, "candidate_inventory"), table(spark, d, "udi_details_queue")])[0]


# --------------------------------------------------------------------------- p7

_COPY_FIELDS = ["trade_name", "risk_class_code", "device_status_code", "manufacturer_srn", "version_number", "last_update_date"]


def _copy(spark: SparkSession, d: str, name: str) -> DataFrame:
    plain = [clean(c).alias(c) for c in _COPY_FIELDS[:4]]
    day = F.coalesce(day_of("last_update_date"), clean("last_update_date")).alias("last_update_date")
    return table(spark, d, name).select(uuid_key("key_value").alias("key"), *plain, number_text("version_number").alias("version_number"), day)


_CP = ", ".join([f"{nn(c)} {c}" for c in _COPY_FIELDS[:4]] + [f"{num('version_number')} version_number", f"{dd('last_update_date')} last_update_date"])
_P7 = "WITH " + ", ".join(
    f"{a} AS (SELECT {uu('key_value')} k, {_CP} FROM {t} QUALIFY row_number() OVER (PARTITION BY k ORDER BY {', '.join(f'{c} DESC NULLS LAST' for c in _COPY_FIELDS)}) = 1)"
    for a, t in (("l", "dl_keys"), ("r", "ui_keys"))
)


@query(
    "p7_found",
    _P7 + """
SELECT k key_value, 'dl_only' difference FROM l WHERE k IS NOT NULL AND k NOT IN (SELECT k FROM r WHERE k IS NOT NULL)
UNION ALL SELECT k, 'ui_only' FROM r WHERE k IS NOT NULL AND k NOT IN (SELECT k FROM l WHERE k IS NOT NULL)
""" + "".join(f" UNION ALL SELECT k, '{c}' FROM l JOIN r USING (k) WHERE l.{c} IS DISTINCT FROM r.{c}" for c in _COPY_FIELDS),
)
def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Devices on one side only, and each field whose value differs."""
    found = copy_diff.copy_differences(
        _copy(spark, d, "dl_keys"), _copy(spark, d, "ui_keys"), _COPY_FIELDS, left_only="dl_only", right_only="ui_only"
    )
    return found.withColumnRenamed("key", "key_value")


@query("p7_chunks")
def p7_chunks(spark: SparkSession, d: str) -> DataFrame:
    """How many chunks and rows the fingerprints settled."""
    return copy_diff.chunk_report(_copy(spark, d, "dl_keys"), _copy(spark, d, "ui_keys"), _COPY_FIELDS)
