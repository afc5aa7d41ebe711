"""Marts over the registry's own tables: actors, devices and changes of the last snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean, code_key, day_of, normalise_id, uuid_key
from ..operators import cdc, ranking, relations
from ..operators.audit import COMPLETE
from ..operators.cdc import CdcSpec
from ..sources.snapshots import SnapshotStore
from ..sources.tables import table
from .general import dd, nn, uu
from .registry import query


def _devices(spark: SparkSession, d: str) -> DataFrame:
    """Log rows with canonical keys and ids."""
    e = table(spark, d, "udi_change_events")
    return e.select(
        F.coalesce(day_of("CURRENT_EXTRACT_DATE"), day_of("CURRENT_EXTRACT_DATETIME_UTC")).alias("day"),
        F.coalesce(uuid_key("UUID"), uuid_key(F.regexp_extract(clean("BUSINESS_KEY"), r"\|(.*)$", 1))).alias("uuid"),
        code_key("MF_SRN").alias("mf"), code_key("AR_SRN").alias("ar"), normalise_id("RISK_CLASS_ID").alias("risk"),
        normalise_id("APPLICABLE_LEGISLATION_ID").alias("law"), clean("CHANGE_TYPE").alias("change_type"),
    ).filter("day IS NOT NULL AND uuid IS NOT NULL")


def _last_two(rows: DataFrame) -> tuple[str | None, str | None]:
    days = [r["day"] for r in rows.select("day").distinct().orderBy(F.col("day").desc()).limit(2).collect()]
    return (days + [None, None])[0], (days + [None, None])[1]


def _id(c: str) -> str:
    return f"regexp_replace({nn(c)}, '[.]0+$', '')"


_D = f"""
WITH e AS (SELECT coalesce({dd('CURRENT_EXTRACT_DATE')}, {dd('CURRENT_EXTRACT_DATETIME_UTC')}) AS day, coalesce({uu('UUID')}, {uu("regexp_extract(BUSINESS_KEY, '[|](.*)$', 1)")}) uuid,
 upper({nn('MF_SRN')}) mf, upper({nn('AR_SRN')}) ar, {_id('RISK_CLASS_ID')} risk, {_id('APPLICABLE_LEGISLATION_ID')} law, {nn('CHANGE_TYPE')} change_type FROM udi_change_events),
g AS (SELECT * FROM e WHERE day IS NOT NULL AND uuid IS NOT NULL), m AS (SELECT max(day) d1 FROM g), m2 AS (SELECT max(day) d2 FROM g, m WHERE day < d1),
c AS (SELECT g.* FROM g, m WHERE day = d1), p AS (SELECT g.* FROM g, m2 WHERE day = d2),
ce AS (SELECT DISTINCT actor, uuid, risk, law FROM (SELECT mf actor, uuid, risk, law FROM c UNION ALL SELECT ar, uuid, risk, law FROM c) WHERE actor IS NOT NULL),
pe AS (SELECT DISTINCT actor, uuid FROM (SELECT mf actor, uuid FROM p UNION ALL SELECT ar, uuid FROM p) WHERE actor IS NOT NULL)
"""


def _actor_edges(rows: DataFrame) -> DataFrame:
    """One row per actor, device and its classes, manufacturer or representative alike."""
    return (
        rows.select("uuid", "risk", "law", F.explode(F.array("mf", "ar")).alias("actor")).filter("actor IS NOT NULL").distinct()
    )


@query(
    "actor_mart",
    _D + """, n AS (SELECT actor, count(DISTINCT uuid)::BIGINT device_count FROM ce GROUP BY 1), o AS (SELECT actor, count(DISTINCT uuid)::BIGINT device_count_previous FROM pe GROUP BY 1),
r AS (SELECT actor, risk dominant_risk, count(DISTINCT uuid)::BIGINT dominant_risk_count FROM ce WHERE risk IS NOT NULL GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY actor ORDER BY count(DISTINCT uuid) DESC, risk) = 1),
l AS (SELECT actor, law dominant_law, count(DISTINCT uuid)::BIGINT dominant_law_count FROM ce WHERE law IS NOT NULL GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY actor ORDER BY count(DISTINCT uuid) DESC, law) = 1)
SELECT n.actor, device_count, coalesce(device_count_previous, 0)::BIGINT device_count_previous, (device_count - coalesce(device_count_previous, 0))::BIGINT device_count_change,
 dominant_risk, dominant_risk_count, dominant_law, dominant_law_count, round(100.0::DOUBLE * dominant_law_count::DOUBLE / device_count::DOUBLE, 2) dominant_law_share
FROM n LEFT JOIN o USING (actor) LEFT JOIN r USING (actor) LEFT JOIN l USING (actor)""",
)
def actor_mart(spark: SparkSession, d: str) -> DataFrame:
    """Per actor: devices now and before, dominant risk class and legislation."""
    rows = _devices(spark, d)
    last, before = _last_two(rows)
    now = _actor_edges(rows.filter(F.col("day") == F.lit(last)))
    old = _actor_edges(rows.filter(F.col("day") == F.lit(before))) if before else now.limit(0)
    base = now.groupBy("actor").agg(F.count_distinct("uuid").alias("device_count"))
    prev = old.groupBy("actor").agg(F.count_distinct("uuid").alias("device_count_previous"))
    parts = [prev]
    for c in ("risk", "law"):
        top = ranking.top_category(ranking.category_counts(now, "actor", c, "uuid"), "actor", c)
        parts.append(top.select("actor", F.col(c).alias(f"dominant_{c}"), F.col("n").alias(f"dominant_{c}_count")))
    star = ranking.metric_star(base, "actor", parts, zero=["device_count_previous"])
    return star.select(
        "actor", "device_count", "device_count_previous", (F.col("device_count") - F.col("device_count_previous")).alias("device_count_change"), "dominant_risk", "dominant_risk_count",
        "dominant_law", "dominant_law_count", ranking.share_score(F.col("dominant_law_count"), F.col("device_count")).alias("dominant_law_share"),
    )


_DK = f"SELECT DISTINCT upper({nn('ACTOR_ID')}) k FROM actors WHERE upper({nn('ACT_COUNTRY_ISO2_CODE')}) = 'DK'"


@query(
    "device_mart",
    _D + f", dk AS ({_DK}) SELECT DISTINCT uuid, mf, ar, risk, law FROM c WHERE mf LIKE 'DK-%' OR ar LIKE 'DK-%' OR mf IN (SELECT k FROM dk WHERE k IS NOT NULL) OR ar IN (SELECT k FROM dk WHERE k IS NOT NULL)",
)
def device_mart(spark: SparkSession, d: str) -> DataFrame:
    """Devices of the last snapshot with an actor of one country, by id prefix or by the actor's country."""
    rows = _devices(spark, d)
    last, _ = _last_two(rows)
    here = table(spark, d, "actors").filter(code_key("ACT_COUNTRY_ISO2_CODE") == "DK").select(code_key("ACTOR_ID").alias("k"))
    kept = relations.prefix_or_known(rows.filter(F.col("day") == F.lit(last)).select("uuid", "mf", "ar", "risk", "law"), ["mf", "ar"], "DK-", here, "k")
    return kept.distinct()


@query(
    "change_event_mart",
    _D + "SELECT day, coalesce(mf, ar) actor, change_type, count(*)::BIGINT n FROM g WHERE change_type IS DISTINCT FROM 'UNCHANGED' GROUP BY ALL",
)
def change_event_mart(spark: SparkSession, d: str) -> DataFrame:
    """Logged changes per day, actor (manufacturer, else representative) and type; a missing type is one."""
    rows = _devices(spark, d).filter(~F.col("change_type").eqNullSafe("UNCHANGED"))
    return rows.groupBy("day", F.coalesce("mf", "ar").alias("actor"), "change_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "risk_distribution",
    _D + "SELECT risk, law, count(DISTINCT uuid)::BIGINT devices FROM c GROUP BY 1, 2",
)
def risk_distribution(spark: SparkSession, d: str) -> DataFrame:
    """Devices of the last snapshot per risk class and legislation, missing ones included."""
    rows = _devices(spark, d)
    last, _ = _last_two(rows)
    return rows.filter(F.col("day") == F.lit(last)).groupBy("risk", "law").agg(F.count_distinct("uuid").alias("devices"))


# Legislation codes from the newest to the oldest of each framework, and the ranks of their risk classes.
_FRAMEWORKS = {"a": {"-300": 2, "-301": 1}, "b": {"-302": 2, "-303": 1}}
_RISKS = {"a": {"-203": 1, "-204": 2, "-205": 3, "-206": 4}, "b": {"-207": 1, "-208": 2, "-209": 3, "-210": 4}}
_RISK_PROFILES = {"dominant_risk": (None, False)} | {f"highest_risk_{f}": (r, False) for f, r in _RISKS.items()}
_LAW_PROFILES = {"dominant_law": (None, False)} | {f"{n}_law_{f}": (r, n == "oldest") for f, r in _FRAMEWORKS.items() for n in ("latest", "oldest")}
_ALL_PROFILES = _RISK_PROFILES | _LAW_PROFILES


def _actor_metrics(edges: DataFrame) -> DataFrame:
    """One row per actor: devices, the top profiles of risk classes and legislations, and how far each framework has moved to its newest."""
    risk, law = (ranking.category_counts(edges, "actor", c, "uuid") for c in ("risk", "law"))
    held = {f: [ranking.category_counts(edges, "actor", "law", "uuid").groupBy("actor").agg(
        *[F.coalesce(F.sum(F.when(F.col("law") == code, F.col("n"))), F.lit(0)).alias(f"{kind}_{f}") for kind, code in zip(("new", "old"), ranks, strict=True)]
    )] for f, ranks in _FRAMEWORKS.items()}
    base = edges.groupBy("actor").agg(F.count_distinct("uuid").alias("devices"))
    parts = [ranking.top_profiles(risk, "actor", "risk", _RISK_PROFILES), ranking.top_profiles(law, "actor", "law", _LAW_PROFILES), *[p for ps in held.values() for p in ps]]
    star = ranking.metric_star(base, "actor", parts, zero=[f"{k}_{f}" for f in _FRAMEWORKS for k in ("new", "old")])
    return star.select("*", *[ranking.share_score(F.col(f"new_{f}"), F.col(f"new_{f}") + F.col(f"old_{f}")).alias(f"migration_{f}") for f in _FRAMEWORKS])


def _metric_names() -> tuple[list[str], list[str], list[str]]:
    """Counts, scores and labels of the actor's profile."""
    return ["devices", *[f"{n}_count" for n in _ALL_PROFILES]], [f"migration_{f}" for f in _FRAMEWORKS], list(_ALL_PROFILES)


def _profile_sql(edges: str) -> str:
    def ranked(name: str, column: str, ranks: dict[str, int] | None, lowest: bool) -> str:
        rank = "0" if ranks is None else f"CASE {column} " + " ".join(f"WHEN '{c}' THEN {r}" for c, r in ranks.items()) + " END"
        return (
            f"(SELECT actor, {column} {name}, count(DISTINCT uuid)::BIGINT {name}_count, {'NULL' if ranks is None else rank}::INT {name}_rank FROM {edges} "
            f"WHERE {column} IS NOT NULL AND {rank} IS NOT NULL GROUP BY actor, {column} "
            f"QUALIFY row_number() OVER (PARTITION BY actor ORDER BY {rank} {'' if lowest else 'DESC'}, count(DISTINCT uuid) DESC, {column}) = 1)"
        )

    parts = [ranked(n, "risk", dict(r) if r else None, low) for n, (r, low) in _RISK_PROFILES.items()] + [ranked(n, "law", dict(r) if r else None, low) for n, (r, low) in _LAW_PROFILES.items()]
    held = ", ".join(
        f"count(DISTINCT CASE WHEN law = '{code}' THEN uuid END)::BIGINT {kind}_{f}" for f, ranks in _FRAMEWORKS.items() for kind, code in zip(("new", "old"), ranks, strict=True)
    )
    scores = ", ".join(f"round(100.0::DOUBLE * new_{f}::DOUBLE / nullif(new_{f} + old_{f}, 0)::DOUBLE, 2) migration_{f}" for f in _FRAMEWORKS)
    joins = " ".join(f"LEFT JOIN {p} x{i} USING (actor)" for i, p in enumerate(parts))
    return f"SELECT *, {scores} FROM (SELECT actor, count(DISTINCT uuid)::BIGINT devices, {held} FROM {edges} GROUP BY 1) {joins}"


def _actor_profile_sql() -> str:
    counts, scores, labels = _metric_names()
    out = ["cm.*"]
    out += [f"coalesce(om.{c}, 0)::BIGINT {c}_previous, (coalesce(cm.{c}, 0) - coalesce(om.{c}, 0))::BIGINT {c}_change" for c in counts]
    out += [f"om.{c} {c}_previous, round(cm.{c} - om.{c}, 2) {c}_change" for c in scores]
    out += [f"om.{c} {c}_previous, (om.actor IS NOT NULL AND cm.{c} IS DISTINCT FROM om.{c}) {c}_changed" for c in labels]
    old = "(SELECT DISTINCT actor, uuid, risk, law FROM (SELECT mf actor, uuid, risk, law FROM p UNION ALL SELECT ar, uuid, risk, law FROM p) WHERE actor IS NOT NULL)"
    return _D + f", cm AS ({_profile_sql('ce')}), om AS ({_profile_sql(old)}) SELECT {', '.join(out)} FROM cm LEFT JOIN om ON cm.actor = om.actor"


@query("actor_profile", _actor_profile_sql())
def actor_profile(spark: SparkSession, d: str) -> DataFrame:
    """Per actor the whole metric star, each metric with its value in the snapshot before and the change."""
    rows = _devices(spark, d)
    last, before = _last_two(rows)
    now = _actor_metrics(_actor_edges(rows.filter(F.col("day") == F.lit(last))))
    counts, scores, labels = _metric_names()
    old = _actor_metrics(_actor_edges(rows.filter(F.col("day") == F.lit(before)))).select("actor", F.lit(True).alias("__was"), *[F.col(c).alias(f"{c}_previous") for c in (*counts, *scores, *labels)])
    both = now.join(old, "actor", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return both.select(
        *now.columns,
        *[x for c in counts for x in (zero(f"{c}_previous").alias(f"{c}_previous"), (zero(c) - zero(f"{c}_previous")).alias(f"{c}_change"))],
        *[x for c in scores for x in (F.col(f"{c}_previous"), F.round(F.col(c) - F.col(f"{c}_previous"), 2).alias(f"{c}_change"))],
        *[x for c in labels for x in (F.col(f"{c}_previous"), (F.col("__was").isNotNull() & ~F.col(c).eqNullSafe(F.col(f"{c}_previous"))).alias(f"{c}_changed"))],
    )


@query(
    "event_projection",
    _D + """, r AS (SELECT DISTINCT risk code, 'class ' || risk AS label FROM g WHERE risk IS NOT NULL)
SELECT day, uuid, coalesce(mf, ar) actor, coalesce(change_type, 'UNKNOWN') change_type, risk, label risk_label, law FROM g LEFT JOIN r ON risk = code WHERE change_type IS DISTINCT FROM 'UNCHANGED'""",
)
def event_projection(spark: SparkSession, d: str) -> DataFrame:
    """Logged changes row by row, with the label of their risk class from a code list."""
    rows = _devices(spark, d)
    codes = rows.select(F.col("risk").alias("code"), F.concat(F.lit("class "), "risk").alias("label"))
    labelled = relations.with_label(rows.filter(~F.col("change_type").eqNullSafe("UNCHANGED")), F.col("risk"), relations.code_labels(codes, "code", "label"), "code", "label", "risk_label")
    return labelled.select("day", "uuid", F.coalesce("mf", "ar").alias("actor"), F.coalesce("change_type", F.lit("UNKNOWN")).alias("change_type"), "risk", "risk_label", "law")


_SPEC = CdcSpec(key=["uuid"], changes=[("UPDATED_RISK", ["risk"]), ("UPDATED_LAW", ["law"])])
_H = "md5(concat_ws('|', coalesce(law,''), coalesce(mf,''), coalesce(risk,''), uuid))"


@query(
    "cdc_snapshots",
    _D + f""", h1 AS (SELECT DISTINCT uuid, mf, risk, law, {_H} h FROM c), h2 AS (SELECT DISTINCT uuid, mf, risk, law, {_H} h FROM p),
c1 AS (SELECT * FROM h1 QUALIFY row_number() OVER (PARTITION BY uuid ORDER BY h) = 1), p1 AS (SELECT * FROM h2 QUALIFY row_number() OVER (PARTITION BY uuid ORDER BY h) = 1)
SELECT CASE WHEN c1.uuid IS NULL THEN 'REMOVED' WHEN p1.uuid IS NULL THEN 'NEW' WHEN c1.h = p1.h THEN 'UNCHANGED' WHEN c1.risk IS DISTINCT FROM p1.risk THEN 'UPDATED_RISK'
 WHEN c1.law IS DISTINCT FROM p1.law THEN 'UPDATED_LAW' ELSE 'UPDATED' END change_type, count(*)::BIGINT n FROM c1 FULL JOIN p1 ON c1.uuid = p1.uuid GROUP BY 1""",
)
def cdc_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """The last snapshot of the change log against the one before, by the registry's own comparison."""
    rows = _devices(spark, d).select("day", "uuid", "mf", "risk", "law")
    last, before = _last_two(rows)
    now, old = (rows.filter(F.col("day") == F.lit(at)).drop("day") for at in (last, before))
    state = cdc.one_per_key(cdc.with_keys(old, _SPEC)).withColumns({"FIRST_SEEN_DATE": F.lit(before), "LAST_SEEN_DATE": F.lit(before)})
    return cdc.run_statistics(cdc.compare(now, state, _SPEC, last or "", removed=True)).withColumnRenamed("CHANGE_TYPE", "change_type")


def build_marts(spark: SparkSession, d: str, store: SnapshotStore, version: str) -> list[str]:
    """All marts of the tables in ``d`` as one version of ``store``: readers see all of them or none."""
    marts = {"actors": actor_mart, "devices": device_mart, "change_events": change_event_mart, "events": event_projection, "profiles": actor_profile, "risk_distribution": risk_distribution}
    store.commit(version, {name: fn(spark, d) for name, fn in marts.items()}, COMPLETE)
    return sorted(marts)
