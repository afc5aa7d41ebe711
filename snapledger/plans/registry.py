"""Queries for the registry engine's own operators, on the driver's plain tables.

``prev`` and ``cur`` are two states of orders derived alike in both engines:
``prev`` lacks every tenth key and has other statuses and priorities on some,
``cur`` lacks every thirteenth.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean, is_missing, labelled_key, normalise_id, row_hash, ulid_millis
from ..operators import audit, cdc, coverage, flatten, merge, ranking, relations, versions
from ..operators.cdc import CdcSpec
from ..session import ship
from ..sources import loopback, paged
from ..sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


# --------------------------------------------------------------------------- change data

SPEC = CdcSpec(
    key=["o_orderkey"],
    changes=[("UPDATED_STATUS", ["o_orderstatus"]), ("UPDATED_PRIORITY", ["o_orderpriority"])],
    severities={"KEY_MISSING": "HIGH", "UPDATED_STATUS": "MEDIUM", "UPDATED_PRIORITY": "MEDIUM", "UPDATED": "LOW"},
    raised=("UPDATED_PRIORITY", "o_orderpriority", {"1-URGENT": 5, "2-HIGH": 4, "3-MEDIUM": 3, "4-NOT SPECIFIED": 2, "5-LOW": 1, "9-OLD": 3}),
    summaries=[("o_orderstatus", "STATUS"), ("o_orderpriority", "PRIORITY")],
)
_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
TODAY, BEFORE = "2025-02-01", "2025-01-01"


def _cur(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(_COLS).filter("o_orderkey % 13 <> 0")


def _prev(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.expr("CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END").alias("o_orderstatus"),
        F.expr("CASE WHEN o_orderkey % 11 = 0 THEN '9-OLD' ELSE o_orderpriority END").alias("o_orderpriority"),
    ).filter("o_orderkey % 10 <> 0")


def _state(prev: DataFrame) -> DataFrame:
    """A kept state: the previous rows with hash and first-seen days."""
    return prev.select("*", row_hash(_COLS).alias("ROW_HASH"), F.lit(BEFORE).alias("FIRST_SEEN_DATE"), F.lit(BEFORE).alias("LAST_SEEN_DATE"))


def _compared(spark: SparkSession, d: str) -> DataFrame:
    return cdc.compare(_cur(spark, d), _state(_prev(spark, d)), SPEC, TODAY)


_HASH = "md5(concat_ws('|', o_custkey::VARCHAR, o_orderkey::VARCHAR, o_orderpriority, o_orderstatus))"
_CDC = f"""
WITH cur AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 13 <> 0),
prev AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END o_orderstatus,
                CASE WHEN o_orderkey % 11 = 0 THEN '9-OLD' ELSE o_orderpriority END o_orderpriority FROM orders WHERE o_orderkey % 10 <> 0),
ch AS (SELECT *, {_HASH} h FROM cur), ph AS (SELECT *, {_HASH} h FROM prev),
j AS (SELECT c.*, p.o_orderkey pk, p.h ph, p.o_orderstatus ps, p.o_orderpriority pp,
        CASE WHEN p.o_orderkey IS NULL THEN 'NEW' WHEN c.h = p.h THEN 'UNCHANGED' WHEN c.o_orderstatus IS DISTINCT FROM p.o_orderstatus THEN 'UPDATED_STATUS'
             WHEN c.o_orderpriority IS DISTINCT FROM p.o_orderpriority THEN 'UPDATED_PRIORITY' ELSE 'UPDATED' END ct
      FROM ch c LEFT JOIN ph p ON c.o_orderkey = p.o_orderkey),
k AS (SELECT *, CASE WHEN ct LIKE 'UPDATED%' THEN concat_ws('|', CASE WHEN o_orderpriority IS DISTINCT FROM pp THEN 'o_orderpriority' END,
                     CASE WHEN o_orderstatus IS DISTINCT FROM ps THEN 'o_orderstatus' END) END cc FROM j)
"""
_RANK = "CASE {0} WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4 WHEN '3-MEDIUM' THEN 3 WHEN '4-NOT SPECIFIED' THEN 2 WHEN '5-LOW' THEN 1 WHEN '9-OLD' THEN 3 END"


@query("cdc_change_type_counts", _CDC + "SELECT ct change_type, count(*)::BIGINT n FROM j GROUP BY 1")
def cdc_change_type_counts(spark: SparkSession, d: str) -> DataFrame:
    return cdc.run_statistics(_compared(spark, d)).withColumnRenamed("CHANGE_TYPE", "change_type")


@query(
    "cdc_state",
    _CDC + f"SELECT '{TODAY}' extract_date, ct change_type, 'o_orderkey=|' || o_orderkey business_key, h row_hash, ph old_row_hash, o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM j",
)
def cdc_state(spark: SparkSession, d: str) -> DataFrame:
    return _compared(spark, d).select(
        F.col("EXTRACT_DATE").alias("extract_date"), F.col("CHANGE_TYPE").alias("change_type"), F.col("BUSINESS_KEY").alias("business_key"),
        F.col("ROW_HASH").alias("row_hash"), F.col("OLD_ROW_HASH").alias("old_row_hash"), *_COLS,
    )


@query(
    "cdc_changed_columns",
    _CDC + "SELECT o_orderkey, cc changed_columns, coalesce(CASE WHEN cc = '' THEN 0 ELSE length(cc) - length(replace(cc,'|','')) + 1 END, 0)::BIGINT changed_columns_count FROM k WHERE ct LIKE 'UPDATED%'",
)
def cdc_changed_columns(spark: SparkSession, d: str) -> DataFrame:
    return _compared(spark, d).filter("CHANGE_TYPE LIKE 'UPDATED%'").select(
        "o_orderkey", F.col("CHANGED_COLUMNS").alias("changed_columns"), F.col("CHANGED_COLUMNS_COUNT").alias("changed_columns_count")
    )


@query(
    "cdc_severity",
    _CDC + f"""SELECT o_orderkey, CASE WHEN ct = 'UPDATED_PRIORITY' AND {_RANK.format('o_orderpriority')} > {_RANK.format('pp')} THEN 'HIGH'
WHEN ct IN ('UPDATED_PRIORITY','UPDATED_STATUS') THEN 'MEDIUM' WHEN ct = 'UPDATED' THEN 'LOW' END severity FROM j""",
)
def cdc_severity(spark: SparkSession, d: str) -> DataFrame:
    return _compared(spark, d).select("o_orderkey", F.col("CHANGE_SEVERITY").alias("severity"))


@query(
    "cdc_summary",
    _CDC + """SELECT o_orderkey, CASE WHEN o_orderstatus IS DISTINCT FROM ps THEN 'STATUS: '||coalesce(ps,'')||' -> '||coalesce(o_orderstatus,'')
WHEN o_orderpriority IS DISTINCT FROM pp THEN 'PRIORITY: '||coalesce(pp,'')||' -> '||coalesce(o_orderpriority,'') END summary FROM k WHERE ct LIKE 'UPDATED%'""",
)
def cdc_summary(spark: SparkSession, d: str) -> DataFrame:
    return _compared(spark, d).filter("CHANGE_TYPE LIKE 'UPDATED%'").select("o_orderkey", F.col("CHANGE_SUMMARY").alias("summary"))


@query("cdc_first_seen", _CDC + f"SELECT o_orderkey, CASE WHEN pk IS NULL THEN '{TODAY}' ELSE '{BEFORE}' END first_seen_date, '{TODAY}' last_seen_date FROM j")
def cdc_first_seen(spark: SparkSession, d: str) -> DataFrame:
    return _compared(spark, d).select("o_orderkey", F.col("FIRST_SEEN_DATE").alias("first_seen_date"), F.col("LAST_SEEN_DATE").alias("last_seen_date"))


@query(
    "cdc_event_filter",
    _CDC + "SELECT 'later' run, ct change_type, count(*)::BIGINT n FROM j WHERE ct <> 'UNCHANGED' GROUP BY ALL UNION ALL SELECT 'first', ct, count(*)::BIGINT FROM j WHERE ct LIKE 'UPDATED%' GROUP BY ALL",
)
def cdc_event_filter(spark: SparkSession, d: str) -> DataFrame:
    rows = _compared(spark, d)
    parts = [cdc.run_statistics(cdc.events_of(rows, first)).select(F.lit(run).alias("run"), F.col("CHANGE_TYPE").alias("change_type"), "n") for run, first in (("later", False), ("first", True))]
    return parts[0].unionByName(parts[1])


@query("cdc_incompatible_schema", _CDC + "SELECT CASE WHEN pk IS NULL THEN 'NEW' ELSE 'UNCHANGED' END change_type, count(*)::BIGINT n FROM j GROUP BY 1")
def cdc_incompatible_schema(spark: SparkSession, d: str) -> DataFrame:
    old = _state(_prev(spark, d)).drop("o_orderpriority")
    return cdc.run_statistics(cdc.compare(_cur(spark, d), old, SPEC, TODAY)).withColumnRenamed("CHANGE_TYPE", "change_type")


@query(
    "cdc_removed",
    _CDC + "SELECT ct change_type, count(*)::BIGINT n FROM j GROUP BY 1 UNION ALL SELECT 'REMOVED', count(*)::BIGINT FROM prev WHERE o_orderkey NOT IN (SELECT o_orderkey FROM cur)",
)
def cdc_removed(spark: SparkSession, d: str) -> DataFrame:
    return cdc.run_statistics(cdc.compare(_cur(spark, d), _state(_prev(spark, d)), SPEC, TODAY, removed=True)).withColumnRenamed("CHANGE_TYPE", "change_type")


_KM = "CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN ' ' WHEN c_custkey % 11 = 0 THEN ' None ' WHEN c_custkey % 13 = 0 THEN 'nan' ELSE c_name END"


@query(
    "key_missing_rows",
    f"SELECT (lower(trim(coalesce(k,''))) IN ('','none','nan','nat')) missing, count(*)::BIGINT n FROM (SELECT {_KM} k FROM customer) GROUP BY 1",
)
def key_missing_rows(spark: SparkSession, d: str) -> DataFrame:
    keyed = table(spark, d, "customer").select(F.expr(_KM).alias("k"))
    return keyed.groupBy(is_missing("k").alias("missing")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "duplicate_key_groups",
    "SELECT l_orderkey, l_linenumber, count(*)::BIGINT n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def duplicate_key_groups(spark: SparkSession, d: str) -> DataFrame:
    return cdc.duplicate_groups(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dedupe_first_by_hash",
    """WITH h AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey,
 md5(concat_ws('|', l_linenumber::VARCHAR, l_orderkey::VARCHAR, l_partkey::VARCHAR, l_suppkey::VARCHAR)) row_hash FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_hash FROM h QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY row_hash) = 1""",
)
def dedupe_first_by_hash(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    kept = cdc.one_per_key(cdc.with_keys(rows, CdcSpec(key=["l_orderkey", "l_linenumber"])))
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("ROW_HASH").alias("row_hash"))


@query(
    "latest_previous_row",
    "SELECT user_id, event_id, event_type FROM events WHERE user_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) = 1",
)
def latest_previous_row(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    return cdc.latest_rows(events, "user_id", [F.col("ts"), -F.col("event_id")]).drop("ts")


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").dropDuplicates()


# --------------------------------------------------------------------------- merges

_STAGE = "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 3 <> 0"
_OLD = "SELECT o_orderkey, o_custkey, 'OLD' o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 2 = 0"


def _stage(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").filter("o_orderkey % 3 <> 0").select("o_orderkey", "o_custkey", "o_orderstatus")


def _old(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").filter("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey", F.lit("OLD").alias("o_orderstatus"), "o_orderpriority")


@query("merge_complete", _STAGE)
def merge_complete(spark: SparkSession, d: str) -> DataFrame:
    return merge.merge_snapshot(_old(spark, d), _stage(spark, d), ["o_orderkey"], complete=True)


@query(
    "merge_partial",
    f"WITH s AS ({_STAGE}), o AS ({_OLD}) SELECT *, NULL::VARCHAR o_orderpriority FROM s UNION ALL SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = o.o_orderkey)",
)
def merge_partial(spark: SparkSession, d: str) -> DataFrame:
    return merge.merge_snapshot(_old(spark, d), _stage(spark, d), ["o_orderkey"], complete=False)


@query(
    "merge_latest_wins",
    """WITH b AS (SELECT event_id, ts, user_id, event_type, 0 src FROM events WHERE event_id % 2 = 0 UNION ALL SELECT event_id, ts, user_id, event_type, 1 FROM events WHERE event_id % 3 = 0)
SELECT user_id, event_id, event_type FROM b WHERE user_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, src DESC, event_id DESC) = 1
UNION ALL SELECT user_id, event_id, event_type FROM b WHERE user_id IS NULL""",
)
def merge_latest_wins(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    merged = merge.merge_latest_wins(e.filter("event_id % 2 = 0"), e.filter("event_id % 3 = 0"), "user_id", [F.col("ts")], F.col("event_id"))
    return merged.select("user_id", "event_id", "event_type")


@query(
    "merge_accounting",
    f"""WITH a AS (SELECT DISTINCT o_orderkey FROM ({_OLD})), b AS (SELECT DISTINCT o_orderkey FROM ({_STAGE}))
SELECT count(a.o_orderkey)::BIGINT previous_keys, count(b.o_orderkey)::BIGINT received_keys, count(*) FILTER (a.o_orderkey IS NULL)::BIGINT inserted,
count(*) FILTER (a.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL)::BIGINT refreshed, count(*) FILTER (b.o_orderkey IS NULL)::BIGINT retained
FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey""",
)
def merge_accounting(spark: SparkSession, d: str) -> DataFrame:
    return merge.merge_accounting(_old(spark, d), _stage(spark, d), "o_orderkey")


@query("freshness_counts", "SELECT count(*) FILTER (o_orderpriority = '1-URGENT')::BIGINT refreshed_rows, count(*) FILTER (o_orderpriority IS DISTINCT FROM '1-URGENT')::BIGINT stale_rows FROM orders")
def freshness_counts(spark: SparkSession, d: str) -> DataFrame:
    return merge.freshness(table(spark, d, "orders"), "o_orderpriority", "1-URGENT")


# --------------------------------------------------------------------------- versions and queues

_EV = "SELECT 'e' || event_id uuid, 'u' || user_id device, (event_type = 'click') latest_version, event_id % 9 version_number, lpad(CAST((event_id * 7919) % 100003 AS VARCHAR), 6, '0') ulid FROM events"
_EVC = f"""WITH e AS ({_EV}),
c AS (SELECT uuid FROM e WHERE device IS NOT NULL QUALIFY row_number() OVER (PARTITION BY device ORDER BY latest_version DESC, version_number DESC, ulid DESC, uuid DESC) = 1),
x AS (SELECT uuid, 'x' || version_number last_extract FROM e WHERE version_number IN (1, 2, 3)),
f AS (SELECT e.*, c.uuid IS NOT NULL is_current, x.uuid IS NOT NULL already_there, x.last_extract FROM e LEFT JOIN c USING (uuid) LEFT JOIN x USING (uuid))
"""


def _versions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        F.concat(F.lit("e"), F.col("event_id")).alias("uuid"), F.concat(F.lit("u"), F.col("user_id")).alias("device"), (F.col("event_type") == "click").alias("latest_version"),
        (F.col("event_id") % 9).alias("version_number"), F.lpad(((F.col("event_id") * 7919) % 100003).cast("string"), 6, "0").alias("ulid"),
    )


def _existing(rows: DataFrame) -> DataFrame:
    return rows.filter("version_number IN (1, 2, 3)").select("uuid", F.concat(F.lit("x"), F.col("version_number")).alias("last_extract"))


@query("current_version_per_identity", _EVC + "SELECT e.uuid, e.device, e.latest_version, e.version_number, e.ulid FROM e JOIN c USING (uuid)")
def current_version_per_identity(spark: SparkSession, d: str) -> DataFrame:
    return versions.current_versions(_versions(spark, d), versions.identity_key(["device"]), "uuid").select("uuid", "device", "latest_version", "version_number", "ulid")


def _candidates(spark: SparkSession, d: str, mode: str) -> DataFrame:
    rows = _versions(spark, d)
    return versions.candidates(rows, _existing(rows), mode, versions.identity_key(["device"]), "uuid").select("uuid", "is_current", "already_there")


@query("candidates_incremental", _EVC + "SELECT uuid, is_current, already_there FROM f WHERE NOT already_there")
def candidates_incremental(spark: SparkSession, d: str) -> DataFrame:
    return _candidates(spark, d, "incremental")


@query("candidates_incremental_current", _EVC + "SELECT uuid, is_current, already_there FROM f WHERE NOT already_there AND is_current")
def candidates_incremental_current(spark: SparkSession, d: str) -> DataFrame:
    return _candidates(spark, d, "incremental_current")


@query("candidates_historical", _EVC + "SELECT uuid, is_current, already_there FROM f WHERE NOT is_current")
def candidates_historical(spark: SparkSession, d: str) -> DataFrame:
    return _candidates(spark, d, "historical")


def _queue(spark: SparkSession, d: str, mode: str) -> DataFrame:
    rows = _versions(spark, d)
    return versions.build_queue(rows, _existing(rows), mode, versions.identity_key(["device"]), "uuid", "last_extract")


@query(
    "priority_queue",
    _EVC + """SELECT uuid, CASE WHEN is_current THEN 'FULL_CURRENT' ELSE 'FULL_HISTORICAL' END queue_source, CASE WHEN is_current THEN 1 ELSE 2 END::BIGINT priority, 'pending' status,
 last_extract last_detail_extract FROM f""",
)
def priority_queue(spark: SparkSession, d: str) -> DataFrame:
    return _queue(spark, d, "full").select("uuid", "queue_source", "priority", "status", "last_detail_extract")


@query(
    "priority_queue_head",
    _EVC + """SELECT uuid, row_number() OVER (ORDER BY priority, last_extract, uuid)::BIGINT queue_index FROM
(SELECT uuid, CASE WHEN is_current THEN 1 ELSE 2 END priority, coalesce(last_extract, '0000') last_extract FROM f) ORDER BY queue_index LIMIT 100""",
)
def priority_queue_head(spark: SparkSession, d: str) -> DataFrame:
    """The first hundred entries of the queue: what the next run drains."""
    from pyspark.sql import Window

    order = versions.queue_order("full", "uuid")
    head = _queue(spark, d, "full").orderBy(*order).limit(100)
    return head.select("uuid", F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("queue_index"))


@query(
    "queue_status_rollup",
    _EVC + """SELECT CASE WHEN version_number = 0 THEN 'done' WHEN version_number = 4 THEN 'failed' ELSE 'pending' END status,
CASE WHEN is_current THEN 1 ELSE 2 END::BIGINT priority, count(*)::BIGINT n, sum(CASE WHEN version_number IN (0, 4) THEN 1 ELSE 0 END)::BIGINT attempts FROM f GROUP BY 1, 2""",
)
def queue_status_rollup(spark: SparkSession, d: str) -> DataFrame:
    results = _versions(spark, d).filter("version_number IN (0, 4)").select(
        "uuid", (F.col("version_number") == 0).alias("ok"), F.when(F.col("version_number") == 0, 200).otherwise(500).alias("status_code"), F.lit(None).cast("string").alias("error")
    )
    drained = versions.apply_results(_queue(spark, d, "full"), results, "uuid", TODAY)
    return drained.groupBy("status", "priority").agg(F.count(F.lit(1)).alias("n"), F.sum("attempt_count").alias("attempts"))


# --------------------------------------------------------------------------- relations


@query("code_label_lookup", "SELECT c_custkey, n_name nation, r_name region FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def code_label_lookup(spark: SparkSession, d: str) -> DataFrame:
    nations = relations.code_labels(table(spark, d, "nation"), "n_nationkey", "n_name")
    regions = relations.code_labels(table(spark, d, "region"), "r_regionkey", "r_name")
    parents = relations.code_labels(table(spark, d, "nation"), "n_nationkey", "n_regionkey")
    rows = relations.with_label(table(spark, d, "customer").select("c_custkey", "c_nationkey"), F.col("c_nationkey"), nations, "n_nationkey", "n_name", "nation")
    rows = relations.with_label(rows, F.col("c_nationkey"), parents, "n_nationkey", "n_regionkey", "parent")
    return relations.with_label(rows, F.col("parent"), regions, "r_regionkey", "r_name", "region").select("c_custkey", "nation", "region")


@query(
    "prefix_or_in_relation",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority LIKE '1-%' OR o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
)
def prefix_or_in_relation(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").cast("string").alias("k"))
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", F.col("o_custkey").cast("string").alias("cust"))
    return relations.prefix_or_known(rows, ["o_orderpriority", "cust"], "1-", known, "k").select("o_orderkey", "o_orderpriority")


@query("edge_union_distinct", "SELECT l_orderkey item, l_partkey::VARCHAR actor FROM lineitem WHERE l_partkey IS NOT NULL UNION SELECT l_orderkey, l_suppkey::VARCHAR FROM lineitem WHERE l_suppkey IS NOT NULL")
def edge_union_distinct(spark: SparkSession, d: str) -> DataFrame:
    return relations.edges(table(spark, d, "lineitem"), "l_orderkey", [("part", "l_partkey"), ("supplier", "l_suppkey")]).withColumnRenamed("l_orderkey", "item")


@query(
    "edge_union_all_counts",
    """SELECT actor, count(*) FILTER (role = 'part')::BIGINT as_part, count(*) FILTER (role = 'supplier')::BIGINT as_supplier FROM
(SELECT l_partkey::VARCHAR actor, 'part' role FROM lineitem UNION ALL SELECT l_suppkey::VARCHAR, 'supplier' FROM lineitem) WHERE actor IS NOT NULL GROUP BY 1""",
)
def edge_union_all_counts(spark: SparkSession, d: str) -> DataFrame:
    made = relations.edges(table(spark, d, "lineitem"), "l_orderkey", [("part", "l_partkey"), ("supplier", "l_suppkey")], distinct=False)
    return made.groupBy("actor").agg(ranking.flag_sum(F.col("role") == "part").alias("as_part"), ranking.flag_sum(F.col("role") == "supplier").alias("as_supplier"))


# --------------------------------------------------------------------------- rankings

_PR = {"1-URGENT": 5, "2-HIGH": 4, "3-MEDIUM": 3, "4-NOT SPECIFIED": 2, "5-LOW": 1}
_PRC = "CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4 WHEN '3-MEDIUM' THEN 3 WHEN '4-NOT SPECIFIED' THEN 2 WHEN '5-LOW' THEN 1 END"
_CC = "SELECT o_custkey, o_orderpriority, count(DISTINCT o_orderkey) n FROM orders WHERE o_orderpriority IS NOT NULL AND o_custkey IS NOT NULL GROUP BY ALL"


def _priorities(spark: SparkSession, d: str) -> DataFrame:
    return ranking.category_counts(table(spark, d, "orders"), "o_custkey", "o_orderpriority", "o_orderkey")


@query("dominant_category", f"SELECT o_custkey, o_orderpriority, n::BIGINT n FROM ({_CC}) QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) = 1")
def dominant_category(spark: SparkSession, d: str) -> DataFrame:
    return ranking.top_category(_priorities(spark, d), "o_custkey", "o_orderpriority").select("o_custkey", "o_orderpriority", "n")


@query(
    "highest_rank_category",
    f"SELECT o_custkey, o_orderpriority, n::BIGINT n, rk::INTEGER AS \"rank\" FROM (SELECT *, {_PRC} rk FROM ({_CC})) WHERE rk IS NOT NULL QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY rk DESC, n DESC, o_orderpriority) = 1",
)
def highest_rank_category(spark: SparkSession, d: str) -> DataFrame:
    return ranking.top_category(_priorities(spark, d), "o_custkey", "o_orderpriority", ranks=_PR)


_RF = {"R": 3, "N": 2, "A": 1}
_RFC = "SELECT l_suppkey, l_returnflag, count(DISTINCT l_orderkey) n, CASE l_returnflag WHEN 'R' THEN 3 WHEN 'N' THEN 2 WHEN 'A' THEN 1 END rk FROM lineitem WHERE l_suppkey IS NOT NULL AND l_returnflag IS NOT NULL GROUP BY ALL"


@query(
    "latest_oldest_profile",
    f"""WITH c AS ({_RFC}) SELECT 'latest' profile, l_suppkey, l_returnflag, n::BIGINT n FROM c WHERE rk IS NOT NULL QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY rk DESC, n DESC, l_returnflag) = 1
UNION ALL SELECT 'oldest', l_suppkey, l_returnflag, n::BIGINT FROM c WHERE rk IS NOT NULL QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY rk, n DESC, l_returnflag) = 1""",
)
def latest_oldest_profile(spark: SparkSession, d: str) -> DataFrame:
    counts = ranking.category_counts(table(spark, d, "lineitem"), "l_suppkey", "l_returnflag", "l_orderkey")
    parts = [
        ranking.top_category(counts, "l_suppkey", "l_returnflag", ranks=_RF, oldest=old).select(F.lit(name).alias("profile"), "l_suppkey", "l_returnflag", "n")
        for name, old in (("latest", False), ("oldest", True))
    ]
    return parts[0].unionByName(parts[1])


@query(
    "migration_score",
    """SELECT l_suppkey, count(*) FILTER (l_returnflag = 'N')::BIGINT newer, count(*) FILTER (l_returnflag IN ('N','R'))::BIGINT either,
CASE WHEN count(*) FILTER (l_returnflag IN ('N','R')) = 0 THEN NULL ELSE round(100.0::DOUBLE * (count(*) FILTER (l_returnflag = 'N'))::DOUBLE / (count(*) FILTER (l_returnflag IN ('N','R')))::DOUBLE, 2) END score
FROM lineitem GROUP BY 1""",
)
def migration_score(spark: SparkSession, d: str) -> DataFrame:
    new, both = ranking.flag_sum(F.col("l_returnflag") == "N"), ranking.flag_sum(F.col("l_returnflag").isin("N", "R"))
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(new.alias("newer"), both.alias("either"), ranking.share_score(new, both).alias("score"))


@query(
    "actor_metric_star",
    f"""WITH c AS (SELECT l_suppkey, count(DISTINCT l_orderkey)::BIGINT orders, count(DISTINCT l_partkey)::BIGINT parts FROM lineitem WHERE l_suppkey % 10 <> 0 GROUP BY 1),
t AS (SELECT l_suppkey, l_returnflag, n FROM ({_RFC}) QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_returnflag) = 1)
SELECT s_suppkey, s_name, coalesce(orders, 0)::BIGINT orders, coalesce(parts, 0)::BIGINT parts, l_returnflag top_flag FROM supplier LEFT JOIN c ON s_suppkey = c.l_suppkey LEFT JOIN t ON s_suppkey = t.l_suppkey""",
)
def actor_metric_star(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem")
    counts = lines.filter("l_suppkey % 10 <> 0").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_partkey").alias("parts"))
    top = ranking.top_category(ranking.category_counts(lines, "l_suppkey", "l_returnflag", "l_orderkey"), "l_suppkey", "l_returnflag")
    top = top.select(F.col("l_suppkey").alias("s_suppkey"), F.col("l_returnflag").alias("top_flag"))
    return ranking.metric_star(table(spark, d, "supplier").select("s_suppkey", "s_name"), "s_suppkey", [counts, top], zero=["orders", "parts"])


@query(
    "previous_metric_delta",
    """WITH c AS (SELECT l_suppkey s, count(*)::BIGINT n FROM lineitem GROUP BY 1), p AS (SELECT l_suppkey s, count(*)::BIGINT n FROM lineitem WHERE l_suppkey % 4 <> 0 AND l_linenumber <= 3 GROUP BY 1)
SELECT c.s l_suppkey, c.n, p.n n_previous, c.n - p.n n_change FROM c LEFT JOIN p ON c.s = p.s""",
)
def previous_metric_delta(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem")
    cur = lines.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    prev = lines.filter("l_suppkey % 4 <> 0 AND l_linenumber <= 3").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return ranking.previous_delta(cur, prev, "l_suppkey", ["n"])


@query(
    "update_from_metrics",
    "SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'X' || s_suppkey ELSE s_name END s_name, s_nationkey FROM supplier",
)
def update_from_metrics(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    patch = s.filter("s_suppkey % 3 = 0").select("s_suppkey", F.concat(F.lit("X"), F.col("s_suppkey")).alias("s_name"))
    return ranking.update_from(s, patch, "s_suppkey", ["s_name"])


@query(
    "span_newest_oldest",
    """WITH c AS (SELECT l_suppkey, count(*) FILTER (l_returnflag='R') r, count(*) FILTER (l_returnflag='N') n, count(*) FILTER (l_returnflag='A') a FROM lineitem GROUP BY 1)
SELECT l_suppkey, CASE WHEN r > 0 THEN 'R' WHEN n > 0 THEN 'N' WHEN a > 0 THEN 'A' END newest, CASE WHEN a > 0 THEN 'A' WHEN n > 0 THEN 'N' WHEN r > 0 THEN 'R' END oldest,
round(n::DOUBLE / nullif(r + n + a, 0)::DOUBLE, 4) middle_ratio FROM c""",
)
def span_newest_oldest(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "lineitem").groupBy("l_suppkey").agg(*[ranking.flag_sum(F.col("l_returnflag") == f).alias(f.lower()) for f in "RNA"])
    ratio = F.round(F.try_divide(F.col("n").cast("double"), (F.col("r") + F.col("n") + F.col("a")).cast("double")), 4)
    span = ranking.ladder_span(c, "l_suppkey", {"R": "r", "N": "n", "A": "a"})
    return ranking.metric_star(span, "l_suppkey", [c.select("l_suppkey", ratio.alias("middle_ratio"))])


@query(
    "top10_entities",
    "SELECT s_name, s_suppkey, count(*)::BIGINT n, row_number() OVER (ORDER BY count(*) DESC, s_name, s_suppkey)::BIGINT AS \"rank\" FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_name, s_suppkey QUALIFY \"rank\" <= 10",
)
def top10_entities(spark: SparkSession, d: str) -> DataFrame:
    # counted on the key before the join, so names do not travel with every line
    counts = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count(F.lit(1)).alias("c"))
    named = counts.join(table(spark, d, "supplier").select("s_suppkey", "s_name"), "s_suppkey")
    return ranking.top_entities(named, ["s_name", "s_suppkey"], 10, F.sum("c"))


@query("category_distribution", "SELECT CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderstatus END status, count(*)::BIGINT n FROM orders GROUP BY 1")
def category_distribution(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select(F.expr("CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderstatus END").alias("status"))
    return ranking.distribution(rows, "status")


@query(
    "actor_summary",
    """SELECT c_custkey, c_name, coalesce(n, 0)::BIGINT orders, coalesce(u, 0)::BIGINT urgent FROM customer LEFT JOIN
(SELECT coalesce(CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_custkey END, 0) k, count(*) n, count(*) FILTER (o_orderpriority = '1-URGENT') u FROM orders GROUP BY 1) ON c_custkey = k""",
)
def actor_summary(spark: SparkSession, d: str) -> DataFrame:
    who = F.coalesce(F.when(F.col("o_orderkey") % 4 != 0, F.col("o_custkey")), F.lit(0)).cast("bigint")
    per = table(spark, d, "orders").groupBy(who.alias("c_custkey")).agg(F.count(F.lit(1)).alias("orders"), ranking.flag_sum(F.col("o_orderpriority") == "1-URGENT").alias("urgent"))
    return ranking.metric_star(table(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey", [per], zero=["orders", "urgent"])


# --------------------------------------------------------------------------- coverage

_KEYS = """WITH a AS (SELECT DISTINCT o_custkey::VARCHAR k FROM orders WHERE o_custkey IS NOT NULL AND o_custkey % 3 <> 0), b AS (SELECT DISTINCT c_custkey::VARCHAR k FROM customer WHERE c_custkey % 5 <> 0)
"""


def _key_sets(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    a = coverage.key_set(table(spark, d, "orders").filter("o_custkey % 3 <> 0"), F.col("o_custkey"))
    b = coverage.key_set(table(spark, d, "customer").filter("c_custkey % 5 <> 0"), F.col("c_custkey"))
    return a, b


_OVER = """, j AS (SELECT a.k ak, b.k bk FROM a FULL JOIN b ON a.k = b.k), c AS (SELECT count(ak)::BIGINT left_keys, count(bk)::BIGINT right_keys,
count(*) FILTER (ak IS NOT NULL AND bk IS NOT NULL)::BIGINT common_keys, count(*) FILTER (bk IS NULL)::BIGINT left_only, count(*) FILTER (ak IS NULL)::BIGINT right_only FROM j) """


@query("coverage_overlap", _KEYS + _OVER + "SELECT * FROM c")
def coverage_overlap(spark: SparkSession, d: str) -> DataFrame:
    return coverage.overlap(*_key_sets(spark, d)).select("left_keys", "right_keys", "common_keys", "left_only", "right_only")


@query("coverage_pct", _KEYS + _OVER + "SELECT round(common_keys::DOUBLE*100/left_keys::DOUBLE,4) left_coverage_pct, round(common_keys::DOUBLE*100/right_keys::DOUBLE,4) right_coverage_pct FROM c")
def coverage_pct(spark: SparkSession, d: str) -> DataFrame:
    return coverage.overlap(*_key_sets(spark, d)).select("left_coverage_pct", "right_coverage_pct")


@query(
    "coverage_samples",
    _KEYS + "SELECT * FROM (SELECT 'left_only' AS sample, k key_value FROM a WHERE k NOT IN (SELECT k FROM b) ORDER BY 2 LIMIT 20) UNION ALL SELECT * FROM (SELECT 'right_only', k FROM b WHERE k NOT IN (SELECT k FROM a) ORDER BY 2 LIMIT 20) "
    "UNION ALL SELECT * FROM (SELECT 'common', k FROM a WHERE k IN (SELECT k FROM b) ORDER BY 2 LIMIT 20)",
)
def coverage_samples(spark: SparkSession, d: str) -> DataFrame:
    """The first twenty keys of each kind: a sample report."""
    return coverage.samples(*_key_sets(spark, d), 20)


def _missing_sql(c: str) -> str:
    return f"(trim(coalesce({c}::VARCHAR,''), ' \t\n\r') <> '' AND lower(trim({c}::VARCHAR, ' \t\n\r')) NOT IN ('none','nan','nat'))"


@query(
    "column_presence",
    " UNION ALL ".join(f"SELECT '{c}' column_name, count(*) FILTER {_missing_sql(c).join(['(WHERE ', ')'])}::BIGINT present_rows, count(*)::BIGINT total_rows FROM documents" for c in ("doc_id", "lang", "source", "n_chars", "bundle_id")),
)
def column_presence(spark: SparkSession, d: str) -> DataFrame:
    return coverage.presence(table(spark, d, "documents"), ["doc_id", "lang", "source", "n_chars", "bundle_id"])


@query(
    "coverage_missing_rows",
    "SELECT o.o_custkey::VARCHAR key_value, o.o_custkey, o.o_orderkey, o.o_orderstatus FROM orders o WHERE o.o_custkey::VARCHAR NOT IN (SELECT c_custkey::VARCHAR FROM customer WHERE c_nationkey <> 3) ORDER BY 1, 2, 3, 4 LIMIT 1000",
)
def coverage_missing_rows(spark: SparkSession, d: str) -> DataFrame:
    """Whole orders of customers the other side lacks (those of one nation): the first thousand, a sample report."""
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return coverage.missing_rows(orders, table(spark, d, "customer").filter("c_nationkey <> 3"), F.col("o_custkey"), F.col("c_custkey"))


@query(
    "cdc_run_report",
    _CDC + """SELECT (SELECT count(*) FROM cur)::BIGINT source_rows, 0::BIGINT key_missing_rows, (SELECT count(*) FROM (SELECT o_orderkey FROM cur GROUP BY 1 HAVING count(*) > 1))::BIGINT duplicate_keys,
(SELECT count(*) FROM j)::BIGINT state_rows, (SELECT count(*) FROM j WHERE ct <> 'UNCHANGED')::BIGINT appended_events""",
)
def cdc_run_report(spark: SparkSession, d: str) -> DataFrame:
    return cdc.run_report(_cur(spark, d), _compared(spark, d), SPEC, first_run=False)


# --------------------------------------------------------------------------- extracts

LOOP = "snapledger.sources.loopback:serve"


def _unfolded(pages: DataFrame, path: str) -> DataFrame:
    return flatten.explode_entries(pages.filter("error IS NULL"), "body", path, "struct<id:bigint>", ["label", "page"])


@query("offset_page_scan", "SELECT 'pages' AS label, i // 40 page, i id FROM range(1000) t(i)")
def offset_page_scan(spark: SparkSession, d: str) -> DataFrame:  # noqa: ARG001
    """A thousand records by pages of forty, several partitions at a time, through the loopback transport."""
    spark.dataSource.register(paged.PagedSource)
    ship(spark)
    found = paged.discover(loopback.serve, "loop://offset/1000/40")
    pages = spark.read.format("paged").options(transport=LOOP, url="loop://offset/1000/40", mode="offset", pages=str(found["total_pages"]), pagesPerPartition="7").load()
    return _unfolded(pages, "$.content")


@query("next_link_scan", "SELECT l AS label, i // 30 page, i id FROM range(200) t(i), (VALUES ('risk=1'), ('risk=2 law=9')) p(l)")
def next_link_scan(spark: SparkSession, d: str) -> DataFrame:  # noqa: ARG001
    """Two planned partitions, each followed along its next links."""
    spark.dataSource.register(paged.PagedSource)
    ship(spark)
    plan = '[{"risk": 1}, {"risk": 2, "law": 9}]'
    return _unfolded(spark.read.format("paged").options(transport=LOOP, url="loop://next/200/30", partitions=plan).load(), "$.value")


@query(
    "key_lookup_scan",
    """SELECT s_suppkey::VARCHAR "key", CASE WHEN s_suppkey % 7 = 0 THEN 404 WHEN s_suppkey % 11 = 0 THEN 403 ELSE 200 END::BIGINT status,
CASE WHEN s_suppkey % 7 = 0 OR s_suppkey % 11 = 0 THEN NULL ELSE s_suppkey * s_suppkey END::BIGINT square, CASE WHEN s_suppkey % 7 = 0 THEN 'status 404' WHEN s_suppkey % 11 = 0 THEN 'refused' END error FROM supplier""",
)
def key_lookup_scan(spark: SparkSession, d: str) -> DataFrame:
    """One request for each supplier key; what fails comes back as an error row."""
    got = paged.lookup(table(spark, d, "supplier"), "s_suppkey", LOOP, "loop://key/{key}?deny=1")
    return got.select("key", "status", F.get_json_object("body", "$.square").cast("bigint").alias("square"), "error")


# --------------------------------------------------------------------------- audits


@query(
    "field_inventory",
    " UNION ALL ".join(f"SELECT 'customer' table_name, '{c}' field_name, count({c})::BIGINT non_null_rows, count(*)::BIGINT total_rows FROM customer" for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")),
)
def field_inventory(spark: SparkSession, d: str) -> DataFrame:
    return audit.field_inventory(table(spark, d, "customer"), "customer")


_PAGED = "SELECT event_id // 300 page, user_id, event_type, ts, value, event_id FROM events"


def _paged(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").withColumn("page", F.floor(F.col("event_id") / 300))


@query(
    "page_audit_diag",
    f"SELECT page, count(*)::BIGINT rows_returned, count(user_id)::BIGINT key_rows, count(DISTINCT user_id)::BIGINT distinct_keys, count(*) FILTER (user_id IS NULL)::BIGINT missing_keys, (count(user_id) - count(DISTINCT user_id))::BIGINT duplicate_keys FROM ({_PAGED}) GROUP BY 1",
)
def page_audit_diag(spark: SparkSession, d: str) -> DataFrame:
    return audit.page_diagnostics(_paged(spark, d), "page", "user_id")


_NOVEL = """WITH n AS (SELECT event_id // 50 page, count(DISTINCT CASE WHEN user_id = 7 THEN user_id END) nk FROM events GROUP BY 1),
g AS (SELECT page, page - row_number() OVER (ORDER BY page) g FROM n WHERE nk = 0), r AS (SELECT min(page) first_page, max(page) last_page, count(*)::BIGINT pages FROM g GROUP BY g)
"""


def _novelty(spark: SparkSession, d: str) -> DataFrame:
    """Pages of fifty events; all users but one are known."""
    events = table(spark, d, "events")
    return audit.page_novelty(events.withColumn("page", F.floor(F.col("event_id") / 50)), events.filter("user_id <> 7"), "page", "user_id")


@query("known_page_streak", _NOVEL + "SELECT * FROM r")
def known_page_streak(spark: SparkSession, d: str) -> DataFrame:
    return audit.known_streaks(_novelty(spark, d), "page", "new_keys")


@query(
    "head_tail_pages",
    _NOVEL + """, e AS (SELECT coalesce((SELECT min(first_page) FROM r WHERE pages >= 5), (SELECT max(page) + 1 FROM n)) head_end)
SELECT any_value(head_end) head_end, count(*) FILTER (nk > 0 AND page < head_end)::BIGINT head_pages, count(*) FILTER (nk > 0 AND page >= head_end)::BIGINT tail_pages, count(*) FILTER (nk > 0 AND page >= head_end) > 0 probe_needed FROM n, e""",
)
def head_tail_pages(spark: SparkSession, d: str) -> DataFrame:
    """Where a scan for new keys may stop after five known pages, and whether it must probe behind them."""
    return audit.head_tail_pages(_novelty(spark, d), "page", "new_keys", 5)


_ENC = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"
_MS = "(1704067200000 + event_id * 137)"
_ULID_SQL = " || ".join(f"substr('{_ENC}', (({_MS} // {32 ** (9 - i)}) % 32)::INT + 1, 1)" for i in range(10))


def _ulids(spark: SparkSession, d: str) -> DataFrame:
    ms = F.lit(1704067200000) + F.col("event_id") * 137
    text = F.concat(*[F.substring(F.lit(_ENC), F.pmod(F.floor(ms / F.lit(32 ** (9 - i))), F.lit(32)).cast("int") + 1, F.lit(1)) for i in range(10)])
    return table(spark, d, "events").select("event_id", text.alias("ulid"))


@query("ulid_frontier", f"WITH u AS (SELECT event_id, {_ULID_SQL} ulid, ts FROM events), m AS (SELECT max(ulid) f FROM u WHERE ts < (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM u) AND event_id <= (SELECT avg(event_id) FROM u)) SELECT event_id, ulid FROM u, m WHERE ulid > f OR f IS NULL")
def ulid_frontier(spark: SparkSession, d: str) -> DataFrame:
    """What is new since the extract at half time, which had the first half of the ids."""
    u, events = _ulids(spark, d), table(spark, d, "events")
    half = events.agg((F.min("ts") + (F.max("ts") - F.min("ts")) / 2).alias("at"), F.avg("event_id").alias("mid"))
    known = u.join(events.select("event_id", "ts"), "event_id").join(F.broadcast(half), (F.col("ts") < F.col("at")) & (F.col("event_id") <= F.col("mid")))
    return audit.beyond_frontier(u, known, "ulid")


@query("ulid_decode", f"SELECT event_id, {_ULID_SQL} ulid, {_MS}::BIGINT ms FROM events")
def ulid_decode(spark: SparkSession, d: str) -> DataFrame:
    return _ulids(spark, d).withColumn("ms", ulid_millis("ulid"))


@query("json_flatten", "SELECT event_id, json_extract_string(props, '$.k') k, props raw_json FROM events")
def json_flatten(spark: SparkSession, d: str) -> DataFrame:
    return flatten.flatten_declared(table(spark, d, "events").select("event_id", "props"), "props", ["k"])


@query("json_explode", "SELECT o_custkey, o_orderkey, o_orderpriority FROM orders WHERE o_custkey IS NOT NULL")
def json_explode(spark: SparkSession, d: str) -> DataFrame:
    """Orders of a customer as a JSON list and back, one row per entry."""
    packed = table(spark, d, "orders").filter("o_custkey IS NOT NULL").groupBy("o_custkey").agg(F.to_json(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))).alias("j"))
    return flatten.explode_entries(packed, "j", "$", "struct<o_orderkey:bigint,o_orderpriority:string>", ["o_custkey"])


@query("trace_partition_rollup", "SELECT event_type, count(*)::BIGINT pages, coalesce(sum(event_id % 300), 0)::BIGINT rows_returned, min(ts) first_page_at, max(ts) last_page_at, count(*) FILTER (value > 50)::BIGINT error_pages FROM events GROUP BY 1")
def trace_partition_rollup(spark: SparkSession, d: str) -> DataFrame:
    trace = table(spark, d, "events").withColumn("rows", F.col("event_id") % 300)
    return audit.trace_rollup(trace, ["event_type"], "rows", "ts", F.col("value") > 50)


_STATUS = "CASE event_id % 11 WHEN 0 THEN 429 WHEN 1 THEN 500 WHEN 2 THEN 404 WHEN 3 THEN 302 ELSE 200 END"


@query(
    "request_status_summary",
    f"""SELECT event_type endpoint, s status_code, CASE WHEN s = 200 THEN 'OK' WHEN s = 429 THEN 'RATE_LIMITED_429' WHEN s BETWEEN 500 AND 599 THEN 'SERVER_ERROR' WHEN s BETWEEN 400 AND 499 THEN 'CLIENT_ERROR' ELSE 'UNKNOWN' END classification,
count(*)::BIGINT n FROM (SELECT event_type, ({_STATUS})::INTEGER s FROM events) GROUP BY ALL""",
)
def request_status_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select(F.col("event_type").alias("endpoint"), F.expr(_STATUS).alias("status_code"))
    return rows.withColumn("classification", audit.status_class(F.col("status_code"))).groupBy("endpoint", "status_code", "classification").agg(F.count(F.lit(1)).alias("n"))


@query("recent_50_mean", "SELECT event_type, round(avg(value), 4) recent_mean FROM (SELECT event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC NULLS LAST, event_id DESC) <= 50) GROUP BY 1")
def recent_50_mean(spark: SparkSession, d: str) -> DataFrame:
    """Mean of the last fifty values per type: a telemetry report."""
    order = [F.col("ts").desc_nulls_last(), F.col("event_id").desc()]
    return audit.recent_mean(table(spark, d, "events"), order, "value", 50, ["event_type"])


@query(
    "schema_union_align",
    "SELECT c_custkey, c_name name, c_mktsegment, NULL::BIGINT s_suppkey FROM customer UNION ALL SELECT NULL, s_name, NULL, s_suppkey FROM supplier",
)
def schema_union_align(spark: SparkSession, d: str) -> DataFrame:
    from ..sources.snapshots import evolve

    return evolve(
        table(spark, d, "customer").select("c_custkey", F.col("c_name").alias("name"), "c_mktsegment"),
        table(spark, d, "supplier").select(F.col("s_name").alias("NAME"), "s_suppkey"),
    )


@query(
    "id_normalise",
    "SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 3 = 1 THEN '-' || p_size ELSE '-' || p_size END id FROM part",
)
def id_normalise(spark: SparkSession, d: str) -> DataFrame:
    raw = F.expr("CASE WHEN p_partkey % 5 = 0 THEN ' None' WHEN p_partkey % 3 = 1 THEN concat(' -', p_size, '.0 ') ELSE concat('-', p_size) END")
    return table(spark, d, "part").select("p_partkey", normalise_id(raw).alias("id"))


@query(
    "first_seen_history",
    f"""WITH h AS (SELECT md5(event_type || (event_id % 97)) h, 'd' || min(event_id % 5) f FROM events WHERE event_id % 97 < 60 GROUP BY 1),
p AS (SELECT DISTINCT md5(event_type || (event_id % 97)) h FROM events)
SELECT p.h page_hash, coalesce(f, '{TODAY}') first_seen, CASE WHEN f IS NULL THEN 'NEW' ELSE 'UNCHANGED' END change_type FROM p LEFT JOIN h ON p.h = h.h""",
)
def first_seen_history(spark: SparkSession, d: str) -> DataFrame:
    hashed = table(spark, d, "events").select("event_id", F.md5(F.concat("event_type", (F.col("event_id") % 97).cast("string"))).alias("page_hash"))
    history = hashed.filter("event_id % 97 < 60").select("page_hash", F.concat(F.lit("d"), (F.col("event_id") % 5).cast("string")).alias("FIRST_SEEN_DATE"))
    out = cdc.first_seen_history(hashed.select("page_hash").distinct(), history, "page_hash", TODAY)
    return out.select("page_hash", F.col("FIRST_SEEN_DATE").alias("first_seen"), F.col("CHANGE_TYPE").alias("change_type"))


@query("event_cleanup", "SELECT event_id, event_type FROM events WHERE NOT coalesce(strftime(ts, '%Y-%m-%d') IN ('2024-01-01','2024-01-03') AND event_type IN ('click','error'), false)")
def event_cleanup(spark: SparkSession, d: str) -> DataFrame:
    log = table(spark, d, "events").select("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return cdc.without_events(log, ["2024-01-01", "2024-01-03"], ["click", "error"], "day", "event_type").select("event_id", "event_type")


@query("labelled_keys", "SELECT n_nationkey, 'n_nationkey=|' || n_nationkey || '|n_name=|' || n_name business_key FROM nation")
def labelled_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select("n_nationkey", labelled_key(["n_nationkey", "n_name"]).alias("business_key"))


@query("partition_plan", "SELECT * FROM (VALUES ('risk=-203 law=-197'), ('risk=-204 law=-197'), ('risk=-10'), ('law=-55')) t(label)")
def partition_plan(spark: SparkSession, d: str) -> DataFrame:  # noqa: ARG001
    from ..sources.paged import label_of, plan_partitions

    config = {
        "combinations": [{"parameters": ["risk", "law"], "pairs": [["-203", "-197"], ["-204", "-197"], ["-205", None]]}, {"active": False, "parameters": ["risk", "law"], "pairs": [["-10", "-55"]]}],
        "parameters": {"risk": [{"value": "-203"}, {"value": "-10"}, {"value": "-1", "active": False}], "law": [{"value": "-197"}, {"value": "-55"}]},
    }
    return spark.createDataFrame([(label_of(p),) for p in plan_partitions(config)], "label string")


@query("stream_merge_available_now", "SELECT user_id, event_id, event_type FROM events WHERE user_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1 UNION ALL SELECT user_id, event_id, event_type FROM events WHERE user_id IS NULL")
def stream_merge_available_now(spark: SparkSession, d: str) -> DataFrame:
    """The latest event of each user, merged batch by batch from a file stream."""
    from ..sources.tables import scratch_path
    from ..streaming.merge_stream import MergedState

    events = table(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    source = scratch_path(spark, "stream-in")
    events.repartition(3, "event_id").write.parquet(source)
    state = MergedState(spark, scratch_path(spark, "stream-state"), "user_id", [F.col("ts"), F.col("event_id")])
    return state.run(source, events.schema, files_per_batch=2).select("user_id", "event_id", "event_type")
