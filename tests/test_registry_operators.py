"""The registry engine's operators on hand-made rows, and properties that must hold."""

from __future__ import annotations

import json
import random

import pytest
from tests.conftest import rows

from pyspark.sql import functions as F
from snapledger.operators import audit, cdc, coverage, flatten, merge, ranking, relations, versions
from snapledger.operators.cdc import CdcSpec
from snapledger.sources import exports, paged, snapshots
from snapledger.sources.tables import scratch_path
from snapledger.streaming.merge_stream import MergedState

C = F.col
UDI = CdcSpec(
    key=["UUID"],
    changes=[("UPDATED_LAW", ["LAW"]), ("UPDATED_RISK", ["RISK"]), ("UPDATED_ACTOR", ["MF", "AR"])],
    severities={"KEY_MISSING": "HIGH", "UPDATED_LAW": "HIGH", "UPDATED_RISK": "MEDIUM", "UPDATED_ACTOR": "MEDIUM", "UPDATED": "LOW"},
    raised=("UPDATED_RISK", "RISK", {"-203": 40, "-205": 80}),
    summaries=[("LAW", "LAW"), ("RISK", "RISK")],
)
SCHEMA = "UUID string, LAW string, RISK string, MF string, AR string, NAME string"


def compared(spark, cur, prev, spec=UDI, **kw):
    return cdc.compare(spark.createDataFrame(cur, SCHEMA), spark.createDataFrame(prev, SCHEMA).withColumn("ROW_HASH", cdc.row_hash(SCHEMA.replace(" string", "").replace(",", "").split())), spec, "2025-02-02", **kw)


def test_changes_are_named_by_priority(spark):
    base = ("-53", "-203", "m", "a", "n")
    prev = [(k, *base) for k in ("same", "law", "up", "down", "ar", "name", "gone")]
    prev[3] = ("down", "-53", "-205", "m", "a", "n")
    cur = [
        ("same", *base), ("law", "-197", "-205", "m", "a", "n"), ("up", "-53", "-205.0", "m", "a", "n"), ("down", "-53", "-203", "m", "a", "n"), ("ar", "-53", "-203", "m", "b", "n"),
        ("name", "-53", "-203", "m", "a", "z"), ("new", *base), (" None ", *base), ("", *base), ("dup", *base), ("dup", *base), ("two", *base), ("two", "-53", "-203", "m", "a", "other"),
    ]
    got = {r["UUID"]: r for r in compared(spark, cur, prev).collect()}
    kinds = {k: r["CHANGE_TYPE"] for k, r in got.items()}
    assert kinds == {
        "same": "UNCHANGED", "law": "UPDATED_LAW", "up": "UPDATED_RISK", "down": "UPDATED_RISK", "ar": "UPDATED_ACTOR", "name": "UPDATED", "new": "NEW",
        " None ": "KEY_MISSING", "": "KEY_MISSING", "dup": "NEW", "two": "NEW",
    }
    assert (got["up"]["CHANGE_SEVERITY"], got["down"]["CHANGE_SEVERITY"], got["new"]["CHANGE_SEVERITY"]) == ("HIGH", "MEDIUM", None)
    assert (got["law"]["CHANGED_COLUMNS"], got["law"]["CHANGED_COLUMNS_COUNT"], got["law"]["CHANGE_SUMMARY"]) == ("LAW|RISK", 2, "LAW: -53 -> -197")
    assert got["same"]["CHANGED_COLUMNS_COUNT"] == 0 and got["same"]["CHANGE_SUMMARY"] is None
    assert compared(spark, cur, prev, removed=True).filter("CHANGE_TYPE = 'REMOVED'").count() == 1


def test_a_snapshot_against_itself_is_unchanged(spark):
    rnd = random.Random(2)
    data = [(f"k{i}", *[rnd.choice(["a", "b", None, ""]) for _ in range(5)]) for i in range(60)]
    assert {r[0] for r in compared(spark, data, data).select("CHANGE_TYPE").collect()} == {"UNCHANGED"}
    assert {r[0] for r in compared(spark, data, []).select("CHANGE_TYPE").collect()} == {"NEW"}
    assert compared(spark, [], data).count() == 0


def test_older_states_are_migrated(spark):
    cur = spark.createDataFrame([("k", "-53", "-203", "m", "a", "n")], SCHEMA)
    no_hash = spark.createDataFrame([("k", "-1")], "UUID string, LAW string")
    assert rows(cdc.compare(cur, no_hash, UDI, "d"), "CHANGE_TYPE", "CHANGE_SEVERITY", "FIRST_SEEN_DATE") == [("UNCHANGED", None, "d")]
    kept = spark.createDataFrame([("k", "x", "2024-01-01", "2024-02-01"), ("k", "y", "2023-01-01", "2023-02-01")], "UUID string, ROW_HASH string, FIRST_SEEN_DATE string, LAST_SEEN_DATE string")
    assert rows(cdc.compare(cur, kept, UDI, "d"), "OLD_ROW_HASH", "FIRST_SEEN_DATE") == [("x", "2024-01-01")]
    no_key = spark.createDataFrame([("v",)], "LAW string")
    assert rows(cdc.compare(no_key, kept, UDI, "d"), "CHANGE_TYPE") == [("KEY_MISSING",)]


def test_variant_changes(spark):
    spec = CdcSpec(key=["ID"], variant=["ID", "WHO"], variant_change="UPDATED_WHO")
    cur = spark.createDataFrame([("1", "x", "n"), ("2", "x", "m")], "ID string, WHO string, N string")
    prev = spark.createDataFrame([("1", "y", "n"), ("2", "x", "n")], "ID string, WHO string, N string")
    prev = prev.withColumn("ROW_HASH", cdc.row_hash(["ID", "WHO", "N"]))
    assert rows(cdc.compare(cur, prev, spec, "d"), "ID", "CHANGE_TYPE") == [("1", "UPDATED_WHO"), ("2", "UPDATED")]


def test_event_filters(spark):
    df = spark.createDataFrame([(k,) for k in ("NEW", "UNCHANGED", "UPDATED", "UPDATED_X", "KEY_MISSING")], "CHANGE_TYPE string")
    assert cdc.events_of(df, first_run=True).count() == 2 and cdc.events_of(df, first_run=False).count() == 4
    log = spark.createDataFrame([("d1", "NEW"), ("d1", None), ("d2", "NEW"), (None, "NEW")], "EVENT_DATE string, CHANGE_TYPE string")
    assert cdc.without_events(log, ["d1"], ["NEW"]).count() == 3


# --------------------------------------------------------------------------- merges


def test_partial_merge_keeps_unseen_keys_and_duplicates(spark):
    stage = spark.createDataFrame([("1", "new", "x"), ("1", "new", "x"), (None, "s", "x")], "id string, v string, extra string")
    prev = spark.createDataFrame([("1", "old"), ("2", "old"), ("2", "old"), (None, "p")], "ID string, v string")
    out = merge.merge_snapshot(prev, stage, ["id"], complete=False)
    assert rows(out) == [(None, "s", "x"), ("1", "new", "x"), ("1", "new", "x"), ("2", "old", None), ("2", "old", None)]
    assert rows(merge.merge_snapshot(prev, stage, ["id"], complete=True)) == rows(stage)
    assert merge.merge_snapshot(prev.limit(0), stage, ["id"], complete=False).count() == 3


def test_latest_wins(spark):
    schema = "uuid string, ulid string, at string, src string"
    prev = spark.createDataFrame([("a", "1", "1", "old"), ("b", "2", "9", "old"), ("c", "1", "1", "old"), (None, "1", "1", "old")], schema)
    new = spark.createDataFrame([("a", "1", "2", "new"), ("b", "1", "99", "new"), ("c", "1", "1", "new"), ("d", None, None, "new"), (None, "1", "1", "new")], schema)
    out = merge.merge_latest_wins(prev, new, "uuid", [C("ulid"), C("at")])
    assert rows(out, "uuid", "src") == [(None, "new"), (None, "old"), ("a", "new"), ("b", "old"), ("c", "new"), ("d", "new")]
    acc = merge.merge_accounting(prev, new, "uuid").first()
    assert acc["previous_keys"] == acc["refreshed"] + acc["retained"] and acc["received_keys"] == acc["inserted"] + acc["refreshed"]


# --------------------------------------------------------------------------- versions


def test_current_versions(spark):
    data = [
        ("u1", "d1", None, "1", "Z"), ("u2", "d1", "false", "2", "A"), ("u3", "d2", "true", "1", "A"), ("u4", "d2", "TRUE", "3.0", "A"), ("u5", "d2", "no", "9", "Z"),
        ("u6", "d3", "true", "nan", None), ("u7", "d3", "true", None, None), ("u8", " None", "true", "1", "A"), (None, "d1", "true", "9", "Z"),
    ]
    df = spark.createDataFrame(data, "uuid string, dev string, latest_version string, version_number string, ulid string")
    assert rows(versions.current_versions(df, versions.identity_key(["dev"]), "uuid"), "uuid") == [("u2",), ("u4",), ("u7",)]
    assert rows(versions.current_versions(df, versions.identity_key(["dev", "uuid"]), "uuid"), "uuid") == [("u2",), ("u4",), ("u7",), ("u8",)]


@pytest.mark.parametrize("mode", versions.MODES)
def test_queue_modes(spark, mode):
    df = spark.createDataFrame([("c1", "d1", True, 2, "B"), ("h1", "d1", False, 1, "A"), ("c2", "d2", True, 1, "C"), ("h2", "d2", False, 0, "D")], "uuid string, dev string, latest_version boolean, version_number int, ulid string")
    have = spark.createDataFrame([("c1", "2025"), ("h1", "2024")], "uuid string, last string")
    got = versions.build_queue(df, have, mode, C("dev"), "uuid", "last").orderBy(*versions.queue_order(mode, "uuid"))
    current, old = ["c1", "c2"], ["h1", "h2"]
    want = {"full": ["c2", "c1", "h2", "h1"], "full_current": ["c2", "c1"], "full_historical": ["h2", "h1"], "incremental": ["c2", "h2"], "incremental_current": ["c2"], "incremental_historical": ["h2"]}[mode]
    assert [r["uuid"] for r in got.collect()] == want
    assert all(r["priority"] == (1 if r["uuid"] in current else 2) for r in got.collect()) and old


def test_queue_drain_and_resume(spark):
    q = spark.createDataFrame([("a", "pending", 0), ("b", "pending", 0), ("c", "done", 1)], "uuid string, status string, attempt_count bigint")
    res = spark.createDataFrame([("a", True, 200, None), ("b", False, 429, "busy"), ("b", False, 500, "down")], "uuid string, ok boolean, status_code int, error string")
    out = versions.apply_results(q, res, "uuid", "now")
    assert rows(out, "uuid", "status", "attempt_count", "last_error") == [("a", "done", 1, None), ("b", "failed", 2, "down"), ("c", "done", 1, None)]
    assert rows(versions.remaining(out), "uuid") == [("b",)]
    assert versions.base_mode("resume_current") == "full_current"
    with pytest.raises(ValueError):
        versions.base_mode("other")


# --------------------------------------------------------------------------- rankings, relations, coverage


def test_rankings(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 1), ("a", "y", 2), ("a", None, 3), (None, "x", 1), ("b", "y", 1), ("b", "y", 2), ("b", "x", 3)], "g string, c string, i int")
    counts = ranking.category_counts(df, "g", "c", "i")
    assert rows(ranking.top_category(counts, "g", "c"), "g", "c", "n") == [("a", "x", 1), ("b", "y", 2)]
    assert rows(ranking.top_category(counts, "g", "c", ranks={"x": 1, "y": 9}), "g", "c", "rank") == [("a", "y", 9), ("b", "y", 9)]
    assert rows(ranking.top_category(counts, "g", "c", ranks={"x": 1}, oldest=True), "g", "c") == [("a", "x"), ("b", "x")]
    top = ranking.top_entities(df.filter("g IS NOT NULL"), ["g"], 1)
    assert rows(top, "g", "n", "rank") == [("a", 4, 1)]
    zero = df.limit(0).agg(ranking.share_score(ranking.flag_sum(C("i") > 1), ranking.flag_sum(C("i") > 0)).alias("s"), ranking.flag_sum(C("i") > 0).alias("n")).first()
    assert zero["s"] is None and zero["n"] == 0
    assert rows(ranking.distribution(df, "c")) == [(None, 1), ("x", 4), ("y", 3)]


def test_previous_and_update(spark):
    cur = spark.createDataFrame([("a", 5), ("b", None), ("c", 1)], "k string, m int")
    prev = spark.createDataFrame([("a", 3), ("b", 2)], "k string, m int")
    assert rows(ranking.previous_delta(cur, prev, "k", ["m"]), "k", "m_change") == [("a", 2), ("b", None), ("c", None)]
    assert rows(ranking.previous_delta(cur, prev, "k", ["m"], null_as_zero=True), "k", "m_change") == [("a", 2), ("b", -2), ("c", 1)]
    assert rows(ranking.update_from(cur, prev, "k", ["m"])) == [("a", 3), ("b", 2), ("c", 1)]


def test_edges_and_existence(spark):
    df = spark.createDataFrame([("d1", "m", "m"), ("d2", "m", None), ("d3", "DK-x", "y")], "dev string, mf string, ar string")
    assert relations.edges(df, "dev", [("mf", "mf"), ("ar", "ar")]).count() == 4
    assert relations.edges(df, "dev", [("mf", "mf"), ("ar", "ar")], distinct=False).count() == 5
    known = spark.createDataFrame([("m",), ("m",), (None,)], "k string")
    assert rows(relations.prefix_or_known(df, ["mf", "ar"], "DK-", known, "k"), "dev") == [("d1",), ("d2",), ("d3",)]
    codes = spark.createDataFrame([("1", "b"), ("1", "a"), (None, "z")], "c string, l string")
    assert rows(relations.with_label(known, F.lit("1"), relations.code_labels(codes, "c", "l"), "c", "l", "lab"), "lab") == [("a",)] * 3


def test_coverage(spark):
    a = coverage.key_set(spark.createDataFrame([("1",), ("2",), ("2",), ("nan",), (None,)], "k string"), C("k"))
    b = coverage.key_set(spark.createDataFrame([("2",), ("3",)], "k string"), C("k"))
    r = coverage.overlap(a, b).first()
    assert (r["left_keys"], r["right_keys"], r["common_keys"], r["left_only"], r["right_only"], r["left_coverage_pct"]) == (2, 2, 1, 1, 1, 50.0)
    assert coverage.overlap(a.limit(0), b).first()["left_coverage_pct"] is None
    assert rows(coverage.samples(a, b, 1)) == [("common", "2"), ("left_only", "1"), ("right_only", "3")]
    x = spark.createDataFrame([("None", 1), ("v", None)], "A string, b int")
    y = spark.createDataFrame([("v",)], "a string")
    assert rows(coverage.compare_presence(x, y)) == [("A", 1, 1, 0)]
    assert coverage.column_sets(x.columns, y.columns) == {"common": ["A"], "left_only": ["B"], "right_only": []}
    assert coverage.choose_table({"udi": 5, "udi_audit_log": 50, "other": 99}, ["udi"]) == "udi"
    assert coverage.choose_key(["Uuid", "x"], ["UUID"], ["srn", "uuid"]) == ("Uuid", "UUID")


# --------------------------------------------------------------------------- audits


def test_pages(spark):
    r = spark.createDataFrame([(0, "a"), (0, "a"), (0, None), (1, "b"), (2, "a"), (4, "a")], "page int, k string")
    assert rows(audit.page_diagnostics(r, "page", "k"))[0] == (0, 3, 2, 1, 1, 1)
    known = spark.createDataFrame([("a",)], "k string")
    novelty = audit.page_novelty(r, known, "page", "k")
    assert rows(novelty, "page", "new_keys") == [(0, 0), (1, 1), (2, 0), (4, 0)]
    assert rows(audit.known_streaks(novelty, "page", "new_keys")) == [(0, 0, 1), (2, 2, 1), (4, 4, 1)]
    log = spark.createDataFrame([(0, 500), (0, 200), (1, 429)], "page int, status int")
    missing = audit.missing_pages(log, "page", C("status") == 200, spark.range(3).select(C("id").cast("int").alias("page")))
    assert rows(missing) == [(1,), (2,)]
    assert rows(audit.recover(r, spark.createDataFrame([(0, "z")], "page int, k string"), "page"))[0] == (0, "z")
    check = audit.crawl_audit(log, r, "page", C("status") == 200, "k", 10, 3).first()
    assert (check["ok_pages"], check["missing_pages"], check["row_difference"]) == (1, 2, -4)


def test_status_rules(spark):
    df = spark.createDataFrame([(200, "", None), (403, "Web Filter", None), (429, "", None), (503, None, None), (404, "", None), (302, "", None), (200, "", "boom")], "s int, b string, e string")
    got = [r[0] for r in df.select(audit.status_class(C("s"), C("b"), C("e"))).collect()]
    assert got == ["OK", "BLOCKED_WEB_FILTER", "RATE_LIMITED_429", "SERVER_ERROR", "CLIENT_ERROR", "UNKNOWN", "ERROR"]
    cls = df.select(audit.status_class(C("s"), C("b"), C("e")).alias("classification"))
    assert audit.endpoint_summary(cls).first()["conclusion"] == "PARTIAL_ENDPOINT_BLOCKING_FROM_RUNNER"
    assert [audit.run_status(*a) for a in ((0, True, True), (1, False, True), (1, True, True), (1, True, False))] == ["FAILED", "PARTIAL", "COMPLETE", "BOOTSTRAP"]
    assert audit.column_drift({"t": ["a", "b"]}, {"t": ["b", "c"], "u": ["x"]}) == {"t": {"added": ["c"], "removed": ["a"]}, "u": {"added": ["x"], "removed": []}}
    assert audit.table_summary({"t": df}, {"t": df, "u": df})[1]["rows_before"] is None
    bounds = audit.ulid_bounds(spark.createDataFrame([("None",), ("01B",), ("01A",)], "u string"), "u", 4).first()
    assert (bounds["min_ulid"], bounds["max_ulid"], bounds["completeness"]) == ("01A", "01B", 0.75)


# --------------------------------------------------------------------------- JSON


def test_declared_layouts(spark):
    doc = {
        "uuid": "u", "ulid": "01HK153X00AAAAAAAAAAAAAAAA", "riskClass": {"code": "", "value": "v"}, "deviceStatusType": "plain", "versionNumber": 3, "latestVersion": True, "sterile": "maybe",
        "manufacturerNames": [{"a": 1}],
    }
    df = spark.createDataFrame([(json.dumps(doc),), ("not json",), (None,)], "body string")
    out = flatten.flatten_declared(df, "body", flatten.DEVICE_LIST, flatten.DEVICE_LIST_KINDS)
    assert len(out.columns) == 36 and {"basic_udi_di_data_ulid_timestamp", "mf_or_pr_srn", "manufacturer_names_json"} <= set(out.columns)
    r = out.collect()
    assert (r[0]["risk_class_code"], r[0]["device_status_code"], r[0]["version_number"], r[0]["latest_version"], r[0]["sterile"]) == ("v", "plain", 3, True, None)
    assert r[0]["ulid_timestamp"] == "2024-01-01T00:00:00.000Z" and r[1]["uuid"] is None and r[2]["uuid"] is None
    assert len(flatten.flatten_declared(df, "body", flatten.actor_list("ownId")).columns) == 38
    assert flatten.flatten_declared(df, "body", flatten.actor_list("uuid")).first()["registry_identifier"] == "u"
    assert flatten.flatten_declared(df, "body", flatten.with_path(["uuid"], {"uuid": "riskClass"})).first()["uuid"] is not None


def test_detail_layouts(spark):
    doc = {
        "uuid": "d", "tradeName": {"texts": [{"language": {"isoCode": "da"}, "text": "dansk"}, {"language": {"isoCode": "en"}, "text": "english"}]},
        "primaryDi": {"code": "c", "issuingAgency": {"code": "GS1"}}, "marketInfoLink": {"uuid": "m", "msWhereAvailable": [{"uuid": "e1", "country": {"iso2Code": "DK"}}, {"uuid": "e2"}, {"country": {"iso2Code": "SE"}}]},
        "cndNomenclatures": [{"code": "n1", "description": {"textByDefaultLanguage": "std"}}],
    }
    df = spark.createDataFrame([(json.dumps(doc),), ("{}",)], "body string")
    r = flatten.flatten_declared(df, "body", flatten.grouped_layout(flatten.DEVICE_DETAIL_GROUPS)).collect()
    assert (r[0]["trade_name"], r[0]["primary_di_issuing_agency_code"], r[0]["primary_cnd_description"], r[0]["primary_cnd_code"]) == ("english", "GS1", "std", "n1")
    assert r[1]["trade_name"] is None
    m = flatten.market_countries(df, "body")
    assert rows(m, "device_uuid", "country_iso2") == [("d", None), ("d", "DK"), ("d", "SE")]
    actor = {"actorDataPublicView": {"uuid": "a", "ownId": "DK-1", "name": {"textByDefaultLanguage": "N"}, "country": {"iso2Code": "DK"}, "actorAddress": {"complement": "2nd"}, "regulatoryComplianceResponsibles": [{"firstName": "F", "geographicalAddress": {"country": {"name": "Denmark"}}}]}}
    a = flatten.flatten_declared(spark.createDataFrame([(json.dumps(actor),)], "body string"), "body", flatten.actor_detail("ownId")).first()
    assert a["srn"] == a["registry_identifier"] == "DK-1"
    assert (a["name"], a["country_iso2_code"], a["address_complement"], a["primary_prrc_first_name"], a["primary_prrc_country_name"]) == ("N", "DK", "2nd", "F", "Denmark")


def test_recursive_flatten_and_list_helpers(spark):
    df = spark.createDataFrame([(((1, "x"), [1, 2]),), (None,)], "top struct<a:struct<n:int,s:string>,l:array<int>>")
    out = flatten.flatten_recursive(df)
    assert out.columns == ["top.a.n", "top.a.s", "top.l", "top.l.__count"]
    assert rows(out) == [(None, None, None, None), (1, "x", "[1,2]", 2)]
    lists = spark.createDataFrame([(["a", "", None, "b"],), ([],), (None,)], "l array<string>")
    assert [tuple(r) for r in lists.select(flatten.list_size(C("l")), flatten.first_of(C("l")), flatten.joined_codes(C("l"))).collect()] == [(4, "a", "a|b"), (0, None, ""), (0, None, None)]


# --------------------------------------------------------------------------- sources

PAGES = {"x": [["r1", "r2"], ["r3"], []], "bad": [["r4"], None]}


def fixture_transport(url, params):
    """Pages of two partitions; the second one of ``bad`` always fails."""
    if "page" in params:
        pages = {0: ["a"], 1: ["b"], 2: None, 3: ["c"]}
        got = pages[params["page"]]
        return (200, json.dumps({"content": got, "totalElements": 3, "totalPages": 4}), None) if got is not None else (500, "", 0.0)
    name, _, page = (params.get("p") or url.rsplit("/", 1)[1]).partition("-")
    n = int(page or 0)
    got = PAGES[name][n]
    if got is None:
        return 503, "", 0.0
    more = n + 1 < len(PAGES[name])
    return 200, json.dumps({"value": got, "nextLink": f"http://x/{name}-{n + 1}" if more else None}), None


def test_paged_source(spark):
    spark.dataSource.register(paged.PagedSource)
    reader = spark.read.format("paged").option("transport", "tests.test_registry_operators:fixture_transport").option("url", "http://x").option("tries", 2).option("maxWait", 0)
    df = reader.option("partitions", json.dumps([{"p": "x"}, {"p": "bad"}])).load()
    assert rows(df, "label", "page", "status", "n_rows", "attempts") == [("p=bad", 0, 200, 1, 1), ("p=bad", 1, 503, 0, 2), ("p=x", 0, 200, 2, 1), ("p=x", 1, 200, 1, 1), ("p=x", 2, 200, 0, 1)]
    rolled = audit.trace_rollup(df, ["label"], "n_rows", "page", C("error").isNotNull())
    assert rows(rolled, "label", "pages", "rows_returned", "error_pages") == [("p=bad", 2, 1, 1), ("p=x", 3, 3, 0)]
    offset = spark.read.format("paged").option("transport", "tests.test_registry_operators:fixture_transport").option("url", "http://y").option("mode", "offset").option("tries", 1)
    assert rows(offset.option("pages", 4).option("pagesPerPartition", 3).load(), "page", "error") == [(0, None), (1, None), (2, "status 500"), (3, None)]
    assert rows(offset.option("pages", 4).option("onlyPages", "[3]").load(), "page") == [(3,)]
    assert paged.discover(fixture_transport, "http://y")["total_pages"] == 4


def test_retry_and_limits():
    waits, answers = [], iter([(429, "", 7.0), (500, "", None), (200, "ok", None)])
    got = paged.fetch(lambda u, p: next(answers), "u", {}, paged.RetryPolicy(5), waits.append)
    assert (got.status, got.attempts, waits) == (200, 3, [7.0, 4.0])
    assert paged.fetch(lambda u, p: (404, "", None), "u", {}, paged.RetryPolicy(5), waits.append).attempts == 1

    def broken(u, p):
        raise OSError("no route")

    assert paged.fetch(broken, "u", {}, paged.RetryPolicy(2), lambda s: None).error == "OSError: no route"
    now, slept = [0.0], []
    limiter = paged.RateLimiter(2.0, lambda: now[0], slept.append)
    limiter.wait(), limiter.wait(), limiter.wait()
    assert slept == [0.5, 1.0]


def test_partition_plan():
    config = {
        "combinations": [{"parameters": ["r", "l"], "pairs": [[1, 2], [1, None], [1, 2]]}, {"active": False, "parameters": ["r", "l"], "pairs": [[3, 4]]}],
        "parameters": {"r": [{"value": 1}, {"value": 3}, {"value": 5, "active": False}], "l": [{"value": 2}, {"value": 4}]},
    }
    assert paged.plan_partitions(config) == [{"r": 1, "l": 2}, {"r": 3}, {"l": 4}]
    gap = {"combinations": [{"parameters": ["r", "l"], "pairs": [[1, 2], [3, 4]]}], "parameters": config["parameters"]}
    assert paged.plan_partitions(gap, residual=True)[2:] == [{"l": 2, "r": 3}, {"l": 4, "r": 1}]
    assert paged.plan_partitions({}) == []


def test_snapshot_store(spark):
    store = snapshots.SnapshotStore(spark, scratch_path(spark, "store"))
    assert store.latest() is None and store.read("t") is None and store.metadata() == {}
    assert store.commit("v1", {"t": spark.range(3)}, "COMPLETE", {"note": "x"})
    assert not store.commit("v2", {"t": spark.range(9)}, "FAILED")
    assert store.latest() == "v1" and store.read("t").count() == 3 and store.metadata()["note"] == "x"
    store.commit("v3", {"t": store.read("t").unionAll(spark.range(1))}, "PARTIAL")
    assert store.read("t").count() == 4 and store.read("t", "v1").count() == 3
    store.append("log", spark.createDataFrame([("1",)], "a string"))
    store.append("log", spark.createDataFrame([("1", "2")], "a string, b string"))
    assert rows(store.read_log("log"), "a", "b") == [("1", None), ("1", "2")] and store.read_log("none") is None
    assert rows(snapshots.all_text(spark.createDataFrame([(1, None)], "a int, b string"), "None")) == [("1", "None")]


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 'q"x', "{}")], "x string, y string, j string")
    exports.write_csv(df, f"{tmp_path}/csv", single=True, drop=["j"])
    back = spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/csv")
    assert rows(back) == [("a,b", 'q"x')]
    assert exports.zip_dirs(f"{tmp_path}/out.zip", {"t.csv": f"{tmp_path}/csv", "no.csv": f"{tmp_path}/none"}) == ["no.csv"]
    exports.write_json_lines(df, f"{tmp_path}/json")
    assert rows(spark.read.json(f"{tmp_path}/json"), "x") == [("a,b",)]
    exports.summary_json(f"{tmp_path}/s.json", {"b": 1, "a": 2})
    assert exports.read_sidecar(f"{tmp_path}/s.json") == {"a": 2, "b": 1} and exports.read_sidecar(f"{tmp_path}/none") == {}
    text = exports.markdown_report("T", {"status": "COMPLETE"}, {"rows": df})
    assert "- **status:** COMPLETE" in text and "| a,b | q\"x | {} |" in text
    assert exports.human_duration(3725) == "1h 2m 5s" and exports.human_bytes(2048) == "2.0 KB"


def test_stream_is_the_batch_merge_and_is_idempotent(spark):
    schema = "k string, ulid string, v string"
    source = scratch_path(spark, "in")
    a = spark.createDataFrame([("a", "1", "x"), ("b", "1", "x")], schema)
    b = spark.createDataFrame([("a", "2", "y"), (None, "1", "n")], schema)
    a.coalesce(1).write.parquet(source)
    state = MergedState(spark, scratch_path(spark, "state"), "k", [C("ulid")])
    assert rows(state.run(source, a.schema)) == [("a", "1", "x"), ("b", "1", "x")]
    b.coalesce(1).write.mode("append").parquet(source)
    want = rows(merge.merge_latest_wins(a, b, "k", [C("ulid")]))
    assert rows(state.run(source, a.schema)) == want
    state.apply(b, state.version())  # delivered again
    assert rows(state.current()) == want


def test_columns_by_synonym(spark, tmp_path):
    from snapledger.operators import columns

    df = spark.createDataFrame([("1", "n", None, "x")], "Uuid string, deviceName string, new string, old string")
    out = columns.canonical(df, {"uuid": [], "name": ["device_name", "DEVICENAME"], "n": []}, {"uuid": "bigint", "n": "bigint"})
    assert rows(out) == [(1, "n", None)] and out.columns == ["uuid", "name", "n"]
    assert columns.first_existing(df, ["zzz", "NEW"]) == "new"
    assert rows(columns.coalesce_legacy(df, {"new": "old", "title": "deviceName"})) == [("1", "x", "n")]
    df.write.parquet(f"{tmp_path}/b.parquet")
    assert columns.read_first(spark, str(tmp_path), ["a", "b"], ["new", "none"]).columns == ["new"]
    assert columns.read_first(spark, str(tmp_path), ["a"]) is None
    assert columns.copy_tables(spark, str(tmp_path), f"{tmp_path}/out", ["b", "c"]) == {"b": "copied", "c": "missing"}
    assert df.select(columns.json_digest(df, ["old", "Uuid"])).first()[0] == df.select(columns.json_digest(df, ["Uuid", "old"])).first()[0]


# --------------------------------------------------------------------------- runs


def test_crawl_stops_and_is_taken_up_again(spark, monkeypatch, tmp_path):
    from snapledger.sources import crawl, paged

    spark.dataSource.register(paged.PagedSource)
    options = {"transport": "snapledger.sources.loopback:serve", "url": "loop://offset/100/10"}
    first = crawl.crawl(spark, options, 10, "full", stretch=3, caps=paged.Caps(records=5))
    assert first.state == {"mode": "full", "first_page": 0, "next_page": 6, "total_pages": 10, "finished": False, "stopped_by": "records"}
    rest = crawl.crawl(spark, options, 10, "resume_full", state=first.state, stretch=4)
    assert rest.state["first_page"] == 5 and rest.state["finished"] and rest.state["stopped_by"] is None
    assert sorted({r["page"] for r in first.pages.collect()} | {r["page"] for r in rest.pages.collect()}) == list(range(10))
    assert [crawl.resume_page(s, "full") for s in (None, {}, {**first.state, "mode": "incremental"}, {**first.state, "finished": True}, {"mode": "x", "finished": False, "next_page": 3})] == [0] * 5
    # a page that fails for good ends the crawl before it
    bad = crawl.crawl(spark, {"transport": "snapledger.sources.loopback:serve", "url": "loop://key/7", "tries": "1"}, 4, "full", stretch=2)
    assert bad.state["next_page"] == 0 and bad.state["stopped_by"] == "failed" and bad.pages.count() == 0


def test_lookups_keep_to_their_caps_and_lose_no_key(spark):
    from snapledger.sources import paged

    keys = spark.createDataFrame([(i,) for i in range(1, 41)] + [(1,), (None,)], "k int")
    ask = lambda **kw: paged.lookup(keys, "k", "snapledger.sources.loopback:serve", "loop://key/{key}", **kw)
    got = {r["key"]: r for r in ask().collect()}
    assert len(got) == 40 and got["7"]["error"] == "status 404" and got["8"]["body"] == '{"key": 8, "square": 64}'
    capped = ask(parallel=2, caps=paged.Caps(records=10)).collect()
    assert len(capped) == 40 and sum(r["status"] is not None for r in capped) == 10
    assert {r["error"] for r in capped if r["status"] is None} == {"not asked: records"}
    failures = ask(parallel=1, caps=paged.Caps(failures=2)).collect()
    assert sum(r["error"] == "status 404" for r in failures) == 2 and len(failures) == 40
    assert ask(parallel=1).count() == 40 and paged.lookup(keys.limit(0), "k", "snapledger.sources.loopback:serve", "loop://key/{key}").count() == 0


def test_results_of_a_capped_drain_leave_the_rest_pending(spark):
    from snapledger.sources import paged

    queue = spark.createDataFrame([(str(i), "pending", 0) for i in range(1, 21)], "k string, status string, attempt_count bigint")
    got = paged.lookup(versions.remaining(queue), "k", "snapledger.sources.loopback:serve", "loop://key/{key}", parallel=1, caps=paged.Caps(records=8)).filter("status IS NOT NULL")
    after = versions.apply_results(queue, got.select(C("key").alias("k"), C("error").isNull().alias("ok"), C("status").alias("status_code"), "error"), "k", "now").collect()
    assert sum(r["status"] == "pending" for r in after) == 12 and {r["status"] for r in after} <= {"pending", "done", "failed"}


def test_a_refusal_is_not_asked_again():
    from snapledger.sources import paged

    asked = []
    got = paged.fetch(lambda u, p: asked.append(u) or (503, "<h1>Access Denied</h1>", None), "u", {}, paged.RetryPolicy(5), lambda s: None)
    assert got.error == "refused" and len(asked) == 1


def test_runs_leave_what_their_status_says(spark, tmp_path):
    from snapledger.sources.crawl import finish_run
    from snapledger.sources.snapshots import SnapshotStore

    store = SnapshotStore(spark, f"file://{tmp_path}/runs")
    frame = lambda data: spark.createDataFrame(data, "k string, v int")
    run = lambda version, data, **kw: finish_run(store, version, "t", frame(data) if data is not None else None, ["k"], **kw)
    assert run("v0", None, usable_pages=0, finished=False) == "FAILED" and store.latest() is None
    assert run("v1", [("a", 1), ("b", 1)], usable_pages=2, finished=True) == "BOOTSTRAP"
    assert run("v2", [("a", 2)], usable_pages=1, finished=False) == "PARTIAL" and rows(store.read("t")) == [("a", 2), ("b", 1)]
    assert run("v3", None, usable_pages=0, finished=False) == "FAILED" and store.latest() == "v2"
    assert run("v4", [("c", 3)], usable_pages=1, finished=True) == "COMPLETE" and rows(store.read("t")) == [("c", 3)]
    assert store.vacuum(keep=2) == ["v1"] and store.vacuum(keep=2) == [] and rows(store.read("t", "v2")) == [("a", 2), ("b", 1)]
    assert store.vacuum(keep=0) == ["v2"] and rows(store.read("t")) == [("c", 3)]


def test_marts_come_as_one_version(spark, tmp_path):
    from snapledger.plans import marts
    from snapledger.sources.snapshots import SnapshotStore
    from tests.conftest import SMALL

    store = SnapshotStore(spark, f"file://{tmp_path}/marts")
    assert marts.build_marts(spark, SMALL, store, "m1") == ["actors", "change_events", "devices", "events", "profiles", "risk_distribution"]
    assert store.read("actors").count() == marts.actor_mart(spark, SMALL).count()


def test_newest_file_and_row_samples(spark, tmp_path):
    import os

    from snapledger.sources.tables import newest_path

    for i, name in enumerate(("b.csv", "a.csv", "c.txt")):
        (tmp_path / name).write_text("x")
        os.utime(tmp_path / name, (1000 + i, 1000 + i))
    assert newest_path(spark, f"file://{tmp_path}", "*.csv").endswith("/a.csv") and newest_path(spark, f"file://{tmp_path}/none") is None
    df = spark.createDataFrame([(3,), (1,), (2,)], "n int")
    assert [[r[0] for r in coverage.sample_rows(df, ["n"], n).collect()] for n in (0, -1, 2)] == [[], [1, 2, 3], [1, 2]]


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from snapledger.sources import tables

    class Fake:
        class conf:
            get = staticmethod(lambda k, default=None: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError):
        tables.shared_dir(Fake)


def test_frontier_of_nothing_known_lets_all_pass(spark):
    df = spark.createDataFrame([("01b",), ("01A",), (None,)], "ulid string")
    assert rows(audit.beyond_frontier(df, df.filter("ulid = '01A'"), "ulid")) == [("01b",)]
    assert audit.beyond_frontier(df, df.limit(0), "ulid").count() == 3
