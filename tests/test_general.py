"""The general data problems on hand-made rows: dirt, ties, hot keys, empty tables, clashing columns."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.conftest import rows

from pyspark.sql import functions as F
from snapledger.operators import copy_diff, drift, orphans, profile, satellites, snapshot_diff
from snapledger.operators.snapshot_diff import History, SnapshotIndex, snapshot_rows
from snapledger.sources.tables import scratch_path

C = F.col


# --------------------------------------------------------------------------- references


def problems(spark, refs, parents, **kw):
    r = spark.createDataFrame(refs, "k string, d string")
    p = spark.createDataFrame(parents, "k string, a string, z string, ref_key string")
    return orphans.reference_problems(r, p, ref_key=C("k"), ref_day=C("d"), parent_key=C("k"), parent_first=C("a"), parent_last=C("z"), **kw)


def test_kinds_of_broken_references(spark):
    parents = [("p", "2025-01-02", "2025-01-05", "clash"), ("p", "2025-01-03", "2025-01-04", None), ("open", None, None, None), (None, "2025-01-01", None, None)]
    refs = [("p", "2025-01-01"), ("p", "2025-01-02"), ("p", "2025-01-05"), ("p", "2025-01-06"), ("q", "2025-01-01"), ("q", "2025-01-01"), ("q", None), ("open", "1999-01-01"), (None, "2025-01-01")]
    got = rows(problems(spark, refs, parents))
    assert got == [("p", "2025-01-01", "late", 1), ("p", "2025-01-06", "deleted", 1), ("q", None, "missing", 1), ("q", "2025-01-01", "missing", 2)]


def test_hot_key_is_split_off_and_counted_whole(spark):
    refs = [("hot", f"2025-01-{i % 28 + 1:02d}") for i in range(600)] + [(f"k{i}", "2025-01-01") for i in range(300)]
    parents = [("hot", "2025-01-10", None, None)] + [(f"k{i}", "2025-01-01", None, None) for i in range(0, 300, 2)]
    for share in (0.01, 1.0):
        got = problems(spark, refs, parents, heavy_share=share)
        assert got.filter("kind = 'late'").agg(F.sum("n_refs")).first()[0] == sum(i % 28 + 1 < 10 for i in range(600))
        assert got.filter("kind = 'missing'").count() == 150


def test_references_of_empty_tables(spark):
    assert problems(spark, [], [("p", "2025-01-01", None, None)]).count() == 0
    assert rows(problems(spark, [("a", "2025-01-01")], []), "ref_key", "kind") == [("a", "missing")]


def test_heavy_keys_are_bounded(spark):
    df = spark.createDataFrame([(f"k{i % 7}", 1) for i in range(700)], "k string, w int")
    assert len(orphans.heavy_keys(df, "k", "w", 0.1)) == 7
    assert orphans.heavy_keys(df, "k", "w", 0.5) == []
    with pytest.raises(ValueError):
        orphans.heavy_keys(df, "k", "w", 0)


# --------------------------------------------------------------------------- quality


def inventory(spark, series, feed="m", table="t", others=3, totals=None):
    """series: filled share by load; further fields are always full."""
    out = []
    for load, share in enumerate(series, 1):
        tot = (totals or {}).get(load, 4000)
        out.append((feed, load, table, "f", round(share * tot) if share is not None else None, tot))
        out += [(feed, load, table, f"g{i}", tot, tot) for i in range(others)]
    return spark.createDataFrame(out, "feed string, load_no bigint, table_name string, field_name string, non_null_rows bigint, total_rows bigint")


def broken(df):
    return rows(profile.quality_breaks(df), "load_no", "field_name", "reason")


@pytest.mark.parametrize(
    ("series", "cases"),
    [
        ([0.8, 0.81, 0.79, 0.4, 0.8, 0.81], [4]),  # one load off, then back
        ([0.8, 0.81, 0.79, 0.68, 0.69, 0.68], [4]),  # a lasting shift is one case
        ([0.8, 0.81, 0.79, 0.68, 0.69, 0.68, 0.8], [4]),  # and the return is none
        ([1.0, 1.0, 1.0, 0.0, 1.0, 0.6, 1.0], [4, 6]),
        ([0.8, 0.81, None, 0.79, 0.8], []),  # a missing count
        ([0.5, 0.51, 0.49, 0.52, 0.5, 0.51], []),
        ([0.3], []),
    ],
)
def test_share_breaks(spark, series, cases):
    assert broken(inventory(spark, series)) == [(n, "f", "share") for n in cases]


def test_small_loads_and_growth_are_no_breaks(spark):
    assert broken(inventory(spark, [0.8, 0.8, 0.6, 0.8], totals={3: 15})) == []
    assert broken(inventory(spark, [0.8, 0.8, 0.8, 0.8], totals={2: 8000, 3: 16000, 4: 32000})) == []
    # but what is beyond chance even there counts
    assert broken(inventory(spark, [1.0, 1.0, 0.0, 1.0], totals={3: 40})) == [(3, "f", "share")]


def test_one_rule_for_loads_of_any_size(spark):
    # around a tenth of the usual size nothing jumps: the same break shows as soon as its rows suffice
    got = [bool(broken(inventory(spark, [0.8, 0.8, 0.8, 0.4, 0.8], totals={4: n}))) for n in (5, 20, 100, 390, 400, 410, 4000)]
    assert got == sorted(got) and got[3] == got[4] == got[5] is True and not got[0]


def test_logistic_regression_finds_the_odds():
    from math import log

    a, b = profile.fit_logistic((0.2, 0.6), ridge=0.0)
    assert abs(a - log(0.4 / 0.8)) < 1e-4 and abs(b - log(0.6 * 0.8 / (0.4 * 0.2))) < 1e-4
    for shares in ((0.0, 1.0), (1.0, 0.0), (0.5, 0.5), (0.0, 0.0), (1.0, 0.999)):
        a, b = profile.fit_logistic(shares)
        assert abs(a) < 100 and (b > 0) == (shares[1] > shares[0])
    auc, gain = profile.two_sample(0.3, (0.8, 0.8))
    assert abs(auc - 0.75) < 1e-9 and gain > 0.1
    # folds that pull to either side of the load tell nothing about it
    auc, gain = profile.two_sample(0.5, (0.8, 0.2))
    assert auc < 0.5 and gain < 0


def test_breaks_against_brute_force(spark):
    """The same rule over all levels of a field instead of the nearest ones."""
    rnd = random.Random(7)
    data, want = [], set()
    for f in range(60):
        level, levels = rnd.choice([0.5, 0.9, 1.0]), []
        known = profile._Field(0.009, 3.0)
        for load in range(1, 12):
            if rnd.random() < 0.15:
                level = rnd.choice([0.0, 0.3, 0.7, 1.0])
            tot = rnd.choice([40, 900, 5000])
            nn = sum(rnd.random() < level for _ in range(tot))
            data.append(("m", load, "t", f"f{f}", nn, tot))
            best = min(((known.compare(nn, tot, x), x) for x in known.levels), key=lambda c: (c[0][0], -c[1].loads), default=None)
            if best is not None and best[0][0] <= 2.5:
                known.join(nn, tot, best[1])
                continue
            if best is not None and best[0][0] >= 6.0 and best[0][2] > 0:
                want.add((load, f"f{f}"))
            known.begin(nn, tot)
    rnd.shuffle(data)
    df = spark.createDataFrame(data, "feed string, load_no bigint, table_name string, field_name string, nn bigint, tot bigint")
    assert {(r["load_no"], r["field_name"]) for r in profile.fill_breaks(df).collect()} == want and len(want) > 20


def test_contradictions(spark):
    df = inventory(spark, [0.8, 0.8, 0.8])
    more = spark.createDataFrame(
        [("m", 1, " T ", "H ", 5000, 4000), ("m", 2, "t", "h", -3, 4000), ("m", 3, "t", "h", 10, 3999), ("m", 3, "t", "i", None, None), ("m", 3, None, "x", 1, 1), ("m", 3, "t", "h", 10, 3999)], df.schema
    )
    assert broken(df.unionByName(more)) == [(1, "h", "contradiction"), (2, "h", "contradiction"), (3, "h", "contradiction")]
    # of rows that disagree one stands whole: no count is put together from two of them
    assert rows(profile.inventory_fields(spark.createDataFrame([("m", 1, "t", "a", 9, 10), ("m", 1, "t", "a", 3, 12)], df.schema)), "nn", "tot") == [(3, 12)]
    two = spark.createDataFrame([("m", 1, "t", "a", 1, 10), ("m", 1, "t", "b", 1, 11)], df.schema)
    assert broken(two) == []  # nobody is accused
    assert broken(df.limit(0)) == []


def test_base_profile_is_exact_and_knows_patterns(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (" None", 3), ("bb", 1), (None, 1)], "s string, `weird.name` int")
    got = {r["column_name"]: r for r in profile.base_profile(df, patterns={"s": "^[a-z]$"}).collect()}
    s = got["s"]
    assert (s["total_rows"], s["non_null_rows"], s["distinct_values"], s["min_value"], s["max_value"], s["pattern_violations"], s["null_rate"]) == (5, 3, 2, "a", "bb", 1, 0.4)
    assert got["weird.name"]["pattern_violations"] is None
    empty = profile.base_profile(df.limit(0)).collect()
    assert len(empty) == 2 and all(r["total_rows"] == 0 and r["null_rate"] == 0.0 for r in empty)


def test_classifier_names_the_column_that_moved(spark):
    rnd = random.Random(1)
    old = [(rnd.choice("abc"), rnd.choice("xyz"), str(rnd.randint(0, 9))) for _ in range(1500)]
    new = [(rnd.choice("abc"), rnd.choice("xxy"), str(rnd.randint(0, 9))) for _ in range(1500)]
    schema = "p string, q string, r string"
    got = {r["column_name"]: r for r in profile.load_shift(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema), ["p", "q", "r"], buckets=16).collect()}
    assert got["q"]["auc"] > 0.6 and got["q"]["ablation"] > 0.08
    assert abs(got["p"]["ablation"]) < 0.03 and abs(got["r"]["ablation"]) < 0.03
    assert profile.load_shift(spark.createDataFrame([], schema), spark.createDataFrame(new, schema), ["p"]).count() == 0


def test_every_column_of_the_change_log_is_profiled(spark):
    from snapledger.plans import general
    from tests.conftest import SMALL

    got = {r["column_name"]: r["pattern_violations"] for r in general.QUERIES["p2_profile"](spark, SMALL).collect()}
    assert set(got) == set(spark.read.parquet(f"{SMALL}/udi_change_events.parquet").columns) and len(got) == 33
    assert {c for c, n in got.items() if n is not None} == set(general._PROFILED)


def test_load_shift_query_sees_breaks_of_middle_snapshots(spark, tmp_path):
    from snapledger.plans import general

    rnd = random.Random(2)
    fields = list(general._EVENT_VALUES)
    data = []
    for day in ("2025-01-01", "2025-02-01", "2025-03-01"):
        for i in range(500):
            # in the middle snapshot only, names lose most of their values
            name = rnd.choice("abcdef") if day != "2025-02-01" or i % 5 == 0 else None
            data.append((day, None, *[name if c == "DEVICE_NAME" else str(rnd.randint(1, 4)) for c in fields]))
    data += [(None, None, *["x"] * len(fields))] * 3  # of no snapshot
    schema = ", ".join(f"{c} string" for c in ("CURRENT_EXTRACT_DATE", "CURRENT_EXTRACT_DATETIME_UTC", *fields))
    spark.createDataFrame(data, schema).write.parquet(str(tmp_path / "udi_change_events.parquet"))
    got = general.p2_load_shift(spark, str(tmp_path)).collect()
    assert {(r["load"], r["prev_load"]) for r in got} == {("2025-02-01", "2025-01-01"), ("2025-03-01", "2025-02-01")}
    assert len(got) == 2 * len(fields) and {r["column_name"] for r in got} == set(fields)
    for r in got:
        assert r["auc"] > 0.8
        assert r["ablation"] > 0.2 if r["column_name"] == "DEVICE_NAME" else abs(r["ablation"]) < 0.1


def test_load_shift_query_tests_every_column(spark, tmp_path):
    from snapledger.plans import general

    rnd = random.Random(3)
    days = ["2025-01-01", "2025-02-01", "2025-03-01"]  # 31 and 28 days apart
    data = []
    for at, day in enumerate(days):
        for i in range(400):
            uuid, ids = f"{i:08x}-0000-0000-0000-000000000000", [str(-rnd.randint(1, 4)) for _ in range(4)]
            was = [str(-rnd.randint(1, 4)) for _ in ids] if at else [None] * 4
            late, gone = at == 2 and i % 10 > 1, at == 2 and i % 10 > 2
            row = {c: rnd.choice("abcd") for c in general._EVENT_COLUMNS}
            row |= dict.fromkeys(("BUSINESS_KEY", "ENTITY_VARIANT_KEY"), f"UUID=|{uuid}") | {"UUID": uuid, "ROW_HASH": f"h{i}"}
            row |= dict.fromkeys(("CURRENT_EXTRACT_DATE", "EVENT_DATE"), day)
            row |= dict.fromkeys(("CURRENT_EXTRACT_DATETIME_UTC", "EVENT_DATETIME_UTC"), f"{day} 04:{rnd.randint(10, 59)}:00 UTC")
            row |= {c: days[at - 1] if at else None for c in ("PREVIOUS_EXTRACT_DATE", "PREVIOUS_EXTRACT_DATETIME_UTC")}
            row |= {"OLD_ROW_HASH": f"h{i}" if at else None, "OLD_ENTITY_VARIANT_KEY": f"UUID=|{uuid}" if at else None}
            for k, kind in enumerate(("RISK_CLASS_ID", "LEGISLATION_ID", "STATUS_ID", "DEVICE_STATUS_TYPE_ID")):
                row |= {f"OLD_{kind}": was[k], f"NEW_{kind}": ids[k]}
            # only in the last snapshot: event days that are late, former states that are lost
            row |= ({"EVENT_DATE": "2025-03-11"} if late else {}) | ({"OLD_STATUS_ID": None} if gone else {})
            data.append(tuple(row[c] for c in general._EVENT_COLUMNS))
    schema = ", ".join(f"{c} string" for c in general._EVENT_COLUMNS)
    spark.createDataFrame(data, schema).write.parquet(str(tmp_path / "udi_change_events.parquet"))
    got = {(r["load"], r["column_name"]): r for r in general.p2_load_shift(spark, str(tmp_path)).collect()}
    tested = set(general._EVENT_COLUMNS) - {"CURRENT_EXTRACT_DATE", "CURRENT_EXTRACT_DATETIME_UTC"}
    assert set(got) == {(day, c) for day in days[1:] for c in tested} and len(tested) == 31
    for c in tested:
        r = got[days[2], c]
        assert r["ablation"] > 0.2 if c in ("EVENT_DATE", "OLD_STATUS_ID") else abs(r["ablation"]) < 0.1, r
    # that dates move on with the snapshots, by steps of any length, tells nothing
    assert abs(got[days[1], "EVENT_DATE"]["auc"] - 0.5) < 0.1 and got[days[2], "PREVIOUS_EXTRACT_DATE"]["ablation"] == 0
    # the first snapshot has no former states; only the model of those columns sees it
    assert got[days[1], "OLD_STATUS_ID"]["auc"] > 0.95 and abs(got[days[1], "STATUS_ID"]["auc"] - 0.5) < 0.1


def test_a_unit_stays_in_one_fold(spark):
    # the same keys at other times: nothing moved, and no old row may speak against its new one
    rnd = random.Random(4)
    data = [(at, f"k{i}", str(rnd.random())) for at in (1, 2) for i in range(1500)]
    df = spark.createDataFrame(data, "load int, k string, noise string")
    free, held = (profile.load_shifts(df, "load", ["k", "noise"], unit=u).first()["auc"] for u in (None, "k"))
    assert abs(held - 0.5) < 0.05 and free < 0.47, (free, held)


# --------------------------------------------------------------------------- histories


def observed(spark, data):
    return spark.createDataFrame(data, "entity_key string, version_key string, day string, first_seen string")


def history(spark, *batches, **kw):
    """What the satellite's view shows once the batches have been appended in turn."""
    satellite = satellites.Satellite(spark, scratch_path(spark, "satellite"), **kw)
    for data in batches:
        satellite.append(data if kw else observed(spark, data))
    return rows(satellite.history())


def test_history_rules(spark):
    data = [
        ("e", "A", "2025-01-05", "2025-01-01"), ("e", "A", "2025-01-10", "2025-01-20"),  # first_seen after its row's day does not count
        ("e", "B", "2025-01-20", "2025-01-09"), ("e", "B", "2025-01-25", "2025-01-12"),  # not after A's last day; then one that is
        ("e", "A", "2025-02-01", "2025-01-01"),  # a return is a new version
        ("e", "A", "2025-02-01", "2025-01-01"), (None, "A", "2025-02-01", None), ("e", None, "2025-02-02", None), ("e", "A", None, None),
    ]
    assert history(spark, data) == [("e", "A", "2025-01-01", "2025-01-12"), ("e", "A", "2025-02-01", ""), ("e", "B", "2025-01-12", "2025-02-01")]
    assert history(spark, []) == []


def brute_history(data):
    out = []
    for e in sorted({d[0] for d in data}):
        seen = sorted({(d, v) for k, v, d, _ in data if k == e})
        runs = []
        for d, v in seen:
            if runs and runs[-1][0] == v:
                runs[-1][1].append(d)
            else:
                runs.append([v, [d]])
        starts = []
        for i, (v, days) in enumerate(runs):
            before = runs[i - 1][1][-1] if i else None
            firsts = [f for k, w, d, f in data if k == e and w == v and d in days and f and f <= d and (before is None or f > before)]
            starts.append(min([days[0], *firsts]))
        out += [(e, v, starts[i], starts[i + 1] if i + 1 < len(runs) else "") for i, (v, _) in enumerate(runs)]
    return sorted(out)


def test_batches_in_any_order_give_the_same_history(spark):
    """Late rows split, begin, join and void rows that are stored already."""
    rnd = random.Random(14)
    picked = {}
    for e in range(80):
        for day in rnd.sample(range(1, 21), rnd.randint(1, 9)):
            first = rnd.randint(0, 22)
            picked[e, day] = ((f"e{e:02d}", rnd.choice("AB"), f"2025-01-{day:02d}", f"2025-01-{first:02d}" if first else None), rnd.randint(0, 2))
    batches = [[r for r, n in picked.values() if n == k] for k in range(3)]
    want = brute_history([r for r, _ in picked.values()])
    assert len(satellites.hot_entities(observed(spark, sum(batches, [])), "entity_key")) > 20  # so both ways are taken
    assert history(spark, *batches) == want == history(spark, [], sum(batches, []))


def test_satellite_appends_only_changes(spark):
    satellite = satellites.Satellite(spark, scratch_path(spark, "satellite"))
    first = [("e", "A", "2025-01-01", None), ("e", "A", "2025-01-03", None), ("e", "B", "2025-01-05", None)]
    satellite.append(observed(spark, first))
    assert satellite._table("rows").count() == 2
    second = [("e", "B", "2025-01-08", None), ("e", "C", "2025-01-09", None), ("n", "A", "2025-01-09", None)]
    for _ in range(2):  # the second time changes nothing
        satellite.append(observed(spark, second))
        assert satellite._table("rows").count() == 4 and satellite._table("seen").count() == 6
    want = [("e", "A", "2025-01-01", "2025-01-05"), ("e", "B", "2025-01-05", "2025-01-09"), ("e", "C", "2025-01-09", ""), ("n", "A", "2025-01-09", "")]
    assert rows(satellite.history()) == want
    # a late state splits A; an earlier first day begins it sooner and makes the stored beginning void
    satellite.append(observed(spark, [("e", "X", "2025-01-02", None), ("e", "A", "2024-12-31", "2024-12-30")]))
    assert rows(satellite.history())[:4] == [("e", "A", "2024-12-30", "2025-01-02"), ("e", "A", "2025-01-03", "2025-01-05"), *want[1:2], want[2]]
    stored = satellite._table("rows")
    assert stored.count() == 8 and stored.filter("valid_from IS NULL").count() == 1 and satellite.rows().count() == 6
    satellite.append(observed(spark, []))
    assert satellite.rows().count() == 6


def test_a_failed_batch_can_be_appended_again(spark):
    satellite = satellites.Satellite(spark, scratch_path(spark, "satellite"))
    satellite.append(observed(spark, [("e", "A", "2025-01-01", None)]))
    late = [("e", "B", "2025-01-05", None)]
    # as if the job had been lost between the two tables
    valid = observed(spark, late).withColumn("hash_diff", F.unhex(satellites.hash_diff(["version_key"])))
    valid.select(*satellite.key, F.lit("").alias("first_seen")).write.mode("append").parquet(f"{satellite.path}/seen")
    satellite.append(observed(spark, late))
    assert rows(satellite.history()) == [("e", "A", "2025-01-01", "2025-01-05"), ("e", "B", "2025-01-05", "")]


def test_attributes_of_a_group_share_rows(spark):
    schema = "entity_key string, version_key string, day string, first_seen string, n int"
    data = [("e", "A", "2025-01-02", "2025-01-01", 1), ("e", "A", "2025-01-03", None, 2), ("e", "A", "2025-01-04", None, None), ("e", "B", "2025-01-05", None, None)]
    satellite = satellites.Satellite(spark, scratch_path(spark, "satellite"), attributes=["n"])
    satellite.append(spark.createDataFrame(data, schema))
    assert satellite.rows().count() == 4
    assert rows(satellite.history()) == [("e", "A", "2025-01-01", "2025-01-05"), ("e", "B", "2025-01-05", "")]


def test_neighbours_across_stretches(spark):
    rnd = random.Random(2)
    data = list(dict.fromkeys((rnd.choice("efgh"), rnd.choice([None, 1, 2, 3]), rnd.randint(0, 50)) for _ in range(120)))
    df = spark.createDataFrame(data, "k string, c int, n int")
    order = sorted(data, key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
    want = []
    for e, c, n in order:
        mine = [r for r in order if r[0] == e]
        at = mine.index((e, c, n))
        want.append((e, c, n, mine[at - 1][2] if at else None, mine[at + 1][2] if at + 1 < len(mine) else None))
    for hot in ([], ["e", "g"], ["e", "f", "g", "h"]):
        got = satellites.neighbour(df, "k", "c", ["c", "n"], F.struct("n"), "p", hot=hot)
        got = satellites.neighbour(got, "k", "c", ["c", "n"], F.struct("n"), "q", ahead=True, hot=hot)
        assert rows(got.select("k", "c", "n", "p.n", "q.n")) == rows(spark.createDataFrame(want, "k string, c int, n int, p int, q int"))


def test_split_by_change_rate(spark):
    df = spark.createDataFrame([("e", i, "same", str(i), None) for i in range(6)], "k string, n int, slow string, fast string, empty string")
    rates = satellites.change_rates(df, "k", ["n"], ["slow", "fast", "empty"])
    assert satellites.split_by_rate(rates) == {"slow": ["empty", "slow"], "fast": ["fast"]}
    assert satellites.split_by_rate(satellites.change_rates(df.limit(0), "k", ["n"], ["slow"])) == {"slow": ["slow"], "fast": []}


# --------------------------------------------------------------------------- snapshots


SNAPSHOTS = [
    ("d1", "same", "1", "x", "claim"), ("d1", "gone", "1", "x", ""), ("d1", "chg", "1", "x", ""), ("d1", "chg", "2", "y", ""), ("d1", "back", "1", None, ""),
    ("d2", "same", "1", "x", "other"), ("d2", "chg", "1", "z", ""), ("d2", "new", "1", "x", ""), ("d2", None, "1", "x", ""), (None, "k", "1", "x", ""),
    ("d3", "same", "1", "x", ""), ("d3", "chg", "1", "z", ""), ("d3", "new", "1", None, ""), ("d3", "back", "1", None, ""), ("d3", "back", "1", None, ""),
]
CHANGED = [("d2", "back", "removed"), ("d2", "chg", "changed"), ("d2", "gone", "removed"), ("d2", "new", "added"), ("d3", "back", "added"), ("d3", "new", "changed")]


def snapshots(spark, data):
    df = spark.createDataFrame(data, "snapshot string, key string, seen_at string, v string, row_hash string")
    return snapshot_rows(df, key=C("key"), snapshot=C("snapshot"), seen_at=C("seen_at"), values={"v": C("v")})


def tables_left(spark):
    return [t.name for t in spark.catalog.listTables() if t.name.startswith("snapshot_index_")]


def test_snapshot_changes(spark):
    history = History(snapshots(spark, SNAPSHOTS), ["v"])
    assert history.days == ["d1", "d2", "d3"]
    assert rows(history.changes()) == CHANGED
    assert rows(history.changed_values()) == [("d2", "chg", "v", "y", "z"), ("d3", "new", "v", "x", None)]
    assert tables_left(spark) == []


def test_the_index_is_swapped_at_every_snapshot(spark):
    df = snapshots(spark, SNAPSHOTS)
    with SnapshotIndex(spark) as index:
        assert index.advance("d1", df.filter("snapshot = 'd1'")) is None
        got = rows(index.advance("d2", df.filter("snapshot = 'd2'"))) + rows(index.advance("d3", df.filter("snapshot = 'd3'")))
        assert got == CHANGED
        assert spark.table(index._name).columns == ["key", "row_hash"] and len(tables_left(spark)) == 1
        with pytest.raises(ValueError):
            index.advance("d3", df)
        plan = index._probe(index._name, index._name, "d4")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("SortMergeJoin") == 1  # both sides lie in the same buckets
        assert rows(index.advance("d5", df.limit(0)), "key", "change_kind") == [(k, "removed") for k in ("back", "chg", "new", "same")]
    assert tables_left(spark) == []


def test_buckets_grow_with_the_rows(spark):
    assert [snapshot_diff.buckets_for(n, 10) for n in (0, 10, 11, 30, 1000)] == [1, 1, 2, 4, 128]
    df = snapshots(spark, [("d1", f"k{i}", "1", "x", "") for i in range(30)] + [("d2", f"k{i}", "1", "x", "") for i in range(300)])
    assert History(df).changes().count() == 270
    assert sum(c.count() for _, _, c in History(df).replay(rows_per_bucket=10)) == 270


def test_no_or_one_snapshot_changes_nothing(spark):
    for data in ([], SNAPSHOTS[:5]):
        history = History(snapshots(spark, data), ["v"])
        assert history.changes().count() == 0 and history.changed_values().count() == 0


# --------------------------------------------------------------------------- copies


def brute_copies(a, b, fields):
    x, y = ({k: max(r[1:] for r in side if r[0] == k) for k in {r[0] for r in side if r[0] is not None}} for side in (a, b))
    out = [(k, "left_only") for k in x.keys() - y.keys()] + [(k, "right_only") for k in y.keys() - x.keys()]
    out += [(k, f) for k in x.keys() & y.keys() for i, f in enumerate(fields) if x[k][i] != y[k][i]]
    return sorted(out)


@settings(max_examples=8, deadline=None)
@given(st.integers(0, 10_000), st.integers(0, 300), st.sampled_from([(1,), (3,), (64, 8, 2)]), st.sampled_from([1, 2, 4]))
def test_copies_against_brute_force(spark, seed, n, levels, window):
    rnd = random.Random(seed)
    a = [(f"k{rnd.randint(0, 400)}", "v", "w") for _ in range(n)]
    b = [(k, v if rnd.random() > 0.05 else "other", w if rnd.random() > 0.05 else "") for k, v, w in a if rnd.random() > 0.05] + [(None, "v", "w"), ("new", "", "")]
    schema = "key string, f string, g string"
    got = copy_diff.copy_differences(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["f", "g"], levels=levels, window=window)
    assert rows(got) == brute_copies(a, b, ["f", "g"])


def test_copies_nulls_and_empty_sides(spark):
    schema = "key string, f string, difference string, c0 string, g string"
    a = spark.createDataFrame([("a", None, "clash", "", "x"), ("b", "x", "", "", None), ("c", None, "", "", "x"), ("d", "", "", "", "")], schema)
    b = spark.createDataFrame([("a", None, "", "z", "x"), ("b", None, "", "", "x"), ("c", "x", "", "", None), ("d", None, "", "", "")], schema)
    assert rows(copy_diff.copy_differences(a, b, ["f", "g"])) == [("b", "f"), ("b", "g"), ("c", "f"), ("c", "g"), ("d", "f")]
    assert rows(copy_diff.copy_differences(a, b.limit(0), ["f"])) == [(k, "left_only") for k in "abcd"]
    assert copy_diff.copy_differences(a.limit(0), b.limit(0), ["f"]).count() == 0
    with pytest.raises(ValueError):
        copy_diff.copy_differences(a, b, ["f"], levels=(64, 7))


def test_chunks_settle_most_equal_rows(spark):
    """Copies that differ in one row of a hundred: nine tenths of the equal rows need no comparison."""
    rnd = random.Random(6)
    data = [(f"key-{i:05d}", str(i)) for i in range(12_000)]
    other = [(k, v) if rnd.random() > 0.005 else (k, "changed") for k, v in data if rnd.random() > 0.005] + [(f"key-{i:05d}x", "new") for i in range(7, 12_000, 500)]
    a, b = (spark.createDataFrame(x, "key string, f string").repartition(5) for x in (data, other))
    found = {r["key"] for r in copy_diff.copy_differences(a, b, ["f"]).collect()}
    equal = len(set(data) & set(other))
    report = {(r["side"], r["level_rows"]): r for r in copy_diff.chunk_report(a, b, ["f"]).collect()}
    assert report["left", 2]["n_rows"] == 12_000 and len(found) > 100
    assert 0.9 * equal <= report["left", 2]["settled_rows"] <= equal
    assert report["left", 64]["settled_rows"] < report["left", 8]["settled_rows"] < report["left", 2]["settled_rows"] == report["right", 2]["settled_rows"]


def test_cutting_does_not_depend_on_batches():
    import numpy as np

    keys = np.random.default_rng(1).integers(0, 2**63, 200, dtype=np.int64).view(np.uint64)
    whole = copy_diff._rolling(keys, keys[:0], 3)
    parts, before = [], keys[:0]
    for at in (0, 1, 2, 3, 50):
        end = {0: 1, 1: 2, 2: 3, 3: 50, 50: 200}[at]
        parts.append(copy_diff._rolling(keys[at:end], before, 3))
        before = keys[max(0, end - 2) : end]
    assert (np.concatenate(parts) == whole).all()


# --------------------------------------------------------------------------- schemas

F_ = drift.Field


@pytest.mark.parametrize(
    ("old", "new"),
    [
        ("city_name", "cityname"), ("device_model", "dev_mdl"), ("issuing_agency", "agency_issuing"), ("ulid", "ulid_v2"), ("version_number", "ver_no"),
        ("uuid", "x_uuid"), ("latest_version", "last_ver"), ("cityName", "city_name"),
    ],
)
def test_renames_are_seen(old, new):
    assert drift.edit_script([F_("a"), F_(old, "varchar", 0.9)], [F_("a"), F_(new, "varchar", 0.91)]) == [drift.Edit("renamed", new, old)]


def test_unrelated_fields_are_no_rename():
    got = drift.edit_script([F_("trade_name", "varchar", 0.5)], [F_("storage_note", "varchar", 0.5)])
    assert [e.kind for e in got] == ["added", "removed"]


def test_nested_edits():
    old = [F_("a.x", "int"), F_("a.long_name", "string"), F_("b.y", "string"), F_("gone.z", "int")]
    new = [F_("a.x", "bigint"), F_("a.longname", "string"), F_("c.y", "string")]
    assert drift.edit_script(old, new) == [
        drift.Edit("moved", "c.y", "b.y"), drift.Edit("removed", None, "gone.z"), drift.Edit("renamed", "a.longname", "a.long_name"), drift.Edit("retyped", "a.x", None)
    ]
    assert drift.edit_script([], []) == []


def matchings(n, m):
    import itertools

    for k in range(min(n, m) + 1):
        for rs in itertools.combinations(range(n), k):
            for cs in itertools.permutations(range(m), k):
                yield list(zip(rs, cs, strict=True))


def test_assignment_is_cheapest():
    rnd = random.Random(3)
    for _ in range(200):
        n, m = rnd.randint(1, 4), rnd.randint(1, 4)
        cost = [[rnd.choice([rnd.random(), 0.2]) for _ in range(m)] for _ in range(n)]
        out, put = [rnd.choice([0.25, 0.5]) for _ in range(n)], [rnd.choice([0.1, 0.25]) for _ in range(m)]

        def price(pairs, cost=cost, out=out, put=put):
            return sum(cost[i][j] - out[i] - put[j] for i, j in pairs)

        got = drift.assign(cost, out, put)
        assert len({i for i, _ in got}) == len({j for _, j in got}) == len(got)
        assert abs(price(got) - min(price(p) for p in matchings(n, m))) < 1e-9
    assert drift.assign([], [], [0.5]) == [] and drift.assign([[], []], [1, 1], []) == []


def test_wide_schemas_are_matched_in_time():
    old, new = [F_(f"col_{i:04d}_name") for i in range(150)], [F_(f"col_{i:04d}name") for i in range(150)]
    assert len([e for e in drift.edit_script(old, new) if e.kind == "renamed"]) == 150


def brute_forest(a, b, x, y):
    was, now = ({n.rsplit(".", 1)[-1]: n for n in t.children[at]} for t, at in ((a, x), (b, y)))

    def node(i, j):
        old, new = a.nodes[i], b.nodes[j]
        same = i.rsplit(".", 1)[-1] == j.rsplit(".", 1)[-1]
        own = drift.RETYPE * (old.kind is not None and new.kind is not None and old.kind != new.kind) if same else drift.rename_cost(old, new)
        return own + brute_forest(a, b, i, j)

    lost, gained = [was[n] for n in was if n not in now], [now[n] for n in now if n not in was]
    best = min(
        sum(node(lost[i], gained[j]) for i, j in pairs)
        + drift.INDEL * sum(a.size[n] for k, n in enumerate(lost) if k not in {i for i, _ in pairs})
        + drift.INDEL * sum(b.size[n] for k, n in enumerate(gained) if k not in {j for _, j in pairs})
        for pairs in matchings(len(lost), len(gained))
    )
    return best + sum(node(was[n], now[n]) for n in was if n in now)


def test_scripts_of_random_trees_cost_least():
    rnd = random.Random(12)
    for _ in range(300):
        trees = []
        for _ in range(2):
            names = [""]
            for _ in range(rnd.randint(1, 6)):
                parent = rnd.choice(names)
                name = (parent + "." if parent else "") + rnd.choice(["a", "ab", "abc", "x", "xy", "city_name", "cityname"])
                if name not in names:
                    names.append(name)
            trees.append([F_(n, rnd.choice(["int", "string", None])) for n in names[1:]])
        a, b = drift._Tree(trees[0]), drift._Tree(trees[1])
        assert abs(drift.script_cost(*trees) - brute_forest(a, b, "", "")) < 1e-9
        assert drift.edit_script(trees[0], trees[0]) == []
        # nothing is lost: every field of either side is kept, renamed, moved, added or removed
        script = drift.edit_script(*trees)
        assert len(script) == len(set(script))


def test_renamed_parents_are_known_by_their_children():
    """The cheapest script is two renames; taking the parents' names alone would move all four fields."""
    old, new = ([F_(n) for n in names] for names in (["alpha.x", "alpha.y", "beta.p", "beta.q"], ["gamma.p", "gamma.q", "delta.x", "delta.y"]))
    assert drift.edit_script(old, new) == [drift.Edit("renamed", "delta", "alpha"), drift.Edit("renamed", "gamma", "beta")]


def test_a_parent_that_stays_is_no_rename():
    old, new = ([F_(n) for n in names] for names in (["a.kept", "a.y"], ["a.kept", "b.y"]))
    assert drift.edit_script(old, new) == [drift.Edit("moved", "b.y", "a.y")]
    # a subtree moves as one, and a move that does not pay is none
    old, new = ([F_(n) for n in names] for names in (["a.k", "a.s.t.u", "c.k"], ["a.k", "c.k", "c.s.t.u"]))
    assert drift.edit_script(old, new) == [drift.Edit("moved", "c.s", "a.s")]


def test_small_samples_say_little_about_renames():
    far = drift.rename_cost(F_("p", "int", 1.0, 4000), F_("q", "int", 0.5, 4000)) - drift.rename_cost(F_("p", "int"), F_("q", "int"))
    near = [drift.rename_cost(F_("p", "int", 1.0, n), F_("q", "int", 0.5, n)) - drift.rename_cost(F_("p", "int"), F_("q", "int")) for n in (2, 29, 30, 31, 200)]
    assert far > 0.29 and near == sorted(near) and near[0] < 0.1 and abs(near[2] - near[1]) < 0.01


def test_schema_changes_between_deliveries(spark):
    def load(n, *fields, table="t"):
        return [("m", n, table, f, k, 50, 100) for f, k in fields]

    data = load(1, ("a", "INT"), ("city_name", "varchar"), ("b", "int")) + load(2, table="other", *[("q", "int")])
    data += load(3, (" A ", "int"), ("cityname", "VARCHAR "), ("b", "bigint"), ("c", None), (None, "int")) + load(4, ("a", "int"), ("cityname", "varchar"), ("b", "bigint"), ("c", "int"))
    df = spark.createDataFrame(data, "feed string, load_no bigint, table_name string, field_name string, field_type string, non_null_rows bigint, total_rows bigint")
    got = rows(drift.schema_changes(drift.fields_of_loads(df)), "load_no", "table_name", "field_name", "prev_field_name", "change_kind")
    assert got == [(3, "t", "b", "", "retyped"), (3, "t", "c", "", "added"), (3, "t", "cityname", "city_name", "renamed")]
    assert drift.schema_changes(drift.fields_of_loads(df.limit(0))).count() == 0
    # nested names: the parent stays, as one of its fields does
    deep = spark.createDataFrame(load(1, ("p.keep", "int"), ("p.move", "int")) + load(2, ("p.keep", "int"), ("r.move", "int")), df.schema)
    assert rows(drift.schema_changes(drift.fields_of_loads(deep)), "field_name", "prev_field_name", "change_kind") == [("r.move", "p.move", "renamed")]


def test_unify_reads_all_files_into_one_table(spark):
    a = spark.createDataFrame([("1", "x", "old")], "id string, city_name string, dropped string")
    b = spark.createDataFrame([("2", "y")], "id string, cityname string")
    c = spark.createDataFrame([(3, "z", 1.5)], "id int, cityname_v2 string, extra double")
    out, report = drift.unify([a, b, c])
    assert out.columns == ["id", "cityname_v2", "extra"]
    assert rows(out) == [(1, "x", None), (2, "y", None), (3, "z", 1.5)]
    assert [(i, e.kind) for i, e in report] == [(1, "removed"), (1, "renamed"), (2, "added"), (2, "renamed"), (2, "retyped")]


def test_scratch_is_removed_on_request(spark):
    from snapledger.sources.tables import clean_scratch, get_text, materialise, path_exists, put_text, scratch_path, scratch_root

    kept = materialise(spark.range(3), "x")
    assert kept.count() == 3
    p = scratch_path(spark, "t.json")
    put_text(spark, p, "a\nb")
    put_text(spark, p, "c")
    assert get_text(spark, p) == "c"
    clean_scratch(spark)
    assert not path_exists(spark, scratch_root(spark)) and get_text(spark, p) is None
