from __future__ import annotations

from datetime import datetime, timezone

from hypothesis import given, settings
from hypothesis import strategies as st
from tests.conftest import rows

from pyspark.sql import functions as F
from snapledger import functions as fn


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column).first()[0]


def test_clean_knows_the_texts_of_a_null(spark):
    df = spark.createDataFrame([(v,) for v in [None, "", "  ", "None", " nan ", "NaT", "\t", "x ", "nano", "null"]], "v string")
    assert [r[0] for r in df.select(fn.clean("v")).collect()] == [None] * 7 + ["x", "nano", "null"]
    assert [r[0] for r in df.select(fn.is_missing("v")).collect()] == [True] * 7 + [False] * 3


def test_keys_have_one_writing(spark):
    u = "00EEFCE5E0AB4F55A5B3C57E02534395 "
    assert one(spark, u, fn.uuid_key("v")) == "00eefce5-e0ab-4f55-a5b3-c57e02534395"
    assert one(spark, " 00EEFCE5-e0ab-4F55-A5B3-C57E02534395", fn.uuid_key("v")) == "00eefce5-e0ab-4f55-a5b3-c57e02534395"
    assert one(spark, "No-Uuid", fn.uuid_key("v")) == "no-uuid"
    assert one(spark, " dk-mf-000000001 ", fn.code_key("v")) == "DK-MF-000000001"
    assert one(spark, "nan", fn.uuid_key("v")) is None


def test_numbers_and_ids(spark):
    for text in ("-203", "-203.0", " -203.0 ", "-203.00"):
        assert one(spark, text, fn.number_text("v")) == one(spark, "-203", fn.number_text("v"))
        assert one(spark, text, fn.normalise_id("v")) == "-203"
    assert one(spark, "12a", fn.number_text("v")) == "12a"
    assert one(spark, "", fn.number_text("v")) is None
    assert one(spark, "a|b|c", fn.token_count("v")) == 3
    assert one(spark, "", fn.token_count("v")) == 0


def test_days(spark):
    for text in ("2025-02-03", "20250203", "2025-02-03 00:00:00 UTC", "2025-02-03T04:05:06.000Z", " 2025-02-03 "):
        assert one(spark, text, fn.day_of("v")) == "2025-02-03"
    for text in ("2025-02-31", "soon", "2025-2-3", None, "nan"):
        assert one(spark, text, fn.day_of("v")) is None


def test_ulid_guards(spark):
    assert one(spark, "01HK153X00AAAAAAAAAAAAAAAA", fn.ulid_millis("v")) == 1704067200000
    assert one(spark, "01hk153x00aaaaaaaaaaaaaaaa", fn.ulid_day("v")) == "2024-01-01"
    for bad in ("01HK153X0", "01HK153XIL", "01HK153XOU", None, ""):
        assert one(spark, bad, fn.ulid_millis("v")) is None


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 2**46), min_size=1, max_size=30))
def test_ulid_time_is_what_was_encoded(spark, stamps):
    alphabet = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"

    def encode(ms):
        return "".join(alphabet[(ms >> (5 * (9 - i))) % 32] for i in range(10)) + "0" * 16

    df = spark.createDataFrame([(encode(m), m) for m in stamps], "u string, m bigint")
    got = df.select("u", "m", fn.ulid_millis("u").alias("x"), fn.ulid_day("u").alias("d")).collect()
    assert all(r["x"] == r["m"] for r in got)
    assert all(r["d"] == datetime.fromtimestamp(r["m"] / 1000, timezone.utc).strftime("%Y-%m-%d") for r in got if r["m"] < 2**45)
    assert [r["u"] for r in sorted(got, key=lambda r: r["u"])] == [encode(m) for m in sorted(stamps)]


def test_hashes_and_labelled_keys(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, "", "x")], "b int, a string, c string")
    h = [r[0] for r in df.select(fn.row_hash(["c", "a", "b"])).collect()]
    assert h[0] == h[1]
    import hashlib

    assert h[0] == hashlib.md5(b"|1|x").hexdigest()
    assert [r[0] for r in df.select(fn.labelled_key(["b", "a"])).collect()] == ["b=|1|a=", "b=|1|a=|"]
    assert rows(df.select(fn.composite_key(["b", "a"]))) == [("1|",), ("1|",)]
    diff = fn.changed_columns([("a", F.col("a"), F.lit("")), ("c", F.col("c"), F.lit("x"))])
    assert [r[0] for r in df.select(diff).collect()] == ["a", ""]
