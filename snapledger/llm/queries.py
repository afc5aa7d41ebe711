"""Queries on texts and duplicate groups (p5, p8, p9, p10), each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean, normalise_id, number_text, uuid_key
from ..plans.general import nn, uu
from ..sources.tables import materialise, table
from . import consensus, mixing, subjects, tokens

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


# --------------------------------------------------------------------------- p5

# Texts that say yes.
YES = ("true", "t", "1", "1.0", "yes", "y")


def device_code(c: str) -> Column:
    """Upper case, trimmed, without an application identifier in brackets before it."""
    return F.upper(clean(F.regexp_replace(clean(c), r"^\(\d+\)\s*", "")))


def _preference() -> Column:
    """Marked latest, then version number, then ulid, then candidate uuid; missing is lowest."""
    return F.struct(
        F.coalesce(F.lower(clean("latest_version")).isin(*YES).cast("int"), F.lit(0)).alias("latest"),
        clean("version_number").try_cast("decimal(38,6)").alias("version"),
        F.upper(clean("ulid")).alias("ulid"),
        uuid_key("candidate_uuid").alias("candidate"),
    )


def _trust() -> Column:
    """A row's weight in millionths: 1, 2 more if marked latest, and up to 1 that grows with the version number."""
    latest = F.coalesce(F.lower(clean("latest_version")).isin(*YES).cast("int"), F.lit(0))
    version = clean("version_number").try_cast("decimal(38,6)").cast("double")
    recency = F.coalesce((version / (1 + F.abs(version)) + 1) / 2, F.lit(0.0))
    return F.floor(F.lit(1_000_000) * (1 + 2 * latest + recency))


@query(
    "p5_found",
    f"""
WITH c AS (SELECT upper({nn(f"regexp_replace({nn('primary_di_code')}, '^[(][0-9]+[)] *', '')")}) code, {uu('candidate_uuid')} cand, {uu('primary_di_uuid')} di,
                  coalesce(lower({nn('latest_version')}) IN ('true','t','1','1.0','yes','y'), false)::INT latest,
                  try_cast({nn('version_number')} AS DECIMAL(38,6)) v, upper({nn('ulid')}) u FROM candidate_inventory),
r AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY latest DESC, v DESC NULLS LAST, u DESC NULLS LAST, cand DESC NULLS LAST) n FROM c WHERE code IS NOT NULL)
SELECT max(cand) FILTER (n = 1) candidate_uuid, coalesce(arg_min(di, n) FILTER (di IS NOT NULL), '') primary_di_uuid
FROM r GROUP BY code HAVING count(DISTINCT cand) >= 2""",
)
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """The surviving candidate of each device: every distinct uuid votes once, by the trust and recency of its best row.

    A mark as latest weighs 2, a version number up to 1 beside the 1 every value has; equal weights go by the order.
    """
    inventory = table(spark, d, "candidate_inventory")
    chosen = consensus.survivors(
        inventory, device_code("primary_di_code"),
        {"candidate_uuid": uuid_key("candidate_uuid"), "primary_di_uuid": uuid_key("primary_di_uuid")},
        weight=_trust(), rank=_preference(), pool="max",
    )

    def of(name: str, col: str) -> Column:
        return F.max(F.when(F.col("column_name") == name, F.col(col)))

    wide = chosen.groupBy("group_key").agg(
        of("candidate_uuid", "value").alias("candidate_uuid"), of("candidate_uuid", "n_values").alias("n"), of("primary_di_uuid", "value").alias("di")
    )
    return wide.filter("n >= 2").select("candidate_uuid", F.coalesce("di", F.lit("")).alias("primary_di_uuid"))


def _consensus_fields() -> dict[str, Column]:
    """All columns of candidate_inventory but the key; writings of one meaning are one value."""
    flag = F.when(clean("latest_version").isNotNull(), F.lower(clean("latest_version")).isin(*YES).cast("string"))
    special = {
        "candidate_uuid": uuid_key("candidate_uuid"), "primary_di_uuid": uuid_key("primary_di_uuid"), "ulid": F.upper(clean("ulid")),
        "latest_version": flag, "version_number": normalise_id(number_text("version_number")),
    }
    plain = [
        "ulid_datetime_utc", "queue_source", "priority", "status", "attempt_count", "last_status_code", "last_error", "queued_at_utc",
        "last_attempt_at_utc", "completed_at_utc", "last_detail_extract_datetime_utc",
    ]
    return special | {c: clean(c) for c in plain}


@query("p5_consensus")
def p5_consensus(spark: SparkSession, d: str) -> DataFrame:
    """Field by field the value closest to the consensus of all rows of a device; every column but the key.

    A row's vote is the number of its filled fields, twice if it is marked latest, and up to 8 more that
    grow with its version number, so a claim of a huge number cannot outvote the rest.  Equal weights go
    to the value of the row marked latest, then of the highest version number, then to the higher value.
    """
    fields = _consensus_fields()
    filled = sum((c.isNotNull().cast("int") for c in fields.values()), F.lit(0))
    latest = F.coalesce((fields["latest_version"] == "true").cast("int"), F.lit(0))
    version = F.greatest(F.coalesce(clean("version_number").try_cast("double"), F.lit(0.0)), F.lit(0.0))
    weight = F.greatest(filled, F.lit(1)) * (1 + latest) + F.floor(8 * version / (1 + version))
    return consensus.survivors(table(spark, d, "candidate_inventory"), device_code("primary_di_code"), fields, weight=weight, rank=F.struct(latest.alias("latest"), version.alias("version")))


# --------------------------------------------------------------------------- p8


@query("p8_ids")
def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """Every text encoded by byte_bpe_50k."""
    return tokens.encode_corpus(table(spark, d, "documents"), "doc_id", "text")


@query("p8_roundtrip", "SELECT doc_id, true exact FROM documents")
def p8_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Whether decoding a document's ids gives its text again."""
    docs = materialise(table(spark, d, "documents").select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "numbered")
    back = tokens.decode_corpus(tokens.encode_corpus(docs, "row", "text"), "row").withColumnRenamed("text", "decoded")
    return docs.join(back, "row").select("doc_id", (F.coalesce("text", F.lit("")) == F.col("decoded")).alias("exact"))


# --------------------------------------------------------------------------- p9

# Three-letter codes of the languages that occur under both.
LANGUAGES = {"eng": "en", "dan": "da", "deu": "de", "ger": "de", "fra": "fr", "fre": "fr"}


def source_name(c: str) -> Column:
    return F.regexp_replace(F.lower(clean(c)), r"[\s_]+", "_")


def language(c: str) -> Column:
    """Two-letter code; a region or placeholder after a hyphen is dropped; missing is ``und``."""
    code = F.regexp_extract(F.lower(clean(c)), r"^([a-z]+)", 1)
    named = code
    for three, two in LANGUAGES.items():
        named = F.when(code == three, F.lit(two)).otherwise(named)
    return F.coalesce(F.when(named != "", named), F.lit("und"))


# The domain each source belongs to; a source not named here is one of its own.
DOMAINS = {
    "leaflets": "instructions", "manuals": "instructions", "parliament_minutes": "public", "newswire": "public", "encyclopedia": "public",
    "subtitles": "spoken", "forum": "spoken", "pilot_scans": "archive", "old_archive": "archive",
}


def _targets(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "source_weights").select(
        source_name("source").alias("source"), F.col("target_share").cast("double").alias("target_share"), F.col("max_repeats").cast("bigint").alias("max_repeats")
    )


def _sized(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", source_name("source").alias("source"), language("lang").alias("lang"))
    domain = F.col("source")
    for name, at in DOMAINS.items():
        domain = F.when(F.col("source") == name, F.lit(at)).otherwise(domain)
    return tokens.with_token_counts(docs, "text").withColumn("domain", domain)


def _mix(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The chosen documents, the targets, and all documents with their sizes."""
    targets, sized = _targets(spark, d), materialise(_sized(spark, d), "sized")
    return mixing.choose(sized, "doc_id", "n_tokens", ["domain", "lang", "source"], targets, "source", seed=20), targets, sized


@query("p9_mix")
def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """The chosen documents with their repeats."""
    return _mix(spark, d)[0]


@query("p9_shares")
def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual share of each source, shortfalls included."""
    chosen, targets, _ = _mix(spark, d)
    return mixing.shares(chosen, targets, "source")


@query("p9_kept", "SELECT regexp_replace(lower(trim(source)), '[ _]+', '_', 'g') source, target_share, true caps_kept, true target_met FROM source_weights")
def p9_kept(spark: SparkSession, d: str) -> DataFrame:
    """Whether no document of a source is taken too often, and whether the source has its share or gave all it could."""
    chosen, targets, sized = _mix(spark, d)
    most = chosen.groupBy("source").agg(F.max("repeats").alias("most"))
    held = sized.groupBy("doc_id").agg(F.max(F.struct("n_tokens", "source")).alias("x")).groupBy("x.source").agg(F.sum("x.n_tokens").alias("held"))
    got = mixing.shares(chosen, targets, "source").join(most, "source", "left").join(held, "source", "left")
    return got.select(
        "source", "target_share", (F.coalesce("most", F.lit(0)) <= F.col("max_repeats")).alias("caps_kept"),
        # a prefix ends before the first document that does not fit, so a share may lack a few tokens
        ((F.col("actual_share") >= 0.99 * F.col("target_share")) | (F.col("actual_tokens") == F.coalesce("held", F.lit(0)) * F.col("max_repeats"))).alias("target_met"),
    )


# --------------------------------------------------------------------------- p10


def _subjects(spark: SparkSession, d: str) -> DataFrame:
    return subjects.subjects_of(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "doc_subjects"))


@query("p10_found")
def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """The subjects of each document."""
    return _subjects(spark, d).select("doc_id", "subject")


@query("p10_composition")
def p10_composition(spark: SparkSession, d: str) -> DataFrame:
    """Number of documents per subject and language."""
    found = _subjects(spark, d).select("doc_id", "subject")
    langs = table(spark, d, "documents").select("doc_id", language("lang").alias("lang")).distinct()
    return found.join(langs, "doc_id").groupBy("subject", "lang").agg(F.count_distinct("doc_id").alias("n_docs"))
