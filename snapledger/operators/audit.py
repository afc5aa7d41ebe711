"""Inventories, page diagnostics and telemetry of a crawl."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean


def field_inventory(df: DataFrame, name: str) -> DataFrame:
    """``table_name, field_name, non_null_rows, total_rows`` of every column in one aggregate."""
    one = df.agg(F.count(F.lit(1)).alias("total_rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns if c != "total_rows"])
    fields = [c for c in one.columns if c != "total_rows"]
    return one.unpivot(["total_rows"], fields, "field_name", "non_null_rows").select(F.lit(name).alias("table_name"), "field_name", "non_null_rows", "total_rows")


def page_diagnostics(df: DataFrame, page: str, key: str) -> DataFrame:
    """Per page: rows, rows with a key, distinct, missing and duplicate keys."""
    return df.groupBy(page).agg(
        F.count(F.lit(1)).alias("rows_returned"), F.count(key).alias("key_rows"), F.count_distinct(key).alias("distinct_keys"),
        F.count_if(F.col(key).isNull()).alias("missing_keys"), (F.count(key) - F.count_distinct(key)).alias("duplicate_keys"),
    )


def known_streaks(pages: DataFrame, page: str, new_keys: str) -> DataFrame:
    """Gaps and islands: ``first_page, last_page, pages`` of runs of neighbouring pages without a new key.

    Numbers within blocks of pages would need no global order, but the pages of one crawl are one sequence;
    pages are pre-aggregated, a few bytes each.
    """
    known = pages.filter(F.col(new_keys) == 0)
    island = known.withColumn("__g", F.col(page) - F.row_number().over(Window.orderBy(page)))
    return island.groupBy("__g").agg(F.min(page).alias("first_page"), F.max(page).alias("last_page"), F.count(F.lit(1)).alias("pages")).drop("__g")


def page_novelty(rows: DataFrame, known: DataFrame, page: str, key: str) -> DataFrame:
    """``page, n_rows, new_keys``: distinct keys of a page that are not known yet."""
    seen = known.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("__k", F.lit(True))
    pairs = rows.groupBy(page, key).agg(F.count(F.lit(1)).alias("c")).join(seen, key, "left")
    return pairs.groupBy(page).agg(F.sum("c").alias("n_rows"), F.count_if(F.col("__k").isNull() & F.col(key).isNotNull()).alias("new_keys"))


def missing_pages(audit: DataFrame, page: str, ok: Column, spark_range: DataFrame) -> DataFrame:
    """Requested pages (a frame of ``page``) without any successful fetch: what a recovery round asks for again."""
    return spark_range.join(audit.filter(ok).select(page).distinct(), page, "left_anti")


def recover(rows: DataFrame, recovered: DataFrame, page: str) -> DataFrame:
    """Rows with the recovered pages in the place of their earlier ones."""
    return rows.join(recovered.select(page).distinct(), page, "left_anti").unionByName(recovered)


def trace_rollup(trace: DataFrame, by: Sequence[str], rows: str, at: str, error: Column) -> DataFrame:
    """Per partition: pages, rows, first and last time, failed pages."""
    return trace.groupBy(*by).agg(
        F.count(F.lit(1)).alias("pages"), F.coalesce(F.sum(rows), F.lit(0)).cast("bigint").alias("rows_returned"), F.min(at).alias("first_page_at"),
        F.max(at).alias("last_page_at"), F.count_if(error).alias("error_pages"),
    )


def status_class(status: Column, body: Column | None = None, error: Column | None = None) -> Column:
    """Class of an HTTP answer; an error text wins, then success, then a blocking page."""
    # The names of the classes.
    text = F.lower(F.coalesce(body, F.lit(""))) if body is not None else F.lit("")
    out = F.when(clean(error).isNotNull(), "ERROR") if error is not None else F.when(F.lit(False), "ERROR")
    return (
        out.when(status == 200, "OK")
        .when(text.contains("web filter") | text.contains("access denied"), "BLOCKED_WEB_FILTER")
        .when(status == 429, "RATE_LIMITED_429")
        .when(status.between(500, 599), "SERVER_ERROR")
        .when(status.between(400, 499), "CLIENT_ERROR")
        .otherwise("UNKNOWN")
    )


def endpoint_summary(results: DataFrame, cls: str = "classification") -> DataFrame:
    """One row of counts per class and what they say about the endpoints together."""
    counts = results.agg(
        F.count(F.lit(1)).alias("tested_endpoints"), F.count_if(F.col(cls) == "OK").alias("ok_count"),
        F.count_if(F.col(cls) == "BLOCKED_WEB_FILTER").alias("blocked_web_filter_count"), F.count_if(F.col(cls) == "RATE_LIMITED_429").alias("rate_limited_429_count"),
        F.count_if(F.col(cls) == "SERVER_ERROR").alias("server_error_count"), F.count_if(F.col(cls) == "ERROR").alias("request_error_count"),
    )
    # The names of the verdicts.
    n, ok, blocked = F.col("tested_endpoints"), F.col("ok_count"), F.col("blocked_web_filter_count")
    verdict = (
        F.when(blocked == n, "ENTIRE_PLATFORM_API_BLOCKED_FROM_RUNNER").when((blocked > 0) & (ok > 0), "PARTIAL_ENDPOINT_BLOCKING_FROM_RUNNER")
        .when(ok == n, "ALL_ENDPOINTS_REACHABLE_FROM_RUNNER").when(F.col("rate_limited_429_count") > 0, "RATE_LIMITING_OBSERVED")
        .when(F.col("server_error_count") > 0, "SERVER_ERRORS_OBSERVED").when(F.col("request_error_count") > 0, "REQUEST_ERRORS_OBSERVED")
        .otherwise("MIXED_OR_UNKNOWN_RESULT")
    )
    return counts.withColumn("conclusion", verdict)


def recent_mean(df: DataFrame, order: Sequence[Column], value: str, n: int, by: Sequence[str] = ()) -> DataFrame:
    """Mean of the last ``n`` values (per group if ``by``); a top-n report."""
    if by:
        ranked = df.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("__n") <= n)
        return ranked.groupBy(*by).agg(F.round(F.avg(value), 4).alias("recent_mean"))
    return df.orderBy(*order).limit(n).agg(F.round(F.avg(value), 4).alias("recent_mean"))


def crawl_audit(audit: DataFrame, rows: DataFrame, page: str, ok: Column, key: str, expected_rows: int, expected_pages: int) -> DataFrame:
    """One row: pages asked, ok and missing, rows received, duplicate keys and the difference to what was expected."""
    pages = audit.agg(
        F.count_distinct(page).alias("requested_pages"), F.count_distinct(F.when(ok, F.col(page))).alias("ok_pages"),
    ).withColumn("missing_pages", F.lit(expected_pages) - F.col("ok_pages"))
    got = rows.agg(F.count(F.lit(1)).alias("received_rows"), (F.count(key) - F.count_distinct(key)).alias("duplicate_keys"))
    return pages.withColumn("__j", F.lit(1)).join(F.broadcast(got.withColumn("__j", F.lit(1))), "__j").drop("__j").withColumn(
        "row_difference", F.col("received_rows") - F.lit(expected_rows)
    )


def ulid_bounds(df: DataFrame, ulid: str, expected: int) -> DataFrame:
    """One row: lowest and highest ulid (texts of a null left out), rows and completeness."""
    return df.agg(F.min(clean(ulid)).alias("min_ulid"), F.max(clean(ulid)).alias("max_ulid"), F.count(F.lit(1)).alias("rows")).withColumn(
        "completeness", F.round(F.try_divide(F.col("rows").cast("double"), F.lit(expected).cast("double")), 4)
    )


def beyond_frontier(df: DataFrame, known: DataFrame, ulid: str) -> DataFrame:
    """Rows whose ulid is above every known one; all rows if none is known.

    One value is broadcast; ulids are compared in upper case, texts of a null count for nothing.
    """
    top = known.agg(F.max(F.upper(clean(ulid))).alias("__top"))
    joined = df.withColumn("__one", F.lit(1)).join(F.broadcast(top.withColumn("__one", F.lit(1))), "__one")
    return joined.filter(F.col("__top").isNull() | (F.upper(clean(ulid)) > F.col("__top"))).select(*df.columns)


def head_tail_pages(novelty: DataFrame, page: str, new_keys: str, streak: int) -> DataFrame:
    """One row: pages with new keys at the head (before the first ``streak`` known pages in a row) and behind it.

    ``head_end`` is the first page of that run, or one past the last page; ``probe_needed`` says whether new
    keys lie behind it, so that the scan has to go on.
    """
    runs = known_streaks(novelty, page, new_keys).filter(F.col("pages") >= streak).agg(F.min("first_page").alias("run"))
    last = novelty.agg((F.max(page) + 1).alias("past"))
    end = runs.withColumn("__j", F.lit(1)).join(last.withColumn("__j", F.lit(1)), "__j").select("__j", F.coalesce("run", "past").alias("head_end"))
    rows = novelty.withColumn("__j", F.lit(1)).join(F.broadcast(end), "__j").filter(F.col(new_keys) > 0)
    counts = rows.agg(F.count_if(F.col(page) < F.col("head_end")).alias("head_pages"), F.count_if(F.col(page) >= F.col("head_end")).alias("tail_pages"))
    return end.join(counts.withColumn("__j", F.lit(1)), "__j").select("head_end", "head_pages", "tail_pages", (F.col("tail_pages") > 0).alias("probe_needed"))


def column_drift(old: dict[str, Sequence[str]], new: dict[str, Sequence[str]]) -> dict[str, dict[str, list[str]]]:
    """Added and removed columns per table, from two descriptions of the same tables."""
    out = {}
    for t in sorted(old.keys() | new.keys()):
        a, b = set(old.get(t, ())), set(new.get(t, ()))
        if a != b:
            out[t] = {"added": sorted(b - a), "removed": sorted(a - b)}
    return out


def table_summary(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> list[dict[str, object]]:
    """Rows and columns of each table in two snapshots (one count per table)."""
    out = []
    for t in sorted(before.keys() | after.keys()):
        a, b = before.get(t), after.get(t)
        out.append(
            {
                "table_name": t, "rows_before": a.count() if a is not None else None, "rows_after": b.count() if b is not None else None,
                "columns_before": len(a.columns) if a is not None else None, "columns_after": len(b.columns) if b is not None else None,
            }
        )
    return out


# The names of a run's outcome.
FAILED, BOOTSTRAP, COMPLETE, PARTIAL = "FAILED", "BOOTSTRAP", "COMPLETE", "PARTIAL"


def run_status(usable_pages: int, finished: bool, had_previous: bool) -> str:
    """No usable page fails the run; a finished one without a previous snapshot is a bootstrap."""
    if usable_pages == 0:
        return FAILED
    if not finished:
        return PARTIAL
    return COMPLETE if had_previous else BOOTSTRAP
