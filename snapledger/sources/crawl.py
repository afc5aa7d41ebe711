"""Crawls that can be stopped and taken up again, and what a run leaves behind."""

from __future__ import annotations

import time
from collections.abc import Mapping
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.audit import FAILED, run_status
from ..operators.merge import merge_snapshot
from ..operators.versions import base_mode
from .paged import Caps
from .snapshots import SnapshotStore
from .tables import materialise


class Crawl(NamedTuple):
    pages: DataFrame  #: what was fetched before the first failed page
    state: dict[str, Any]


def resume_page(state: Mapping[str, Any] | None, mode: str, overlap: int = 1) -> int:
    """Where a crawl begins: ``overlap`` pages before the last state's next page, or at 0.

    A state of another base mode, of a finished crawl or that cannot be read begins anew.
    """
    try:
        if not state or state["finished"] or base_mode(state["mode"]) != base_mode(mode):
            return 0
        return max(0, int(state["next_page"]) - overlap)
    except (KeyError, TypeError, ValueError):
        return 0


def crawl(
    spark: SparkSession, options: Mapping[str, Any], total_pages: int, mode: str, *, state: Mapping[str, Any] | None = None, overlap: int = 1,
    stretch: int = 500, caps: Caps | None = None,
) -> Crawl:
    """Pages of an offset extract in stretches of ``stretch``, until the end, a failed page or a cap.

    Each stretch is fetched by the executors and written out; only its counts come to the driver.  Pages
    after the first failed one are dropped, as the resumed crawl asks for them again.
    """
    caps, began, parts = caps or Caps(), time.monotonic(), []
    page = first = resume_page(state, mode, overlap)
    stopped = None
    limited = 0
    while page < total_pages and stopped is None:
        end = min(total_pages, page + stretch)
        reader = spark.read.format("paged").option("mode", "offset").option("pages", end).option("firstPage", page)
        for k, v in options.items():
            reader = reader.option(k, v)
        got = materialise(reader.load(), "crawl")
        seen = got.agg(F.min(F.when(F.col("error").isNotNull(), F.col("page"))).alias("bad"), F.count_if(F.col("status") == 429).alias("limited")).first()
        limited += seen["limited"]
        parts.append(got if seen["bad"] is None else got.filter(F.col("page") < seen["bad"]))
        page = end if seen["bad"] is None else seen["bad"]
        stopped = "failed" if seen["bad"] is not None else caps.reached(page - first, time.monotonic() - began, limited, 0)
    finished = page >= total_pages
    note = {"mode": base_mode(mode), "first_page": first, "next_page": page, "total_pages": total_pages, "finished": finished, "stopped_by": None if finished else stopped}
    pages = parts[0] if parts else None
    for p in parts[1:]:
        pages = pages.unionByName(p)
    return Crawl(pages, note)


def finish_run(
    store: SnapshotStore, version: str, name: str, stage: DataFrame | None, key: list[str], *, usable_pages: int, finished: bool, note: Mapping[str, Any] | None = None
) -> str:
    """Judge a run and commit what it leaves: its status.

    FAILED leaves the snapshot as it is; BOOTSTRAP and COMPLETE replace it by the staged rows; PARTIAL adds the
    previous rows of keys that were not seen.
    """
    previous = store.read(name)
    status = run_status(usable_pages, finished, previous is not None)
    if status == FAILED:
        store.commit(version, {}, status, note)
        return status
    merged = stage if previous is None else merge_snapshot(previous, stage, key, complete=finished)
    store.commit(version, {name: merged}, status, note)
    return status
