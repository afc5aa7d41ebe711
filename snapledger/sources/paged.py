"""A Python Data Source for paged REST extracts, with the transport as a parameter.

``spark.read.format("paged").option("transport", "module:function")`` gives one
row per fetched page (body text and telemetry); rows are unfolded from the body
by the caller with built-ins.  Each planned partition of the extract is one
Spark partition, so pages are fetched where they are kept.  A page that fails
for good ends its partition with an error row instead of failing the job: the
status of the run is read from those rows.

``transport(url, params) -> (status, body, retry_after)`` does one request.
"""

from __future__ import annotations

import importlib
import itertools
import json
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..session import ship

SCHEMA = "label string, page bigint, url string, status bigint, body string, next_link string, n_rows bigint, duration_ms bigint, attempts bigint, error string"

Transport = Callable[[str, Mapping[str, Any]], tuple[int, str, float | None]]


@dataclass(frozen=True)
class RetryPolicy:
    """429 and 5xx are tried again; waits double up to ``max_wait`` or follow Retry-After."""

    tries: int = 5
    max_wait: float = 60.0

    def waits(self) -> Iterator[float]:
        return (min(self.max_wait, 2.0**n) for n in range(1, self.tries))

    @staticmethod
    def passing(status: int) -> bool:
        return status == 429 or status >= 500

    @staticmethod
    def refused(status: int, body: str | None) -> bool:
        """A filter's page of refusal, whatever its status says: asking again does not help."""
        text = (body or "")[:4096].lower()
        return status != 200 and ("access denied" in text or "web filter" in text)


@dataclass
class FetchResult:
    status: int
    body: str | None
    attempts: int
    error: str | None


def fetch(transport: Transport, url: str, params: Mapping[str, Any], policy: RetryPolicy, sleep: Callable[[float], None] = time.sleep) -> FetchResult:
    """One page under the retry policy; never raises for an answer or a transport error."""
    waits = policy.waits()
    for attempt in itertools.count(1):
        after: float | None = None
        try:
            status, body, after = transport(url, params)
            if policy.refused(status, body):
                return FetchResult(status, body, attempt, "refused")
            if status == 200 or not policy.passing(status):
                return FetchResult(status, body, attempt, None if status == 200 else f"status {status}")
            error = f"status {status}"
        except Exception as e:  # a broken connection counts as a passing failure
            status, body, error = 0, None, f"{type(e).__name__}: {e}"
        wait = next(waits, None)
        if wait is None:
            return FetchResult(status, body, attempt, error)
        sleep(after if after is not None else wait)
    raise AssertionError("unreachable")


class RateLimiter:
    """A fixed gap between requests; a partition's share of the budget, as executors share no lock."""

    def __init__(self, per_second: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.gap = 1.0 / per_second if per_second > 0 else 0.0
        self.clock, self.sleep, self.next = clock, sleep, 0.0

    def wait(self) -> None:
        now = self.clock()
        if now < self.next:
            self.sleep(self.next - now)
            now = self.next
        self.next = now + self.gap


@dataclass
class Caps:
    """When a run stops asking: after so many records, seconds, 429 answers or failures (0: no cap).

    What was not asked for is reported as such, so a resumed run takes it up; nothing is lost.
    """

    records: int = 0
    seconds: float = 0.0
    rate_limited: int = 0
    failures: int = 0

    def reached(self, records: int, seconds: float, rate_limited: int, failures: int) -> str | None:
        for name, cap, now in (("records", self.records, records), ("seconds", self.seconds, seconds), ("rate_limited", self.rate_limited, rate_limited), ("failures", self.failures, failures)):
            if cap and now >= cap:
                return name
        return None

    def shared(self, parts: int) -> Caps:
        """One partition's part: executors share no counter, so counts are split; time is the same for all."""
        split = lambda n: -(-n // parts) if n else 0
        return Caps(split(self.records), self.seconds, split(self.rate_limited), split(self.failures))


# --------------------------------------------------------------------------- planning


def active_values(block: Sequence[Mapping[str, Any]]) -> list[Any]:
    """Values of a parameter block that are switched on; an entry without ``active`` is."""
    return [v["value"] for v in block if v.get("active", True)]


def plan_partitions(config: Mapping[str, Any], residual: bool = False) -> list[dict[str, Any]]:
    """Request parameters per partition: the configured pairs first, then single values no pair covers.

    Pairs with a missing side and switched-off rules are left out.  ``residual`` adds one partition per
    combination of active values that neither covers, as pairs leave gaps.
    """
    out: list[dict[str, Any]] = []
    covered: dict[str, set[Any]] = {}
    pairs_seen: set[tuple[tuple[str, Any], ...]] = set()
    for rule in config.get("combinations", []):
        if not rule.get("active", True):
            continue
        names = rule["parameters"]
        for pair in rule["pairs"]:
            if len(pair) != len(names) or any(v is None for v in pair):
                continue
            chosen = dict(zip(names, pair, strict=True))
            key = tuple(sorted(chosen.items()))
            if key not in pairs_seen:
                pairs_seen.add(key)
                out.append(chosen)
            for n, v in chosen.items():
                covered.setdefault(n, set()).add(v)
    blocks = {n: active_values(b) for n, b in config.get("parameters", {}).items()}
    for n, values in blocks.items():
        out += [{n: v} for v in values if v not in covered.get(n, set())]
    if residual and len(blocks) > 1:
        names = sorted(blocks)
        for combo in itertools.product(*(blocks[n] for n in names)):
            chosen = dict(zip(names, combo, strict=True))
            singles = any(v not in covered.get(n, set()) for n, v in chosen.items())
            if not singles and tuple(sorted(chosen.items())) not in pairs_seen:
                out.append(chosen)
    return out


def label_of(params: Mapping[str, Any]) -> str:
    return " ".join(f"{k}={v}" for k, v in params.items()) or "all"


# --------------------------------------------------------------------------- data source


class _Part(InputPartition):
    def __init__(self, label: str, params: Mapping[str, Any], first: int = 0, last: int | None = None):
        self.label, self.params, self.first, self.last = label, dict(params), first, last


def _load(name: str) -> Transport:
    module, _, attr = name.partition(":")
    return getattr(importlib.import_module(module), attr)


class PagedReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]):
        self.options = {k.lower(): v for k, v in options.items()}  # Spark hands option names over in any case

    def partitions(self) -> Sequence[InputPartition]:
        mode = self.options.get("mode", "nextlink")
        if mode == "nextlink":
            plan = json.loads(self.options.get("partitions", "[{}]"))
            return [_Part(label_of(p), p) for p in plan]
        pages, size = int(self.options["pages"]), int(self.options.get("pagesperpartition", "50"))
        wanted = json.loads(self.options["onlypages"]) if "onlypages" in self.options else None
        if wanted is not None:
            return [_Part("pages", {}, p, p + 1) for p in wanted]
        return [_Part("pages", {}, a, min(pages, a + size)) for a in range(int(self.options.get("firstpage", "0")), pages, size)]

    def read(self, partition: _Part) -> Iterator[tuple]:
        transport = _load(self.options["transport"])
        policy = RetryPolicy(int(self.options.get("tries", "5")), float(self.options.get("maxwait", "60")))
        shares = max(1, int(self.options.get("parallel", "1")))
        limiter = RateLimiter(float(self.options.get("maxrps", "0")) / shares)
        url = self.options["url"]
        if self.options.get("mode", "nextlink") == "nextlink":
            link, params, page = url, partition.params, 0
            while link:
                row, link = self._page(transport, policy, limiter, partition.label, page, link, params, "value", "nextLink")
                yield row
                params, page = {}, page + 1  # a next link carries the parameters itself
            return
        for page in range(partition.first, partition.last or 0):
            row, _ = self._page(transport, policy, limiter, partition.label, page, url, {"page": page}, "content", "")
            yield row
            if row[9] is not None and self.options.get("stoponerror", "false") == "true":
                return

    @staticmethod
    def _page(transport, policy, limiter, label, page, url, params, rows_key, link_key):
        limiter.wait()
        began = time.monotonic()
        got = fetch(transport, url, params, policy)
        took = int((time.monotonic() - began) * 1000)
        link, n, error = None, 0, got.error
        if error is None:
            try:
                doc = json.loads(got.body or "")
                n, link = len(doc.get(rows_key) or []), (doc.get(link_key) or None) if link_key else None
            except (ValueError, AttributeError) as e:
                error = f"unreadable body: {e}"
        return (label, page, url, got.status, got.body, link, n, took, got.attempts, error), link


class PagedSource(DataSource):
    """Options: transport, url, mode (nextlink or offset), partitions (JSON), pages, onlyPages, tries, maxWait, maxRps, parallel."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PagedReader:  # noqa: ARG002
        return PagedReader(self.options)


def discover(transport: Transport, url: str, policy: RetryPolicy | None = None) -> dict[str, Any]:
    """Totals from page 0: the first present of the usual names."""
    got = fetch(transport, url, {"page": 0}, policy or RetryPolicy(), lambda s: None)
    doc = json.loads(got.body) if got.error is None and got.body else {}

    def first(*names: str) -> Any:
        return next((doc[n] for n in names if doc.get(n) is not None), None)

    return {"total_elements": first("totalElements", "total", "count"), "total_pages": first("totalPages", "pages"), "error": got.error}


# --------------------------------------------------------------------------- lookups

LOOKUP = "key string, url string, status bigint, body string, n_rows bigint, duration_ms bigint, attempts bigint, error string"


def lookup(keys: DataFrame, key: str, transport: str, url: str, *, policy: RetryPolicy | None = None, per_second: float = 0.0, parallel: int = 4, caps: Caps | None = None) -> DataFrame:
    """One request per distinct key, ``url`` with ``{key}`` in it: ``key, url, status, body, ..., error``.

    Keys are spread over ``parallel`` partitions, each with its part of the rate and of the caps.  A key that
    fails gives an error row; past a cap the rest come back with status NULL and the cap's name as error.
    Missing keys are left out, repeated ones asked for once.
    """
    ship(keys.sparkSession)
    rule, limits = policy or RetryPolicy(), (caps or Caps()).shared(parallel)
    wanted = keys.select(F.col(key).cast("string").alias("key")).filter(F.col("key").isNotNull()).distinct().repartition(parallel, "key")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask, limiter, began = _load(transport), RateLimiter(per_second / parallel), time.monotonic()
        records = limited = failed = 0
        for b in batches:
            out = []
            for k in b["key"]:
                at = url.replace("{key}", k)
                stop = limits.reached(records, time.monotonic() - began, limited, failed)
                if stop:
                    out.append((k, at, None, None, 0, 0, 0, f"not asked: {stop}"))
                    continue
                limiter.wait()
                since = time.monotonic()
                got = fetch(ask, at, {}, rule)
                records, limited, failed = records + 1, limited + (got.status == 429), failed + (got.error is not None)
                out.append((k, at, got.status, got.body, int(got.error is None), int((time.monotonic() - since) * 1000), got.attempts, got.error))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in LOOKUP.split(", ")]).astype({"status": "Int64"})

    return wanted.mapInPandas(run, LOOKUP)
