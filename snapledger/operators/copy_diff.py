"""Differences between two copies of the same data, by content-defined chunks.

Each side is range-partitioned and sorted on its key.  A chunk ends where a
rolling hash over the last keys meets a condition, so equal stretches are cut
alike on both sides whatever was inserted elsewhere and wherever the ranges
begin.  Chunks are nested: the coarser conditions are multiples of the finer
ones.  Chunks whose fingerprint occurs on the other side are done, level by level; only
the rows of the finest chunks left over are joined and compared field by field.

Plan: repeated keys are merged with map-side combine, then the rows are brought
into key order; cutting is one pass over sorted Arrow batches, written out once.  Fingerprints of coarser
chunks are combined from the finest ones, so the rows are not looked at again.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from ..sources.tables import materialise, together

#: Average rows per chunk, from the coarsest to the finest; each a multiple of the next.
LEVELS = (64, 8, 2)
SEED = 2654435761
_MIX = np.uint64(0x9E3779B97F4A7C15)


def distinct_by_key(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row per key in key order; of rows that differ the highest values stand (NULL lowest), on both sides alike."""
    return (
        df.filter(F.col("key").isNotNull())
        .groupBy("key")  # combined before it moves, so a key repeated without end is a row per task
        .agg(F.max(F.struct(*fields)).alias("v"))
        .select("key", *[F.col(f"v.{f}").alias(f) for f in fields])
        .repartitionByRange("key")
        .sortWithinPartitions("key")
    )


def _rolling(hashes: np.ndarray, before: np.ndarray, window: int) -> np.ndarray:
    """Polynomial hash of the last ``window`` values at each place, the ones before the batch included."""
    padded = np.concatenate([before, hashes])
    out = np.zeros(len(hashes), dtype=np.uint64)
    for k in range(window):
        at = len(before) - k
        if at >= 0:
            part = padded[at : at + len(hashes)]
            out = out * _MIX + part
        else:  # the first rows of a range have fewer keys before them
            out = out * _MIX
            out[-at:] += padded[: len(hashes) + at] if len(hashes) + at > 0 else 0
    mixed = (out ^ (out >> np.uint64(29))) * _MIX
    return mixed ^ (mixed >> np.uint64(32))


def chunked(df: DataFrame, fields: Sequence[str], levels: Sequence[int] = LEVELS, window: int = 2) -> DataFrame:
    """``key``, the fields, two independent hashes ``h1, h2`` of the row and its chunk of each level ``c0, c1, ...``, written out."""
    if any(a % b for a, b in zip(levels, levels[1:], strict=False)):
        raise ValueError("each level must be a multiple of the next")
    ship(df.sparkSession)
    values = [x for f in fields for x in (F.isnull(f), F.col(f))]  # a missing value leaves a hash as it was: its mark does not
    rows = distinct_by_key(df, fields).select(
        "key", *fields, F.xxhash64("key", *values).alias("h1"), F.xxhash64(F.lit(SEED), *values, "key").alias("h2"), F.xxhash64("key").alias("__k")
    )
    names = [f"c{i}" for i in range(len(levels))]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = np.int64(TaskContext.get().partitionId()) << np.int64(40)
        before, ended = np.zeros(0, dtype=np.uint64), [0] * len(levels)
        for b in batches:
            if not b.num_rows:
                continue
            hashes = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False).view(np.uint64)
            rolled = _rolling(hashes, before, window)
            before = np.concatenate([before, hashes])[len(before) + len(hashes) - window + 1 :] if window > 1 else before
            chunks = []
            for i, rows_per in enumerate(levels):
                cuts = (rolled % np.uint64(rows_per) == 0).astype(np.int64)
                total = np.cumsum(cuts)
                chunks.append(pa.array(first + ended[i] + total - cuts, type=pa.int64()))  # the row that meets the condition is the chunk's last
                ended[i] += int(total[-1])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *chunks], names=[*b.schema.names[:-1], *names])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]), *(f"{n} bigint" for n in names)])
    return materialise(rows.mapInArrow(run, schema), "chunked")


_SAME = ["n", "f1", "f2", "lo", "hi"]


def _prints(of: DataFrame, by: Sequence[str], n="n", h1="f1", h2="f2", lo="lo", hi="hi") -> DataFrame:
    return of.groupBy(*by).agg(
        F.sum(n).alias("n"), F.bit_xor(h1).alias("f1"), F.bit_xor(h2).alias("f2"), F.min(lo).alias("lo"), F.max(hi).alias("hi")
    )


def _settle(left: DataFrame, right: DataFrame, n_levels: int) -> tuple[list[DataFrame], list[list[DataFrame]]]:
    """The finest chunks left over on each side, and those left after each level (all tables of chunks, not of rows)."""
    names = [f"c{i}" for i in range(n_levels)]
    spark = left.sparkSession
    open_ = together(
        spark, *[lambda side=side: materialise(_prints(side.withColumn("__n", F.lit(1)), names, "__n", "h1", "h2", "key", "key"), "fingerprints") for side in (left, right)]
    )
    history = [open_]
    for i in range(n_levels):
        coarse = [_prints(o, [names[i]]) for o in open_]
        left_over = [coarse[s].join(coarse[1 - s].select(*_SAME), _SAME, "left_anti").select(names[i]) for s in (0, 1)]
        open_ = together(spark, *[lambda o=open_[s], rest=left_over[s], c=names[i]: materialise(o.join(rest, c, "left_semi"), "open-chunks") for s in (0, 1)])
        history.append(open_)
    return open_, history


def copy_differences(
    left: DataFrame, right: DataFrame, fields: Sequence[str], *, left_only: str = "left_only", right_only: str = "right_only",
    levels: Sequence[int] = LEVELS, window: int = 2,
) -> DataFrame:
    """``key, difference``: which side alone has a key, or the name of each field that differs.

    Both sides hold ``key`` and ``fields`` in canonical writing; other columns are ignored.  Rows
    without a key are left out, repeated keys count once (:func:`distinct_by_key`), NULLs are equal and
    differ from the empty text.  An empty side makes every key of the other one-sided.
    """
    sides = together(left.sparkSession, *[lambda df=df: chunked(df, fields, levels, window) for df in (left, right)])
    open_, _ = _settle(*sides, len(levels))
    finest = f"c{len(levels) - 1}"
    a, b = (
        side.join(o.select(finest), finest, "left_semi").select("key", F.struct(*fields).alias(name)) for side, o, name in zip(sides, open_, "ab", strict=True)
    )
    found = F.when(F.col("b").isNull(), F.array(F.lit(left_only))).when(F.col("a").isNull(), F.array(F.lit(right_only)))
    differing = F.array_compact(F.array(*[F.when(~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")), F.lit(f)) for f in fields]))
    return a.join(b, "key", "full").select("key", F.explode(found.otherwise(differing)).alias("difference"))


def chunk_report(left: DataFrame, right: DataFrame, fields: Sequence[str], *, levels: Sequence[int] = LEVELS, window: int = 2) -> DataFrame:
    """``side, level_rows, chunks, open_chunks, n_rows, settled_rows``: how far the fingerprints of each level settled the rows."""
    sides = together(left.sparkSession, *[lambda df=df: chunked(df, fields, levels, window) for df in (left, right)])
    _, history = _settle(*sides, len(levels))
    out = None
    for s, name in enumerate(("left", "right")):
        whole = history[0][s].agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))
        for i, rows_per in enumerate(levels):
            before = history[0][s].agg(F.count_distinct(f"c{i}").alias("chunks"))
            after = history[i + 1][s].agg(F.count_distinct(f"c{i}").alias("open_chunks"), F.coalesce(F.sum("n"), F.lit(0)).alias("open_rows"))
            one = (
                whole.withColumn("one", F.lit(1)).join(before.withColumn("one", F.lit(1)), "one").join(after.withColumn("one", F.lit(1)), "one")
                .select(
                    F.lit(name).alias("side"), F.lit(rows_per).cast("bigint").alias("level_rows"), "chunks", "open_chunks", "n_rows",
                    (F.col("n_rows") - F.col("open_rows")).alias("settled_rows"),
                )
            )
            out = one if out is None else out.unionByName(one)
    return out
