"""Choosing columns and tables whose names changed over time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import path_exists


def first_existing(df: DataFrame, names: Sequence[str]) -> str | None:
    """The frame's own writing of the first name it has, letter case ignored."""
    have = {c.lower(): c for c in df.columns}
    return next((have[n.lower()] for n in names if n.lower() in have), None)


def column_or_null(df: DataFrame, names: Sequence[str], kind: str = "string") -> Column:
    found = first_existing(df, names)
    return F.col(f"`{found}`") if found else F.lit(None).cast(kind)


def canonical(df: DataFrame, synonyms: Mapping[str, Sequence[str]], kinds: Mapping[str, str] | None = None) -> DataFrame:
    """The canonical columns in order, each from the first of its synonyms the frame has, typed or NULL.

    What does not read as its type becomes NULL.
    """
    kinds = kinds or {}
    out = []
    for name, others in synonyms.items():
        c = column_or_null(df, [name, *others], kinds.get(name, "string"))
        out.append((c.try_cast(kinds[name]) if name in kinds else c).alias(name))
    return df.select(out)


def coalesce_legacy(df: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    """New columns filled from their legacy ones where empty; the legacy ones go."""
    out = []
    for c in df.columns:
        if c in pairs.values():
            continue
        old = pairs.get(c)
        out.append(F.coalesce(F.col(c), F.col(old)).alias(c) if old in df.columns else F.col(c))
    known = set(df.columns)
    out += [F.col(o).alias(n) for n, o in pairs.items() if n not in known and o in known]
    return df.select(out)


def read_first(spark: SparkSession, root: str, names: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame | None:
    """The first of the named tables that exists, narrowed to the columns it has of those asked for."""
    for n in names:
        for path in (f"{root}/{n}.parquet", f"{root}/{n}"):
            if path_exists(spark, path):
                df = spark.read.parquet(path)
                return df.select(*[c for c in columns if c in df.columns]) if columns else df
    return None


def copy_tables(spark: SparkSession, source: str, target: str, names: Sequence[str]) -> dict[str, str]:
    """Copy tables to an export root; a failed one is reported and does not stop the others."""
    out = {}
    for n in names:
        try:
            df = read_first(spark, source, [n])
            if df is None:
                out[n] = "missing"
                continue
            df.write.mode("overwrite").parquet(f"{target}/{n}")
            out[n] = "copied"
        except Exception as e:  # an export must not fail the run
            out[n] = f"failed: {type(e).__name__}"
    return out


def json_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """sha256 of a row as JSON with its keys in order; missing values are left out of the text."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(columns)])), 256)
