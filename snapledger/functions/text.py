"""Null tokens, identifiers and numbers written as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing value, compared in lower case.
NULL_TOKENS = ("none", "nan", "nat")

#: Characters that count as surrounding blanks.
BLANKS = " \t\n\r\f\v "


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: Column | str) -> Column:
    return F.btrim(_col(c).cast("string"), F.lit(BLANKS))


def clean(c: Column | str) -> Column:
    """Trimmed text; NULL for NULL, blank and the texts of a null.

    Written so that the input occurs twice in the expression and no more: these builders nest, and
    copies of an input multiply in plans and in generated code.
    """
    return F.nullif(F.regexp_replace(trimmed(c), f"(?i)^(?:{'|'.join(NULL_TOKENS)})$", ""), F.lit(""))


def is_missing(c: Column | str) -> Column:
    """TRUE for NULL, blank and the texts of a null; never NULL itself."""
    return clean(c).isNull()


def normalise_id(c: Column | str) -> Column:
    """Trim, blank to NULL, and a trailing ``.0`` taken off (``-203.0`` to ``-203``)."""
    return F.regexp_replace(clean(c), r"\.0+$", "")


def number_text(c: Column | str) -> Column:
    """Canonical text of a number however written; other text unchanged.

    ``-203``, ``-203.0`` and `` -203 `` give the same text.  Missing gives NULL.
    """
    return F.coalesce(trimmed(c).try_cast("decimal(38,10)").cast("string"), clean(c))


def token_count(c: Column | str, sep: str = "|") -> Column:
    """Number of separated tokens: 0 for the empty text, NULL for NULL."""
    text = _col(c)
    return F.when(text == "", F.lit(0)).otherwise(
        F.length(text) - F.length(F.replace(text, F.lit(sep), F.lit(""))) + 1
    ).cast("bigint")


def changed_columns(pairs: Sequence[tuple[str, Column, Column]]) -> Column:
    """``|``-joined names of the pairs whose sides differ (NULLs are equal)."""
    return F.concat_ws("|", *[F.when(~a.eqNullSafe(b), F.lit(name)) for name, a, b in pairs])
