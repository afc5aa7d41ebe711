"""Keys and hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, clean


def uuid_key(c: Column | str) -> Column:
    """One writing of a uuid: lower case, hyphens at 8-4-4-4-12 whether or not they were written.

    A text that is no uuid keeps its lower-case writing; missing is NULL.
    """
    groups = "-?".join(f"([0-9a-f]{{{n}}})" for n in (8, 4, 4, 4, 12))
    return F.regexp_replace(F.lower(clean(c)), f"^{groups}$", "$1-$2-$3-$4-$5")


def code_key(c: Column | str) -> Column:
    """Trimmed and in upper case; missing is NULL."""
    return F.upper(clean(c))


def composite_key(cols: Sequence[Column | str]) -> Column:
    """Columns joined by ``|`` with missing parts as the empty text."""
    return F.concat_ws("|", *[F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols])


def labelled_key(names: Sequence[str]) -> Column:
    """``ID=|1|CODE=|x``: each name followed by its value; NULL values are left out."""
    parts: list[Column] = []
    for name in names:
        parts += [F.lit(f"{name}="), F.col(name).cast("string")]
    return F.concat_ws("|", *parts)


def row_hash(names: Sequence[str]) -> Column:
    """md5 over the name-sorted columns, NULL and '' alike."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(n).cast("string"), F.lit("")) for n in sorted(names)]))
