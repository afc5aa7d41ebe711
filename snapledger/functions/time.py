"""Days and ULID time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean, trimmed

# The ULID alphabet and the digits of base 32.
CROCKFORD = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"
BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def day_of(c: Column | str) -> Column:
    """``YYYY-MM-DD`` of a date or time text; NULL if it names no day.

    Reads ``2025-02-03``, ``20250203``, ``2025-02-03 00:00:00 UTC`` and ``2025-02-03T00:00:00Z``.
    """
    iso = F.regexp_replace(trimmed(c), r"^(\d{4})-(\d{2})-(\d{2})[T ].*$|^(\d{4})(\d{2})(\d{2})$", "$1$4-$2$5-$3$6")
    return F.when(iso.rlike(r"^\d{4}-\d{2}-\d{2}$"), iso).try_cast("date").cast("string")


def ulid_millis(c: Column | str) -> Column:
    """Milliseconds since the epoch of a ULID in any case; NULL if it is none."""
    head = F.substring(F.upper(clean(c)), 1, 10)
    digits = F.translate(head, CROCKFORD, BASE32)
    return F.when(head.rlike(f"^[{CROCKFORD}]{{10}}$"), F.conv(digits, 32, 10).try_cast("bigint"))


def ulid_timestamp(c: Column | str) -> Column:
    return F.timestamp_millis(ulid_millis(c))


def ulid_day(c: Column | str) -> Column:
    """UTC day of a ULID, taken from the milliseconds, whatever the session's time zone."""
    days = F.floor(ulid_millis(c) / F.lit(86_400_000)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days).cast("string")
