"""Column builders; everything here stays inside whole-stage codegen."""

from .keys import code_key, composite_key, labelled_key, row_hash, uuid_key
from .text import changed_columns, clean, is_missing, normalise_id, number_text, token_count
from .time import day_of, ulid_day, ulid_millis, ulid_timestamp

__all__ = [
    "changed_columns", "clean", "code_key", "composite_key", "day_of", "is_missing", "labelled_key",
    "normalise_id", "number_text", "row_hash", "token_count", "ulid_day", "ulid_millis",
    "ulid_timestamp", "uuid_key",
]
