"""The version cursor kept in the metadata text of a commit."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the field under which a commit carries its version.
CURSOR_FIELD = "ChangeTrackingVersion"


def cursor_json(version: Column) -> Column:
    """Metadata text for a version column; NULL for a NULL version."""
    return F.when(version.isNotNull(), F.to_json(F.struct(version.alias(CURSOR_FIELD))))


def cursor_version(metadata: Column) -> Column:
    """Version in a metadata text: the JSON field, or a bare number as older commits wrote it.

    Anything else (NULL, empty, other JSON) gives NULL.
    """
    digits = metadata.rlike("^[0-9]+$")
    text = F.when(digits, metadata).otherwise(F.get_json_object(metadata, f"$.{CURSOR_FIELD}"))
    return text.try_cast("long")


def cursor_text(version: int | None) -> str | None:
    """`cursor_json` for a driver-side value."""
    return None if version is None else json.dumps({CURSOR_FIELD: version}, separators=(",", ":"))


def parse_cursor(text: str | None) -> int | None:
    """`cursor_version` for a driver-side value."""
    if not text:
        return None
    if text.isascii() and text.isdigit():
        return int(text)
    try:
        value = json.loads(text).get(CURSOR_FIELD)
    except (ValueError, AttributeError):
        return None
    return None if value is None else int(value)
