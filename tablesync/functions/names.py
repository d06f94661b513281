"""Names of columns, keys and tables."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_name(name: str) -> str:
    """Column name without blanks, parentheses, dots and colons; anything else stays."""
    without_parens = re.sub(r"[()]", "", name)
    return re.sub(r"[\s.:]", "__", without_parens, flags=re.ASCII)


def slug(text: str, replacement: str = "_") -> str:
    """`text` with every non-word character replaced."""
    return re.sub(r"\W", lambda _: replacement, text, flags=re.ASCII)


def slug_column(column: Column, replacement: str = "_") -> Column:
    """`slug` for a column, lower-cased as in table names."""
    return F.lower(F.regexp_replace(column, r"\W", replacement))


def target_name(schema: str, table: str) -> str:
    """Directory and catalog name of the copy of `schema.table`."""
    return f"{slug(schema)}__{slug(table)}".lower()


def key_list(text: str | Iterable[str] | None) -> list[str]:
    """Column list from text such as `"no,[shop], 'x'"`, or from a sequence of names."""
    if text is None:
        return []
    if not isinstance(text, str):
        return [str(part) for part in text]
    parts = (part.strip() for part in re.sub(r"[\[\]']", "", text).split(","))
    return [part for part in parts if part]
