"""Column functions and the small name helpers shared by all operators."""

from tablesync.functions.cursor import cursor_json, cursor_version
from tablesync.functions.names import clean_name, key_list, slug, slug_column, target_name
from tablesync.functions.timestamps import date_to_instant, utc_wall_clock, wall_clock_to_instant

__all__ = [
    "clean_name",
    "cursor_json",
    "cursor_version",
    "date_to_instant",
    "key_list",
    "slug",
    "slug_column",
    "target_name",
    "utc_wall_clock",
    "wall_clock_to_instant",
]
