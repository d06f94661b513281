"""Query texts for a SQL Server source with change tracking, and their parameters.

Only text is built here; `tablesync.sources.jdbc` runs it.
"""

from __future__ import annotations

from collections.abc import Sequence

from tablesync.operators.changes import change_key
from tablesync.operators.predicates import CHANGE_OP

# Words that stand for a run's own values in a parameter list.
TABLE_PARAMETER = "defaultSQLTable"
LAST_PARAMETER = "queryCTLastVersion"
CURRENT_PARAMETER = "queryCTCurrentVersion"


def object_name(schema: str, table: str) -> str:
    """Bracketed two-part name."""
    return f"[{schema}].[{table}]"


def bind_version_params(
    params: Sequence[str], schema: str, table: str, last: int | None, current: int | None
) -> list[str]:
    """The parameter list with reserved words replaced; other entries pass through."""
    reserved = {
        TABLE_PARAMETER: object_name(schema, table),
        LAST_PARAMETER: last,
        CURRENT_PARAMETER: current,
    }
    unknown = [param for param in params if param in reserved and reserved[param] is None]
    if unknown:
        raise ValueError(f"not known at this point of a run: {unknown}")
    return [str(reserved.get(param, param)) for param in params]


def render_call(query: str, params: Sequence[str]) -> str:
    """`query` with its `?` markers replaced in order by literals.

    Whole numbers are written bare, anything else as an escaped text literal.
    """
    pieces = query.split("?")
    if len(pieces) - 1 != len(params):
        raise ValueError(f"{len(pieces) - 1} markers but {len(params)} parameters")
    text = pieces[0]
    for param, piece in zip(params, pieces[1:]):
        is_number = param.lstrip("-").isdigit()
        text += (param if is_number else "'" + param.replace("'", "''") + "'") + piece
    return text


def current_version_query() -> str:
    """Latest change version of the database."""
    return "select change_tracking_current_version() as current_version"


def min_valid_version_query(schema: str, table: str) -> str:
    """Oldest version from which changes of the table can still be listed."""
    name = object_name(schema, table).replace("'", "''")
    return f"select change_tracking_min_valid_version(object_id('{name}')) as min_valid_version"


def table_query(schema: str, table: str) -> str:
    """The whole table; filters are added by Spark's pushdown."""
    return f"select * from {object_name(schema, table)}"


def changes_query(
    schema: str, table: str, keys: Sequence[str], last: int, current: int
) -> str:
    """Net changes after `last` up to `current`, joined with the rows as they are now.

    The change side is the preserved one, so deleted rows come with NULL base columns. The
    version limit acts on the net change of a key.
    """
    name = object_name(schema, table)
    key_columns = ", ".join(f"changed.[{key}] as [{change_key(key)}]" for key in keys)
    same_key = " and ".join(f"base.[{key}] = changed.[{key}]" for key in keys)
    return (
        f"select base.*, changed.SYS_CHANGE_OPERATION as [{CHANGE_OP}], {key_columns} "
        f"from changetable(changes {name}, {last}) as changed "
        f"left join {name} as base on {same_key} "
        f"where changed.SYS_CHANGE_VERSION <= {current}"
    )
