import re

import pytest

from tablesync.sources import change_sql

TABLES = [("dbo", "Events", ["id"]), ("hr", "Shift Plan", ["site", "day", "shift"]), ("x", "Order", ["order", "line"])]


@pytest.mark.parametrize("schema, table, keys", TABLES)
def test_changes_query_by_its_parts(schema, table, keys):
    text = change_sql.changes_query(schema, table, keys, 10**12, 10**12 + 1)
    name = f"[{schema}].[{table}]"
    selected, source, joined, limit = re.fullmatch(r"select (.*) from (.*) left join (.*) where (.*)", text).groups()
    assert selected.split(", ") == ["base.*", "changed.SYS_CHANGE_OPERATION as [_op]", *(f"changed.[{k}] as [_pk_{k}]" for k in keys)]
    # the change side is kept, so rows that are gone come without base columns
    assert source == f"changetable(changes {name}, {10**12}) as changed"
    table_part, _, condition = joined.partition(" on ")
    assert table_part == f"{name} as base"
    assert condition.split(" and ") == [f"base.[{k}] = changed.[{k}]" for k in keys]
    assert limit == f"changed.SYS_CHANGE_VERSION <= {10**12 + 1}"


def test_version_queries_are_scalars_and_escape_names():
    assert re.match(r"select \w+\(\) as current_version$", change_sql.current_version_query())
    for schema, table, _ in TABLES:
        assert f"object_id('[{schema}].[{table}]')" in change_sql.min_valid_version_query(schema, table)
    assert "[it''s].[t]" in change_sql.min_valid_version_query("it's", "t")


@pytest.mark.parametrize(
    "params, bound",
    [
        ([], []),
        (["plain", "", "5"], ["plain", "", "5"]),
        (["queryCTLastVersion", "queryCTLastVersion"], ["0", "0"]),
        (["defaultSQLTable", "N'x'"], ["[hr].[Plan]", "N'x'"]),
        (["queryCTCurrentVersion", "QueryCTCurrentVersion"], ["9000000000", "QueryCTCurrentVersion"]),
    ],
)
def test_reserved_words_are_bound_wherever_they_stand(params, bound):
    assert change_sql.bind_version_params(params, "hr", "Plan", 0, 9_000_000_000) == bound


@pytest.mark.parametrize("word", ["queryCTLastVersion", "queryCTCurrentVersion"])
def test_a_version_that_is_not_known_yet_is_an_error(word):
    with pytest.raises(ValueError, match=word):
        change_sql.bind_version_params(["1", word], "hr", "Plan", None, None)
    assert change_sql.bind_version_params(["1"], "hr", "Plan", None, None) == ["1"]


@pytest.mark.parametrize(
    "query, params, text",
    [
        ("exec p", [], "exec p"),
        ("f(?)", ["-12"], "f(-12)"),
        ("f(?,?,?)", ["a?b", "''", "1.5"], "f('a?b','''''','1.5')"),
        ("?", [""], "''"),
    ],
)
def test_rendered_literals(query, params, text):
    assert change_sql.render_call(query, params) == text


@pytest.mark.parametrize("query, params", [("select ?", []), ("select 1", ["1"]), ("? ?", ["1"])])
def test_markers_and_parameters_must_agree(query, params):
    with pytest.raises(ValueError):
        change_sql.render_call(query, params)
