import datetime as dt
import string

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablesync.functions import (
    clean_name,
    cursor_json,
    cursor_version,
    date_to_instant,
    key_list,
    slug,
    target_name,
    utc_wall_clock,
    wall_clock_to_instant,
)
from tablesync.functions.cursor import cursor_text, parse_cursor
from tablesync.functions.names import slug_column


SPACE = " \t\n\x0b\x0c\r"
WORDLIKE = "abcXYZ019_"
names = st.text(alphabet=st.one_of(st.sampled_from("()" + ".:" + SPACE + WORDLIKE), st.characters(codec="utf-8")), max_size=40)


@given(names)
def test_clean_name_character_by_character(name):
    """Round brackets vanish, white space, dots and colons double an underscore, the rest stays in place."""
    expected = ""
    for c in name:
        if c in "()":
            continue
        expected += "__" if c in SPACE + ".:" else c
    assert clean_name(name) == expected
    assert clean_name(clean_name(name)) == clean_name(name)


@pytest.mark.parametrize("signs, cleaned", [("..", "____"), (":)", "__"), ("((", ""), ("% of $", "%__of__$"), ("größe.m²", "größe__m²"), ("1st:", "1st__"), ("\u00a0x", "\u00a0x")])
def test_clean_name_of_signs_digits_and_other_letters(signs, cleaned):
    assert clean_name(signs) == cleaned


@given(names, st.sampled_from(["", "_", "-", "\\1", "__"]))
def test_slug_replaces_each_sign_alone(text, replacement):
    letters = set(string.ascii_letters + string.digits + "_")
    assert slug(text, replacement) == "".join(c if c in letters else replacement for c in text)


@pytest.mark.parametrize(
    "schema, table, name",
    [
        ("dbo", "T", "dbo__t"),
        ("", "loose", "__loose"),
        ("Archive.2019", "Order-Lines (old)", "archive_2019__order_lines__old_"),
        ("ünï", "9lives", "_n___9lives"),
        ("a__b", "c", "a__b__c"),
    ],
)
def test_target_names(schema, table, name):
    assert target_name(schema, table) == name


def test_slug_column_equals_slug(spark):
    texts = ["Mixed CASE", "--", "tail!", "", "x" * 50]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select("t", slug_column(F.col("t")).alias("s"))
    assert all(r.s == slug(r.t).lower() for r in found.collect())


@given(st.lists(st.text(alphabet="abc xyz_9é", min_size=1).map(str.strip).filter(bool), max_size=5), st.sampled_from(["{}", "[{}]", "'{}'", "  {} ", "['{}' ]"]))
def test_key_list_reads_what_is_written(keys, form):
    assert key_list(", ".join(form.format(key) for key in keys)) == keys
    assert key_list(",,".join(form.format(key) for key in keys) + ",") == keys
    assert key_list(tuple(keys)) == keys


def test_key_list_of_nothing():
    assert key_list(None) == key_list("") == key_list(" , [ ],''") == []


def test_cursor_forms(spark):
    texts = ['{"ChangeTrackingVersion":42}', "17", "", None, "{}", "x", "-3", '{"ChangeTrackingVersion":null}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    versions = [r.v for r in df.orderBy("i").select(cursor_version(F.col("t")).alias("v")).collect()]
    assert versions == [42, 17, None, None, None, None, None, None]
    assert [parse_cursor(t) for t in texts] == versions
    written = spark.range(2).select(cursor_json(F.when(F.col("id") == 1, 99)).alias("t")).collect()
    assert [r.t for r in written] == [None, cursor_text(99)]


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York", "Europe/Kiev"])
def test_wall_clock_does_not_depend_on_session_zone(spark, session_zone):
    walls = ["2022-03-29 00:30:00", "2022-01-15 12:00:00.123456", "2022-03-13 02:30:00"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        df = spark.createDataFrame([(w,) for w in walls], "w string").select(
            F.col("w").cast("timestamp_ntz").alias("w")
        )
        instant = wall_clock_to_instant(F.col("w"), "Europe/Kiev")
        found = {
            r.w: (r.u, r.m)
            for r in df.select(
                "w",
                utc_wall_clock(instant).alias("u"),
                F.unix_micros(date_to_instant(F.to_date("w"), "Europe/Kiev")).alias("m"),
            ).collect()
        }
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found[dt.datetime(2022, 3, 29, 0, 30)][0] == dt.datetime(2022, 3, 28, 21, 30)
    assert found[dt.datetime(2022, 1, 15, 12, 0, 0, 123456)][0] == dt.datetime(2022, 1, 15, 10, 0, 0, 123456)
    assert found[dt.datetime(2022, 3, 13, 2, 30)][0] == dt.datetime(2022, 3, 13, 0, 30)
    midnight = dt.datetime(2022, 3, 28, 21, tzinfo=dt.timezone.utc)
    assert found[dt.datetime(2022, 3, 29, 0, 30)][1] == int(midnight.timestamp()) * 10**6
