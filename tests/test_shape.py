import datetime as dt
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampType

from conftest import rows
from tablesync.operators.shape import (
    INGESTED_AT,
    add_generated_column,
    add_ingestion_time,
    clean_column_names,
    date_to_timestamp,
    partition_timestamp_to_date,
    shape,
)

UTC = dt.timezone.utc


@pytest.fixture
def events(table):
    """The event log with a name that needs cleaning and a column of every kind that is cast."""
    return table("events").withColumns({
        "day. seen": F.to_date("ts"),
        "stored": F.col("ts").cast("timestamp"),
        "nested": F.struct(F.to_date("ts").alias("date"), "user_id"),
    })


def epochs(df, *columns):
    """Instants as microseconds, so that no session zone is involved."""
    return df.select(*[F.unix_micros(c) if isinstance(df.schema[c].dataType, TimestampType) else c for c in columns])


def test_renamed_columns_hold_the_same_values(table):
    orders = table("orders").limit(50)
    odd = orders.toDF("o(k)", "cust.key", ":status", "total price", "()", "prio\trity")
    cleaned = clean_column_names(odd)
    assert cleaned.columns == ["ok", "cust__key", "__status", "total__price", "", "prio__rity"]
    assert rows(cleaned) == rows(odd)


def test_shape_of_the_event_log(events):
    """Every column of the result, computed row by row from the source in plain Python."""
    shaped = shape(events, "America/St_Johns", ["day. seen"], ("hour_of", "hour(ts)", "smallint"))
    kinds = {f.name: f.dataType.simpleString() for f in shaped.schema}
    assert list(kinds) == [INGESTED_AT, *("event_id", "ts", "user_id", "event_type", "value", "props"), "day____seen", "stored", "nested", "hour_of"]
    assert kinds["ts"] == kinds["stored"] == kinds[INGESTED_AT] == "timestamp"
    assert (kinds["day____seen"], kinds["hour_of"]) == ("date", "smallint")
    assert kinds["nested"] == events.schema["nested"].dataType.simpleString()
    zone = ZoneInfo("America/St_Johns")
    source = {r.event_id: r for r in events.collect()}
    for event_id, seen, day, hour in epochs(shaped, "event_id", "ts", "day____seen", "hour_of").collect():
        wall = source[event_id].ts
        instant = wall.replace(tzinfo=zone).astimezone(UTC)
        assert seen == (instant - dt.datetime(1970, 1, 1, tzinfo=UTC)) // dt.timedelta(microseconds=1)
        assert (day, hour) == (wall.date(), wall.hour)
    assert shaped.where("stored <> ts").count() == 0
    assert shaped.select(INGESTED_AT).distinct().count() == 1


def test_dates_become_midnights(spark):
    df = spark.sql("select explode(sequence(date'2023-10-27', date'2023-11-08')) as d, 5 as n")
    at = {r[0]: r[1] for r in df.select("d").join(
        date_to_timestamp(df, "Europe/Kiev").select(F.col("d").alias("t")), F.to_date(F.col("t") + F.expr("interval 12 hours")) == F.col("d")
    ).select("d", F.unix_seconds("t")).collect()}
    zone = ZoneInfo("Europe/Kiev")
    assert len(at) == 13 and all(dt.datetime(d.year, d.month, d.day, tzinfo=zone).timestamp() == s for d, s in at.items())
    assert date_to_timestamp(df).schema["n"].dataType == df.schema["n"].dataType


def test_shape_is_one_projection_over_the_source(events):
    plan = shape(events.drop("day. seen"), "Asia/Tokyo", ["ts"], ("g", "user_id % 10", "int"))._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("Project") == 1


@pytest.mark.parametrize("data_type, expected", [("string", "7"), ("double", 7.0), ("boolean", True), ("date", None), ("decimal(3,2)", 7), ("decimal(2,2)", None)])
def test_generated_value_is_cast_and_null_where_it_does_not_fit(spark, data_type, expected):
    df = add_generated_column(spark.range(1), "made", "'7'" if data_type != "boolean" else "7", data_type)
    assert df.first().made == expected and df.columns == ["id", "made"]


def test_generated_column_takes_the_place_of_one_of_its_name(table):
    nation = table("nation")
    df = add_generated_column(nation, "n_name", "concat_ws('/', n_regionkey, upper(n_name))", "string")
    assert df.columns == nation.columns
    assert rows(df.select("n_name")) == sorted((f"{r.n_regionkey}/{r.n_name.upper()}",) for r in nation.collect())


def test_generated_times_are_shifted_like_any_other(table):
    orders = table("orders").limit(5)
    shaped = shape(orders, "Asia/Tokyo", generated=("copy", "o_orderdate", "timestamp_ntz"), ingestion_time=False)
    assert shaped.where("copy = o_orderdate").count() == 5 and isinstance(shaped.schema["copy"].dataType, TimestampType)


def test_ingestion_time_comes_first_and_once(table):
    region = table("region").withColumn(INGESTED_AT.upper(), F.lit("old"))
    moment = F.lit(dt.datetime(2020, 2, 29, 12))
    df = add_ingestion_time(region, moment)
    assert df.columns == [INGESTED_AT, *table("region").columns]
    assert {r[0] for r in df.collect()} == {dt.datetime(2020, 2, 29, 12)}
    assert INGESTED_AT not in shape(table("region"), "UTC", ingestion_time=False).columns


@pytest.mark.parametrize("hour, local, utc", [(0, 15, 14), (8, 15, 14), (9, 15, 15), (23, 15, 15)])
def test_partition_date_is_the_sources_or_utcs(spark, hour, local, utc):
    df = spark.sql(f"select timestamp_ntz'2021-08-15 {hour:02d}:59:59.999999' as at, array(1) as other")
    days = [shape(df, "Asia/Tokyo", ["AT"], ingestion_time=False, partition_date=way).first().at.day for way in ("local", "utc")]
    assert days == [local, utc]
    with pytest.raises(ValueError):
        shape(df, "Asia/Tokyo", ["at"], partition_date="source")


def test_only_times_among_partition_columns_become_dates(events):
    df = partition_timestamp_to_date(events, ["STORED", "user_id", "absent"])
    changed = [f.name for f, g in zip(df.schema, events.schema, strict=True) if f.dataType != g.dataType]
    assert changed == ["stored"] and isinstance(df.schema["stored"].dataType, DateType)
