"""Compare registered queries with their SQL: `python tests/oracle.py [sf] [name …]`."""

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402


TYPES = {
    "string": "varchar",
    "int": "integer",
    "timestamp_ntz": "timestamp",
    "array<string>": "varchar[]",
}


def connect(sf_dir):
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (dt.datetime, dt.date, decimal.Decimal)):
        return str(value)
    return value


def canonical(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(
        (tuple(plain(record[i]) for i in order) for record in records), key=repr
    )


def compare(spark, connection, sf_dir, query, sql):
    """None if both sides agree, else a description of the difference."""
    df = query(spark, sf_dir)
    ours = canonical(df.columns, [tuple(row) for row in df.collect()])
    cursor = connection.execute(sql)
    sql_types = {c[0]: str(c[1]).upper() for c in cursor.description}
    theirs = canonical([c[0] for c in cursor.description], cursor.fetchall())
    for field in df.schema:
        ours_type = TYPES.get(field.dataType.simpleString(), field.dataType.simpleString()).upper()
        if field.name in sql_types and sql_types[field.name] != ours_type:
            return f"type of {field.name}: {ours_type} / {sql_types[field.name]}"
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} / {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows / {len(theirs[1])}"
    for a, b in zip(ours[1], theirs[1]):
        if a != b:
            return f"{a} / {b}"
    return None if ours[1] else "no rows"


def main():
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf_dir = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", os.environ.get("CHECK_TZ", "UTC"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            problem = compare(spark, connection, sf_dir, queries[name], sqls[name])
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
