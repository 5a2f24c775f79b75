import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[8]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *columns):
    """The rows of ``df`` as sorted tuples."""
    found = [tuple(r[c] for c in columns) if columns else tuple(r) for r in df.collect()]
    return sorted(found, key=repr)


@pytest.fixture(scope="session")
def oracle():
    """Compares a query with its SQL on a folder of test data."""
    import datetime
    import glob
    import os

    import duckdb

    def norm(values):
        def one(v):
            if isinstance(v, float):
                return round(v, 6)
            return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v

        return sorted(repr(tuple(map(one, r))) for r in values)

    connections = {}

    def compare(name, result, sql, folder):
        if folder not in connections:
            con = connections[folder] = duckdb.connect()
            for p in glob.glob(f"{folder}/*.parquet"):
                con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
        con = connections[folder]
        names, found = result
        columns = sorted(names)
        got = norm(tuple(r[names.index(c)] for c in columns) for r in found)
        con.execute(sql)
        there = [d[0] for d in con.description]
        assert sorted(there) == columns
        want = norm(tuple(r[there.index(c)] for c in columns) for r in con.fetchall())
        assert got == want, f"{name}: {set(got) ^ set(want)}"

    return compare


@pytest.fixture(scope="session")
def run_queries():
    """Runs queries several at a time, as each is small; gives columns and rows by name, or raises what one raised."""
    from concurrent.futures import ThreadPoolExecutor

    def run(spark, queries, folder):
        def one(query):
            df = query(spark, folder)
            return df.columns, df.collect()

        with ThreadPoolExecutor(6) as pool:
            return {n: pool.submit(one, q) for n, q in queries.items()}

    return run
