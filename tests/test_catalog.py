"""Every query against its SQL in another engine; those without SQL give rows of a stable schema."""

import os

import duckdb
import pytest

from strandline import registry


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
    return con


def norm(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    text = lambda v: f"{v:.7g}" if isinstance(v, float) else str(v)
    return sorted(tuple(text(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_matches_sql(spark, sf, duck, name):
    df = registry.QUERIES[name](spark, sf)
    result = duck.execute(registry.SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(names)
    expected = norm(result.fetchall(), names)
    assert norm(df.collect(), df.columns) == expected


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_gives_rows(spark, sf, name):
    assert registry.QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_best_slope_ties_as_in_sql(spark, tmp_path):
    # three transects of sf0.1 have slopes whose energies are equal to the SQL's 5 digits
    events = spark.read.parquet("/root/testdata/sf0.1/events.parquet").where("user_id IN (354, 860, 936)")
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    df = registry.QUERIES["t13_o3_best_slope"](spark, str(tmp_path))
    result = con.execute(registry.SQL["t13_o3_best_slope"])
    names = [c[0] for c in result.description]
    expected = norm(result.fetchall(), names)
    assert len(expected) == 3 and norm(df.collect(), df.columns) == expected
