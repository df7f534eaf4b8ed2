"""Every registered query of the layout engine: its SQL gives the same rows, or it gives rows."""

import math
from decimal import Decimal
from pathlib import Path

import pytest

from foliospark.plans import catalog, outlines, records, structure  # noqa: F401

D = "/root/testdata/sf0.001"


def normal(rows):
    cell = lambda x: "" if x is None or (isinstance(x, float) and math.isnan(x)) else f"{float(x):.6f}" if isinstance(x, (int, float, Decimal)) and not isinstance(x, bool) else str(x)
    return sorted(tuple(cell(x) for x in r) for r in rows)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in Path(D).glob("*.parquet"):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, D)
    assert len(set(got.columns)) == len(got.columns)
    if name in catalog.ORACLE_SQL:
        want = duck.sql(catalog.ORACLE_SQL[name])
        assert sorted(got.columns) == sorted(want.columns)
        assert normal(map(tuple, got.select(*want.columns).collect())) == normal(want.fetchall())
    else:
        got.collect()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
