"""Every registered query against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

from quillmill.plans import registry

SF = "/root/testdata/sf0.001"


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)) or type(value).__name__ == "NAType":
        return None
    value = value.item() if hasattr(value, "item") else value
    return round(float(value), 9) if isinstance(value, (int, float)) and not isinstance(value, bool) else value


def bag(frame):
    columns = sorted(frame.columns)
    return columns, sorted(repr(tuple(plain(v) for v in row)) for row in frame[columns].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    if name in registry.ORACLE:
        assert bag(got) == bag(duck.sql(registry.ORACLE[name]).df())
    else:
        assert len(got)
