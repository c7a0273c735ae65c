"""Registered queries against their SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from folium import catalog

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for p in Path(SMALL).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def norm(v):
    return float(f"{v:.9g}") if isinstance(v, float) and not math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, con, name):
    frame = catalog.queries()[name](spark, SMALL)
    columns = sorted(frame.columns)
    got = sorted(repr([norm(v) for v in r]) for r in frame.select(*columns).collect())
    assert got
    if sql := catalog.oracle_sql().get(name):
        names = ", ".join(f'"{c}"' for c in columns)
        assert got == sorted(repr([norm(v) for v in r]) for r in con.sql(f"select {names} from ({sql.strip()})").fetchall())


def test_toc_gaps_looks_for_headings_once(spark):
    """Entries and sections come from one stored pass over the documents."""
    plan = catalog.queries()["toc_gaps"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "posexplode" not in plan
