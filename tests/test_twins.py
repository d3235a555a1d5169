"""Every query with a SQL twin gives the twin's rows on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from folioforge.plans import adopting, core, derived, library, operations, texts, work

DATA = "/root/testdata/sf0.001"
MODULES = [core, library, operations, texts, work, adopting, derived]
NAMES = [(m, n) for m in MODULES for n in m.ORACLES]

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def rows(df: pd.DataFrame) -> list:
    def cell(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "null"
        return repr(round(float(v), 6)) if type(v).__name__.startswith(("int", "float", "Decimal")) else str(v)

    return sorted(tuple(cell(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("module,name", NAMES, ids=[n for _, n in NAMES])
def test_twin(spark, duck, module, name):
    mine, twin = module.QUERIES[name](spark, DATA).toPandas(), duck.execute(module.ORACLES[name]).fetchdf()
    assert sorted(mine.columns) == sorted(twin.columns)
    assert rows(mine) == rows(twin)


def test_flagship(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
