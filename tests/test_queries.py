"""Every core query against its SQL on the smallest tables, as the driver compares them."""

import decimal
import math
import sys
from pathlib import Path

import duckdb
import pytest

from inkwell.plans import registry

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return [plain(x) for x in v] if isinstance(v, list | tuple) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, str(DATA))
    cols = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in cols]) for r in df.collect())
    sql = registry.oracle_sql().get(name)
    if sql is None:
        return
    cur = duck.execute(sql)
    at = [c[0] for c in cur.description]
    assert sorted(at) == cols
    assert got == sorted(repr([plain(r[at.index(c)]) for c in cols]) for r in cur.fetchall())


def test_the_core_needs_no_subpackage(monkeypatch):
    for m in [m for m in sys.modules if m.startswith("inkwell.llm")]:
        monkeypatch.delitem(sys.modules, m)
    for path in Path(registry.__file__).parents[1].rglob("*.py"):
        if "llm" not in path.parts:
            assert "inkwell.llm" not in path.read_text(), path
