"""The driver's contract: every registered query of the engine on the small
tables, against its DuckDB twin where it has one."""

import decimal
import math
import re
from collections import Counter
from pathlib import Path

import __spark_entry__ as entry
import duckdb
import pytest
from marginalia.plans import catalogue

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
there = pytest.mark.skipif(not Path(SMALL).exists(), reason="the driver's tables are absent")


def test_names():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 200
    assert set(catalogue.QUERIES) <= set(queries)


def test_optional_parts_are_looked_for_and_not_guessed(monkeypatch):
    """A missing subpackage leaves the other queries; a broken one is an error."""
    monkeypatch.setattr(entry.importlib.util, "find_spec", lambda name: None)
    assert set(entry.queries()) == set(catalogue.QUERIES)
    monkeypatch.undo()

    def broken(name):
        raise ImportError("a library is missing")

    monkeypatch.setattr(entry.importlib.util, "find_spec", lambda name: object())
    monkeypatch.setattr(entry.importlib, "import_module", broken)
    with pytest.raises(ImportError, match="library"):
        entry.queries()


@there
def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return None if math.isnan(v) else round(float(v), 6) + 0.0
    if isinstance(v, bool) or v is None:
        return v
    return float(v) if isinstance(v, int) else tuple(map(plain, v)) if isinstance(v, (list, tuple)) else str(v)


@there
@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert got
    if name in catalogue.ORACLE_SQL:
        found = duck.execute(catalogue.ORACLE_SQL[name])
        names = [d[0] for d in found.description]
        assert sorted(names) == columns
        at = [names.index(c) for c in columns]
        assert got == Counter(tuple(plain(row[i]) for i in at) for row in found.fetchall())


def test_no_query_takes_a_subset():
    """No limits, samples or id filters in the queries' own code."""
    for path in Path(catalogue.__file__).parent.glob("*.py"):
        for call in re.findall(r"\.(?:sample|limit)\([^)]*\)", path.read_text()):
            assert call in (".limit(0)", ".limit(1)"), (path.name, call)  # schemas and constants only
