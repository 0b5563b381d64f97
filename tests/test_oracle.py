"""Every registered query against its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from tools.compare import digest

QUERIES = entry.queries()
ORACLE = {k: v for k, v in entry.oracle_sql().items() if not k.startswith("op")}  # those have tests of their own


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_every_query_has_oracle():
    from kpool.plans import queries as Q

    assert set(Q.QUERIES) == set(Q.ORACLE)


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 200
