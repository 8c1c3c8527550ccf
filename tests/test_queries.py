"""Every registered query against its SQL oracle (DuckDB) at sf0.001:
same columns, same row count, same order-insensitive value hash."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import compare  # noqa: E402
from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from purchlake.plans.catalog import PIPELINES  # noqa: E402
from purchlake.plans.operator_queries import OPERATORS  # noqa: E402

SF = "/root/testdata/sf0.001"
LIBRARY = {**PIPELINES, **OPERATORS}
NAMES = sorted(LIBRARY)


@pytest.fixture(scope="module")
def duck():
    return compare.duck(SF)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(oracle_sql()) and set(NAMES) <= set(queries())


def test_entry_smoke(spark):
    df = entry(spark)
    assert len(df.columns) == 75          # 76-column mart without the audit timestamp
    assert df.count() >= 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert compare.digest(df.columns, srows)[0] == compare.digest(ocols, orows)[0]
