"""Each query with SQL gives the rows that DuckDB gives for it."""

import decimal
import os

import duckdb
import pytest

from karyolytics.config import DEFAULT
from karyolytics.operators.chaining import chain_numbers, kept_intervals
from karyolytics.operators.subgenome import fit, nearest
from karyolytics.plans import catalog, reports, runs  # noqa: F401


def shown(v):
    return "null" if v is None or v != v else f"{float(v):.9g}" if isinstance(v, (float, decimal.Decimal)) else str(v)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, sf_dir, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    rows = df.collect()
    if name not in catalog.SQL:
        return
    con = duckdb.connect()
    for t in os.listdir(sf_dir):
        con.execute(f"create view {t[:-8]} as select * from '{sf_dir}/{t}'")
    cur = con.execute(catalog.SQL[name])
    names = [c[0] for c in cur.description]
    order = sorted(df.columns)
    assert sorted(names) == order
    want = sorted(tuple(shown(r[names.index(c)]) for c in order) for r in cur.fetchall())
    assert sorted(tuple(shown(r[c]) for c in order) for r in rows) == want


def test_chains_open_and_join():
    near = [(0, 100, 0, 100), (150, 300, 150, 300), (500_000, 500_100, 500_000, 500_100)]
    assert chain_numbers(near, False, DEFAULT) == [0, 0, 1]
    # of two open chains the one of least penalty takes the block
    assert chain_numbers([(0, 10, 0, 10), (0, 20, 450_000, 450_020), (30, 40, 450_040, 450_050)], False, DEFAULT) == [0, 1, 1]


def test_overlap_suppression_keeps_first():
    assert kept_intervals([(0, 10), (5, 15), (10, 20), (19, 30), (20, 25), (3, 3)]) == [True, False, True, False, True, False]


def test_mixture_separates():
    means, *_ = fit([0.90, 0.901, 0.899, 0.98, 0.981, 0.979], 2)
    assert sorted(round(m, 2) for m in means) == [0.9, 0.98]
    assert nearest(0.5, [1.0, 0.0]) == 0
