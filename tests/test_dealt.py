"""Tables are dealt to as many tasks as their rows need, and keep their results."""

import numpy as np
import pytest

from karyolytics.operators import compare, intervals, rdna
from karyolytics.plans import catalog, runs  # noqa: F401
from karyolytics.plans.adapters import view


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def few(spark, monkeypatch):
    """Tasks of a hundred rows."""
    monkeypatch.setattr(intervals, "ROWS", 100)


@pytest.mark.parametrize("name", ["interval_islands", "pair_evidence", "largest_cluster", "rearr_candidates", "gene_density_median", "ref_origin_split", "chain_greedy", "macro_blocks", "segments", "pairwise_synteny"])
def test_same_rows(spark, sf_dir, monkeypatch, name):
    whole = rows(catalog.QUERIES[name](spark, sf_dir))
    monkeypatch.setattr(intervals, "ROWS", 100)
    assert rows(catalog.QUERIES[name](spark, sf_dir)) == whole


@pytest.mark.parametrize("name", ["interval_islands", "pair_evidence", "largest_cluster", "ref_origin_split"])
def test_tasks_of_intervals(spark, sf_dir, few, name):
    n = view(spark, sf_dir, "kept").count()
    assert n > 3000
    assert catalog.QUERIES[name](spark, sf_dir).rdd.getNumPartitions() == -(-n // 100)


@pytest.mark.parametrize("name", ["macro_blocks", "segments"])
def test_tasks_of_chains(spark, sf_dir, few, name):
    n = view(spark, sf_dir, "kept").count()
    assert catalog.QUERIES[name](spark, sf_dir).rdd.getNumPartitions() == -(-n // 100)


def test_tasks_of_origins(spark, sf_dir, few):
    kept = view(spark, sf_dir, "kept")
    origins = kept.filter("qe - qs >= 9000").selectExpr("assembly", "contig", "ref_id as origin", "qs as s", "qe as e")
    got = compare.origin_segments(kept, origins)
    assert got.rdd.getNumPartitions() == -(-kept.count() // 100)


def test_small_tables_stay(spark):
    df = spark.range(50).selectExpr("id as k", "id as s", "id + 2 as e")
    assert intervals.tasks(df) == 1
    assert intervals.dealt(df, ["k"]) is df


@pytest.mark.parametrize("largest,size", [(0, 1), (255, 1), (256, 2), (65535, 2), (65536, 4), (0x10FFFF, 4), (1 << 32, 8)])
def test_narrow_numbers(largest, size):
    n = np.array([0, 7, largest])
    data = rdna.packed(n)
    assert len(data) == 1 + 3 * size and rdna.unpacked(data).tolist() == n.tolist()


def test_consensus_parts_are_small(spark):
    """Stretches of plain letters move at about a byte each, wide signs and many sequences keep their counts."""
    texts = ["ACGT" * 1024] * 3 + ["AC" * 2048] * 2
    got = rdna.column_consensus(spark.createDataFrame([("a", t) for t in texts] + [("b", "\U0001f600T")] * 300, "contig string, seq string"), "contig", "seq")
    assert {r.contig: r.consensus for r in got.collect()} == {"a": "ACGT" * 1024, "b": "\U0001f600T"}
    assert len(rdna.packed(np.frombuffer(texts[0].encode("utf-32-le"), "<u4"))) == 4097
