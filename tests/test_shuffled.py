"""Tables that grow with the contigs never go whole through the driver: their joins are shuffled, however small they look."""

import re

from karyolytics.operators import intervals, run, scaffold
from karyolytics.plans import runs


def broadcast(df):
    """Keys of broadcast joins with a contig."""
    joins = re.findall(r"BroadcastHashJoin (\[.*?\])", df._jdf.queryExecution().sparkPlan().toString())
    return [j for j in joins if re.search(r"(contig|qseqid)#", j)]


def table(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_lift_is_shuffled(spark, tmp_path):
    """A contig is one short row and a row for each of its bins of positions."""
    pieces = table(spark, tmp_path / "pieces", [("a", "c", 0, 4_000_000, "s", 100, False)], "assembly string, contig string, c_start long, c_end long, scaffold string, s_start long, reversed boolean")
    features = table(spark, tmp_path / "features", [("a", "c", 150_000, 350_000, "+"), ("a", "d", 5, 9, "-")], "assembly string, contig string, start long, end long, strand string")
    got = scaffold.lift(features, pieces)
    assert sorted((r.contig, r.scaffold, r.s_start, r.s_end, r.s_strand) for r in got.collect()) == [("c", "s", 150_100, 350_100, "+"), ("d", "d", 5, 9, "-")]
    assert broadcast(got) == []


def test_overlaps_are_shuffled(spark, tmp_path):
    a = table(spark, tmp_path / "a", [("x", 0, 500_000)], "contig string, s long, e long")
    b = table(spark, tmp_path / "b", [("x", 250_000, 900_000)], "contig string, s2 long, e2 long")
    got = intervals.overlap_join(a, b, ["contig"], ("s", "e"), ("s2", "e2"))
    assert [r.overlap for r in got.collect()] == [250_000]
    assert broadcast(got) == []


def test_run_is_shuffled(spark, sf_dir, monkeypatch):
    plans, written = {}, run.written
    monkeypatch.setattr(runs, "_HELD", {})
    monkeypatch.setattr(run, "written", lambda df, name: plans.update({name: broadcast(df)}) or written(df, name))
    plans["lifted"] = broadcast(runs.scaffold_lifted(spark, sf_dir))
    assert {"ranks", "assignments", "chromosomes", "organelles", "rdna", "copies", "contaminants", "evidence", "report", "placed"} <= set(plans)
    assert {name: joins for name, joins in plans.items() if joins} == {}
