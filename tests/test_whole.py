"""Queries that read all of their input; the expected rows come from loops in Python or from DuckDB without any cut."""

import os
from collections import Counter, defaultdict

import duckdb

from karyolytics.operators import rdna
from karyolytics.plans import catalog
from karyolytics.plans.adapters import view


def consensus(seqs):
    """The most frequent base of columns that half of all sequences have a base in."""
    lower = str.maketrans("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    seqs, out = [x.translate(lower) for x in seqs], ""
    for i in range(max(map(len, seqs))):
        votes = Counter(x[i] for x in seqs if i < len(x) and x[i] not in "-.")
        if sum(votes.values()) >= max(1, len(seqs) // 2):
            out += min(votes, key=lambda v: (-votes[v], ord(v)))
    return out


def test_consensus_of_all_columns(spark, sf_dir):
    by_contig = defaultdict(list)
    for r in view(spark, sf_dir, "seqs").select("assembly", "contig", "seq").collect():
        by_contig[f"{r.assembly}:{r.contig}"].append(r.seq)
    assert max(len(x) for v in by_contig.values() for x in v) > 1000
    got = {r.contig: r.consensus for r in catalog.QUERIES["column_consensus"](spark, sf_dir).collect()}
    assert got == {k: consensus(v) for k, v in by_contig.items()}


def test_consensus_after_column_60(spark):
    rows = [("a", "A" * 60 + "CG-T"), ("a", "A" * 60 + "CG-A"), ("a", "A" * 60 + "CT-"), ("b", "ACGT" * 500)]
    got = rdna.column_consensus(spark.createDataFrame(rows, "contig string, seq string"), "contig", "seq").collect()
    assert {r.contig: r.consensus for r in got} == {"a": "A" * 60 + "CGA", "b": "ACGT" * 500}


def uncut(sf_dir, name, cut):
    """Rows of the query's SQL without its modulo filter."""
    con = duckdb.connect()
    for t in os.listdir(sf_dir):
        con.execute(f"create view {t[:-8]} as select * from '{sf_dir}/{t}'")
    cur = con.execute(catalog.SQL[name].replace(cut, ""))
    names = [c[0] for c in cur.description]
    return [dict(zip(names, r)) for r in cur.fetchall()]


def test_origins_of_all_order_keys(spark, sf_dir):
    want = uncut(sf_dir, "ref_origin_split", " WHERE l_orderkey % 5 = 0")
    assert {r["block_id"] // 1000 % 5 for r in want} == {0, 1, 2, 3, 4}
    got = catalog.QUERIES["ref_origin_split"](spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == sorted((r["block_id"], r["origin"], r["bp"]) for r in want)


def test_pairs_of_all_assigned_contigs(spark, sf_dir):
    want = uncut(sf_dir, "assembly_pairs", " WHERE (best_bp // 1000) % 3 <> 0")
    got = catalog.QUERIES["assembly_pairs"](spark, sf_dir).select("ref_id", "left_ord", "right_ord", "adjacent").collect()
    assert sorted(map(tuple, got)) == sorted((r["ref_id"], r["left_ord"], r["right_ord"], r["adjacent"]) for r in want)
    best = {(int(r.assembly[4:]), r.best_ref) for r in catalog._best(spark, sf_dir).select("assembly", "best_ref").collect()}
    refs = defaultdict(list)
    for o, ref in sorted(best):
        refs[ref].append(o)
    assert sorted(map(tuple, got)) == sorted((ref, a, b, b - a == 1) for ref, x in refs.items() for a, b in zip(x, x[1:]))


def test_pairs_pass_over_missing_references(spark, monkeypatch):
    """Contigs count whatever their best_bp; references are missing where no contig has them."""
    rows = [("asm_0", "a", "chr1A", 3000), ("asm_2", "b", "chr1A", 4000), ("asm_3", "c", "chr1A", 6500), ("asm_1", "d", "chr2A", 5000)]
    monkeypatch.setattr(catalog, "_best", lambda s, d: s.createDataFrame(rows, "assembly string, contig string, best_ref string, best_bp long"))
    got = catalog.QUERIES["assembly_pairs"](spark, "").select("ref_id", "left_ord", "right_ord", "adjacent").collect()
    assert sorted(map(tuple, got)) == [("chr1A", 0, 2, False), ("chr1A", 2, 3, True)]
