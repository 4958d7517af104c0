"""Patterns of names, maps of names, lineages and chains between assemblies, against Python and values worked out by hand."""

import re

import pytest
from pyspark.sql import functions as F

from karyolytics.config import Config
from karyolytics.functions import ids
from karyolytics.operators import compare, run, taxonomy

NAMES = ["chr1At", "CHR12Dt", "Chr3at", "chr4", "Chromosome_7Dt", "scaffold1X", "SCAFFOLD2y", "scaffold3", "chr1A_B_f2", "scaffold9X_c3", "Mt", "Pt", "ChrC", "x", ""]
PATTERNS = [r"^(?P<chrom>chr\d+)(?P<sg>At|Dt)$", r"(?P<chrom>scaffold\d+)(?P<sg>[XY])?$", r"(?P<chrom>chr\d)"]


def split(name):
    """As the first pattern that matches from the start says."""
    norm = re.sub("^chr", "chr", name, flags=re.I)
    for kind, known in (("C", ids.CHLOROPLAST), ("M", ids.MITOCHONDRION)):
        if name.lower() in known:
            return ("Chr" if name.startswith("Chr") else "chr") + kind, "NA"
    base = re.sub("_[A-Z]$", "", re.sub(r"_[fc]\d+$", "", norm))
    for p in PATTERNS:
        if m := re.compile(p, re.I).match(base):
            chrom = re.sub("^chr", "Chr", m["chrom"]) if name.startswith("Chr") else m["chrom"]
            return chrom, m.groupdict().get("sg") or "NA"
    return name, "NA"


def test_patterns(spark):
    p = ids.Patterns(PATTERNS)
    df = spark.createDataFrame([(n,) for n in NAMES], "n string")
    got = {r.n: (r.c, r.s) for r in df.select("n", p.chrom_id(F.col("n")).alias("c"), p.subgenome(F.col("n")).alias("s")).collect()}
    assert got == {n: split(n) for n in NAMES}
    for wrong in ("(", "chr(?P<sg>A)"):
        with pytest.raises(ValueError):
            ids.Patterns([wrong])


def test_id_map(spark):
    df = spark.createDataFrame([("Mt", 2), ("ChrM", 1), ("CHR1", 3), ("chr1", 4), ("chr1", 0), ("s", 5)], "n string, o int")
    got = sorted(tuple(r) for r in ids.id_map(df, "n", "o").collect())
    assert got == [("CHR1", "chr1", False), ("ChrM", "chrM", True), ("Mt", "chrM", False), ("chr1", "chr1", True), ("s", "s", True)]


def test_lineages(spark):
    nodes = [(1, 1, "no rank", "root"), (2, 1, "domain", "Eukaryota"), (3, 2, "kingdom", "Fungi"), (4, 3, "family", "Fam"), (5, 4, "genus", "Genus"), (6, 5, "species", "Genus one"), (7, 2, "family", "Free"), (8, None, "domain", "Bacteria"), (9, 8, "genus", "Bac"), (10, 99, "genus", "Torn"), (11, 12, "genus", "Loop"), (12, 11, "family", "Round")]
    table = spark.createDataFrame(nodes, "taxid long, parent long, rank string, name string")
    hits = [(6, "Genus one"), (7, "f"), (9, "Bac"), (10, "Torn"), (11, "Loop"), (50, "s__Genus_AB two"), (51, "Bac sp3"), (52, "Nobody knows"), (53, None), (54, ""), (6, "again")]
    got = sorted(((r.taxid, r["name"], r.kingdom, r.family, r.genus, r.species, r.found_by) for r in taxonomy.with_fallback(spark.createDataFrame(hits, "taxid long, name string"), table).collect()), key=repr)
    assert got == sorted(
        [
            (6, "Genus one", "Fungi", "Fam", "Genus", "Genus one", "taxid"), (6, "again", "Fungi", "Fam", "Genus", "Genus one", "taxid"), (7, "f", "Eukaryota", "Free", None, None, "taxid"), (9, "Bac", "Bacteria", None, "Bac", None, "taxid"),
            (10, "Torn", None, None, "Torn", None, "taxid"), (11, "Loop", None, "Round", "Loop", None, "taxid"), (50, "s__Genus_AB two", "Fungi", "Fam", "Genus", "Genus two", "genus"), (51, "Bac sp3", "Bacteria", None, "Bac", "Bac sp3", "genus"),
            (52, "Nobody knows", None, None, None, "Nobody knows", "none"), (53, None, None, None, None, None, "none"), (54, "", None, None, None, None, "none"),
        ],
        key=repr,
    )


@pytest.mark.parametrize(("domain", "clade", "want"), [("Bacteria", "x", "Bacteria"), ("Eukaryota", "Sar", "Chromista"), ("Eukaryota", "Odd", "Protozoa"), ("Eukaryota", None, "Eukaryota"), (None, "Fungi", "Fungi"), (None, None, None)])
def test_kingdoms(spark, domain, clade, want):
    df = spark.createDataFrame([(domain, clade)], "d string, c string")
    assert df.select(taxonomy.kingdom(F.col("d"), F.col("c"))).first()[0] == want


def test_chains_between_assemblies(spark):
    schema = "left string, right string, contig string, target string, strand string, qs long, qe long, rs long, re long, matches long, aln_len long, k long"
    data = [("a", "b", "c1", "t1", "+", 0, 40_000, 0, 40_000, 39_000, 40_000, 1), ("a", "b", "c1", "t1", "+", 40_000, 80_000, 41_000, 81_000, 38_000, 40_000, 2), ("a", "b", "c1", "t2", "-", 0, 9_000, 0, 9_000, 9_000, 9_000, 3), ("b", "c", "c1", "t1", "-", 0, 60_000, 0, 60_000, 60_000, 60_000, 4)]
    got = sorted(tuple(r)[:9] for r in compare.pairwise_synteny(spark.createDataFrame(data, schema), ["k"]).select("left", "right", "contig", "target", "strand", "qstart", "qend", "union_bp", "n_segments").collect())
    assert got == [("a", "b", "c1", "t1", "+", 0, 80_000, 80_000, 1), ("b", "c", "c1", "t1", "-", 0, 60_000, 60_000, 1)]


@pytest.mark.parametrize(("ref", "chain", "bp", "score", "second", "want"), [(None, True, 50, 0.5, 0.1, "NO_HITS"), ("r", True, 50, 0.0, 0.0, "NO_HITS"), ("r", False, 0, None, None, "AMBIG_LOW_FRAC"), ("r", True, 9, 0.5, 0.1, "AMBIG_LOW_FRAC"), ("r", True, 50, 0.5, 0.45, "AMBIG_LOW_RATIO"), ("r", False, 50, 0.0, 0.0, "AMBIG_LOW_RATIO"), ("r", True, 50, 0.5, 0.0, "OK"), ("r", True, 50, 0.5, 0.4, "OK")])
def test_status(spark, ref, chain, bp, score, second, want):
    df = spark.createDataFrame([(ref, 100, bp, score, second)], "r string, contig_len long, best_bp long, best_score double, second_score double")
    assert df.select(run.status(F.col("r"), F.lit(chain), Config())).first()[0] == want
