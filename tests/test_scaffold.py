"""Scaffolds, lifted positions, the riparian layout and exemplars, against loops or values worked out by hand."""

import random

import pytest
from pyspark.sql import functions as F

from karyolytics.config import Config
from karyolytics.functions import ids
from karyolytics.operators import layout, rdna, scaffold

CONTIG = "assembly string, contig string, class string, ref_id string, grp int, identity double, chain_identity double, contig_len long, name string, ref_name string, full_length boolean, telo5 boolean, telo3 boolean, reversed boolean, ref_mid long"


def contig(assembly, name, cls="chrom_assigned", ref="chr1A", grp=None, ident=None, chain=None, size=100, new=None, full=False, t5=False, t3=False, back=False, mid=None):
    return (assembly, name, cls, ref, grp, ident, chain, size, new, None, full, t5, t3, back, mid)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def placed(spark, data, cfg=Config(scaffold_gap=10)):
    return scaffold.scaffolds(scaffold.haplotypes(spark.createDataFrame(data, CONTIG)), cfg)


def test_haplotype_groups(spark):
    data = [
        contig("x", "a", ident=0.95), contig("x", "b", ident=0.94, grp=1), contig("x", "c", ident=0.80, grp=2), contig("x", "n", grp=3),
        contig("x", "near1", "chrom_debris", chain=0.93), contig("x", "near2", "chrom_debris", chain=0.79), contig("x", "none", "chrom_debris", chain=None),
        contig("x", "other", "debris", chain=0.9), contig("x", "lost", "chrom_debris", ref="chr9A", chain=0.9), contig("x", "unref", "chrom_debris", ref=None),
        contig("y", "a", "chrom_debris", chain=0.99),
    ]
    got = {(r.assembly, r.contig): r.group for r in scaffold.haplotypes(spark.createDataFrame(data, CONTIG)).collect()}
    # a group without identities has mean 0, which is nearest to a contig without one
    assert got == {("x", "a"): 1, ("x", "b"): 1, ("x", "c"): 2, ("x", "n"): 3, ("x", "near1"): 1, ("x", "near2"): 2, ("x", "none"): 3}


def test_order_and_gaps(spark):
    data = [contig("x", "A", mid=1100, size=100), contig("x", "B", mid=300, size=100, back=True), contig("x", "Z", mid=None, size=7), contig("x", "d", "chrom_debris", mid=500, size=50, chain=0.9), contig("x", "empty", size=0)]
    agp = scaffold.agp_rows(placed(spark, data), Config(scaffold_gap=10))
    lines = [tuple(r)[1:] for r in agp.orderBy("part").collect()]
    assert lines == [
        ("chr1A", 1, 100, 1, "W", "B", "1", "100", "-"), ("chr1A", 101, 110, 2, "N", "10", "scaffold", "yes", "align_genus"), ("chr1A", 111, 160, 3, "W", "d", "1", "50", "+"),
        ("chr1A", 161, 170, 4, "N", "10", "scaffold", "yes", "align_genus"), ("chr1A", 171, 270, 5, "W", "A", "1", "100", "+"),
        ("chr1A", 271, 280, 6, "N", "10", "scaffold", "yes", "align_genus"), ("chr1A", 281, 287, 7, "W", "Z", "1", "7", "+"),
    ]
    bare = scaffold.agp_rows(placed(spark, data, Config(scaffold_gap=0)), Config(scaffold_gap=0))
    assert [(r.beg, r.end, r.part, r.type) for r in bare.orderBy("part").collect()] == [(1, 100, 1, "W"), (101, 150, 2, "W"), (151, 250, 3, "W"), (251, 257, 4, "W")]


def test_whole_and_single_contigs(spark):
    data = [
        contig("x", "t2t", new="chr1A", full=True, t5=True, t3=True, mid=5), contig("x", "copy", new="chr1A_c2", full=True, t5=True, back=True, mid=2), contig("x", "d", "chrom_debris", chain=0.9, mid=1),
        contig("x", "only", ref="chr2A", new="chr2A_f1", back=True), contig("x", "h1", ref="chr3A", grp=2, mid=9), contig("x", "h2", ref="chr3A", grp=2, mid=3), contig("x", "unnamed", ref="chr4A", grp=3),
        contig("y", "t2t", mid=5), contig("y", "copy", mid=2),
    ]
    got = {(r.assembly, r.contig): (r.scaffold, r.part, r.start, r.reversed) for r in placed(spark, data).collect()}
    assert got == {
        ("x", "t2t"): ("chr1A", 1, 0, False), ("x", "copy"): ("chr1A_c2", 1, 0, True), ("x", "only"): ("chr2A_f1", 1, 0, True), ("x", "h2"): ("chr3A_B", 1, 0, False), ("x", "h1"): ("chr3A_B", 2, 110, False),
        ("x", "unnamed"): ("chr4A_C", 1, 0, False), ("y", "copy"): ("chr1A", 1, 0, False), ("y", "t2t"): ("chr1A", 2, 110, False),
    }


def test_lift_against_positions(spark):
    """Each position of a contig is mapped alone; a lifted feature must cover just the places of its positions."""
    rng = random.Random(2)
    agp, place = [], {}
    for assembly in "xy":
        for scaf in ("s1", "s2"):
            at, part = 1, 1
            for k in range(3):
                a, z, back = rng.randrange(1, 40), rng.randrange(60, 100), rng.random() < 0.5
                name = f"c{k}" if scaf == "s1" else "split"
                if scaf == "s2":
                    a, z = 100 * k + 1, 100 * k + 90
                agp.append((assembly, scaf, at, at + z - a, part, "W", name, str(a), str(z), "-" if back else "+"))
                for i in range(a, z + 1):
                    place[assembly, name, i - 1] = (scaf, at - 1 + (z - i if back else i - a), back)
                at, part = at + z - a + 1, part + 1
                agp.append((assembly, scaf, at, at + 9, part, "N", "10", "scaffold", "yes", "align_genus"))
                at, part = at + 10, part + 1
    features = []
    for i in range(60):
        s = rng.randrange(0, 290)
        features.append((rng.choice("xy"), rng.choice(["c0", "c1", "c2", "split", "free"]), s, s + rng.randrange(1, 200), rng.choice("+-"), i))
    df = spark.createDataFrame(agp, "assembly string, object string, beg long, end long, part long, type string, component string, component_beg string, component_end string, orientation string")
    got = scaffold.lift(spark.createDataFrame(features, "assembly string, contig string, start long, end long, strand string, i int"), scaffold.components(df)).collect()
    for a, c, s, e, strand, i in features:
        mine = [r for r in got if r.i == i]
        if c == "free":
            assert [(r.scaffold, r.s_start, r.s_end, r.s_strand) for r in mine] == [("free", s, e, strand)]
            continue
        cells = {(r.scaffold, x, r.s_strand) for r in mine for x in range(r.s_start, r.s_end)}
        turned = {"+": "-", "-": "+"}
        assert cells == {(p[0], p[1], turned[strand] if p[2] else strand) for x in range(s, e) if (p := place.get((a, c, x)))}
        assert sum(r.s_end - r.s_start for r in mine) == len(cells)
    assert not [r for r in scaffold.lift(spark.createDataFrame(features, "assembly string, contig string, start long, end long, strand string, i int"), scaffold.components(df), keep=False).collect() if r.contig == "free"]


def test_numeric_names(spark):
    names = ["chr10A", "chr2A_f10", "chr2A_f9", "chr2A", "contig_007", "contig_12", ""]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r.n for r in df.orderBy(ids.numeric_key(F.col("n"))).collect()] == ["", "chr2A", "chr2A_f9", "chr2A_f10", "chr10A", "contig_007", "contig_12"]


def test_riparian_layout(spark):
    refs = spark.createDataFrame([("A", 1, "chr1A", 1000), ("A", 2, "chr2A", 500), ("B", 1, "chr1B", 800)], "subgenome string, chrom_num int, ref_id string, ref_len long")
    agp = spark.createDataFrame(
        [("x", "chr1A", 1, 600, 1, "W", "o1"), ("x", "chr1A", 601, 700, 2, "N", "100"), ("x", "chr1A", 701, 1500, 3, "W", "o2"), ("x", "chr1A_B", 1, 300, 1, "W", "o3"), ("x", "chr1A_B", 301, 400, 2, "N", "100"), ("x", "chr1A_B", 401, 500, 3, "W", "o4"), ("x", "chr2A_f1", 1, 200, 1, "W", "o5")],
        "assembly string, object string, beg long, end long, part int, type string, component string",
    )
    contigs = spark.createDataFrame(
        [("x", "chr1A_f1", "o1", "chr1A", 600, False), ("x", "chr1A_f2", "o2", "chr1A", 800, False), ("x", "chr1A_B_f1", "o3", "chr1A", 300, False), ("x", "chr1A_B_f2", "o4", "chr1A", 100, True), ("x", "chr1A_f10", "o6", "chr1A", 50, True), ("x", "chr2A_f1", "o5", "chr2A", 200, True), ("y", "chr2A_f2", "p2", "chr2A", 300, False), ("y", "chr2A_f10", "p1", "chr2A", 400, True)],
        "assembly string, contig string, original string, ref_id string, contig_len long, reversed boolean",
    )
    cols = layout.columns(refs, contigs, agp, 1000.0)
    width = {r.ref_id: (round(r.width, 9), round(r.x, 9)) for r in cols.collect()}
    # chr1A: the scaffold of 1500; chr2A: 0.3 + 0.4 and one gap of 0.4
    assert width == {"chr1A": (1.5, 0.75), "chr2A": (1.1, 1.5 + 0.2 + 0.55), "chr1B": (0.8, 0.4)}
    drawn = layout.stretches(cols, contigs, agp, 1000.0)
    at = {(r.assembly, r.name): (r.kind, round(r.left, 6), round(r.right, 6), r.reversed) for r in drawn.collect()}
    assert at == {
        (None, "chr1A"): ("reference", 0.25, 1.25, False), (None, "chr2A"): ("reference", 2.0, 2.5, False), (None, "chr1B"): ("reference", 0.0, 0.8, False),
        ("x", "chr1A"): ("scaffold", -0.45, 1.05, False), ("x", "chr1A_B"): ("scaffold", 1.45, 1.95, False), ("x", "chr1A_f10"): ("contig", 0.725, 0.775, True),
        ("x", "chr2A_f1"): ("contig", 2.15, 2.35, True), ("y", "chr2A_f2"): ("contig", 1.7, 2.0, False), ("y", "chr2A_f10"): ("contig", 2.4, 2.8, True),
    }
    marks = {(r.assembly, r.name): round(r.x, 6) for r in layout.joins(drawn, agp).collect()}
    assert marks == {("x", "chr1A"): round(-0.45 + 650.5 / 1500 * 1.5, 6), ("x", "chr1A_B"): round(1.45 + 350.5 / 500 * 0.5, 6)}
    feats = spark.createDataFrame([("x", "chr1A", 0, 750), ("y", "chr2A_f10", 100, 400)], "assembly string, name string, start long, end long")
    assert sorted((r.name, round(r.x_start, 6), round(r.x_end, 6)) for r in layout.projected(feats, drawn).collect()) == [("chr1A", -0.45, 0.3), ("chr2A_f10", 2.5, 2.8)]


COPY, CLUSTER, HIT = "k string, name string, seq string", "k string, cluster long, name string, representative boolean", "k string, q string, t string, pident double"


@pytest.mark.parametrize("width", [4096, 7])
def test_consensus_against_loops(spark, width):
    rng = random.Random(6)
    data = [(k, "".join(rng.choice("ACGTacgt-.N") for _ in range(rng.randrange(0, 60)))) for k in "pqr" for _ in range(rng.choice([1, 2, 9]))] + [("gaps", "--."), ("gaps", "")]
    want = {}
    for key in {k for k, _ in data}:
        seqs = [s.upper() for k, s in data if k == key]
        out = ""
        for i in range(max(map(len, seqs))):
            bases = [s[i] for s in seqs if i < len(s) and s[i] not in "-."]
            if len(bases) >= max(1, int(len(seqs) * 0.5)):
                out += min(set(bases), key=lambda b: (-bases.count(b), b))
        want[key] = out
    df = spark.createDataFrame(data, "k string, s string").repartition(4)
    assert {r.k: r.consensus for r in rdna.column_consensus(df, "k", "s", width=width).collect()} == want


def test_exemplars(spark):
    long = "ACGT" * 300
    copies = [("one", "a", "AC"), *[("cons", n, long) for n in "abcd"], ("rep", "a", "AAA"), ("rep", "b", "CC"), ("far", "a", "G"), ("far", "b", "TT"), ("cent", "a", "A"), ("cent", "b", "CC"), ("cent", "c", "GGG"), ("long", "a", "A"), ("long", "b", "CC"), ("long", "c", "GG"), *[("short", n, "ACGT") for n in "abc"]]
    clusters = [*[("cons", 1, n, n == "b") for n in "abc"], ("cons", 0, "d", True), ("rep", 4, "a", False), ("rep", 3, "b", True), ("far", 7, "a", False), ("far", 9, "b", True), *[("short", 0, n, n == "a") for n in "abc"]]
    aligned = [("cons", "a", long[:600] + "--" + long[602:]), ("cons", "b", "T" + long[1:]), ("cons", "c", long.lower()), ("cons", "d", "T" * 2000), *[("short", n, "ACGT") for n in "abc"]]
    hits = [("cent", "a", "b", 90.0), ("cent", "b", "a", 95.0), ("cent", "b", "c", 97.0), ("cent", "c", "a", 80.0)]
    got = rdna.exemplars(*(spark.createDataFrame(d, s) for d, s in ((copies, COPY),)), ["k"], spark.createDataFrame(clusters, CLUSTER), spark.createDataFrame(aligned, COPY), spark.createDataFrame(hits, HIT))
    assert {r.k: (r.seq, r.method, r.n_copies) for r in got.collect()} == {
        "one": ("AC", "single_copy", 1), "cons": (long, "cdhit+mafft", 3), "rep": ("CC", "cdhit_rep", 1), "far": ("TT", "cdhit_rep", 1), "cent": ("CC", "blast_central", 3), "long": ("CC", "longest_copy", 3), "short": ("ACGT", "cdhit_rep", 3),
    }
