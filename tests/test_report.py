"""Operators of reports and those that no query calls, on rows made by hand; expected values are worked out by hand."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from karyolytics.config import Config
from karyolytics.functions import ids
from karyolytics.operators import assign, classify, compare, detect, evidence, rdna, rearrange, report, scaffold, subgenome


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def one(spark, expression, **values):
    df = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())) if values else spark.range(1)
    return df.select(expression.alias("x")).first()["x"]


def test_reads():
    assert [report.preset(x) for x in ("lrhq", "r9", "sr")] == ["lr:hqae", "map-ont", "sr"]
    with pytest.raises(ValueError):
        report.preset("hifi")


@pytest.mark.parametrize("bases,size,want", [(1000, 10, 0.2), (100, 10, 1.0), (0, 10, 1.0), (10, 0, 1.0)])
def test_subsample_fraction(spark, bases, size, want):
    assert one(spark, report.subsample_fraction(F.col("b"), F.col("s"), 20.0), b=bases, s=size) == want


def test_names(spark):
    want = {"CHR1A": ("chr1", "A"), "Chr2": ("Chr2", "NA"), "ChrM": ("ChrM", "NA"), "chr6A_B_f1": ("chr6", "A"), "chr3At": ("chr3", "At"), "cpDNA": ("chrC", "NA"), "cp": ("cp", "NA"), "scaffold_1": ("scaffold_1", "NA")}
    df = spark.createDataFrame([(x,) for x in want], "x string")
    assert {r[0]: (r[1], r[2]) for r in df.select("x", ids.chrom_id(F.col("x")), ids.subgenome(F.col("x"))).collect()} == want
    assert [r[0] for r in df.filter(ids.is_nuclear(F.col("x"))).select("x").orderBy("x").collect()] == ["CHR1A", "Chr2", "chr3At", "chr6A_B_f1"]
    got = spark.createDataFrame([("contig_10",), ("chr10",), ("contig_2",), ("chr2",)], "c string")
    assert [r[0] for r in got.orderBy(*ids.natural_key(F.col("c"))).collect()] == ["chr2", "chr10", "contig_2", "contig_10"]
    circular = spark.createDataFrame([("ptg000001c",), ("ptg000001l",)], "c string")
    assert [r[0] for r in circular.select(ids.is_circular(F.col("c"))).collect()] == [True, False]


def test_small_columns(spark):
    assert [one(spark, rdna.copy_type(F.lit(x))) for x in (0.9, 0.5, 0.49)] == ["full", "partial", "fragment"]
    assert one(spark, classify.synteny_score("nucleotide", F.lit(0.4), F.lit(0.9))) == 0.4
    assert one(spark, classify.synteny_score("protein", F.lit(0.4), F.lit(0.9))) == 1.0
    assert one(spark, evidence.diagonal(F.lit("-"), F.lit(5), F.lit(7))) == 12
    assert one(spark, evidence.diagonal(F.lit("+"), F.lit(5), F.lit(7))) == 2
    weight = lambda mode, n=10: one(spark, evidence.chain_weight(mode, F.lit(8), F.lit(9), F.lit(0.5), F.lit(n)))
    assert [weight("matches"), weight("qbp_ident"), weight("matches_ident"), weight("matches", 0)] == [8.0, 4.5, 4.0, 0.0]
    pairs = [("chr1", "A", "chr1", "B"), ("chr1", "A", "chr1", "A"), ("chr1", "A", "chr2", "B")]
    assert [one(spark, rearrange.homeologous(*map(F.lit, p))) for p in pairs] == [True, False, False]


def test_display_and_cells(spark):
    cases = {("chrC", "x", None): "chrC", ("c1", "organelle_debris", "chrM"): "chrM_debris", ("c1", "organelle_debris", "chr1"): "organelle_debris", ("c1", "rDNA", None): "rDNA"}
    for (a, b, c), want in cases.items():
        assert one(spark, report.depth_display_class(F.lit(a), F.lit(b), F.lit(c).cast("string"))) == want
    for args, want in {(0, None, None, None): "unassigned", (1, False, True, True): "incomplete", (1, True, True, True): "telo_both", (2, True, True, False): "telo_5p", (1, True, None, True): "telo_3p", (1, True, None, None): "full_length"}.items():
        n, *flags = args
        assert one(spark, report.cell_status(F.lit(n), *(F.lit(x).cast("boolean") for x in flags))) == want


CONF = "class string, mode string, ref_coverage double, chain_identity double, gene_proportion double, gc_dev double, collinearity double, n_chains long, coverage double, identity double, protein_hits long, ref_id string"


@pytest.mark.parametrize("row,want", [
    (("chrom_assigned", "nucleotide", 0.5, 0.9), "high"), (("chrom_assigned", "nucleotide", 0.2, 0.9), "medium"), (("chrom_assigned", "nucleotide", None, 0.9), "low"),
    (("chrom_assigned", "nucleotide", 0.5, 0.4), "low"), (("chrom_assigned", "protein", None, None, 0.3, 2.5), "medium"), (("chrom_assigned", "protein", None, None, 0.3, 3.5), "low"),
    (("chrom_assigned", "protein", None, None, 0.15, 0.0, 0.95, 5), "high"), (("chrom_assigned", "protein", None, None, 0.3, 0.0, 0.2, 10), "low"), (("chrom_assigned", "protein", None, None, 0.3, 0.0, 0.4, 6), "medium"), (("chrom_assigned", "protein", None, None, 0.3, 0.0, 0.1, 2), "high"),
    (("chrom_unassigned", "protein", None, None, None, 2.1), "low"), (("chrom_unassigned", "protein"), "medium"),
    (("organelle_complete", "protein", None, None, None, None, None, None, 0.85), "medium"), (("organelle_debris", "protein", None, None, None, None, None, None, 0.55), "low"),
    (("rDNA", "protein", None, None, None, None, None, None, 0.8, 0.95), "high"), (("rDNA", "protein", None, None, None, None, None, None, 0.7, 0.9), "medium"),
    (("contaminant", "protein", None, None, None, None, None, None, 0.4), "low"), (("contaminant", "protein", None, None, None, 2.5, None, None, 0.4), "high"),
    (("chrom_debris", "protein", None, None, None, None, None, None, 0.84, 0.99), "medium"), (("chrom_debris", "protein", None, None, None, 3.5, None, None, 0.84, 0.99), "low"), (("chrom_debris", "protein"), "high"),
    (("debris", "nucleotide", None, None, None, None, None, None, 0.5, None, 9), "low"), (("debris", "protein", None, None, None, None, None, None, 0.5, None, 9), "high"), (("debris", "protein", None, None, None, 3.5, None, None, 0.9), "low"),
    (("unclassified", "protein"), "low"),
])
def test_confidence(spark, row, want):
    df = spark.createDataFrame([(*row, *[None] * (12 - len(row)))], CONF)
    assert df.select(report.confidence(F.col("class"), F.col("mode"))).first()[0] == want


def test_sub_features(spark):
    """Against loops, on random hits."""
    rng = random.Random(3)
    features = [("18S", 0, 1800), ("5.8S", 2000, 2160), ("25S", 2400, 5800)]
    hits = []
    for locus in range(30):
        for _ in range(rng.randint(1, 3)):
            qs = rng.randrange(0, 5000)
            n = rng.randrange(100, 3000)
            ss = locus * 10_000 + qs
            hits.append(("x", "c", locus, qs, qs + n, ss, ss + n, rng.choice("+-")))
    want = []
    for locus, group in itertools.groupby(hits, lambda h: h[2]):
        group = list(group)
        for name, a, z in features:
            covered = set()
            for _, _, _, qs, qe, ss, se, strand in group:
                low, high = max(a, qs), min(z, qe)
                if qs <= z and qe >= a and high > low:
                    covered |= set(range(ss + low - qs, ss + high - qs) if strand == "+" else range(se - (high - qs), se - (low - qs)))
            if len(covered) >= 0.5 * (z - a):
                want.append(("x", "c", locus, name, min(covered), max(covered) + 1, len(covered)))
    got = report.sub_features(spark.createDataFrame(hits, "assembly string, contig string, locus long, qs long, qe long, ss long, se long, strand string"), spark.createDataFrame(features, "name string, start long, end long"))
    assert rows(got) == sorted(want, key=repr) and len(want) > 10


def test_look_ups(spark):
    names = spark.createDataFrame([("chr1", "Chr1"), ("chr2", "Chr2")], "norm string, orig string")
    df = spark.createDataFrame([("chr1", 1), ("chr9", 2), (None, 3)], "ref_id string, k int")
    assert rows(report.looked_up(df, "ref_id", names, "norm", "orig")) == sorted([("Chr1", 1), ("chr9", 2), (None, 3)], key=repr)
    first = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 1, "z")], "k string, o int, v string")
    assert rows(report.first_kept(first, ["k"], ["o"])) == [("a", 1, "x"), ("b", 1, "z")]


def test_rdna_parts(spark):
    hits = spark.createDataFrame([("x", "a", 1000, 2000), ("x", "a", 1900, 3000), ("x", "a", 9000, 9100), ("x", "a", 3500, 4600), ("y", "a", 0, 1500)], "assembly string, contig string, start long, end long")
    lengths = spark.createDataFrame([("x", "a", 5000), ("y", "a", 1600)], "assembly string, contig string, contig_len long")
    assert sorted(tuple(r)[:4] for r in rdna.regions(hits, 1000, 400, lengths).collect()) == [("x", "a", 600, 5000), ("y", "a", 0, 1600)]
    seqs = spark.createDataFrame([("s", "ACGTACGTAC"), ("t", "ACGTACGTACG"), ("e", "")], "name string, seq string")
    assert rows(rdna.tiles(seqs, 4).select("name", "at", "copy")) == [("s", 0, "ACGT"), ("s", 4, "ACGT"), ("t", 0, "ACGT"), ("t", 4, "ACGT"), ("t", 8, "ACG")]
    central = spark.createDataFrame([(1, "a", "b", 90.0), (1, "a", "b", 95.0), (1, "a", "c", 91.0), (1, "b", "a", 95.0), (1, "b", "c", 99.0), (1, "c", "a", 1.0), (1, "a", "a", 100.0), (2, "z", "b", 1.0)], "k int, q string, t string, pident double")
    assert rows(rdna.central_copy(central, ["k"])) == [(1, "b"), (2, "z")]
    feats = spark.createDataFrame([("x", "a", "18S", 0, 100), ("x", "a", "5.8S", 150, 200), ("x", "a", "18S", 400, 500), ("x", "a", "18S", 600, 700), ("y", "a", "5.8S", 520, 530)], "assembly string, contig string, name string, start long, end long")
    assert rows(rdna.spacers(feats, "18S", "5.8S")) == [("x", "a", 100, 150), ("x", "a", 200, 400)]


def test_debris_and_groups(spark):
    cov = spark.createDataFrame([("x", "a", 0.6), ("x", "b", 0.4)], "assembly string, contig string, coverage double")
    genes = spark.createDataFrame([("x", "a", 3), ("x", "c", 2), ("x", "d", 1), ("y", "b", 2)], "assembly string, contig string, gene_hits long")
    assert rows(detect.reference_debris(cov, genes)) == [("x", "a"), ("x", "c"), ("y", "b")]
    c = spark.createDataFrame([("x", "r", "k1", 1, 0.9), ("x", "r", "k2", 2, 0.5)], "assembly string, ref_id string, contig string, group int, identity double")
    groups = scaffold.group_identity(c)
    assert rows(groups) == [("x", "r", 1, 0.9), ("x", "r", 2, 0.5)]
    new = spark.createDataFrame([("x", "r", "n1", 0.71), ("x", "r", "n2", 0.69), ("x", "r", "n3", 0.1)], "assembly string, ref_id string, contig string, identity double")
    assert {r.contig: r.group for r in scaffold.nearest_group(new, groups).collect()} == {"n1": 1, "n2": 2, "n3": 2}


def test_order_and_ribbons(spark):
    df = spark.createDataFrame([("a", 0.8), ("a", 0.9), ("b", 0.95), ("c", None)], "assembly string, identity double")
    assert [(r.assembly, r.ord) for r in compare.order_by_identity(df).orderBy("ord").collect()] == [("b", 1), ("a", 2), ("c", 3)]
    blocks = spark.createDataFrame([("r", 1, 3, 5), ("r", 1, 2, 6), ("s", 1, 3, 7)], "ref_id string, left_ord int, right_ord int, k int")
    present = spark.createDataFrame([("r", 1), ("r", 2), ("r", 3), ("s", 1), ("s", 3)], "ref_id string, ord int")
    assert sorted(r.k for r in compare.suppress_ribbons(blocks, present).collect()) == [6, 7]


def test_reciprocal_by_hand(spark):
    schema = "assembly string, contig string, best_ref string, best_frac double, second_ref string, second_frac double"
    two = [("x", "a", "chr1", 0.6, "chr2", 0.3), ("x", "b", "chr1", 0.5, "chr2", 0.4), ("x", "f", "chr1", 0.1, "chr2", 0.02), ("x", "g", "chr1", 0.1, "chr3", 0.02)]
    assert rows(assign.resolve_reciprocal(spark.createDataFrame(two, schema))) == [("x", "b", "chr1", "chr2"), ("x", "f", "chr1", "chr2")]
    held = [*two, ("x", "h", "chr2", 0.5, None, None)]  # taken by a contig without a second reference
    assert rows(assign.resolve_reciprocal(spark.createDataFrame(held, schema))) == []
    other = [*two, ("y", "h", "chr2", 0.5, None, None)]  # of another assembly
    assert len(rows(assign.resolve_reciprocal(spark.createDataFrame(other, schema)))) == 2


def test_same_names_in_two_assemblies(spark):
    contigs = spark.createDataFrame([("x", "contig_1", 1000), ("y", "contig_1", 1000)], "assembly string, contig string, contig_len long")
    windows = spark.createDataFrame([("x", "contig_1", 0, 1000, 4.0), ("x", "contig_1", 0, 500, 8.0)], "assembly string, contig string, start_pos long, end_pos long, depth double")
    got = {r.assembly: (r.n_windows, r.sd) for r in compare.depth_stats(windows, contigs).collect()}
    assert got == {"x": (2, 2.8284), "y": (0, 0.0)}
    assert rows(classify.exclude(contigs.drop("contig_len"), contigs.filter("assembly = 'x'"))) == [("y", "contig_1")]


def test_detection_by_assembly(spark):
    """Two assemblies with contigs of one name: each has an organelle of its own, and hits count for their own contig only."""
    contigs = spark.createDataFrame([("x", "contig_1", 1000), ("y", "contig_1", 1000), ("y", "contig_2", 980)], "assembly string, contig string, contig_len long")
    cov = spark.createDataFrame([("x", "contig_1", "chrC", 990), ("y", "contig_1", "chrC", 990), ("y", "contig_2", "chrC", 970)], "assembly string, qseqid string, sseqid string, union_bp long")
    got = detect.organelle_select(cov, contigs, F.lit(1000), F.lit(0.05))
    assert rows(got.filter("chosen").select("assembly", "contig")) == [("x", "contig_1"), ("y", "contig_1")]
    one = cov.filter("assembly = 'x'")
    assert rows(detect.covered_contigs(one, contigs, 0.5)) == [("x", "contig_1", 0.99)]
    assert rows(detect.debris(one.withColumn("matches", F.lit(950)).withColumn("hit_bp", F.lit(1000)), contigs)) == [("x", "contig_1", 0.99, 0.95)]
    taxa = spark.createDataFrame([(1, "E", "Bacteria")], "taxid long, name string, kingdom string")
    hits = spark.createDataFrame([("x", "contig_1", 1, 5000, 900), ("y", "contig_2", 1, 5000, 100)], "assembly string, contig string, taxid long, score long, matching_bp long")
    assert rows(detect.contaminants(hits, taxa, contigs, least_cov=0.5).select("assembly", "contig", "coverage")) == [("x", "contig_1", 0.9)]
    loci = spark.createDataFrame([(a, "contig_1", i * 100, i * 100 + 50, "+", 99.0, i) for a in "xy" for i in range(3 if a == "x" else 2)], "assembly string, contig string, start long, end long, strand string, pident double, k long")
    found = rdna.loci(loci, "k", Config(locus_gap=10))
    assert rows(found.groupBy("assembly").count()) == [("x", 3), ("y", 2)]
    assert rows(rdna.arrays(found).select("assembly", "n_copies")) == [("x", 3)]


def test_names_by_subgenome(spark):
    schema = "assembly string, contig string, ref_id string, subgenome string, full_length boolean, identity double, length long"
    data = [("x", "a", "chr1A", None, True, 0.9, 10), ("x", "b", "chr1A", "B", True, 0.8, 9), ("x", "c", "chr1A", "B", False, 0.7, 8), ("x", "d", "chr1A", "B", False, 0.95, 7), ("x", "e", "chr2A", None, True, 0.5, 5), ("x", "f", "chr2A", None, True, 0.6, 4), ("x", "g", None, None, False, None, 3), ("x", "h", None, None, True, None, 30), ("y", "a", "chr1A", None, True, None, 3)]
    got = {(r.assembly, r.contig): r["name"] for r in classify.names(spark.createDataFrame(data, schema)).collect()}
    assert got == {("x", "a"): "chr1A", ("x", "b"): "chr1A_B", ("x", "c"): "chr1A_B_f2", ("x", "d"): "chr1A_B_f1", ("x", "e"): "chr2A_c2", ("x", "f"): "chr2A_c1", ("x", "g"): "contig_2", ("x", "h"): "contig_1", ("y", "a"): "chr1A"}


def test_choice_of_clusters():
    rng = random.Random(1)
    chroms = [f"chr{i}" for i in range(6) for _ in range(2)]
    apart = [0.99 + rng.gauss(0, 0.001) if i % 2 == 0 else 0.93 + rng.gauss(0, 0.001) for i in range(12)]
    assert len(subgenome.choose(apart, chroms)) == 2
    together = [0.95 + rng.gauss(0, 0.001) for _ in range(12)]
    assert subgenome.choose(together, ["chr1"] * 12) == [sum(together) / 12]


def test_comparison_summary(spark):
    schema = "assembly string, contig_len long, class string, full_length boolean, telo5 boolean, telo3 boolean, chimeric boolean, identity double, coverage double, collinearity double, gc_dev double, species string, depth double"
    data = [("x", 100, "chrom_assigned", True, True, True, False, 0.9, 0.8, 1.0, 0.1, None, 10.0), ("x", 50, "chrom_assigned", False, True, False, True, 0.7, 0.4, 0.5, 0.3, None, None), ("x", 30, "contaminant", False, False, False, False, None, None, None, None, "E. coli", 40.0), ("x", 20, "contaminant", False, False, False, False, None, None, None, None, "E. coli", 0.0)]
    r = report.comparison_summary(spark.createDataFrame(data, schema), classify.CLASSES).first()
    assert (r.n_contigs, r.total_bp, r.longest, r.n_chrom_assigned, r.bp_contaminant, r.bp_debris) == (4, 200, 100, 2, 50, 0)
    assert (r.n_full_length, r.n_both_telomeres, r.n_one_telomere, r.n_no_telomere, r.n_chimeric, r.n_species) == (1, 1, 1, 0, 1, 1)
    assert (r.mean_identity, r.mean_coverage, r.mean_depth) == (0.8, 0.6, round((1000 + 1200) / 150, 4))


def test_shared_stretches(spark):
    schema = "assembly string, contig string, ref_id string, rs long, re long"
    left = spark.createDataFrame([("x", "a", "r", 0, 150_000), ("x", "a", "r", 140_000, 260_000)], schema)
    right = spark.createDataFrame([("y", "b", "r", 100_000, 200_000), ("y", "b", "r", 250_000, 300_000), ("y", "c", "s", 0, 10)], schema)
    assert rows(report.shared_stretches(left, right)) == [("x", "y", "a", "b", "r", 100_000, 200_000, 2), ("x", "y", "a", "b", "r", 250_000, 260_000, 1)]


def test_all_rearrangements(spark, sf_dir):
    from karyolytics.plans import catalog, reports  # noqa: F401

    got = catalog.QUERIES["rearrangements"](spark, sf_dir).groupBy("kind").count().collect()
    n = {r["kind"]: r["count"] for r in got}
    assert n.get("inversion", 0) == catalog.QUERIES["inversions"](spark, sf_dir).count()
    assert sum(v for k, v in n.items() if "translocation" in k) == catalog.QUERIES["translocations"](spark, sf_dir).count() > 0


def test_streams(spark, tmp_path):
    """Windows and sessions over files that arrive in turn; a late event past the watermark is not counted."""
    from karyolytics.streaming import depth

    schema = "ts timestamp, contig string, depth double"
    turns = [[("2024-01-01 10:00:00", "a", 2.0), ("2024-01-01 10:20:00", "a", 4.0), ("2024-01-01 11:30:00", "b", 1.0)], [("2024-01-01 18:00:00", "a", 9.0)], [("2024-01-01 18:30:00", "b", 9.0)], [("2024-01-01 10:30:00", "a", 100.0), ("2024-01-01 23:00:00", "b", 1.0)]]
    for i, turn in enumerate(turns):
        df = spark.createDataFrame(turn, "ts string, contig string, depth double").withColumn("ts", F.to_timestamp("ts"))
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / str(i)))
    out = {}
    for name, f in (("windows", depth.depth_windows), ("sessions", depth.sessions)):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
        q = f(stream).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(120)
        out[name] = spark.table(name).collect()
    assert [(r.n, r["mean"], r.high) for r in out["windows"] if r.contig == "a" and r.window.start.hour == 10] == [(2, 3.0, 4.0)]
    assert sorted((r.contig, r.n) for r in out["sessions"])[:2] == [("a", 1), ("a", 2)]
