"""Files written by hand are read as told, and sinks give what sources read."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from karyolytics.functions import sequence
from karyolytics.sources import readers, sinks


def test_fasta(spark, tmp_path):
    (p := tmp_path / "a.fa").write_text(">one first\nACGT\nAC\n>Chr2\n\nGG\n")
    assert {tuple(r) for r in readers.fasta(spark, str(p)).collect()} == {("one", "ACGTAC", 6), ("Chr2", "GG", 2)}
    with gzip.open(tmp_path / "b.fa.gz", "wt") as f:
        f.write(">x\nAC\n")
    assert readers.fasta_lengths(spark, str(tmp_path / "b.fa.gz")).collect()[0][:] == ("x", 2)
    sinks.fasta(readers.fasta(spark, str(p)), str(tmp_path / "out"), 4)
    assert {tuple(r) for r in readers.fasta(spark, str(tmp_path / "out")).collect()} == {("one", "ACGTAC", 6), ("Chr2", "GG", 2)}


def test_paf(spark, tmp_path):
    row = "q\t100\t10\t50\t+\tchr1\t1000\t400\t300\t30\t40\t60"
    (p := tmp_path / "a.paf").write_text("\n".join([row + "\ttp:A:P", row + "\ttp:A:S", row, "# no", "", "q\tx\t1", row.replace("\t10\t", "\tbad\t", 1)]) + "\n")
    got = readers.paf(spark, str(p)).collect()
    assert len(got) == 2 and (got[0].rs, got[0].re) == (300, 400)
    assert readers.paf(spark, str(p), tp=None).count() == 3
    assert readers.paf(spark, str(p), protein=True).first().contig == "chr1"


def test_tables(spark, tmp_path):
    (tmp_path / "b.tsv").write_text("q\ts\t99.5\t201\t0\t0\t50\t10\t1\t200\t1e-9\t100\t3;4\n")
    r = readers.blast6(spark, str(tmp_path / "b.tsv")).first()
    assert (r.qstart, r.qend, r.taxid, r.matches) == (10, 50, 3, 199)
    (tmp_path / "g.gff3").write_text("##gff-version 3\nCHR1\tx\tmRNA\t11\t20\t.\t?\t.\tID=t1;Parent=g1,g2\nCHR1\tx\tgene\t11\t20\t.\t+\t.\tID=g1\n")
    t = readers.transcripts(spark, str(tmp_path / "g.gff3")).first()
    assert tuple(t) == ("t1", "g1", "chr1", 10, 20, "+")
    assert readers.genes(spark, str(tmp_path / "g.gff3")).first().gene_id == "g1"
    (tmp_path / "busco.txt").write_text("S:85.27%, 110\nD:10.00%, 13\nF:1.0%, 2\nI:0.0%, 0\nM:3.7%, 4\nN:129\n")
    r = readers.busco(spark, str(tmp_path / "busco.txt")).first()
    assert (r.s_pct, r.s_n, r.n) == (85.27, 110, 129)
    (tmp_path / "c.clstr").write_text(">Cluster 0\n0\t10nt, >a... *\n1\t9nt, >b... at 99%\n>Cluster 1\n0\t8nt, >c... *\n")
    assert {tuple(r) for r in readers.clusters(spark, str(tmp_path / "c.clstr")).collect()} == {(0, "a", True), (0, "b", False), (1, "c", True)}
    (tmp_path / "a.agp").write_text("s1\t1\t4\t1\tW\tc1\t1\t4\t-\ns1\t5\t104\t2\tN\t100\tscaffold\tyes\talign\ns1\t105\t108\t3\tW\tc2\t1\t4\t+\n")
    seqs = spark.createDataFrame([("c1", "AACC"), ("c2", "GGTT"), ("c3", "A")], "name string, seq string")
    whole, left = readers.rebuilt(readers.agp(spark, str(tmp_path / "a.agp")), seqs, 2)
    assert whole.first().seq == "GGTTNNGGTT" and [r.name for r in left.collect()] == ["c3"]
    (tmp_path / "d.bed").write_text("c\t0\t10\t1.5\nc\t10\t5\t1\n")
    assert readers.depth_bed(spark, str(tmp_path / "d.bed")).count() == 1


def test_file_list(tmp_path):
    (p := tmp_path / "l.tsv").write_text("path\tname\treads\na.fa.gz\nb.fa\tB\tr.fq\n")
    got = readers.file_list(str(p), "all.fq")
    assert [(n, r and r.split("/")[-1]) for _, n, r in got] == [("a", "all.fq"), ("B", "r.fq")]
    p.write_text("a.fa\tx\nb.fa\tx\n")
    with pytest.raises(ValueError, match="x"):
        readers.file_list(str(p))
    assert readers.read_format("x.FQ.gz") == "fastq" and readers.read_format("x") == "unknown"


def test_sequences(spark):
    df = spark.createDataFrame([("ACGTNacgtn",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(sequence.reverse_complement(F.col("s"))).collect()] == ["nacgtNACGT", "", None]
    assert [r[0] for r in df.select(sequence.gc_content(F.col("s"))).collect()] == [0.5, 0.0, 0.0]
    a, b = sequence.telomere_repeats(F.col("s"), "TTTAGGG", 1000, 3)
    t = spark.createDataFrame([("CCCTAAA" * 4 + "A" * 100 + "TTTAGGG" * 3,)], "s string").select(a, b).first()
    assert tuple(t) == (4, 3)


def test_tsv_sink(spark, tmp_path):
    df = spark.createDataFrame([("b", True, 0.25, None), ("a", False, None, 3)], "k string, y boolean, x double, n long")
    sinks.tsv(df, str(tmp_path / "o"), ["k"])
    text = next((tmp_path / "o").glob("part-*")).read_text().splitlines()
    assert text == ["k\ty\tx\tn", "a\tno\t\t3", "b\tyes\t0.2500\t"]


def test_blocks_that_span_splits(spark, tmp_path):
    """Splits of a few bytes: a cluster or a sequence goes on over many of them, and none starts with another file's mark."""
    rng = random.Random(4)
    want, sizes = [], {}
    for name in ("one", "two"):
        text = ""
        for k in range(6):
            text += f">Cluster {k}\n"
            for i in range(rng.choice([1, 2, 40])):
                text += f"{i}\t{100 + i}nt, >{name}_{k}_{i}... {'*' if i == 0 else 'at 99%'}\n"
                want.append((k, f"{name}_{k}_{i}", i == 0))
        (tmp_path / f"{name}.clstr").write_text(text)
        seqs = {f"{name}{k}": "".join(rng.choice("ACGTN") for _ in range(rng.choice([0, 7, 900]))) for k in range(5)}
        (tmp_path / f"{name}.fa").write_text("".join(f">{k} note\n" + "".join(f"{v[i : i + 30]}\n" for i in range(0, len(v), 30)) for k, v in seqs.items()))
        (tmp_path / f"{name}.fa.gz").write_bytes(gzip.compress((tmp_path / f"{name}.fa").read_bytes()))
        sizes |= {k: (len(v), sum(c in "GC" for c in v) / max(1, sum(c in "ACGT" for c in v))) for k, v in seqs.items() if v}
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in old:
            spark.conf.set(k, "97")
        assert sorted(tuple(r) for r in readers.clusters(spark, str(tmp_path / "*.clstr")).collect()) == sorted(want)
        got = {r.name: (r.length, r.gc) for r in readers.fasta_gc(spark, str(tmp_path / "*.fa")).collect()}
        assert got == sizes and readers.carried(spark, str(tmp_path / "*.fa"), "^>(\\S+)").select("file", "split").distinct().count() > 8
        packed = {r.name: (r.length, r.gc) for r in readers.fasta_gc(spark, str(tmp_path / "*.fa.gz")).collect()}
        assert packed == sizes
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
