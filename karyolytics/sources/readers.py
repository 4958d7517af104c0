"""Readers of genomic text formats. Each gives a typed DataFrame; rows that don't parse are left out."""

from __future__ import annotations

import os
import tomllib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ids import normalize_ref_id
from ..functions.sequence import base_count

FASTA_SUFFIXES = (".fa", ".fasta", ".fna", ".fa.gz", ".fasta.gz", ".fna.gz")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file; gzip is decoded by suffix."""
    return spark.read.text(path).select("value", F.input_file_name().alias("file"))


def fields(df: DataFrame, sep: str = "\t") -> DataFrame:
    return df.filter((F.trim("value") != "") & ~F.col("value").startswith("#")).withColumn("f", F.split("value", sep))


def _at(i: int, kind: str | None = None):
    c = F.get("f", i)
    return c.try_cast(kind) if kind else c


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """name (up to the first white space), seq, length. Records are split at line starts with >."""
    df = spark.read.option("lineSep", "\n>").text(path)
    df = df.select(F.regexp_replace("value", "^>", "").alias("v")).filter(F.trim("v") != "")
    name = F.regexp_extract("v", "^(\\S+)", 1)
    seq = F.regexp_replace(F.regexp_replace("v", "^[^\\n]*(\\n|$)", ""), "\\s", "")
    return df.select(name.alias("name"), seq.alias("seq")).withColumn("length", F.length("seq").cast("long"))


def carried(spark: SparkSession, path: str, header: str) -> DataFrame:
    """Lines other than headers, each with what the header before it captures: mark, value, file, split.

    Formats of blocks under a header line are read so without a block ever being one row. Within a split of a file lines
    come in order and the mark is filled forward; a split begins with the last mark of the splits before it, which is found
    among one row for each split.
    """
    at = F.col("_metadata")
    df = spark.read.text(path).select("value", at["file_path"].alias("file"), at["file_block_start"].alias("split"))
    mark = F.when(F.col("value").rlike(header), F.regexp_extract("value", header, 1))
    df = df.withColumn("mark", mark).withColumn("head", F.col("mark").isNotNull())

    def fill(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = None
        for pdf in parts:
            key = list(zip(pdf["file"], pdf["split"]))
            filled = pdf.groupby(["file", "split"], sort=False)["mark"].ffill()
            if before and key:
                same = pd.Series([k == before[0] for k in key], index=pdf.index)
                filled = filled.where(~(same & filled.isna()), before[1])
            if key:
                before = (key[-1], None if pd.isna(filled.iloc[-1]) else filled.iloc[-1])
            yield pdf.assign(mark=filled.where(filled.notna(), None))

    last = df.withColumn("at", F.monotonically_increasing_id()).groupBy("file", "split").agg(F.max_by("mark", F.when(F.col("head"), F.col("at"))).alias("mark"))
    before = last.select("file", "split", F.last("mark", ignorenulls=True).over(W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)).alias("before"))
    out = df.mapInPandas(fill, df.schema).filter("not head").join(before, ["file", "split"], "left")
    return out.select(F.coalesce("mark", "before").alias("mark"), "value", "file", "split")


def fasta_lines(spark: SparkSession, path: str) -> DataFrame:
    """name and seq of each line of sequences, file; so a chromosome is as many rows as lines."""
    df = carried(spark, path, "^>\\s*(\\S*)")
    return df.select(F.col("mark").alias("name"), F.regexp_replace("value", "\\s", "").alias("seq"), "file").filter("name is not null and name <> ''")


def fasta_lengths(spark: SparkSession, path: str) -> DataFrame:
    """Lengths by normalised id; the largest where ids collide."""
    per = fasta_lines(spark, path).groupBy("file", "name").agg(F.sum(F.length("seq")).alias("length"))
    return per.groupBy(normalize_ref_id(F.col("name")).alias("ref_id")).agg(F.max("length").alias("ref_len"))


def fasta_gc(spark: SparkSession, path: str) -> DataFrame:
    """name, length and gc of each sequence, added up over its lines."""
    n = lambda bases: F.sum(base_count(F.col("seq"), bases))
    per = fasta_lines(spark, path).groupBy("file", "name").agg(F.sum(F.length("seq")).alias("length"), n("GC").alias("gc"), n("ACGT").alias("all"))
    return per.select("name", "length", F.coalesce(F.col("gc") / F.nullif(F.col("all"), F.lit(0)), F.lit(0.0)).alias("gc"))


def paf(spark: SparkSession, path: str, min_len: int = 0, min_mapq: int = 0, tp: tuple[str, ...] | None = ("P", "I"), protein: bool = False) -> DataFrame:
    """Alignment blocks past the gates; in protein files the target is the contig. A missing tp tag passes."""
    df = fields(lines(spark, path)).filter(F.size("f") >= 12)
    tag = F.get(F.filter(F.slice("f", 13, 1000), lambda x: x.startswith("tp:A:")), 0)
    q, t = ("qname", "tname") if not protein else ("tname", "qname")
    col = {"qname": _at(0), "qlen": _at(1, "long"), "qstart": _at(2, "long"), "qend": _at(3, "long"), "strand": _at(4), "tname": _at(5), "tlen": _at(6, "long"), "tstart": _at(7, "long"), "tend": _at(8, "long")}
    side = lambda x: x[0]
    low = lambda s: F.least(col[f"{s}start"], col[f"{s}end"])
    high = lambda s: F.greatest(col[f"{s}start"], col[f"{s}end"])
    df = df.select(
        col[q].alias("contig"), col[f"{side(q)}len"].alias("contig_len"), low(side(q)).alias("qs"), high(side(q)).alias("qe"), col["strand"].alias("strand"),
        col[t].alias("ref_id"), col[f"{side(t)}len"].alias("ref_len"), low(side(t)).alias("rs"), high(side(t)).alias("re"), _at(9, "long").alias("matches"), _at(10, "long").alias("aln_len"), _at(11, "long").alias("mapq"), F.element_at(F.split(tag, ":"), -1).alias("tp"),
    ).dropna(subset=["contig_len", "qs", "qe", "ref_len", "rs", "re", "matches", "aln_len", "mapq"])
    return df.filter(passes(min_len, min_mapq, tp))


def passes(min_len: int, min_mapq: int, tp: tuple[str, ...] | None = ("P", "I")) -> Column:
    """Whether an alignment block passes the gates; a missing tp tag does."""
    gates = (F.col("aln_len") >= min_len) & (F.col("mapq") >= min_mapq) & (F.col("qs") < F.col("qe")) & (F.col("rs") < F.col("re"))
    return gates & (F.col("tp").isNull() | F.col("tp").isin(*tp)) if tp else gates


#: Columns of tabular hits; the last one is missing in twelve-column files.
BLAST = (("qseqid", "string"), ("sseqid", "string"), ("pident", "double"), ("length", "long"), ("mismatch", "long"), ("gapopen", "long"), ("qstart", "long"), ("qend", "long"), ("sstart", "long"), ("send", "long"), ("evalue", "double"), ("bitscore", "double"), ("staxids", "string"))


def blast6(spark: SparkSession, path: str) -> DataFrame:
    """Hits with ordered query range, the first taxid, and matches cut to whole numbers. Lines of fewer than twelve fields, or
    without numbers where they belong, are left out, whichever columns are read; without taxids they are null.
    """
    df = fields(lines(spark, path)).filter(F.size("f") >= 12)
    df = df.select(*(F.get("f", i).try_cast(t).alias(c) if t != "string" else F.get("f", i).alias(c) for i, (c, t) in enumerate(BLAST)))
    df = df.dropna(subset=[c for c, t in BLAST if t != "string"])
    df = df.withColumn("taxid", F.get(F.split("staxids", ";"), 0).try_cast("long")).withColumn("matches", F.floor(F.col("pident") * F.col("length") / 100).cast("long"))
    return df.withColumns({"qstart": F.least("qstart", "qend"), "qend": F.greatest("qstart", "qend")})


GFF = "seqid string, source string, type string, start long, end long, score string, strand string, phase string, attributes string"


def gff3(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(GFF).option("sep", "\t").option("comment", "#").option("mode", "DROPMALFORMED").csv(path).withColumn("attrs", F.expr("str_to_map(attributes, ';', '=')"))


def transcripts(spark: SparkSession, path: str) -> DataFrame:
    """transcript_id, gene_id (first parent, else its own id), ref_id, start0, end0, strand."""
    df = gff3(spark, path).filter(F.lower("type").isin("mrna", "transcript") & (F.col("attrs")["ID"].isNotNull()))
    gene = F.coalesce(F.get(F.split(F.col("attrs")["Parent"], ","), 0), F.col("attrs")["ID"])
    return df.select(F.col("attrs")["ID"].alias("transcript_id"), gene.alias("gene_id"), normalize_ref_id(F.col("seqid")).alias("ref_id"), (F.col("start") - 1).alias("start0"), F.col("end").alias("end0"), F.when(F.col("strand") == "-", "-").otherwise("+").alias("strand"))


def genes(spark: SparkSession, path: str) -> DataFrame:
    return gff3(spark, path).filter(F.lower("type") == "gene").select(normalize_ref_id(F.col("seqid")).alias("ref_id"), F.col("attrs")["ID"].alias("gene_id"))


def gff3_by_refs(spark: SparkSession, path: str, refs: DataFrame) -> DataFrame:
    """Rows on known references, by their own name or its normal form; refs: ref_id, original."""
    df = gff3(spark, path)
    by_norm = refs.groupBy(F.col("ref_id").alias("_norm")).agg(F.min("original").alias("_by_norm"))
    own = refs.select(F.col("original").alias("_own")).distinct()
    out = df.withColumn("_norm", normalize_ref_id(F.col("seqid"))).join(own, F.col("seqid") == F.col("_own"), "left").join(by_norm, "_norm", "left")
    out = out.withColumn("seqid", F.coalesce("_own", "_by_norm")).filter("seqid is not null")
    return out.drop("_norm", "_own", "_by_norm", "attrs")


def depth_bed(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.schema("contig string, start_pos long, end_pos long, depth double").option("sep", "\t").option("mode", "DROPMALFORMED").csv(path)
    return df.filter("start_pos >= 0 and end_pos > start_pos and depth >= 0")


def tax_hits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("contig string, seq_id string, taxid long, score long, second_score long, matching_bp long, read_len long, n_matches long").option("sep", "\t").option("header", True).csv(path)


def tax_names(spark: SparkSession, path: str) -> DataFrame:
    """taxid | name | ..."""
    return lines(spark, path).withColumn("f", F.split("value", "\\s*\\|\\s*")).select(F.trim(_at(0)).try_cast("long").alias("taxid"), F.trim(_at(1)).alias("name")).filter("taxid is not null")


def lineages(spark: SparkSession, path: str) -> DataFrame:
    """taxid, then seven ranks separated by semicolons; empty ranks are null."""
    df = lines(spark, path).withColumn("t", F.split("value", "\t")).withColumn("f", F.split(F.get("t", 1), ";"))
    ranks = ("domain", "kingdom", "phylum", "class", "order", "family", "genus")
    return df.select(F.get("t", 0).try_cast("long").alias("taxid"), *(F.nullif(F.trim(_at(i)), F.lit("")).alias(r) for i, r in enumerate(ranks))).filter("taxid is not null")


def busco(spark: SparkSession, path: str) -> DataFrame:
    """Shares and counts of single, duplicated, fragmented, incomplete and missing genes, and the total."""
    df = spark.read.text(path, wholetext=True)
    out = [F.input_file_name().alias("file")]
    for k in "SDFIM":
        out += [F.regexp_extract("value", f"{k}:\\s*([\\d.]+)%", 1).try_cast("double").alias(f"{k.lower()}_pct"), F.regexp_extract("value", f"{k}:\\s*[\\d.]+%,\\s*(\\d+)", 1).try_cast("long").alias(f"{k.lower()}_n")]
    return df.select(*out, F.regexp_extract("value", "N:\\s*(\\d+)", 1).try_cast("long").alias("n"))


def model_hits(spark: SparkSession, path: str) -> DataFrame:
    """Best significant hit of each covariance model in a table of columns separated by blanks."""
    df = fields(lines(spark, path), "\\s+").filter((F.size("f") >= 17) & (F.get("f", 16) == "!"))
    df = df.select(_at(0).alias("model"), _at(7, "long").alias("start"), _at(8, "long").alias("end"), _at(9).alias("strand"), _at(14, "double").alias("score"))
    return df.groupBy("model").agg(F.max_by(F.struct("start", "end", "strand", "score"), F.struct("score", -F.col("start"))).alias("x")).select("model", "x.*")


def clusters(spark: SparkSession, path: str) -> DataFrame:
    """cluster, member, representative of a cluster file, of which a cluster may span any number of splits."""
    df = carried(spark, path, "^>Cluster\\s+(\\d+)").filter(F.col("mark").isNotNull() & F.col("value").contains(">"))
    return df.select(F.col("mark").cast("long").alias("cluster"), F.regexp_extract("value", ">(.+?)\\.\\.\\.", 1).alias("member"), F.trim("value").endswith("*").alias("representative"))


def agp(spark: SparkSession, path: str) -> DataFrame:
    df = fields(lines(spark, path)).filter(F.get("f", 4) == "W")
    return df.select(_at(0).alias("object"), _at(1, "long").alias("beg"), _at(2, "long").alias("end"), _at(3, "long").alias("part"), _at(5).alias("component"), F.coalesce(_at(8), F.lit("+")).alias("orientation"))


def confidence(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("sep", "\t").option("header", True).csv(path)


def tsv(spark: SparkSession, path: str, schema: str | None = None, assembly: str | None = None) -> DataFrame:
    """A table with header; with an assembly column if given."""
    reader = spark.read.option("sep", "\t").option("header", True)
    df = (reader.schema(schema) if schema else reader).csv(path)
    return df.withColumn("assembly", F.lit(assembly)) if assembly else df


def bound(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def rebuilt(components: DataFrame, seqs: DataFrame, gap: int = 100) -> tuple[DataFrame, DataFrame]:
    """Sequences of AGP objects from their components, and components that no object places."""
    from ..functions.sequence import reverse_complement

    df = components.join(seqs.select(F.col("name").alias("component"), "seq"), "component")
    df = df.withColumn("seq", F.when(F.col("orientation") == "-", reverse_complement(F.col("seq"))).otherwise(F.col("seq")))
    whole = df.groupBy("object").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "seq"))), lambda x: x["seq"]), "N" * gap).alias("seq"))
    return whole, seqs.join(components.select(F.col("component").alias("name")), "name", "left_anti")


def without_suffix(name: str) -> str:
    for s in sorted(FASTA_SUFFIXES, key=len, reverse=True):
        if name.lower().endswith(s):
            return name[: -len(s)]
    return name


def file_list(path: str, reads: str | None = None) -> list[tuple[str, str, str | None]]:
    """(path, name, reads) of a list of files with an optional header; paths are relative to the list."""
    out, base = [], os.path.dirname(os.path.abspath(path))
    with open(path) as f:
        for line in f:
            cells = [c.strip() for c in line.rstrip("\n").split("\t")]
            if not cells[0] or cells[0].startswith("#") or (not out and cells[0].lower() == "path"):
                continue
            cells += [""] * (3 - len(cells))
            full = cells[0] if os.path.isabs(cells[0]) else os.path.join(base, cells[0])
            own = cells[2] and (cells[2] if os.path.isabs(cells[2]) else os.path.join(base, cells[2]))
            out.append((full, cells[1] or without_suffix(os.path.basename(full)), own or reads))
    names = [n for _, n, _ in out]
    if twice := sorted({n for n in names if names.count(n) > 1}):
        raise ValueError(f"names given twice: {', '.join(twice)}")
    return out


def folder(path: str, reads: str | None = None) -> list[tuple[str, str, str | None]]:
    files = sorted(f for f in os.listdir(path) if f.lower().endswith(FASTA_SUFFIXES))
    names = [without_suffix(f) for f in files]
    return [(os.path.join(path, f), n if names.count(n) == 1 else f, reads) for f, n in zip(files, names)]


def assemblies(spark: SparkSession, rows: list[tuple[str, str, str | None]]) -> DataFrame:
    return spark.createDataFrame(rows, "path string, assembly string, reads string")


def read_format(path: str) -> str:
    low = path.lower()
    for kind, ends in (("bam", (".bam",)), ("cram", (".cram",)), ("sam", (".sam",)), ("fastq", (".fq", ".fastq", ".fq.gz", ".fastq.gz")), ("fasta", FASTA_SUFFIXES)):
        if low.endswith(ends):
            return kind
    return "unknown"


def settings(path: str, given: dict | None = None) -> dict:
    """A TOML file's values by section_key, under those given."""
    with open(path, "rb") as f:
        data = tomllib.load(f)
    flat = {k: v for k, v in data.items() if not isinstance(v, dict)} | {k: v for s in data.values() if isinstance(s, dict) for k, v in s.items()}
    return flat | {k: v for k, v in (given or {}).items() if v is not None}
