"""Decision tables, the precedence cascade and names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from .evidence import CONTIG
from .intervals import shuffled

#: Classes in order of precedence.
CLASSES = ("chrom_assigned", "chrom_unassigned", "organelle_complete", "organelle_debris", "rDNA", "contaminant", "chrom_debris", "debris", "unclassified")


def full_length(n_telomeres: Column, ratio: Column, coverage: Column, cfg: Config = DEFAULT) -> tuple[Column, Column]:
    """(is full length, confidence) by telomeres, length ratio and reference coverage."""
    long, cov = ratio >= cfg.full_length_ratio, coverage >= cfg.full_length_cov
    yes = F.when(n_telomeres >= 2, True).when(long, True).otherwise(cov)
    conf = F.when(n_telomeres >= 2, "high").when(long, F.when(n_telomeres == 1, "medium").otherwise("low")).when(n_telomeres == 1, "medium").otherwise("low")
    return yes, conf


def rearrangement_confidence(span: Column, supported: Column) -> Column:
    return F.when((span > 1_000_000) & supported, "high").when(span > 1_000_000, "medium").when((span >= 50_000) & supported, "medium").otherwise("low")


def synteny_score(mode: str, coverage: Column, gene_prop: Column) -> Column:
    return F.least(F.lit(1.0), coverage if mode == "nucleotide" else 2 * gene_prop)


def cascade(contigs: DataFrame) -> DataFrame:
    """contigs has a boolean column for each kind of evidence; the first that holds gives the class."""
    c = F.col
    chrom = c("assigned") & c("chromosome_like")
    out = F.when(chrom, CLASSES[0]).when(c("chromosome_like") & ~c("contaminant"), CLASSES[1]).when(c("organelle"), CLASSES[2]).when(c("organelle_debris"), CLASSES[3])
    out = out.when(c("rdna"), CLASSES[4]).when(c("contaminant"), CLASSES[5]).when(c("chrom_debris"), CLASSES[6]).when(c("debris"), F.when(c("assigned"), CLASSES[6]).otherwise(CLASSES[7])).otherwise(CLASSES[8])
    return contigs.withColumn("class", out)


def exclude(contigs: DataFrame, *taken: DataFrame) -> DataFrame:
    """Contigs of an assembly that are in none of the tables."""
    for t in taken:
        contigs = contigs.join(shuffled(t.select(*CONTIG)), CONTIG, "left_anti")
    return contigs


def names(contigs: DataFrame) -> DataFrame:
    """contigs: assembly, contig, ref_id, subgenome (of the query, null for the primary one), full_length, identity, length.

    Those of a reference and subgenome are named after both, several full-length ones as copies and others as fragments,
    by falling identity; contigs without reference by falling length.
    """
    on = F.col("ref_id").isNotNull()
    kind = F.when(on & F.col("full_length"), "c").when(on, "f").otherwise("o")
    df = contigs.withColumn("_kind", kind)
    group = W.partitionBy("assembly", "ref_id", F.when(on, F.col("subgenome")), "_kind")
    n = F.row_number().over(group.orderBy(F.coalesce("identity", F.lit(0.0)).desc(), F.desc("length"), "contig"))
    other = F.row_number().over(W.partitionBy("assembly", "_kind").orderBy(F.desc("length"), "contig"))
    base = F.concat_ws("_", "ref_id", "subgenome")
    named = F.when(F.col("_kind") == "o", F.concat(F.lit("contig_"), other)).when((F.col("_kind") == "c") & (F.count("*").over(group) == 1), base).otherwise(F.concat(base, F.lit("_"), "_kind", n))
    return df.withColumn("name", named).drop("_kind")
