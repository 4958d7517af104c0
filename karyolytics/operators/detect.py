"""Organelle, rDNA, debris and contaminant detection from hit tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.ids import is_circular
from .evidence import CONTIG
from .intervals import dealt, shuffled, tasks, union_bp

#: Eukaryote kingdoms by clade.
KINGDOMS = {"Viridiplantae": "Plant", "Fungi": "Fungi", "Metazoa": "Animal"}


def hit_coverage(hits: DataFrame, keys: list[str], n: int | None = None) -> DataFrame:
    """Union of query ranges, mean identity by length and the hit of least e-value, of each key."""
    n = tasks(hits) if n is None else n
    hits = dealt(hits, keys, n)
    best = F.min_by("sseqid", F.struct("evalue_rank", "o_orderkey"))
    sums = hits.groupBy(*keys).agg(F.count("*").alias("n_hits"), F.sum("length").alias("hit_bp"), F.sum(F.floor(F.col("pident") * F.col("length") / 100)).cast("long").alias("matches"), best.alias("best_subject"))
    return union_bp(hits, keys, "qstart", "qend", n=1).join(shuffled(sums), keys)


def on_contigs(cov: DataFrame, contigs: DataFrame) -> DataFrame:
    """Coverage of query ids, as share of their contig of the same assembly."""
    df = cov.withColumnRenamed("qseqid", "contig").join(shuffled(contigs), CONTIG)
    return df.withColumn("coverage", F.round(F.least(F.lit(1.0), F.col("union_bp") / F.col("contig_len")), 6))


def organelle_select(cov: DataFrame, contigs: DataFrame, ref_len: Column, tolerance: Column, cfg: Config = DEFAULT) -> DataFrame:
    """cov: assembly, qseqid, sseqid, union_bp. Candidates by coverage and length; of an assembly's candidates for a subject
    the circular and closest one is chosen. Others of half coverage are debris.
    """
    off = F.abs(F.col("contig_len") - ref_len)
    df = on_contigs(cov, contigs).withColumn("off", off).withColumn("kind", F.when((F.col("coverage") >= cfg.organelle_cov) & (off <= tolerance * ref_len), "candidate").when(F.col("coverage") >= 0.5, "debris").otherwise("none"))
    rank = F.row_number().over(W.partitionBy("assembly", "sseqid", "kind").orderBy(is_circular(F.col("contig")).desc(), "off", "contig"))
    return df.withColumn("chosen", (F.col("kind") == "candidate") & (rank == 1)).select(*CONTIG, "sseqid", "coverage", "off", "kind", "chosen")


def covered_contigs(cov: DataFrame, contigs: DataFrame, least: float) -> DataFrame:
    return on_contigs(cov, contigs).filter(F.col("coverage") >= least).select(*CONTIG, "coverage")


def debris(cov: DataFrame, contigs: DataFrame, cfg: Config = DEFAULT, least_cov: float | None = None) -> DataFrame:
    df = on_contigs(cov, contigs).withColumn("identity", F.round(F.col("matches") / F.col("hit_bp"), 6))
    return df.filter((F.col("coverage") >= (cfg.debris_cov if least_cov is None else least_cov)) & (F.col("identity") >= cfg.debris_ident)).select(*CONTIG, "coverage", "identity")


def reference_debris(cov: DataFrame, genes: DataFrame, least_cov: float = 0.5, least_hits: int = 2) -> DataFrame:
    """Contigs covered by alignment, or hit by genes; those with gene hits need no alignment."""
    by_genes = genes.filter(F.col("gene_hits") >= least_hits).select(*CONTIG)
    by_cov = cov.filter(F.col("coverage") >= least_cov).select(*CONTIG)
    return by_genes.unionByName(by_cov.join(by_genes, CONTIG, "left_anti")).distinct()


def contaminants(hits: DataFrame, taxa: DataFrame, contigs: DataFrame, cfg: Config = DEFAULT, least_cov: float = 0.0) -> DataFrame:
    """The taxon of each contig by summed score among hits past the score gate, with coverage and lineage.

    Those that cover too little of their contig are no contaminants where least_cov asks for it.
    """
    kept = hits.filter(F.col("score") >= cfg.contaminant_score)
    per = kept.groupBy(*CONTIG, "taxid").agg(F.sum("score").alias("score"), F.sum("matching_bp").alias("matching_bp"))
    top = per.withColumn("_r", F.row_number().over(W.partitionBy(*CONTIG).orderBy(F.desc("score"), "taxid"))).filter("_r = 1").drop("_r")
    top = top.join(taxa, "taxid", "left").join(shuffled(contigs), CONTIG)
    out = top.select(*CONTIG, "taxid", F.coalesce("name", F.lit("unknown")).alias("name"), "kingdom", "score", F.round(F.col("matching_bp") / F.col("contig_len"), 6).alias("coverage"))
    return out.filter(F.col("coverage") >= least_cov) if least_cov else out


def kingdom(clade: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, v in KINGDOMS.items():
        out = F.when(clade == k, v).otherwise(out)
    return F.coalesce(out, clade)


def gene_counts(genes: DataFrame) -> DataFrame:
    return genes.groupBy("ref_id").agg(F.countDistinct("gene_id").alias("n_genes"))
