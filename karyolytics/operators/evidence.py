"""Evidence of contig-reference pairs, from alignment blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from .intervals import dealt, islands, shuffled, tasks, union_bp

PAIR = ["assembly", "contig", "ref_id"]
CONTIG = ["assembly", "contig"]
BLOCK = ["qs", "qe", "rs", "re"]


def chain_weight(mode: str, matches: Column, qbp: Column, ident: Column, aln_len: Column) -> Column:
    of = {"matches": matches.cast("double"), "qbp_ident": qbp * ident, "matches_ident": matches * ident}
    return F.when(aln_len <= 0, 0.0).otherwise(of[mode])


def diagonal(strand: Column, qs: Column, rs: Column) -> Column:
    return F.when(strand == "-", rs + qs).otherwise(rs - qs)


def pair_evidence(blocks: DataFrame, n: int | None = None) -> DataFrame:
    """Union of query intervals, sums, identity and genes of each pair; one shuffle serves window and aggregate."""
    order = W.partitionBy(*PAIR).orderBy("qs", "qe").rowsBetween(W.unboundedPreceding, -1)
    new = F.greatest(F.lit(0), F.col("qe") - F.greatest(F.col("qs"), F.coalesce(F.max("qe").over(order), F.col("qs"))))
    out = dealt(blocks, PAIR, n).withColumn("_new", new).groupBy(*PAIR).agg(
        F.sum("_new").cast("long").alias("union_bp"), F.sum("matches").alias("matches"), F.sum("aln_len").alias("aln_len"), F.countDistinct("gene_id").alias("n_genes"), F.count("*").alias("n_blocks"), F.min("qs").alias("q_min"), F.max("qe").alias("q_max")
    )
    return out.withColumn("identity", F.round(F.col("matches") / F.col("aln_len"), 6))


def ref_span(blocks: DataFrame) -> DataFrame:
    n = tasks(blocks)
    span = union_bp(blocks, PAIR, "rs", "re", "ref_union_bp", n)
    return span.join(blocks.groupBy(*PAIR).agg(F.min("rs").alias("ref_start"), F.max("re").alias("ref_end")), PAIR)


def contig_totals(evidence: DataFrame) -> DataFrame:
    return evidence.groupBy(*CONTIG).agg(F.sum("union_bp").alias("total_bp"), F.count("*").alias("n_refs"))


def topk_score(chains: DataFrame, keys: list[str], score: str, k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(score)))
    return chains.withColumn("_r", rank).filter(F.col("_r") <= k).groupBy(*keys).agg(F.sum(score).alias("topk_score"))


def strand_votes(blocks: DataFrame) -> DataFrame:
    """Neighbours by query midpoint vote on the direction of the reference; near midpoints don't vote."""
    w = W.partitionBy(*PAIR).orderBy(F.col("qs") + F.col("qe"), *BLOCK, "l_orderkey", "l_linenumber", "l_partkey")
    q, r = F.col("qs") + F.col("qe"), F.col("rs") + F.col("re")
    df = blocks.withColumn("_dq", q - F.lag(q).over(w)).withColumn("_dr", r - F.lag(r).over(w))
    ok = F.abs("_dq") >= 200
    out = df.groupBy(*PAIR).agg(F.count_if(ok & (F.col("_dr") > 0)).alias("forward"), F.count_if(ok & (F.col("_dr") < 0)).alias("reverse"))
    return out.withColumn("strand", F.when(F.col("reverse") > F.col("forward"), "-").otherwise("+"))


def collinearity(chains: DataFrame, ties: list[str]) -> DataFrame:
    """Share of neighbouring chains, weighted by the smaller one, that keep strand and direction."""
    w = W.partitionBy(*PAIR).orderBy(F.col("qs") + F.col("qe"), *BLOCK, *ties)
    r = F.col("rs") + F.col("re")
    df = chains.withColumn("_w", F.when(F.lead("matches").over(w).isNotNull(), F.least("matches", F.lead("matches").over(w))))
    df = df.withColumn("_same", (F.lead("strand").over(w) == F.col("strand")) & F.when(F.col("strand") == "+", F.lead(r).over(w) > r).otherwise(F.lead(r).over(w) < r))
    out = df.groupBy(*PAIR).agg(F.coalesce(F.sum("_w"), F.lit(0)).alias("weight"), F.coalesce(F.sum(F.when(F.col("_same"), F.col("_w"))), F.lit(0)).alias("kept"))
    return out.select(*PAIR, "weight", F.when(F.col("weight") == 0, 1.0).otherwise(F.round(F.col("kept") / F.col("weight"), 6)).alias("collinearity"))


def orientation_votes(blocks: DataFrame, best: DataFrame) -> DataFrame:
    got = blocks.join(shuffled(best.select(*CONTIG, F.col("best_ref").alias("ref_id"))), PAIR)
    got = got.groupBy(*CONTIG).agg(F.sum(F.when(F.col("strand") == "+", F.col("matches")).otherwise(0)).alias("forward_bp"), F.sum(F.when(F.col("strand") == "-", F.col("matches")).otherwise(0)).alias("reverse_bp"))
    return got.withColumn("reverse", F.col("reverse_bp") > F.col("forward_bp"))


def largest_cluster(blocks: DataFrame, cfg: Config = DEFAULT, n: int | None = None) -> DataFrame:
    """Of each pair the island with the widest span; the first one on ties."""
    c = islands(dealt(blocks, PAIR, n), PAIR, "qs", "qe", cfg.cluster_gap).groupBy(*PAIR, "island").agg(F.min("qs").alias("c_start"), F.max("qe").alias("c_end"), F.sum("matches").alias("aligned_bp"), F.countDistinct("gene_id").alias("n_genes"))
    c = c.withColumn("span_bp", F.col("c_end") - F.col("c_start"))
    best = F.row_number().over(W.partitionBy(*PAIR).orderBy(F.desc("span_bp"), "c_start"))
    return c.withColumn("_r", best).filter("_r = 1").select(*PAIR, "c_start", "span_bp", "aligned_bp", "n_genes")


def segment_support(evidence: DataFrame, chrom: Column, sub: Column) -> DataFrame:
    return evidence.groupBy(*CONTIG, chrom.alias("chrom_id"), sub.alias("subgenome")).agg(F.count("*").alias("n_segments"), (F.max("q_max") - F.min("q_min")).alias("span_bp"))


def rearrangement_candidates(clusters: DataFrame, best: DataFrame, contigs: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """References off the assigned one with a large and dense cluster, as a list by falling span."""
    c = clusters.join(best.select(*CONTIG, "best_ref"), CONTIG).filter("ref_id <> best_ref").join(contigs, CONTIG)
    c = c.filter((F.col("span_bp") >= cfg.rearrangement_frac * F.col("contig_len")) & (F.col("aligned_bp") >= cfg.density_frac * F.col("span_bp")))
    c = c.groupBy(*CONTIG).agg(F.sort_array(F.collect_list(F.struct((-F.col("span_bp")).alias("k"), "ref_id"))).alias("x"))
    return c.select(*CONTIG, F.array_join(F.transform("x", lambda x: x["ref_id"]), ",").alias("candidates"))
