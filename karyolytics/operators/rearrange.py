"""Structural rearrangements as compositions of evidence, islands and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from .classify import rearrangement_confidence
from .evidence import CONTIG, PAIR
from .intervals import union_bp


def translocations(evidence: DataFrame, best: DataFrame, contigs: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    off = evidence.join(best.select(*CONTIG, "best_ref"), CONTIG).filter("ref_id <> best_ref").join(contigs, CONTIG).withColumn("span", F.col("q_max") - F.col("q_min"))
    off = off.filter((F.col("span") >= cfg.translocation_span) & (F.col("union_bp") >= cfg.translocation_bp))
    swapped = off.select("assembly", F.col("best_ref").alias("ref_id"), F.col("ref_id").alias("best_ref")).distinct().withColumn("reciprocal", F.lit(True))
    off = off.join(swapped, ["assembly", "ref_id", "best_ref"], "left").withColumn("reciprocal", F.coalesce("reciprocal", F.lit(False)))
    edge = F.least(F.lit(cfg.terminal_bp).cast("long"), F.floor(cfg.terminal_frac * F.col("contig_len")))
    first, last = F.col("q_min") <= edge, F.col("q_max") >= F.col("contig_len") - edge
    kind = F.when(F.col("reciprocal"), "reciprocal_translocation").when(first != last, "terminal_translocation").otherwise("translocation")
    return off.select(*CONTIG, "best_ref", "ref_id", "span", kind.alias("kind"), rearrangement_confidence(F.col("span"), F.col("reciprocal")).alias("confidence"))


def inversions(blocks: DataFrame, best: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Runs of the minority strand on the assigned reference; + is the majority on ties."""
    df = blocks.join(best.select(*CONTIG, F.col("best_ref").alias("ref_id")), PAIR)
    ties = ["qs", "qe", "rs", "re", "l_orderkey", "l_linenumber", "l_partkey"]
    plus = F.sum(F.when(F.col("strand") == "+", F.col("aln_len")).otherwise(-F.col("aln_len"))).over(W.partitionBy(*PAIR))
    w = W.partitionBy(*PAIR).orderBy(*ties)
    df = df.withColumn("major", F.when(plus >= 0, "+").otherwise("-")).withColumn("_new", F.coalesce((F.lag("strand").over(w) != F.col("strand")).cast("int"), F.lit(1)))
    df = df.withColumn("run", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0))).filter("strand <> major")
    out = df.groupBy(*PAIR, "run").agg(F.min("qs").alias("start"), F.max("qe").alias("end"), F.count("*").alias("n_blocks")).withColumn("span", F.col("end") - F.col("start"))
    return out.filter(F.col("span") >= cfg.inversion_span).select(*PAIR, "start", "end", "n_blocks", "span")


def fusions(evidence: DataFrame, contigs: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Pairs of references that each cover a good part of a contig. A contig has at most three of them."""
    big = evidence.join(contigs, CONTIG).filter(F.col("union_bp") >= cfg.fusion_frac * F.col("contig_len")).select(*CONTIG, "ref_id", "q_min", "union_bp")
    a = big.select(*CONTIG, F.col("ref_id").alias("ref_a"), F.col("q_min").alias("a"))
    b = big.select(*CONTIG, F.col("ref_id").alias("ref_b"), F.col("q_min").alias("b"))
    return a.join(b, CONTIG).filter((F.col("a") < F.col("b")) | ((F.col("a") == F.col("b")) & (F.col("ref_a") < F.col("ref_b")))).select(*CONTIG, "ref_a", "ref_b")


def fissions(ranges: DataFrame, best: DataFrame, refs: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """ranges: reference start and end of each pair. References that several assigned contigs cover together, none alone."""
    df = ranges.join(best.select(*CONTIG, F.col("best_ref").alias("ref_id")), PAIR).join(refs, "ref_id").withColumn("share", (F.col("ref_end") - F.col("ref_start")) / F.col("ref_len"))
    keys = ["assembly", "ref_id"]
    sums = df.groupBy(*keys).agg(F.count("*").alias("n_contigs"), F.max("share").alias("top"), F.first("ref_len").alias("ref_len"))
    out = union_bp(df, keys, "ref_start", "ref_end").join(sums, keys).withColumn("coverage", F.round(F.col("union_bp") / F.col("ref_len"), 6))
    out = out.filter((F.col("n_contigs") >= 2) & (F.col("coverage") >= cfg.fission_cov) & (F.col("top") <= cfg.fission_single))
    return out.select(*keys, "n_contigs", "coverage", (F.col("coverage") > cfg.fission_collinear).alias("collinear"))


def fusion_calls(evidence: DataFrame, best: DataFrame, contigs: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Every pair of references of a contig that each cover a good part of it. The partner is the one the contig isn't assigned
    to; if it is assigned to neither, the one that covers less, the first by position where both cover as much as the other.
    """
    big = evidence.join(contigs, CONTIG).filter(F.col("union_bp") >= cfg.fusion_frac * F.col("contig_len"))
    side = lambda x: big.select(*CONTIG, *(F.col(c).alias(f"{c}_{x}") for c in ("ref_id", "q_min", "q_max", "union_bp")))
    pair = side("a").join(side("b"), CONTIG).filter(F.struct("q_min_a", "ref_id_a") < F.struct("q_min_b", "ref_id_b")).join(best.select(*CONTIG, "best_ref"), CONTIG)
    partner = F.when(F.col("ref_id_a") == F.col("best_ref"), F.col("ref_id_b")).when(F.col("ref_id_b") == F.col("best_ref"), F.col("ref_id_a")).when(F.col("union_bp_a") >= F.col("union_bp_b"), F.col("ref_id_b")).otherwise(F.col("ref_id_a"))
    span = F.col("union_bp_a") + F.col("union_bp_b")
    start, end = F.least("q_min_a", "q_min_b"), F.greatest("q_max_a", "q_max_b")
    return pair.select(*CONTIG, F.col("best_ref").alias("ref_id"), F.lit("fusion").alias("kind"), partner.alias("partner"), start.alias("q_start"), end.alias("q_end"), F.lit(0).cast("long").alias("r_start"), F.lit(0).cast("long").alias("r_end"), span.alias("span"), rearrangement_confidence(span, F.lit(True)).alias("confidence"))


def fission_calls(ranges: DataFrame, best: DataFrame, contigs: DataFrame, refs: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """One call for each contig of a reference that several assigned contigs cover together, none of them alone."""
    keys = ["assembly", "ref_id"]
    df = ranges.join(best.select(*CONTIG, F.col("best_ref").alias("ref_id")), PAIR).join(contigs, CONTIG)
    found = fissions(ranges, best, refs, cfg).join(refs, "ref_id").select(*keys, (F.col("coverage") * F.col("ref_len")).alias("covered"), "collinear")
    conf = rearrangement_confidence(F.col("covered"), F.col("collinear"))
    return df.join(found, keys).select(*CONTIG, "ref_id", F.lit("fission").alias("kind"), F.lit(None).cast("string").alias("partner"), F.lit(0).cast("long").alias("q_start"), F.col("contig_len").alias("q_end"), F.col("ref_start").alias("r_start"), F.col("ref_end").alias("r_end"), (F.col("ref_end") - F.col("ref_start")).alias("span"), conf.alias("confidence"))


def rearrangements(blocks: DataFrame, evidence: DataFrame, best: DataFrame, ranges: DataFrame, contigs: DataFrame, refs: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """All calls in one form: assembly, contig, ref_id, kind, partner, q_start, q_end, r_start, r_end, span, confidence."""
    none, zero = F.lit(None).cast("string"), F.lit(0).cast("long")
    moved = translocations(evidence, best, contigs, cfg).join(evidence.select(*PAIR, "q_min", "q_max"), PAIR).join(ranges.select(*PAIR, "ref_start", "ref_end"), PAIR)
    moved = moved.select(*CONTIG, F.col("best_ref").alias("ref_id"), "kind", F.col("ref_id").alias("partner"), F.col("q_min").alias("q_start"), F.col("q_max").alias("q_end"), F.col("ref_start").alias("r_start"), F.col("ref_end").alias("r_end"), "span", "confidence")
    turned = inversions(blocks, best, cfg).select(*CONTIG, "ref_id", F.lit("inversion").alias("kind"), none.alias("partner"), F.col("start").alias("q_start"), F.col("end").alias("q_end"), zero.alias("r_start"), zero.alias("r_end"), "span", rearrangement_confidence(F.col("span"), F.col("n_blocks") >= 3).alias("confidence"))
    return moved.unionByName(turned).unionByName(fusion_calls(evidence, best, contigs, cfg)).unionByName(fission_calls(ranges, best, contigs, refs, cfg))


def homeologous(chrom_a, sub_a, chrom_b, sub_b):
    return (chrom_a == chrom_b) & (sub_a != sub_b)
