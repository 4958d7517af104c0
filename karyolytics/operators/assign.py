"""Assignment of contigs to references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from .evidence import CONTIG

NO_SECOND = 1e9


def best_second(evidence: DataFrame, score: str = "union_bp") -> DataFrame:
    """Best and second reference by score; equal scores go by name."""
    w = W.partitionBy(*CONTIG).orderBy(F.desc(score), "ref_id")
    r = evidence.withColumn("_r", F.row_number().over(w)).filter("_r <= 2")
    at = lambda k, c: F.max(F.when(F.col("_r") == k, F.col(c)))
    return r.groupBy(*CONTIG).agg(at(1, "ref_id").alias("best_ref"), at(1, score).alias("best_bp"), at(2, "ref_id").alias("second_ref"), F.coalesce(at(2, score), F.lit(0)).alias("second_bp"))


def synteny_gate(cfg: Config) -> Column:
    return (F.col("n_blocks") >= cfg.synteny_min_segments) & (F.col("q_max") - F.col("q_min") >= cfg.synteny_min_span) & ((F.col("q_max") - F.col("q_min")) / F.col("contig_len") >= cfg.synteny_min_frac) & (F.col("n_genes") >= cfg.synteny_min_genes)


def gate_rerank(evidence: DataFrame, contigs: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Best and second among pairs that pass the gate; contigs without any keep nulls."""
    passed = evidence.join(contigs, CONTIG).filter(synteny_gate(cfg))
    return contigs.select(*CONTIG).join(best_second(passed), CONTIG, "left")


def assign_status(ranked: DataFrame, totals: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    df = totals.join(ranked, CONTIG, "left")
    ratio = F.when(F.coalesce("second_bp", F.lit(0)) > 0, F.round(F.col("best_bp") / F.col("second_bp"), 6)).otherwise(NO_SECOND)
    frac = F.round(F.coalesce("best_bp", F.lit(0)) / F.col("total_bp"), 6)
    status = F.when(F.col("best_ref").isNull(), "NO_HITS").when(frac < cfg.assign_min_frac, "AMBIG_LOW_FRAC").when(ratio < cfg.assign_min_ratio, "AMBIG_LOW_RATIO").otherwise("OK")
    return df.select(*CONTIG, "best_ref", frac.alias("frac"), ratio.alias("ratio"), status.alias("status"))


def chimera_flag(ranked: DataFrame, totals: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    df = totals.join(ranked, CONTIG)
    flag = (F.col("n_refs") >= 2) & (F.col("best_bp") < cfg.chimera_primary * F.col("total_bp")) & (F.col("second_bp") >= cfg.chimera_secondary * F.col("total_bp"))
    return df.select(*CONTIG, flag.alias("chimeric"))


def reciprocal_pairs(ranked: DataFrame) -> DataFrame:
    """Contigs assigned to A with second B for which the assembly has one assigned to B with second A."""
    other = ranked.select("assembly", F.col("best_ref").alias("second_ref"), F.col("second_ref").alias("best_ref")).distinct()
    return ranked.filter("second_ref is not null").join(other, ["assembly", "best_ref", "second_ref"], "left_semi").select(*CONTIG, "best_ref", "second_ref")


def resolve_reciprocal(spans: DataFrame) -> DataFrame:
    """spans: assembly, contig, best_ref, best_frac, second_ref, second_frac, the last two null without a second reference.

    Of the contigs of a reference the two of largest share are looked at: if both have the same second reference, with a
    share of 0.05 at least, and nothing of the assembly is assigned there, the weaker one moves to it; of the other contigs
    of the reference those with that second reference follow. A reference that a contig moved to is taken for those that
    come later in order of name; equal shares go by name. Gives one row for each move.

    Only the conflict between references needs an order: it is settled on one row for each reference of an assembly.
    """
    w = W.partitionBy("assembly", "best_ref").orderBy(F.desc("best_frac"), "contig")
    df = spans.withColumn("_r", F.row_number().over(w))
    at = lambda k, c: F.max(F.when(F.col("_r") == k, F.col(c)))
    pair = df.groupBy("assembly", "best_ref").agg(at(1, "second_ref").alias("a"), at(1, "second_frac").alias("fa"), at(2, "second_ref").alias("b"), at(2, "second_frac").alias("fb"))
    wanted = pair.filter("a = b and fa >= 0.05 and fb >= 0.05").select("assembly", "best_ref", F.col("a").alias("new_ref"))
    taken = spans.select("assembly", F.col("best_ref").alias("new_ref")).distinct()
    first = wanted.join(taken, ["assembly", "new_ref"], "left_anti").groupBy("assembly", "new_ref").agg(F.min("best_ref").alias("best_ref"))
    moved = df.join(first, ["assembly", "best_ref"]).filter("_r >= 2 and second_ref = new_ref")
    return moved.select("assembly", "contig", F.col("best_ref").alias("old_ref"), "new_ref")
