"""Assembly statistics and comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import Config
from .chaining import chain_greedy, macro_blocks
from .intervals import dealt, overlap_join, tasks


def n50(contigs: DataFrame) -> DataFrame:
    w = W.partitionBy("assembly").orderBy(F.desc("contig_len"), "contig")
    df = contigs.withColumn("_cum", F.sum("contig_len").over(w.rowsBetween(W.unboundedPreceding, 0))).withColumn("_n", F.row_number().over(w)).withColumn("_total", F.sum("contig_len").over(W.partitionBy("assembly")))
    hit = 2 * F.col("_cum") >= F.col("_total")
    return df.groupBy("assembly").agg(F.max("_total").alias("total_bp"), F.count("*").alias("n_contigs"), F.max(F.when(hit, F.col("contig_len"))).alias("n50"), F.min(F.when(hit, F.col("_n"))).cast("long").alias("l50"))


def nx_curve(contigs: DataFrame) -> DataFrame:
    """Lengths at 0 to 100 % of each assembly; 0 is the longest contig."""
    w = W.partitionBy("assembly").orderBy(F.desc("contig_len"), "contig")
    df = contigs.select("assembly", "contig_len", F.sum("contig_len").over(w.rowsBetween(W.unboundedPreceding, 0)).alias("cum"), F.sum("contig_len").over(W.partitionBy("assembly")).alias("total"))
    # each contig stands for the x between the sum before it and the sum with it
    x = F.sequence(F.ceil(100 * (F.col("cum") - F.col("contig_len")) / F.col("total")).cast("int"), F.floor(100 * F.col("cum") / F.col("total")).cast("int"))
    df = df.filter(F.ceil(100 * (F.col("cum") - F.col("contig_len")) / F.col("total")) <= F.floor(100 * F.col("cum") / F.col("total")))
    return df.select("assembly", F.explode(x).alias("x"), "contig_len").groupBy("assembly", "x").agg(F.max("contig_len").alias("nx"))


def summary(classified: DataFrame) -> DataFrame:
    of = lambda c: F.col("class") == c
    return classified.groupBy("assembly").agg(F.count("*").alias("n_contigs"), F.sum("contig_len").alias("total_bp"), F.count_if(of("chrom_assigned")).alias("n_chrom"), F.coalesce(F.sum(F.when(of("chrom_assigned"), F.col("contig_len"))), F.lit(0)).alias("chrom_bp"), F.count_if(of("unclassified")).alias("n_unclassified"), F.count_if(F.col("full_length")).alias("n_full_length"))


def completeness(contigs: DataFrame, refs: DataFrame) -> DataFrame:
    """The complete matrix of assembly and reference; both sides are small: assemblies and reference names."""
    grid = contigs.select("assembly").distinct().crossJoin(F.broadcast(refs.select("ref_id")))
    per = contigs.groupBy("assembly", "ref_id").agg(F.count("*").alias("n"), F.sum("contig_len").alias("bp"), F.max("frac").alias("max_frac"), F.bool_or("full_length").alias("any_full"))
    return grid.join(per, ["assembly", "ref_id"], "left").select("assembly", "ref_id", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("bp", F.lit(0)).alias("bp"), "max_frac", F.coalesce("any_full", F.lit(False)).alias("any_full"))


def class_pivot(classified: DataFrame, classes: tuple[str, ...]) -> DataFrame:
    return classified.groupBy("assembly").pivot("class", list(classes)).agg(F.count(F.lit(1))).fillna(0)


def class_breakdown(classified: DataFrame) -> DataFrame:
    """Per class share of the total in whole percent and its running range."""
    g = classified.groupBy("assembly", "class").agg(F.count("*").alias("n"), F.sum("contig_len").alias("bp"))
    w = W.partitionBy("assembly").orderBy(F.desc("bp"), "class")
    return g.withColumn("to_bp", F.sum("bp").over(w.rowsBetween(W.unboundedPreceding, 0))).withColumn("from_bp", F.col("to_bp") - F.col("bp")).withColumn("pct", F.round(100 * F.col("bp") / F.sum("bp").over(W.partitionBy("assembly")), 4))


def depth_stats(depth: DataFrame, contigs: DataFrame) -> DataFrame:
    """Mean by window size, spread, range and breadth of each contig of an assembly; contigs without windows have zeros."""
    keys, size = ["assembly", "contig"], F.col("end_pos") - F.col("start_pos")
    d = depth.filter((F.col("start_pos") >= 0) & (size > 0) & (F.col("depth") >= 0))
    g = d.groupBy(*keys).agg(F.count("*").alias("n_windows"), (F.sum(F.col("depth") * size) / F.sum(size)).alias("mean"), F.median("depth").alias("median"), F.stddev_samp("depth").alias("sd"), F.min("depth").alias("low"), F.max("depth").alias("high"), F.sum(F.when(F.col("depth") >= 1, size)).alias("b1"), F.sum(F.when(F.col("depth") >= 10, size)).alias("b10"))
    df = contigs.select(*keys, "contig_len").join(g, keys, "left")
    part = lambda b: F.round(F.least(F.lit(1.0), F.coalesce(b, F.lit(0)) / F.col("contig_len")), 6)
    zero = lambda c: F.round(F.coalesce(c, F.lit(0.0)), 4)
    return df.select(*keys, F.coalesce("n_windows", F.lit(0)).alias("n_windows"), zero("mean").alias("mean"), zero("median").alias("median"), zero("sd").alias("sd"), zero("low").alias("low"), zero("high").alias("high"), part(F.col("b1")).alias("breadth_1"), part(F.col("b10")).alias("breadth_10"))


def assembly_pairs(present: DataFrame) -> DataFrame:
    """present: ord, ref_id. Of each assembly the nearest earlier one that has the reference, and whether it is the neighbour."""
    w = W.partitionBy("ref_id").orderBy("ord")
    return present.withColumn("prev", F.lag("ord").over(w)).filter("prev is not null").select("ref_id", F.col("prev").alias("left_ord"), F.col("ord").alias("right_ord"), (F.col("ord") - F.col("prev") == 1).alias("adjacent"))


def subgenome_support(evidence: DataFrame, chrom: str, sub: str) -> DataFrame:
    """Shares of support by subgenome for each contig, with missing combinations as 0."""
    got = evidence.groupBy("assembly", "contig", sub).agg(F.sum("union_bp").alias("bp"))
    grid = got.select("assembly", "contig").distinct().crossJoin(F.broadcast(got.select(sub).distinct()))
    df = grid.join(got, ["assembly", "contig", sub], "left").withColumn("bp", F.coalesce("bp", F.lit(0)))
    return df.withColumn("share", F.round(F.col("bp") / F.sum("bp").over(W.partitionBy("assembly", "contig")), 6))


def origin_split(blocks: DataFrame, segments: DataFrame, n: int = 1) -> DataFrame:
    """For each block the reference of the segments that overlaps it most. Blocks are dealt to n tasks."""
    o = overlap_join(blocks, segments, ["assembly", "contig"], ("qs", "qe"), ("s", "e"), n=n)
    per = dealt(o, ["block_id"], n).groupBy("block_id", "origin").agg(F.sum("overlap").alias("bp"))
    return per.groupBy("block_id").agg(F.max_by("origin", F.struct("bp", "origin")).alias("origin"), F.max("bp").alias("bp"))


def oriented_origins(chains: DataFrame, contigs: DataFrame, origin: Column, least: int = 50_000) -> DataFrame:
    """assembly, contig, origin, s, e: stretches of contigs by reference, in coordinates of the oriented contig.

    chains: rows of ``macro_blocks``, of which those of small span are left out; contigs: assembly, contig, contig_len, reversed.
    """
    df = chains.filter(F.col("qspan_bp") >= least).select("assembly", "contig", origin.alias("origin"), "qstart", "qend").filter("origin <> ''").join(contigs.select("assembly", "contig", "contig_len", "reversed"), ["assembly", "contig"])
    at = lambda one, other: F.when(F.col("reversed"), F.col("contig_len") - F.col(other)).otherwise(F.col(one))
    return df.select("assembly", "contig", "origin", at("qstart", "qend").alias("s"), at("qend", "qstart").alias("e"))


def origin_segments(blocks: DataFrame, origins: DataFrame) -> DataFrame:
    """Each block split where its reference changes: origin, its part of the block, bp, and that part as shares of the block.

    blocks: assembly, contig, qs, qe, told apart by these. A block without origin is one part without a name.
    """
    keys = ["assembly", "contig", "qs", "qe"]
    n = tasks(blocks)
    own = dealt(blocks.select(*keys), keys, n).distinct()
    o = overlap_join(own, origins, keys[:2], ("qs", "qe"), ("s", "e"), n=n)
    parts = dealt(o, keys, n).groupBy(*keys, "origin").agg(F.min(F.greatest("qs", "s")).alias("start"), F.max(F.least("qe", "e")).alias("end"), F.sum("overlap").alias("bp"))
    df = own.join(parts, keys, "left")
    size = F.col("qe") - F.col("qs")
    share = lambda c, none: F.coalesce((F.col(c) - F.col("qs")) / size, F.lit(none))
    number = F.row_number().over(W.partitionBy(*keys).orderBy("start", "origin"))
    return df.select(*keys, "origin", F.coalesce("start", "qs").alias("start"), F.coalesce("end", "qe").alias("end"), F.coalesce("bp", F.lit(0)).alias("bp"), share("start", 0.0).alias("from_share"), share("end", 1.0).alias("to_share"), number.cast("long").alias("part"))


def order_by_identity(classified: DataFrame) -> DataFrame:
    m = classified.groupBy("assembly").agg(F.median("identity").alias("m"))
    return m.withColumn("ord", F.row_number().over(W.orderBy(F.desc_nulls_last("m"), "assembly")))


def suppress_ribbons(blocks: DataFrame, present: DataFrame) -> DataFrame:
    """Drops blocks between two assemblies if all those between them have the chromosome. blocks: ref_id, left_ord, right_ord."""
    between = blocks.join(present.withColumnRenamed("ord", "mid"), "ref_id").filter("mid > left_ord and mid < right_ord").groupBy("ref_id", "left_ord", "right_ord").agg(F.countDistinct("mid").alias("n"))
    full = between.filter("n = right_ord - left_ord - 1")
    return blocks.join(full, ["ref_id", "left_ord", "right_ord"], "left_anti")


#: Gaps and the least size of chains between two assemblies.
PAIRWISE = Config(chain_q_gap=500_000, chain_r_gap=500_000, chain_diag_slop=200_000, chain_min_bp=50_000)


def pairwise_synteny(blocks: DataFrame, ties: list[str], cfg: Config = PAIRWISE) -> DataFrame:
    """Chains of alignments of pairs of assemblies, all pairs as one job.

    blocks: left and right (assemblies), contig (of the right one), target (contig of the left one), strand, qs, qe, rs, re,
    matches, aln_len, past the gates of alignments. The pair takes the place of the assembly in chaining.
    """
    pair = F.concat_ws("\x01", "left", "right")
    chained = chain_greedy(blocks.withColumns({"assembly": pair, "ref_id": F.col("target"), "gene_id": F.lit(None).cast("string")}).drop("left", "right", "target"), ties, cfg)
    out = macro_blocks(chained, cfg)
    side = lambda i: F.split("assembly", "\x01")[i]
    return out.select(side(0).alias("left"), side(1).alias("right"), F.col("ref_id").alias("target"), "contig", "strand", "chain_id", "qstart", "qend", "qspan_bp", "union_bp", "matches", "aln_len", "identity", "n_segments", "ref_start", "ref_end")
