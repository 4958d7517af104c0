"""Scaffolds by reference and haplotype, their AGP rows, and positions of contigs lifted to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from .intervals import overlap_join, shuffled


def layout(contigs: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """contigs: assembly, ref_id, contig, ref_mid, length. Order by reference midpoint with fixed gaps between components."""
    w = W.partitionBy("assembly", "ref_id").orderBy("ref_mid", "contig")
    before = F.sum(F.col("length") + cfg.scaffold_gap).over(w.rowsBetween(W.unboundedPreceding, -1))
    df = contigs.withColumn("part", F.row_number().over(w)).withColumn("start", F.coalesce(before, F.lit(0)))
    return df.withColumn("end", F.col("start") + F.col("length"))


def agp(placed: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Lines of components and of the gaps between them, 1-based and closed."""
    last = F.max("part").over(W.partitionBy("assembly", "ref_id"))
    df = placed.withColumn("_last", last)
    comp = df.select("assembly", F.col("ref_id").alias("object"), (F.col("start") + 1).alias("beg"), F.col("end"), (2 * F.col("part") - 1).alias("n"), F.lit("W").alias("type"), F.col("contig").alias("component"), F.col("length").alias("size"))
    gap = df.filter("part < _last").select("assembly", F.col("ref_id").alias("object"), (F.col("end") + 1).alias("beg"), (F.col("end") + cfg.scaffold_gap).alias("end"), (2 * F.col("part")).alias("n"), F.lit("N").alias("type"), F.lit("").alias("component"), F.lit(cfg.scaffold_gap).cast("long").alias("size"))
    return comp.unionByName(gap)


def nearest_group(contigs: DataFrame, groups: DataFrame) -> DataFrame:
    """The haplotype group of nearest mean identity; equal distances go to the lowest group."""
    return contigs.join(groups, ["assembly", "ref_id"]).groupBy("assembly", "ref_id", "contig").agg(F.min_by("group", F.struct(F.abs(F.col("identity") - F.col("mean_identity")), "group")).alias("group"))


def group_identity(contigs: DataFrame) -> DataFrame:
    return contigs.groupBy("assembly", "ref_id", "group").agg(F.avg("identity").alias("mean_identity"))


def haplotypes(contigs: DataFrame) -> DataFrame:
    """Contigs that are scaffolded, with their haplotype group; others are left out.

    contigs: assembly, contig, class, ref_id, grp (1 where null), identity, chain_identity. Assigned chromosomes have groups of
    their own; chromosome debris joins the group of its reference whose mean identity is nearest, and none where no
    chromosome is assigned to the reference.
    """
    on = contigs.filter(F.col("ref_id").isNotNull())
    chrom = on.filter(F.col("class") == "chrom_assigned").withColumn("group", F.coalesce("grp", F.lit(1)).cast("int"))
    means = group_identity(chrom).withColumn("mean_identity", F.coalesce("mean_identity", F.lit(0.0)))
    debris = on.filter(F.col("class") == "chrom_debris")
    near = nearest_group(debris.select("assembly", "ref_id", "contig", F.coalesce("chain_identity", F.lit(0.0)).alias("identity")), means)
    return chrom.unionByName(debris.join(shuffled(near), ["assembly", "ref_id", "contig"]))


def scaffolds(grouped: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Components of scaffolds with their places. grouped: rows of ``haplotypes`` with contig_len, name, ref_name, full_length,
    telo5, telo3, reversed and ref_mid (null without range on the reference, which comes last).

    Where a haplotype has a contig from telomere to telomere, each assigned contig is a scaffold of its own and debris is
    left out; a single contig is one too, under its own name. Others are joined in order of their middle on the reference.
    Gives assembly, scaffold, ref_id, group, part, contig, length, reversed, start and end (0-based, half open).
    """
    of = W.partitionBy("assembly", "ref_id", "group")
    chrom = F.col("class") == "chrom_assigned"
    whole = chrom & F.coalesce("full_length", F.lit(False)) & F.coalesce("telo5", F.lit(False)) & F.coalesce("telo3", F.lit(False))
    base = F.coalesce("ref_name", "ref_id")
    base = F.when(F.col("group") <= 1, base).otherwise(F.concat(base, F.lit("_"), F.char(F.col("group") + 64)))
    df = grouped.filter(F.col("contig_len") > 0).withColumns({"_whole": F.max(whole).over(of), "_n": F.count("*").over(of)}).filter(chrom | ~F.col("_whole"))
    alone = F.col("_whole") | (F.col("_n") == 1)
    df = df.withColumn("scaffold", F.when(alone, F.coalesce("name", base)).otherwise(base)).withColumn("_alone", F.when(alone, F.col("contig")))
    w = W.partitionBy("assembly", "ref_id", "group", "_alone").orderBy(F.asc_nulls_last("ref_mid"), "contig")
    before = F.sum(F.col("contig_len") + cfg.scaffold_gap).over(w.rowsBetween(W.unboundedPreceding, -1))
    df = df.withColumns({"part": F.row_number().over(w), "start": F.coalesce(before, F.lit(0)).cast("long")})
    return df.select("assembly", "scaffold", "ref_id", "group", "part", "contig", F.col("contig_len").alias("length"), F.coalesce("reversed", F.lit(False)).alias("reversed"), "start", (F.col("start") + F.col("contig_len")).alias("end"))


def agp_rows(placed: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """AGP 2.0 rows of ``scaffolds``: the nine columns of the format, with the assembly. Without gaps there are no gap rows."""
    step = 2 if cfg.scaffold_gap > 0 else 1
    line = lambda *c: [x.alias(n) for x, n in zip(c, ("object", "beg", "end", "part", "type", "component", "component_beg", "component_end", "orientation"))]
    part = F.col("part").cast("long")
    comp = placed.select("assembly", *line(F.col("scaffold"), F.col("start") + 1, F.col("end"), step * part - (step - 1), F.lit("W"), F.col("contig"), F.lit("1"), F.col("length").cast("string"), F.when(F.col("reversed"), "-").otherwise("+")))
    if step == 1:
        return comp
    gaps = placed.filter("part > 1").select("assembly", *line(F.col("scaffold"), F.col("start") + 1 - cfg.scaffold_gap, F.col("start"), 2 * part - 2, F.lit("N"), F.lit(str(cfg.scaffold_gap)), F.lit("scaffold"), F.lit("yes"), F.lit("align_genus")))
    return comp.unionByName(gaps)


def components(agp: DataFrame) -> DataFrame:
    """Component rows of AGP as a map of coordinates: assembly, contig, c_start, c_end, scaffold, s_start (0-based), reversed."""
    w = agp.filter("type = 'W'")
    return w.select("assembly", F.col("component").alias("contig"), (F.col("component_beg").try_cast("long") - 1).alias("c_start"), F.col("component_end").try_cast("long").alias("c_end"), F.col("object").alias("scaffold"), (F.col("beg") - 1).alias("s_start"), (F.col("orientation") == "-").alias("reversed"))


def lift(features: DataFrame, pieces: DataFrame, keep: bool = True) -> DataFrame:
    """Features of contigs in the coordinates of their scaffolds. features: assembly, contig, start, end (0-based), strand and
    others; pieces: rows of ``components``. Adds scaffold, s_start, s_end, s_strand.

    A feature is cut at the ends of components, so one that spans several has a row for each; on a reversed component
    it is mirrored and its strand turned. Features of contigs that are no component stay in place on their contig where
    keep asks for it, else they are left out. Features and components meet by bins of positions.
    """
    at = overlap_join(features, pieces, ["assembly", "contig"], ("start", "end"), ("c_start", "c_end"))
    low, high = F.greatest("start", "c_start"), F.least("end", "c_end")
    back = F.col("reversed")
    turned = F.when(back & (F.col("strand") == "+"), "-").when(back & (F.col("strand") == "-"), "+").otherwise(F.col("strand"))
    place = lambda x, y: F.col("s_start") + F.when(back, F.col("c_end") - y).otherwise(x - F.col("c_start"))
    own = [*features.columns, "scaffold"]
    out = at.select(*own, place(low, high).alias("s_from"), place(high, low).alias("s_to"), turned.alias("s_strand"))
    out = out.withColumnsRenamed({"s_from": "s_start", "s_to": "s_end"})
    if keep:
        rest = features.join(shuffled(pieces.select("assembly", "contig").distinct()), ["assembly", "contig"], "left_anti")
        out = out.unionByName(rest.select(*features.columns, F.col("contig").alias("scaffold"), F.col("start").alias("s_start"), F.col("end").alias("s_end"), F.col("strand").alias("s_strand")))
    return out
