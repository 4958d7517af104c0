"""Tables of reports: confidence by class, cell states, layouts, look-ups, and summaries of assemblies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.ids import is_nuclear
from .evidence import CONTIG, PAIR
from .intervals import islands, overlap_join, union_bp

#: Presets of the read aligner by type of reads.
PRESETS = {"lrhq": "lr:hqae", "r9": "map-ont", "sr": "sr"}


def preset(reads_type: str) -> str:
    if reads_type not in PRESETS:
        raise ValueError(f"reads_type {reads_type!r} is none of {', '.join(PRESETS)}")
    return PRESETS[reads_type]


def subsample_fraction(bases: Column, size: Column, target: float) -> Column:
    """Share of the reads that gives the target coverage; all of them where sizes are unknown."""
    return F.when((bases <= 0) | (size <= 0), 1.0).otherwise(F.least(F.lit(1.0), target * size / bases))


def default_min_length(refs: DataFrame) -> DataFrame:
    """One row: a quarter of the smallest nuclear chromosome, 100000 where there is none."""
    least = F.min(F.when(is_nuclear(F.col("ref_id")) & (F.col("ref_len") > 0), F.col("ref_len")))
    return refs.agg(F.coalesce(F.floor(least * 0.25), F.lit(100_000)).cast("long").alias("min_length"))


def low_coverage(totals: DataFrame, contigs: DataFrame, least: DataFrame) -> DataFrame:
    """Whether less than the least length of a contig is aligned at all. least: one row, min_length."""
    df = contigs.join(totals, CONTIG, "left").crossJoin(F.broadcast(least))
    return df.select(*CONTIG, (F.coalesce("total_bp", F.lit(0)) < F.col("min_length")).alias("low_coverage"))


def best_chain(chains: DataFrame) -> DataFrame:
    """Of each pair the chain of greatest weight, the first one on ties. chains: pair, chain_id, weight, qbp, identity."""
    top = F.min_by(F.struct("qbp", "identity", "weight"), F.struct(-F.col("weight"), "chain_id")).alias("x")
    return chains.groupBy(*PAIR).agg(top).select(*PAIR, "x.*")


def first_match(df: DataFrame, raw: str, known: DataFrame, key: str) -> DataFrame:
    """Rows with what is known of the name itself, else of its first word, else of its part before the first bar.

    One equi join per form, so that each can be broadcast or shuffled by the name; rows without a match go.
    """
    rest = [c for c in known.columns if c != key]
    forms = [F.col(raw), F.get(F.split(F.trim(raw), "\\s+"), 0), F.get(F.split(raw, "\\|"), 0)]
    for i, form in enumerate(forms):
        df = df.withColumn(f"_f{i}", form).join(known.select(F.col(key).alias(f"_f{i}"), F.struct(*rest).alias(f"_k{i}")), f"_f{i}", "left")
    got = F.coalesce(*(F.col(f"_k{i}") for i in range(len(forms))))
    return df.withColumn("_got", got).filter("_got is not null").select(*(c for c in df.columns if not c.startswith(("_f", "_k"))), *(F.col(f"_got.{c}").alias(c) for c in rest))


def looked_up(df: DataFrame, column: str, names: DataFrame, key: str, value: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """The column with names as another table has them; those it lacks stay as they are."""
    of = names.select(*keys, F.col(key).alias(column), F.col(value).alias("_value")).dropDuplicates([*keys, column])
    return df.join(of, [*keys, column], "left").withColumn(column, F.coalesce("_value", column)).drop("_value").select(*df.columns)


def off_diagonal(hits: DataFrame, least: int = 1000, low: int = 0, high: int | None = None) -> DataFrame:
    """Distances of hits of a sequence on itself, save those next to the diagonal. hits: q, t, qs, ts."""
    d = F.abs(F.col("ts") - F.col("qs"))
    keep = (F.col("q") == F.col("t")) & (d >= least) & (d >= low)
    return hits.filter(keep if high is None else keep & (d <= high)).select("q", d.alias("distance"))


def sub_features(hits: DataFrame, features: DataFrame, least: float = 0.5) -> DataFrame:
    """Features of a consensus on contigs. hits: assembly, contig, locus, qs, qe (consensus), ss, se (contig), strand; features: name,
    start, end. Each hit's part of a feature is mapped by strand; a locus has a feature if half of it is covered.
    """
    a = hits.join(F.broadcast(features), (F.col("qs") <= F.col("end")) & (F.col("qe") >= F.col("start")))
    low, high = F.greatest("start", "qs"), F.least("end", "qe")
    plus = F.col("strand") == "+"
    a = a.filter(high > low).withColumn("_s", F.when(plus, F.col("ss") + low - F.col("qs")).otherwise(F.col("se") - (high - F.col("qs"))))
    a = a.withColumn("_e", F.when(plus, F.col("ss") + high - F.col("qs")).otherwise(F.col("se") - (low - F.col("qs")))).filter("_e > _s")
    keys = [*CONTIG, "locus", "name"]
    span = a.groupBy(*keys).agg(F.min("_s").alias("f_start"), F.max("_e").alias("f_end"), F.first(F.col("end") - F.col("start")).alias("_len"))
    return union_bp(a, keys, "_s", "_e").join(span, keys).filter((F.col("_len") > 0) & (F.col("union_bp") >= least * F.col("_len"))).select(*keys, "f_start", "f_end", "union_bp")


def rdna_reclassified(loci: DataFrame, contigs: DataFrame, taken: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Share of each contig that loci cover, and whether it is enough for the class; contigs of taken are left out."""
    keys = CONTIG
    df = union_bp(loci, keys, "start", "end").join(contigs, keys).join(taken.select(*keys), keys, "left_anti").filter("contig_len > 0")
    cov = F.col("union_bp") / F.col("contig_len")
    return df.select(*keys, F.round(cov, 6).alias("coverage"), (cov >= cfg.rdna_min_cov).alias("rdna"))


def identity_bands(df: DataFrame, key: str, value: str) -> DataFrame:
    """Mean and one deviation around it, within 0 and 1."""
    g = df.filter(F.col(value).isNotNull()).groupBy(key).agg(F.avg(value).alias("m"), F.stddev_samp(value).alias("sd"))
    return g.select(key, F.round("m", 6).alias("mean"), F.round("sd", 6).alias("sd"), F.round(F.greatest(F.lit(0.0), F.col("m") - F.col("sd")), 6).alias("low"), F.round(F.least(F.lit(1.0), F.col("m") + F.col("sd")), 6).alias("high"))


def merged_ribbons(ribbons: DataFrame, keys: list[str], order: str, same: list[str]) -> DataFrame:
    """Consecutive ribbons of one connection as one. ribbons: l_start, l_end, r_start, r_end, bp, identity."""
    w = W.partitionBy(*keys).orderBy(order)
    changed = ~F.coalesce(F.expr(" and ".join(f"`{c}` <=> `_{c}`" for c in same)) & F.col("_seen"), F.lit(False))
    df = ribbons.withColumns({f"_{c}": F.lag(c).over(w) for c in same}).withColumn("_seen", F.lag(F.lit(True)).over(w))
    df = df.withColumn("_new", changed.cast("int")).withColumn("run", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return df.groupBy(*keys, "run", *same).agg(F.min("l_start").alias("l_start"), F.max("l_end").alias("l_end"), F.min("r_start").alias("r_start"), F.max("r_end").alias("r_end"), F.sum("bp").alias("bp"), F.round(F.median("identity"), 6).alias("identity"), F.count("*").alias("n_blocks"))


def slots(contigs: DataFrame, height: float = 1.0) -> DataFrame:
    """Places of contigs within their chromosome, centred. contigs: assembly, chrom_id, subgenome, contig, contig_len."""
    w = W.partitionBy("assembly", "chrom_id")
    df = contigs.withColumn("n_in_bin", F.count("*").over(w)).withColumn("slot", F.row_number().over(w.orderBy("subgenome", F.desc("contig_len"), "contig")))
    return df.withColumn("y_offset", (F.col("slot") - (F.col("n_in_bin") + 1) / 2) * height)


def reference_lines(placed: DataFrame, refs: DataFrame) -> DataFrame:
    """Subgenomes present on a chromosome that have a reference, numbered. refs: chrom_id, subgenome, ref_len."""
    df = placed.select("assembly", "chrom_id", "subgenome").distinct().join(refs, ["chrom_id", "subgenome"])
    w = W.partitionBy("assembly", "chrom_id")
    return df.withColumn("n_sg", F.count("*").over(w)).withColumn("sg_idx", F.row_number().over(w.orderBy("subgenome")))


def prepared_blocks(blocks: DataFrame, placed: DataFrame) -> DataFrame:
    """Blocks in drawing coordinates. placed: contig keys, chrom_id, contig_len, is_reversed; blocks: target_chrom, qs, qe."""
    df = blocks.join(placed, CONTIG)
    clip = lambda x: F.greatest(F.lit(0), F.least(x, F.col("contig_len")))
    start = F.when(F.col("is_reversed"), F.col("contig_len") - F.col("qe")).otherwise(F.col("qs"))
    end = F.when(F.col("is_reversed"), F.col("contig_len") - F.col("qs")).otherwise(F.col("qe"))
    df = df.withColumn("xmin", clip(start)).withColumn("xmax", clip(end)).withColumn("off_target", F.col("target_chrom") != F.col("chrom_id"))
    return df.filter("xmax > xmin")


def cell_status(n: Column, full: Column, five: Column, three: Column) -> Column:
    """State of an assembly's chromosome by contigs, full length and telomeres."""
    five, three = F.coalesce(five, F.lit(False)), F.coalesce(three, F.lit(False))
    return F.when(n == 0, "unassigned").when(~F.coalesce(full, F.lit(False)), "incomplete").when(five & three, "telo_both").when(five, "telo_5p").when(three, "telo_3p").otherwise("full_length")


def depth_display_class(contig: Column, cls: Column, ref: Column) -> Column:
    debris = cls == "organelle_debris"
    return F.when(contig.isin("chrC", "chrM"), contig).when(debris & ref.isin("chrC", "chrM"), F.concat(ref, F.lit("_debris"))).otherwise(cls)


def assemblies_per_subgenome(contigs: DataFrame, refs: DataFrame, order: DataFrame) -> DataFrame:
    """Assemblies with a contig on a reference of the subgenome, in their order. order: assembly, ord."""
    have = contigs.select("assembly", "ref_id").join(refs.select("ref_id", "subgenome"), "ref_id").select("subgenome", "assembly").distinct()
    w = W.partitionBy("subgenome").orderBy("ord")
    return have.join(order, "assembly").select("subgenome", "assembly", F.row_number().over(w).alias("place"))


def top_by_length(contigs: DataFrame, keys: list[str], most: int = 50) -> DataFrame:
    """The longest contigs of each key; a report's list, so the limit is the feature."""
    r = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("contig_len"), "contig"))
    return contigs.withColumn("rank", r).filter(F.col("rank") <= most)


def first_kept(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("_r = 1").drop("_r")


def confidence(cls: Column, mode: Column) -> Column:
    """Confidence by class, from columns ref_coverage, chain_identity, gene_proportion, gc_dev, collinearity, n_chains, coverage,
    identity, protein_hits and ref_id; what is missing is null. The order of the tests matters.
    """
    c = F.col
    gc = lambda x: F.coalesce(c("gc_dev") > x, F.lit(False))
    known = c("coverage").isNotNull()
    by_cov = F.when(c("ref_coverage").isNull() | (c("ref_coverage") < 0.1), "low").when(c("ref_coverage") < 0.3, "medium").otherwise("high")
    by_cov = F.when((c("chain_identity") > 0) & (c("chain_identity") < 0.5), "low").otherwise(by_cov)
    by_genes = F.when(c("gene_proportion").isNull() | (c("gene_proportion") < 0.1), "low").when(c("gene_proportion") < 0.2, "medium").otherwise("high")
    chrom = F.when(mode == "nucleotide", by_cov).otherwise(by_genes)
    chrom = F.when(gc(3.0), "low").when(gc(2.0) & (chrom == "high"), "medium").otherwise(chrom)
    n, line = F.coalesce(c("n_chains"), F.lit(0)), c("collinearity")
    lower = F.when(chrom == "high", "medium").otherwise("low")
    chrom = F.when(line.isNull() | (n < 3), chrom).when((line >= 0.9) & (n >= 5) & (chrom == "medium"), "high").when((line < 0.3) & (n >= 10), "low").when((line < 0.5) & (n >= 5), lower).otherwise(chrom)
    reference_debris = F.when(known & (mode == "nucleotide"), F.when(c("coverage") >= 0.8, "high").when(c("coverage") < 0.55, "low").otherwise("medium"))
    reference_debris = F.coalesce(reference_debris, F.when(known, F.when((c("coverage") >= 0.8) | (c("protein_hits") >= 5), "high").when((c("coverage") < 0.55) & (c("protein_hits") < 3), "low").otherwise("medium")), F.lit("medium"))
    debris = F.when(known & ~((c("coverage") >= 0.9) & (c("identity") >= 0.95)) & ((c("coverage") < 0.85) | (c("identity") < 0.92)), "medium").otherwise("high")
    return (
        F.when(cls == "chrom_assigned", chrom)
        .when(cls == "chrom_unassigned", F.when(gc(2.0), "low").otherwise("medium"))
        .when(cls == "organelle_complete", F.when(c("coverage") < 0.9, "medium").otherwise("high"))
        .when(cls == "organelle_debris", F.when(c("coverage") < 0.6, "low").otherwise("medium"))
        .when(cls == "rDNA", F.when((c("coverage") >= 0.8) & (c("identity") >= 0.95), "high").when(c("coverage") < 0.6, "low").otherwise("medium"))
        .when(cls == "contaminant", F.when(gc(2.0), "high").when(c("coverage") < 0.5, "low").when(c("coverage") < 0.8, "medium").otherwise("high"))
        .when(cls == "chrom_debris", F.when(gc(3.0), F.when(debris == "high", "medium").otherwise("low")).otherwise(debris))
        .when(cls == "debris", F.when(gc(3.0) & c("ref_id").isNull(), "low").otherwise(reference_debris))
        .otherwise("low")
    )


def completeness_cells(contigs: DataFrame, refs: DataFrame) -> DataFrame:
    """Per assembly and reference: contigs, bp, best coverage, full length, both telomeres on one contig, mean identity, state.

    contigs: assembly, ref_id, contig_len, coverage, full_length, telo5, telo3, identity. Both sides of the grid are names.
    """
    grid = contigs.select("assembly").distinct().crossJoin(F.broadcast(refs.select("ref_id", "ref_len")))
    g = contigs.groupBy("assembly", "ref_id").agg(F.count("*").alias("n"), F.sum("contig_len").alias("bp"), F.max("coverage").alias("best"), F.bool_or("full_length").alias("full"), F.bool_or(F.col("telo5") & F.col("telo3")).alias("both"), F.bool_or("telo5").alias("t5"), F.bool_or("telo3").alias("t3"), F.avg("identity").alias("mean"))
    no = lambda c: F.coalesce(F.col(c), F.lit(False))
    n = F.coalesce("n", F.lit(0))
    return grid.join(g, ["assembly", "ref_id"], "left").select("assembly", "ref_id", "ref_len", n.alias("n_contigs"), F.coalesce("bp", F.lit(0)).alias("assigned_bp"), F.round("best", 6).alias("best_coverage"), no("full").alias("is_full_length"), no("both").alias("has_both_telomeres"), F.round("mean", 6).alias("mean_identity"), cell_status(n, F.col("full"), F.col("t5"), F.col("t3")).alias("status"))


def comparison_summary(contigs: DataFrame, classes: tuple[str, ...]) -> DataFrame:
    """One row for each assembly: counts and bp of all classes, full-length and telomere counts, means, chimeras, species.

    contigs: assembly, contig_len, class, full_length, telo5, telo3, chimeric, identity, coverage, collinearity, gc_dev, species, depth.
    """
    of = lambda c: F.col("class") == c
    chrom = of("chrom_assigned")
    length, both, any_ = F.col("contig_len"), F.col("telo5") & F.col("telo3"), F.col("telo5") | F.col("telo3")
    mean = lambda c: F.round(F.avg(F.when(chrom, F.col(c))), 6)
    out = [F.count("*").alias("n_contigs"), F.sum("contig_len").alias("total_bp"), F.max("contig_len").alias("longest")]
    for c in classes:
        out += [F.count_if(of(c)).alias(f"n_{c}"), F.coalesce(F.sum(F.when(of(c), length)), F.lit(0)).alias(f"bp_{c}")]
    out += [F.count_if(chrom & F.col("full_length")).alias("n_full_length"), F.count_if(chrom & both).alias("n_both_telomeres"), F.count_if(chrom & any_ & ~both).alias("n_one_telomere"), F.count_if(chrom & ~any_).alias("n_no_telomere")]
    out += [mean("identity").alias("mean_identity"), mean("coverage").alias("mean_coverage"), mean("collinearity").alias("mean_collinearity"), mean("gc_dev").alias("mean_gc_dev"), F.count_if("chimeric").alias("n_chimeric")]
    out += [F.countDistinct(F.when(of("contaminant"), F.col("species"))).alias("n_species"), F.round(F.sum(F.col("depth") * length) / F.sum(F.when(F.col("depth").isNotNull(), length)), 4).alias("mean_depth")]
    return contigs.groupBy("assembly").agg(*out)


def shared_stretches(left: DataFrame, right: DataFrame) -> DataFrame:
    """Shared stretches of two assemblies through a common reference. Both: assembly, contig, ref_id, rs, re.

    Overlaps on the reference are dealt by bins; rows of one pair of contigs that touch become one.
    """
    a = left.select(F.col("assembly").alias("l_assembly"), F.col("contig").alias("l_contig"), "ref_id", F.col("rs").alias("l_rs"), F.col("re").alias("l_re"))
    b = right.select(F.col("assembly").alias("r_assembly"), F.col("contig").alias("r_contig"), "ref_id", F.col("rs").alias("r_rs"), F.col("re").alias("r_re"))
    o = overlap_join(a, b, ["ref_id"], ("l_rs", "l_re"), ("r_rs", "r_re")).withColumn("s", F.greatest("l_rs", "r_rs")).withColumn("e", F.least("l_re", "r_re"))
    keys = ["l_assembly", "r_assembly", "l_contig", "r_contig", "ref_id"]
    return islands(o, keys, "s", "e").groupBy(*keys, "island").agg(F.min("s").alias("start"), F.max("e").alias("end"), F.count("*").alias("n")).drop("island")
