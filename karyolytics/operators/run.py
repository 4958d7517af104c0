"""The run from alignments and hits to classes, for all assemblies at once.

Phases follow one another: chromosomes by synteny, organelles, rDNA, debris of the chromosomes, contaminants, debris by
reference. Each scans only hits of contigs that no earlier phase took, so its table of found contigs anti-joins what later
phases read; it is written, so a later phase does not plan all of the earlier ones again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.sequence import gc_deviation
from .assign import NO_SECOND, resolve_reciprocal, synteny_gate
from .chaining import chain_greedy, macro_blocks
from .classify import cascade, exclude, full_length, names
from .detect import contaminants, covered_contigs, debris, hit_coverage, organelle_select
from .evidence import CONTIG, PAIR, collinearity, orientation_votes, pair_evidence
from .intervals import dealt, shuffled, tasks, union_bp
from .report import best_chain, confidence, default_min_length


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the folder that the cluster shares; where none is named, its rows are kept on executors' disks."""
    root = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if not root:
        return df.persist(StorageLevel.DISK_ONLY)
    path = f"{root.rstrip('/')}/run-{uuid.uuid4().hex[:12]}-{name}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._path = path
    return out


def synteny_ranks(blocks: DataFrame, contigs: DataFrame, refs: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """References of each contig: share of the reference spanned, union and whether the pair passes the gate.

    Adds rank among those that pass (null for others), by share, then union, then name.
    """
    n = tasks(blocks)
    spans = pair_evidence(blocks, n).join(shuffled(union_bp(blocks, PAIR, "rs", "re", "ref_bp", n)), PAIR).join(shuffled(contigs.select(*CONTIG, "contig_len")), CONTIG)
    df = spans.join(refs.select("ref_id", "ref_len"), "ref_id").withColumn("frac", F.col("ref_bp") / F.col("ref_len")).withColumn("_ok", synteny_gate(cfg))
    w = W.partitionBy(*CONTIG).orderBy(F.desc("_ok"), F.desc("frac"), F.desc("union_bp"), "ref_id")
    return df.withColumn("rank", F.when(F.col("_ok"), F.row_number().over(w))).drop("_ok")


def assignments(ranks: DataFrame) -> DataFrame:
    """assembly, contig, ref_id, second_ref of contigs with a reference, reciprocal swaps resolved; with the union and score (the
    share spanned) of the best and the second one that pass the gate.
    """
    at = lambda k, c: F.max(F.when(F.col("rank") == k, F.col(c)))
    best = ranks.groupBy(*CONTIG).agg(at(1, "ref_id").alias("best_ref"), at(1, "frac").alias("best_frac"), at(2, "ref_id").alias("gated_second"), at(1, "union_bp").alias("best_bp"), at(2, "union_bp").alias("second_bp"), at(2, "frac").alias("gated_frac")).filter("best_ref is not null")
    other = ranks.join(shuffled(best.select(*CONTIG, "best_ref")), CONTIG).filter("ref_id <> best_ref").groupBy(*CONTIG).agg(F.max(F.struct("frac", "ref_id")).alias("o"))
    spans = best.join(shuffled(other), CONTIG, "left").select(*CONTIG, "best_ref", "best_frac", F.col("o.ref_id").alias("second_ref"), F.col("o.frac").alias("second_frac"), "gated_second", "best_bp", "second_bp", "gated_frac")
    moves = resolve_reciprocal(spans.drop("gated_second", "best_bp", "second_bp", "gated_frac")).select(*CONTIG, "new_ref")
    return spans.join(shuffled(moves), CONTIG, "left").select(*CONTIG, F.coalesce("new_ref", "best_ref").alias("ref_id"), F.col("gated_second").alias("second_ref"), "best_bp", F.coalesce("second_bp", F.lit(0)).alias("second_bp"), F.col("best_frac").alias("best_score"), F.coalesce("gated_frac", F.lit(0.0)).alias("second_score"))


def status(ref: Column, by_chain: Column, cfg: Config = DEFAULT) -> Column:
    """State of an assignment, from contig_len and what ``assignments`` gives. Classes that have their reference by another
    way than chains (not by_chain) need no score.
    """
    score, second = F.coalesce("best_score", F.lit(0.0)), F.coalesce("second_score", F.lit(0.0))
    frac = F.when(F.col("contig_len") > 0, F.coalesce("best_bp", F.lit(0)) / F.col("contig_len")).otherwise(0.0)
    ratio = F.when(second > 0, score / second).when(score > 0, NO_SECOND).otherwise(0.0)
    return F.when(ref.isNull() | (by_chain & (score <= 0)), "NO_HITS").when(frac < cfg.assign_min_frac, "AMBIG_LOW_FRAC").when(ratio < cfg.assign_min_ratio, "AMBIG_LOW_RATIO").otherwise("OK")


def classified(
    contigs: DataFrame, refs: DataFrame, blocks: DataFrame, ties: list[str], organelle_hits: DataFrame, rdna_hits: DataFrame, self_hits: DataFrame, ref_hits: DataFrame,
    taxon_hits: DataFrame, taxa: DataFrame, gc: DataFrame, telomeres: DataFrame, ref_gc: tuple[float, float], cfg: Config = DEFAULT,
    stage: Callable[[DataFrame, str], DataFrame] = written,
) -> DataFrame:
    """One row a contig with class, reference, confidence and name, in nucleotide mode.

    contigs: assembly, contig, contig_len. refs: ref_id, ref_len; organelles are chrC and chrM. blocks: alignments past their
    gates. Hits: assembly, qseqid, sseqid, qstart, qend, length, pident, evalue_rank, o_orderkey (their order); subjects of
    self_hits are contigs. taxon_hits and taxa: as for ``contaminants``. gc: assembly, contig, gc. telomeres: assembly, contig,
    telo5, telo3. ref_gc: mean and deviation of the reference's nuclear chromosomes. An assembly without hits of a kind has
    no contigs of its class.
    """
    least = default_min_length(refs).first()["min_length"]
    ranks = stage(synteny_ranks(blocks, contigs, refs, cfg), "ranks")
    to = stage(assignments(ranks), "assignments")
    chroms = stage(contigs.join(shuffled(to), CONTIG).filter(F.col("contig_len") >= least).select(*CONTIG, "ref_id"), "chromosomes")
    left = lambda hits, *taken: exclude(hits.withColumnRenamed("qseqid", "contig"), *taken).withColumnRenamed("contig", "qseqid")

    of_kind = union_bp(left(organelle_hits, chroms), ["assembly", "qseqid", "sseqid"], "qstart", "qend", n=tasks(organelle_hits))
    lengths = refs.filter("ref_id in ('chrC', 'chrM')").select(F.col("ref_id").alias("sseqid"), "ref_len")
    tolerance = F.when(F.col("sseqid") == "chrC", cfg.organelle_tol_c).otherwise(cfg.organelle_tol_m)
    organelle = organelle_select(of_kind.join(lengths, "sseqid"), contigs, F.col("ref_len"), tolerance, cfg)
    organelle = organelle.filter("chosen or kind = 'debris'").groupBy(*CONTIG).agg(F.max("chosen").alias("complete"), F.min_by(F.struct("sseqid", "coverage"), F.struct(~F.col("chosen"), "sseqid")).alias("o"))
    organelle = stage(organelle.select(*CONTIG, "complete", F.col("o.sseqid").alias("organelle_ref"), F.col("o.coverage").alias("coverage")), "organelles")

    rdna = hit_coverage(left(rdna_hits, chroms, organelle), ["assembly", "qseqid"], tasks(rdna_hits))
    rdna = covered_contigs(rdna, contigs, cfg.rdna_min_cov).join(shuffled(rdna.select("assembly", F.col("qseqid").alias("contig"), F.round(F.col("matches") / F.col("hit_bp"), 6).alias("identity"))), CONTIG)
    rdna = stage(rdna, "rdna")

    on_chroms = left(self_hits, chroms, organelle, rdna).join(shuffled(chroms.select("assembly", F.col("contig").alias("sseqid"))), ["assembly", "sseqid"], "left_semi")
    copies = stage(debris(hit_coverage(on_chroms, ["assembly", "qseqid"], tasks(self_hits)), contigs, cfg), "copies")

    foreign = stage(contaminants(exclude(taxon_hits, chroms, organelle, rdna, copies), taxa, contigs, cfg), "contaminants")
    alien = foreign.filter(F.col("coverage") >= cfg.contaminant_cov)

    rest = covered_contigs(union_bp(left(ref_hits, chroms, organelle, rdna, copies, foreign), ["assembly", "qseqid"], "qstart", "qend", n=tasks(ref_hits)), contigs, 0.5)

    joined = []
    for kind, table, more in (("assigned_to", to, ["ref_id", "second_ref"]), ("organelle_any", organelle, ["complete", "organelle_ref", "coverage"]), ("rdna", rdna, ["coverage", "identity"]), ("chrom_debris", copies, ["coverage", "identity"]), ("contaminant", alien, ["coverage", "taxid", "name", "score"]), ("debris", rest, ["coverage"])):
        joined.append((kind, table.select(*CONTIG, *(F.col(c).alias(f"{kind}_{c}") for c in more), F.lit(True).alias(kind))))
    n = tasks(contigs)
    out = dealt(contigs.select(*CONTIG, "contig_len"), CONTIG, n)
    for _, table in joined:
        out = out.join(shuffled(table), CONTIG, "left")
    out = dealt(stage(out.fillna(False, [kind for kind, _ in joined]), "evidence"), CONTIG, n)
    out = out.withColumns({"ref_id": F.col("assigned_to_ref_id"), "assigned": F.col("assigned_to"), "chromosome_like": F.col("contig_len") >= least, "organelle": F.coalesce("organelle_any_complete", F.lit(False))})
    out = cascade(out.withColumn("organelle_debris", F.col("organelle_any") & ~F.col("organelle")))
    out = out.join(shuffled(to.drop("ref_id", "second_ref")), CONTIG, "left").join(shuffled(ranks.groupBy(*CONTIG).agg(F.sum("union_bp").alias("total_bp"), F.count("*").alias("n_refs"))), CONTIG, "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    mixed = (zero("n_refs") > 1) & (zero("best_bp") < cfg.chimera_primary * F.col("total_bp")) & (zero("second_bp") >= cfg.chimera_secondary * F.col("total_bp"))
    out = out.withColumns({"low_coverage": zero("total_bp") < least, "chimeric": F.coalesce(mixed & (F.col("total_bp") > 0), F.lit(False))})
    return finished(out, blocks, ties, ranks, gc, telomeres, ref_gc, refs, cfg, stage)


def finished(out: DataFrame, blocks: DataFrame, ties: list[str], ranks: DataFrame, gc: DataFrame, telomeres: DataFrame, ref_gc: tuple[float, float], refs: DataFrame, cfg: Config, stage: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Evidence of the class, confidence, orientation and names."""
    cls, chrom = F.col("class"), F.col("class") == "chrom_assigned"
    by_class = lambda c: F.when(cls.startswith("organelle"), F.col("organelle_any_coverage") if c == "coverage" else None).when(cls == "rDNA", F.col(f"rdna_{c}")).when(F.col("chrom_debris"), F.col(f"chrom_debris_{c}")).when(cls == "contaminant", F.col("contaminant_coverage") if c == "coverage" else None).when(F.col("debris"), F.col("debris_coverage") if c == "coverage" else None)
    # a contig that only the reference's debris scan found has its class by that scan's coverage
    out = out.withColumns({"coverage": by_class("coverage"), "identity": by_class("identity"), "by_reference": F.col("debris") & ~F.col("chrom_debris")})
    chains = dealt(stage(macro_blocks(chain_greedy(blocks, ties, cfg), cfg), "chains"), PAIR)
    mid = chains.select(*PAIR, "strand", F.col("qstart").alias("qs"), F.col("qend").alias("qe"), F.col("ref_start").alias("rs"), F.col("ref_end").alias("re"), F.col("union_bp").alias("matches"))
    line = collinearity(mid, ["strand"]).select(*PAIR, "collinearity")
    top = best_chain(chains.select(*PAIR, F.struct("chain_id", "strand").alias("chain_id"), F.col("matches").alias("weight"), F.col("union_bp").alias("qbp"), "identity")).select(*PAIR, F.col("identity").alias("chain_identity"))
    pair = ranks.select(*PAIR, F.col("frac").alias("ref_coverage")).join(shuffled(line), PAIR, "left").join(shuffled(top), PAIR, "left").join(shuffled(chains.groupBy(*PAIR).agg(F.count("*").alias("n_chains"))), PAIR, "left")
    out = out.join(shuffled(pair), PAIR, "left").join(shuffled(telomeres), CONTIG, "left").join(shuffled(gc), CONTIG, "left").join(refs.select("ref_id", "ref_len"), "ref_id", "left")
    own = out.filter(chrom).groupBy("assembly").agg(F.avg("gc").alias("_mean"), F.coalesce(F.stddev_samp("gc"), F.lit(0.0)).alias("_sd"))
    out = out.join(own, "assembly", "left")
    mean, sd = F.lit(ref_gc[0]), F.lit(ref_gc[1])
    dev = F.when(chrom, gc_deviation(F.col("gc"), mean, sd)).when(~cls.startswith("organelle"), gc_deviation(F.col("gc"), F.coalesce("_mean", mean), F.coalesce("_sd", sd)))
    n_telo = F.coalesce("telo5", F.lit(False)).cast("int") + F.coalesce("telo3", F.lit(False)).cast("int")
    yes, sure = full_length(n_telo, F.col("contig_len") / F.col("ref_len"), F.col("ref_coverage"), cfg)
    out = out.withColumns({"gc_dev": dev, "full_length": chrom & F.coalesce(yes, F.lit(False)), "full_length_confidence": F.when(chrom, sure), "gene_proportion": F.lit(None).cast("double"), "protein_hits": F.lit(None).cast("int")})
    judged = F.when((cls == "chrom_debris") & F.col("by_reference"), F.lit("debris")).otherwise(cls)
    out = out.withColumn("confidence", confidence(judged, F.lit("nucleotide")))
    turn = orientation_votes(chains.withColumn("matches", F.col("union_bp")), out.filter(chrom).select(*CONTIG, F.col("ref_id").alias("best_ref"))).select(*CONTIG, "reverse")
    named_ref = F.when(chrom, F.col("ref_id"))
    label = names(out.select(*CONTIG, named_ref.alias("ref_id"), F.lit(None).cast("string").alias("subgenome"), "full_length", F.col("chain_identity").alias("identity"), F.col("contig_len").alias("length"))).select(*CONTIG, "name")
    shown = F.when(cls.isin("chrom_assigned", "chrom_debris"), F.col("ref_id")).when(cls.startswith("organelle"), F.col("organelle_any_organelle_ref"))
    name = F.when(cls == "organelle_complete", F.col("organelle_any_organelle_ref")).otherwise(F.col("name"))
    out = out.join(shuffled(label), CONTIG).join(shuffled(turn), CONTIG, "left")
    state = status(shown, cls.isin("chrom_assigned", "chrom_unassigned"), cfg)
    six = lambda c: F.round(c, 6).alias(c)
    return out.select(
        *CONTIG, "contig_len", "class", shown.alias("ref_id"), F.when(chrom, F.col("assigned_to_second_ref")).alias("second_ref"), state.alias("status"), "low_coverage", "chimeric", "confidence", name.alias("name"), "full_length", "full_length_confidence",
        F.coalesce("reverse", F.lit(False)).alias("reversed"), F.coalesce("telo5", F.lit(False)).alias("telo5"), F.coalesce("telo3", F.lit(False)).alias("telo3"), *(six(c) for c in ("gc_dev", "coverage", "identity")), *(F.when(chrom, F.round(c, 6)).alias(c) for c in ("ref_coverage", "chain_identity", "collinearity")),
        F.when(chrom, F.col("n_chains")).alias("n_chains"), F.when(cls == "contaminant", F.col("contaminant_name")).alias("species"), F.when(cls == "contaminant", contaminant_score(F.col("contaminant_score"))).alias("contaminant_score"),
    )


def contaminant_score(score: Column) -> Column:
    """Scores of the classifier within 0 and 1; none where there is none."""
    return F.when(score > 0, F.least(F.lit(1.0), score / 1e9))
