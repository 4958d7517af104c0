"""Queries over the wired run: classes from alignments and hits, and scaffolds with positions lifted to them, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT as C
from ..functions import ids, sequence
from ..operators import compare, evidence, layout, run, scaffold
from ..operators.intervals import shuffled
from .adapters import ctes, view
from .catalog import TIES, chains_sql, query

_K = "assembly, contig"
_P = "assembly, contig, ref_id"


def _anti(hit: str, *taken: str) -> str:
    """Conditions that hits (as h, with their contig in a column) are of no contig of the tables."""
    return " AND ".join(f"NOT EXISTS (SELECT 1 FROM {t} x WHERE x.assembly = h.assembly AND x.contig = h.{hit})" for t in taken)


def _union(name: str, source: str, keys: str, start: str, end: str, more: str = "") -> str:
    """Covered length of each key of the source."""
    return f"""{name}_w AS (SELECT *, max({end}) OVER (PARTITION BY {keys} ORDER BY {start}, {end} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM {source}),
 {name} AS (SELECT {keys}, CAST(sum(greatest(0, {end} - greatest({start}, coalesce(pe, {start})))) AS BIGINT) AS bp{more} FROM {name}_w GROUP BY {keys})"""


_IDENT = ", round(sum(CAST(trunc(pident * length / 100) AS BIGINT)) / sum(length), 6) AS identity"
_DEV = "CASE WHEN {sd} >= 0.001 THEN abs(gc - {mean}) / {sd} END"
_RUN = ctes("run_contigs", "refs", "scan", "run_blocks", "run_taxhits", "seqs") + f""",
 lm AS (SELECT CAST(floor(min(ref_len) * 0.25) AS BIGINT) AS least FROM refs WHERE ref_id NOT IN ('chrC', 'chrM')),
 {_union("uq", "run_blocks", _P, "qs", "qe", ", count(*) AS n_blocks, min(qs) AS q_min, max(qe) AS q_max")},
 {_union("ur", "run_blocks", _P, "rs", "re")},
 rk AS (SELECT *, row_number() OVER (PARTITION BY {_K} ORDER BY ok DESC, frac DESC, bp DESC, ref_id) AS r FROM (SELECT uq.*, ur.bp / ref_len AS frac, q_max - q_min >= {C.synteny_min_span} AND (q_max - q_min) / contig_len >= {C.synteny_min_frac} AS ok FROM uq JOIN ur USING ({_P}) JOIN run_contigs USING ({_K}) JOIN refs USING (ref_id))),
 b0 AS (SELECT {_K}, max(CASE WHEN ok AND r = 1 THEN ref_id END) AS best_ref, max(CASE WHEN ok AND r = 1 THEN frac END) AS best_frac, max(CASE WHEN ok AND r = 2 THEN ref_id END) AS gated, max(CASE WHEN ok AND r = 1 THEN bp END) AS best_bp, coalesce(max(CASE WHEN ok AND r = 2 THEN bp END), 0) AS second_bp, coalesce(max(CASE WHEN ok AND r = 2 THEN frac END), 0) AS second_score FROM rk GROUP BY {_K} HAVING best_ref IS NOT NULL),
 ot AS (SELECT {_K}, ref_id AS second_ref, frac AS second_frac FROM (SELECT rk.assembly, rk.contig, ref_id, frac, row_number() OVER (PARTITION BY rk.assembly, rk.contig ORDER BY frac DESC, ref_id DESC) AS o FROM rk JOIN b0 ON b0.assembly = rk.assembly AND b0.contig = rk.contig AND ref_id <> best_ref) WHERE o = 1),
 sp AS (SELECT b0.*, second_ref, second_frac, row_number() OVER (PARTITION BY assembly, best_ref ORDER BY best_frac DESC, contig) AS m FROM b0 LEFT JOIN ot USING ({_K})),
 pr AS (SELECT a.assembly, a.best_ref, a.second_ref AS new_ref, row_number() OVER (PARTITION BY a.assembly, a.second_ref ORDER BY a.best_ref) AS n FROM sp a JOIN sp b ON a.assembly = b.assembly AND a.best_ref = b.best_ref AND a.m = 1 AND b.m = 2 AND a.second_ref = b.second_ref AND a.second_frac >= 0.05 AND b.second_frac >= 0.05 WHERE NOT EXISTS (SELECT 1 FROM sp t WHERE t.assembly = a.assembly AND t.best_ref = a.second_ref)),
 asg AS (SELECT sp.assembly, contig, CASE WHEN new_ref IS NOT NULL AND m >= 2 AND second_ref = new_ref THEN new_ref ELSE sp.best_ref END AS ref_id, gated AS second_ref, best_bp, second_bp, best_frac AS best_score, second_score FROM sp LEFT JOIN pr ON pr.assembly = sp.assembly AND pr.best_ref = sp.best_ref AND n = 1),
 tt AS (SELECT {_K}, sum(bp) AS total, count(*) AS n_refs FROM uq GROUP BY {_K}),
 chm AS (SELECT {_K}, ref_id FROM asg JOIN run_contigs USING ({_K}), lm WHERE contig_len >= least),
 ohits AS (SELECT * FROM scan h WHERE kind IN ('1-URGENT', '2-HIGH') AND {_anti("qseqid", "chm")}),
 {_union("oc", "ohits", "assembly, qseqid, sseqid", "qstart", "qend")},
 os AS (SELECT *, CASE WHEN coverage >= {C.organelle_cov} AND off <= tol * ref_len THEN 'candidate' WHEN coverage >= 0.5 THEN 'debris' ELSE 'none' END AS st FROM (SELECT oc.assembly, contig, sseqid, round(least(1.0, bp / contig_len), 6) AS coverage, abs(contig_len - ref_len) AS off, ref_len, CASE sseqid WHEN 'chrC' THEN {C.organelle_tol_c} ELSE {C.organelle_tol_m} END AS tol FROM oc JOIN run_contigs c ON c.assembly = oc.assembly AND c.contig = qseqid JOIN refs ON ref_id = sseqid)),
 ok AS (SELECT *, st = 'candidate' AND row_number() OVER (PARTITION BY assembly, sseqid, st ORDER BY off, contig) = 1 AS chosen FROM os),
 org AS (SELECT {_K}, bool_or(chosen) AS complete, first(sseqid ORDER BY chosen DESC, sseqid) AS organelle_ref, first(coverage ORDER BY chosen DESC, sseqid) AS coverage FROM ok WHERE chosen OR st = 'debris' GROUP BY {_K}),
 rhits AS (SELECT * FROM scan h WHERE kind = '3-MEDIUM' AND {_anti("qseqid", "chm", "org")}),
 {_union("rc", "rhits", "assembly, qseqid", "qstart", "qend", _IDENT)},
 rd AS (SELECT rc.assembly, contig, round(least(1.0, bp / contig_len), 6) AS coverage, identity FROM rc JOIN run_contigs c ON c.assembly = rc.assembly AND c.contig = qseqid WHERE round(least(1.0, bp / contig_len), 6) >= {C.rdna_min_cov}),
 shits AS (SELECT * FROM scan h WHERE kind = '4-NOT SPECIFIED' AND {_anti("qseqid", "chm", "org", "rd")} AND EXISTS (SELECT 1 FROM chm x WHERE x.assembly = h.assembly AND x.contig = h.sseqid)),
 {_union("sc", "shits", "assembly, qseqid", "qstart", "qend", _IDENT)},
 cp AS (SELECT sc.assembly, contig, round(least(1.0, bp / contig_len), 6) AS coverage, identity FROM sc JOIN run_contigs c ON c.assembly = sc.assembly AND c.contig = qseqid WHERE round(least(1.0, bp / contig_len), 6) >= {C.debris_cov} AND identity >= {C.debris_ident}),
 tx AS (SELECT {_K}, taxid, sum(score) AS score, sum(matching_bp) AS bp FROM run_taxhits h WHERE score >= {C.contaminant_score} AND {_anti("contig", "chm", "org", "rd", "cp")} GROUP BY {_K}, taxid),
 fo AS (SELECT {_K}, n_name AS species, score, round(bp / contig_len, 6) AS coverage FROM (SELECT *, row_number() OVER (PARTITION BY {_K} ORDER BY score DESC, taxid) AS r FROM tx) JOIN run_contigs USING ({_K}) JOIN nation ON n_nationkey = taxid WHERE r = 1),
 al AS (SELECT * FROM fo WHERE coverage >= {C.contaminant_cov}),
 fhits AS (SELECT * FROM scan h WHERE kind = '5-LOW' AND {_anti("qseqid", "chm", "org", "rd", "cp", "fo")}),
 {_union("fc", "fhits", "assembly, qseqid", "qstart", "qend")},
 de AS (SELECT fc.assembly, contig, round(least(1.0, bp / contig_len), 6) AS coverage FROM fc JOIN run_contigs c ON c.assembly = fc.assembly AND c.contig = qseqid WHERE round(least(1.0, bp / contig_len), 6) >= 0.5),
 cl AS (SELECT c.assembly, c.contig, contig_len, a.ref_id, a.second_ref, organelle_ref, species, al.score, coalesce(total, 0) < least AS low_coverage, coalesce(n_refs, 0) > 1 AND total > 0 AND coalesce(best_bp, 0) < {C.chimera_primary} * total AND coalesce(second_bp, 0) >= {C.chimera_secondary} * total AS chimeric, coalesce(best_bp, 0) AS best_bp, coalesce(best_score, 0) AS best_score, coalesce(second_score, 0) AS second_score, cp.contig IS NULL AND de.contig IS NOT NULL AS by_ref,
  CASE WHEN a.ref_id IS NOT NULL AND contig_len >= least THEN 'chrom_assigned' WHEN contig_len >= least AND al.contig IS NULL THEN 'chrom_unassigned' WHEN org.complete THEN 'organelle_complete' WHEN org.contig IS NOT NULL THEN 'organelle_debris' WHEN rd.contig IS NOT NULL THEN 'rDNA' WHEN al.contig IS NOT NULL THEN 'contaminant' WHEN cp.contig IS NOT NULL THEN 'chrom_debris' WHEN de.contig IS NOT NULL THEN CASE WHEN a.ref_id IS NOT NULL THEN 'chrom_debris' ELSE 'debris' END ELSE 'unclassified' END AS class,
  org.coverage AS c1, rd.coverage AS c2, cp.coverage AS c3, al.coverage AS c4, de.coverage AS c5, rd.identity AS i2, cp.identity AS i3
  FROM run_contigs c LEFT JOIN asg a USING ({_K}) LEFT JOIN tt USING ({_K}) LEFT JOIN org USING ({_K}) LEFT JOIN rd USING ({_K}) LEFT JOIN cp USING ({_K}) LEFT JOIN al USING ({_K}) LEFT JOIN de USING ({_K}), lm),
 {chains_sql("run_blocks")},
 li AS (SELECT *, least(union_bp, lead(union_bp) OVER w) AS wt, lead(strand) OVER w = strand AND CASE strand WHEN '+' THEN lead(ref_start + ref_end) OVER w > ref_start + ref_end ELSE lead(ref_start + ref_end) OVER w < ref_start + ref_end END AS same, lead(strand) OVER w IS NOT NULL AS nx FROM mb WINDOW w AS (PARTITION BY {_P} ORDER BY qstart + qend, qstart, qend, ref_start, ref_end, strand)),
 pe AS (SELECT {_P}, count(*) AS n_chains, first(identity ORDER BY matches DESC, chain_id, strand) AS chain_identity, CASE WHEN coalesce(sum(wt) FILTER (WHERE nx), 0) = 0 THEN 1.0 ELSE round(coalesce(sum(wt) FILTER (WHERE same), 0) / sum(wt) FILTER (WHERE nx), 6) END AS collinearity, sum(CASE WHEN strand = '-' THEN union_bp ELSE 0 END) > sum(CASE WHEN strand = '+' THEN union_bp ELSE 0 END) AS reverse FROM li GROUP BY {_P}),
 gs AS (SELECT {_K}, avg(coalesce((length(seq) - length(translate(seq, 'GCgc', ''))) / nullif(length(seq) - length(translate(seq, 'ACGTacgt', '')), 0), 0)) AS gc, arg_min(regexp_matches(substring(seq, 1, CAST(least(10000, length(seq) // 2) AS INT)), '(TTTAGGG){{3,}}|(CCCTAAA){{3,}}'), doc_id) AS telo5, arg_max(regexp_matches(substring(seq, 1, CAST(least(10000, length(seq) // 2) AS INT)), '(TTTAGGG){{3,}}|(CCCTAAA){{3,}}'), doc_id) AS telo3 FROM seqs GROUP BY {_K}),
 rg AS (SELECT avg(gc) AS rm, stddev_samp(gc) AS rsd FROM gs),
 ag AS (SELECT assembly, avg(gc) AS am, coalesce(stddev_samp(gc), 0) AS asd FROM cl JOIN gs USING ({_K}) WHERE class = 'chrom_assigned' GROUP BY assembly),
 f0 AS (SELECT cl.*, gc, coalesce(telo5, FALSE) AS telo5, coalesce(telo3, FALSE) AS telo3, coalesce(am, rm) AS m, coalesce(asd, rsd) AS sd, rm, rsd, rk.frac AS ref_coverage, n_chains, chain_identity, collinearity, pe.reverse, ref_len,
  CASE WHEN starts_with(class, 'organelle') THEN c1 WHEN class = 'rDNA' THEN c2 WHEN c3 IS NOT NULL THEN c3 WHEN class = 'contaminant' THEN c4 ELSE c5 END AS coverage,
  CASE WHEN starts_with(class, 'organelle') THEN NULL WHEN class = 'rDNA' THEN i2 ELSE i3 END AS identity
  FROM cl LEFT JOIN gs USING ({_K}) LEFT JOIN ag ON ag.assembly = cl.assembly LEFT JOIN rk ON rk.assembly = cl.assembly AND rk.contig = cl.contig AND rk.ref_id = cl.ref_id LEFT JOIN pe ON pe.assembly = cl.assembly AND pe.contig = cl.contig AND pe.ref_id = cl.ref_id LEFT JOIN refs ON refs.ref_id = cl.ref_id, rg),
 f1 AS (SELECT *, CASE WHEN class = 'chrom_assigned' THEN {_DEV.format(mean="rm", sd="rsd")} WHEN NOT starts_with(class, 'organelle') THEN {_DEV.format(mean="m", sd="sd")} END AS dev, CAST(telo5 AS INT) + CAST(telo3 AS INT) AS nt FROM f0),
 f2 AS (SELECT *, class = 'chrom_assigned' AND coalesce(nt >= 2 OR contig_len / ref_len >= {C.full_length_ratio} OR ref_coverage >= {C.full_length_cov}, FALSE) AS full_length, CASE WHEN class = 'chrom_assigned' THEN CASE WHEN nt >= 2 THEN 'high' WHEN nt = 1 THEN 'medium' ELSE 'low' END END AS full_length_confidence,
  CASE WHEN chain_identity > 0 AND chain_identity < 0.5 THEN 'low' WHEN ref_coverage IS NULL OR ref_coverage < 0.1 THEN 'low' WHEN ref_coverage < 0.3 THEN 'medium' ELSE 'high' END AS k0 FROM f1),
 f3 AS (SELECT *, CASE WHEN dev > 3 THEN 'low' WHEN dev > 2 AND k0 = 'high' THEN 'medium' ELSE k0 END AS k1, CASE WHEN coverage >= 0.9 AND identity >= 0.95 THEN 'high' WHEN coverage < 0.85 OR identity < 0.92 THEN 'medium' ELSE 'high' END AS d1 FROM f2),
 f4 AS (SELECT *, CASE WHEN class = 'chrom_assigned' THEN CASE WHEN collinearity IS NULL OR n_chains < 3 THEN k1 WHEN collinearity >= 0.9 AND n_chains >= 5 AND k1 = 'medium' THEN 'high' WHEN collinearity < 0.3 AND n_chains >= 10 THEN 'low' WHEN collinearity < 0.5 AND n_chains >= 5 THEN CASE k1 WHEN 'high' THEN 'medium' ELSE 'low' END ELSE k1 END
  WHEN class = 'chrom_unassigned' THEN CASE WHEN dev > 2 THEN 'low' ELSE 'medium' END WHEN class = 'organelle_complete' THEN CASE WHEN coverage < 0.9 THEN 'medium' ELSE 'high' END WHEN class = 'organelle_debris' THEN CASE WHEN coverage < 0.6 THEN 'low' ELSE 'medium' END
  WHEN class = 'rDNA' THEN CASE WHEN coverage >= 0.8 AND identity >= 0.95 THEN 'high' WHEN coverage < 0.6 THEN 'low' ELSE 'medium' END WHEN class = 'contaminant' THEN CASE WHEN dev > 2 THEN 'high' WHEN coverage < 0.5 THEN 'low' WHEN coverage < 0.8 THEN 'medium' ELSE 'high' END
  WHEN class = 'debris' OR (class = 'chrom_debris' AND by_ref) THEN CASE WHEN dev > 3 AND ref_id IS NULL THEN 'low' WHEN coverage >= 0.8 THEN 'high' WHEN coverage < 0.55 THEN 'low' ELSE 'medium' END WHEN class = 'chrom_debris' THEN CASE WHEN dev > 3 THEN CASE d1 WHEN 'high' THEN 'medium' ELSE 'low' END ELSE d1 END ELSE 'low' END AS confidence,
  class = 'chrom_assigned' AS chrom, CASE WHEN class = 'chrom_assigned' THEN CASE WHEN full_length THEN 'c' ELSE 'f' END ELSE 'o' END AS nk FROM f3),
 f5 AS (SELECT *, row_number() OVER (PARTITION BY assembly, CASE WHEN chrom THEN ref_id END, nk ORDER BY coalesce(chain_identity, 0) DESC, contig_len DESC, contig) AS ni, count(*) OVER (PARTITION BY assembly, CASE WHEN chrom THEN ref_id END, nk) AS nc, row_number() OVER (PARTITION BY assembly, nk ORDER BY contig_len DESC, contig) AS nj FROM f4),
 report AS (SELECT {_K}, contig_len, class, CASE WHEN class IN ('chrom_assigned', 'chrom_debris') THEN ref_id WHEN starts_with(class, 'organelle') THEN organelle_ref END AS ref_id, CASE WHEN chrom THEN second_ref END AS second_ref, CASE WHEN NOT (class IN ('chrom_assigned', 'chrom_debris') AND ref_id IS NOT NULL OR starts_with(class, 'organelle')) OR (class IN ('chrom_assigned', 'chrom_unassigned') AND best_score <= 0) THEN 'NO_HITS' WHEN best_bp / contig_len < {C.assign_min_frac} THEN 'AMBIG_LOW_FRAC' WHEN (CASE WHEN second_score > 0 THEN best_score / second_score WHEN best_score > 0 THEN 1e9 ELSE 0 END) < {C.assign_min_ratio} THEN 'AMBIG_LOW_RATIO' ELSE 'OK' END AS status, low_coverage, coalesce(chimeric, FALSE) AS chimeric, confidence,
  CASE WHEN class = 'organelle_complete' THEN organelle_ref WHEN nk = 'o' THEN concat('contig_', nj) WHEN nk = 'c' AND nc = 1 THEN ref_id ELSE concat(ref_id, '_', nk, ni) END AS name, full_length, full_length_confidence, chrom AND coalesce(reverse, FALSE) AS reversed, telo5, telo3, round(dev, 6) AS gc_dev, coverage, identity,
  CASE WHEN chrom THEN round(ref_coverage, 6) END AS ref_coverage, CASE WHEN chrom THEN chain_identity END AS chain_identity, CASE WHEN chrom THEN collinearity END AS collinearity, CASE WHEN chrom THEN n_chains END AS n_chains, CASE WHEN class = 'contaminant' THEN species END AS species, CASE WHEN class = 'contaminant' THEN least(1.0, score / 1e9) END AS contaminant_score FROM f5)"""


_HELD: dict[tuple[str, str, str], DataFrame] = {}


def _held(s: SparkSession, d: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A table of the run over a folder. The queries over one run share its tables, as long as they are there."""
    key = (s.sparkContext.applicationId, d, name)
    df = _HELD.get(key)
    if df is not None and (path := getattr(df, "_path", None)):
        at = s._jvm.org.apache.hadoop.fs.Path(path)
        df = df if at.getFileSystem(s._jsc.hadoopConfiguration()).exists(at) else None
    if df is None:
        _HELD[key] = df = run.written(make(), name)
    return df


def _report(s, d):
    return _held(s, d, "report", lambda: _classified(s, d))


def _chains(s, d):
    return _held(s, d, "chains", lambda: run.macro_blocks(run.chain_greedy(view(s, d, "run_blocks"), TIES)))


def _classified(s, d):
    scan = view(s, d, "scan")
    kind = lambda k: scan.filter(F.col("kind").isin(*k)).drop("kind")
    seqs = view(s, d, "seqs")
    five, _ = sequence.telomere_repeats(F.col("seq"), C.telomere_motif, C.telomere_window, C.telomere_repeats)
    # a contig's first and last text stand for its two ends
    found = seqs.groupBy("assembly", "contig").agg(F.avg(sequence.gc_content(F.col("seq"))).alias("gc"), F.min_by(five > 0, "doc_id").alias("telo5"), F.max_by(five > 0, "doc_id").alias("telo3"))
    per = _held(s, d, "sequences", lambda: found)
    mean, sd = per.agg(F.avg("gc"), F.stddev_samp("gc")).first()
    taxa = s.read.parquet(f"{d}/nation.parquet").select(F.col("n_nationkey").cast("long").alias("taxid"), F.col("n_name").alias("name"), F.col("n_regionkey").cast("string").alias("kingdom"))
    return run.classified(view(s, d, "run_contigs"), view(s, d, "refs"), view(s, d, "run_blocks"), TIES, kind(["1-URGENT", "2-HIGH"]), kind(["3-MEDIUM"]), kind(["4-NOT SPECIFIED"]), kind(["5-LOW"]), view(s, d, "run_taxhits"), taxa, per.select("assembly", "contig", "gc"), per.select("assembly", "contig", "telo5", "telo3"), (mean, sd), stage=lambda df, name: _held(s, d, name, lambda: df))


@query(f"WITH RECURSIVE {_RUN} SELECT * FROM report")
def assembly_report(s, d):
    return _report(s, d)


_GROUP = "CASE WHEN chain_identity < 0.95 THEN 2 ELSE 1 END"
_SCAF = _RUN + f""",
 rr AS (SELECT {_P}, min(rs) + max(re) AS ref_mid FROM run_blocks GROUP BY {_P}),
 c0 AS (SELECT p.assembly, p.contig, p.ref_id, p.class, p.contig_len, p.name, p.full_length AND telo5 AND telo3 AS t2t, p.reversed, {_GROUP.replace("chain_identity", "p.chain_identity")} AS grp, p.chain_identity, pe.chain_identity AS debris_identity, ref_mid FROM report p LEFT JOIN rr USING ({_P}) LEFT JOIN pe USING ({_P}) WHERE p.ref_id IS NOT NULL AND p.class IN ('chrom_assigned', 'chrom_debris')),
 gm AS (SELECT assembly, ref_id, grp, coalesce(avg(chain_identity), 0) AS mi FROM c0 WHERE class = 'chrom_assigned' GROUP BY assembly, ref_id, grp),
 dg AS (SELECT c0.assembly, c0.contig, first(gm.grp ORDER BY abs(coalesce(debris_identity, 0) - mi), gm.grp) AS g FROM c0 JOIN gm USING (assembly, ref_id) WHERE class = 'chrom_debris' GROUP BY 1, 2),
 c1 AS (SELECT c0.*, CASE WHEN class = 'chrom_assigned' THEN c0.grp ELSE g END AS hap FROM c0 LEFT JOIN dg USING ({_K}) WHERE class = 'chrom_assigned' OR g IS NOT NULL),
 c2 AS (SELECT *, bool_or(class = 'chrom_assigned' AND t2t) OVER w AS whole, count(*) OVER w AS n, CASE WHEN hap <= 1 THEN ref_id ELSE concat(ref_id, '_', chr(CAST(64 + hap AS INT))) END AS base FROM c1 WINDOW w AS (PARTITION BY assembly, ref_id, hap)),
 c3 AS (SELECT *, CASE WHEN whole OR n = 1 THEN name ELSE base END AS scaffold, CASE WHEN whole OR n = 1 THEN contig END AS alone FROM c2 WHERE class = 'chrom_assigned' OR NOT whole),
 pl AS (SELECT *, row_number() OVER w AS part, CAST(coalesce(sum(contig_len + {C.scaffold_gap}) OVER (PARTITION BY assembly, ref_id, hap, alone ORDER BY ref_mid NULLS LAST, contig ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS s0 FROM c3 WINDOW w AS (PARTITION BY assembly, ref_id, hap, alone ORDER BY ref_mid NULLS LAST, contig))"""


def _placed(s, d):
    return _held(s, d, "placed", lambda: _scaffolds(s, d))


def _scaffolds(s, d):
    blocks = view(s, d, "run_blocks")
    mid = blocks.groupBy(*evidence.PAIR).agg((F.min("rs") + F.max("re")).alias("ref_mid"))
    top = run.best_chain(_chains(s, d).select(*evidence.PAIR, F.struct("chain_id", "strand").alias("chain_id"), F.col("matches").alias("weight"), F.col("union_bp").alias("qbp"), "identity")).select(*evidence.PAIR, F.col("identity").alias("debris_identity"))
    df = _report(s, d).join(shuffled(mid), evidence.PAIR, "left").join(shuffled(top), evidence.PAIR, "left")
    df = df.withColumns({"identity": F.col("chain_identity"), "chain_identity": F.col("debris_identity"), "grp": F.when(F.col("chain_identity") < 0.95, 2).otherwise(1), "ref_name": F.col("ref_id")})
    return scaffold.scaffolds(scaffold.haplotypes(df))


@query(f"WITH RECURSIVE {_SCAF} SELECT assembly, scaffold AS object, s0 + 1 AS beg, s0 + contig_len AS \"end\", CAST(2 * part - 1 AS BIGINT) AS part, 'W' AS type, contig AS component, '1' AS component_beg, CAST(contig_len AS VARCHAR) AS component_end, CASE WHEN reversed THEN '-' ELSE '+' END AS orientation FROM pl UNION ALL SELECT assembly, scaffold, s0 + 1 - {C.scaffold_gap}, s0, CAST(2 * part - 2 AS BIGINT), 'N', '{C.scaffold_gap}', 'scaffold', 'yes', 'align_genus' FROM pl WHERE part > 1")
def haplotype_agp(s, d):
    return scaffold.agp_rows(_placed(s, d))


@query(f"WITH RECURSIVE {_SCAF}, bl AS (SELECT assembly, contig, qs, qe, strand, l_orderkey, l_linenumber, l_partkey FROM run_blocks), j AS (SELECT bl.*, scaffold, s0, contig_len, reversed, least(qe, contig_len) AS hi FROM bl LEFT JOIN pl USING ({_K}) WHERE scaffold IS NULL OR qs < contig_len) SELECT {_K}, qs AS \"start\", qe AS \"end\", strand, l_orderkey, l_linenumber, l_partkey, coalesce(scaffold, contig) AS scaffold, CASE WHEN scaffold IS NULL THEN qs WHEN reversed THEN s0 + contig_len - hi ELSE s0 + qs END AS s_start, CASE WHEN scaffold IS NULL THEN qe WHEN reversed THEN s0 + contig_len - qs ELSE s0 + hi END AS s_end, CASE WHEN scaffold IS NULL OR NOT reversed THEN strand WHEN strand = '+' THEN '-' ELSE '+' END AS s_strand FROM j")
def scaffold_lifted(s, d):
    pieces = scaffold.components(scaffold.agp_rows(_placed(s, d)))
    blocks = view(s, d, "run_blocks").select("assembly", "contig", F.col("qs").alias("start"), F.col("qe").alias("end"), "strand", *TIES)
    return scaffold.lift(blocks, pieces)


_SCALE = 1_000_000
_PILLS = _SCAF + f""",
 rf AS (SELECT regexp_extract(ref_id, '^chr[0-9]+([A-Z])', 1) AS subgenome, CAST(regexp_extract(ref_id, '^chr([0-9]+)', 1) AS INT) AS chrom_num, ref_id, ref_len FROM refs WHERE ref_id NOT IN ('chrC', 'chrM')),
 lk AS (SELECT p.assembly, name AS contig, p.contig AS original, p.ref_id, contig_len, reversed FROM report p JOIN rf USING (ref_id)),
 sz AS (SELECT assembly, scaffold, CAST(2 * count(*) - 1 AS BIGINT) AS n_rows, max(s0 + contig_len) AS size FROM pl GROUP BY 1, 2),
 ap AS (SELECT assembly, ref_id, sum(contig_len) / {_SCALE} + (count(*) - 1) * 0.4e0 AS w FROM lk GROUP BY 1, 2),
 wd AS (SELECT ref_id, max(coalesce(size / {_SCALE}, w)) AS widest FROM ap FULL JOIN (SELECT assembly, scaffold AS ref_id, size FROM sz WHERE n_rows > 1) USING (assembly, ref_id) GROUP BY ref_id),
 cw2 AS (SELECT rf.*, greatest(ref_len / {_SCALE}, widest) AS width FROM rf LEFT JOIN wd USING (ref_id)),
 cx AS (SELECT *, coalesce(sum(width + 0.2e0) OVER (PARTITION BY subgenome ORDER BY chrom_num, ref_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + width / 2 AS x FROM cw2),
 sn AS (SELECT DISTINCT assembly, ref_id, ref_id AS object, 0 AS place FROM lk UNION SELECT DISTINCT assembly, ref_id, regexp_replace(contig, '_[fc][0-9]+$', ''), 1 FROM lk WHERE regexp_replace(contig, '_[fc][0-9]+$', '') <> ref_id),
 ss AS (SELECT sn.*, size, n_rows, CASE WHEN n_rows > 1 THEN size / {_SCALE} ELSE 0 END AS span, x, subgenome, (SELECT min(CAST(regexp_extract(k.contig, '([0-9]+)$', 1) AS INT)) FROM lk k WHERE k.assembly = sn.assembly AND k.ref_id = sn.ref_id AND regexp_replace(k.contig, '_[fc][0-9]+$', '') = sn.object AND regexp_matches(k.contig, '[0-9]$')) AS num FROM sn JOIN sz ON sz.assembly = sn.assembly AND sz.scaffold = object JOIN cx USING (ref_id)),
 sl AS (SELECT *, x - (sum(span) OVER (PARTITION BY assembly, ref_id) + (count(*) OVER (PARTITION BY assembly, ref_id) - 1) * 0.4e0) / 2 + coalesce(sum(span + 0.4e0) OVER (PARTITION BY assembly, ref_id ORDER BY place, num, object ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "left" FROM ss),
 ctg AS (SELECT lk.*, contig_len / {_SCALE} AS span, x, subgenome, regexp_replace(contig, '[0-9]+$', '') AS stem, TRY_CAST(regexp_extract(contig, '([0-9]+)$', 1) AS INT) AS num FROM lk JOIN cx USING (ref_id) WHERE NOT EXISTS (SELECT 1 FROM pl JOIN sl ON sl.assembly = pl.assembly AND sl.object = pl.scaffold AND sl.n_rows > 1 WHERE pl.assembly = lk.assembly AND pl.contig = lk.original)),
 cl2 AS (SELECT *, x - (sum(span) OVER (PARTITION BY assembly, ref_id) + (count(*) OVER (PARTITION BY assembly, ref_id) - 1) * 0.4e0) / 2 + coalesce(sum(span + 0.4e0) OVER (PARTITION BY assembly, ref_id ORDER BY stem, num ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "left" FROM ctg),
 pills AS (SELECT subgenome, ref_id, CAST(NULL AS VARCHAR) AS assembly, ref_id AS name, 'reference' AS kind, ref_len AS size, FALSE AS reversed, x - ref_len / {_SCALE} / 2 AS "left", x + ref_len / {_SCALE} / 2 AS "right" FROM cx
  UNION ALL SELECT subgenome, ref_id, assembly, object, 'scaffold', size, FALSE, "left", "left" + span FROM sl WHERE n_rows > 1
  UNION ALL SELECT subgenome, ref_id, assembly, contig, 'contig', contig_len, reversed, "left", "left" + span FROM cl2)"""


def _drawn(s, d):
    agp = _held(s, d, "agp", lambda: scaffold.agp_rows(_placed(s, d)))
    refs = view(s, d, "refs").filter("ref_id not in ('chrC', 'chrM')").select(ids.subgenome(F.col("ref_id")).alias("subgenome"), F.regexp_extract("ref_id", "^chr(\\d+)", 1).cast("int").alias("chrom_num"), "ref_id", "ref_len")
    contigs = _report(s, d).select("assembly", F.col("name").alias("contig"), F.col("contig").alias("original"), "ref_id", "contig_len", "reversed").join(refs.select("ref_id"), "ref_id")
    return layout.stretches(layout.columns(refs, contigs, agp, _SCALE), contigs, agp, _SCALE), agp


@query(f"WITH RECURSIVE {_PILLS} SELECT subgenome, ref_id, assembly, name, kind, size, reversed, round(\"left\", 8) AS \"left\", round(\"right\", 8) AS \"right\" FROM pills")
def riparian_layout(s, d):
    return _drawn(s, d)[0].withColumns({c: F.round(c, 8) for c in ("left", "right")})


@query(f"WITH RECURSIVE {_PILLS} SELECT p.assembly, p.name, round(\"left\" + (s0 + s0 - {C.scaffold_gap} + 1) / 2 / p.size * (\"right\" - \"left\"), 6) AS x FROM pl JOIN pills p ON p.assembly = pl.assembly AND p.name = scaffold AND kind = 'scaffold' WHERE part > 1")
def riparian_joins(s, d):
    placed, agp = _drawn(s, d)
    return layout.joins(placed, agp).withColumn("x", F.round("x", 6))


#: Alignments of each assembly with the one before it.
_PAIR = """
SELECT concat('asm_', CAST(CAST(substring(assembly, 5) AS INT) - 1 AS STRING)) AS left_assembly, assembly AS right_assembly, contig,
       concat('ctg_', CAST((CAST(substring(contig, 5) AS INT) + CASE WHEN l_linenumber <= 5 THEN 0 ELSE l_partkey % 3 END) % 20 AS STRING)) AS target,
       strand, qs, qe, rs, re, matches, aln_len, l_orderkey, l_linenumber, l_partkey
FROM kept WHERE assembly <> 'asm_0' AND aln_len >= 5000"""


@query("WITH RECURSIVE " + ctes("kept") + f", pb AS (SELECT concat(left_assembly, '|', right_assembly) AS assembly, target AS ref_id, * EXCLUDE (target), CAST(NULL AS VARCHAR) AS gene_id FROM ({_PAIR})), {chains_sql('pb', compare.PAIRWISE)} SELECT split_part(assembly, '|', 1) AS \"left\", split_part(assembly, '|', 2) AS \"right\", ref_id AS target, contig, strand, chain_id, qstart, qend, qspan_bp, union_bp, matches, aln_len, identity, n_segments, ref_start, ref_end FROM mb")
def pairwise_synteny(s, d):
    df = s.sql(_PAIR.replace("FROM kept", "FROM {kept}"), kept=view(s, d, "kept"))
    return compare.pairwise_synteny(df.withColumnsRenamed({"left_assembly": "left", "right_assembly": "right"}), TIES)


@query(f"WITH RECURSIVE {ctes('kept')}, {_RUN}, og AS (SELECT mb.assembly, mb.contig, regexp_extract(mb.ref_id, '^(chr[0-9]+)', 1) AS origin, CASE WHEN reversed THEN contig_len - qend ELSE qstart END AS s, CASE WHEN reversed THEN contig_len - qstart ELSE qend END AS e FROM mb JOIN report r ON r.assembly = mb.assembly AND r.contig = mb.contig WHERE qspan_bp >= 50000), bl AS (SELECT DISTINCT assembly, contig, qs, qe FROM kept WHERE aln_len >= 5000), j AS (SELECT bl.assembly, bl.contig, qs, qe, origin, min(greatest(qs, s)) AS s1, max(least(qe, e)) AS e1, CAST(sum(least(qe, e) - greatest(qs, s)) AS BIGINT) AS bp FROM bl JOIN og ON og.assembly = bl.assembly AND og.contig = bl.contig AND s < qe AND e > qs GROUP BY ALL) SELECT {_K}, qs, qe, origin, coalesce(s1, qs) AS \"start\", coalesce(e1, qe) AS \"end\", coalesce(bp, 0) AS bp, round(coalesce((s1 - qs) / (qe - qs), 0), 6) AS from_share, round(coalesce((e1 - qs) / (qe - qs), 1), 6) AS to_share, row_number() OVER (PARTITION BY {_K}, qs, qe ORDER BY s1, origin) AS part FROM bl LEFT JOIN j USING ({_K}, qs, qe)")
def origin_segments(s, d):
    origins = compare.oriented_origins(_chains(s, d), _report(s, d), F.regexp_extract("ref_id", "^(chr\\d+)", 1))
    blocks = view(s, d, "kept").filter("aln_len >= 5000")
    return compare.origin_segments(blocks, origins).withColumns({c: F.round(c, 6) for c in ("from_share", "to_share")})
