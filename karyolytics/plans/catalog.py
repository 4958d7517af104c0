"""The queries over the adapter views, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT as C
from ..functions import ids, sequence
from ..operators import assign, chaining, classify, compare, detect, evidence, intervals, rdna, rearrange, scaffold, subgenome
from ..sources import readers
from .adapters import ctes, view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
TIES = ["l_orderkey", "l_linenumber", "l_partkey"]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _best(s, d):
    return assign.best_second(evidence.pair_evidence(view(s, d, "kept")))


_P = "assembly, contig, ref_id"
_EV = ctes("kept", "contigs", "refs") + f""", nw AS (SELECT *, greatest(0, qe - greatest(qs, coalesce(max(qe) OVER (PARTITION BY {_P} ORDER BY qs, qe ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), qs))) AS nb FROM kept),
 ev AS (SELECT {_P}, CAST(sum(nb) AS BIGINT) AS union_bp, CAST(sum(matches) AS BIGINT) AS matches, CAST(sum(aln_len) AS BIGINT) AS aln_len, count(DISTINCT gene_id) AS n_genes, count(*) AS n_blocks, min(qs) AS q_min, max(qe) AS q_max, round(sum(matches) / sum(aln_len), 6) AS identity FROM nw GROUP BY {_P}),
 rk AS (SELECT *, row_number() OVER (PARTITION BY assembly, contig ORDER BY union_bp DESC, ref_id) AS r FROM ev),
 best AS (SELECT assembly, contig, max(CASE WHEN r = 1 THEN ref_id END) AS best_ref, max(CASE WHEN r = 1 THEN union_bp END) AS best_bp, max(CASE WHEN r = 2 THEN ref_id END) AS second_ref, coalesce(max(CASE WHEN r = 2 THEN union_bp END), 0) AS second_bp FROM rk WHERE r <= 2 GROUP BY assembly, contig),
 tot AS (SELECT assembly, contig, CAST(sum(union_bp) AS BIGINT) AS total_bp, count(*) AS n_refs FROM ev GROUP BY assembly, contig)"""
_WITH = f"WITH {_EV} "
_CL = _EV + f""", ci AS (SELECT *, sum(CASE WHEN pe IS NULL OR qs > pe + {C.cluster_gap} THEN 1 ELSE 0 END) OVER (PARTITION BY {_P} ORDER BY qs, qe ROWS UNBOUNDED PRECEDING) AS island FROM (SELECT *, max(qe) OVER (PARTITION BY {_P} ORDER BY qs, qe ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM kept)),
 cg AS (SELECT {_P}, island, min(qs) AS c_start, max(qe) - min(qs) AS span_bp, CAST(sum(matches) AS BIGINT) AS aligned_bp, count(DISTINCT gene_id) AS n_genes FROM ci GROUP BY {_P}, island),
 lc AS (SELECT {_P}, c_start, span_bp, aligned_bp, n_genes FROM (SELECT *, row_number() OVER (PARTITION BY {_P} ORDER BY span_bp DESC, c_start) AS r FROM cg) WHERE r = 1)"""


@query(_WITH + "SELECT t.assembly, t.contig, best_ref, round(coalesce(best_bp, 0) / total_bp, 6) AS frac, CASE WHEN coalesce(second_bp, 0) > 0 THEN round(best_bp / second_bp, 6) ELSE 1e9 END AS ratio, CASE WHEN best_ref IS NULL THEN 'NO_HITS' WHEN round(coalesce(best_bp, 0) / total_bp, 6) < 0.1 THEN 'AMBIG_LOW_FRAC' WHEN (CASE WHEN coalesce(second_bp, 0) > 0 THEN round(best_bp / second_bp, 6) ELSE 1e9 END) < 1.25 THEN 'AMBIG_LOW_RATIO' ELSE 'OK' END AS status FROM tot t LEFT JOIN best b USING (assembly, contig)")
def assign_status(s, d):
    ev = evidence.pair_evidence(view(s, d, "kept"))
    return assign.assign_status(assign.best_second(ev), evidence.contig_totals(ev))


_RAW = "WITH " + ctes("aln") + ", ids AS (SELECT DISTINCT CASE l_partkey % 4 WHEN 0 THEN upper(ref_id) WHEN 1 THEN concat('C', substring(ref_id, 2), '_c2') WHEN 2 THEN ref_id ELSE ['Pt', 'ChrM', 'cpDNA', 'Chloroplast', 'plastid', 'chrC', 'MT', 'mitochondrion', 'Mitochondria', 'mitochondrial', 'cp', 'mito', 'scaffold_7'][1 + l_suppkey % 13] END AS raw FROM aln) "


def _raw_ids(s, d):
    k = F.col("l_partkey") % 4
    names = ["Pt", "ChrM", "cpDNA", "Chloroplast", "plastid", "chrC", "MT", "mitochondrion", "Mitochondria", "mitochondrial", "cp", "mito", "scaffold_7"]
    other = F.get(F.array(*map(F.lit, names)), (F.col("l_suppkey") % 13).cast("int"))
    raw = F.when(k == 0, F.upper("ref_id")).when(k == 1, F.concat(F.lit("C"), F.substring("ref_id", 2, 99), F.lit("_c2"))).when(k == 2, F.col("ref_id")).otherwise(other)
    return view(s, d, "aln").select(raw.alias("raw")).distinct()


@query(_RAW + "SELECT raw, regexp_replace(raw, '^(?i:chr)', 'chr') AS ref_id, CASE WHEN lower(raw) IN ('chrc', 'cpdna', 'chloroplast', 'plastid', 'pt') THEN 'chrC' WHEN lower(raw) IN ('chrm', 'mt', 'mitochondrion', 'mitochondria', 'mitochondrial') THEN 'chrM' END AS organelle FROM ids")
def id_normalize(s, d):
    return _raw_ids(s, d).select("raw", ids.normalize_ref_id(F.col("raw")).alias("ref_id"), ids.organelle_id(F.col("raw")).alias("organelle"))


@query(_RAW + ", o AS (SELECT raw, CASE WHEN lower(raw) IN ('chrc', 'cpdna', 'chloroplast', 'plastid', 'pt') THEN 'chrC' WHEN lower(raw) IN ('chrm', 'mt', 'mitochondrion', 'mitochondria', 'mitochondrial') THEN 'chrM' END AS organelle, CASE WHEN substring(raw, 1, 3) = 'Chr' THEN 'Chr' ELSE 'chr' END AS style FROM ids) SELECT raw, CASE WHEN organelle IS NOT NULL THEN concat(style, substring(organelle, 4)) WHEN regexp_matches(raw, '^(?i:chr)[0-9]') THEN concat(style, regexp_extract(raw, '^(?i:chr)([0-9]+)', 1)) ELSE raw END AS chrom_id, CASE WHEN organelle IS NOT NULL OR NOT regexp_matches(raw, '^(?i:chr)[0-9]') THEN 'NA' ELSE regexp_extract(raw, '^(?i:chr)[0-9]+([A-Za-z])', 1) END AS subgenome FROM o")
def id_split(s, d):
    return _raw_ids(s, d).select("raw", ids.chrom_id(F.col("raw")).alias("chrom_id"), ids.subgenome(F.col("raw")).alias("subgenome"))


#: Names of two styles, each split by a pattern of its own.
_CUSTOM = ids.Patterns([r"chr(?:omosome)?_?(?P<chrom>\d+)(?P<sg>[ab]t)?$", r"(?P<chrom>ns\d+)\.(?P<sg>[A-Z])$"])
_STYLES = _RAW + ", st AS (SELECT raw FROM ids UNION SELECT concat('Chromosome_', CAST(l_partkey % 12 AS STRING), CASE l_linenumber % 3 WHEN 0 THEN 'At' WHEN 1 THEN 'bT' ELSE '' END) FROM aln UNION SELECT concat('NS', CAST(l_suppkey AS STRING), CASE WHEN l_linenumber < 3 THEN '.D' WHEN l_linenumber < 5 THEN '.E_f3' ELSE '_5' END) FROM aln) "


def _styles(s, d):
    aln = view(s, d, "aln")
    line = F.col("l_linenumber") % 3
    two = F.concat(F.lit("Chromosome_"), (F.col("l_partkey") % 12).cast("string"), F.when(line == 0, "At").when(line == 1, "bT").otherwise(""))
    three = F.concat(F.lit("NS"), F.col("l_suppkey").cast("string"), F.when(F.col("l_linenumber") < 3, ".D").when(F.col("l_linenumber") < 5, ".E_f3").otherwise("_5"))
    return _raw_ids(s, d).union(aln.select(two)).union(aln.select(three)).distinct()


_ORGANELLE = "CASE WHEN lower(raw) IN ('chrc', 'cpdna', 'chloroplast', 'plastid', 'pt') THEN 'chrC' WHEN lower(raw) IN ('chrm', 'mt', 'mitochondrion', 'mitochondria', 'mitochondrial') THEN 'chrM' END"


@query(_STYLES + f", n AS (SELECT raw, {_ORGANELLE} AS org, regexp_replace(regexp_replace(regexp_replace(raw, '^(?i:chr)', 'chr'), '_[fc][0-9]+$', ''), '_[A-Z]$', '') AS nm FROM st), f AS (SELECT *, regexp_matches(nm, '(?i)^chr(?:omosome)?_?[0-9]+(?:[ab]t)?$') AS a, regexp_matches(nm, '(?i)^ns[0-9]+[.][A-Z]$') AS b FROM n) SELECT raw, CASE WHEN org IS NOT NULL THEN CASE WHEN starts_with(raw, 'Chr') THEN concat('Chr', substring(org, 4)) ELSE org END WHEN a THEN regexp_extract(nm, '([0-9]+)', 1) WHEN b THEN regexp_extract(nm, '(?i)(ns[0-9]+)', 1) ELSE raw END AS chrom_id, CASE WHEN org IS NOT NULL THEN 'NA' WHEN a THEN coalesce(nullif(regexp_extract(nm, '(?i)([ab]t)$', 1), ''), 'NA') WHEN b THEN right(nm, 1) ELSE 'NA' END AS subgenome FROM f")
def id_custom(s, d):
    return _styles(s, d).select("raw", _CUSTOM.chrom_id(F.col("raw")).alias("chrom_id"), _CUSTOM.subgenome(F.col("raw")).alias("subgenome"))


@query(_STYLES + f", n AS (SELECT raw AS original, coalesce({_ORGANELLE}, regexp_replace(raw, '^(?i:chr)', 'chr')) AS ref_id FROM st) SELECT original, ref_id, row_number() OVER (PARTITION BY ref_id ORDER BY length(original), original) = 1 AS first FROM n")
def id_maps(s, d):
    return ids.id_map(_styles(s, d).withColumn("order", F.length("raw")), "raw", "order")


@query("WITH " + ctes("aln") + " SELECT assembly, tp, count(*) AS n, CAST(sum(aln_len) AS BIGINT) AS bp FROM aln WHERE (tp IS NULL OR tp IN ('P', 'I')) AND aln_len >= 5000 AND mapq >= 20 AND qs < qe AND rs < re GROUP BY assembly, tp")
def paf_filter(s, d):
    return view(s, d, "aln").filter(readers.passes(5000, 20)).groupBy("assembly", "tp").agg(F.count("*").alias("n"), F.sum("aln_len").alias("bp"))


@query(_WITH + f"SELECT {_P}, union_bp FROM ev")
def interval_union(s, d):
    return intervals.union_bp(view(s, d, "kept"), evidence.PAIR, "qs", "qe")


@query("WITH " + ctes("kept") + f" SELECT {_P}, min(qs) AS qs, max(qe) AS qe, count(*) AS n FROM (SELECT *, sum(CASE WHEN pe IS NULL OR qs > pe THEN 1 ELSE 0 END) OVER (PARTITION BY {_P} ORDER BY qs, qe ROWS UNBOUNDED PRECEDING) AS i FROM (SELECT *, max(qe) OVER (PARTITION BY {_P} ORDER BY qs, qe ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM kept)) GROUP BY {_P}, i")
def interval_islands(s, d):
    return intervals.merged(view(s, d, "kept"), evidence.PAIR, "qs", "qe")


@query("WITH " + ctes("kept") + f" SELECT {_P}, CAST(sum(greatest(0, re - greatest(rs, coalesce(pe, rs)))) AS BIGINT) AS ref_union_bp, min(rs) AS ref_start, max(re) AS ref_end FROM (SELECT *, max(re) OVER (PARTITION BY {_P} ORDER BY rs, re ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM kept) GROUP BY {_P}")
def ref_span(s, d):
    return evidence.ref_span(view(s, d, "kept"))


@query(_WITH + "SELECT * FROM ev")
def pair_evidence(s, d):
    return evidence.pair_evidence(view(s, d, "kept"))


@query(_WITH + "SELECT * FROM tot")
def contig_totals(s, d):
    return evidence.contig_totals(evidence.pair_evidence(view(s, d, "kept")))


@query(_WITH + "SELECT * FROM best")
def best_second_ref(s, d):
    return _best(s, d)


_GATE = "(SELECT e.* FROM ev e JOIN contigs c USING (assembly, contig) WHERE n_blocks >= 1 AND q_max - q_min >= 50000 AND (q_max - q_min) / contig_len >= 0.2)"


@query(_WITH + f", gr AS (SELECT *, row_number() OVER (PARTITION BY assembly, contig ORDER BY union_bp DESC, ref_id) AS g FROM {_GATE}), gb AS (SELECT assembly, contig, max(CASE WHEN g = 1 THEN ref_id END) AS best_ref, max(CASE WHEN g = 1 THEN union_bp END) AS best_bp, max(CASE WHEN g = 2 THEN ref_id END) AS second_ref, coalesce(max(CASE WHEN g = 2 THEN union_bp END), 0) AS second_bp FROM gr WHERE g <= 2 GROUP BY assembly, contig) SELECT c.assembly, c.contig, best_ref, best_bp, second_ref, second_bp FROM contigs c LEFT JOIN gb USING (assembly, contig)")
def gate_rerank(s, d):
    return assign.gate_rerank(evidence.pair_evidence(view(s, d, "kept")), view(s, d, "contigs"))


@query(_WITH + "SELECT assembly, contig, n_refs >= 2 AND best_bp < 0.8 * total_bp AND second_bp >= 0.2 * total_bp AS chimeric FROM tot JOIN best USING (assembly, contig)")
def chimera_flag(s, d):
    ev = evidence.pair_evidence(view(s, d, "kept"))
    return assign.chimera_flag(assign.best_second(ev), evidence.contig_totals(ev))


@query("WITH " + ctes("kept") + f" SELECT {_P}, CAST(sum(matches) AS BIGINT) AS topk_score FROM (SELECT *, row_number() OVER (PARTITION BY {_P} ORDER BY matches DESC) AS r FROM kept) WHERE r <= 3 GROUP BY {_P}")
def topk_score(s, d):
    return evidence.topk_score(view(s, d, "kept"), evidence.PAIR, "matches", C.chain_topk)


_O = "qs + qe, qs, qe, rs, re, l_orderkey, l_linenumber, l_partkey"


@query("WITH " + ctes("kept") + f", v AS (SELECT {_P}, qs + qe - lag(qs + qe) OVER w AS dq, rs + re - lag(rs + re) OVER w AS dr FROM kept WINDOW w AS (PARTITION BY {_P} ORDER BY {_O})), g AS (SELECT {_P}, count(*) FILTER (WHERE abs(dq) >= 200 AND dr > 0) AS forward, count(*) FILTER (WHERE abs(dq) >= 200 AND dr < 0) AS reverse FROM v GROUP BY {_P}) SELECT *, CASE WHEN reverse > forward THEN '-' ELSE '+' END AS strand FROM g")
def strand_votes(s, d):
    return evidence.strand_votes(view(s, d, "kept"))


@query("WITH " + ctes("kept") + f", v AS (SELECT {_P}, least(matches, lead(matches) OVER w) AS wt, lead(matches) OVER w AS nx, lead(strand) OVER w = strand AND CASE WHEN strand = '+' THEN lead(rs + re) OVER w > rs + re ELSE lead(rs + re) OVER w < rs + re END AS same FROM kept WINDOW w AS (PARTITION BY {_P} ORDER BY {_O})), g AS (SELECT {_P}, CAST(coalesce(sum(wt) FILTER (WHERE nx IS NOT NULL), 0) AS BIGINT) AS weight, CAST(coalesce(sum(wt) FILTER (WHERE same), 0) AS BIGINT) AS kp, count(*) AS n FROM v GROUP BY {_P}) SELECT {_P}, weight, CASE WHEN weight = 0 THEN 1.0 ELSE round(kp / weight, 6) END AS collinearity FROM g")
def collinearity(s, d):
    return evidence.collinearity(view(s, d, "kept"), TIES)


@query(_WITH + ", o AS (SELECT k.assembly, k.contig, CAST(sum(CASE WHEN strand = '+' THEN matches ELSE 0 END) AS BIGINT) AS forward_bp, CAST(sum(CASE WHEN strand = '-' THEN matches ELSE 0 END) AS BIGINT) AS reverse_bp FROM kept k JOIN best b ON k.assembly = b.assembly AND k.contig = b.contig AND k.ref_id = b.best_ref GROUP BY k.assembly, k.contig) SELECT *, reverse_bp > forward_bp AS reverse FROM o")
def orientation_votes(s, d):
    return evidence.orientation_votes(view(s, d, "kept"), _best(s, d))


@query(f"WITH {_CL} SELECT * FROM lc")
def largest_cluster(s, d):
    return evidence.largest_cluster(view(s, d, "kept"))


@query(f"WITH {_CL} SELECT lc.assembly, round(median(1000000.0 * n_genes / span_bp), 4) AS density FROM lc JOIN best b ON lc.assembly = b.assembly AND lc.contig = b.contig AND lc.ref_id = b.best_ref WHERE span_bp > 0 AND n_genes > 0 GROUP BY lc.assembly")
def gene_density_median(s, d):
    k = view(s, d, "kept")
    n = intervals.tasks(k)
    best = assign.best_second(evidence.pair_evidence(k, n))
    on = evidence.largest_cluster(k, n=n).join(best.select("assembly", "contig", F.col("best_ref").alias("ref_id")), evidence.PAIR)
    return on.filter("span_bp > 0 and n_genes > 0").groupBy("assembly").agg(F.round(F.median(1000000.0 * F.col("n_genes") / F.col("span_bp")), 4).alias("density"))


@query(f"WITH {_CL} SELECT lc.assembly, lc.contig, string_agg(ref_id, ',' ORDER BY span_bp DESC, ref_id) AS candidates FROM lc JOIN best b ON lc.assembly = b.assembly AND lc.contig = b.contig AND lc.ref_id <> b.best_ref JOIN contigs c ON c.assembly = lc.assembly AND c.contig = lc.contig WHERE span_bp >= 0.1 * contig_len AND aligned_bp >= 0.15 * span_bp GROUP BY lc.assembly, lc.contig")
def rearr_candidates(s, d):
    k = view(s, d, "kept")
    n = intervals.tasks(k)
    return evidence.rearrangement_candidates(evidence.largest_cluster(k, n=n), assign.best_second(evidence.pair_evidence(k, n)), view(s, d, "contigs"))


_G = "assembly, contig, ref_id, strand"
_BO = "qs, qe, rs, re, l_orderkey, l_linenumber, l_partkey"


def chains_sql(source: str, C=C) -> str:
    """Greedy chaining as a recursion over the blocks of a stretch; the state is the list of its chains: last end, last place, diagonal, number."""
    return f"""cs AS (SELECT *, CASE WHEN strand = '-' THEN -re ELSE rs END AS place, CASE WHEN strand = '-' THEN rs + qs ELSE rs - qs END AS diag, sum(CASE WHEN pe IS NULL OR qs > pe + {C.chain_q_gap} THEN 1 ELSE 0 END) OVER (PARTITION BY {_G} ORDER BY {_BO} ROWS UNBOUNDED PRECEDING) AS island FROM (SELECT *, max(qe) OVER (PARTITION BY {_G} ORDER BY {_BO} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM {source})),
 cb AS (SELECT *, dense_rank() OVER (ORDER BY {_G}, island) AS g, row_number() OVER (PARTITION BY {_G}, island ORDER BY {_BO}) AS k FROM cs),
 cr AS (SELECT g, k, CAST(0 AS BIGINT) AS chain, [{{'e': qe, 'p': place, 'd': diag, 'i': CAST(0 AS BIGINT)}}] AS open FROM cb WHERE k = 1
  UNION ALL SELECT g, k, coalesce(m.i, len(open)) AS chain, CASE WHEN m IS NULL THEN list_append(open, {{'e': qe, 'p': place, 'd': diag, 'i': CAST(len(open) AS BIGINT)}}) ELSE list_transform(open, lambda x: CASE WHEN x.i = m.i THEN {{'e': greatest(x.e, qe), 'p': place, 'd': x.d, 'i': x.i}} ELSE x END) END
  FROM (SELECT cb.g, cb.k, open, qs, qe, place, diag, list_min(list_transform(list_filter(open, lambda x: qs - x.e <= {C.chain_q_gap} AND abs(place - x.p) <= {C.chain_r_gap} AND abs(diag - x.d) <= {C.chain_diag_slop}), lambda x: {{'c': abs(qs - x.e) + abs(place - x.p) + abs(diag - x.d) // 10, 'i': x.i}})) AS m FROM cr JOIN cb ON cb.g = cr.g AND cb.k = cr.k + 1)),
 ch AS (SELECT {_G}, CAST(dense_rank() OVER (PARTITION BY {_G} ORDER BY island, chain) - 1 AS BIGINT) AS chain_id, qs, qe, rs, re, matches, aln_len, gene_id, l_orderkey, l_linenumber, l_partkey FROM cb JOIN cr USING (g, k)),
 cw AS (SELECT *, max(qe) OVER (PARTITION BY {_G}, chain_id ORDER BY qs, qe ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM ch),
 mb AS (SELECT {_G}, CAST(row_number() OVER (PARTITION BY {_G} ORDER BY chain_id) - 1 AS BIGINT) AS chain_id, qstart, qend, qend - qstart AS qspan_bp, union_bp, matches, aln_len, identity, n_segments, gene_count, ref_start, ref_end FROM (SELECT {_G}, chain_id, min(qs) AS qstart, max(qe) AS qend, CAST(sum(greatest(0, qe - greatest(qs, coalesce(pe, qs)))) AS BIGINT) AS union_bp, CAST(sum(matches) AS BIGINT) AS matches, CAST(sum(aln_len) AS BIGINT) AS aln_len, round(sum(matches) / sum(aln_len), 6) AS identity, count(*) FILTER (WHERE pe IS NULL OR qs > pe) AS n_segments, count(DISTINCT gene_id) AS gene_count, min(rs) AS ref_start, max(re) AS ref_end FROM cw GROUP BY {_G}, chain_id) WHERE union_bp > 0 AND union_bp >= {C.chain_min_bp} AND identity >= {C.chain_min_ident} AND matches > 0)"""


_CHAINS = ctes("kept") + ", " + chains_sql("kept")


def _chained(s, d):
    return chaining.chain_greedy(view(s, d, "kept"), TIES)


@query(f"WITH RECURSIVE {_CHAINS} SELECT {_G}, chain_id, {_BO} FROM ch")
def chain_greedy(s, d):
    return _chained(s, d).select(*chaining.GROUP, "chain_id", "qs", "qe", "rs", "re", *TIES)


@query(f"WITH RECURSIVE {_CHAINS} SELECT * FROM mb")
def macro_blocks(s, d):
    return chaining.macro_blocks(_chained(s, d))


@query(f"WITH RECURSIVE {_CHAINS} SELECT {_G}, chain_id, min(qs) AS qs, max(qe) AS qe, count(*) AS n FROM (SELECT *, sum(CASE WHEN pe IS NULL OR qs > pe THEN 1 ELSE 0 END) OVER (PARTITION BY {_G}, chain_id ORDER BY qs, qe ROWS UNBOUNDED PRECEDING) AS seg FROM cw) GROUP BY {_G}, chain_id, seg")
def segments(s, d):
    return intervals.merged(_chained(s, d), [*chaining.GROUP, "chain_id"], "qs", "qe", n=1)  # dealt by the chaining


@query(_WITH + "SELECT assembly, contig, regexp_extract(ref_id, '^(chr[0-9]+)', 1) AS chrom_id, regexp_extract(ref_id, '^chr[0-9]+([A-Z])', 1) AS subgenome, count(*) AS n_segments, max(q_max) - min(q_min) AS span_bp FROM ev GROUP BY 1, 2, 3, 4")
def segment_support(s, d):
    return evidence.segment_support(evidence.pair_evidence(view(s, d, "kept")), ids.chrom_id(F.col("ref_id")), ids.subgenome(F.col("ref_id")))


#: Blocks of a contig one by one, by falling identity; the state is the list of kept intervals.
_KEPT = ctes("kept") + """, kb AS (SELECT *, row_number() OVER (PARTITION BY assembly, contig ORDER BY matches / aln_len DESC, l_orderkey, l_linenumber, l_partkey) AS k FROM kept),
 kr AS (SELECT assembly, contig, k, qs < qe AS ok, CASE WHEN qs < qe THEN [{'s': qs, 'e': qe}] ELSE [] END AS held FROM kb WHERE k = 1
  UNION ALL SELECT assembly, contig, k, ok, CASE WHEN ok THEN list_append(held, {'s': qs, 'e': qe}) ELSE held END FROM (SELECT kb.assembly, kb.contig, kb.k, qs, qe, held, qs < qe AND len(list_filter(held, lambda x: x.s < qe AND x.e > qs)) = 0 AS ok FROM kr JOIN kb ON kb.assembly = kr.assembly AND kb.contig = kr.contig AND kb.k = kr.k + 1))"""


@query(f"WITH RECURSIVE {_KEPT} SELECT assembly, contig, ref_id, strand, qs, qe, matches, aln_len, l_orderkey, l_linenumber, l_partkey FROM kb JOIN kr USING (assembly, contig, k) WHERE ok")
def overlap_suppression(s, d):
    return chaining.suppress_overlaps(view(s, d, "kept").select("assembly", "contig", "ref_id", "strand", "qs", "qe", "matches", "aln_len", *TIES), TIES)


@query(_WITH + "SELECT a.assembly, a.contig, a.best_ref, a.second_ref FROM best a WHERE a.second_ref IS NOT NULL AND EXISTS (SELECT 1 FROM best b WHERE b.assembly = a.assembly AND b.best_ref = a.second_ref AND b.second_ref = a.best_ref)")
def reciprocal_pairs(s, d):
    return assign.reciprocal_pairs(_best(s, d))


#: Groups of three contigs of an assembly share a best reference; most share a second one that nothing is assigned to.
_RECIPROCAL = """SELECT assembly, contig, concat('chr', CAST(k // 3 AS STRING)) AS best_ref, CASE WHEN k % 7 = 6 THEN NULL ELSE concat('chr', CAST(CASE WHEN k % 11 = 10 THEN 1 ELSE 100 + (k // 3) % 4 END AS STRING)) END AS second_ref,
 CAST(40 + (k * 37) % 50 AS DOUBLE) / 100 AS best_frac, CASE WHEN k % 7 = 6 THEN NULL ELSE CAST(3 + (k * 53) % 30 AS DOUBLE) / 100 END AS second_frac FROM (SELECT assembly, contig, row_number() OVER (PARTITION BY assembly ORDER BY contig_len, contig) - 1 AS k FROM contigs)"""


@query("WITH " + ctes("contigs") + f", sp AS ({_RECIPROCAL}), rk AS (SELECT *, row_number() OVER (PARTITION BY assembly, best_ref ORDER BY best_frac DESC, contig) AS r FROM sp), pr AS (SELECT a.assembly, a.best_ref, a.second_ref AS new_ref FROM rk a JOIN rk b ON a.assembly = b.assembly AND a.best_ref = b.best_ref AND a.r = 1 AND b.r = 2 AND a.second_ref = b.second_ref AND a.second_frac >= 0.05 AND b.second_frac >= 0.05 WHERE NOT EXISTS (SELECT 1 FROM sp t WHERE t.assembly = a.assembly AND t.best_ref = a.second_ref)), f AS (SELECT *, row_number() OVER (PARTITION BY assembly, new_ref ORDER BY best_ref) AS n FROM pr) SELECT rk.assembly, contig, rk.best_ref AS old_ref, new_ref FROM rk JOIN f ON rk.assembly = f.assembly AND rk.best_ref = f.best_ref AND f.n = 1 AND r >= 2 AND second_ref = new_ref")
def reciprocal_resolve(s, d):
    sql = _RECIPROCAL.replace("k // 3", "k div 3").replace("FROM contigs", "FROM {contigs}")
    return assign.resolve_reciprocal(s.sql(sql, contigs=view(s, d, "contigs")))


@query(_WITH + ", off AS (SELECT e.*, b.best_ref, c.contig_len, q_max - q_min AS span FROM ev e JOIN best b ON e.assembly = b.assembly AND e.contig = b.contig AND e.ref_id <> b.best_ref JOIN contigs c ON c.assembly = e.assembly AND c.contig = e.contig WHERE q_max - q_min >= 50000 AND union_bp >= 10000), f AS (SELECT o.*, EXISTS (SELECT 1 FROM off x WHERE x.assembly = o.assembly AND x.best_ref = o.ref_id AND x.ref_id = o.best_ref) AS rec, least(100000, CAST(floor(0.02 * contig_len) AS BIGINT)) AS edge FROM off o) SELECT assembly, contig, best_ref, ref_id, span, CASE WHEN rec THEN 'reciprocal_translocation' WHEN (q_min <= edge) <> (q_max >= contig_len - edge) THEN 'terminal_translocation' ELSE 'translocation' END AS kind, CASE WHEN span > 1000000 AND rec THEN 'high' WHEN span > 1000000 OR (span >= 50000 AND rec) THEN 'medium' ELSE 'low' END AS confidence FROM f")
def translocations(s, d):
    return rearrange.translocations(evidence.pair_evidence(view(s, d, "kept")), _best(s, d), view(s, d, "contigs"))


_OB = "qs, qe, rs, re, l_orderkey, l_linenumber, l_partkey"


@query(_WITH + f", o AS (SELECT k.*, sum(CASE WHEN strand = '+' THEN aln_len ELSE -aln_len END) OVER (PARTITION BY k.assembly, k.contig, k.ref_id) AS plus FROM kept k JOIN best b ON k.assembly = b.assembly AND k.contig = b.contig AND k.ref_id = b.best_ref), n AS (SELECT *, CASE WHEN lag(strand) OVER (PARTITION BY {_P} ORDER BY {_OB}) = strand THEN 0 ELSE 1 END AS nw FROM o), r AS (SELECT *, sum(nw) OVER (PARTITION BY {_P} ORDER BY {_OB} ROWS UNBOUNDED PRECEDING) AS run FROM n) SELECT {_P}, min(qs) AS \"start\", max(qe) AS \"end\", count(*) AS n_blocks, max(qe) - min(qs) AS span FROM r WHERE strand <> CASE WHEN plus >= 0 THEN '+' ELSE '-' END GROUP BY {_P}, run HAVING max(qe) - min(qs) >= 50000")
def inversions(s, d):
    return rearrange.inversions(view(s, d, "kept"), _best(s, d))


_FUSE = C.__class__(fusion_frac=0.05)


@query(_WITH + ", big AS (SELECT e.* FROM ev e JOIN contigs c USING (assembly, contig) WHERE union_bp >= 0.05 * contig_len) SELECT a.assembly, a.contig, a.ref_id AS ref_a, b.ref_id AS ref_b FROM big a JOIN big b ON a.assembly = b.assembly AND a.contig = b.contig AND (a.q_min < b.q_min OR (a.q_min = b.q_min AND a.ref_id < b.ref_id))")
def fusions(s, d):
    return rearrange.fusions(evidence.pair_evidence(view(s, d, "kept")), view(s, d, "contigs"), _FUSE)


@query(_WITH + ", rr AS (SELECT k.assembly, k.contig, k.ref_id, min(rs) AS s, max(re) AS e FROM kept k JOIN best b ON k.assembly = b.assembly AND k.contig = b.contig AND k.ref_id = b.best_ref GROUP BY 1, 2, 3), u AS (SELECT rr.*, ref_len, greatest(0, e - greatest(s, coalesce(max(e) OVER (PARTITION BY assembly, rr.ref_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), s))) AS nb FROM rr JOIN refs ON rr.ref_id = refs.ref_id) SELECT assembly, ref_id, count(*) AS n_contigs, round(sum(nb) / max(ref_len), 6) AS coverage, round(sum(nb) / max(ref_len), 6) > 0.8 AS collinear FROM u GROUP BY assembly, ref_id HAVING count(*) >= 2 AND round(sum(nb) / max(ref_len), 6) >= 0.5 AND max((e - s) / ref_len) <= 0.9")
def fissions(s, d):
    return rearrange.fissions(evidence.ref_span(view(s, d, "kept")), _best(s, d), view(s, d, "refs"))


_BL = ctes("blast", "contigs") + """, hb AS (SELECT *, greatest(0, qend - greatest(qstart, coalesce(max(qend) OVER (PARTITION BY assembly, qseqid ORDER BY qstart, qend ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), qstart))) AS nb FROM blast),
 cov AS (SELECT assembly, qseqid, CAST(sum(nb) AS BIGINT) AS union_bp, count(*) AS n_hits, CAST(sum(length) AS BIGINT) AS hit_bp, CAST(sum(CAST(trunc(pident * length / 100) AS BIGINT)) AS BIGINT) AS matches, first(sseqid ORDER BY evalue_rank, o_orderkey) AS best_subject FROM hb GROUP BY assembly, qseqid),
 hp AS (SELECT *, greatest(0, qend - greatest(qstart, coalesce(max(qend) OVER (PARTITION BY assembly, qseqid, sseqid ORDER BY qstart, qend ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), qstart))) AS nb FROM blast),
 pcov AS (SELECT assembly, qseqid, sseqid, CAST(sum(nb) AS BIGINT) AS union_bp FROM hp GROUP BY assembly, qseqid, sseqid),
 cc AS (SELECT c.assembly, contig, contig_len, union_bp / contig_len AS coverage, hit_bp, matches FROM cov JOIN contigs c ON c.assembly = cov.assembly AND qseqid = contig)"""
_HIT = ["assembly", "qseqid"]


@query(f"WITH {_BL} SELECT * FROM cov")
def blast_coverage(s, d):
    return detect.hit_coverage(view(s, d, "blast"), _HIT)


_ORG = C.__class__(organelle_cov=0.02)


@query(f"WITH {_BL}, o AS (SELECT c.assembly, contig, sseqid, round(least(1.0, union_bp / contig_len), 6) AS coverage, abs(contig_len - 4000000) AS off FROM pcov JOIN contigs c ON c.assembly = pcov.assembly AND qseqid = contig), k AS (SELECT *, CASE WHEN coverage >= 0.02 AND off <= 0.2 * 4000000 THEN 'candidate' WHEN coverage >= 0.5 THEN 'debris' ELSE 'none' END AS kind FROM o) SELECT *, kind = 'candidate' AND row_number() OVER (PARTITION BY assembly, sseqid, kind ORDER BY off, contig) = 1 AS chosen FROM k")
def organelle_select(s, d):
    cov = intervals.union_bp(view(s, d, "blast"), [*_HIT, "sseqid"], "qstart", "qend")
    return detect.organelle_select(cov, view(s, d, "contigs"), F.lit(4_000_000), F.lit(0.2), _ORG)


@query(f"WITH {_BL} SELECT assembly, contig, round(coverage, 6) AS coverage FROM cc WHERE round(coverage, 6) >= 0.02")
def rdna_contigs(s, d):
    return detect.covered_contigs(intervals.union_bp(view(s, d, "blast"), _HIT, "qstart", "qend"), view(s, d, "contigs"), 0.02)


@query(f"WITH {_BL} SELECT assembly, contig, round(coverage, 6) AS coverage, round(matches / hit_bp, 6) AS identity FROM cc WHERE round(coverage, 6) >= 0.01 AND round(matches / hit_bp, 6) >= 0.9")
def chrom_debris(s, d):
    return detect.debris(detect.hit_coverage(view(s, d, "blast"), _HIT), view(s, d, "contigs"), C, 0.01)


_TX = ctes("taxhits", "contigs") + ", taxa AS (SELECT CAST(n_nationkey AS BIGINT) AS taxid, n_name AS name, CASE n_regionkey WHEN 0 THEN 'Plant' WHEN 1 THEN 'Fungi' WHEN 2 THEN 'Animal' ELSE CAST(n_regionkey AS STRING) END AS kingdom FROM nation), pt AS (SELECT assembly, contig, taxid, CAST(sum(score) AS BIGINT) AS score, CAST(sum(matching_bp) AS BIGINT) AS matching_bp FROM taxhits WHERE score >= 1000 GROUP BY assembly, contig, taxid), tt AS (SELECT assembly, contig, taxid, coalesce(name, 'unknown') AS name, kingdom, score, round(matching_bp / contig_len, 6) AS coverage FROM (SELECT *, row_number() OVER (PARTITION BY assembly, contig ORDER BY score DESC, taxid) AS r FROM pt) x LEFT JOIN taxa USING (taxid) JOIN contigs USING (assembly, contig) WHERE r = 1)"


def _contaminants(s, d):
    region = F.col("n_regionkey")
    clade = F.when(region == 0, "Viridiplantae").when(region == 1, "Fungi").when(region == 2, "Metazoa").otherwise(region.cast("string"))
    taxa = s.read.parquet(f"{d}/nation.parquet").select(F.col("n_nationkey").cast("long").alias("taxid"), F.col("n_name").alias("name"), detect.kingdom(clade).alias("kingdom"))
    return detect.contaminants(view(s, d, "taxhits"), taxa, view(s, d, "contigs"))


@query(f"WITH {_TX} SELECT * FROM tt")
def contaminant_lineage(s, d):
    return _contaminants(s, d)


@query(f"WITH {_TX} SELECT name, count(*) AS n, CAST(sum(score) AS BIGINT) AS score FROM tt GROUP BY name ORDER BY score DESC, name LIMIT 10")
def contaminant_topn(s, d):
    return _contaminants(s, d).groupBy("name").agg(F.count("*").alias("n"), F.sum("score").alias("score")).orderBy(F.desc("score"), "name").limit(10)


@query(f"WITH {_TX} SELECT kingdom, name, count(DISTINCT assembly) AS n_assemblies FROM tt GROUP BY kingdom, name ORDER BY n_assemblies DESC, name LIMIT 10")
def taxon_prevalence(s, d):
    return _contaminants(s, d).groupBy("kingdom", "name").agg(F.countDistinct("assembly").alias("n_assemblies")).orderBy(F.desc("n_assemblies"), "name").limit(10)


_GC = ctes("seqs") + ", gc AS (SELECT doc_id, assembly, coalesce((length(seq) - length(translate(seq, 'GCgc', ''))) / nullif(length(seq) - length(translate(seq, 'ACGTacgt', '')), 0), 0) AS gc FROM seqs)"


def _gc(s, d):
    return view(s, d, "seqs").select("doc_id", "assembly", sequence.gc_content(F.col("seq")).alias("gc"))


@query(f"WITH {_GC} SELECT doc_id, assembly, round(gc, 6) AS gc FROM gc")
def gc_content(s, d):
    return _gc(s, d).withColumn("gc", F.round("gc", 6))


@query(f"WITH {_GC} SELECT assembly, round(avg(gc), 6) AS mean, round(coalesce(stddev_samp(gc), 0), 6) AS sd FROM gc GROUP BY assembly")
def gc_stats(s, d):
    return _gc(s, d).groupBy("assembly").agg(F.round(F.avg("gc"), 6).alias("mean"), F.round(F.coalesce(F.stddev_samp("gc"), F.lit(0.0)), 6).alias("sd"))


@query(f"WITH {_GC}, st AS (SELECT assembly, avg(gc) AS m, coalesce(stddev_samp(gc), 0) AS sd FROM gc GROUP BY assembly) SELECT doc_id, CASE WHEN sd >= 0.001 THEN round(abs(gc - m) / sd, 4) END AS deviation FROM gc JOIN st USING (assembly)")
def gc_deviation(s, d):
    g = _gc(s, d)
    st = g.groupBy("assembly").agg(F.avg("gc").alias("m"), F.coalesce(F.stddev_samp("gc"), F.lit(0.0)).alias("sd"))
    return g.join(F.broadcast(st), "assembly").select("doc_id", F.round(sequence.gc_deviation(F.col("gc"), F.col("m"), F.col("sd")), 4).alias("deviation"))


def _run(x: str) -> str:
    one = lambda m: f"coalesce(list_max(list_transform(regexp_extract_all({x}, '(?:{m}){{3,}}'), lambda r: length(r) // 7)), 0)"
    return f"greatest({one('TTTAGGG')}, {one('CCCTAAA')})"


@query("WITH " + ctes("seqs") + f", w AS (SELECT doc_id, substring(seq, 1, CAST(least(10000, length(seq) // 2) AS INT)) AS a, right(seq, CAST(least(10000, length(seq) // 2) AS INT)) AS b FROM seqs) SELECT doc_id, {_run('a')} AS n5, {_run('b')} AS n3 FROM w")
def telomere(s, d):
    a, b = sequence.telomere_repeats(F.col("seq"), C.telomere_motif, C.telomere_window, C.telomere_repeats)
    return view(s, d, "seqs").select("doc_id", a.alias("n5"), b.alias("n3"))


@query("WITH " + ctes("seqs") + " SELECT doc_id, md5(reverse(translate(seq, 'ACGTRYSWKMBDHVNacgtryswkmbdhvn', 'TGCAYRSWMKVHDBNtgcayrswmkvhdbn'))) AS rc FROM seqs")
def revcomp(s, d):
    return view(s, d, "seqs").select("doc_id", F.md5(sequence.reverse_complement(F.col("seq"))).alias("rc"))


_FL = _EV + ", fl AS (SELECT b.assembly, b.contig, b.best_ref, best_bp, contig_len, ref_len, CAST(substring(b.contig, 5) AS BIGINT) % 3 AS n_telo, contig_len / ref_len AS ratio, best_bp / ref_len AS cov FROM best b JOIN contigs USING (assembly, contig) JOIN refs ON best_ref = ref_id), fc AS (SELECT *, CASE WHEN n_telo >= 2 OR ratio >= 0.8 THEN TRUE ELSE cov >= 0.7 END AS full_length, CASE WHEN n_telo >= 2 THEN 'high' WHEN ratio >= 0.8 THEN CASE WHEN n_telo = 1 THEN 'medium' ELSE 'low' END WHEN n_telo = 1 THEN 'medium' ELSE 'low' END AS confidence FROM fl)"


def _full(s, d):
    df = _best(s, d).join(view(s, d, "contigs"), ["assembly", "contig"]).join(F.broadcast(view(s, d, "refs")), F.col("best_ref") == F.col("ref_id"))
    df = df.withColumn("n_telo", F.substring("contig", 5, 20).cast("long") % 3)
    yes, conf = classify.full_length(F.col("n_telo"), F.col("contig_len") / F.col("ref_len"), F.col("best_bp") / F.col("ref_len"))
    return df.select("assembly", "contig", "best_ref", "best_bp", "contig_len", "ref_len", yes.alias("full_length"), conf.alias("confidence"))


@query(f"WITH {_FL} SELECT assembly, contig, full_length, confidence FROM fc")
def full_length(s, d):
    return _full(s, d).select("assembly", "contig", "full_length", "confidence")


_CC = _FL + ", k AS (SELECT c.assembly, c.contig, c.contig_len, CAST(substring(c.contig, 5) AS BIGINT) AS i, b.best_ref IS NOT NULL AS assigned, coalesce(fc.full_length, FALSE) AS full_length FROM contigs c LEFT JOIN best b USING (assembly, contig) LEFT JOIN fc USING (assembly, contig)), cc AS (SELECT *, CASE WHEN assigned AND contig_len >= 4000000 THEN 'chrom_assigned' WHEN contig_len >= 4000000 AND i % 5 <> 0 THEN 'chrom_unassigned' WHEN i % 11 = 0 THEN 'organelle_complete' WHEN i % 13 = 0 THEN 'organelle_debris' WHEN i % 7 = 0 THEN 'rDNA' WHEN i % 5 = 0 THEN 'contaminant' WHEN i % 6 = 0 THEN 'chrom_debris' WHEN i % 2 = 0 THEN CASE WHEN assigned THEN 'chrom_debris' ELSE 'debris' END ELSE 'unclassified' END AS class FROM k)"


def _classes(s, d):
    i = F.substring("contig", 5, 20).cast("long")
    k = view(s, d, "contigs").join(_best(s, d).select("assembly", "contig", F.col("best_ref").alias("ref_id")), ["assembly", "contig"], "left").join(_full(s, d).select("assembly", "contig", "full_length"), ["assembly", "contig"], "left")
    k = k.withColumns({"assigned": F.col("ref_id").isNotNull(), "chromosome_like": F.col("contig_len") >= 4_000_000, "contaminant": i % 5 == 0, "organelle": i % 11 == 0, "organelle_debris": i % 13 == 0, "rdna": i % 7 == 0, "chrom_debris": i % 6 == 0, "debris": i % 2 == 0, "full_length": F.coalesce("full_length", F.lit(False))})
    return classify.cascade(k)


@query(f"WITH {_CC} SELECT assembly, contig, class FROM cc")
def classify_cascade(s, d):
    return _classes(s, d).select("assembly", "contig", "class")


@query(f"WITH {_FL}, n AS (SELECT fc.assembly, fc.contig, contig_len, full_length, CASE WHEN best_bp >= 150000 THEN best_ref END AS ref_id, CASE WHEN identity < 0.95 THEN 'B' END AS sub, identity FROM fc JOIN ev ON ev.assembly = fc.assembly AND ev.contig = fc.contig AND ev.ref_id = best_ref), k AS (SELECT *, CASE WHEN ref_id IS NULL THEN 'o' WHEN full_length THEN 'c' ELSE 'f' END AS kd, CASE WHEN sub IS NULL THEN ref_id ELSE concat(ref_id, '_', sub) END AS base FROM n), r AS (SELECT *, row_number() OVER (PARTITION BY assembly, base, kd ORDER BY identity DESC, contig_len DESC, contig) AS i, row_number() OVER (PARTITION BY assembly, kd ORDER BY contig_len DESC, contig) AS j, count(*) OVER (PARTITION BY assembly, base, kd) AS m FROM k) SELECT assembly, contig, CASE WHEN kd = 'o' THEN concat('contig_', j) WHEN kd = 'c' AND m = 1 THEN base ELSE concat(base, '_', kd, i) END AS name FROM r")
def contig_names(s, d):
    ev = evidence.pair_evidence(view(s, d, "kept")).select("assembly", "contig", F.col("ref_id").alias("best_ref"), "identity")
    df = _full(s, d).join(ev, ["assembly", "contig", "best_ref"]).select("assembly", "contig", F.when(F.col("best_bp") >= 150_000, F.col("best_ref")).alias("ref_id"), F.when(F.col("identity") < 0.95, "B").alias("subgenome"), "full_length", "identity", F.col("contig_len").alias("length"))
    return classify.names(df).select("assembly", "contig", "name")


_DP = ctes("depth", "contigs") + ", dg AS (SELECT assembly, contig, count(*) AS n, sum(depth * (end_pos - start_pos)) / sum(end_pos - start_pos) AS mean, median(depth) AS median, stddev_samp(depth) AS sd, min(depth) AS low, max(depth) AS high, sum(CASE WHEN depth >= 1 THEN end_pos - start_pos ELSE 0 END) AS b1, sum(CASE WHEN depth >= 10 THEN end_pos - start_pos ELSE 0 END) AS b10 FROM depth WHERE depth >= 0 AND start_pos >= 0 AND end_pos > start_pos GROUP BY assembly, contig), ds AS (SELECT c.assembly, c.contig, coalesce(n, 0) AS n_windows, round(coalesce(mean, 0), 4) AS mean, round(coalesce(median, 0), 4) AS median, round(coalesce(sd, 0), 4) AS sd, round(coalesce(low, 0), 4) AS low, round(coalesce(high, 0), 4) AS high, round(least(1.0, coalesce(b1, 0) / contig_len), 6) AS breadth_1, round(least(1.0, coalesce(b10, 0) / contig_len), 6) AS breadth_10 FROM contigs c LEFT JOIN dg USING (assembly, contig))"


@query(f"WITH {_DP} SELECT * FROM ds")
def depth_stats(s, d):
    return compare.depth_stats(view(s, d, "depth"), view(s, d, "contigs"))


@query(f"WITH {_CC}, {_DP.replace(ctes('depth', 'contigs'), ctes('depth'))} SELECT class, count(*) AS n, round(avg(mean), 3) AS mean, round(median(median), 3) AS median, round(avg(breadth_1), 5) AS breadth FROM cc JOIN ds USING (assembly, contig) GROUP BY class")
def depth_by_class(s, d):
    st = compare.depth_stats(view(s, d, "depth"), view(s, d, "contigs"))
    return _classes(s, d).select("assembly", "contig", "class").join(st, ["assembly", "contig"]).groupBy("class").agg(F.count("*").alias("n"), F.round(F.avg("mean"), 3).alias("mean"), F.round(F.median("median"), 3).alias("median"), F.round(F.avg("breadth_1"), 5).alias("breadth"))


_N = ctes("contigs") + ", cu AS (SELECT assembly, contig, contig_len, CAST(sum(contig_len) OVER (PARTITION BY assembly ORDER BY contig_len DESC, contig ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum, CAST(sum(contig_len) OVER (PARTITION BY assembly) AS BIGINT) AS total, row_number() OVER (PARTITION BY assembly ORDER BY contig_len DESC, contig) AS n FROM contigs)"


@query(f"WITH {_N} SELECT assembly, max(total) AS total_bp, count(*) AS n_contigs, max(CASE WHEN 2 * cum >= total THEN contig_len END) AS n50, min(CASE WHEN 2 * cum >= total THEN n END) AS l50 FROM cu GROUP BY assembly")
def n50_l50(s, d):
    return compare.n50(view(s, d, "contigs"))


@query(f"WITH {_N}, x AS (SELECT CAST(unnest(range(101)) AS INT) AS x) SELECT assembly, x, max(contig_len) AS nx FROM cu, x WHERE 100 * cum >= x * total GROUP BY assembly, x")
def nx_curve(s, d):
    return compare.nx_curve(view(s, d, "contigs"))


@query(f"WITH {_CC} SELECT assembly, count(*) AS n_contigs, CAST(sum(contig_len) AS BIGINT) AS total_bp, count(*) FILTER (WHERE class = 'chrom_assigned') AS n_chrom, CAST(coalesce(sum(contig_len) FILTER (WHERE class = 'chrom_assigned'), 0) AS BIGINT) AS chrom_bp, count(*) FILTER (WHERE class = 'unclassified') AS n_unclassified, count(*) FILTER (WHERE full_length) AS n_full_length FROM cc GROUP BY assembly")
def assembly_summary(s, d):
    return compare.summary(_classes(s, d))


@query(f"WITH {_FL}, g AS (SELECT assembly, r.ref_id FROM (SELECT DISTINCT assembly FROM fc), refs r), p AS (SELECT assembly, best_ref AS ref_id, count(*) AS n, CAST(sum(contig_len) AS BIGINT) AS bp, max(round(best_bp / ref_len, 6)) AS max_frac, bool_or(full_length) AS any_full FROM fc GROUP BY 1, 2) SELECT assembly, ref_id, coalesce(n, 0) AS n, coalesce(bp, 0) AS bp, max_frac, coalesce(any_full, FALSE) AS any_full FROM g LEFT JOIN p USING (assembly, ref_id)")
def completeness_matrix(s, d):
    df = _full(s, d).select("assembly", F.col("best_ref").alias("ref_id"), "contig_len", F.round(F.col("best_bp") / F.col("ref_len"), 6).alias("frac"), "full_length")
    return compare.completeness(df, view(s, d, "refs"))


@query(f"WITH {_CC} SELECT assembly, " + ", ".join(f"count(*) FILTER (WHERE class = '{c}') AS {c}" for c in classify.CLASSES) + " FROM cc GROUP BY assembly")
def class_pivot(s, d):
    return compare.class_pivot(_classes(s, d), classify.CLASSES)


@query(f"WITH {_CC}, g AS (SELECT assembly, class, count(*) AS n, CAST(sum(contig_len) AS BIGINT) AS bp FROM cc GROUP BY 1, 2), c AS (SELECT *, CAST(sum(bp) OVER (PARTITION BY assembly ORDER BY bp DESC, class ROWS UNBOUNDED PRECEDING) AS BIGINT) AS to_bp, sum(bp) OVER (PARTITION BY assembly) AS tt FROM g) SELECT assembly, class, n, bp, to_bp, to_bp - bp AS from_bp, round(100 * bp / tt, 4) AS pct FROM c")
def class_breakdown(s, d):
    return compare.class_breakdown(_classes(s, d))


@query(_WITH + ", g AS (SELECT assembly, contig, regexp_extract(ref_id, '^chr[0-9]+([A-Z])', 1) AS subgenome, CAST(sum(union_bp) AS BIGINT) AS bp FROM ev GROUP BY 1, 2, 3), x AS (SELECT a.assembly, a.contig, b.subgenome, coalesce(g.bp, 0) AS bp FROM (SELECT DISTINCT assembly, contig FROM g) a CROSS JOIN (SELECT DISTINCT subgenome FROM g) b LEFT JOIN g ON g.assembly = a.assembly AND g.contig = a.contig AND g.subgenome = b.subgenome) SELECT *, round(bp / sum(bp) OVER (PARTITION BY assembly, contig), 6) AS share FROM x")
def subgenome_support(s, d):
    ev = evidence.pair_evidence(view(s, d, "kept")).withColumn("subgenome", ids.subgenome(F.col("ref_id")))
    return compare.subgenome_support(ev, "ref_id", "subgenome")


_LO = ctes("blast") + ", h AS (SELECT assembly, qseqid AS contig, qstart AS s, qend AS e, CASE WHEN o_orderkey % 3 = 0 THEN '-' ELSE '+' END AS strand, pident, o_orderkey AS o, (o_orderkey * 53) % 6000 AS cs, (o_orderkey * 53) % 6000 + length * 4 AS ce FROM blast), l AS (SELECT *, sum(nw) OVER (PARTITION BY assembly, contig ORDER BY s, e, o ROWS UNBOUNDED PRECEDING) AS locus FROM (SELECT *, CASE WHEN s - lag(e) OVER (PARTITION BY assembly, contig ORDER BY s, e, o) <= 2000 THEN 0 ELSE 1 END AS nw FROM h)), v AS (SELECT assembly, contig, locus, strand, count(*) AS n, min({'s': s, 'e': e, 'o': o}) AS f, min(s) AS s, max(e) AS e, CAST(sum(pident * (e - s)) AS BIGINT) AS w, CAST(sum(e - s) AS BIGINT) AS bp FROM l GROUP BY 1, 2, 3, 4), lo AS (SELECT assembly, contig, locus, min(s) AS \"start\", max(e) AS \"end\", first(strand ORDER BY n DESC, f) AS strand, CAST(sum(n) AS BIGINT) AS n_hits, round(sum(w) / sum(bp), 6) AS identity, sum(w) AS w, sum(bp) AS bp FROM v GROUP BY 1, 2, 3)"


def _loci(s, d):
    h = view(s, d, "blast").select("assembly", F.col("qseqid").alias("contig"), F.col("qstart").alias("start"), F.col("qend").alias("end"), F.when(F.col("o_orderkey") % 3 == 0, "-").otherwise("+").alias("strand"), "pident", "o_orderkey", (F.col("o_orderkey") * 53 % 6000).alias("cs"), (F.col("o_orderkey") * 53 % 6000 + F.col("length") * 4).alias("ce"))
    return rdna.loci(h, "o_orderkey", consensus=9000, region=(1000, 6800))


def _covered(name: str, low: int, high: int) -> str:
    """Share of a part of the consensus that each locus covers."""
    k = "assembly, contig, locus"
    return f"{name}_c AS (SELECT {k}, greatest(cs, {low}) AS a, least(ce, {high}) AS z FROM l), {name} AS (SELECT {k}, sum(greatest(0, z - greatest(a, coalesce(pe, a)))) / {high - low} AS share FROM (SELECT *, max(z) OVER (PARTITION BY {k} ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM {name}_c WHERE a < z) GROUP BY {k})"


_LT = _LO + ", " + _covered("cv", 0, 9000) + ", " + _covered("rv", 1000, 6800) + ", lt AS (SELECT lo.*, coalesce(cv.share, 0) AS consensus_coverage, CASE WHEN coalesce(rv.share, 0) >= 0.9 THEN 'full' WHEN coalesce(rv.share, 0) >= 0.5 THEN 'partial' ELSE 'fragment' END AS copy_type FROM lo LEFT JOIN cv USING (assembly, contig, locus) LEFT JOIN rv USING (assembly, contig, locus))"


@query(f"WITH {_LT} SELECT assembly, contig, \"start\", \"end\", strand, n_hits, identity, round(consensus_coverage, 6) AS consensus_coverage, copy_type FROM lt")
def rdna_loci(s, d):
    return _loci(s, d).drop("locus", "identity_sum", "identity_bp").withColumn("consensus_coverage", F.round("consensus_coverage", 6))


@query(f"WITH {_LT}, a AS (SELECT *, sum(nw) OVER (PARTITION BY assembly, contig ORDER BY \"start\", \"end\" ROWS UNBOUNDED PRECEDING) AS arr FROM (SELECT *, CASE WHEN \"start\" - lag(\"end\") OVER (PARTITION BY assembly, contig ORDER BY \"start\", \"end\") <= 50000 THEN 0 ELSE 1 END AS nw FROM lt)), g AS (SELECT assembly, contig, min(\"start\") AS \"start\", last(\"end\" ORDER BY \"start\", \"end\") AS \"end\", count(*) AS n_copies, CAST(count(*) FILTER (WHERE copy_type = 'full') AS BIGINT) AS n_full, CAST(count(*) FILTER (WHERE copy_type = 'partial') AS BIGINT) AS n_partial, CAST(count(*) FILTER (WHERE copy_type = 'fragment') AS BIGINT) AS n_fragment, CASE WHEN 2 * count(*) FILTER (WHERE strand = '+') > count(*) THEN '+' WHEN 2 * count(*) FILTER (WHERE strand = '-') > count(*) THEN '-' ELSE first(strand ORDER BY \"start\", \"end\") END AS strand, round(min(w / bp), 6) AS min_identity, round(max(w / bp), 6) AS max_identity, round(median(w / bp), 6) AS median_identity FROM a GROUP BY assembly, contig, arr HAVING count(*) >= 3) SELECT *, concat('array_', row_number() OVER (PARTITION BY assembly ORDER BY contig, \"start\")) AS array_id FROM g")
def rdna_arrays(s, d):
    return rdna.arrays(_loci(s, d))


@query("WITH " + ctes("kept") + ", x AS (SELECT assembly, contig, abs(rs - qs) // 1 AS dist, abs(rs - qs) // 500 AS bin FROM kept), g AS (SELECT assembly, contig, bin, count(*) AS n, median(dist) AS m FROM x GROUP BY 1, 2, 3) SELECT assembly, contig, CAST(trunc(first(m ORDER BY n DESC, bin)) AS BIGINT) AS period, max(n) AS support FROM g GROUP BY assembly, contig")
def repeat_period(s, d):
    return rdna.repeat_period(view(s, d, "kept").select("assembly", "contig", F.abs(F.col("rs") - F.col("qs")).alias("dist")), ["assembly", "contig"], "dist")


@query("WITH " + ctes("seqs") + ", q AS (SELECT concat(assembly, ':', contig) AS contig, translate(seq, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') AS seq FROM seqs), k AS (SELECT contig, count(*) AS n_seqs FROM q GROUP BY contig), c AS (SELECT contig, unnest(range(1, length(seq) + 1)) AS pos, unnest(regexp_extract_all(seq, '(?s).')) AS base FROM q), v AS (SELECT contig, pos, base, count(*) AS n FROM c WHERE base NOT IN ('-', '.') GROUP BY 1, 2, 3), w AS (SELECT contig, pos, sum(n) AS al, first(base ORDER BY n DESC, unicode(base)) AS base FROM v GROUP BY 1, 2) SELECT contig, coalesce(string_agg(base, '' ORDER BY pos) FILTER (WHERE al >= greatest(1, floor(n_seqs * 0.5))), '') AS consensus FROM w JOIN k USING (contig) GROUP BY contig")
def column_consensus(s, d):
    return rdna.column_consensus(view(s, d, "seqs").withColumn("contig", F.concat_ws(":", "assembly", "contig")), "contig", "seq")


@query(f"WITH {_CL}, sg AS (SELECT assembly, contig, ref_id AS origin, c_start AS s, c_start + span_bp AS e FROM lc), b AS (SELECT DISTINCT assembly, contig, qs, qe, CAST(l_orderkey * 1000 + l_linenumber AS BIGINT) AS block_id FROM kept), o AS (SELECT block_id, origin, CAST(sum(least(qe, e) - greatest(qs, s)) AS BIGINT) AS bp FROM b JOIN sg ON b.assembly = sg.assembly AND b.contig = sg.contig AND qs < e AND qe > s GROUP BY 1, 2) SELECT block_id, first(origin ORDER BY bp DESC, origin DESC) AS origin, max(bp) AS bp FROM o GROUP BY block_id")
def ref_origin_split(s, d):
    k = view(s, d, "kept")
    n = intervals.tasks(k)
    seg = evidence.largest_cluster(k, n=n).select("assembly", "contig", F.col("ref_id").alias("origin"), F.col("c_start").alias("s"), (F.col("c_start") + F.col("span_bp")).alias("e"))
    blocks = k.select("assembly", "contig", "qs", "qe", (F.col("l_orderkey") * 1000 + F.col("l_linenumber")).cast("long").alias("block_id")).distinct()
    return compare.origin_split(blocks, seg, n)


@query(_WITH + ", m AS (SELECT * FROM (VALUES (0, 0.99), (1, 0.96), (2, 0.93)) t(cluster, mean)) SELECT assembly || ':' || contig || ':' || ref_id AS id, first(cluster ORDER BY abs(identity - mean), cluster) AS cluster FROM ev, m GROUP BY 1")
def nearest_mean(s, d):
    ev = evidence.pair_evidence(view(s, d, "kept")).select(F.concat_ws(":", *evidence.PAIR).alias("id"), "identity")
    means = s.createDataFrame([(0, 0.99), (1, 0.96), (2, 0.93)], "cluster int, mean double")
    return subgenome.nearest_mean(ev, means, "id", "identity")


@query()
def gmm_subgenomes(s, d):
    ev = evidence.pair_evidence(view(s, d, "kept")).join(_best(s, d).select("assembly", "contig", F.col("best_ref").alias("ref_id")), evidence.PAIR)
    return subgenome.assign(ev.select("assembly", "contig", "ref_id", ids.subgenome(F.col("ref_id")).alias("ref_subgenome"), "identity"))


_LAY = _EV + ", rr AS (SELECT k.assembly, k.contig, k.ref_id, min(rs) + max(re) AS ref_mid FROM kept k JOIN best b ON k.assembly = b.assembly AND k.contig = b.contig AND k.ref_id = b.best_ref GROUP BY 1, 2, 3), ly AS (SELECT assembly, ref_id, contig, contig_len AS length, row_number() OVER w AS part, CAST(coalesce(sum(contig_len + 100) OVER (PARTITION BY assembly, ref_id ORDER BY ref_mid, contig ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS s FROM rr JOIN contigs USING (assembly, contig) WINDOW w AS (PARTITION BY assembly, ref_id ORDER BY ref_mid, contig))"


def _layout(s, d):
    sp = evidence.ref_span(view(s, d, "kept")).join(_best(s, d).select("assembly", "contig", F.col("best_ref").alias("ref_id")), evidence.PAIR).join(view(s, d, "contigs"), ["assembly", "contig"])
    return scaffold.layout(sp.select("assembly", "ref_id", "contig", (F.col("ref_start") + F.col("ref_end")).alias("ref_mid"), F.col("contig_len").alias("length")))


@query(f"WITH {_LAY} SELECT assembly, ref_id, contig, length, part, s AS \"start\", s + length AS \"end\" FROM ly")
def scaffold_layout(s, d):
    return _layout(s, d).select("assembly", "ref_id", "contig", "length", "part", "start", "end")


@query(f"WITH {_LAY}, x AS (SELECT *, max(part) OVER (PARTITION BY assembly, ref_id) AS lp FROM ly) SELECT assembly, ref_id AS object, s + 1 AS beg, s + length AS \"end\", CAST(2 * part - 1 AS BIGINT) AS n, 'W' AS type, contig AS component, length AS size FROM x UNION ALL SELECT assembly, ref_id, s + length + 1, s + length + 100, CAST(2 * part AS BIGINT), 'N', '', CAST(100 AS BIGINT) FROM x WHERE part < lp")
def scaffold_agp(s, d):
    return scaffold.agp(_layout(s, d)).withColumn("n", F.col("n").cast("long"))


@query(_WITH + ", p AS (SELECT DISTINCT CAST(substring(assembly, 5) AS INT) AS o, best_ref AS ref_id FROM best), l AS (SELECT ref_id, lag(o) OVER (PARTITION BY ref_id ORDER BY o) AS left_ord, o AS right_ord FROM p) SELECT *, right_ord - left_ord = 1 AS adjacent FROM l WHERE left_ord IS NOT NULL")
def assembly_pairs(s, d):
    p = _best(s, d).select(F.substring("assembly", 5, 9).cast("int").alias("ord"), F.col("best_ref").alias("ref_id")).distinct()
    return compare.assembly_pairs(p)


@query(_WITH + ", " + ctes("blast") + " SELECT assembly, contig FROM contigs c WHERE NOT EXISTS (SELECT 1 FROM best x WHERE x.assembly = c.assembly AND x.contig = c.contig AND second_bp > 0.9 * best_bp) AND NOT EXISTS (SELECT 1 FROM blast x WHERE x.assembly = c.assembly AND qseqid = c.contig AND evalue_rank = 0)")
def exclusion_cascade(s, d):
    taken = _best(s, d).filter("second_bp > 0.9 * best_bp")
    hit = view(s, d, "blast").filter("evalue_rank = 0").withColumnRenamed("qseqid", "contig")
    return classify.exclude(view(s, d, "contigs").select("assembly", "contig"), taken, hit)


@query("WITH " + ctes("genes") + " SELECT ref_id, count(DISTINCT gene_id) AS n_genes FROM genes GROUP BY ref_id")
def genes_per_ref(s, d):
    return detect.gene_counts(view(s, d, "genes"))
