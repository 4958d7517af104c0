"""Queries over report operators, each with SQL of its own. They join the catalog's queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ids
from ..operators import chaining, evidence, rearrange, report, run, taxonomy
from .adapters import ctes, view
from .catalog import _CHAINS, _EV, _P, _WITH, _best, _chained, query

_CHROM = "concat('chr', regexp_extract(ref_id, '^chr([0-9]+)', 1))"
_SUB = "regexp_extract(ref_id, '^chr[0-9]+([A-Z])', 1)"


def _evidence(s, d):
    return evidence.pair_evidence(view(s, d, "kept"))


@query("WITH " + ctes("refs") + " SELECT coalesce(CAST(floor(min(ref_len) FILTER (WHERE regexp_matches(ref_id, '^chr[0-9]+[A-Z]?$') AND ref_len > 0) * 0.25) AS BIGINT), 100000) AS min_length FROM refs")
def default_min_length(s, d):
    return report.default_min_length(view(s, d, "refs"))


@query(_WITH + ", m AS (SELECT CAST(floor(min(ref_len) * 0.25) AS BIGINT) AS least FROM refs WHERE ref_id NOT IN ('chrC', 'chrM')) SELECT c.assembly, c.contig, coalesce(total_bp, 0) < least AS low_coverage FROM contigs c LEFT JOIN tot t USING (assembly, contig), m")
def low_coverage(s, d):
    return report.low_coverage(evidence.contig_totals(_evidence(s, d)), view(s, d, "contigs").select("assembly", "contig"), report.default_min_length(view(s, d, "refs")))


@query(f"WITH RECURSIVE {_CHAINS} SELECT {_P}, union_bp AS qbp, identity, matches AS weight FROM (SELECT *, row_number() OVER (PARTITION BY {_P} ORDER BY matches DESC, chain_id, strand) AS r FROM mb) WHERE r = 1")
def best_chain(s, d):
    return report.best_chain(chaining.macro_blocks(_chained(s, d)).select(*evidence.PAIR, F.struct("chain_id", "strand").alias("chain_id"), F.col("matches").alias("weight"), F.col("union_bp").alias("qbp"), "identity"))


_PROT = "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN concat('tx', CAST(p_partkey AS STRING)) WHEN 1 THEN concat('tx', CAST(p_partkey AS STRING), ' protein 1') WHEN 2 THEN concat('tx', CAST(p_partkey AS STRING), '|p1') ELSE concat('none', CAST(p_partkey AS STRING)) END AS raw FROM part"


@query("WITH " + ctes("genes") + f", q AS ({_PROT}) SELECT raw, coalesce(a.gene_id, b.gene_id, c.gene_id) AS gene_id, coalesce(a.start0, b.start0, c.start0) AS start0 FROM q LEFT JOIN genes a ON a.transcript_id = raw LEFT JOIN genes b ON b.transcript_id = split_part(raw, ' ', 1) LEFT JOIN genes c ON c.transcript_id = split_part(raw, '|', 1) WHERE coalesce(a.gene_id, b.gene_id, c.gene_id) IS NOT NULL")
def transcript_lookup(s, d):
    raw = s.sql(_PROT.replace("FROM part", "FROM {part}"), part=s.read.parquet(f"{d}/part.parquet")).select("raw")
    return report.first_match(raw, "raw", view(s, d, "genes").select("transcript_id", "gene_id", "start0"), "transcript_id")


@query("WITH " + ctes("kept") + " SELECT ref_id AS q, abs(rs - qs) AS distance FROM kept WHERE abs(rs - qs) BETWEEN 1000 AND 9000 AND l_partkey % 3 > 0")
def off_diagonal(s, d):
    t = F.when(F.col("l_partkey") % 3 > 0, F.col("ref_id")).otherwise("other")
    return report.off_diagonal(view(s, d, "kept").select(F.col("ref_id").alias("q"), t.alias("t"), "qs", F.col("rs").alias("ts")), high=9000)


@query("WITH " + ctes("blast", "contigs") + ", nw AS (SELECT assembly, qseqid, greatest(0, qend - greatest(qstart, coalesce(max(qend) OVER (PARTITION BY assembly, qseqid ORDER BY qstart, qend ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), qstart))) AS nb FROM blast), g AS (SELECT assembly, qseqid AS contig, sum(nb) * 40 AS bp FROM nw GROUP BY 1, 2) SELECT assembly, contig, round(bp / contig_len, 6) AS coverage, bp / contig_len >= 0.5 AS rdna FROM g JOIN contigs USING (assembly, contig) WHERE contig_len <= 5500000")
def rdna_reclassified(s, d):
    loci = view(s, d, "blast").select("assembly", F.col("qseqid").alias("contig"), (F.col("qstart") * 40).alias("start"), (F.col("qend") * 40).alias("end"))
    c = view(s, d, "contigs")
    return report.rdna_reclassified(loci, c, c.filter("contig_len > 5500000"))


@query(_WITH + ", x AS (SELECT ref_id, avg(matches / aln_len) AS m, stddev_samp(matches / aln_len) AS sd FROM ev GROUP BY 1) SELECT ref_id, round(m, 6) AS mean, round(sd, 6) AS sd, round(greatest(0, m - sd), 6) AS low, round(least(1, m + sd), 6) AS high FROM x")
def identity_bands(s, d):
    return report.identity_bands(_evidence(s, d).withColumn("identity", F.col("matches") / F.col("aln_len")), "ref_id", "identity")


_RIB = "SELECT assembly, contig, ref_id, strand, qs AS l_start, qe AS l_end, rs AS r_start, re AS r_end, aln_len AS bp, matches / aln_len AS identity, row_number() OVER (PARTITION BY assembly, contig ORDER BY qs, qe, l_orderkey, l_linenumber, l_partkey, l_suppkey, ref_id) AS o FROM kept"


@query("WITH " + ctes("kept") + f", x AS ({_RIB}), f AS (SELECT *, CASE WHEN lag(ref_id) OVER w = ref_id AND lag(strand) OVER w = strand THEN 0 ELSE 1 END AS nw FROM x WINDOW w AS (PARTITION BY assembly, contig ORDER BY o)), g AS (SELECT *, CAST(sum(nw) OVER (PARTITION BY assembly, contig ORDER BY o ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM f) SELECT assembly, contig, run, ref_id, strand, min(l_start) AS l_start, max(l_end) AS l_end, min(r_start) AS r_start, max(r_end) AS r_end, CAST(sum(bp) AS BIGINT) AS bp, round(median(identity), 6) AS identity, count(*) AS n_blocks FROM g GROUP BY 1, 2, 3, 4, 5")
def merged_ribbons(s, d):
    return report.merged_ribbons(s.sql(_RIB.replace("FROM kept", "FROM {kept}"), kept=view(s, d, "kept")), ["assembly", "contig"], "o", ["ref_id", "strand"])


_SL = f", sl AS (SELECT assembly, {_CHROM} AS chrom_id, {_SUB} AS subgenome, contig, contig_len FROM (SELECT assembly, contig, best_ref AS ref_id FROM best) JOIN contigs USING (assembly, contig))"


def _slots(s, d):
    b = _best(s, d).join(view(s, d, "contigs"), ["assembly", "contig"])
    return b.select("assembly", ids.chrom_id(F.col("best_ref")).alias("chrom_id"), ids.subgenome(F.col("best_ref")).alias("subgenome"), "contig", "contig_len")


@query(_WITH + _SL + " SELECT *, count(*) OVER (PARTITION BY assembly, chrom_id) AS n_in_bin, row_number() OVER w AS slot, row_number() OVER w - (count(*) OVER (PARTITION BY assembly, chrom_id) + 1) / 2 AS y_offset FROM sl WINDOW w AS (PARTITION BY assembly, chrom_id ORDER BY subgenome, contig_len DESC, contig)")
def slot_layout(s, d):
    return report.slots(_slots(s, d)).withColumn("slot", F.col("slot").cast("long"))


@query(_WITH + _SL + f", p AS (SELECT DISTINCT assembly, chrom_id, subgenome FROM sl), r AS (SELECT {_CHROM} AS chrom_id, {_SUB} AS subgenome, ref_len FROM refs) SELECT assembly, chrom_id, subgenome, ref_len, count(*) OVER (PARTITION BY assembly, chrom_id) AS n_sg, row_number() OVER (PARTITION BY assembly, chrom_id ORDER BY subgenome) AS sg_idx FROM p JOIN r USING (chrom_id, subgenome)")
def reference_lines(s, d):
    refs = view(s, d, "refs").select(ids.chrom_id(F.col("ref_id")).alias("chrom_id"), ids.subgenome(F.col("ref_id")).alias("subgenome"), "ref_len")
    return report.reference_lines(_slots(s, d), refs).withColumn("sg_idx", F.col("sg_idx").cast("long"))


@query(_WITH + _SL + f", b AS (SELECT k.assembly, k.contig, {_CHROM} AS target_chrom, chrom_id, CASE WHEN contig_len % 200000 = 0 THEN contig_len - qe ELSE qs END AS a, CASE WHEN contig_len % 200000 = 0 THEN contig_len - qs ELSE qe END AS z, contig_len FROM kept k JOIN sl USING (assembly, contig)), c AS (SELECT assembly, contig, target_chrom <> chrom_id AS off_target, greatest(0, least(a, contig_len)) AS xmin, greatest(0, least(z, contig_len)) AS xmax FROM b) SELECT * FROM c WHERE xmax > xmin")
def prepared_blocks(s, d):
    placed = _slots(s, d).select("assembly", "contig", "chrom_id", "contig_len", (F.col("contig_len") % 200000 == 0).alias("is_reversed"))
    k = view(s, d, "kept").select("assembly", "contig", ids.chrom_id(F.col("ref_id")).alias("target_chrom"), "qs", "qe")
    return report.prepared_blocks(k, placed).select("assembly", "contig", "off_target", "xmin", "xmax")


@query(_WITH + f", o AS (SELECT DISTINCT assembly, row_number() OVER (ORDER BY assembly DESC) AS ord FROM (SELECT DISTINCT assembly FROM contigs)), h AS (SELECT DISTINCT {_SUB.replace('ref_id', 'best_ref')} AS subgenome, assembly FROM best) SELECT subgenome, assembly, row_number() OVER (PARTITION BY subgenome ORDER BY ord) AS place FROM h JOIN o USING (assembly)")
def assemblies_per_subgenome(s, d):
    refs = view(s, d, "refs").select("ref_id", ids.subgenome(F.col("ref_id")).alias("subgenome"))
    order = view(s, d, "contigs").select("assembly").distinct().select("assembly", (-F.substring("assembly", 5, 9).cast("long")).alias("ord"))
    return report.assemblies_per_subgenome(_best(s, d).select("assembly", F.col("best_ref").alias("ref_id")), refs, order).withColumn("place", F.col("place").cast("long"))


@query(_WITH + ", x AS (SELECT assembly, best_ref AS ref_id, contig, contig_len, row_number() OVER (PARTITION BY assembly ORDER BY contig_len DESC, contig) AS rank FROM best JOIN contigs USING (assembly, contig)) SELECT * FROM x WHERE rank <= 50")
def longest_debris(s, d):
    b = _best(s, d).join(view(s, d, "contigs"), ["assembly", "contig"]).select("assembly", F.col("best_ref").alias("ref_id"), "contig", "contig_len")
    return report.top_by_length(b, ["assembly"]).withColumn("rank", F.col("rank").cast("long"))


_CELL = ", ce AS (SELECT b.assembly, b.best_ref AS ref_id, contig_len, best_bp / ref_len AS coverage, best_bp >= 0.3 * ref_len AS full_length, contig_len % 300000 = 0 AS telo5, contig_len % 200000 = 0 AS telo3, matches / aln_len AS identity FROM best b JOIN contigs c USING (assembly, contig) JOIN refs r ON r.ref_id = best_ref JOIN ev e ON e.assembly = b.assembly AND e.contig = b.contig AND e.ref_id = best_ref)"


def _cells(s, d):
    b = _best(s, d).withColumnRenamed("best_ref", "ref_id").join(view(s, d, "contigs"), ["assembly", "contig"]).join(view(s, d, "refs"), "ref_id").join(_evidence(s, d).select(*evidence.PAIR, (F.col("matches") / F.col("aln_len")).alias("identity")), evidence.PAIR)
    n = F.col("contig_len")
    return b.select("assembly", "contig", "ref_id", "contig_len", (F.col("best_bp") / F.col("ref_len")).alias("coverage"), (F.col("best_bp") >= 0.3 * F.col("ref_len")).alias("full_length"), (n % 300000 == 0).alias("telo5"), (n % 200000 == 0).alias("telo3"), "identity")


@query(_WITH + _CELL + ", gr AS (SELECT assembly, r.ref_id, r.ref_len FROM (SELECT DISTINCT assembly FROM ce), refs r), g AS (SELECT assembly, ref_id, count(*) AS n, CAST(sum(contig_len) AS BIGINT) AS bp, max(coverage) AS best, bool_or(full_length) AS fl, bool_or(telo5 AND telo3) AS bt, bool_or(telo5) AS t5, bool_or(telo3) AS t3, avg(identity) AS mi FROM ce GROUP BY 1, 2) SELECT assembly, ref_id, ref_len, coalesce(n, 0) AS n_contigs, coalesce(bp, 0) AS assigned_bp, round(best, 6) AS best_coverage, coalesce(fl, FALSE) AS is_full_length, coalesce(bt, FALSE) AS has_both_telomeres, round(mi, 6) AS mean_identity, CASE WHEN n IS NULL THEN 'unassigned' WHEN NOT fl THEN 'incomplete' WHEN t5 AND t3 THEN 'telo_both' WHEN t5 THEN 'telo_5p' WHEN t3 THEN 'telo_3p' ELSE 'full_length' END AS status FROM gr LEFT JOIN g USING (assembly, ref_id)")
def completeness_cells(s, d):
    return report.completeness_cells(_cells(s, d), view(s, d, "refs"))


_FISS = _EV + ", rr AS (SELECT k.assembly, k.contig, k.ref_id, min(rs) AS a, max(re) AS z FROM kept k JOIN best b ON k.assembly = b.assembly AND k.contig = b.contig AND k.ref_id = b.best_ref GROUP BY 1, 2, 3), nn AS (SELECT rr.*, ref_len, contig_len, greatest(0, z - greatest(a, coalesce(max(z) OVER (PARTITION BY assembly, rr.ref_id ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), a))) AS nb FROM rr JOIN refs USING (ref_id) JOIN contigs USING (assembly, contig)), gg AS (SELECT assembly, ref_id, count(*) AS n, round(sum(nb) / max(ref_len), 6) AS cov, round(sum(nb) / max(ref_len), 6) * max(ref_len) AS covered, max((z - a) / ref_len) AS top FROM nn GROUP BY 1, 2)"


@query(f"WITH {_FISS} SELECT assembly, contig, ref_id, 'fission' AS kind, CAST(NULL AS VARCHAR) AS partner, CAST(0 AS BIGINT) AS q_start, contig_len AS q_end, a AS r_start, z AS r_end, z - a AS span, CASE WHEN covered > 1000000 AND cov > 0.8 THEN 'high' WHEN covered > 1000000 THEN 'medium' WHEN covered >= 50000 AND cov > 0.8 THEN 'medium' ELSE 'low' END AS confidence FROM nn JOIN gg USING (assembly, ref_id) WHERE n >= 2 AND cov >= 0.5 AND top <= 0.9")
def fission_calls(s, d):
    return rearrange.fission_calls(evidence.ref_span(view(s, d, "kept")), _best(s, d), view(s, d, "contigs"), view(s, d, "refs"))


_FUS = _EV + ", bg AS (SELECT e.*, best_ref FROM ev e JOIN contigs c USING (assembly, contig) JOIN best b USING (assembly, contig) WHERE union_bp * 10 >= 0.3 * contig_len)"


@query(f"WITH {_FUS} SELECT a.assembly, a.contig, a.best_ref AS ref_id, 'fusion' AS kind, CASE WHEN a.ref_id = a.best_ref THEN b.ref_id WHEN b.ref_id = a.best_ref THEN a.ref_id WHEN a.union_bp >= b.union_bp THEN b.ref_id ELSE a.ref_id END AS partner, least(a.q_min, b.q_min) AS q_start, greatest(a.q_max, b.q_max) AS q_end, CAST(0 AS BIGINT) AS r_start, CAST(0 AS BIGINT) AS r_end, a.union_bp + b.union_bp AS span, CASE WHEN a.union_bp + b.union_bp >= 50000 THEN CASE WHEN a.union_bp + b.union_bp > 1000000 THEN 'high' ELSE 'medium' END ELSE 'low' END AS confidence FROM bg a JOIN bg b ON a.assembly = b.assembly AND a.contig = b.contig AND (a.q_min, a.ref_id) < (b.q_min, b.ref_id)")
def fusion_calls(s, d):
    from ..config import Config

    return rearrange.fusion_calls(_evidence(s, d), _best(s, d), view(s, d, "contigs"), Config(fusion_frac=0.03))


@query()
def rearrangements(s, d):
    k = view(s, d, "kept")
    return rearrange.rearrangements(k, _evidence(s, d), _best(s, d), evidence.ref_span(k), view(s, d, "contigs"), view(s, d, "refs"))


#: Taxa from the nations: species under genera, families, an order and clades of domains. Species 20 and up have no node.
_NODES = """
SELECT CAST(n_nationkey AS BIGINT) AS taxid, CAST(100 + n_nationkey % 7 AS BIGINT) AS parent, 'species' AS rank, concat('Genus', CAST(n_nationkey % 7 AS STRING), ' ', lower(n_name)) AS name FROM nation WHERE n_nationkey < 20
UNION ALL SELECT DISTINCT CAST(100 + n_nationkey % 7 AS BIGINT), CAST(200 + n_nationkey % 7 % 3 AS BIGINT), 'genus', concat('Genus', CAST(n_nationkey % 7 AS STRING)) FROM nation
UNION ALL SELECT DISTINCT CAST(200 + n_nationkey % 3 AS BIGINT), CAST(300 + n_nationkey % 3 AS BIGINT), 'family', concat('Family', CAST(n_nationkey % 3 AS STRING)) FROM nation
UNION ALL SELECT DISTINCT CAST(300 + n_nationkey % 3 AS BIGINT), CAST(CASE n_nationkey % 3 WHEN 2 THEN 500 ELSE 400 + n_nationkey % 3 END AS BIGINT), 'no rank', 'x' FROM nation
UNION ALL SELECT DISTINCT CAST(400 + n_regionkey % 2 AS BIGINT), CAST(501 AS BIGINT), 'kingdom', CASE n_regionkey % 2 WHEN 0 THEN 'Viridiplantae' ELSE 'Apusozoa' END FROM nation
UNION ALL SELECT DISTINCT CAST(500 + n_regionkey % 2 AS BIGINT), CAST(999 AS BIGINT), 'domain', CASE n_regionkey % 2 WHEN 0 THEN 'Bacteria' ELSE 'Eukaryota' END FROM nation
UNION ALL SELECT CAST(999 AS BIGINT), CAST(999 AS BIGINT), 'no rank', 'root' FROM nation WHERE n_nationkey = 0"""
_TAXA = "SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS taxid, CASE WHEN c_nationkey = 24 THEN '' ELSE concat(CASE WHEN c_custkey % 2 = 0 THEN 's__' ELSE '' END, 'Genus', CAST(CASE WHEN c_nationkey = 23 THEN 77 ELSE c_nationkey % 7 END AS STRING), CASE WHEN c_custkey % 5 = 0 THEN ' sp. nov' ELSE ' alba' END) END AS name FROM customer"


@query(f"WITH RECURSIVE nodes AS ({_NODES}), hits AS ({_TAXA}), cl AS (SELECT *, trim(regexp_replace(trim(name), '^[a-z]__', '')) AS bare FROM hits), gn AS (SELECT name AS g, min(taxid) AS gt FROM nodes WHERE rank = 'genus' GROUP BY name), st AS (SELECT cl.*, n.taxid IS NOT NULL AS own, CASE WHEN n.taxid IS NOT NULL THEN n.taxid ELSE gt END AS start FROM cl LEFT JOIN nodes n USING (taxid) LEFT JOIN gn ON g = split_part(bare, ' ', 1)), w AS (SELECT DISTINCT start FROM st WHERE start IS NOT NULL), up AS (SELECT start, taxid, parent, rank, name FROM w JOIN nodes ON taxid = start UNION ALL SELECT start, n.taxid, n.parent, n.rank, n.name FROM up JOIN nodes n ON n.taxid = up.parent WHERE up.parent <> up.taxid), l AS (SELECT start, max(CASE rank WHEN 'domain' THEN name END) AS d, max(CASE rank WHEN 'kingdom' THEN name END) AS k, max(CASE rank WHEN 'family' THEN name END) AS family, max(CASE rank WHEN 'genus' THEN name END) AS genus, max(CASE rank WHEN 'species' THEN name END) AS species FROM up GROUP BY start) SELECT c_custkey, taxid, CASE WHEN d = 'Eukaryota' AND k = 'Viridiplantae' THEN 'Plantae' WHEN d = 'Eukaryota' AND k IS NOT NULL THEN 'Protozoa' ELSE d END AS kingdom, family, genus, CASE WHEN own THEN species ELSE nullif(bare, '') END AS species, CASE WHEN own THEN 'taxid' WHEN genus IS NOT NULL THEN 'genus' ELSE 'none' END AS found_by FROM st LEFT JOIN l USING (start)")
def lineage_fallback(s, d):
    nation, customer = (s.read.parquet(f"{d}/{t}.parquet") for t in ("nation", "customer"))
    nodes = run.written(s.sql(_NODES.replace("FROM nation", "FROM {nation}"), nation=nation), "nodes")
    hits = s.sql(_TAXA.replace("FROM customer", "FROM {customer}"), customer=customer)
    return taxonomy.with_fallback(hits, nodes).select("c_custkey", "taxid", "kingdom", "family", "genus", "species", "found_by")
