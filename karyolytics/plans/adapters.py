"""The driver tables seen as genomic tables: one SQL text for Spark and DuckDB.

Contigs of different assemblies have the same names, so a join that forgets the assembly gives wrong rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")

VIEWS = {
    "aln": """
SELECT concat('asm_', CAST(l_suppkey % 5 AS STRING)) AS assembly,
       concat('ctg_', CAST(CAST((l_suppkey - l_suppkey % 5) / 5 AS BIGINT) AS STRING)) AS contig,
       concat('chr', CAST(1 + (CAST((l_suppkey - l_suppkey % 5) / 5 AS BIGINT) + CASE WHEN l_linenumber <= 5 THEN 0 ELSE l_partkey % 3 END) % 5 AS STRING),
              CASE WHEN l_partkey % 2 = 0 THEN 'A' ELSE 'B' END) AS ref_id,
       CASE WHEN l_linestatus = 'O' THEN '-' ELSE '+' END AS strand,
       l_orderkey * 200 AS qs,
       l_orderkey * 200 + 2000 + CAST(l_quantity AS BIGINT) * 200 AS qe,
       CASE WHEN l_linestatus = 'O' THEN 3900000 - l_orderkey * 200 - (l_partkey % 40) * 500
            ELSE l_orderkey * 200 + (l_partkey % 40) * 500 END AS rs,
       CASE WHEN l_linestatus = 'O' THEN 3900000 - l_orderkey * 200 - (l_partkey % 40) * 500
            ELSE l_orderkey * 200 + (l_partkey % 40) * 500 END + 2000 + CAST(l_quantity AS BIGINT) * 200 AS re,
       2000 + CAST(l_quantity AS BIGINT) * 200 AS aln_len,
       (2000 + CAST(l_quantity AS BIGINT) * 200) - (20 + CAST(l_quantity AS BIGINT) * 2) * CAST(round(l_discount * 100) AS BIGINT) AS matches,
       CAST(l_quantity AS BIGINT) + 10 AS mapq,
       CASE l_returnflag WHEN 'A' THEN 'P' WHEN 'N' THEN 'I' ELSE 'S' END AS tp,
       concat('g', CAST(l_partkey % 700 AS STRING)) AS gene_id,
       l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM lineitem
""",
    "contigs": """
SELECT concat('asm_', CAST(s_suppkey % 5 AS STRING)) AS assembly, concat('ctg_', CAST(CAST((s_suppkey - s_suppkey % 5) / 5 AS BIGINT) AS STRING)) AS contig,
       3100000 + (s_suppkey * 7919 % 30) * 100000 AS contig_len
FROM supplier
""",
    "refs": """
SELECT CASE WHEN n_nationkey < 10 THEN concat('chr', CAST(1 + n_nationkey % 5 AS STRING), CASE WHEN n_nationkey < 5 THEN 'A' ELSE 'B' END)
            WHEN n_nationkey = 10 THEN 'chrC' ELSE 'chrM' END AS ref_id,
       CAST(CASE WHEN n_nationkey < 10 THEN 4200000 + n_nationkey * 50000 WHEN n_nationkey = 10 THEN 150000 ELSE 360000 END AS BIGINT) AS ref_len
FROM nation WHERE n_nationkey < 12
""",
    "blast": """
SELECT concat('asm_', CAST(o_custkey % 5 AS STRING)) AS assembly, concat('ctg_', CAST(CAST((o_custkey % 100 - o_custkey % 5) / 5 AS BIGINT) AS STRING)) AS qseqid, CASE WHEN o_orderkey % 2 = 0 THEN 'chrC' ELSE 'chrM' END AS sseqid,
       90 + o_orderkey % 10 AS pident, 100 + o_custkey % 900 AS length,
       (o_orderkey * 37) % 200000 + 1 AS qstart, (o_orderkey * 37) % 200000 + 100 + o_custkey % 900 AS qend,
       o_orderkey % 97 AS evalue_rank, o_orderkey
FROM orders
""",
    "depth": """
SELECT concat('asm_', CAST(user_id % 5 AS STRING)) AS assembly, concat('ctg_', CAST(CAST((user_id % 100 - user_id % 5) / 5 AS BIGINT) AS STRING)) AS contig, event_id * 1000 AS start_pos,
       event_id * 1000 + 1000 - (event_id % 7) * 50 AS end_pos, value AS depth, event_id
FROM events
""",
    "genes": """
SELECT concat('tx', CAST(p_partkey AS STRING)) AS transcript_id, concat('g', CAST(p_partkey % 700 AS STRING)) AS gene_id,
       concat('chr', CAST(1 + p_partkey % 5 AS STRING), CASE WHEN p_size % 2 = 0 THEN 'A' ELSE 'B' END) AS ref_id,
       p_partkey * 2000 AS start0, p_partkey * 2000 + 500 + p_size * 10 AS end0
FROM part
""",
    "taxhits": """
SELECT concat('asm_', CAST(c_custkey % 5 AS STRING)) AS assembly, concat('ctg_', CAST(CAST((c_custkey % 100 - c_custkey % 5) / 5 AS BIGINT) AS STRING)) AS contig, CAST(c_nationkey AS BIGINT) AS taxid,
       (c_custkey * 31) % 5000 AS score, (c_custkey * 17) % 1000 AS matching_bp, CAST(1000 AS BIGINT) AS read_len, c_custkey
FROM customer
""",
    "seqs": """
SELECT doc_id, concat('asm_', CAST(doc_id % 5 AS STRING)) AS assembly, concat('ctg_', CAST(CAST((doc_id % 100 - doc_id % 5) / 5 AS BIGINT) AS STRING)) AS contig,
       concat(repeat('TTTAGGG', CAST(doc_id % 6 AS INT)), translate(lower(text), 'abcdefghijklmnopqrstuvwxyz .,', 'ACGTACGTACGTACGTACGTACGTAC')) AS seq
FROM documents WHERE text IS NOT NULL
""",
}

_SMALL = "concat('asm_', CAST({0} % 5 AS STRING)) AS assembly, concat('sml_', CAST(CAST(({0} - {0} % 5) / 5 AS BIGINT) AS STRING))"
_LEN = "20000 + CAST(floor(abs(c_acctbal) * 40) AS BIGINT)"
#: Hits of small contigs, of several kinds; and contigs, alignments and hits of a whole run.
VIEWS["scan"] = f"""
SELECT *, qend - qstart AS length FROM (
    SELECT {_SMALL.format("o_custkey")} AS qseqid, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus <> 'O' THEN 'none' ELSE o_orderpriority END AS kind,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'chrC' WHEN '2-HIGH' THEN 'chrM' WHEN '3-MEDIUM' THEN '45S'
                WHEN '4-NOT SPECIFIED' THEN concat('ctg_', CAST(o_orderkey % 20 AS STRING)) ELSE concat('chr', CAST(1 + o_orderkey % 5 AS STRING), 'A') END AS sseqid,
           CAST(floor(len * ((o_orderkey * 37) % 100) / 400) AS BIGINT) AS qstart,
           least(len, CAST(floor(len * ((o_orderkey * 37) % 100) / 400) AS BIGINT) + CAST(floor(len * o_totalprice / 400000) AS BIGINT)) AS qend,
           85 + o_orderkey % 15 AS pident, o_orderkey % 97 AS evalue_rank, o_orderkey, o_orderstatus, o_totalprice, len, c_nationkey
    FROM (SELECT * FROM orders) o JOIN (SELECT c_custkey, c_nationkey, {_LEN} AS len FROM customer) c ON o_custkey = c_custkey)
WHERE qend > qstart
"""
VIEWS["run_contigs"] = f"SELECT * FROM ({VIEWS['contigs']}) UNION ALL SELECT {_SMALL.format('c_custkey')} AS contig, {_LEN} AS contig_len FROM customer"
VIEWS["run_taxhits"] = f"""
SELECT assembly, qseqid AS contig, CAST(c_nationkey AS BIGINT) AS taxid, CAST(floor(o_totalprice / 100) AS BIGINT) AS score, CAST(floor(len * o_totalprice / 600000) AS BIGINT) AS matching_bp
FROM ({VIEWS["scan"]}) WHERE o_orderstatus = 'P'
"""

#: Alignments that pass the tp and length gates.
VIEWS["kept"] = f"SELECT * FROM ({VIEWS['aln']}) WHERE tp IN ('P', 'I') AND aln_len >= 3000"
VIEWS["run_blocks"] = f"""
SELECT assembly, contig, ref_id, strand, qs, qe, rs, re, aln_len, matches, gene_id, l_orderkey, l_linenumber, l_partkey FROM ({VIEWS["kept"]})
UNION ALL
SELECT assembly, qseqid, sseqid, CASE o_orderstatus WHEN 'F' THEN '-' ELSE '+' END, qstart, qend, (o_orderkey * 131) % 3500000, (o_orderkey * 131) % 3500000 + length, length,
       CAST(floor(length * pident / 100) AS BIGINT), concat('g', CAST(o_orderkey % 700 AS STRING)), o_orderkey, CAST(0 AS INT), CAST(0 AS BIGINT)
FROM ({VIEWS["scan"]}) WHERE kind = '5-LOW'
"""


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = VIEWS[name]
    for t in TABLES:
        sql = re.sub(rf"\bFROM {t}\b", f"FROM {{{t}}}", sql)
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in sql}
    return spark.sql(sql, **used)


def ctes(*names: str) -> str:
    return ", ".join(f"{n} AS ({VIEWS[n]})" for n in names)
