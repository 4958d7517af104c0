"""Order-dependent block operators, as maps over sorted rows whose state is bounded by one stretch or one contig."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT, Config
from .intervals import dealt, islands, tasks

GROUP = ["assembly", "contig", "ref_id", "strand"]


class Chains:
    """The open chains of one stretch of blocks, which come in order. Each block goes to the chain of least penalty within the gaps.

    Blocks come by query start, so a chain that ended more than the gap before can take no other: it is closed.
    """

    def __init__(self, minus: bool, cfg: Config):
        self.minus, self.cfg, self.open, self.count, self.full = minus, cfg, [], 0, 64

    def take(self, qs: int, qe: int, rs: int, re_: int) -> int:
        """The number of the chain that the block joins or opens."""
        cfg = self.cfg
        place, diag = (-re_, rs + qs) if self.minus else (rs, rs - qs)
        if len(self.open) > self.full:
            self.open = [c for c in self.open if qs - c[0] <= cfg.chain_q_gap]
            self.full = max(64, 2 * len(self.open))
        best, to = None, None
        for c in self.open:
            dq, dr, dd = qs - c[0], place - c[1], abs(diag - c[2])
            if dq <= cfg.chain_q_gap and abs(dr) <= cfg.chain_r_gap and dd <= cfg.chain_diag_slop:
                cost = abs(dq) + abs(dr) + dd // 10
                if best is None or cost < best:
                    best, to = cost, c
        if to is None:
            self.open.append(to := [qe, place, diag, self.count])
            self.count += 1
        else:
            to[0], to[1] = max(to[0], qe), place
        return to[3]


def chain_numbers(blocks: list[tuple[int, int, int, int]], minus: bool, cfg: Config) -> list[int]:
    """The chain of each block (qs, qe, rs, re) of one stretch."""
    chains = Chains(minus, cfg)
    return [chains.take(*b) for b in blocks]


def chain_greedy(blocks: DataFrame, ties: list[str], cfg: Config = DEFAULT) -> DataFrame:
    """Adds chain_id, unique within contig, reference and strand, in order of the chains' first blocks.

    No chain crosses a gap in the query that is wider than a chain may leave open, so such gaps cut the blocks of a pair
    into islands, which are dealt to tasks: a pair with very many blocks is many tasks. Within a task blocks stream in order
    past the open chains of one island at a time; an island of one block has one chain and skips this. What comes out lies
    in as many partitions by GROUP as the blocks need, which later windows by GROUP and more keep.
    """
    n = tasks(blocks)
    order = ["qs", "qe", "rs", "re", *ties]
    cut = islands(dealt(blocks, GROUP, n), GROUP, "qs", "qe", cfg.chain_q_gap, "_island", tuple(order[2:]))
    cut = cut.withColumn("_more", F.count("*").over(W.partitionBy(*GROUP, "_island")) > 1)
    many = cut.filter("_more").drop("_more").repartition(*([n] if n > 1 else []), *GROUP, "_island").sortWithinPartitions(*GROUP, "_island", *order)
    edge = F.xxhash64(*GROUP, "_island")  # a cheap sign of where the next island begins; the island itself decides

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, chains = None, None
        for batch in batches:
            edges, strand = batch.column("_edge").to_pylist(), batch.column("strand")
            key = [batch.column(c) for c in (*GROUP, "_island")]
            numbers = []
            for i, (e, *block) in enumerate(zip(edges, *(batch.column(c).to_pylist() for c in order[:4]))):
                if i == 0 or e != edges[i - 1]:
                    here = tuple(c[i].as_py() for c in key)
                    if here != now:
                        now, chains = here, Chains(strand[i].as_py() == "-", cfg)
                numbers.append(chains.take(*block))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], [*batch.schema.names, "_chain"])

    many = many.withColumn("_edge", edge)
    numbered = many.mapInArrow(run, T.StructType([*many.schema.fields, T.StructField("_chain", T.LongType())])).drop("_edge")
    out = numbered.unionByName(cut.filter("not _more").drop("_more").withColumn("_chain", F.lit(0).cast("long")))
    number = F.dense_rank().over(W.partitionBy(*GROUP).orderBy("_island", "_chain")) - 1
    return dealt(out, GROUP, n).withColumn("chain_id", number.cast("long")).drop("_island", "_chain")


def kept_intervals(rows: list[tuple[int, int]]) -> list[bool]:
    """Of intervals in order of preference, those that overlap no kept one."""
    starts: list[int] = []
    ends: list[int] = []
    out = []
    for s, e in rows:
        i = bisect.bisect_right(starts, s)
        ok = s < e and not (i and ends[i - 1] > s) and not (i < len(starts) and starts[i] < e)
        if ok:
            starts.insert(i, s)
            ends.insert(i, e)
        out.append(ok)
    return out


def suppress_overlaps(blocks: DataFrame, ties: list[str]) -> DataFrame:
    """Per contig, blocks by falling identity that overlap no block kept before."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(_i=pdf["matches"] / pdf["aln_len"]).sort_values(["_i", *ties], ascending=[False, *([True] * len(ties))], kind="stable").drop(columns="_i")
        return pdf[kept_intervals(list(zip(pdf["qs"].tolist(), pdf["qe"].tolist())))]

    return blocks.groupBy("assembly", "contig").applyInPandas(run, blocks.schema)


def macro_blocks(chained: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """One row per chain with union, sums, identity, genes and reference range, past the chain gates."""
    keys = [*GROUP, "chain_id"]
    before = F.max("qe").over(W.partitionBy(*keys).orderBy("qs", "qe").rowsBetween(W.unboundedPreceding, -1))
    new = chained.withColumn("_before", before).withColumn("_new", F.greatest(F.lit(0), F.col("qe") - F.greatest("qs", F.coalesce("_before", "qs"))))
    out = new.groupBy(*keys).agg(F.min("qs").alias("qstart"), F.max("qe").alias("qend"), F.sum("matches").alias("matches"), F.sum("aln_len").alias("aln_len"), F.count_if(F.col("_before").isNull() | (F.col("qs") > F.col("_before"))).alias("n_segments"), F.countDistinct("gene_id").alias("gene_count"), F.min("rs").alias("ref_start"), F.max("re").alias("ref_end"), F.sum("_new").cast("long").alias("union_bp"))
    out = out.withColumn("identity", F.round(F.col("matches") / F.col("aln_len"), 6)).withColumn("qspan_bp", F.col("qend") - F.col("qstart"))
    out = out.filter((F.col("union_bp") > 0) & (F.col("union_bp") >= cfg.chain_min_bp) & (F.col("identity") >= cfg.chain_min_ident) & (F.col("matches") > 0))
    return out.withColumn("chain_id", F.row_number().over(W.partitionBy(*GROUP).orderBy("chain_id")).cast("long") - 1)  # numbers without gaps
