"""rDNA loci, arrays, repeat period and consensus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..config import DEFAULT, Config
from .evidence import CONTIG
from .intervals import merged, union_bp


#: So few stretches of a block are handed on as they are, else their counts.
FEW = 16


def packed(n: np.ndarray) -> bytes:
    """Whole numbers from 0 in as few bytes each as the largest one takes, after a byte that tells how many."""
    size = next(s for s in (1, 2, 4, 8) if s == 8 or n.max(initial=0) < 1 << 8 * s)
    return bytes([size]) + n.astype(f"<u{size}").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1)


def copy_type(coverage: Column) -> Column:
    return F.when(coverage >= 0.9, "full").when(coverage >= 0.5, "partial").otherwise("fragment")


def chained(df: DataFrame, keys: list[str], start: str, end: str, gap: int, ties: list[str], name: str) -> DataFrame:
    """Groups by the gap to the row before, whatever ended earlier."""
    w = W.partitionBy(*keys).orderBy(start, end, *ties)
    df = df.withColumn("_new", F.coalesce((F.col(start) - F.lag(end).over(w) > gap).cast("int"), F.lit(1)))
    return df.withColumn(name, F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_new")


def loci(hits: DataFrame, tie: str, cfg: Config = DEFAULT, consensus: int | None = None, region: tuple[int, int] | None = None) -> DataFrame:
    """hits: assembly, contig, start, end, strand, pident. Majority strand, the first seen on ties; identity by length.

    With the length of the consensus, hits have cs and ce on it, and loci the share of it that they cover; with its
    transcribed region too, they have a copy type by the share of that.
    """
    df = chained(hits, CONTIG, "start", "end", cfg.locus_gap, [tie], "locus")
    length = F.col("end") - F.col("start")
    votes = df.groupBy(*CONTIG, "locus", "strand").agg(F.count("*").alias("n"), F.min(F.struct("start", "end", tie)).alias("first"), F.min("start").alias("s"), F.max("end").alias("e"), F.sum(F.col("pident") * length).alias("w"), F.sum(length).alias("bp"))
    out = votes.groupBy(*CONTIG, "locus").agg(F.min("s").alias("start"), F.max("e").alias("end"), F.min_by("strand", F.struct(-F.col("n"), "first")).alias("strand"), F.sum("n").alias("n_hits"), F.round(F.sum("w") / F.sum("bp"), 6).alias("identity"), F.sum("w").alias("identity_sum"), F.sum("bp").alias("identity_bp"))
    share = lambda a, z: union_bp(df.withColumns({"_a": F.greatest(F.col("cs"), F.lit(a)), "_z": F.least(F.col("ce"), F.lit(z))}).filter("_a < _z"), [*CONTIG, "locus"], "_a", "_z", "_bp").withColumn("_bp", F.col("_bp") / (z - a))
    if consensus:
        out = out.join(share(0, consensus).withColumnRenamed("_bp", "consensus_coverage"), [*CONTIG, "locus"], "left").fillna(0.0, ["consensus_coverage"])
    if region:
        out = out.join(share(*region), [*CONTIG, "locus"], "left").withColumn("copy_type", copy_type(F.coalesce("_bp", F.lit(0.0)))).drop("_bp")
    return out


def arrays(loci_: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Runs of loci. Identities are compared unrounded, as sums over lengths, and rounded once.

    An array has a strand by majority, the first locus' on ties, counts of copy types where loci have them, and a number
    within its assembly by contig and place.
    """
    loci_ = loci_.withColumn("identity", F.col("identity_sum") / F.col("identity_bp"))
    df = chained(loci_, CONTIG, "start", "end", cfg.array_gap, [], "array")
    kinds = [F.sum(F.col("copy_type").eqNullSafe(k).cast("long")).alias(f"n_{k}") for k in ("full", "partial", "fragment")] if "copy_type" in loci_.columns else []
    plus, minus = (F.count_if(F.col("strand") == x) for x in "+-")
    first = F.min_by("strand", F.struct("start", "end"))
    strand = F.when(plus > minus, "+").when(minus > plus, "-").otherwise(first)
    out = df.groupBy(*CONTIG, "array").agg(F.min("start").alias("start"), F.max_by("end", F.struct("start", "end")).alias("end"), F.count("*").alias("n_copies"), *kinds, strand.alias("strand"), F.round(F.min("identity"), 6).alias("min_identity"), F.round(F.max("identity"), 6).alias("max_identity"), F.round(F.median("identity"), 6).alias("median_identity"))
    number = F.row_number().over(W.partitionBy("assembly").orderBy("contig", "start"))
    return out.filter(F.col("n_copies") >= cfg.array_min_copies).withColumn("array_id", F.concat(F.lit("array_"), number)).drop("array")


def regions(hits: DataFrame, least: int, flank: int, lengths: DataFrame) -> DataFrame:
    """Merged hits of some size, with flanks clipped to the contig, merged again."""
    m = merged(hits, CONTIG, "start", "end").filter(F.col("end") - F.col("start") >= least).join(lengths, CONTIG)
    m = m.select(*CONTIG, F.greatest(F.lit(0), F.col("start") - flank).alias("start"), F.least("contig_len", F.col("end") + flank).alias("end"))
    return merged(m, CONTIG, "start", "end")


def repeat_period(distances: DataFrame, keys: list[str], distance: str, width: int = 500) -> DataFrame:
    """The median distance within the fullest histogram bin, the lowest on ties."""
    df = distances.withColumn("bin", F.floor(F.col(distance) / width))
    top = df.groupBy(*keys, "bin").agg(F.count("*").alias("n"), F.median(distance).alias("m"))
    return top.groupBy(*keys).agg(F.max_by("m", F.struct("n", -F.col("bin"))).cast("long").alias("period"), F.max("n").alias("support"))


def tiles(seqs: DataFrame, period: int) -> DataFrame:
    """Copies of the period's length; a last one of at least seven tenths counts."""
    n = F.length("seq")
    at = F.explode(F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(period)), lambda x: n - x >= 0.7 * period))
    return seqs.filter(n > 0).withColumn("at", at).withColumn("copy", F.substring(F.col("seq"), F.col("at") + 1, F.lit(period)))


def column_consensus(seqs: DataFrame, key: str, seq: str, least: float = 0.5, width: int = 4096) -> DataFrame:
    """Of each key's aligned sequences the most frequent base of each column, the least one on ties.

    Columns where fewer than the share of all sequences have a base are left out; gaps are - and ., case does not count.

    Sequences are cut into blocks of columns. Tasks count the signs of each block's columns, or hand on the stretches
    themselves where those are smaller; counts of a block meet by shuffle and are added up as they stream past, so a key
    with very many or very long sequences is many blocks, and no task holds more than one block's counts.
    """
    rows = seqs.select(F.col(key).alias("key"), F.col(seq).alias("seq")).filter("seq is not null")
    kind = seqs.schema[key].dataType

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0

        def flush() -> Iterator[pa.RecordBatch]:
            out = []
            for (k, b), parts in held.items():
                if len(parts) < FEW:
                    out += [(k, b, packed(p), None, None) for p in parts]
                else:
                    counts = Columns(width)
                    for p in parts:
                        counts.add(p)
                    counts.settle()
                    out += [(k, b, None, int(s), packed(n[: counts.used])) for s, n in counts.of.items()]
                if len(out) >= 256:
                    yield piece(out)
                    out = []
            if out:
                yield piece(out)

        def piece(out: list) -> pa.RecordBatch:
            types = (None, pa.int64(), pa.binary(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t or to_arrow_type(kind)) for i, t in enumerate(types)], ["key", "block", "part", "sign", "counts"])

        for batch in batches:
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                codes = np.frombuffer(text.as_py().encode("utf-32-le", "surrogatepass"), "<u4")
                codes = codes - 32 * ((codes >= ord("a")) & (codes <= ord("z"))).astype("<u4")
                for b in range(-(-len(codes) // width)):
                    held.setdefault((k, b), []).append(codes[b * width : (b + 1) * width])
                size += codes.nbytes
                if size > 64 << 20:
                    yield from flush()
                    held, size = {}, 0
        if held:
            yield from flush()

    def called(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts = None, Columns(width)
        for batch in batches:
            keys, out = list(zip(*(batch.column(i).to_pylist() for i in (0, 1, 5)))), []
            for at, part, sign, n in zip(keys, *(batch.column(i) for i in (2, 3, 4))):
                if at != now:
                    if now is not None:
                        out.append((*now[:2], counts.call(least, now[2])))
                    now, counts = at, Columns(width)
                if part.is_valid:
                    counts.add(unpacked(part.as_py()).astype("<u4"))
                else:
                    counts.plus(sign.as_py(), unpacked(n.as_py()).astype("<i8"))
            yield done(out)
        if now is not None:
            yield done([(*now[:2], counts.call(least, now[2]))])

    def done(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((to_arrow_type(kind), pa.int64(), pa.string()))], ["key", "block", "call"])

    def fields(*more: tuple[str, T.DataType]) -> T.StructType:
        return T.StructType([T.StructField("key", kind), T.StructField("block", T.LongType()), *(T.StructField(*m) for m in more)])

    counted = rows.mapInArrow(partial, fields(("part", T.BinaryType()), ("sign", T.LongType()), ("counts", T.BinaryType())))
    counted = counted.join(rows.groupBy("key").agg(F.count("*").alias("n_seqs")), "key")
    calls = counted.repartition("key", "block").sortWithinPartitions("key", "block").mapInArrow(called, fields(("call", T.StringType())))
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "call"))), lambda x: x["call"]), "")
    return calls.groupBy("key").agg(whole.alias("consensus")).withColumnRenamed("key", key)


class Columns:
    """Counts of signs in the columns of one block. Stretches wait until there are some, then they are counted at once."""

    def __init__(self, width: int):
        self.width, self.of, self.used, self.parts, self.size = width, {}, 0, [], 0

    def plus(self, sign: int, n: np.ndarray) -> None:
        self.used = max(self.used, len(n))
        self.of.setdefault(sign, np.zeros(self.width, np.int64))[: len(n)] += n

    def add(self, codes: np.ndarray) -> None:
        self.parts.append(codes)
        self.size += len(codes)
        if self.size > 1 << 18:
            self.settle()

    def settle(self) -> None:
        if self.size:
            codes, at = np.concatenate(self.parts), np.concatenate([np.arange(len(p)) for p in self.parts])
            top = int(codes.max()) + 1
            seen = np.flatnonzero(np.bincount(codes, minlength=top))
            rank = np.zeros(top, np.int64)
            rank[seen] = np.arange(len(seen))
            n = np.bincount(rank[codes] * self.width + at, minlength=len(seen) * self.width).reshape(len(seen), self.width)
            longest = max(map(len, self.parts))
            for sign, row in zip(seen.tolist(), n):
                self.plus(sign, row[:longest])
            self.parts, self.size = [], 0

    def call(self, least: float, n: int) -> str:
        self.settle()
        signs = np.array(sorted(self.of.keys() - {ord("-"), ord(".")}), np.uint32)
        if not len(signs):
            return ""
        counts = np.array([self.of[s][: self.used] for s in signs.tolist()])
        top = signs[counts.argmax(0)]  # the first of equal ones, so the least sign
        return top[counts.sum(0) >= max(1, int(n * least))].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def central_copy(hits: DataFrame, keys: list[str]) -> DataFrame:
    """Of each set of copies the one with the highest mean over others of the best identity. hits: keys, q, t, pident."""
    best = hits.filter("q <> t").groupBy(*keys, "q", "t").agg(F.max("pident").alias("p"))
    return best.groupBy(*keys, "q").agg(F.avg("p").alias("mean")).groupBy(*keys).agg(F.max_by("q", F.struct("mean", F.col("q"))).alias("central"))


def exemplars(copies: DataFrame, keys: list[str], clusters: DataFrame, aligned: DataFrame, hits: DataFrame, least: int = 1000) -> DataFrame:
    """Of each set of copies one sequence that stands for it: keys, seq, method, n_copies.

    copies: keys, name, seq. clusters: keys, cluster, name, representative. aligned: keys, name, seq with gaps. hits: keys, q, t,
    pident. Tables may lack sets. In this order: the only copy; the consensus of the largest cluster (the first of equal
    ones) if it has three members, all that is aligned of them, and comes out longer than least; that cluster's
    representative, or the set's first one; the most central copy; the longest.
    """
    sets = copies.groupBy(*keys).agg(F.count("*").alias("n"), F.min_by("seq", F.struct(-F.length("seq"), "name")).alias("longest"))
    size = clusters.groupBy(*keys, "cluster").agg(F.count("*").alias("members"))
    largest = size.groupBy(*keys).agg(F.max(F.struct("members", (-F.col("cluster")).alias("cluster"))).alias("x")).select(*keys, F.col("x.members").alias("members"), (-F.col("x.cluster")).alias("top"))
    inside = clusters.join(largest.filter("members >= 3"), keys).filter("cluster = top").join(aligned, [*keys, "name"])
    joined = inside.select(F.to_json(F.struct(*keys)).alias("set"), "seq")
    consensus = column_consensus(joined, "set", "seq").join(inside.select(*keys, F.to_json(F.struct(*keys)).alias("set")).distinct(), "set").select(*keys, "consensus")
    reps = clusters.filter("representative").join(largest, keys).join(copies, [*keys, "name"])
    rep = reps.groupBy(*keys).agg(F.min_by("seq", F.struct(F.col("cluster") != F.col("top"), "cluster", "name")).alias("rep"))
    central = central_copy(hits, keys).withColumnRenamed("central", "name").join(copies, [*keys, "name"]).select(*keys, F.col("seq").alias("central"))
    df = sets.join(largest.drop("top"), keys, "left").join(consensus, keys, "left").join(rep, keys, "left").join(central, keys, "left")
    first = lambda one, two, three, four, five: F.when(F.col("n") == 1, one).when(F.length("consensus") > least, two).when(F.col("rep").isNotNull(), three).when(F.col("central").isNotNull(), four).otherwise(five)
    c = F.col
    # Names of the ways.
    method = first(*map(F.lit, ("single_copy", "cdhit+mafft", "cdhit_rep", "blast_central", "longest_copy")))
    return df.select(*keys, first(c("longest"), c("consensus"), c("rep"), c("central"), c("longest")).alias("seq"), method.alias("method"), first(F.lit(1), c("members"), c("members"), c("n"), c("n")).cast("long").alias("n_copies"))


def spacers(features: DataFrame, left: str, right: str) -> DataFrame:
    """Gaps between two neighbouring named features of a contig, in either order."""
    w = W.partitionBy(*CONTIG).orderBy("start", "end", "name")
    df = features.withColumn("after", F.lead("name").over(w)).withColumn("to", F.lead("start").over(w))
    pair = ((F.col("name") == left) & (F.col("after") == right)) | ((F.col("name") == right) & (F.col("after") == left))
    return df.filter(pair & (F.col("to") > F.col("end"))).select(*CONTIG, F.col("end").alias("start"), F.col("to").alias("end"))
