"""Layout of a riparian plot: a column for each reference chromosome, a row for each assembly, stretches placed along x."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ids import numeric_key

#: Gaps between stretches of one column, and between columns.
STRETCH_GAP, COLUMN_GAP = 0.40, 0.2


def scaffold_sizes(agp: DataFrame) -> DataFrame:
    """assembly, object, rows and last position of each scaffold."""
    return agp.groupBy("assembly", "object").agg(F.count("*").alias("n_rows"), F.max("end").alias("size"))


def columns(refs: DataFrame, contigs: DataFrame, agp: DataFrame, scale: float) -> DataFrame:
    """Width and centre of each reference's column. refs: subgenome, chrom_num, ref_id, ref_len; contigs: assembly, contig,
    ref_id, contig_len; agp: rows of ``scaffold.agp_rows``.

    A column is as wide as the reference or the widest assembly: the scaffold of that name if it has several rows, else its
    contigs side by side. Columns of a subgenome stand next to each other by number.
    """
    apart = contigs.groupBy("assembly", "ref_id").agg((F.sum("contig_len") / scale + (F.count("*") - 1) * STRETCH_GAP).alias("apart"))
    joined = scaffold_sizes(agp).filter("n_rows > 1").select("assembly", F.col("object").alias("ref_id"), (F.col("size") / scale).alias("joined"))
    widest = apart.join(joined, ["assembly", "ref_id"], "full").groupBy("ref_id").agg(F.max(F.coalesce("joined", "apart")).alias("widest"))
    width = F.greatest(F.col("ref_len") / scale, "widest")
    w = W.partitionBy("subgenome").orderBy("chrom_num", "ref_id").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("width") + COLUMN_GAP).over(w), F.lit(0.0))
    return refs.join(widest, "ref_id", "left").withColumn("width", width).withColumn("x", before + F.col("width") / 2).select("subgenome", "chrom_num", "ref_id", "ref_len", "width", "x")


def stretches(columns_: DataFrame, contigs: DataFrame, agp: DataFrame, scale: float) -> DataFrame:
    """What is drawn in each row: the references (assembly null), scaffolds of several rows, and contigs that are in none.

    contigs: assembly, contig (its new name), original, ref_id, contig_len, reversed. Scaffolds of a column are the reference's
    and those named after its contigs, without copy or fragment number; they stand side by side around the column's centre, and
    so do the contigs, by natural order of names. Gives subgenome, ref_id, assembly, name, kind, size, reversed, left, right.
    """
    at = columns_.select("subgenome", "ref_id", "x")
    named = contigs.withColumn("key", numeric_key(F.col("contig")))
    base = F.regexp_replace("contig", "_[fc]\\d+$", "")
    own = named.groupBy("assembly", "ref_id", base.alias("object")).agg(F.min("key").alias("key")).filter("object <> ref_id").withColumn("place", F.lit(1))
    first = named.select("assembly", "ref_id").distinct().select("assembly", "ref_id", F.col("ref_id").alias("object"), F.lit(None).cast("string").alias("key"), F.lit(0).alias("place"))
    scaffolds = first.unionByName(own).join(scaffold_sizes(agp), ["assembly", "object"]).withColumn("span", F.when(F.col("n_rows") > 1, F.col("size") / scale).otherwise(0.0))
    scaffolds = side_by_side(scaffolds.join(at, "ref_id"), ["place", "key", "object"]).filter("n_rows > 1")
    inside = agp.filter("type = 'W'").join(scaffolds.select("assembly", "object"), ["assembly", "object"], "left_semi").select("assembly", F.col("component").alias("original"))
    rest = named.join(inside, ["assembly", "original"], "left_anti").withColumn("span", F.col("contig_len") / scale)
    rest = side_by_side(rest.join(at, "ref_id"), ["key", "contig"])
    show = lambda df, name, kind, size, back: df.select("subgenome", "ref_id", "assembly", F.col(name).alias("name"), F.lit(kind).alias("kind"), F.col(size).alias("size"), back.alias("reversed"), "left", "right")
    half = F.col("ref_len") / scale / 2
    refs = columns_.withColumns({"assembly": F.lit(None).cast("string"), "left": F.col("x") - half, "right": F.col("x") + half, "name": F.col("ref_id")})
    return show(refs, "name", "reference", "ref_len", F.lit(False)).unionByName(show(scaffolds, "object", "scaffold", "size", F.lit(False))).unionByName(show(rest, "contig", "contig", "contig_len", F.col("reversed")))


def side_by_side(df: DataFrame, order: list[str]) -> DataFrame:
    """Adds left and right of stretches of width span, in their order and with gaps, centred on x."""
    of = W.partitionBy("assembly", "ref_id")
    total = F.sum("span").over(of) + (F.count("*").over(of) - 1) * STRETCH_GAP
    before = F.coalesce(F.sum(F.col("span") + STRETCH_GAP).over(of.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    df = df.withColumn("left", F.col("x") - total / 2 + before)
    return df.withColumn("right", F.col("left") + F.col("span"))


def joins(placed: DataFrame, agp: DataFrame) -> DataFrame:
    """Where the gaps of drawn scaffolds are: assembly, name, x."""
    gaps = agp.filter("type in ('N', 'U')").select("assembly", F.col("object").alias("name"), ((F.col("beg") + F.col("end")) / 2).alias("mid"))
    df = gaps.join(placed.filter("kind = 'scaffold'"), ["assembly", "name"])
    return df.select("assembly", "name", (F.col("left") + F.col("mid") / F.col("size") * (F.col("right") - F.col("left"))).alias("x"))


def projected(features: DataFrame, placed: DataFrame) -> DataFrame:
    """Features in coordinates of what is drawn, as x. features: assembly, name, start, end and others, as ``scaffold.lift`` gives them."""
    df = features.join(placed.select("assembly", "name", "left", "right", "size"), ["assembly", "name"])
    to = lambda c: F.col("left") + F.col(c) / F.col("size") * (F.col("right") - F.col("left"))
    return df.select(*features.columns, to("start").alias("x_start"), to("end").alias("x_end"))
