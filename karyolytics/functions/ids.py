"""Identifiers as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Names of organelle references.
CHLOROPLAST = ("chrc", "cpdna", "chloroplast", "plastid", "pt")
MITOCHONDRION = ("chrm", "mt", "mitochondrion", "mitochondria", "mitochondrial")


def normalize_ref_id(c: Column) -> Column:
    """A CHR prefix in any case becomes chr."""
    return F.regexp_replace(c, "^(?i:chr)", "chr")


def organelle_id(c: Column) -> Column:
    return F.when(F.lower(c).isin(*CHLOROPLAST), "chrC").when(F.lower(c).isin(*MITOCHONDRION), "chrM")


def bare(c: Column) -> Column:
    """Without a copy or fragment ordinal and a haplotype letter at the end."""
    return F.regexp_replace(F.regexp_replace(c, "_[fc]\\d+$", ""), "_[A-Z]$", "")


def styled(c: Column, found: Column) -> Column:
    """Names keep a capital Chr of their own; any other case becomes chr."""
    return F.when(c.startswith("Chr"), F.regexp_replace(found, "^chr", "Chr")).otherwise(found)


def chrom_id(c: Column) -> Column:
    b = bare(normalize_ref_id(c))
    nuclear = F.when(b.rlike("^chr\\d+([A-Za-z]|(?i:At|Dt))?$"), F.regexp_extract(b, "^(chr\\d+)", 1))
    return F.coalesce(styled(c, F.coalesce(organelle_id(c), nuclear)), c)


def subgenome(c: Column) -> Column:
    part = F.regexp_extract(bare(normalize_ref_id(c)), "^chr\\d+([A-Za-z]|(?i:At|Dt))$", 1)
    return F.when(organelle_id(c).isNotNull() | (part == ""), "NA").otherwise(part)


def rebuilt(chrom: Column, sub: Column) -> Column:
    return F.when(sub == "NA", chrom).otherwise(F.concat(chrom, sub))


def is_nuclear(c: Column) -> Column:
    return organelle_id(c).isNull() & bare(c).rlike("^(?i:chr)\\d+([A-Za-z]|At|Dt)?$")


def is_circular(c: Column) -> Column:
    return c.rlike("^ptg\\d+c")


def gff3_escape(c: Column) -> Column:
    for a, b in (("%", "%25"), (";", "%3B"), ("=", "%3D"), ("&", "%26"), (",", "%2C"), ("\t", "%09"), ("\n", "%0A")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def natural_key(c: Column) -> list[Column]:
    """Sort columns: chromosome number, then contig number, then name."""
    n = lambda p: F.regexp_extract(c, p, 1).try_cast("int")
    return [n("(?i)chr(\\d+)").asc_nulls_last(), n("(?i)contig_(\\d+)").asc_nulls_last(), c.asc()]


def numeric_key(c: Column) -> Column:
    """A string that sorts as the name does with its numbers taken as numbers."""
    parts = F.regexp_extract_all(c, F.lit("(\\d+|\\D+)"), 1)
    return F.array_join(F.transform(parts, lambda x: F.when(x.rlike("^\\d"), F.lpad(x, F.greatest(F.length(x), F.lit(20)), F.lit("0"))).otherwise(x)), "")


class Patterns:
    """A user's patterns for reference names, checked when they are given: the first that matches a name splits it.

    Patterns are as in Python, with a group named chrom and perhaps one named sg; case does not count. Names that none matches
    stay whole and have no subgenome. Organelles keep their own names.
    """

    def __init__(self, patterns: list[str]):
        self.java = []
        for p in patterns:
            try:
                groups = re.compile(p, re.IGNORECASE).groupindex
            except re.error as e:
                raise ValueError(f"no regular expression: {p} ({e})") from e
            if "chrom" not in groups:
                raise ValueError(f"no group named chrom: {p}")
            self.java.append(("(?i)" + p.replace("(?P<", "(?<"), groups["chrom"], groups.get("sg")))

    def _first(self, name: Column, group: int, missing: Column) -> Column:
        out = missing
        for regex, chrom, sg in reversed(self.java):
            at = (chrom, sg)[group]
            # patterns hold from the start of a name, as a match in Python does
            found = F.regexp_extract(name, f"^(?:{regex})", at) if at else F.lit("")
            out = F.when(name.rlike(f"^(?:{regex})"), F.coalesce(F.nullif(found, F.lit("")), F.lit("NA"))).otherwise(out)
        return out

    def chrom_id(self, c: Column) -> Column:
        found = self._first(bare(normalize_ref_id(c)), 0, F.lit(None).cast("string"))
        return F.coalesce(styled(c, F.coalesce(organelle_id(c), found)), c)

    def subgenome(self, c: Column) -> Column:
        return F.when(organelle_id(c).isNotNull(), "NA").otherwise(self._first(bare(normalize_ref_id(c)), 1, F.lit("NA")))


def id_map(names: DataFrame, name: str, order: str) -> DataFrame:
    """original, ref_id (normal name; organelles by kind) and whether it is the first original of its normal name, by order."""
    df = names.select(F.col(name).alias("original"), F.coalesce(organelle_id(F.col(name)), normalize_ref_id(F.col(name))).alias("ref_id"), F.col(order).alias("_order"))
    df = df.groupBy("original", "ref_id").agg(F.min("_order").alias("_order"))
    first = F.row_number().over(W.partitionBy("ref_id").orderBy("_order", "original")) == 1
    return df.select("original", "ref_id", first.alias("first"))
