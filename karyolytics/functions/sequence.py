"""Sequences as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: IUPAC codes and their complements.
CODES, COMPLEMENTS = "ACGTRYSWKMBDHVNacgtryswkmbdhvn", "TGCAYRSWMKVHDBNtgcayrswmkvhdbn"


def reverse_complement(c: Column) -> Column:
    return F.reverse(F.translate(c, CODES, COMPLEMENTS))


def base_count(c: Column, bases: str) -> Column:
    return F.length(c) - F.length(F.translate(c, bases + bases.lower(), ""))


def gc_content(c: Column) -> Column:
    """(G+C)/(A+C+G+T), 0 without bases."""
    return F.coalesce(base_count(c, "GC") / F.nullif(base_count(c, "ACGT"), F.lit(0)), F.lit(0.0))


def gc_deviation(gc: Column, mean: Column, sd: Column) -> Column:
    return F.when(sd >= 0.001, F.abs(gc - mean) / sd)


def longest_run(window: Column, motif: str, least: int) -> Column:
    """Repeats in the longest tandem run, 0 if under the least."""
    runs = F.regexp_extract_all(window, F.lit(f"((?:{motif}){{{least},}})"), 1)
    return F.coalesce(F.array_max(F.transform(runs, lambda r: F.length(r) / len(motif))), F.lit(0)).cast("long")


def telomere_repeats(seq: Column, motif: str, window: int, least: int) -> tuple[Column, Column]:
    """Longest runs of the motif or its reverse complement in both end windows."""
    rc = motif.translate(str.maketrans(CODES, COMPLEMENTS))[::-1]
    w = F.least(F.lit(window), F.floor(F.length(seq) / 2)).cast("int")
    left, right = F.substring(seq, F.lit(1), w), F.right(seq, w)
    either = lambda x: F.greatest(longest_run(x, motif, least), longest_run(x, rc, least))
    return either(left), either(right)


def wrap(c: Column, width: int = 80) -> Column:
    return F.regexp_replace(c, f"(.{{{width}}})(?=.)", "$1\n")
