"""Intervals: union, islands, overlap joins. All are windows or joins on the keys; none collects a group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


#: About so many rows go to one task, whatever the size of the table.
ROWS = 200_000


def tasks(df: DataFrame) -> int:
    """How many tasks the rows of df are dealt to, which are counted; one where a single task is enough."""
    n = -(-df.count() // ROWS)
    return max(n, df.sparkSession.sparkContext.defaultParallelism) if n > 1 else 1


def dealt(df: DataFrame, keys: list[str], n: int | None = None) -> DataFrame:
    """df by keys in n partitions, as many as ``tasks`` gives where none is named.

    Windows and aggregates that follow by these keys keep the partitions. Without a number Spark makes partitions of some size in
    compressed bytes, which sorts and hash tables of narrow rows take many times of.
    """
    n = tasks(df) if n is None else n
    return df.repartition(n, *keys) if n > 1 else df


def shuffled(df: DataFrame) -> DataFrame:
    """df as a side of a join that meets the other by a shuffle, however small Spark takes it for.

    Spark sizes a table by its compressed bytes and counts no exploded rows; up to its threshold a table goes whole through the
    driver and to each executor, where its rows take many times that. Tables that do not grow (references, taxa) are left to Spark.
    """
    return df.hint("merge")


def islands(df: DataFrame, keys: list[str], start: str, end: str, gap: int = 0, name: str = "island", ties: tuple[str, ...] = ()) -> DataFrame:
    """Numbers the islands of each key: a row joins while its start is at most gap beyond the largest end so far."""
    order = W.partitionBy(*keys).orderBy(start, end, *ties)
    before = F.max(end).over(order.rowsBetween(W.unboundedPreceding, -1))
    df = df.withColumn(f"_{name}", F.when(before.isNull() | (F.col(start) > before + gap), 1).otherwise(0))
    return df.withColumn(name, F.sum(f"_{name}").over(order.rowsBetween(W.unboundedPreceding, 0))).drop(f"_{name}")


def merged(df: DataFrame, keys: list[str], start: str, end: str, gap: int = 0, n: int | None = None) -> DataFrame:
    """The islands as rows: keys, start, end, n. Rows are dealt to n tasks by keys, or left where they are with 1."""
    return islands(dealt(df, keys, n), keys, start, end, gap).groupBy(*keys, "island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n")).drop("island")


def union_bp(df: DataFrame, keys: list[str], start: str, end: str, name: str = "union_bp", n: int | None = None) -> DataFrame:
    """Covered length of each key. Rows are dealt to n tasks by keys, or left where they are with 1."""
    df = dealt(df, keys, n)
    order = W.partitionBy(*keys).orderBy(start, end).rowsBetween(W.unboundedPreceding, -1)
    new = F.greatest(F.lit(0), F.col(end) - F.greatest(F.col(start), F.coalesce(F.max(end).over(order), F.col(start))))
    return df.withColumn("_new", new).groupBy(*keys).agg(F.sum("_new").cast("long").alias(name))


def overlap_join(a: DataFrame, b: DataFrame, keys: list[str], a_range: tuple[str, str], b_range: tuple[str, str], bin_size: int = 100_000, n: int = 1) -> DataFrame:
    """Overlapping pairs on equal keys with the overlap in bp.

    Both sides are dealt into bins of positions, so a key with many intervals is spread; a pair counts in the bin of its
    first common position only. Bins are dealt to n tasks, or as Spark does with 1; neither side is broadcast.
    """
    bins = lambda s, e: F.explode(F.sequence(F.floor(F.col(s) / bin_size), F.floor((F.col(e) - 1) / bin_size)))
    x = a.filter(F.col(a_range[0]) < F.col(a_range[1])).withColumn("_bin", bins(*a_range))
    y = b.filter(F.col(b_range[0]) < F.col(b_range[1])).withColumn("_bin", bins(*b_range))
    x, y = dealt(x, [*keys, "_bin"], n), dealt(y, [*keys, "_bin"], n)
    low, high = F.greatest(a_range[0], b_range[0]), F.least(a_range[1], b_range[1])
    return x.join(shuffled(y), [*keys, "_bin"]).filter((low < high) & (F.floor(low / bin_size) == F.col("_bin"))).withColumn("overlap", high - low).drop("_bin")
