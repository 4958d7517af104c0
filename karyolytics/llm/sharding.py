"""Shards by best-fit-decreasing bin packing of indivisible groups.

Rows with equal texts are one group and stay together. Groups larger than a fixed part of a shard are items of their own;
all others are dealt by a hash of their digest into a fixed number of bundles, which are items too. So the driver packs at
most ``large_items + bundles`` items however large the table is. Items go in order of size, each into the bin with the
least remaining capacity that still holds it; a balanced search tree over (remaining, bin) finds that bin. The capacity
starts at the mean and rises by the smallest step until all items fit, which leaves sizes as near as the groups allow.

Cases: null and empty texts have size 1 and are one group; a group larger than the mean has a shard to itself as far as
possible; an empty table gives an empty result; null identifiers are kept and sort first within their shard.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch

LARGE_ITEMS = 4096
BUNDLES = 8192
#: Ranks within a shard are counted in so many parts.
PARTS = 256


class CapacityTree:
    """A B-tree of (remaining, bin) of fixed fan-out: a sorted list of small sorted blocks, split when full."""

    def __init__(self, entries=(), block: int = 64):
        self.block, self.blocks = block, []
        for x in entries:
            self.add(x)

    def _at(self, x) -> int:
        return min(bisect.bisect_left([b[-1] for b in self.blocks], x), len(self.blocks) - 1)

    def add(self, x) -> None:
        if not self.blocks:
            self.blocks.append([x])
            return
        i = self._at(x)
        bisect.insort(self.blocks[i], x)
        if len(b := self.blocks[i]) > self.block:
            self.blocks[i : i + 1] = [b[: len(b) // 2], b[len(b) // 2 :]]

    def remove(self, x) -> None:
        i = self._at(x)
        b = self.blocks[i]
        del b[bisect.bisect_left(b, x)]
        if not b:
            del self.blocks[i]

    def tightest(self, size: int):
        """The entry with the least remaining capacity that is no smaller than size, or None."""
        if not self.blocks or self.blocks[-1][-1] < (size, -1):
            return None
        b = self.blocks[self._at((size, -1))]
        return b[bisect.bisect_left(b, (size, -1))]


def best_fit_decreasing(sizes: list[int], bins: int, capacity: int) -> list[int] | None:
    """The bin of each item, or None if they don't fit into so many bins of this capacity."""
    tree, out = CapacityTree([(capacity, b) for b in range(bins)]), [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        got = tree.tightest(sizes[i])
        if got is None:
            return None
        tree.remove(got)
        tree.add((got[0] - sizes[i], got[1]))
        out[i] = got[1]
    return out


def fewest_bins(sizes: list[int], capacity: int) -> list[int]:
    """Fixed capacity, as few bins as best-fit-decreasing finds; larger items have a bin of their own."""
    tree, out, n = CapacityTree(), [0] * len(sizes), 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        got = tree.tightest(sizes[i]) if sizes[i] <= capacity else None
        if got is None:
            got, n = (max(capacity, sizes[i]), n), n + 1
        else:
            tree.remove(got)
        tree.add((got[0] - sizes[i], got[1]))
        out[i] = got[1]
    return out


def pack(sizes: list[int], bins: int) -> list[int]:
    """Least capacity, to a thousandth of a percent of the mean, at which best-fit-decreasing fits the items into the bins."""
    total = sum(sizes)
    low = max(-(-total // bins), max(sizes, default=0), 1)
    if (got := best_fit_decreasing(sizes, bins, low)) is not None:
        return got
    high, got = low, None
    while got is None:
        high += max(1, high // 100)
        got = best_fit_decreasing(sizes, bins, high)
    while high - low > max(1, total // bins // 100_000):
        mid = (low + high) // 2
        if (x := best_fit_decreasing(sizes, bins, mid)) is None:
            low = mid
        else:
            high, got = mid, x
    return got


def shard(spark: SparkSession, docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text", large_items: int = LARGE_ITEMS, bundles: int = BUNDLES) -> DataFrame:
    """Per row: id, size, crc, shard, slot; slots of a shard run from 0 without gaps."""
    scratch = Scratch(spark, "sharding")
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), (F.octet_length(t) + 1).cast("long").alias("size"), F.crc32(t.cast("binary")).cast("long").alias("crc"), F.unhex(F.md5(t.cast("binary"))).alias("digest"))
    rows = scratch.table(rows.withColumn("uid", F.monotonically_increasing_id()), "rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"))
    floor = max(1, total // large_items)
    large = groups.filter(F.col("bytes") > floor)
    bundle = F.pmod(F.xxhash64("digest"), F.lit(bundles)).cast("int")
    # at most large_items groups exceed the floor, and at most `bundles` bundles exist
    big = [(bytes(r[0]), r[1]) for r in large.orderBy("digest").collect()]
    small = groups.join(F.broadcast(large.select("digest")), "digest", "left_anti").groupBy(bundle.alias("bundle")).agg(F.sum("bytes").alias("bytes")).orderBy("bundle").collect()
    bins = pack([b for _, b in big] + [r["bytes"] for r in small], shards)
    of_big = spark.createDataFrame([(bytearray(d), s) for (d, _), s in zip(big, bins)], "digest binary, big_shard int")
    of_small = spark.createDataFrame([(r["bundle"], s) for r, s in zip(small, bins[len(big) :])], "bundle int, small_shard int")
    placed = rows.withColumn("bundle", bundle).join(F.broadcast(of_big), "digest", "left").join(F.broadcast(of_small), "bundle", "left")
    placed = placed.select("id", "uid", "size", "crc", F.coalesce("big_shard", "small_shard").alias("shard"), F.pmod(F.xxhash64("uid"), F.lit(PARTS)).cast("int").alias("part"))
    placed = scratch.table(placed, "placed")
    scratch.drop(rows)
    # shards x PARTS rows at most
    starts = placed.groupBy("shard", "part").agg(F.count("*").alias("n")).withColumn("start", F.sum("n").over(W.partitionBy("shard").orderBy("part")) - F.col("n")).drop("n")
    ranked = placed.withColumn("at", F.row_number().over(W.partitionBy("shard", "part").orderBy("id", "uid")) - 1)
    return ranked.join(F.broadcast(starts), ["shard", "part"]).select("id", "size", "crc", "shard", (F.col("at") + F.col("start")).cast("long").alias("slot"))
