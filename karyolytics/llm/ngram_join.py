"""N-gram Jaccard self-join as a blocked sparse product of the document by n-gram incidence with itself.

Texts with equal shingle sets are one class, and each class is one row of the incidence. Columns are shingles. Any pair
with Jaccard similarity t shares a shingle among the first n - ceil(t n) + 1 of either row in one fixed order of columns,
so only these prefixes are multiplied. The order puts columns with few rows first, by a count sketch of fixed size; the
sketch decides how much work there is, never what is found. Columns are dealt into blocks; each block multiplies its part
and accumulates overlap counts by pair, and pairs are dropped as soon as sizes and counts cannot reach the overlap that
their similarity needs. What remains is verified on the whole sets.

Large groups of near copies: before the product, each row is verified, in turns, against the leader that it shares most
columns with, and verified links are united. The product then counts only pairs of different components, so that a group of near
copies costs links to its leaders rather than all its pairs. The first leaders are rows with the largest part of their prefix in
shared columns, which in a group of edited copies is the text the others were made from. Before a pair is counted, the
parities of both sets in BITS bins bound their overlap: bins that differ are at most the shingles that differ. Every pair of different classes is either verified, or
excluded by a bound, or within a component already: no link that could join two components is lost.

Words are hashed to 64 bits and so are shingles and sets; two different ones collide with probability 2^-64.

Cases: null, empty and blank texts have no shingles and are linked with nothing; with fewer words than n the whole
sequence is one shingle; repeated rows are linked; a null identifier is kept, and is the component's only if there is no
other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, components, small_batches, trimmed

WORDS, PER_CENT = 5, 80
SKETCH = 1 << 20
BLOCKS = 128
#: Rounds of leaders before the product.
LEADERS = 2
#: Bins of the parities of a set.
BITS = 512
BYTES = 1 << 19
#: Identifiers are broadcast up to so many.
BROADCAST_IDS = 1_000_000
PAIRS = 1 << 18

_RANDOM = np.random.RandomState(20240229)
_BYTE = _RANDOM.randint(0, 1 << 62, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, in which A-Z count as a-z, and the place of its first byte."""
    b = np.frombuffer(data, np.uint8)
    white = (b == 32) | ((b >= 9) & (b <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], white, [True])).view(np.int8)))
    at, end = edge[::2], edge[1::2]
    if not len(at):
        return np.zeros(0, np.uint64), at
    lens = end - at
    total = int(lens.sum())
    first = np.cumsum(lens) - lens
    place = np.arange(total) - np.repeat(first, lens)
    b = b[~white]
    b = np.where((b >= 65) & (b <= 90), b + 32, b)
    power = np.full(int(lens.max()), _STEP, np.uint64)
    power[0] = 1
    return mix(np.add.reduceat(_BYTE[b] * np.cumprod(power)[place], first) + lens.astype(np.uint64)), at


def words_of(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Word hashes of each text. Short texts are hashed together, long ones in parts cut at white space."""
    held: list[bytes] = []

    def flush() -> Iterator[np.ndarray]:
        if held:
            h, at = word_hashes(b"\n".join(held))
            ends = np.cumsum([len(x) + 1 for x in held])
            bounds = np.searchsorted(at, ends)
            yield from np.split(h, bounds[:-1])
            held.clear()

    size = 0
    for t in texts:
        data = (t or "").encode("utf-8", "replace")
        if len(data) > BYTES:
            yield from flush()
            size, parts, at = 0, [], 0
            while at < len(data):
                cut = data.find(b" ", at + BYTES)
                cut = len(data) if cut < 0 else cut
                parts.append(word_hashes(data[at:cut])[0])
                at = cut
            yield np.concatenate(parts)
            continue
        held.append(data)
        size += len(data)
        if size > BYTES:
            yield from flush()
            size = 0
    yield from flush()


def distinct_sorted(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """The sorted distinct hashes of the n-word shingles, as whole numbers with sign."""
    if not len(words):
        return np.zeros(0, np.int64)
    k = min(n, len(words))
    h = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        h = h * _STEP + words[i : len(words) - k + 1 + i]
    return distinct_sorted(mix(h).view(np.int64))


def sets_of(texts: list[str | None], n: int) -> Iterator[np.ndarray]:
    for words in words_of(texts):
        yield shingles(words, n)


def class_of(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def slot(s: np.ndarray) -> np.ndarray:
    return (s.view(np.uint64) >> np.uint64(64 - SKETCH.bit_length() + 1)).astype(np.int64)


def parities(s: np.ndarray) -> bytes:
    """Of each bin, whether an odd number of the shingles falls into it; then the set's size as eight bytes."""
    return np.packbits(np.bincount(s & (BITS - 1), minlength=BITS) & 1).tobytes() + np.int64(len(s)).tobytes()


def rows_of(docs: DataFrame, n: int) -> DataFrame:
    """Rows with id, class, set size and parities, and the sketch's blocks of each task with a block number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SKETCH, np.uint32)
        names = ["id", "cls", "n", "bits", "block", "counts"]
        for batch in batches:
            cls, size, bits = [], [], []
            for s in sets_of(batch.column(1).to_pylist(), n):
                cls.append(class_of(s))
                size.append(len(s))
                bits.append(parities(s))
                sketch += np.bincount(slot(s), minlength=SKETCH).astype(np.uint32) if len(s) > SKETCH // 8 else 0
                if len(s) <= SKETCH // 8:
                    np.add.at(sketch, slot(s), np.uint32(1))
            k = len(cls)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cls, pa.int64()), pa.array(size, pa.int64()), pa.array(bits, pa.binary()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names)
        parts = [p.tobytes() for p in np.split(sketch, BLOCKS)]
        yield pa.RecordBatch.from_arrays([pa.nulls(BLOCKS, pa.int64()), pa.nulls(BLOCKS, pa.int64()), pa.nulls(BLOCKS, pa.int64()), pa.nulls(BLOCKS, pa.binary()), pa.array(range(BLOCKS), pa.int32()), pa.array(parts, pa.binary())], names)

    return docs.mapInArrow(trimmed(run), "id long, cls long, n long, bits binary, block int, counts binary")


def sum_blocks(blocks: DataFrame) -> bytes:
    """The whole sketch. Each task adds up the parts of its blocks as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = np.frombuffer(c, np.uint32).astype(np.uint64)
                total[k] = total[k] + x if k in total else x
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["block", "counts"])

    got = blocks.repartition("block").mapInArrow(trimmed(run), "block int, counts binary").collect()  # BLOCKS rows, SKETCH counts
    return b"".join(bytes(r["counts"]) for r in sorted(got, key=lambda r: r["block"])) or bytes(8 * SKETCH)


def prefixes(docs: DataFrame, n: int, per_cent: int, sketch: bytes) -> DataFrame:
    """Column entries: shingle, class and set size for the prefix of each row; a task gives each class once."""
    packed = np.minimum(np.frombuffer(sketch, np.uint64), 0xFFFFFFFF).astype(np.uint32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, done = np.frombuffer(packed, np.uint32), set()
        for batch in batches:
            h, cls, size = [], [], []
            for s in sets_of(batch.column(1).to_pylist(), n):
                if not len(s) or (c := class_of(s)) in done:
                    continue
                done.add(c)
                p = len(s) - (len(s) * per_cent + 99) // 100 + 1
                order = (counts[slot(s)].astype(np.uint64) << np.uint64(32)) | (s.view(np.uint64) >> np.uint64(32))
                keep = s[np.argpartition(order, p - 1)[:p]] if p < len(s) else s
                h.append(keep)
                cls.append(c)
                size.append(len(s))
            if h:
                k = [len(x) for x in h]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(h)), pa.array(np.repeat(np.array(cls, np.int64), k)), pa.array(np.repeat(np.array(size, np.int64), k))], ["h", "cls", "n"])

    return docs.mapInArrow(trimmed(run), "h long, cls long, n long")


def shared(entries: DataFrame) -> DataFrame:
    """Entries of columns with at least two classes, each once. Reads sorted entries with one row of memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_out = None, True  # the last row seen, and whether it has been given out
        for batch in batches:
            x = np.column_stack([c.to_numpy() for c in batch.columns])
            if last is not None:
                x = np.vstack([last, x])
            fresh = np.append(True, (x[1:, 0] != x[:-1, 0]) | (x[1:, 1] != x[:-1, 1]))
            x = x[fresh]
            same = x[1:, 0] == x[:-1, 0]
            keep = np.append(False, same) | np.append(same, False)
            if last is not None and last_out:
                keep[0] = False
            # the last row may yet meet its like in the next batch
            out_last = bool(keep[-1]) or (len(x) == 1 and last is not None and last_out)
            y = x[keep]
            if len(y):
                yield pa.RecordBatch.from_arrays([pa.array(y[:, i]) for i in range(3)], ["h", "cls", "n"])
            last, last_out = x[-1:], out_last

    return entries.repartition("h").sortWithinPartitions("h", "cls").mapInArrow(trimmed(run), "h long, cls long, n long")


def needed(na: Column, nb: Column, per_cent: int) -> Column:
    """Least overlap at which sets of these sizes reach the similarity."""
    return F.ceil(per_cent * (na + nb) / (100 + per_cent)).cast("long")


def reachable(na: Column, nb: Column, c: Column, per_cent: int) -> Column:
    """Whether sets of these sizes whose prefixes share c columns can still reach the similarity."""
    behind = lambda n: F.ceil(n * per_cent / 100).cast("long") - 1
    return (per_cent * F.greatest(na, nb) <= 100 * F.least(na, nb)) & (c + F.greatest(behind(na), behind(nb)) >= needed(na, nb, per_cent))


def product(lists: DataFrame, per_cent: int, bits: DataFrame | None = None, prefix: bool = True) -> DataFrame:
    """Overlap counts of pairs of classes of different components, block by block: (a, b, na, nb, c).

    Columns within one component have none. bits: by class, BITS bins that differ no more often than shingles do, then
    at least the set's size; with them, pairs whose bins exclude the similarity are not counted. prefix: whether columns
    are prefixes of the sets, so that counts bound the overlap.
    """

    width = BITS // 64 + 1 if bits is not None else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        count = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, count
            x = np.concatenate(held)
            held, count = [], 0
            x = x[np.lexsort((x[:, 1], x[:, 0]))]
            at = np.flatnonzero(np.append(True, (x[1:, 0] != x[:-1, 0]) | (x[1:, 1] != x[:-1, 1])))
            c = np.diff(np.append(at, len(x)))
            return pa.RecordBatch.from_arrays([*(pa.array(x[at, i]) for i in range(4)), pa.array(c)], ["a", "b", "na", "nb", "c"])

        def of_column(x: np.ndarray, odd: np.ndarray) -> Iterator[np.ndarray]:
            """x: class, size, component, by size; odd: parities. Rows outside the largest component meet all of other components."""
            comp, at, k = np.unique(x[:, 2], return_inverse=True, return_counts=True)
            if len(comp) < 2:
                return
            most = int(np.argmax(k))
            for i in np.flatnonzero(at != most):
                lo = np.searchsorted(x[:, 1], -(-x[i, 1] * per_cent // 100))
                hi = np.searchsorted(x[:, 1], x[i, 1] * 100 // per_cent, "right")
                j = np.arange(lo, hi)
                j = j[(at[lo:hi] != at[i]) & ((at[lo:hi] == most) | (j > i))]
                if odd.shape[1]:
                    most_shingles = (odd[j, -1] + odd[i, -1]).astype(np.int64)
                    j = j[(100 + per_cent) * np.bitwise_count(odd[j, :-1] ^ odd[i, :-1]).sum(1, dtype=np.int64) <= (100 - per_cent) * most_shingles]
                if len(j):
                    a, b = np.full(len(j), x[i, 0]), x[j, 0]
                    na, nb = np.full(len(j), x[i, 1]), x[j, 1]
                    swap = a > b
                    yield np.column_stack([np.where(swap, b, a), np.where(swap, a, b), np.where(swap, nb, na), np.where(swap, na, nb)])

        rest = np.zeros((0, 4), np.int64)
        rest_odd = np.zeros((0, width), np.uint64)
        for batch in chain(batches, (None,)):
            if batch is None:
                x, odd = rest, rest_odd
                ends = [0, len(x)] if len(x) else [0]
            else:
                x = np.vstack([rest, np.column_stack([c.to_numpy() for c in batch.columns[:4]])])
                new = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint64).reshape(-1, width) if width else np.zeros((batch.num_rows, 0), np.uint64)
                odd = np.vstack([rest_odd, new])
                ends = np.flatnonzero(np.append(True, x[1:, 0] != x[:-1, 0]))
                rest, rest_odd = x[ends[-1] :], odd[ends[-1] :]
            for a, b in zip(ends[:-1], ends[1:]):
                for y in of_column(x[a:b, 1:], odd[a:b]):
                    held.append(y)
                    count += len(y)
                    if count >= PAIRS:
                        yield flush()
        if held:
            yield flush()

    mixed = lists.groupBy("h").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("h")
    lists = lists.select("h", "cls", "n", "component").join(mixed, "h", "left_semi")
    if bits is not None:
        lists = lists.join(bits, "cls").select("h", "cls", "n", "component", "bits")
    blocks = lists.repartition("h").sortWithinPartitions("h", "n", "cls")
    pairs = blocks.mapInArrow(trimmed(run), "a long, b long, na long, nb long, c long")
    pairs = pairs.groupBy("a", "b").agg(F.first("na").alias("na"), F.first("nb").alias("nb"), F.sum("c").alias("c"))
    return pairs.filter(reachable(F.col("na"), F.col("nb"), F.col("c"), per_cent)) if prefix else pairs


def with_components(lists: DataFrame, known: DataFrame | None) -> DataFrame:
    if known is None:
        return lists.withColumn("component", F.col("cls"))
    return lists.join(known.select(F.col("node").alias("cls"), "component"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))


def leaders(lists: DataFrame, per_cent: int, turn: int) -> DataFrame:
    """For each class the leader of other component that it shares most columns with: (a, b, na, nb). The first
    turn has the rows with the largest part of their set in shared columns, later ones any.
    """
    row = F.struct("cls", "n", "component")
    if turn == 0:
        of = lists.join(lists.groupBy("cls").agg((F.count("*") / F.first("n")).alias("part")), "cls")
        lead = of.groupBy("h").agg(F.max_by(row, F.struct("part", "cls")).alias("lead"))
    else:
        lead = lists.groupBy("h").agg(F.min_by(row, F.struct(F.xxhash64("cls", F.lit(turn)), "cls")).alias("lead"))
    pairs = lists.join(lead, "h").filter("component <> lead.component").groupBy(F.col("lead.cls").alias("a"), F.col("cls").alias("b")).agg(F.first("lead.n").alias("na"), F.first("n").alias("nb"), F.count("*").alias("c"))
    pairs = pairs.filter(reachable(F.col("na"), F.col("nb"), F.col("c"), per_cent))
    return pairs.groupBy("b").agg(F.max_by(F.struct("a", "na", "nb"), F.struct("c", "a")).alias("x")).select("x.a", "b", "x.na", "x.nb")


class Join:
    """The join over one table of documents; ``linked`` gives its result."""

    def __init__(self, spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = WORDS, per_cent: int = PER_CENT, scratch: Scratch | None = None):
        small_batches(spark)
        self.spark, self.n, self.per_cent = spark, n, per_cent
        self.scratch = scratch or Scratch(spark, "ngram-join")
        self.docs = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))

    def verified(self, pairs: DataFrame, classes: DataFrame) -> DataFrame:
        """Of pairs (a, b, na, nb) those whose whole sets reach the similarity, as links (a, b)."""
        n = self.n
        ids = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct().join(classes.filter("n > 0"), "cls").select("key")
        ids = self.scratch.keep(ids)
        key = F.coalesce("id", F.lit(-(1 << 63)))
        of = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
        texts = self.docs.withColumn("key", key).join(of, "key", "left_semi").select("text")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                got = list(sets_of(batch.column(0).to_pylist(), n))
                yield pa.RecordBatch.from_arrays([pa.array([class_of(s) for s in got], pa.int64()), pa.array(got, pa.list_(pa.int64()))], ["cls", "items"])

        sets = self.scratch.keep(texts.mapInArrow(trimmed(run), "cls long, items array<long>").dropDuplicates(["cls"]))
        both = pairs.join(sets.select(F.col("cls").alias("a"), F.col("items").alias("x")), "a").join(sets.select(F.col("cls").alias("b"), F.col("items").alias("y")), "b")
        both = both.withColumn("c", F.size(F.array_intersect("x", "y")))
        links = self.scratch.table(both.filter(100 * F.col("c") >= self.per_cent * (F.col("na") + F.col("nb") - F.col("c"))).select("a", "b"), "links", dealt=True)
        return links

    def linked(self) -> DataFrame:
        """Per row: id, n_shingles, component_id."""
        s, per_cent = self.scratch, self.per_cent
        rows = s.keep(rows_of(self.docs, self.n))
        sketch = sum_blocks(rows.filter("block is not null").select("block", "counts"))
        rows = rows.filter("block is null").select("id", "cls", "n", "bits")
        classes = s.table(rows.groupBy("cls").agg(F.first("n").alias("n"), F.first("bits").alias("bits"), F.min("id").alias("low"), F.coalesce(F.min("id"), F.lit(-(1 << 63))).alias("key")), "classes", dealt=True)
        count = classes.count()
        lists = s.table(shared(prefixes(self.docs, self.n, per_cent, sketch)), "lists", dealt=True)
        links = tried = known = None
        for turn in range(LEADERS):
            star = s.table(leaders(with_components(lists, known), per_cent, turn), "star", count)
            more = self.verified(star, classes)
            links = more if links is None else links.unionByName(more)
            pair = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            tried = pair if tried is None else tried.unionByName(pair)
            known = s.table(components(links, s, rows=count), "known", count)
        pairs = s.table(product(with_components(lists, known), per_cent, classes.select("cls", "bits")).join(tried, ["a", "b"], "left_anti"), "pairs", dealt=True)
        more = self.verified(pairs, classes)
        whole = components(links.unionByName(more), s, rows=count).withColumnRenamed("node", "cls")
        of = classes.filter("n > 0").join(whole, "cls", "left").select("cls", F.coalesce("component", "cls").alias("component"), "low")
        low = of.groupBy("component").agg(F.min("low").alias("component_id"))
        named = s.table(of.join(low, "component").select("cls", "component_id"), "named", count)
        out = rows.drop("bits").join(named, "cls", "left")
        return out.select("id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def near_duplicates(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = WORDS, per_cent: int = PER_CENT, scratch: Scratch | None = None) -> DataFrame:
    return Join(spark, docs, doc_id, text, n, per_cent, scratch).linked()
