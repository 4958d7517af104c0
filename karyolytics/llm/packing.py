"""Best-fit packing of token pieces into sequences, by bin completion.

Lengths are whole numbers up to the capacity, so the instance is a histogram of at most ``capacity`` entries however many
documents there are. The driver packs the histogram: around the largest remaining length it enumerates fillings of the
rest of the bin in order of waste and skips dominated ones. A branch is a filling, taken as often as the counts allow or
once. Branches are searched depth first with backtracking, in rounds that allow one departure from the first branch more
each; a branch is cut when its waste can't beat the best plan found, which best-fit-decreasing gives at first. The search
ends when the lower bound is reached, when no branch is left, or after NODES steps, whatever the number of documents;
then the best plan so far stays, and all pieces are packed in each case. Pieces get their bin by rank within length.

Cases: a null or empty text is the end id alone; a text of exactly the capacity is not cut; repeated rows each have their
pieces; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, small_batches, trimmed
from .pieces import Encoder

CAPACITY, END = 1024, 2
PARTS = 64
NODES = 2_000_000  # steps of the search on the driver, some seconds
Plan = list[tuple[tuple[int, ...], int]]  # lengths of a bin, times used


@cache
def library(path: str):
    """The `tokenizers` library's own encoder."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def added(path: str) -> re.Pattern:
    """The tokens that the library finds in texts whatever they are cut into."""
    from tokenizers import Tokenizer

    return re.compile("|".join(re.escape(t.content) for t in Tokenizer.from_file(path).get_added_tokens_decoder().values()) or r"(?!)")


def ids_of(texts: list[str], path: str) -> Iterator[np.ndarray]:
    """Ids of each text; texts with a token of the added ones, which are few, go to the library itself."""
    marked = [added(path).search(t) is not None for t in texts]
    plain = encoder(path).whole([t for t, m in zip(texts, marked) if not m])
    for t, m in zip(texts, marked):
        yield np.array(library(path).encode(t, add_special_tokens=False).ids, np.uint32) if m else next(plain)


@cache
def encoder(path: str) -> Encoder:
    """Ids of the vocabulary file of the `tokenizers` library; its merges have the order of its ids."""
    import tiktoken
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    tok = Tokenizer.from_file(path)
    signs = sorted(ByteLevel.alphabet())
    plain = {c: ord(c) for c in signs if ord(c) < 256}  # bytes that stand for themselves
    rest = iter(b for b in range(256) if b not in plain.values())
    byte = plain | {c: b for c, b in zip((c for c in signs if ord(c) >= 256), rest)}
    added = {t.content for t in tok.get_added_tokens_decoder().values()}
    ranks = {bytes(byte[c] for c in t): i for t, i in tok.get_vocab(False).items() if t not in added}
    core = tiktoken.Encoding("json", pat_str="[\\s\\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe
    return Encoder(lambda pieces: [core.encode_single_piece(p.encode("utf-8", "replace")) for p in pieces])


def fillings(room: int, counts: list[int], limit: int, nodes: int = 4000) -> tuple[list[tuple[int, tuple[int, ...]]], int]:
    """Up to ``limit`` undominated fillings of the room as (waste, lengths), least waste first.

    Depth first over lengths in falling order, with the steps this took. A filling is dominated if a length not used fits its waste.
    """
    sizes = [s for s in range(min(room, len(counts) - 1), 0, -1) if counts[s]]
    if not sizes:
        return [(room, ())], 1
    suffix_min = sizes[-1]
    best: list[tuple[int, tuple[int, ...]]] = []
    left = nodes

    def walk(at: int, rest: int, taken: tuple[int, ...]) -> bool:
        nonlocal left
        left -= 1
        if left < 0:
            return True
        if rest < suffix_min:
            if len(best) < limit or (rest, taken) < best[-1]:
                best.append((rest, taken))
                best.sort(key=lambda x: (x[0], len(x[1])))
                del best[limit:]
            return len(best) >= limit and best[-1][0] == 0
        moved = False
        for i in range(at, len(sizes)):
            s = sizes[i]
            if s <= rest and counts[s] > taken.count(s):
                moved = True
                if walk(i, rest - s, (*taken, s)):
                    return True
        if not moved and (len(best) < limit or rest < best[-1][0]):
            best.append((rest, taken))
            best.sort(key=lambda x: (x[0], len(x[1])))
            del best[limit:]
        return False

    walk(0, room, ())
    return best or [(room, ())], nodes - max(left, 0)


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit-decreasing over the histogram: each bin takes the largest length that still fits, again and again."""
    left = [0] * (capacity + 1)
    for s, n in counts.items():
        left[s] = n
    plan: Plan = []
    for s in range(capacity, 0, -1):
        while left[s]:
            taken, room = [], capacity
            x = s
            while x:
                k = min(left[x] - taken.count(x), room // x)
                if k > 0:
                    taken += [x] * k
                    room -= k * x
                x = min(x - 1, room)
            times = min(left[t] // taken.count(t) for t in set(taken))
            for t in taken:
                left[t] -= times
            plan.append((tuple(taken), times))
    return plan


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any plan needs: those of lengths above half, and what smaller ones from some length on need beyond their room."""
    n = np.zeros(capacity + 1, np.int64)
    n[list(counts)] = list(counts.values())
    number, total = np.append(0, np.cumsum(n)), np.append(0, np.cumsum(n * np.arange(capacity + 1)))
    half, best = capacity // 2, 0
    for least in range(half + 1):
        alone = number[-1] - number[capacity - least + 1]
        shared, filled = number[capacity - least + 1] - number[half + 1], total[capacity - least + 1] - total[half + 1]
        small = total[half + 1] - total[least]
        best = max(best, int(alone + shared + max(0, -(-(small - (shared * capacity - filled)) // capacity))))
    return best


def complete(counts: dict[int, int], capacity: int, best: Plan, bound: int, nodes: int) -> Plan:
    """Bin completion by branch and bound from an incumbent, at most so many steps."""
    left = [0] * (capacity + 1)
    for s, n in counts.items():
        left[s] = n
    total, size = sum(s * n for s, n in counts.items()), sum(n for _, n in best)
    departures, more = 0, True
    while more and nodes > 0 and size > bound:
        more = False  # whether a branch was left out for its departures
        levels: list[list] = []  # branches in order, the next one's place, departures before, the branch taken
        used = waste = spent = 0
        s, down = capacity, True
        while True:
            if down:
                while s and not left[s]:
                    s -= 1
                if not s and used < size:
                    best, size = [level[3][:2] for level in levels], used
                if s and nodes > 0 and size > bound:
                    left[s] -= 1
                    want = 1 + departures - spent
                    found, steps = fillings(capacity - s, left, want + 1)
                    left[s] += 1
                    nodes -= steps
                    plans = [(w, (s, *rest)) for w, rest in found]
                    most = [min(left[t] // taken.count(t) for t in set(taken)) for _, taken in plans]
                    branches = [(taken, k, w * k) for (w, taken), k in zip(plans, most)]
                    branches += [(taken, 1, w) for (w, taken), k in zip(plans, most) if k > 1]
                    more |= len(branches) > want
                    levels.append([branches[:want], 0, spent, None])
            if not levels:
                break
            branches, place, spent, taken = levels[-1]
            if taken is not None:
                for t in taken[0]:
                    left[t] += taken[1]
                used, waste = used - taken[1], waste - taken[2]
                levels[-1][3] = None
            if place == len(branches) or nodes <= 0 or size <= bound:
                levels.pop()
                down = False
                continue
            branch = branches[place]
            levels[-1][1], spent, s = place + 1, spent + place, branch[0][0]
            if waste + branch[2] > (size - 1) * capacity - total:
                down = False
                continue
            for t in branch[0]:
                left[t] -= branch[1]
            used, waste, down = used + branch[1], waste + branch[2], True
            levels[-1][3] = branch
        departures += 1
    return best


def pack(counts: dict[int, int], capacity: int, nodes: int = NODES) -> Plan:
    """Bins for lengths 1 to capacity with their counts."""
    counts = {s: n for s, n in counts.items() if n}
    return complete(counts, capacity, best_fit(counts, capacity), lower_bound(counts, capacity), nodes)


PIECES = "id long, uid long, piece int, start long, length long, crc long"


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of each row's ids with the end id; the first piece of a long text takes what is left over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, uid, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), ids_of([t or "" for t in batch.column(2).to_pylist()], path)):
                ids = np.append(ids, np.uint32(end)).astype("<u4")
                at, first = 0, len(ids) % capacity or min(capacity, len(ids))
                for k, stop in enumerate(range(first, len(ids) + 1, capacity)):
                    out.append((key, uid, k, at, stop - at, zlib.crc32(ids[at:stop].tobytes())))
                    at = stop
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["id", "uid", "piece", "start", "length", "crc"])
        encoder(path).cache.clear()

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.monotonically_increasing_id().alias("uid"), F.col(text).alias("text"))
    return rows.mapInArrow(trimmed(run), PIECES)


def pack_documents(spark: SparkSession, docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, doc_id: str = "doc_id", text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """Per piece: id, uid (the row's number), piece, start, length, crc, sequence_id, offset."""
    small_batches(spark)
    scratch = scratch or Scratch(spark, "packing")
    pieces = scratch.table(token_pieces(docs, path, capacity, end, doc_id, text).withColumn("part", F.pmod(F.xxhash64("uid", "piece"), F.lit(PARTS)).cast("int")), "pieces")
    open_, full = pieces.filter(F.col("length") < capacity), pieces.filter(F.col("length") == capacity)
    counts = open_.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity - 1 rows at most
    rows, base, taken = [], 0, {}
    for lengths, times in pack(histogram, capacity):
        at = 0
        for s in sorted(set(lengths), reverse=True):
            k = lengths.count(s)
            low = taken.get(s, 0)
            taken[s] = low + k * times
            rows.append((s, low, low + k * times, base, k, at))
            at += k * s
        base += times
    # a few rows for each length: the number of fillings is bound by the capacity, not by the documents
    plan = spark.createDataFrame(rows, "length long, low long, high long, base long, k long, at long")
    starts = counts.withColumn("before", F.sum("n").over(W.partitionBy("length").orderBy("part")) - F.col("n")).drop("n")
    ranked = open_.withColumn("r", F.row_number().over(W.partitionBy("length", "part").orderBy("uid", "piece")) - 1)
    ranked = ranked.join(F.broadcast(starts), ["length", "part"]).withColumn("r", F.col("r") + F.col("before"))
    j = F.col("r") - F.col("low")
    columns = ["id", "uid", "piece", "start", "length", "crc"]
    placed = ranked.join(F.broadcast(plan), "length").filter((F.col("r") >= F.col("low")) & (F.col("r") < F.col("high")))
    placed = placed.select(*columns, (F.col("base") + F.floor(j / F.col("k"))).cast("long").alias("sequence_id"), (F.col("at") + (j % F.col("k")) * F.col("length")).cast("long").alias("offset"))
    alone = full.select(*columns, (-1 - F.row_number().over(W.partitionBy("part").orderBy("uid", "piece")) * PARTS - F.col("part")).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed.unionByName(alone)
