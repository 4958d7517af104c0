"""Phrase collocation mining by hierarchical pair naming.

Frequent words get global ids. Two neighbouring ids make a pair; frequent pairs get global ids in turn, and two pairs that
share their middle word make a phrase of three words. The tables of names double as parent pointers: a name's two halves are
the ids of its parts, so the cuts of a phrase and the shorter phrases inside it are look-ups by id.

Tasks keep the corpus as blocks of bounded size: of each block and language a sequence of local numbers, with a break
between pieces, and what the numbers stand for. Only distinct words and pairs of a block move, with their counts, to meet the
global counts; of those that reach the least frequency the ids go back to the blocks, where they replace the local ones.
A part of a frequent phrase is as frequent, so nothing else can be in a longer phrase.

Cases: a null text is empty, a null language ``und``; texts without words give nothing; repeated rows count each; a very
long text is cut into blocks between pieces, of which a single one stays whole; ties go as the ranking says; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, give_back, trimmed

LEAST, TOP = 10, 2000
#: A phrase is dropped for a longer one that has so many hundredths of its occurrences.
COVERED = 50
#: Bytes of text of a block.
BLOCK = 4 << 20
BLANK, BREAK = b" \t", b".,;:!?\n\v\f\r"
KIND = np.zeros(256, np.uint8)
KIND[list(BLANK)], KIND[list(BREAK)] = 1, 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def numbered(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The words of texts as numbers, -1 between pieces, and the words that the numbers stand for."""
    joined = pc.binary_join_element_wise(texts, pa.scalar("", texts.type), pa.scalar("\n", texts.type))
    if not len(joined):
        return np.zeros(0, np.int32), pa.array([], pa.string())
    ends = np.frombuffer(joined.buffers()[1], np.int64 if pa.types.is_large_string(joined.type) else np.int32)[joined.offset : joined.offset + len(joined) + 1]
    data = np.frombuffer(joined.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    kind = KIND[data]
    inside = np.concatenate([[False], kind == 0])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    if not len(edge):
        return np.zeros(0, np.int32), pa.array([], pa.string())
    start, size = edge[::2], edge[1::2] - edge[::2]
    piece = np.cumsum(kind == 2, dtype=np.int32)[start]
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(LOWER[data[inside[1:]]])).dictionary_encode()
    seq = np.insert(words.indices.to_numpy(), np.flatnonzero(piece[1:] != piece[:-1]) + 1, -1)
    return seq.astype(np.int32), words.dictionary


def portions(texts: pa.Array) -> Iterator[pa.Array]:
    """Texts in blocks; one that is longer than a block is cut behind a sign that ends a piece."""
    held, size = [], 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        if n > BLOCK:
            rest = texts[i].as_buffer().to_pybytes()
            while len(rest) > BLOCK:
                cut = max(rest.rfind(c, 0, BLOCK) for c in map(bytes, zip(BREAK)))
                if cut < 0:  # a piece longer than a block: up to its end
                    cut = min((x for c in map(bytes, zip(BREAK)) if (x := rest.find(c, BLOCK)) >= 0), default=len(rest))
                yield pa.StringArray.from_buffers(1, pa.py_buffer(np.array([0, min(cut + 1, len(rest))], np.int32)), pa.py_buffer(rest[: cut + 1]))
                rest = rest[cut + 1 :]
            yield pa.StringArray.from_buffers(1, pa.py_buffer(np.array([0, len(rest)], np.int32)), pa.py_buffer(rest))
            continue
        held.append(i)
        size += n
        if size > BLOCK:
            yield texts.take(pa.array(held))
            held, size = [], 0
    if held:
        yield texts.take(pa.array(held))


def word_blocks(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """block, lang, seq (local numbers), n (words), words and counts of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, held, size = TaskContext.get().partitionId() << 32, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal base
            rows = pa.Table.from_batches(held).combine_chunks()
            for name in pc.unique(rows["lang"]).to_pylist():
                for part in portions(pc.filter(rows["text"], pc.equal(rows["lang"], name)).combine_chunks()):
                    seq, words = numbered(part)
                    count = np.bincount(seq[seq >= 0], minlength=len(words))
                    base += 1
                    one = pa.array([0, len(words)], pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array([base - 1]), pa.array([name], pa.string()), pa.array([seq.tobytes()], pa.binary()), pa.array([int(count.sum())]), pa.ListArray.from_arrays(one, words.cast(pa.string())), pa.ListArray.from_arrays(one, pa.array(count, pa.int64()))], ["block", "lang", "seq", "n", "words", "counts"])

        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size > BLOCK:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(trimmed(run), "block long, lang string, seq binary, n long, words array<string>, counts array<long>")


def named(cells: DataFrame, keys: list[str], scratch: Scratch, name: str, least: int) -> DataFrame:
    """cells: block, local, n and the keys of what is counted. Those of frequent keys, with f and id of the key.

    Counts meet and ids come back in one shuffle by key, in which a key has a row for each block that has it. The ids are
    written, so they stay. ``first`` holds for one row of each key.
    """
    of = W.partitionBy(*keys)
    frequent = cells.withColumn("f", F.sum("n").over(of)).filter(F.col("f") >= least).withColumn("row", F.monotonically_increasing_id())
    out = frequent.withColumn("id", F.min("row").over(of)).select("block", "local", *keys, "f", "id", (F.col("row") == F.col("id")).alias("first"))
    return scratch.table(out, name, dealt=True, swept=True)


def column(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy()


def with_ids(left: pa.Table, right: pa.Table) -> pa.Table:
    """A block and (local number, id) of its frequent words: the sequence of the frequent ones and their ids."""
    if not left.num_rows:
        return pa.table({"block": pa.array([], pa.int64()), "seq": pa.array([], pa.binary()), "ids": pa.array([], pa.binary())})
    seq, local = np.frombuffer(left["seq"][0].as_py(), np.int32), column(right, "local")
    to = np.full(int(seq.max(initial=-1)) + 2, -1, np.int32)  # the last place is for breaks
    to[local] = np.arange(len(local))
    out = pa.table({"block": left["b"], "seq": pa.array([to[seq].tobytes()], pa.binary()), "ids": pa.array([column(right, "id").tobytes()], pa.binary())})
    give_back()
    return out


def neighbours(seq: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where two neighbours have numbers, and a key of each such pair."""
    at = np.flatnonzero((seq[:-1] >= 0) & (seq[1:] >= 0))
    return at, seq[at].astype(np.int64) * n + seq[at + 1]


def block_of(batch: pa.RecordBatch | pa.Table, i: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(batch["seq"][i].as_py(), np.int32), np.frombuffer(batch["ids"][i].as_py(), np.int64)


def block_pairs(blocks: DataFrame) -> DataFrame:
    """Distinct pairs of each block: block, local (rank within the block), l and r (ids), n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                seq, ids = block_of(batch, i)
                key, n = np.unique(neighbours(seq, len(ids))[1], return_counts=True)
                if len(key):
                    l, r = np.divmod(key, len(ids))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), batch["block"][i].as_py())), pa.array(np.arange(len(key), dtype=np.int32)), pa.array(ids[l]), pa.array(ids[r]), pa.array(n)], ["block", "local", "l", "r", "n"])

    return blocks.mapInArrow(trimmed(run), "block long, local int, l long, r long, n long")


def block_triples(left: pa.Table, right: pa.Table) -> pa.Table:
    """A block and (local rank, id) of its frequent pairs: the neighbouring pairs l, r and n."""
    none = np.zeros(0, np.int64)
    p = q = n = none
    if left.num_rows and right.num_rows:
        seq, ids = block_of(left, 0)
        at, key = neighbours(seq, len(ids))
        distinct, rank = np.unique(key, return_inverse=True)
        local, pair_ids = column(right, "local"), column(right, "id")
        to = np.full(len(distinct), -1, np.int32)
        to[local] = np.arange(len(local))
        pairs = np.full(len(seq), -1, np.int32)
        pairs[at] = to[rank]
        key, n = np.unique(neighbours(pairs, len(local))[1], return_counts=True)
        p, q = (pair_ids[x] for x in np.divmod(key, len(local)))
        del at, key, distinct, rank, pairs
        give_back()
    return pa.table({"l": pa.array(p, pa.int64()), "r": pa.array(q, pa.int64()), "n": pa.array(n, pa.int64())})


def score(a: Column | str, l: Column | str, r: Column | str) -> Column:
    """floor(1000000 a a / (l r)) in whole numbers: up to 10^15 occurrences fit into 38 digits."""
    return F.expr(f"(cast(1000000 as decimal(7, 0)) * cast({a} as decimal(15, 0)) * cast({a} as decimal(15, 0))) div (cast({l} as decimal(15, 0)) * cast({r} as decimal(15, 0)))")


def collocations(spark: SparkSession, docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, top: int | None = TOP, scratch: Scratch | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the best phrases of each language; top None gives all."""
    scratch = scratch or Scratch(spark, "collocations")
    first = scratch.table(word_blocks(docs, lang, text), "words")
    totals = scratch.table(first.groupBy("lang").agg(F.sum("n").alias("n")), "totals", dealt=True, swept=True)
    cells = first.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("local", "x")).select("block", "local", "lang", F.col("x.words").alias("word"), F.col("x.counts").alias("n"))
    words = named(cells, ["lang", "word"], scratch, "words-named", least)
    blocks = first.select(F.col("block").alias("b"), "seq").groupBy("b").cogroup(words.select("block", "local", "id").groupBy("block")).applyInArrow(with_ids, "block long, seq binary, ids binary")
    blocks = scratch.table(blocks, "blocks", swept=True)
    scratch.drop(first)
    pairs = named(block_pairs(blocks), ["l", "r"], scratch, "pairs-named", least)
    triples = blocks.select(F.col("block").alias("b"), "seq", "ids").groupBy("b").cogroup(pairs.select("block", "local", "id").groupBy("block")).applyInArrow(block_triples, "l long, r long, n long")
    triples = scratch.table(triples.groupBy("l", "r").agg(F.sum("n").alias("f")).filter(F.col("f") >= least), "triples", dealt=True, swept=True)
    scratch.drop(blocks)
    return ranked(words.filter("first"), pairs.filter("first"), triples, totals, top)


def ranked(words: DataFrame, pairs: DataFrame, triples: DataFrame, totals: DataFrame, top: int | None) -> DataFrame:
    """words: id, lang, word, f. pairs: id, l, r (words), f. triples: l, r (pairs), f. totals: lang, n."""
    left, right = (words.select(F.col("id").alias(k), F.col("word").alias(f"{k}_word"), F.col("f").alias(f"{k}_f"), *["lang"][: k == "l"]) for k in "lr")
    two = pairs.join(left, "l").join(right, "r")
    p, q = (two.select(F.col("id").alias(k), *(F.col(c).alias(f"{k}_{c}") for c in ("f", "l_f", "r_f", "l_word", "r_word")), *["lang"][: k == "l"]) for k in "lr")
    three = triples.join(p, "l").join(q, "r")
    # a longer phrase covers its two pairs; the most frequent one decides
    cover = triples.select(F.explode(F.array("l", "r")).alias("id"), F.col("f").alias("longer")).groupBy("id").agg(F.max("longer").alias("longer"))
    two = two.join(cover, "id", "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < COVERED * F.col("f")))
    two = two.select("lang", F.concat_ws(" ", "l_word", "r_word").alias("phrase"), F.col("f").alias("a"), F.col("l_f").alias("l"), F.col("r_f").alias("r"), score("f", "l_f", "r_f").alias("score"))
    cuts = F.least(*(F.struct(score("f", l, r).alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"), F.col(r).alias("r")) for k, l, r in ((1, "l_l_f", "r_f"), (2, "l_f", "r_r_f"))))
    three = three.withColumn("cut", cuts).select("lang", F.concat_ws(" ", "l_l_word", "l_r_word", "r_r_word").alias("phrase"), F.col("f").alias("a"), "cut.l", "cut.r", "cut.score")
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    out = two.unionByName(three).withColumn("rank", rank)
    out = out if top is None else out.filter(F.col("rank") <= top)  # tasks keep their own first ones before the shuffle
    return out.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
