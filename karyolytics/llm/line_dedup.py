"""Fuzzy line dedup over all documents: MinHash signatures of character shingles, bands, verification, components.

Each distinct line gets a one-permutation MinHash signature of its five-character shingles; empty bins borrow from the
next filled one. Bands of six values make lines that share one candidates: with sixteen bands a pair of similarity 0.8 is
found with probability 0.99, one of 0.9 with 0.99999. Verified links are united, and of each component the first line,
by document and position, stays.

Each task packs its lines and band keys as arrays, one for each bucket of keys, so that the shuffle moves few large rows and
equal keys meet in one sort of numbers. Of a line that a task meets again and again only the first occurrence goes on; the
others are dropped on the spot. Of a band that several lines share, one is the leader, and each line is compared with the
leader that it shares most bands with. Lines that a leader took carry its label, and bands with one label are done. In the
others, lines whose bins (of their shingles, by parity) exclude the similarity with every line of other label go; those that remain are
compared on their whole shingle sets, band by band, and a band gives only links that unite lines it hasn't united yet.
So a group of n near copies costs some links a line and band, never its pairs.

Lines are compared without white space at their ends, by a 64-bit hash of their text. Blank lines always stay.

Cases: null and empty texts have no lines that could be dropped, and null stays null; lines shorter than a shingle are one
shingle; rows that repeat both identifier and text count as one document and keep the same lines; null identifiers come
first; an empty table gives an empty result; columns other than identifier and text are carried along untouched, save those
that are named as the two columns of counts: these are replaced.
"""

from __future__ import annotations

import functools
import operator
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE, Scratch, components, small_batches, trimmed
from .ngram_join import BITS, BROADCAST_IDS, distinct_sorted, mix

CHARS, PER_CENT = 5, 80
BANDS, ROWS = 16, 6
BINS = BANDS * ROWS
#: Characters of new lines, or lines, that a task takes at once.
CHUNK, MOST_LINES = 1 << 18, 5_000
#: Lines that a task remembers, so as not to give their bands again.
SEEN = 200_000
#: A line takes the label of the leader that so many doublings reach. It decides what is left to compare, not what is found.
DOUBLINGS = 1
#: Buckets of keys for each shuffle partition, and the bytes of them that a task holds before it gives them out.
FINE, HELD = 4, 8 << 20
#: Shingles whose sets are compared at once.
COMPARED = 1 << 21
#: Lines of a band whose pairs are compared by their bins together with those of other bands.
SMALL = 64
_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_NONE = np.uint32(0xFFFFFFFF)


def shingle_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of all lines, and their counts by line; a line shorter than a shingle has one.

    A shingle is five UTF-16 units; four of them are read as one number.
    """
    pad = "\0" * (CHARS - 1)
    data = (pad.join(lines) + pad + "\0").encode("utf-16-le", "surrogatepass")
    lens = np.fromiter(map(len, lines), np.int64, len(lines))
    if len(data) != 2 * (int(lens.sum()) + len(pad) * len(lines) + 1):  # signs of two units
        lens = np.fromiter((len(x.encode("utf-16-le", "surrogatepass")) // 2 for x in lines), np.int64, len(lines))
    starts = np.cumsum(lens + len(pad)) - lens - len(pad)
    count = np.maximum(lens - CHARS + 1, 1)
    n = len(data) // 2 - len(pad)
    h = np.ndarray((n,), "<u8", data, 0, (2,)) * _FACTORS[0]
    h ^= h >> np.uint64(32)
    h += np.ndarray((n,), "<u2", data, 2 * CHARS - 2, (2,)) * _FACTORS[1]
    h *= _FACTORS[2]
    h ^= h >> np.uint64(29)
    h *= _FACTORS[3]
    h ^= h >> np.uint64(32)
    real = np.zeros(n + 1, np.int8)
    np.add.at(real, starts, 1)
    np.add.at(real, starts + count, -1)
    return h[np.cumsum(real[:-1], dtype=np.int8).view(bool)], count


def bands(lines: list[str]) -> np.ndarray:
    """Band keys, a row for each line."""
    h, count = shingle_hashes(lines)
    slot = h >> np.uint64(32)
    slot *= np.uint64(BINS)
    slot >>= np.uint64(32)
    slot += np.repeat(np.arange(len(lines), dtype=np.uint64) * np.uint64(BINS), count)
    sig = np.full(len(lines) * BINS, _NONE, np.uint32)
    np.minimum.at(sig, slot.view(np.int64), h.view("<u4")[::2] & np.uint32(0xFFFFFFFE))
    sig = sig.reshape(len(lines), BINS)
    place = np.where(np.tile(sig != _NONE, 2), np.arange(2 * BINS, dtype=np.int16), np.int16(4 * BINS))
    nearest = np.minimum.accumulate(place[:, ::-1], axis=1)[:, ::-1][:, :BINS]
    gap = nearest - np.arange(BINS)
    sig = np.take_along_axis(sig, nearest % BINS, axis=1).astype(np.uint64) + gap.astype(np.uint64) * np.uint64(0x9E3779B1)
    key = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(lines), 1))
    for r in range(ROWS):
        key = mix(key * _FACTORS[0] + sig[:, r::ROWS])
    return key.view(np.int64)


def bins(lines: list[str]) -> tuple[np.ndarray, list[bytes]]:
    """Of each line the number of its shingles, and of each of BITS bins whether an odd number of them falls into it.

    The bin is the head of a shingle's hash, so that it doesn't depend on how many lines are taken at once.
    """
    h, count = shingle_hashes(lines)
    of = np.repeat(np.arange(len(lines), dtype=np.uint64), count)
    bits = np.uint64(max(1, len(lines).bit_length()))
    x = distinct_sorted((of << (np.uint64(64) - bits)) | (h >> bits))
    of = (x >> (np.uint64(64) - bits)).astype(np.int64)
    bin_ = ((x >> (np.uint64(64 - BITS.bit_length() + 1) - bits)) & np.uint64(BITS - 1)).astype(np.int64)
    odd = np.bincount(of * BITS + bin_, minlength=len(lines) * BITS) & 1
    return np.bincount(of, minlength=len(lines)), [x.tobytes() for x in np.packbits(odd.astype(np.uint8).reshape(len(lines), BITS), axis=1)]


def similar(x: list[str], y: list[str], per_cent: int) -> np.ndarray:
    """Which pairs of lines reach the Jaccard similarity, by their whole shingle sets."""
    if not x:
        return np.zeros(0, bool)
    bits = np.uint64(max(1, len(x).bit_length()))

    def by_pair(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
        h, count = shingle_hashes(lines)
        pair = np.repeat(np.arange(len(lines)), count)
        k = distinct_sorted((pair.astype(np.uint64) << (np.uint64(64) - bits)) | (h >> bits))
        return k, np.bincount((k >> (np.uint64(64) - bits)).astype(np.int64), minlength=len(lines))

    (a, na), (b, nb) = by_pair(x), by_pair(y)
    k = np.sort(np.concatenate([a, b]), kind="stable")  # two sorted runs
    both = np.bincount((k[1:][k[1:] == k[:-1]] >> (np.uint64(64) - bits)).astype(np.int64), minlength=len(x))
    return 100 * both >= per_cent * (na + nb - both)


#: A line of a document: hash, whether the document has an identifier, the identifier, the document's key, the line's place.
PLACE = np.dtype([("h", "<i8"), ("has", "u1"), ("id", "<i8"), ("key", "<i8"), ("at", "<i4")])
#: A line that has a band key.
ENTRY = np.dtype([("band", "<i8"), ("h", "<i8")])
#: A line that goes.
DROP = np.dtype([("key", "<i8"), ("at", "<i4")])
_KINDS = (PLACE, ENTRY, DROP)


def key_of(id_: Column, text: Column) -> Column:
    return F.xxhash64(id_, text)


def first_of(x: np.ndarray, *names: str) -> np.ndarray:
    """Which rows differ from the row before them."""
    new = np.zeros(len(x), bool)
    new[:1] = True
    for name in names:
        new[1:] |= x[name][1:] != x[name][:-1]
    return new


def several(x: np.ndarray) -> np.ndarray:
    """Which rows of sorted numbers have an equal neighbour."""
    same = x[1:] == x[:-1]
    return np.append(same, False) | np.append(False, same)


def crowded(x: np.ndarray) -> np.ndarray:
    """Rows of numbers whose tail occurs more than once; all that have an equal are among them, and few others need sorting."""
    bits = max(10, len(x).bit_length() + 1)
    tail = (x & ((1 << bits) - 1)).astype(np.int64)
    return np.flatnonzero((np.bincount(tail) > 1)[tail])


def firsts(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of places: the first one of each line, and the others. A place that occurs twice is one."""
    x = x[np.argsort(x["h"])]
    again = several(x["h"])
    alone, x = x[~again], x[again]
    x = x[np.lexsort((x["at"], x["key"], x["id"], x["has"], x["h"]))]
    x = x[first_of(x, *PLACE.names)]
    new = first_of(x, "h")
    drops = np.zeros(int((~new).sum()), DROP)
    drops["key"], drops["at"] = x["key"][~new], x["at"][~new]
    return np.concatenate([alone, x[new]]), drops


def packed(docs: DataFrame, buckets: int) -> DataFrame:
    """Arrays of places, band entries and drops by bucket of their keys: (bucket, kind, data)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(docs_: list[tuple], counts: list[int], h: list[int], at: list[int], fresh: list[str], hashes: list[int]) -> None:
            nonlocal held_size
            of, place = np.repeat(np.arange(len(counts)), counts), np.zeros(len(h), PLACE)
            place["h"], place["at"] = np.array(h, np.uint64).view(np.int64), at
            for name, values in zip(("has", "id", "key"), zip(*docs_)):
                place[name] = np.array(values, PLACE[name])[of]
            places, drops = firsts(place)
            parts = [(places["h"], places), (drops["key"], drops)]
            if fresh:
                keys = bands(fresh)
                entries = np.zeros(keys.size, ENTRY)
                entries["band"], entries["h"] = keys.ravel(), np.repeat(np.array(hashes, np.uint64).view(np.int64), BANDS)
                parts.append((entries["band"], entries))
            for key, x in parts:
                b = (((mix(key.view(np.uint64)) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.uint16 if buckets < 1 << 16 else np.int64)
                order = np.argsort(b, kind="stable")
                b, x, kind = b[order], x[order], _KINDS.index(x.dtype)
                at = np.flatnonzero(np.append(True, b[1:] != b[:-1])[: len(b)])
                for i, j in zip(at, [*at[1:], len(b)]):
                    held.setdefault((int(b[i]), kind), []).append(x[i:j].tobytes())
                held_size += x.nbytes

        def flush() -> pa.RecordBatch:
            nonlocal held_size
            got = [(bucket, kind, b"".join(data)) for (bucket, kind), data in held.items()]
            held.clear()
            held_size = 0
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), (pa.int32(), pa.int8(), pa.binary()))], ["bucket", "kind", "data"])

        held: dict[tuple[int, int], list[bytes]] = {}
        held_size = 0
        empty = lambda: ([], [], [], [], [], [])
        parts, size, seen = empty(), 0, set()
        for batch in batches:
            for id_, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                docs_, counts, h, at, fresh, hashes = parts
                docs_.append((id_ is not None, id_ or 0, key))
                before = len(h)
                for i, line in enumerate((text or "").split("\n")):
                    if not (line := line.strip(WHITE)):
                        continue
                    x = xxhash.xxh64_intdigest(line.encode("utf-8", "replace"), 42)
                    if x not in seen:
                        seen.add(x)
                        hashes.append(x)
                        fresh.append(line)
                        size += len(line)
                    h.append(x)
                    at.append(i)
                    if size > CHUNK or len(h) > MOST_LINES:
                        counts.append(len(h) - before)
                        out(*parts)
                        if held_size > HELD:
                            yield flush()
                        parts, size, before = empty(), 0, 0
                        docs_, counts, h, at, fresh, hashes = parts
                        docs_.append((id_ is not None, id_ or 0, key))
                        if len(seen) > SEEN:
                            seen.clear()
                counts.append(len(h) - before)
        if parts[2]:
            out(*parts)
        if held:
            yield flush()

    return docs.mapInArrow(trimmed(run), "bucket int, kind byte, data binary")


MET = "kind byte, band long, h long, lead long, has boolean, id long, key long, at int"


def met(blobs: DataFrame) -> DataFrame:
    """What arrays of a bucket have in common. kind 0: the first place of each line; 1: entries of bands that several lines
    share, with the leader; 2: places that go, as another place of the same text stays. A task holds one partition.
    """

    def batch(kind: int, **columns: np.ndarray) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        kinds = {"kind": pa.int8(), "has": pa.bool_(), "at": pa.int32()}
        columns["kind"] = np.full(n, kind, np.int8)
        names = ["kind", "band", "h", "lead", "has", "id", "key", "at"]
        return pa.RecordBatch.from_arrays([pa.array(columns[c], kinds.get(c, pa.int64())) if c in columns else pa.nulls(n, kinds.get(c, pa.int64())) for c in names], names)

    def drops_of(x: np.ndarray) -> pa.RecordBatch:
        return batch(2, key=x["key"].copy(), at=x["at"].copy())

    def of_kind(kind: int, data: list[bytes]) -> Iterator[pa.RecordBatch]:
        x = np.frombuffer(b"".join(data), _KINDS[kind])
        if kind == 0:
            x, drops = firsts(x)
            yield batch(0, h=x["h"].copy(), has=x["has"].astype(bool), id=x["id"].copy(), key=x["key"].copy(), at=x["at"].copy())
            yield drops_of(drops)
        elif kind == 1:
            x = x[crowded(x["band"])]
            x = x[np.argsort(x["band"])]
            x = x[several(x["band"])]
            order = mix(x["h"].copy().view(np.uint64) * _FACTORS[1])  # the leader is as good as drawn
            x = x[np.lexsort((order, x["band"]))]
            x = x[first_of(x, "band", "h")]
            new = first_of(x, "band")
            group = np.cumsum(new) - 1
            shared = np.bincount(group, minlength=1)[group] > 1
            lead = x["h"][new][group]
            yield batch(1, band=x["band"][shared], h=x["h"][shared], lead=lead[shared])
        else:
            yield drops_of(x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[bytes]] = [[], [], []]
        for b in batches:
            for kind, data in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                held[kind].append(data)
        for kind in range(3):
            data, held[kind] = held[kind], []
            if data:
                yield from of_kind(kind, data)

    return blobs.repartition("bucket").mapInArrow(trimmed(run), MET)


def bare(line: Column) -> Column:
    """The line without white space at its ends. btrim visits every sign of a line, so it is left to those that need it."""
    x = F.trim(line)
    ends = functools.reduce(operator.or_, (x.startswith(c) | x.endswith(c) for c in WHITE[1:]))
    return F.when(ends, F.btrim(line, F.lit(WHITE))).otherwise(x)


def texts_of(docs: DataFrame, ids: DataFrame, n: int, scratch: Scratch) -> DataFrame:
    """The text and bins of each of n lines that share a band with another one: (h, line, n, bits). No other line is ever compared."""
    of = F.broadcast(ids) if n <= BROADCAST_IDS else ids
    line = docs.select(F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line")).select(bare(F.col("line")).alias("line")).filter("line <> ''")
    line = line.withColumn("h", F.xxhash64("line")).join(of, "h", "left_semi").dropDuplicates(["h"]).select("h", "line")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = batch.column(1).to_pylist()
            counts, got, at = [np.zeros(0, np.int64)], [], 0
            while at < len(lines):
                n, size = at, 0
                while n < len(lines) and size < CHUNK:
                    size += len(lines[n])
                    n += 1
                k, x = bins(lines[at:n])
                counts.append(k)
                got += x
                at = n
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(counts)), pa.array(got, pa.binary())], ["h", "line", "n", "bits"])

    return scratch.table(line.mapInArrow(trimmed(run), "h long, line string, n long, bits binary"), "texts", n)


def words_of(bits: pa.Array) -> np.ndarray:
    """The bins of lines as numbers, a row for each line."""
    return np.frombuffer(bits.cast(pa.binary(BITS // 8)).buffers()[1], np.uint64).reshape(-1, BITS // 64)


def apart(x: np.ndarray, y: np.ndarray, sizes: np.ndarray, per_cent: int) -> np.ndarray:
    """Which pairs the bins exclude: bins that differ are at most the shingles that differ. sizes: of both sets together."""
    return (100 + per_cent) * np.bitwise_count(x ^ y).sum(1, dtype=np.int64) > (100 - per_cent) * sizes


def verified(texts: DataFrame, pairs: DataFrame, per_cent: int) -> DataFrame:
    """Of pairs (a, b) of line hashes those whose shingle sets reach the similarity. texts: (h, line, n, bits).

    Sets are made only of lines that the bins leave.
    """
    both = pairs.select("a", "b")
    for side in ("a", "b"):
        both = both.join(texts.select(F.col("h").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in ("line", "n", "bits"))), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(4).to_numpy() + batch.column(5).to_numpy()
            batch = batch.take(pa.array(np.flatnonzero(~apart(words_of(batch.column(6)), words_of(batch.column(7)), sizes, per_cent))))
            x, y = (batch.column(i).to_pylist() for i in (2, 3))
            keep, i = [], 0
            while i < len(x):
                n, size = i, 0
                while n < len(x) and size < CHUNK and n - i < 1000:
                    size += len(x[n]) + len(y[n])
                    n += 1
                keep += similar(x[i:n], y[i:n], per_cent).tolist()
                i = n
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep, pa.bool_())) for i in (0, 1)], ["a", "b"])

    return both.select("a", "b", "line_a", "line_b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(trimmed(run), "a long, b long")


def by_band(rows: DataFrame, run_group, schema: str) -> DataFrame:
    """Hands run_group the rows of each band; rows: band first. Only one band is held at a time, beside a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in chain(batches, (None,)):
            if batch is not None:
                rest = batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches(max_chunksize=None)[0]
                band = rest.column(0).to_numpy()
                ends = np.flatnonzero(np.append(True, band[1:] != band[:-1])) if len(band) else np.zeros(1, np.int64)
                whole, rest = (rest.slice(0, ends[-1]), ends), rest.slice(ends[-1])
            elif rest is not None and len(rest):
                band = rest.column(0).to_numpy()
                whole = (rest, np.append(np.flatnonzero(np.append(True, band[1:] != band[:-1])), len(band)))
            else:
                return
            yield from run_group(*whole)

    return rows.repartition("band").sortWithinPartitions("band", "h").mapInArrow(trimmed(run), schema)


def possible(bits: np.ndarray, n: np.ndarray, i: int, j: np.ndarray, per_cent: int) -> np.ndarray:
    """Which of j the bins don't exclude. n: sizes of the sets."""
    return ~apart(bits[j], bits[i], n[j] + n[i], per_cent)


def outside(label: np.ndarray) -> np.ndarray:
    """Rows that aren't of the most frequent label."""
    names, k = np.unique(label, return_counts=True)
    return np.flatnonzero(label != names[np.argmax(k)])


def pairs_of(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows of each group, the earlier row first."""
    row = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
    after = np.repeat(start + size, size) - row - 1
    i = np.repeat(row, after)
    return i, i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(after) - after, after)


def alive(entries: DataFrame, per_cent: int) -> DataFrame:
    """What the bins leave to compare of entries (band, h, label, n, bits): pairs of lines of other label where a band has few
    of them, as (h, other); else the lines of the band that have such a partner, as (h, label, band). Either way a band of n
    lines gives 2 n rows at most. The pairs of small bands are compared together.
    """

    def run_group(x: pa.RecordBatch, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        band, h, label, n = (x.column(i).to_numpy() for i in range(4))
        bits = words_of(x.column(4))
        live = np.zeros(len(h), bool)
        at, size_of = ends[:-1], np.diff(ends)
        more = (size_of > 1) & (np.minimum.reduceat(label, at) != np.maximum.reduceat(label, at)) if len(at) else np.zeros(0, bool)
        small = more & (size_of <= SMALL)
        i, j = pairs_of(at[small], size_of[small])
        other = label[i] != label[j]
        i, j = i[other], j[other]
        kept = ~apart(bits[i], bits[j], n[i] + n[j], per_cent)
        i, j = i[kept], j[kept]
        group = np.searchsorted(at, i, "right") - 1
        many = np.bincount(group, minlength=len(at))[group] > 2 * size_of[group]
        live[i[many]] = live[j[many]] = True
        left, right = [i[~many]], [j[~many]]
        more &= ~small
        for a, b in zip(at[more], ends[1:][more]):
            rows = outside(label[a:b]) + a
            few: list[np.ndarray] | None = []
            size, most = 0, np.ones(b - a, bool)
            most[rows - a] = False
            for i in rows:
                j = np.flatnonzero((label[a:b] != label[i]) & (most | (np.arange(a, b) > i))) + a
                j = j[possible(bits, n, i, j, per_cent)]
                size += len(j)
                if few is not None:
                    few.append(j)
                    if size <= 2 * (b - a):
                        continue
                    for i_, j_ in zip(rows, few):
                        if len(j_):
                            live[j_] = live[i_] = True
                    few = None
                elif len(j):
                    live[j] = live[i] = True
            if few is not None:
                left.append(np.repeat(rows, [len(j) for j in few]).astype(np.int64))
                right += few
        left, right = np.concatenate(left), np.concatenate(right)
        pairs, lines = len(left), int(live.sum())
        none = lambda k: pa.nulls(k, pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(h[left]), pa.array(h[right]), none(pairs), none(pairs)], ["h", "other", "label", "band"])
        yield pa.RecordBatch.from_arrays([pa.array(h[live]), none(lines), pa.array(label[live]), pa.array(band[live])], ["h", "other", "label", "band"])

    return by_band(entries, run_group, "h long, other long, label long, band long")


def compare(lines: list[str], label: np.ndarray, bits: np.ndarray, per_cent: int) -> Iterator[tuple[int, int]]:
    """Pairs of lines of other label that reach the similarity. Their labels become one, so further pairs of them are left out."""
    hashes, count = shingle_hashes(lines)
    code = np.unique(hashes, return_inverse=True)[1]
    codes = int(code.max()) + 1
    of, code = np.divmod(distinct_sorted(np.repeat(np.arange(len(lines)), count) * codes + code), codes)  # a shingle of a line once
    n = np.bincount(of, minlength=len(lines))
    start = np.cumsum(n) - n
    own = np.zeros(codes, np.int8)
    for i in outside(label):
        j = np.flatnonzero(label != label[i])
        j = j[possible(bits, n, i, j, per_cent)]
        mine = code[start[i] : start[i] + n[i]]
        own[mine] = 1
        while len(j):
            take = max(1, int(np.searchsorted(np.cumsum(n[j]), COMPARED)))
            some, j = j[:take], j[take:]
            before = np.cumsum(n[some]) - n[some]
            place = np.repeat(start[some] - before, n[some]) + np.arange(n[some].sum())
            same = np.add.reduceat(own[code[place]], before, dtype=np.int64)
            for k in some[100 * same >= per_cent * (n[some] + n[i] - same)]:
                if label[k] != label[i]:
                    yield i, k
                    label[label == label[k]] = label[i]
            j = j[label[j] != label[i]]
        own[mine] = 0


def united(entries: DataFrame, per_cent: int) -> DataFrame:
    """Links (a, b) between lines of other label, on whole shingle sets. entries: (band, h, label, bits, line).

    Within a band, labels that a link has united count as one, so that a band of n lines gives n - 1 links at most. A band
    with more text than a task should hold as sets is compared part by part.
    """

    def run_group(x: pa.RecordBatch, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        h, label = (x.column(i).to_numpy() for i in (1, 2))
        bits = words_of(x.column(3))
        left, right = [], []
        for a, b in zip(ends[:-1], ends[1:]):
            lines, own = x.column(4).slice(a, b - a).to_pylist(), label[a:b].copy()
            part = np.cumsum([len(y) for y in lines]) // COMPARED
            parts = [np.flatnonzero(part == k) for k in np.unique(part)]
            for p, first in enumerate(parts):
                for second in parts[p:] if p == len(parts) - 1 else parts[p + 1 :]:
                    at = first if second is first else np.concatenate([first, second])
                    some = own[at]
                    for i, k in compare([lines[y] for y in at], some, bits[a + at], per_cent):
                        left.append(h[a + at[i]])
                        right.append(h[a + at[k]])
                        own[own == own[at[k]]] = own[at[i]]
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return by_band(entries, run_group, "a long, b long")


def links_of(docs: DataFrame, entries: DataFrame, ids: DataFrame, n: int, per_cent: int, s: Scratch) -> DataFrame:
    """Links between lines alike that share a band, enough of them to unite all such lines. entries: (band, h, lead) of n lines, ids."""
    texts = texts_of(docs, ids, n, s)
    # most bands, at most sixteen, then the leader, as one number, which aggregates without sorting
    order = F.shiftleft("k", 58) + F.shiftright("lead", 6)
    best = entries.filter("h <> lead").groupBy("h", "lead").agg(F.count("*").alias("k")).groupBy(F.col("h").alias("a")).agg(F.max_by("lead", order).alias("b"))
    stars = s.table(verified(texts, best, per_cent), "stars", n)
    label = stars
    for _ in range(DOUBLINGS):
        up = label.select(F.col("a").alias("b"), F.col("b").alias("c"))
        label = label.join(up, "b", "left").select("a", F.coalesce("c", "b").alias("b"))
    label = label.select(F.col("a").alias("h"), F.col("b").alias("label"))
    # the last leader, who has none, keeps its own label
    named = entries.select("band", "h").join(label.hint("shuffle_hash"), "h", "left").join(texts.select("h", "n", "bits").hint("shuffle_hash"), "h").select("band", "h", F.coalesce("label", "h").alias("label"), "n", "bits")
    left = s.table(alive(named, per_cent), "alive", n)
    pairs = left.filter("other is not null").select(F.least("h", "other").alias("a"), F.greatest("h", "other").alias("b")).distinct()
    bands = left.filter("other is null").join(texts, "h").select("band", "h", "label", "bits", "line")
    return stars.unionByName(verified(texts, pairs, per_cent)).unionByName(united(bands, per_cent))


def dropped_lines(spark: SparkSession, docs: DataFrame, per_cent: int = PER_CENT, scratch: Scratch | None = None) -> DataFrame:
    """docs: id, key, text. Per document with lines to drop: key, and their places in order; scratch: holds this result."""
    small_batches(spark)
    s = Scratch(spark, "line-dedup")
    buckets = FINE * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = s.table(met(packed(docs, buckets)), "met", dealt=True)
    entries = rows.filter("kind = 1").select("band", "h", "lead")
    ids = s.table(entries.select("h").distinct(), "ids")
    n = ids.count()
    whole = components(links_of(docs, entries, ids, n, per_cent, s), s, rows=n).withColumnRenamed("node", "h")
    place = F.struct("has", "id", "key", "at")
    linked = s.keep(rows.filter("kind = 0").join(whole, "h").select("component", place.alias("place")), n)
    first = linked.groupBy("component").agg(F.min("place").alias("first"))
    gone = linked.join(first, "component").filter("place <> first").select("place.key", "place.at")
    gone = gone.unionByName(rows.filter("kind = 2").select("key", "at"))
    out = (scratch or Scratch(spark, "line-dedup")).table(gone.groupBy("key").agg(F.sort_array(F.collect_set("at")).alias("gone")), "gone", n)
    s.clear()
    return out


def dedup_lines(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", per_cent: int = PER_CENT, count: str = "_line_count", drops: str = "_line_drops", scratch: Scratch | None = None) -> DataFrame:
    """All columns of docs, with the text without dropped lines, and the count and the drops of lines that aren't blank."""
    docs = docs.drop(count, drops)
    key = lambda: key_of(F.col(doc_id).cast("long"), F.col(text))
    gone = dropped_lines(spark, docs.select(F.col(doc_id).cast("long").alias("id"), key().alias("key"), F.col(text).alias("text")), per_cent, scratch)
    own = f"_{uuid.uuid4().hex}"
    names = docs.columns
    lost_of = gone.select(F.col("key").alias(own), F.col("gone").alias(f"{own}_gone")).hint("shuffle_hash")  # a row for each key, so that texts needn't be sorted
    out = docs.withColumn(own, key()).join(lost_of, own, "left").select(*(f"`{c}`" for c in names), f"{own}_gone")
    at = names.index(text)
    schema = docs.schema.add(count, "long").add(drops, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, lost = [], [], []
            for t, g in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist()):
                lines = (t or "").split("\n")
                counts.append(sum(1 for x in lines if x.strip(WHITE)))
                lost.append(len(g or ()))
                if g:
                    places = set(g)
                    t = "\n".join(x for i, x in enumerate(lines) if i not in places)
                texts.append(t)
            cols = [batch.column(i) for i in range(len(names))]
            cols[at] = pa.array(texts, cols[at].type)
            yield pa.RecordBatch.from_arrays([*cols, pa.array(counts, pa.int64()), pa.array(lost, pa.int64())], [*names, count, drops])

    return out.mapInArrow(trimmed(run), schema)
