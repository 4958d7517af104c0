"""Byte-level BPE by prefix dynamic programming.

A sequence of tokens is the encoding of its bytes exactly if each two neighbours are the encoding of theirs, and every
prefix of a text has one encoding, so one last token. ``Prefixes`` stores that token for each prefix: of the tokens that
end there, the one whose pair with the last token before it is valid. Appending bytes adds entries and changes none;
an edit keeps the entries before it and recomputes from there until the entries of a whole token length agree with the
old ones again.

``encode_documents`` applies it to each distinct piece of whole texts and decodes the ids again. Short pieces are taken many
at a time by ``last_tokens``: the same programme in arrays, one prefix length of all pieces after the other.

Cases: null counts as empty and gives no ids; bytes are encoded whatever they are; a text of one long piece takes time
linear in its length; repeated rows each give a row; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import Encoder

PAIRS = 2_000_000
#: Pieces of more bytes go through ``Prefixes`` one by one.
SHORT = 64


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Vocabulary:
    """Ranks with what the dynamic programme needs: the tokens that can end a prefix, and which pairs are valid."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.pairs: dict[int, bool] = {}
        self.lengths: dict[int, list[int]] = {}
        for b in ranks:
            self.lengths.setdefault(b[-1], set()).add(len(b))
        self.lengths = {k: sorted(v, reverse=True) for k, v in self.lengths.items()}
        self.size = np.zeros(max(self.bytes_of) + 1, np.int64)
        self.size[list(self.bytes_of)] = [len(b) for b in self.bytes_of.values()]
        node, steps = {b"": 0}, []  # the tokens as a trie: a step is node * 256 + byte, in order
        for b in ranks:
            for k in range(1, len(b) + 1):
                if b[:k] not in node:
                    node[b[:k]] = len(node)
                    steps.append((node[b[: k - 1]] << 8 | b[k - 1], node[b[:k]]))
        self.steps, self.to = (np.array(x, np.int64) for x in zip(*sorted(steps)))
        self.token = np.full(len(node), -1, np.int64)
        self.token[[node[b] for b in ranks]] = list(ranks.values())

    def merge(self, data: bytes) -> list[int]:
        """Ids of a few bytes by merging the pair of least rank while there is one; for pairs of tokens only."""
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = min((ranks.get(a + b, 1 << 62), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best == 1 << 62:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def follows(self, left: int, right: int) -> bool:
        """Whether the two tokens are the encoding of their bytes."""
        key = left << 32 | right
        if (got := self.pairs.get(key)) is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            got = self.pairs[key] = self.merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        return got


class Prefixes:
    """The bytes so far and, for each prefix but the empty one, its last token."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.v, self.data, self.last = vocabulary, bytearray(), [-1]
        self.append(data)

    def token_at(self, end: int) -> int:
        v, last, data = self.v, self.last, self.data
        for n in v.lengths.get(data[end - 1], ()):
            if n <= end and (t := v.ranks.get(bytes(data[end - n : end]))) is not None:
                before = last[end - n]
                if before < 0 or v.follows(before, t):
                    return t
        raise ValueError("the vocabulary lacks a byte")

    def append(self, data: bytes) -> None:
        for b in data:
            self.data.append(b)
            self.last.append(self.token_at(len(self.data)))

    def replace(self, start: int, end: int, data: bytes) -> int:
        """Puts data in place of [start, end); returns how many prefixes were computed anew."""
        old, tail = self.last[end + 1 :], bytes(self.data[end:])
        del self.data[start:], self.last[start + 1 :]
        self.append(data)
        done, same = len(data), 0
        for i, b in enumerate(tail):
            self.data.append(b)
            self.last.append(self.token_at(len(self.data)))
            done += 1
            same = same + 1 if self.last[-1] == old[i] else 0
            if same >= self.v.longest:  # later entries look back no further
                self.data += tail[i + 1 :]
                self.last += old[i + 1 :]
                break
        return done

    def ids(self) -> list[int]:
        out, at = [], len(self.data)
        while at:
            out.append(t := self.last[at])
            at -= len(self.v.bytes_of[t])
        return out[::-1]


def encode_bytes(vocabulary: Vocabulary, data: bytes) -> list[int]:
    """A piece that is a token is that token; others by the dynamic programme."""
    got = vocabulary.ranks.get(data)
    return [got] if got is not None else Prefixes(vocabulary, data).ids()


def last_tokens(v: Vocabulary, data: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """For each byte of many pieces, which lie one behind the other, the last token of the prefix that it ends."""
    n, first = len(data), np.cumsum(lens) - lens
    start = np.repeat(first, lens)
    room = np.repeat(first + lens, lens) - np.arange(n)
    at, node, found = np.arange(n), np.zeros(n, np.int64), []
    depth = 0
    while len(at):
        step = node << 8 | data[at + depth]
        i = np.minimum(np.searchsorted(v.steps, step), len(v.steps) - 1)
        live = v.steps[i] == step
        at, node = at[live], v.to[i[live]]
        token = v.token[node]
        hit = token >= 0
        found.append((at[hit] + depth, at[hit], token[hit]))
        depth += 1
        more = room[at] > depth
        at, node = at[more], node[more]
    end, begin, token = map(np.concatenate, zip(*found))
    order = np.lexsort((begin, end, end - start[end]))  # by prefix length, then the longest token first
    end, begin, token = end[order], begin[order], token[order]
    group = np.flatnonzero(np.append(True, end[1:] != end[:-1]))
    count = np.diff(np.append(group, len(end)))
    if len(group) != n:
        raise ValueError("the vocabulary lacks a byte")
    last = np.empty(n, np.int64)
    bounds = np.append(np.flatnonzero(np.diff(end[group] - start[end[group]], prepend=-1)), n)
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        i, left = group[lo:hi], count[lo:hi]
        while len(i):
            inner = begin[i] > start[begin[i]]
            pair = (last[begin[i[inner]] - 1] << 32) | token[i[inner]]
            one, which = np.unique(pair, return_inverse=True)
            valid = np.ones(len(i), bool)
            valid[inner] = np.fromiter((v.follows(k >> 32, k & 0xFFFFFFFF) for k in one.tolist()), bool, len(one))[which]
            last[end[i[valid]]] = token[i[valid]]
            i, left = i[~valid] + 1, left[~valid] - 1
            if len(left) and not left.all():
                raise ValueError("the vocabulary lacks a byte")
    return last


def encode_short(v: Vocabulary, pieces: list[bytes]) -> list[list[int]]:
    """Ids of pieces that are not empty, from the last tokens of their prefixes."""
    lens = np.fromiter(map(len, pieces), np.int64, len(pieces))
    last = last_tokens(v, np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64), lens)
    ends = np.cumsum(lens)
    of, at, stop, found = np.arange(len(pieces)), ends - 1, ends - lens, []
    while len(of):
        t = last[at]
        found.append((of, t))
        at = at - v.size[t]
        more = at >= stop[of]
        of, at = of[more], at[more]
    of, ids = (np.concatenate(x[::-1]) for x in zip(*found))
    order = np.argsort(of, kind="stable")
    bounds = np.cumsum(np.bincount(of, minlength=len(pieces))).tolist()
    ids = ids[order].tolist()
    return [ids[a:b] for a, b in zip([0, *bounds], bounds)]


def encode_pieces(v: Vocabulary, pieces: list[bytes]) -> list[list[int]]:
    """Ids of each piece: one that is a token is that token; others by the dynamic programme."""
    out = [None if (t := v.ranks.get(p)) is None else [t] for p in pieces]
    short = [i for i, got in enumerate(out) if got is None and 0 < len(pieces[i]) <= SHORT]
    if short:
        for i, ids in zip(short, encode_short(v, [pieces[i] for i in short])):
            out[i] = ids
    return [encode_bytes(v, p) if got is None else got for p, got in zip(pieces, out)]


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(read_ranks(path))


@cache
def encoder(path: str) -> Encoder:
    v = vocabulary(path)
    return Encoder(lambda pieces: encode_pieces(v, [p.encode("utf-8", "replace") for p in pieces]))


SCHEMA = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, number of ids, SHA-256 of the decimal ids joined by blanks and of the bytes decoded from the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, v = encoder(path), vocabulary(path)
        decimal, table = {i: b"%d" % i for i in v.bytes_of}, v.bytes_of
        for batch in batches:
            n, ids_sha, out_sha = [], [], []
            for ids in e.whole([t or "" for t in batch.column(1).to_pylist()]):
                ids = ids.tolist()
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(b" ".join(map(decimal.__getitem__, ids))).hexdigest())
                out_sha.append(hashlib.sha256(b"".join(map(table.__getitem__, ids))).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(out_sha, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(run, SCHEMA)
