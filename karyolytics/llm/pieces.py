"""Splits texts into the pieces of a byte-level BPE pattern, in arrays, and looks up each distinct piece once a chunk.

``Pieces`` follows public_tokenizers.PATTERN: contractions, words, numbers and other signs with at most one blank before
them, and white space, of which the last character before a sign stands alone or joins the sign. Runs of one character
class bound the pieces, so a chunk of many texts is split by a few array operations. Long texts are cut into chunks only
between a letter and a blank, which always bound a piece.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np

OTHER, LETTER, NUMBER, SPACE, BREAK = range(5)
#: Code points with the Unicode property White_Space.
WHITE_SPACE = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CHUNK = 1 << 20
CACHE = 150_000


@cache
def classes() -> np.ndarray:
    """Class of each code point."""
    out = np.zeros(0x110000, np.uint8)
    for cp in range(0x110000):
        if (k := unicodedata.category(chr(cp))[0]) == "L":
            out[cp] = LETTER
        elif k == "N":
            out[cp] = NUMBER
    out[WHITE_SPACE] = SPACE
    return out


def chunks(texts: list[str]) -> Iterator[list[tuple[int, str]]]:
    """Lists of (index of the text, part of it) of about CHUNK code points; a text's parts stay in order."""
    now, size = [], 0
    for i, t in enumerate(texts):
        at = 0
        while True:
            cut = len(t)
            if cut - at > CHUNK:
                cut = t.find(" ", at + CHUNK)
                while cut > 0 and not unicodedata.category(t[cut - 1]).startswith("L"):
                    cut = t.find(" ", cut + 1)
                cut = len(t) if cut < 0 else cut
            now.append((i, t[at:cut]))
            size += cut - at
            at = cut
            if size >= CHUNK:
                yield now
                now, size = [], 0
            if at >= len(t):
                break
    if now:
        yield now


def split(parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, str]:
    """Starts and ends of all pieces in the joined text, the part of each, and the joined text."""
    joined = "\0".join(parts) + "\0"
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lens = np.fromiter(map(len, parts), np.int64, len(parts))
    breaks = np.cumsum(lens + 1) - 1
    cls = classes()[cp]
    cls[breaks] = BREAK
    n = len(cp)
    first = np.empty(n, bool)
    first[0] = True
    np.not_equal(cls[1:], cls[:-1], out=first[1:])
    first[breaks] = True
    first[breaks[:-1] + 1] = True
    start = first.copy()
    run = np.flatnonzero(first)
    sign = run[cls[run] < SPACE]
    after = sign[(sign > 0)]
    after = after[cls[after - 1] == SPACE]
    start[after - 1] = True
    start[after[cp[after - 1] == 0x20]] = False
    quote = sign[(cp[sign] == 0x27) & start[sign]]
    quote = quote[cls[quote + 1] == LETTER]  # a break follows the last sign, so +1 exists
    if len(quote):
        c1 = cp[quote + 1]
        c2 = cp[np.minimum(quote + 2, n - 1)]
        short = np.isin(c1, [ord(c) for c in "stmd"])
        long = ((c2 == ord("e")) & ((c1 == ord("r")) | (c1 == ord("v")))) | ((c1 == ord("l")) & (c2 == ord("l")))
        for hit, k in ((quote[short], 2), (quote[long & ~short], 3)):
            start[hit + 1] = False
            start[hit + k] = True
    at = np.flatnonzero(start)
    end = np.append(at[1:], n)
    real = cls[at] != BREAK
    at, end = at[real], end[real]
    return at, end, np.searchsorted(breaks, at), joined


def keys(cp: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each piece; it only groups the pieces of one chunk."""
    lens = end - at
    total = int(lens.sum())
    place = np.arange(total) - np.repeat(np.cumsum(lens) - lens, lens)
    x = cp[np.repeat(at, lens) + place].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    longest = int(lens.max())
    power = np.full(longest, 0x94D049BB133111EB, np.uint64)
    power[0] = 1
    x *= np.cumprod(power)[place]
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return np.add.reduceat(x, np.cumsum(lens) - lens) + lens.astype(np.uint64)


class Encoder:
    """Ids of whole texts from a function that encodes pieces; keeps up to CACHE pieces and those of a chunk."""

    def __init__(self, encode_pieces: Callable[[list[str]], list[list[int]]]):
        self.encode_pieces, self.cache = encode_pieces, {}

    def ids_of(self, pieces: list[str]) -> list[list[int]]:
        out = [self.cache.get(p) for p in pieces]
        fresh = [i for i, got in enumerate(out) if got is None]
        if len(self.cache) >= CACHE:
            self.cache.clear()
        if fresh:
            for i, got in zip(fresh, self.encode_pieces([pieces[i] for i in fresh])):
                out[i] = got
                if len(pieces[i]) <= 64:
                    self.cache[pieces[i]] = got
        return out

    def encode(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray]]:
        """(index, ids) in order; a long text gives several."""
        for chunk in chunks(texts):
            at, end, part, joined = split([t for _, t in chunk])
            if not len(at):
                for i, _ in chunk:
                    yield i, np.zeros(0, np.uint32)
                continue
            cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
            _, one, which = np.unique(keys(cp, at, end), return_index=True, return_inverse=True)
            found = self.ids_of([joined[a:b] for a, b in zip(at[one].tolist(), end[one].tolist())])
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter((x for f in found for x in f), np.uint32, int(sizes.sum()))
            offset = np.cumsum(sizes) - sizes
            count = sizes[which]
            ends = np.cumsum(count)
            ids = flat[np.arange(int(ends[-1])) + np.repeat(offset[which] - (ends - count), count)]
            bounds = np.append(0, ends)[np.searchsorted(part, np.arange(len(chunk) + 1))]
            for (i, _), a, b in zip(chunk, bounds[:-1].tolist(), bounds[1:].tolist()):
                yield i, ids[a:b]

    def whole(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text."""
        now, held = -1, []
        for i, ids in self.encode(texts):
            if i != now and held:
                yield held[0] if len(held) == 1 else np.concatenate(held)
                held = []
            now = i
            held.append(ids)
        if held:
            yield held[0] if len(held) == 1 else np.concatenate(held)
