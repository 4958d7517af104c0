"""Conversation trie, media columns and collocations against brute force, on hard rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from karyolytics.llm import collocations, conversation_trie, media, queries

RND = random.Random(11)


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


# conversations


def trie_brute(rows):
    turns = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            turns[c].append(((t is not None, t or 0), (r or "", x or "")))
    turns = {c: [x for _, x in sorted(v)] for c, v in turns.items()}
    built = {c: turns.get(c - c % 100, [])[: (h := zlib.crc32(str(c).encode()) % 6)] + turns[c][h:] for c in turns}
    nodes = collections.defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            nodes[tuple(v[:d])].append(c)
    kids = collections.Counter(k[:-1] for k in nodes if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in nodes.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
    ends = lambda k: hashlib.sha256(",".join(map(str, sorted(c for c in nodes[k] if len(built[c]) == len(k)))).encode()).hexdigest()
    return sorted(((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k], ends(k)) for k, m in nodes.items()), key=str)


NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
CONVERSATIONS = {
    "hard": [(100 + i, t, RND.choice(["user", None, ""]), RND.choice(["a", "b", None, "", "é\U0001f600"])) for i in range(120) for t in [None, *range(RND.randrange(6))]] + [(None, 1, "user", "lost"), (4017, 3, "user", "no base")],
    "copies": [(200 + i, t, "user", f"x{t}") for i in range(60) for t in range(9)],
    "deep": [(301, t, "user", "t" * (t % 3)) for t in range(300)] + [(303, t, "user", "t" * (t % 3) if t != 150 else "fork") for t in range(200)],
    "repeated": [(1, 1, "user", "a")] * 3 + [(2, 1, "user", "a")] * 2 + [(3, None, "user", "a")],
    "turnless": [(c, 0, "u", "x") for c in range(901, 940)],
    "comb": [(1000 + i, t, "u", "end" if t == i + 6 else "go") for i in range(30) for t in range(i + 7)],
}


@pytest.mark.parametrize("name", list(CONVERSATIONS))
def test_trie(spark, tmp_path, name):
    rows = CONVERSATIONS[name]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    df = df.withColumn("key", df["turn"]).withColumn("depth", df["turn"])
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op11_conversation_trie(spark, str(tmp_path))
    assert rows_of(got, *NODE) == trie_brute(rows)


def test_trie_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.op11_conversation_trie(spark, str(tmp_path)).collect() == []


# media

TEXTS = [(1, None), (2, ""), (3, "a" * 191), (4, "a" * 192), (5, "a" * 193), (6, "é漢\U0001f600" * 500), (7, "x" * 300_000), (7, "x" * 300_000), (None, "a" * 192), (8, "b\n" * 70_000)]


def test_media_keeps_texts(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string").repartition(2)
    docs = docs.withColumn("height", docs["doc_id"]).withColumn("id", docs["doc_id"]).withColumn("media", docs["doc_id"])
    got = media.stored_texts(spark, docs).collect()
    want = []
    for i, t in TEXTS:
        data = (t or "").encode()
        full = data + b" " * (-len(data) % 192 or 192 * (not data))
        want.append((i, len(data), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-16:])))
    assert sorted(((r.id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got), key=str) == sorted(want, key=str)
    by = collections.defaultdict(set)
    for r in got:
        by[r.payload_sha256].add((r.media_bytes, r.media_sha256, r.feature))
    assert all(len(v) == 1 for v in by.values())
    assert media.stored_texts(spark, docs.limit(0)).collect() == []


def slow_sums(grey, h, w):
    """Each sample cut into h * w equal parts, added up part by part."""
    fine = np.repeat(np.repeat(grey.astype(np.int64), h, 0), w, 1)
    return fine.reshape(h, grey.shape[0], w, grey.shape[1]).sum((1, 3))


@pytest.mark.parametrize("shape", [(1, 1), (3, 5), (8, 9), (17, 64), (100, 7)])
def test_area_resize(shape):
    grey = np.random.default_rng(3).integers(0, 256, shape)
    assert (media.area_sums(grey, 8, 9) == slow_sums(grey, 8, 9)).all()
    samples = grey[:, :, None].astype(np.uint8)
    assert (media.resized(samples, 4, 3)[:, :, 0] == slow_sums(grey, 4, 3) // (shape[0] * shape[1])).all()
    cells = slow_sums(grey, 8, 9)
    bits = "".join(str(int(a < b)) for row in cells.tolist() for a, b in zip(row, row[1:]))
    assert media.difference_hash(samples) == f"{int(bits, 2):016x}"


def test_netpbm_forms():
    grey = np.arange(12, dtype=np.uint8).reshape(3, 4, 1)
    colour = np.arange(36, dtype=np.uint8).reshape(3, 4, 3)
    text = lambda a: " ".join(map(str, a.ravel().tolist())).encode()
    assert (media.decode(b"P2 # a 9 1\n4 3\n#x\n255\n" + text(grey)) == grey).all()
    assert (media.decode(b"P3\n4\t3 255 " + text(colour)) == colour).all()
    assert (media.decode(b"P5 4 3 255\n" + grey.tobytes()) == grey).all()
    assert (media.decode(media.encode(colour, "ppm")) == colour).all()
    wide = (grey.astype(np.uint16) * 3000).astype(">u2")
    assert (media.decode(b"P5 4 3 65535\n" + wide.tobytes()) == wide).all()
    assert (media.decode(b"P2 4 3 65535\n" + text(wide)) == wide).all()
    bits = np.array([[0, 1, 1], [1, 0, 0]])
    white = 255 * (1 - bits)[:, :, None]
    assert (media.decode(b"P1 3 2\n011\n1 0 0\n") == white).all()
    assert (media.decode(b"P4 3 2\n" + np.packbits(bits, axis=1).tobytes()) == white).all()


@pytest.mark.parametrize("bits", [1, 4, 8, 24, 32])
@pytest.mark.parametrize("down", [False, True])
def test_bmp_forms(bits, down):
    h, w, rng = 5, 7, np.random.default_rng(bits)
    n = lambda x, size=4: int(x).to_bytes(size, "little", signed=x < 0)
    if bits < 24:
        table = rng.integers(0, 256, (1 << bits, 4), dtype=np.uint8)
        index = rng.integers(0, 1 << bits, (h, w))
        want = table[index][:, :, 2::-1]
        rows = np.packbits((index[:, :, None] >> np.arange(bits)[::-1] & 1).reshape(h, -1).astype(np.uint8), axis=1)
        palette = table.tobytes()
    else:
        c = bits // 8
        want, palette = rng.integers(0, 256, (h, w, c), dtype=np.uint8), b""
        rows = want[:, :, [2, 1, 0, 3][:c]].reshape(h, -1)
    full = np.zeros((h, (w * bits + 31) // 32 * 4), np.uint8)
    full[:, : rows.shape[1]] = rows
    data = b"BM" + n(0) * 2 + n(54 + len(palette)) + n(40) + n(w) + n(-h if down else h) + n(1, 2) + n(bits, 2) + n(0) * 6 + palette + (full if down else full[::-1]).tobytes()
    assert (media.decode(data) == want).all()
    if bits == 24:
        assert (media.decode(media.encode(want, "bmp")) == want).all()


def test_media_columns(spark):
    image = np.random.default_rng(1).integers(0, 256, (600, 3, 3), dtype=np.uint8)
    rows = [(1, bytearray(media.encode(image, "bmp"))), (2, None), (3, bytearray(b"P6 5 5 255\nshort")), (4, bytearray(b"GIF89a")), (5, bytearray(b"P5 0 0 255\n")), (6, bytearray(b"BM"))]
    df = spark.createDataFrame(rows, "height long, media binary")
    got = {r["_height"]: r for r in media.media_columns(df, tile=256).collect()}
    assert [t[:6] for t in got[1].tiles] == [b"\x93NUMPY"] * 3 and (media.from_tiles(got[1].tiles) == image).all()
    assert (got[1].height, got[1].width, got[1].channels, got[1].error) == (600, 3, 3, None)
    assert all(got[i].tiles is None and got[i].error for i in (2, 3, 4, 6))
    assert got[5].tiles == [] and got[5].dhash == "0" * 16


# collocations


def phrases_brute(rows, least, top):
    out = []
    texts = collections.defaultdict(list)
    for lang, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        texts["und" if lang is None else lang] += [re.findall("[^ \t]+", p) for p in re.split("[.,;:!?\n\x0b\x0c\r]", low)]
    for lang, pieces in texts.items():
        f = collections.Counter(tuple(p[i : i + k]) for p in pieces for k in (1, 2, 3) for i in range(len(p) - k + 1))
        n = sum(v for k, v in f.items() if len(k) == 1)
        cand = [k for k, v in f.items() if len(k) > 1 and v >= least]
        scored = []
        for p in cand:
            a = f[p]
            if any(len(q) > len(p) and 100 * f[q] >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q in cand):
                continue
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, l, r = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), l, r))
        for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, i, p.decode(), -a, l, r, n, -s))
    return sorted(out, key=str)


PHRASE = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
SMALL = ["aa", "B", "cc", "é", "x\x0by"]
CORPUS = [(RND.choice(["en", "de", None, "und", ""]), "".join(RND.choice(SMALL) + RND.choice([" ", " ", "\t", "  ", ". ", "\r", ";"]) for _ in range(RND.randrange(40)))) for _ in range(300)] + [("en", None), ("en", ""), (None, " .. "), ("en", "a a a a a a a a a a a a a"), ("en", "same row here") ] + [("de", "same row here")] * 12


@pytest.mark.parametrize("block", [8 << 20, 400])
def test_collocations(spark, monkeypatch, block):
    monkeypatch.setattr(collocations, "BLOCK", block)
    df = spark.createDataFrame(CORPUS, "lang string, text string").repartition(3)
    df = df.withColumn("block", df["lang"]).withColumn("id", df["lang"]).withColumn("n", df["lang"])
    for least, top in ((10, 2000), (3, 4)):
        assert rows_of(collocations.collocations(spark, df, least=least, top=top), *PHRASE) == phrases_brute(CORPUS, least, top)
    assert collocations.collocations(spark, df.limit(0)).collect() == []


def test_long_texts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK", 50)
    import pyarrow as pa

    text = "".join(RND.choice(["one two", "three", "a b c d", "é" * 40]) + RND.choice([". ", "\n"]) for _ in range(100))
    *parts, last = [p.to_pylist() for p in collocations.portions(pa.array(["short", text, "", "end"]))]
    assert "".join(p for (p,) in parts) == text and last == ["short", "", "end"]
    assert len(parts) > 20 and all(p.rstrip(" ")[-1:] in ".\n" for (p,) in parts)


def test_scores_are_exact(spark):
    df = spark.createDataFrame([(999_999_999_999, 1_000_000_000_007, 999_999_999_999_983)], "a long, l long, r long")
    (got,) = df.select(collocations.score("a", "l", "r")).first()
    assert got == 1_000_000 * 999_999_999_999**2 // (1_000_000_000_007 * 999_999_999_999_983)
