"""Bins of lines exclude no link, and lines lose the white space at their ends, whatever else is taken with them."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from karyolytics.llm import line_dedup
from karyolytics.llm.common import WHITE

RND = random.Random(11)
LINES = ["".join(RND.choices("abcdefgh é\U0001f600", k=RND.randint(1, 200))) for _ in range(40)]


@pytest.mark.parametrize("beside", [0, 3, 100, 3000])
def test_bins_stand_alone(beside):
    """A line's bins are compared with those of lines that were taken with more or fewer others."""
    n, got = line_dedup.bins(LINES + ["x" * 7] * beside)
    for i, line in enumerate(LINES):
        alone = line_dedup.bins([line])
        assert alone[0][0] == n[i] and alone[1][0] == got[i]


def test_links_of_few_and_many():
    """Two lines alike whose bins come from tasks of few and of many lines are not apart."""
    x, y = (line_dedup.bins([line] + ["y" * 9] * k) for line, k in ((LINES[0] * 2 + "a", 1), (LINES[0] * 2 + "b", 2000)))
    bits = [np.frombuffer(z[1][0], np.uint64)[None] for z in (x, y)]
    assert not line_dedup.apart(*bits, x[0][:1] + y[0][:1], line_dedup.PER_CENT).any()


def test_small_and_large_bands(spark):
    """Bands whose pairs are compared together, and those that are compared row by row, leave what brute force leaves."""
    rows, lines = [], []
    for band in range(60):
        base = "".join(RND.choices("abcdefghijklmnopqrstuvwxyz", k=90))
        for _ in range(RND.randint(1, 30) if band else line_dedup.SMALL + 20):
            x = base if RND.random() < 0.6 else "".join(RND.choices("abcdefghijklmnopqrstuvwxyz", k=90))
            i = RND.randrange(90)
            lines.append(x[:i] + RND.choice("0123456789") + x[i + 1 :])
            rows.append((band, len(rows), RND.randint(0, 3)))
    n, bits = line_dedup.bins(lines)
    df = spark.createDataFrame([(*r, int(k), b) for r, k, b in zip(rows, n, bits)], "band long, h long, label long, n long, bits binary")

    left = line_dedup.alive(df, line_dedup.PER_CENT).collect()
    together = {(min(r.h, r.other), max(r.h, r.other)) if r.other is not None else (r.h, r.label, -1 - r.band) for r in left}
    assert len(together) == len(left) and {len(x) for x in together} == {2, 3}
    per_band = {}
    for band, h, label in rows:
        per_band.setdefault(band, []).append((h, label))
    want = set()
    for band, own in per_band.items():
        pairs = [(a, b) for i, (a, la) in enumerate(own) for b, lb in own[i + 1 :] if la != lb and 180 * np.bitwise_count(np.frombuffer(bits[a], np.uint64) ^ np.frombuffer(bits[b], np.uint64)).sum() <= 20 * (n[a] + n[b])]
        if len(pairs) <= 2 * len(own):
            want |= set(pairs)
        else:
            want |= {(h, label, -1 - band) for h, label in own if any(h in p for p in pairs)}
    assert together == want


def test_white_space_at_ends(spark):
    rows = ["".join(RND.choices("ab \t\r\x0b\x0c\x1f é", k=RND.randint(0, 6))) for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in rows], "line string").select("line", line_dedup.bare(F.col("line")).alias("bare"))
    assert all(r.bare == r.line.strip(WHITE) for r in df.collect())


def test_crowded_holds_all_that_repeat():
    x = np.array([RND.randrange(-1 << 63, 1 << 63) for _ in range(5000)] + [5, 5, -1, -1, -1 << 63, -1 << 63], np.int64)
    got = x[line_dedup.crowded(x)]
    assert {5, -1, -1 << 63} <= set(got.tolist()) and len(got) < 3500
    assert len(line_dedup.crowded(x[:0])) == 0
