"""Edited copies of lines against brute force over plain five-character sets."""

import random

from karyolytics.llm import line_dedup


def shingles(x):
    return {x[i : i + 5] for i in range(max(1, len(x) - 4))}


def edited(rng, x):
    """One changed sign, or one changed word."""
    if rng.random() < 0.5:
        i = rng.randrange(len(x))
        return x[:i] + rng.choice("0123456789") + x[i + 1 :]
    words = x.split(" ")
    words[rng.randrange(len(words))] = "".join(rng.choices("abcdefghij", k=rng.randint(3, 7)))
    return " ".join(words)


def test_edited_lines(spark):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(3000)]
    lines = []
    for _ in range(250):
        x = ""
        while len(x) < rng.randint(40, 140):
            x = f"{x} {rng.choice(vocabulary)}".strip()
        lines += [x, edited(rng, x)]
    assert all(40 <= len(x) <= 155 for x in lines)
    sets = [shingles(x) for x in lines]
    parent = list(range(len(lines)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(lines)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    want = {i for i in range(len(lines)) if root(i) != i}
    assert 150 < len(want) < 250
    rows = line_dedup.dedup_lines(spark, spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect()
    assert {r.doc_id for r in rows if r._line_drops} == want
