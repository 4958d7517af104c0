"""Quality rules by weak supervision.

Each rule reads counts of a text and votes good (1), bad (-1) or abstains (0). The votes of all documents are summed up
by vote pattern, at most 3^rules of them, and expectation-maximisation over the patterns estimates the share of good
documents and how often each rule is right where it votes. Limits are shares that hold for texts of every size. A document is kept if the posterior
probability that it is good reaches a threshold; no single rule rejects it, save the base limits of the contract.

Counts are DataFrame expressions only: no Python runs on executors. The driver sees vote patterns and their counts.

Cases: a null or empty text has no words and fails the base limits; a text of one word has no word windows; repeated rows
count as many times as they occur; an empty table gives an empty result; columns with the names of features are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE, WHITE_CLASS, Scratch

SYMBOLS = "#*$%&|<>"
#: Positions take the low bits of a sort key, hashes the others.
POSITION_BITS = 28


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the counts of each text as columns f_*; keeps the others."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumn("f_trim", F.btrim(t, F.lit(WHITE)))
    df = df.withColumn("f_words", F.when(F.col("f_trim") == "", F.array().cast("array<string>")).otherwise(F.split("f_trim", WHITE_CLASS + "+")))
    n = F.size("f_words")
    df = df.withColumn("f_n", n.cast("long"))
    windows = F.transform(F.slice("f_words", 1, F.greatest(F.col("f_n").cast("int") - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get("f_words", i + 1), F.get("f_words", i + 2)))
    df = df.withColumn("f_hash", windows)
    # sort keys: the hash's high bits, then the place; equal windows are neighbours, and their whole hashes are compared
    low = F.lit((1 << POSITION_BITS) - 1)
    key = F.sort_array(F.transform("f_hash", lambda h, i: h.bitwiseAND(F.lit(-1 << POSITION_BITS)).bitwiseOR(i.cast("long"))))
    df = df.withColumn("f_key", F.when(F.size(F.array_distinct("f_hash")) == F.size("f_hash"), F.array().cast("array<bigint>")).otherwise(key))
    whole = lambda k: F.get("f_hash", k.bitwiseAND(low).cast("int"))
    again = F.filter("f_key", lambda k, i: F.coalesce(whole(F.get("f_key", i - 1)) == whole(k), F.lit(False)) | F.coalesce(whole(F.get("f_key", i + 1)) == whole(k), F.lit(False)))
    df = df.withColumn("f_at", F.sort_array(F.transform(again, lambda k: k.bitwiseAND(low))))
    covered = F.aggregate(F.transform("f_at", lambda p, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get("f_at", i + 1) - p, F.lit(3).cast("long")))), F.lit(0).cast("long"), lambda a, x: a + x)
    df = df.withColumn("f_repeat_words", covered)
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    df = df.withColumn("f_lines", lines)
    bare = F.regexp_replace("f_trim", WHITE_CLASS + "+", "")
    df = df.withColumn("f_word_chars", F.length(bare).cast("long"))
    count = lambda chars: (F.length(t) - F.length(F.translate(t, chars, ""))).cast("long")
    return (
        df.withColumn("f_symbols", count(SYMBOLS))
        .withColumn("f_n_lines", F.size("f_lines").cast("long"))
        .withColumn("f_dup_lines", (F.size("f_lines") - F.size(F.array_distinct("f_lines"))).cast("long"))
        .withColumn("f_upper", (F.length(t) - F.length(F.regexp_replace(t, "\\p{Lu}+", ""))).cast("long"))
        .withColumn("f_stops", (F.length("f_trim") - F.length(F.translate("f_trim", ".?!", ""))).cast("long"))
        .withColumn("f_bars", (F.length("f_trim") - F.length(F.translate("f_trim", "|", ""))).cast("long"))
        .withColumn("f_others", (F.length(bare) - F.length(F.regexp_replace(bare, "[^\\p{L}\\p{M}.,;:'-]+", ""))).cast("long"))  # neither letters nor plain punctuation
        .drop("f_trim", "f_words", "f_hash", "f_key", "f_at", "f_lines")
    )


def base_failed(n: Column, repeats: Column) -> Column:
    return (n < 50) | (100 * repeats > 50 * n)


def rules() -> dict[str, Column]:
    """Votes of each rule, from the counts. Most rules know one defect and abstain without it; one knows plain prose."""
    n, c, lines = F.col("f_n"), F.col("f_word_chars"), F.col("f_n_lines")
    stops, symbols, upper, bars, repeats, others = (F.col(f"f_{x}") for x in ("stops", "symbols", "upper", "bars", "repeat_words", "others"))
    bad = lambda x: F.when(x, -1).otherwise(0)
    prose = (n >= 50) & (100 * symbols <= n) & (100 * others <= 10 * c) & (10 * upper <= 2 * c) & (200 * stops >= n) & (3 * stops <= n)
    return {
        "prose": F.when(prose, 1).otherwise(0),
        "letters": bad(100 * others > 15 * c),
        "symbols": bad(10 * symbols > n),
        "word_length": bad((c > 14 * n) | (c < 2 * n)),
        "dup_lines": bad((lines >= 4) & (10 * F.col("f_dup_lines") > 3 * lines)),
        "repeats": bad(100 * repeats > 40 * n),
        "case": bad(10 * upper > 4 * c),
        "shouting": bad(2 * stops > n),
        "unpunctuated": bad((n >= 50) & (200 * stops < n)),
        "bars": bad(10 * bars > n),
    }


def fit(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 100, tolerance: float = 1e-6) -> tuple[float, list[float]]:
    """Share of good texts and each rule's accuracy where it votes, by expectation-maximisation from the rules' majority.

    Votes count as independent given the class; abstaining says nothing. Accuracies stay within 0.6 and 0.999, the share
    within 0.5 and 0.99, so that no rule is turned around. Rules without votes get accuracy 0.6.
    """
    if not patterns:
        return 0.5, []
    k, share, accuracy = len(patterns[0][0]), 0.5, []
    post = [1 / (1 + math.exp(-sum(p))) for p, _ in patterns]
    for _ in range(rounds):
        old = (share, accuracy)
        share = min(0.99, max(0.5, sum(w * q for (_, w), q in zip(patterns, post)) / sum(w for _, w in patterns)))
        accuracy = []
        for r in range(k):
            votes = sum(w for p, w in patterns if p[r])
            right = sum(w * (q if p[r] > 0 else 1 - q) for (p, w), q in zip(patterns, post) if p[r])
            accuracy.append(min(0.999, max(0.6, (right + 1) / (votes + 2))))
        post = [1 / (1 + math.exp(-odds(p, share, accuracy))) for p, _ in patterns]
        if old[1] and max(abs(a - b) for a, b in zip([share, *accuracy], [old[0], *old[1]])) < tolerance:
            break
    return share, accuracy


def odds(votes: tuple[int, ...], share: float, accuracy: list[float]) -> float:
    """Log odds that a text with these votes is good."""
    return math.log(share / (1 - share)) + sum(v * math.log(a / (1 - a)) for v, a in zip(votes, accuracy))


def assess(spark: SparkSession, docs: DataFrame, text: str = "text", threshold: float = 0.5, scratch: Scratch | None = None) -> DataFrame:
    """Keeps the rows' columns and adds f_* counts, votes, base_failed, posterior and kept; own columns of these names are replaced."""
    scratch = scratch or Scratch(spark, "quality")
    named = rules()
    names = [f"vote_{k}" for k in named]
    df = features(docs, text)
    df = df.withColumns({f"vote_{k}": v for k, v in named.items()}).withColumn("base_failed", base_failed(F.col("f_n"), F.col("f_repeat_words")))
    df = scratch.table(df, "votes")
    patterns = [(tuple(r[n] for n in names), r["n"]) for r in df.groupBy(*names).agg(F.count("*").alias("n")).orderBy(*names).collect()]  # at most 3^rules rows
    share, accuracy = fit(patterns)
    log_odds = F.lit(math.log(share / (1 - share)))
    for name, a in zip(names, accuracy):
        log_odds = log_odds + F.col(name) * math.log(a / (1 - a))
    df = df.withColumn("posterior", 1 / (1 + F.exp(-log_odds)))
    return df.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
