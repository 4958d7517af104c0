"""Subgenomes by one-dimensional Gaussian mixtures over identities."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def density(x: float, mean: float, sd: float) -> float:
    sd = max(sd, 1e-8)
    return max(math.exp(-0.5 * ((x - mean) / sd) ** 2) / (sd * math.sqrt(2 * math.pi)), 1e-300)


def fit(xs: list[float], k: int, rounds: int = 100, tolerance: float = 1e-6) -> tuple[list[float], list[float], list[float], float]:
    """Means, deviations, weights and log-likelihood of k components, from quantile seeds."""
    xs = sorted(xs)
    n = len(xs)
    means = [xs[min(n - 1, int((i + 0.5) * n / k))] for i in range(k)]
    sds, weights, last = [max((xs[-1] - xs[0]) / (2 * k), 1e-8)] * k, [1 / k] * k, -math.inf
    for _ in range(rounds):
        like, resp = 0.0, []
        for x in xs:
            p = [w * density(x, m, s) for w, m, s in zip(weights, means, sds)]
            total = sum(p)
            like += math.log(max(total, 1e-300))
            resp.append([v / total for v in p] if total else [1 / k] * k)
        for j in range(k):
            r = sum(q[j] for q in resp)
            if r > 1e-12:
                means[j] = sum(q[j] * x for q, x in zip(resp, xs)) / r
                sds[j] = max(math.sqrt(sum(q[j] * (x - means[j]) ** 2 for q, x in zip(resp, xs)) / r), 1e-8)
                weights[j] = r / n
        if abs(like - last) < tolerance:
            break
        last = like
    return means, sds, weights, like


def bic(like: float, k: int, n: int) -> float:
    return (3 * k - 1) * math.log(n) - 2 * like


def paired(chroms: list[str], labels: list[int], k: int) -> bool:
    """Whether chromosomes with at least k copies fall into k clusters: three testable ones, seven tenths of them."""
    by: dict[str, set[int]] = {}
    size: dict[str, int] = {}
    for c, x in zip(chroms, labels):
        by.setdefault(c, set()).add(x)
        size[c] = size.get(c, 0) + 1
    test = [c for c in by if size[c] >= k]
    return len(test) >= 3 and sum(len(by[c]) >= k for c in test) >= 0.7 * len(test)


def choose(xs: list[float], chroms: list[str], most: int = 3) -> list[float]:
    """Means in falling order, for the number of components that the BIC prefers and the pairing confirms."""
    if len(xs) < 4:
        return [sum(xs) / len(xs)] if xs else []
    fits = {k: fit(xs, k) for k in range(1, most + 1)}
    best = min(fits, key=lambda k: bic(fits[k][3], k, len(xs)))
    for k in [best, 2]:  # two clusters that the pairing confirms count even where the BIC prefers one
        if k == 1:
            continue
        means = sorted(fits[k][0], reverse=True)
        if paired(chroms, [nearest(x, means) for x in xs], k):
            return means
    return [sum(xs) / len(xs)]


def nearest(x: float, means: list[float]) -> int:
    return min(range(len(means)), key=lambda i: (abs(x - means[i]), i))


def assign(contigs: DataFrame) -> DataFrame:
    """contigs: assembly, contig, ref_id, ref_subgenome, identity. Multi-copy chromosomes of an assembly and a subgenome of the
    reference get letters B, C, ... by falling mean.

    If a chromosome has exactly as many copies as there are clusters but they share one, copies take letters by rank.
    """
    copies = contigs.withColumn("_n", F.count("*").over(W.partitionBy("assembly", "ref_id"))).filter("_n >= 2").drop("_n")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["ref_id", "contig"])
        means = choose(pdf["identity"].tolist(), pdf["ref_id"].tolist())
        pdf = pdf.assign(cluster=[nearest(x, means) for x in pdf["identity"]], k=len(means))
        for _, g in pdf.groupby("ref_id"):
            if len(means) > 1 and len(g) == len(means) and g["cluster"].nunique() == 1:
                pdf.loc[g.sort_values(["identity", "contig"], ascending=[False, True]).index, "cluster"] = range(len(means))
        return pdf.assign(subgenome=[chr(ord("B") + i) for i in pdf["cluster"]])[["assembly", "contig", "ref_id", "subgenome", "k"]]

    return copies.groupBy("assembly", "ref_subgenome").applyInPandas(run, "assembly string, contig string, ref_id string, subgenome string, k long")


def nearest_mean(values: DataFrame, means: DataFrame, key: str, value: str) -> DataFrame:
    """The nearest of a few means for each value; equal distances go to the lowest number."""
    return values.crossJoin(F.broadcast(means)).groupBy(key).agg(F.min_by("cluster", F.struct(F.abs(F.col(value) - F.col("mean")), "cluster")).alias("cluster"))
