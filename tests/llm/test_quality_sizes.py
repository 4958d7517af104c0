"""Texts of one kind get the same vote at every size."""

from karyolytics.llm import quality


def text(n, repeated):
    """n words, of which the given per cent lie in windows that occur twice."""
    twice = [f"a{i}" for i in range(n * repeated // 200)]
    return " ".join(twice * 2 + [f"b{i}" for i in range(n - 2 * len(twice))])


def test_repeats_at_every_size(spark):
    sizes = (1000, 2999, 3000, 8000, 20000)
    rows = [(k * 10 + share // 10, text(n, share)) for k, n in enumerate(sizes) for share in (20, 45)]
    got = quality.assess(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted({r.f_n for r in got}) == list(sizes) and not any(r.base_failed for r in got)
    assert {(r.doc_id % 10, r.vote_repeats) for r in got} == {(2, 0), (4, -1)}
