"""The pipeline on hard rows, and what each shard of op8 holds, against brute force."""

import collections
import random
import zlib

import pytest

import corpus_pipeline
from karyolytics.llm import queries

RND = random.Random(8)
WORDS = "the a of to and in is was for on with as by at from that this it river house stone winter morning garden letter voice paper window mountain harbour silver yellow quiet broken distant".split()


def prose(n):
    return " ".join(" ".join(RND.choice(WORDS) for _ in range(12)).capitalize() + "." for _ in range(n))


LONG, OTHER = prose(40), prose(12)
ROWS = [(1, LONG, "en", "s", 1), (1, LONG, "en", "s", 1), (2, None, None, None, None), (3, "", "en", "s", 0), (None, OTHER, None, "s", None), (4, LONG.replace("river", "rivers", 1), "en", "s", 3), *[(10 + i, prose(8 + i), "en", "t", 5) for i in range(12)], (90, "\n".join([OTHER.split(".")[0] + "."] * 3), "en", "s", 9)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def folder(spark, tmp_path):
    def write(rows):
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        names = ("id", "kept", "component_id", "line", "f_n", "digest", "size", "shard", "posterior", "n_words")
        df.withColumns({c: df["n_chars"] for c in names}).write.parquet(f"{tmp_path}/documents.parquet")
        return str(tmp_path)

    return write


def test_hard_rows(spark, folder):
    sf = folder(ROWS)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes), name
        rows = [r.asDict() for r in out.collect()]
        docs = spark.createDataFrame(rows, docs.schema)
        assert rows, name
    ids = [r["doc_id"] for r in rows]
    assert ids.count(1) == 1 and not {2, 3, 90} & set(ids) and {10 + i for i in range(12)} <= set(ids)
    got = collections.defaultdict(list)
    for r in corpus_pipeline.run(spark, sf).collect():
        got[r.doc_id].append(r)
    assert set(got) == set(ids)
    for pieces in got.values():
        at = 0
        for k, r in enumerate(sorted(pieces, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at)
            at += r.length


def test_empty_table(spark, folder):
    sf = folder([])
    assert corpus_pipeline.run(spark, sf).collect() == []


NEAR = [(1, LONG), (1, LONG), (2, LONG.replace("river", "rivers", 1)), (None, OTHER), (None, OTHER), (7, OTHER), (8, None), (8, ""), (9, prose(9)), (10, prose(11)), (10, prose(10))]


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_near_duplicates_leave_one_row(spark, monkeypatch, most):
    monkeypatch.setattr(corpus_pipeline, "BROADCAST_KEYS", most)
    docs = spark.createDataFrame(NEAR, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    assert sorted(got, key=str) == sorted([(1, LONG), (None, OTHER), *NEAR[6:]], key=str)


def test_texts_of_the_result_stay_in_place(spark, tmp_path):
    spark.createDataFrame([(1, LONG), (2, LONG.replace("river", "rivers", 1)), (9, prose(9))], "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    out = corpus_pipeline.drop_near_duplicates(spark, spark.read.parquet(f"{tmp_path}/docs"), "")
    assert sorted(r.doc_id for r in out.collect()) == [1, 9]
    assert "hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()


def test_shards(spark, folder):
    sf = folder([*ROWS, *[(100 + i, prose(RND.randrange(1, 9)), "en", "u", 1) for i in range(300)], *[(500 + i, "same text", "en", "u", 1) for i in range(40)]])
    rows = queries.op8_sharding(spark, sf).collect()
    text = collections.Counter((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    known = collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in text.elements())
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == known
    shards = collections.defaultdict(list)
    for r in rows:
        assert (r.law, r.grown_shard) == ("bytes", None) and 0 <= r.shard < 16
        shards[r.shard].append(r)
    for s in shards.values():
        assert sorted(r.slot for r in s) == list(range(len(s)))
    place = {}
    for r in rows:
        assert place.setdefault((r["size"], r.text_crc32), r.shard) == r.shard  # equal texts stay together
    load = [sum(r["size"] for r in shards[k]) for k in range(16)]
    largest = max(r["size"] for r in rows)
    assert max(load) - min(load) <= largest
