"""How much the Python workers of the pipeline's steps get at once."""

import time
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from karyolytics.llm import collocations, common, line_dedup, ngram_join, packing
from karyolytics.llm.queries import tokenizer

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
OWN = "concat_ws(' ', transform(sequence(1, 150), i -> sha1(concat(id, '-', i))))"
STEPS = {
    "lines": (OWN, lambda s, d: line_dedup.dedup_lines(s, d)),
    "near": (OWN, lambda s, d: ngram_join.near_duplicates(s, d)),
    "packing": ("repeat('river ', 1000)", lambda s, d: packing.pack_documents(s, d, tokenizer("byte_bpe_50k.json"))),
}


@pytest.mark.parametrize("step", STEPS)
def test_batches_are_small(spark, monkeypatch, step):
    most = 5 << 20  # the row that reaches the bound is in

    def watched(run):
        def whole(batches):
            def seen():
                for b in batches:
                    assert b.nbytes <= most, f"a worker got {b.nbytes} bytes at once"
                    yield b

            yield from run(seen())

        return whole

    monkeypatch.setattr({"lines": line_dedup, "near": ngram_join, "packing": packing}[step], "trimmed", watched)
    spark.conf.unset(KEY)
    text, run = STEPS[step]
    docs = spark.range(0, 2000, 1, 1).select(F.col("id").alias("doc_id"), F.expr(text).alias("text"))
    assert run(spark, docs).agg(F.countDistinct("doc_id" if step == "lines" else "id")).first()[0] == 2000


def test_own_bound_stays(spark):
    before = spark.conf.get(KEY, None)
    try:
        spark.conf.set(KEY, "1m")
        common.small_batches(spark)
        assert spark.conf.get(KEY) == "1m"
    finally:
        spark.conf.unset(KEY) if before is None else spark.conf.set(KEY, before)


def test_row_groups_are_small(spark, tmp_path):
    common.small_batches(spark)
    spark.range(0, 20000, 1, 1).selectExpr("id", OWN + " AS text").write.parquet(f"{tmp_path}/out")
    (part,) = tmp_path.glob("out/*.parquet")
    found = pq.ParquetFile(part).metadata
    sizes = [found.row_group(i).total_byte_size for i in range(found.num_row_groups)]
    assert sum(sizes) > 100 << 20 and max(sizes) < 48 << 20, sizes


def test_collocations_leave_no_shuffle_files(spark, monkeypatch):
    """Whenever a step has been written, its shuffle files are gone."""
    top = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for d in top.localDirsString() for f in Path(d).glob("*/shuffle_*.data")}
    before, seen, table = files(), [], common.Scratch.table

    def watched(self, df, name, *args, **kwargs):
        out = table(self, df, name, *args, **kwargs)
        end = time.time() + 5
        while (left := files() - before) and time.time() < end:
            time.sleep(0.1)
        seen.append((name, len(left)))
        return out

    monkeypatch.setattr(common.Scratch, "table", watched)
    docs = spark.range(0, 300, 1, 3).selectExpr("'en' AS lang", "concat('the river house. a stone ', id) AS text")
    assert collocations.collocations(spark, docs).count() and len(seen) == 6
    assert not any(n for _, n in seen), seen
    assert spark.conf.get(common.SWEEP) == "false"
