"""Exact dedup as a stream with keyed state.

A file stream feeds a keyed state on disk, in the shared folder, that never expires: each micro-batch adds a delta of its
keys, and deltas are compacted into a base now and then, as in a log-structured merge tree. The key is the digest of the
normalised text; the value is the group's count, and of the row that stays its length, stable identifier and content
locator (file and row number). Each digest that is hit more than once is then checked on full bytes: the texts of
its rows are compared with the text that the locator names. Rows that differ from it share a digest without sharing a
text; their digests are grouped anew by the bytes themselves, so the result is right whatever the digest.

DataFrame operations only: no Python runs on executors.

Cases: a null text counts as empty, and all empty texts are one group; a null identifier loses a tie against any other;
repeated rows are told apart by their locator; an empty table gives an empty result; columns other than the identifier
and the text are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE_CLASS, Scratch

#: The state is compacted when it has so many deltas.
DELTAS = 16
#: Digests that were hit more than once are broadcast up to so many: a few hundred bytes each.
BROADCAST_DIGESTS = 200_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_CLASS + "+", "")


def sha256(norm: Column) -> Column:
    return F.sha2(norm, 256)


def keyed_rows(df: DataFrame, doc_id: str, text: str, digest: Callable[[Column], Column]) -> DataFrame:
    """Per row: key digest, length in code points, identifier, locator, and the text."""
    return df.select(
        F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body"), F.length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("points"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
    ).withColumn("digest", digest(normalised(F.col("body"))))


def preference() -> Column:
    """Greatest: most code points, then smallest identifier, then a locator for repeated rows."""
    return F.struct("points", (-F.col("id")).alias("neg_id"), "file", "row")


def versions(spark: SparkSession, state: str, kind: str) -> list[int]:
    """Numbers of the complete parts of a kind."""
    jvm = spark._jvm.org.apache.hadoop.fs.Path
    root = jvm(f"{state}/{kind}")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    return sorted(int(x.getPath().getName()) for x in fs.listStatus(root) if fs.exists(jvm(x.getPath(), "_SUCCESS")))


def merged(parts: DataFrame) -> DataFrame:
    return parts.groupBy("digest").agg(F.max("best").alias("best"), F.sum("n").alias("n"))


def read_state(spark: SparkSession, state: str) -> DataFrame:
    """The state as a table: digest, best (length, negated identifier, locator), n."""
    base = versions(spark, state, "base")[-1:]
    paths = [f"{state}/base/{b}" for b in base] + [f"{state}/delta/{d}" for d in versions(spark, state, "delta") if not base or d > base[0]]
    return merged(spark.read.parquet(*paths))


def update_state(spark: SparkSession, path: str, state: str, doc_id: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256, max_bytes_per_trigger: int = 64 << 30, max_files_per_trigger: int | None = None) -> None:
    """Takes all files not yet seen by this state into it. Call again when files were added."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).isFile(at):  # file streams read folders
        reader, path = reader.option("pathGlobFilter", at.getName()), at.getParent().toString()
    reader = reader.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else reader.option("maxBytesPerTrigger", max_bytes_per_trigger)

    def merge(batch: DataFrame, number: int) -> None:
        # a batch that is run again after a failure writes the same delta again
        batch.groupBy("digest").agg(F.max(preference()).alias("best"), F.count("*").alias("n")).write.mode("overwrite").parquet(f"{state}/delta/{number}")
        if number % DELTAS == DELTAS - 1:
            read_state(spark, state).write.mode("overwrite").parquet(f"{state}/base/{number}")

    rows = keyed_rows(reader.parquet(path), doc_id, text, digest).drop("body")
    rows.writeStream.foreachBatch(merge).option("checkpointLocation", f"{state}/offsets").trigger(availableNow=True).start().awaitTermination()


def exact_dedup(spark: SparkSession, path: str, doc_id: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256, state_path: str | None = None, max_bytes_per_trigger: int = 64 << 30, max_files_per_trigger: int | None = None) -> DataFrame:
    """One row per row at ``path``: id, points, digest, keep_id, group_size, kept."""
    scratch = Scratch(spark, "exact-dedup")
    source = spark.read.parquet(path)
    if source.isEmpty():
        return spark.createDataFrame([], "id long, points long, digest string, keep_id long, group_size long, kept boolean")
    state_path = state_path or scratch.path("state")
    update_state(spark, path, state_path, doc_id, text, digest, max_bytes_per_trigger, max_files_per_trigger)
    state = read_state(spark, state_path)
    rows = keyed_rows(source, doc_id, text, digest)
    here = (F.col("file") == F.col("best.file")) & (F.col("row") == F.col("best.row"))
    decided = rows.drop("body").join(state, "digest").select("id", "points", "digest", (-F.col("best.neg_id")).alias("keep_id"), F.col("n").alias("group_size"), here.alias("kept"))
    again = state.filter("n > 1")
    # texts move only where their digest is hit again; a table of such digests that is not small is joined by shuffle
    of = F.broadcast(again) if again.count() <= BROADCAST_DIGESTS else again
    hit = scratch.table(rows.join(of, "digest").select("id", "points", "file", "row", "digest", normalised(F.col("body")).alias("norm"), here.alias("first")), "hits")
    firsts = hit.filter("first").select("digest", F.col("norm").alias("first_norm"))
    unlike = hit.filter("not first").select("digest", "norm").join(firsts, "digest").filter("norm <> first_norm").select("digest").distinct()
    unlike = scratch.table(unlike, "unlike")
    if unlike.isEmpty():
        scratch.drop(hit)
        return decided
    again = hit.join(unlike, "digest", "left_semi")
    best = again.groupBy("digest", "norm").agg(F.max(preference()).alias("best"), F.count("*").alias("n"))
    redone = again.join(best, ["digest", "norm"]).select("id", "points", "digest", (-F.col("best.neg_id")).alias("keep_id"), F.col("n").alias("group_size"), here.alias("kept"))
    return decided.join(unlike, "digest", "left_anti").select(redone.columns).unionByName(redone)
