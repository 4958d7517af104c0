"""Shared pieces: scratch tables in the cluster's shared folder, text constants, connected components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: White space of all contracts: [\x20\x09-\x0D].
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
WHITE_CLASS = "[\\x20\\x09-\\x0D]"
#: Edges that a task unites at once.
FOREST = 1 << 19
#: Rows of a small scratch table's file.
FILE_ROWS = 100_000
#: Bytes of rows that a Python worker gets at once. A batch lies in the JVM as vectors and as a message, and in the worker as
#: bytes and as objects; Spark's own bound of 64 MB takes some hundred MB of an executor for that.
BATCH_BYTES = 4 << 20
#: Bytes of a row group of Parquet files. Tasks hold the group that they write in memory, and of one that they read all its columns;
#: Parquet's own 128 MB, and the copies that come and go with it, let the heap of an executor grow to its most.
GROUP_BYTES = 16 << 20
GROUP = "parquet.block.size"
#: Whether Spark removes the shuffle files of a query when it ends.
SWEEP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of a batch of ``keep``, which is made and read whole: with sets of some hundred numbers, Spark's own 10000 take 24 MB and more.
KEPT_ROWS = 1000


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares, from spark.checkpoint.dir; a temporary one only where that is unset."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = "file://" + tempfile.mkdtemp(prefix="karyolytics-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def small_batches(spark: SparkSession) -> None:
    """From now on Python workers get rows in batches of BATCH_BYTES, files have row groups of GROUP_BYTES and batches of ``keep``
    KEPT_ROWS rows, unless the session has bounds of its own.

    A result that isn't written yet is planned when its caller reads it, so the bounds stay. No result depends on them.
    """
    bounds = {"spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES, "spark.sql.inMemoryColumnarStorage.batchSize": KEPT_ROWS}
    if spark._jsc.hadoopConfiguration().get(GROUP) is None:
        bounds[GROUP] = GROUP_BYTES
    for name, most in bounds.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, str(most))


@contextlib.contextmanager
def set_to(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for the time of a step."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def give_back() -> None:
    """What this worker's allocators have freed goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def trimmed(run):
    """The same function over Arrow batches, which gives what it has freed back to the system when a task ends.

    Python workers outlive their tasks, so what their allocators keep would stay beside the executor's later steps.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole


def gathered(df: DataFrame, rows: int, each: int) -> DataFrame:
    """df in as many partitions as so many rows a partition need, but two for each core; never in more than it has."""
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, rows // each))


class Scratch:
    """Written tables that cut lineage. They lie in the shared folder, so they outlive a lost executor.

    ``table`` writes and rereads; ``drop`` removes a table that no later step reads, so that only what is still needed
    takes disk.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self.n = 0
        self.paths: dict[int, str] = {}
        self.kept: list[DataFrame] = []

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n:03d}-{name}"

    def table(self, df: DataFrame, name: str, rows: int | None = None, dealt: bool = False, swept: bool = False) -> DataFrame:
        """rows: about how many there are at most; then small partitions share tasks and files, yet all cores have some.
        dealt: df's last step deals its rows into the shuffle partitions; a file then holds four of them.
        swept: shuffle files of this step go as soon as it is written, not when the driver happens to collect its garbage.
        """
        path = self.path(name)
        least = self.spark.sparkContext.defaultParallelism
        most = rows // FILE_ROWS if rows is not None else int(self.spark.conf.get("spark.sql.shuffle.partitions")) // 4
        out = df if rows is None and not dealt else df.coalesce(max(2 * least if dealt else least, most))
        with set_to(self.spark, SWEEP, "true") if swept else contextlib.nullcontext():
            out.write.mode("overwrite").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        out._scratch_path = path
        return out

    def keep(self, df: DataFrame, rows: int | None = None) -> DataFrame:
        """Holds the rows on the executors' disks for steps that follow at once; what a lost executor held is made again.

        They stay until ``clear``. rows: as for ``table``.
        """
        self.kept.append((df if rows is None else gathered(df, rows, FILE_ROWS)).persist(StorageLevel.DISK_ONLY))
        return self.kept[-1]

    def clear(self) -> None:
        """Removes all tables of this scratch, and what it keeps. Nothing that reads them should run afterwards."""
        for df in self.kept:
            df.unpersist()
        self.drop(self.root)

    def drop(self, *tables: DataFrame | str) -> None:
        for t in tables:
            path = t if isinstance(t, str) else getattr(t, "_scratch_path", None)
            if path:
                jvm = self.spark._jvm
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each node with an edge but the smallest of its component: the node and that smallest one."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    low, (a, b) = np.arange(len(nodes)), np.split(at, 2)
    while (low[a] != low[b]).any():
        x, y = low[a], low[b]
        np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
        while (low != low[low]).any():
            low = low[low]
    rest = low != np.arange(len(nodes))
    return nodes[rest], nodes[low[rest]]


def contracted(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with u > v of the same components: each task unites its edges in portions, which takes the hubs' load."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in chain(batches, (None,)):
            if batch is not None:
                held.append(np.column_stack([c.to_numpy() for c in batch.columns]))
            if held and (batch is None or sum(map(len, held)) > FOREST):
                x = np.concatenate(held)
                held = []
                u, v = forest(x[:, 0], x[:, 1])
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    # dealt anew, else the Python workers of the step that makes the edges would run beside these
    return edges.repartition("u").mapInArrow(run, "u long, v long")


def components(edges: DataFrame, scratch: Scratch, a: str = "a", b: str = "b", rows: int | None = None) -> DataFrame:
    """Connected components of an edge list as (node, component = smallest node reachable), by large-star and small-star rounds.

    Tasks first unite their own edges, so that of a hub at most one edge a portion is left. Each round then takes two
    windows over the edges of a node and a distinct; its edges are a written table, so lineage stays one round long. It
    ends when all edges are stars, of which the driver sees a count only. Isolated nodes are not in the result. An empty
    edge list gives an empty result; loops and repeated edges are ignored. rows: about how many edges there are at most.
    """
    cur = scratch.table(contracted(edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))), "edges", rows)
    of = W.partitionBy("u")
    while True:
        ends = cur.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("up")), F.struct(F.col("v").alias("x"), F.lit(0).alias("up")))).alias("e")).select("e.*")
        bad = ends.groupBy("x").agg(F.sum("up").alias("up"), F.min("up").alias("low")).filter("up > 1 or up = 1 and low = 0").limit(1)
        if not bad.count():
            break
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.withColumn("m", F.least("u", F.min("v").over(of))).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = large.withColumn("m", F.min("v").over(of)).select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        new = scratch.table(small.select("e.u", F.col("e.m").alias("v")).filter("u <> v").distinct(), "edges", rows)
        scratch.drop(cur)
        cur = new
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
