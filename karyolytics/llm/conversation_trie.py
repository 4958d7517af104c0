"""Prefix trie of conversations, totalled by leaf-peeling message passing.

A node is a distinct sequence of first turns. Its key is the sum, over its turns, of a hash of place, role and text in two
lanes, so a running sum over a conversation's turns gives all its nodes; two different sequences collide with probability
2^-120 or so. A node has as many members as there are conversations that begin with it, which a grouping counts before it
shuffles, so nodes that very many conversations share are no load.

Totals over subtrees go up by messages: each node holds a counter of children that have not reported. Nodes without such
children are complete; they send their totals to their parents, whose counters fall, until only the root is left. A chain of
nodes with one child each would take a round for each node, so it is one unit: its totals are running sums along the longest
conversation through it, and only its lower end, which is a leaf or has several children, counts down. Rounds are thus as
many as there are branchings on top of each other. Each round's tables are written, so lineage is one round long; the driver
sees a count only.

Cases: null roles and texts are empty; turns are ordered by number, null first, equal numbers by a hash of role and text;
rows without a conv_id belong to no conversation and are left out; repeated rows are turns each; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, trimmed

NOTHING = hashlib.sha256(b"").hexdigest()
#: The textless root, as a key.
ROOT = "0"


def turn_rows(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), digest of role and text, length in code points. Texts go no further."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(" "), role, text), 256)
    rows = turns.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.length(text).cast("long").alias("points"))
    place = F.row_number().over(W.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest"))
    return rows.select("conv_id", place.cast("long").alias("pos"), "digest", "points")


def inherited(conv_id: Column) -> Column:
    """How many turns of the first conversation of its hundred a conversation begins with."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 6).cast("long")


def rebuilt(turns: DataFrame) -> DataFrame:
    """turns as of ``turn_rows``; the same of conversations that begin with turns of the first of their hundred.

    Those without any turn left have one row, of place 0.
    """
    base = turns.filter((F.col("conv_id") % 100 == 0) & (F.col("pos") < 6)).withColumnRenamed("conv_id", "base")
    convs = turns.filter("pos = 1").select("conv_id", (F.col("conv_id") - F.col("conv_id") % 100).alias("base"), inherited(F.col("conv_id")).alias("h"))
    first = convs.join(base, "base").filter("pos <= h").select("conv_id", "pos", "digest", "points")
    # a base of fewer turns than wanted moves what follows up
    has = base.groupBy("base").agg(F.count("*").alias("has"))
    own = turns.withColumns({"h": inherited(F.col("conv_id")), "base": F.col("conv_id") - F.col("conv_id") % 100}).filter("pos > h").join(has, "base", "left")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.least("h", F.coalesce("has", F.lit(0)))).alias("pos"), "digest", "points")
    none = convs.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("string").alias("digest"), F.lit(0).cast("long").alias("points"))
    return first.unionByName(own).unionByName(none)


def paths(turns: DataFrame) -> DataFrame:
    """turns with a row of place 0 for each conversation: conv_id, depth, key, parent, points, size (turns of the conversation)."""
    lane = lambda seed: F.xxhash64(F.lit(seed), "pos", "digest").cast("decimal(38, 0)")
    whole = W.partitionBy("conv_id")
    order = whole.orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    df = turns.withColumns({f"x{i}": F.when(F.col("pos") > 0, lane(i)).otherwise(F.lit(0).cast("decimal(38, 0)")) for i in (1, 2)})
    df = df.select("conv_id", "pos", "points", F.max("pos").over(whole).alias("size"), *(F.sum(f"x{i}").over(order).alias(f"s{i}") for i in (1, 2)), "x1", "x2")
    key = lambda d, a, b: F.when(d == 0, ROOT).otherwise(F.concat_ws(".", d.cast("string"), a.cast("decimal(38, 0)").cast("string"), b.cast("decimal(38, 0)").cast("string")))
    above = key(F.col("pos") - 1, F.col("s1") - F.col("x1"), F.col("s2") - F.col("x2"))
    return df.select("conv_id", F.col("pos").alias("depth"), key(F.col("pos"), F.col("s1"), F.col("s2")).alias("key"), F.when(F.col("pos") > 0, above).alias("parent"), "points", "size")


def joined_digests(ends: DataFrame) -> DataFrame:
    """ends: key, conv_id. Of each key the SHA-256 of its conv_ids, ascending and joined by commas.

    Rows come sorted and pass through a running hash, so a key with very many conversations takes no memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            keys, ids, out = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for k, i in zip(keys, ids):
                if k == now:
                    digest.update(b",%d" % i)
                else:
                    if now is not None:
                        out.append((now, digest.hexdigest()))
                    now, digest = k, hashlib.sha256(b"%d" % i)
            yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], pa.string()) for j in range(2)], ["key", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([digest.hexdigest()])], ["key", "ends_sha256"])

    return ends.select("key", "conv_id").repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(trimmed(run), "key string, ends_sha256 string")


def peeled(units: DataFrame, scratch: Scratch) -> list[DataFrame]:
    """units: key, parent, waits (children that have not reported), leaves and saved of its own. Complete ones with their totals, by round.

    A round's complete units send what they hold to their parents; the rest waits for the next.
    """
    done = []
    size = units.count()
    while size:
        done.append(scratch.table(units.filter("waits = 0").select("key", "parent", "leaves", "saved"), f"done-{len(done)}", size))
        sent = done[-1].filter("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n"), F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        zero = lambda c: F.coalesce(c, F.lit(0))
        rest = units.filter("waits > 0").join(sent, "key", "left").select("key", "parent", (F.col("waits") - zero("n")).alias("waits"), (F.col("leaves") + zero("more_leaves")).alias("leaves"), (F.col("saved") + zero("more_saved")).alias("saved"))
        last, units = units, scratch.table(rest, f"waiting-{len(done)}", size)
        scratch.drop(last)
        size = units.count()
    return done


def trie(spark: SparkSession, turns: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """turns: conv_id, pos, digest, points, with a row of place 0 for each conversation. One row a node of the trie."""
    scratch = scratch or Scratch(spark, "trie")
    at = scratch.table(paths(turns), "paths", dealt=True)
    ends = joined_digests(at.filter("depth = size"))
    nodes = at.groupBy("key").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("points").alias("points"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        F.max(F.struct("size", (-F.col("conv_id")).alias("conv_id"))).alias("longest"),
    )
    nodes = scratch.table(nodes, "nodes", dealt=True)
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))).withColumn("own", (F.col("n_convs") - 1) * F.col("points"))
    # the longest conversation through a node goes on to its one child, if it has one: so chains are stretches of it
    up = W.partitionBy("longest", F.col("key") == ROOT).orderBy(F.desc("depth")).rowsBetween(W.unboundedPreceding, 0)
    lower = (F.col("n_children") != 1) | (F.col("key") == ROOT)
    of_lower = lambda c: F.last(F.when(lower, c), ignorenulls=True).over(up)
    nodes = nodes.withColumn("below", F.sum("own").over(up)).withColumns({"unit": of_lower(F.col("key")), "until": of_lower(F.col("below"))})
    nodes = nodes.select("key", "parent", "depth", "conv_id", "n_convs", "n_children", "unit", "own", (F.col("below") - F.col("until")).alias("chain"))
    nodes = scratch.table(nodes, "chains", dealt=True)
    own = F.max(F.when(F.col("key") == F.col("unit"), F.col("own")))
    units = nodes.groupBy(F.col("unit").alias("key")).agg(F.min_by("parent", "depth").alias("parent"), F.max(F.when(F.col("key") == F.col("unit"), F.col("n_children"))).alias("waits"), (own + F.max("chain")).alias("whole"), F.max("chain").alias("chain"))
    units = scratch.table(units, "units", dealt=True)
    start = units.select("key", "parent", "waits", F.when(F.col("waits") == 0, 1).otherwise(0).cast("long").alias("leaves"), F.col("whole").alias("saved"))
    totals = None
    for part in peeled(start, scratch):
        totals = part if totals is None else totals.unionByName(part)
    if totals is None:
        totals = start.select("key", "parent", "leaves", "saved")
    # a unit reports from its top; a node inside lacks the part of the chain that is above it
    totals = totals.join(units.select("key", F.col("chain").alias("top_chain")), "key").select(F.col("key").alias("unit"), F.col("leaves").alias("n_leaves"), (F.col("saved") - F.col("top_chain")).alias("lower_saved"))
    names = nodes.filter("n_children > 0").select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    root = F.broadcast(names.filter(F.col("parent") == ROOT))  # one row; the root has very many children
    first = nodes.filter("depth = 1").join(root, "parent")
    deep = nodes.filter("depth > 1").join(names, "parent")
    top = nodes.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    out = first.unionByName(deep).unionByName(top).join(totals, "unit").join(ends, "key", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("lower_saved") + F.col("chain")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))
