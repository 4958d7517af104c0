"""A hashed maximum-entropy language model with class-factored softmax, learned from and scored on whole texts.

Tokens are lower-cased words and one end per text. P(token | before) = P(class | before) P(member | class, before)
P(token | member). The most frequent words and the end are classes of their own; all other words, unknown ones too,
belong to a class by their last two bytes. In such a class the most frequent words are members of their own, and the rest
is dealt to a few members by hash. Both first factors are softmaxes over hashed features of the words before: n-grams (1
back; 1 and 2 back) and skips (2 back alone; for classes also 3 back alone), each with the class in the second. P(token |
member) is 1 for a word that is a member, else the smoothed share of its count, with room for one unknown token in each
such member, so the probabilities of all tokens and the unknown ones sum to one.

Training goes over all training texts once, dealt by hash into one fold for each update. An update is a Spark job over
the whole texts of its fold: tasks compute the gradient over their tokens, which is added up by blocks of weights; the step
is the gradient over what the rows of weights have seen. Scoring takes tokens in numpy batches, of which only the rows of
their features are read, and looks up frequent words in a table of fixed size; rarer words are joined with the counts,
a table that grows with the corpus, by a shuffle.

Words are hashed to 64 bits; two different words collide with probability 2^-64. Features share ROWS rows by hash.

Cases: null and empty texts are the end alone; a null identifier is held out; repeated rows each have a row and count in
training each; a table without training rows gives uniform classes and no known tokens; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, trimmed
from .ngram_join import BYTES, words_of

SINGLES, SUFFIXES = 15, 16
CLASSES = 1 + SINGLES + SUFFIXES
OWN, SHARED = 24, 8
MEMBERS = OWN + SHARED
BITS = 14
ROWS = 1 << BITS
BLOCKS = 16
HEAD = 1 << 17
UPDATES = 6
RATE, MOMENTUM, PRIOR = 0.5, 0.6, 2.0
END, START = -1, -2  # the hashes that stand for the end and for what is before a text
FLUSH = 4_000_000
TOKENS = 16_384  # tokens of a numpy batch
FEW = 6  # tokens of a short run


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def suffix_of(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each text the word hashes and, of each word, the class of its last two bytes."""
    held: list[bytes] = []
    size, words = 0, words_of(texts)
    for i, t in enumerate(texts):
        held.append((t or "").encode("utf-8", "replace"))
        size += len(held[-1]) + 1
        if size < BYTES and i + 1 < len(texts):
            continue
        data = np.frombuffer(b"\n" + b"\n".join(held) + b"\n", np.uint8)
        white = (data == 32) | ((data >= 9) & (data <= 13))
        last = np.flatnonzero(~white[1:-1] & white[2:]) + 1
        x, y = data[last].astype(np.int64), np.where(white[last - 1], 0, data[last - 1]).astype(np.int64)
        x, y = (np.where((v >= 65) & (v <= 90), v + 32, v) for v in (x, y))
        suffix, at = (x * 31 + y * 7) % SUFFIXES + 1 + SINGLES, 0
        for w in islice(words, len(held)):
            yield w.view(np.int64), suffix[at : at + len(w)]
            at += len(w)
        held.clear()
        size = 0


def summed(key: np.ndarray, *others: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, the counts, and of each other array one value, as a key's are all the same."""
    order = np.argsort(key)
    key = key[order]
    at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return (key[at], *(o[order[at]] for o in others), np.diff(np.append(at, len(key))))


def token_counts(docs: DataFrame) -> DataFrame:
    """Of training texts: word hash w, its suffix class s, its count c."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, ends = [], 0, 0

        def flush() -> pa.RecordBatch:
            w, s, c = summed(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))
            return pa.RecordBatch.from_arrays([pa.array(w), pa.array(s), pa.array(c)], ["w", "s", "c"])

        for batch in batches:
            for words, suffix in suffix_of(batch.column(0).to_pylist()):
                ends += 1
                held.append((words, suffix))
                size += len(words)
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array([END]), pa.array([0]), pa.array([ends])], ["w", "s", "c"])

    return docs.mapInArrow(run, "w long, s long, c long").groupBy("w").agg(F.first("s").alias("s"), F.sum("c").alias("c"))


class Units:
    """Class and member of each word: those of the words that have their own, else by suffix and hash."""

    def __init__(self, singles: list[int], own: list[tuple[int, int]]):
        """own: (word, class) in order of frequency; the first OWN of a class are members."""
        taken = [0] * CLASSES
        of = {w: ((i + 1), 0) for i, w in enumerate(singles)}
        for w, k in own:
            if w not in of and taken[k] < OWN:
                of[w] = (k, taken[k])
                taken[k] += 1
        self.words = np.array(sorted(of), np.int64)
        self.classes = np.array([of[int(w)][0] for w in self.words], np.int64)
        self.members = np.array([of[int(w)][1] for w in self.words], np.int64)

    def of(self, words: np.ndarray, suffix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y, m = suffix.copy(), OWN + ((words.view(np.uint64) >> np.uint64(40)) % np.uint64(SHARED)).astype(np.int64)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
            hit = self.words[at] == words
            y[hit], m[hit] = self.classes[at[hit]], self.members[at[hit]]
        return y, m


def sequences(texts: list[tuple[np.ndarray, np.ndarray]], units: Units) -> tuple[np.ndarray, ...]:
    """Of all tokens of the texts, ends included: class, member, and the words 1, 2 and 3 back."""
    starts, end, none = np.full(3, START, np.int64), np.array([END]), np.array([0])
    words = np.concatenate([x for w, _ in texts for x in (starts, w, end)])
    suffix = np.concatenate([x for _, s in texts for x in (np.zeros(3, np.int64), s, none)])
    at = np.flatnonzero(words != START)
    y, m = units.of(words[at], suffix[at])
    y[words[at] == END], m[words[at] == END] = 0, 0
    return y, m, words[at - 1], words[at - 2], words[at - 3]


def row(kind: int, *parts: np.ndarray) -> np.ndarray:
    x = np.full(len(parts[0]), kind * 0x9E3779B97F4A7C15 % 2**64, np.uint64)
    for p in parts:
        x = (x ^ p.view(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return (x * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - BITS)).astype(np.uint16)


def class_rows(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> list[np.ndarray | int]:
    """Rows of the class weights; the one after the hashed ones, which all tokens have, is the bias."""
    return [row(1, a), row(2, a, b), row(3, b), row(4, c), ROWS]


def member_rows(y: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[np.ndarray | int]:
    """Rows of the member weights; those after the hashed ones are the biases of the classes."""
    return [row(5, y, a), row(6, y, a, b), row(7, y, b), (ROWS + y).astype(np.uint16)]


def exponentials(weights: np.ndarray, rows: list[np.ndarray | int]) -> tuple[np.ndarray, np.ndarray]:
    """Of each token exp of the summed weights, and the total of these.

    A weight moves by RATE / (1 - MOMENTUM) at most in an update and a bias begins above -50, so float32 holds them.
    """
    x = weights[rows[0]]
    for f in rows[1:]:
        x += weights[f]
    np.exp(x, out=x)
    return x, x.sum(axis=1)


def log_probability(weights: np.ndarray, rows: list[np.ndarray | int], y: np.ndarray) -> np.ndarray:
    x, total = exponentials(weights, rows)
    return np.log(x[np.arange(len(y)), y].astype(np.float64) / total)


def spread(total: np.ndarray, seen: np.ndarray, rows: list[np.ndarray | int], miss: np.ndarray) -> None:
    """Adds miss to the rows of total, and to seen how often each row occurs."""
    for f in rows:
        if isinstance(f, int):
            total[f] += miss.sum(axis=0)
            seen[f] += len(miss)
            continue
        order = np.argsort(f, kind="stable")  # of 16 bits, so by radix
        f = f[order]
        at = np.flatnonzero(np.append(True, f[1:] != f[:-1]))
        n = np.diff(np.append(at, len(f)))
        seen[f[at]] += n
        for k in range(FEW):  # runs of few tokens one by one, as sums of short runs are slow
            one = at[(n > k) & (n <= FEW)] + k
            if not len(one):
                break
            total[f[one]] += miss[order[one]]
        many = n > FEW
        if many.any():
            runs = np.append(0, np.cumsum(n[many])[:-1])
            total[f[at[many]]] += np.add.reduceat(miss[order[np.repeat(many, n)]], runs)


def grouped(texts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
    """The texts in order, in groups of about TOKENS tokens."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t[0]) + 1
        if size >= TOKENS:
            yield held
            held, size = [], 0
    if held:
        yield held


def portions(n: int) -> Iterator[slice]:
    return (slice(i, i + TOKENS) for i in range(0, n, TOKENS))


def gradient(docs: DataFrame, units: Units, weights: np.ndarray, member: np.ndarray) -> list[np.ndarray]:
    """Gradient of both tables of weights, each with a last column that counts what its rows have seen."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(w), w.shape[1] + 1), np.float32) for w in (weights, member)]
        for batch in batches:
            for group in grouped(list(suffix_of(batch.column(0).to_pylist()))):
                whole = sequences(group, units)
                for cut in portions(len(whole[0])):
                    y, m, a, b, c = (x[cut] for x in whole)
                    for k in (0, 1):
                        if k:
                            two = y > SINGLES
                            y, m, a, b = y[two], m[two], a[two], b[two]
                            if not len(y):
                                continue
                        rows = member_rows(y, a, b) if k else class_rows(a, b, c)
                        miss, total = exponentials(member if k else weights, rows)
                        miss *= (-1 / total)[:, None]
                        miss[np.arange(len(y)), m if k else y] += 1
                        spread(sums[k][:, :-1], sums[k][:, -1], rows, miss)
        parts = [(k * BLOCKS + i, x.tobytes()) for k, s in enumerate(sums) for i, x in enumerate(np.array_split(s, BLOCKS))]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in parts], pa.int32()), pa.array([x for _, x in parts], pa.binary())], ["block", "g"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, v in zip(*(c.to_pylist() for c in batch.columns)):
                x = np.frombuffer(v, np.float32).astype(np.float64)
                total[k] = total[k] + x if k in total else x
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.astype(np.float32).tobytes() for x in total.values()], pa.binary())], ["block", "g"])

    kind = "block int, g binary"
    tasks = 2 * docs.sparkSession.sparkContext.defaultParallelism
    got = {r["block"]: np.frombuffer(r["g"], np.float32) for r in docs.coalesce(tasks).mapInArrow(trimmed(part), kind).repartition("block").mapInArrow(add, kind).collect()}  # the weights' gradient
    out = []
    for k, w in enumerate((weights, member)):
        blocks = [got.get(k * BLOCKS + i) for i in range(BLOCKS)]
        out.append(np.zeros((len(w), w.shape[1] + 1), np.float32) if blocks[0] is None else np.concatenate(blocks).reshape(len(w), -1))
    return out


def train(docs: DataFrame, units: Units, weights: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One step for each fold of the documents, with momentum. A step is at most RATE times what a row could have seen."""
    both = [weights, member]
    share = [np.exp(weights[ROWS]), np.full(MEMBERS, 1 / MEMBERS, np.float32)]
    speed = [np.zeros_like(w) for w in both]
    for fold in range(UPDATES):
        for k, g in enumerate(gradient(docs.filter(F.col("fold") == fold).select("text"), units, *both)):
            g, seen = g[:, :-1], g[:, -1:]
            step = np.clip(g / (seen * share[k] + np.maximum(g, 0) + PRIOR), -1, 1)
            speed[k] = (MOMENTUM * speed[k] + RATE * step).astype(np.float32)
            both[k] = both[k] + speed[k]
    return both[0], both[1]


class Model:
    """What scoring needs. Its size is fixed: weights, head words, sums by class."""

    def __init__(self, spark: SparkSession, docs: DataFrame, scratch: Scratch):
        rows = docs.filter("not held_out").select("text", F.pmod(F.xxhash64("id", "text"), F.lit(UPDATES)).alias("fold"))
        counts = token_counts(rows.select("text"))
        self.counts = scratch.table(counts, "counts")
        total, kinds = self.counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
        self.total, self.kinds = int(total), int(kinds)
        self.ends = (self.counts.filter(F.col("w") == END).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0])
        # the least count that leaves at most HEAD words; counts fall into a few hundred steps
        step = F.floor(F.log2(F.col("c")) * 16)
        steps = self.counts.groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.min("c").alias("least")).orderBy(F.desc("step")).collect()
        least, n = None, 0
        for r in steps:
            n += r["n"]
            if n > HEAD:
                break
            least = r["least"]
        head = [] if least is None else self.counts.filter(F.col("c") >= int(least)).collect()  # at most HEAD rows
        top = sorted((r for r in head if r["w"] != END), key=lambda r: (-r["c"], r["w"]))
        self.units = Units([r["w"] for r in top[:SINGLES]], [(r["w"], r["s"]) for r in top[SINGLES:]])
        own = spark.createDataFrame([(int(w),) for w in [*self.units.words, END]], "w long")  # CLASSES * OWN rows at most
        slot = (F.lit(OWN) + F.pmod(F.shiftrightunsigned("w", 40), F.lit(SHARED))).alias("m")
        rest = self.counts.join(F.broadcast(own), "w", "left_anti").groupBy("s", slot).agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()  # SUFFIXES * SHARED rows
        self.mass = np.full((CLASSES, MEMBERS), 0.1)
        seen = np.zeros((CLASSES, MEMBERS))
        seen[0, 0] = self.ends
        for r in rest:
            self.mass[r["s"], r["m"]] = r["c"] + 0.1 * (r["n"] + 1)
            seen[r["s"], r["m"]] = r["c"]
        head.sort(key=lambda r: r["w"])
        self.head, self.head_count = np.array([r["w"] for r in head], np.int64), np.array([r["c"] for r in head], np.float64)
        if len(self.units.words):
            seen[self.units.classes, self.units.members] = self.head_count[np.searchsorted(self.head, self.units.words)]
        self.weights, self.member = np.zeros((ROWS + 1, CLASSES), np.float32), np.zeros((ROWS + CLASSES, MEMBERS), np.float32)
        self.weights[ROWS] = np.log((seen.sum(axis=1) + 1) / (seen.sum() + CLASSES))
        self.member[ROWS:] = np.log((seen + 0.1) / (seen + 0.1).sum(axis=1, keepdims=True))
        if self.total:
            self.weights, self.member = train(rows, self.units, self.weights, self.member)

    def base_mass(self) -> float:
        return self.total + 0.1 * (self.kinds + 1)


PARTIAL = "id long, held_out boolean, uid long, n_tokens long, n_known long, base double, score double, tail array<long>, tail_unit array<int>"


def partial_scores(docs: DataFrame, model: Model) -> DataFrame:
    """Scores of all but the tail's shares: classes and members of all tokens, whole terms of head words and the end; tail words as arrays."""
    units, weights, member, head, count, mass, base_mass = model.units, model.weights, model.member, model.head, model.head_count, model.mass, model.base_mass()
    ends = float(model.ends)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scale = 1 / np.log(10)
        for batch in batches:
            out = []
            for group in grouped(list(suffix_of(batch.column(3).to_pylist()))):
                whole = sequences(group, units)
                p = np.zeros(len(whole[0]))
                for cut in portions(len(p)):
                    y, m, a, b, c = (x[cut] for x in whole)
                    got = log_probability(weights, class_rows(a, b, c), y)
                    two = np.flatnonzero(y > SINGLES)
                    if len(two):
                        got[two] += log_probability(member, member_rows(y[two], a[two], b[two]), m[two])
                    p[cut] = got * scale
                n = np.array([len(w) + 1 for w, _ in group])
                ends_at = np.cumsum(n) - 1
                first = ends_at - n + 1
                words = np.concatenate([x for w, _ in group for x in (w, [END])])
                hit = np.zeros(len(words), bool)
                unit = whole[0] * MEMBERS + whole[1]
                base, known = np.zeros(len(words)), np.zeros(len(words), np.int64)
                if len(head):
                    place = np.minimum(np.searchsorted(head, words), len(head) - 1)
                    hit = head[place] == words
                    freq = count[place[hit]]
                    base[hit], known[hit] = np.log10((freq + 0.1) / base_mass), 1
                    shared = (whole[0][hit] > SINGLES) & (whole[1][hit] >= OWN)
                    p[np.flatnonzero(hit)[shared]] += np.log10((freq[shared] + 0.1) / mass.ravel()[unit[hit][shared]])
                hit[ends_at], base[ends_at], known[ends_at] = True, np.log10((ends + 0.1) / base_mass), ends > 0
                tails = np.add.reduceat(~hit, first, dtype=np.int64)
                out.append((n, *(np.add.reduceat(x, first) for x in (known, base, p)), tails, words[~hit], unit[~hit].astype(np.int32)))
            if not out:
                continue
            n, known, base, p, tails, words, unit = (np.concatenate(x) for x in zip(*out))
            at = pa.array(np.append(0, np.cumsum(tails)), pa.int32())
            cols = [*(pa.array(x) for x in (n, known, base, p)), pa.ListArray.from_arrays(at, pa.array(words)), pa.ListArray.from_arrays(at, pa.array(unit))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *cols], ["id", "held_out", "uid", "n_tokens", "n_known", "base", "score", "tail", "tail_unit"])

    return docs.select("id", "held_out", F.monotonically_increasing_id().alias("uid"), "text").mapInArrow(run, PARTIAL)


def score(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    scratch = Scratch(spark, "maxent-lm")
    docs = docs.select(F.col(doc_id).cast("long").alias("id"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("text"))
    model = Model(spark, docs, scratch)
    first = scratch.table(partial_scores(docs, model), "partial")
    tail = first.select("uid", F.explode(F.arrays_zip(F.col("tail").alias("w"), F.col("tail_unit").alias("s"))).alias("x")).select("uid", "x.w", "x.s")
    mass = F.element_at(F.array(*[F.lit(float(m)) for m in model.mass.ravel()]), F.col("s") + 1)
    c = F.coalesce("c", F.lit(0))
    rare = tail.join(model.counts.select("w", "c"), "w", "left").groupBy("uid").agg(F.sum(F.log10((c + 0.1) / model.base_mass())).alias("tail_base"), F.sum(F.log10((c + 0.1) / mass)).alias("tail_score"), F.sum((c > 0).cast("long")).alias("tail_known"))
    zero = lambda k: F.coalesce(k, F.lit(0))
    return first.drop("tail", "tail_unit").join(rare, "uid", "left").select(
        "id", "held_out", "n_tokens", (F.col("n_known") + zero("tail_known")).alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"), (F.col("base") + zero("tail_base")).alias("base_score"), (F.col("score") + zero("tail_score")).alias("score")
    )
