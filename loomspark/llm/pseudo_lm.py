"""Language-model scoring by masked pseudo-likelihood.

A small network predicts every word from the two words on each side of it; a document's score is the sum of the
conditional log-probabilities of its words. The vocabulary is the corpus's commonest words, counted over all documents, as
many as the square root of the words counted (and ``classes`` squared at least); other words share hashed tail ids, and
places beyond the text have an id of their own. The output is a two-level softmax: a class from the context, then a word
within the class, so a prediction costs two short rows. Classes of common words are short and those of rare words long: a
class has as many words as the root of one over its first word's share (``CLASSES`` at least), the sizes for which the two
rows together are shortest; up to ``CLASSES`` squared ids all classes are alike. A tail word's probability is that of its tail id times its share of
the id's words: its count over the id's words and different words, the latter being what unknown words would get. So the
probabilities of all words, unknown ones included, sum to 1. The counts of tail words are joined to the documents, never
held in one place.

Training is data-parallel: the output layer starts from the words' shares; in each round every partition starts from the
common parameters, takes AdaGrad steps on its own whole documents (one word in ``mask`` is masked and a target at a time, as
in masked language modelling; the rounds share out the ``mask`` sets of words, so each word is a target once), and the
results are averaged with the numbers of targets as weights, block by block of parameters and in two levels, so no task sees
more than the square root of the partitions' blocks. A step takes about a quarter of the square root of the corpus's words
(512 to 8192). Long documents are taken in parts with their neighbours' words in view. What the driver holds is the vocabulary
and one set of parameters, which grow with the square root of the corpus.

Defined results: null and empty texts have no words, so a score of 0 and a null mean; repeated documents each get a row;
in a corpus without words every score is 0. Other columns are kept in ``row``.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from functools import cached_property
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, fold, row_of, small

CLASSES, TAIL, SIDE, HIDDEN, LONGEST = 48, 104, 2, 24, 40


@dataclass
class Vocabulary:
    """Ids of the commonest words; then ``tail`` hashed ids; then the edge of a text, which is no word's id."""

    ids: dict[bytes, int]
    edge: int
    tail: int
    room: np.ndarray  # of each tail id, its words and different words
    times: np.ndarray | None = None  # how often the words of ``ids`` occur

    def weights(self) -> np.ndarray:
        """How often each id occurs, and one more."""
        n = np.ones(self.edge)
        if self.times is not None:
            n[: len(self.times)] += self.times
        n[self.edge - self.tail :] += self.room
        return n

    @cached_property
    def bounds(self) -> np.ndarray:
        """Where each class of ids begins, and the end."""
        if self.classes <= CLASSES:
            return np.arange(self.classes + 1) * self.classes
        n = self.weights()
        sizes, out, tail = np.maximum(CLASSES, np.sqrt(n.sum() / n)).astype(np.int64), [0], self.edge - self.tail
        while out[-1] < self.edge:
            a = out[-1]
            out.append(min(a + int(sizes[a]), tail if a < tail else self.edge))
        return np.array(out)

    @property
    def classes(self) -> int:
        """The square root of the number of ids."""
        return math.isqrt(self.edge)

    @property
    def kind(self) -> type:
        return np.uint16 if self.edge < 1 << 16 else np.uint32

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
        """Ids of the words, and those words that have a tail id, each time they occur; long words as they are or shortened."""
        base = self.edge - self.tail
        out, rest = list(map(self.ids.get, words)), []
        if None in out:
            for i in [i for i, x in enumerate(out) if x is None]:
                w = words[i]
                if len(w) > LONGEST:
                    w = _short(w)
                    out[i] = self.ids.get(w)
                    if out[i] is not None:
                        continue
                out[i] = base + sum(w[:8]) % self.tail
                rest.append(w)
        return np.array(out, self.kind), rest

    def log_room(self, ids: np.ndarray) -> np.ndarray:
        """What the share of a tail word in its id is divided by (logarithm); 0 for other words."""
        return np.concatenate([np.zeros(self.edge - self.tail), np.log(np.maximum(self.room, 1))])[ids]


def _bucket(word: bytes, tail: int) -> int:
    return sum(word[:8]) % tail


def _short(word: bytes) -> bytes:
    """A word over ``LONGEST`` bytes by a digest, with a letter that no word has."""
    return word if len(word) <= LONGEST else b"#" + blake2b(word, digest_size=16).hexdigest().encode()


def _words(text: str | None) -> list[bytes]:
    return list(map(_short, fold(text).split()))


def _count(batches):
    """Words of each partition with their numbers, flushed when many are held."""
    seen: Counter = Counter()
    for b in batches:
        for t in b.column("text").to_pylist():
            seen.update(fold(t).split())
            if len(seen) > 400_000:
                yield _pairs(seen)
                seen.clear()
    if seen:
        yield _pairs(seen)


def _pairs(seen: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(map(_short, seen)), pa.binary()).cast(pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])


def word_counts(text: DataFrame) -> DataFrame:
    """(word, n) of every word of every document."""
    return text.mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, classes: int = CLASSES, tail: int = TAIL) -> Vocabulary:
    """From the counts of all words; ties by word. There are ``classes`` squared ids at least."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    edge = max(classes, math.ceil(math.sqrt(math.sqrt(total) + tail))) ** 2
    rows = counts.orderBy(F.desc("n"), "word").limit(edge - tail).collect()  # the square root of the words
    ids = {r["word"].encode(): i for i, r in enumerate(rows)}
    vocab = Vocabulary(ids, edge, tail, np.zeros(tail), np.array([r["n"] for r in rows], np.float64))
    if rows:
        last = rows[-1]
        rest = counts.where((F.col("n") < last["n"]) | ((F.col("n") == last["n"]) & (F.col("word") > last["word"])))
        for r in rest.mapInArrow(_rooms(tail), "bucket int, room long").groupBy("bucket").agg(F.sum("room").alias("room")).collect():  # ``tail`` rows
            vocab.room[r["bucket"]] = r["room"]
    return vocab


def _rooms(tail: int):
    def run(batches):
        room = np.zeros(tail, np.int64)
        for b in batches:
            bucket = [_bucket(w, tail) for w in b.column("word").cast(pa.binary()).to_pylist()]
            np.add.at(room, np.array(bucket, np.int64), b.column("n").to_numpy() + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(tail, dtype=np.int32)), pa.array(room)], names=["bucket", "room"])

    return run


@dataclass
class Network:
    embed: np.ndarray  # (places x ids) x HIDDEN: each context word's contribution, one table a place
    bias: np.ndarray
    top: np.ndarray  # HIDDEN + 1 x classes
    out: np.ndarray  # ids x HIDDEN + 1
    bounds: np.ndarray  # where each class's ids begin, and the end

    NAMES = ("embed", "bias", "top", "out")

    @classmethod
    def fresh(cls, classes: int, seed: int = 0, bounds: np.ndarray | None = None) -> Network:
        """Of classes that begin at ``bounds``, or of ``classes`` classes of as many ids."""
        bounds = np.arange(classes + 1) * classes if bounds is None else bounds
        r, ids = np.random.default_rng(seed), int(bounds[-1])
        f = np.float32
        return cls(r.normal(0, 0.1, (2 * SIDE * (ids + 1), HIDDEN)).astype(f), np.zeros(HIDDEN, f), r.normal(0, 0.05, (HIDDEN + 1, len(bounds) - 1)).astype(f), r.normal(0, 0.05, (ids, HIDDEN + 1)).astype(f), bounds)

    @classmethod
    def start(cls, vocab: Vocabulary) -> Network:
        """A fresh network that gives each id its share of the corpus."""
        net, n = cls.fresh(vocab.classes, bounds=vocab.bounds), vocab.weights()
        whole = np.add.reduceat(n, net.bounds[:-1])
        net.top[-1], net.out[:, -1] = np.log(whole / n.sum()), np.log(n / np.repeat(whole, np.diff(net.bounds)))
        return net

    @property
    def low(self) -> list[np.ndarray]:
        """Of each class, HIDDEN + 1 x its ids."""
        return [self.out[a:z].T for a, z in zip(self.bounds[:-1], self.bounds[1:], strict=True)]

    def classes_of(self, target: np.ndarray) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))[target]

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def like(self, flat: np.ndarray) -> Network:
        out, at = [], 0
        for n in self.NAMES:
            a = getattr(self, n)
            out.append(flat[at : at + a.size].reshape(a.shape).astype(np.float32))
            at += a.size
        return Network(*out, self.bounds)

    def hidden(self, context: np.ndarray) -> np.ndarray:
        """Rows of HIDDEN + 1 values, the last of them 1."""
        h = np.ones((len(context), HIDDEN + 1), np.float32)
        ids = len(self.embed) // context.shape[1]
        z = self.embed[:ids].take(context[:, 0], axis=0)
        for k in range(1, context.shape[1]):
            z += self.embed[k * ids : (k + 1) * ids].take(context[:, k], axis=0)
        z += self.bias
        np.tanh(z, out=h[:, :-1])
        return h

    def log_probability(self, context: np.ndarray, target: np.ndarray, chunk: int = 1024) -> np.ndarray:
        """Of each target given its context; taken in the order of classes, so each class's table serves many at once."""
        order = np.argsort(target.astype(np.uint16) if len(self.out) <= 1 << 16 else target, kind="stable")
        context, target = context[order], target[order]
        c = self.classes_of(target)
        h, got = np.empty((len(c), HIDDEN + 1), np.float32), np.empty(len(c), np.float32)
        for lo in range(0, len(c), chunk):
            own = slice(lo, lo + chunk)
            h[own] = self.hidden(context[own])
            got[own] = _log_share(np.dot(self.top.T, h[own].T), c[own])
        for i, lo, hi in _runs(c):
            a, z = self.bounds[i], self.bounds[i + 1]
            for at in range(lo, hi, chunk):
                own = slice(at, min(at + chunk, hi))
                got[own] += _log_share(np.dot(self.out[a:z], h[own].T), target[own] - a)
        out = np.empty(len(c), np.float32)
        out[order] = got
        return out


def _runs(c: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, from, to) of the runs of a sorted array."""
    first = np.concatenate([[0], np.flatnonzero(c[1:] != c[:-1]) + 1, [len(c)]]) if len(c) else np.zeros(1, np.int64)
    return list(zip(c[first[:-1]].tolist(), first[:-1].tolist(), first[1:].tolist(), strict=True))


def _log_share(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The logarithm of one row's softmax in each column; overwrites ``x``."""
    x -= x.max(axis=0)
    own = x[at, np.arange(x.shape[1])]
    np.exp(x, out=x)
    return own - np.log(x.sum(axis=0))


def _error(x: np.ndarray, at: np.ndarray) -> None:
    """Softmax less one at each column's row, over the number of columns; in place."""
    n = np.float32(x.shape[1])
    x -= x.max(axis=0)
    np.exp(x, out=x)
    x *= 1 / (x.sum(axis=0) * n)
    x[at, np.arange(x.shape[1])] -= 1 / n


def _errors(x: np.ndarray, begin: np.ndarray, width: np.ndarray, at: np.ndarray) -> None:
    """The same for rows of some widths, one after another."""
    n = np.float32(len(begin))
    x -= np.repeat(np.maximum.reduceat(x, begin), width)
    np.exp(x, out=x)
    x *= np.repeat(1 / (np.add.reduceat(x, begin) * n), width)
    x[begin + at] -= 1 / n


class Trainer:
    """AdaGrad steps on one copy of the network. A row of weights (a word's at a place, an output's) has one accumulator, the
    mean of its squared gradients: half the memory to touch, and a root for each row only."""

    AXES = {"embed": 1, "top": 0, "out": 1, "bias": None}

    def __init__(self, net: Network, rate: float = 0.15):
        self.net, self.rate = net, np.float32(rate)
        self.seen = {n: np.full(np.delete(getattr(net, n).shape, [] if x is None else x), 1e-2, np.float32) for n, x in self.AXES.items()}
        self.width = np.diff(net.bounds)
        self.free, self.grad = np.empty(0, np.float32), np.empty_like(net.out)

    def _step(self, name: str, grad: np.ndarray, at=slice(None)) -> None:
        """Overwrites ``grad``."""
        seen, a, axis = self.seen[name], getattr(self.net, name), self.AXES[name]
        if axis is None:
            more = grad * grad
        else:
            more = np.einsum("rh,rh->r" if axis else "ho,ho->o", grad, grad) / grad.shape[axis]
        now = seen[at] + more
        seen[at] = now
        scale = self.rate / np.sqrt(now)
        grad *= scale if axis is None else np.expand_dims(scale, axis)
        if isinstance(at, slice):
            a -= grad
        else:
            a[at] = np.subtract(a.take(at, axis=0), grad, out=grad)

    def step(self, context: np.ndarray, target: np.ndarray) -> None:
        net = self.net
        order = np.argsort(target.astype(np.uint16) if len(net.out) <= 1 << 16 else target, kind="stable")
        context, target = context[order], target[order]
        c = net.classes_of(target)
        h, runs = net.hidden(context), _runs(c)
        p = np.dot(net.top.T, h.T)
        _error(p, c)
        back = np.dot(p.T, net.top.T)
        # each row as long as its class, one after another
        width = self.width[c]
        ends = np.cumsum(width)
        begin = ends - width
        if len(self.free) < ends[-1]:
            self.free = np.empty(ends[-1] + (ends[-1] >> 2), np.float32)
        q, blocks = self.free[: ends[-1]], []
        for (i, lo, hi), at in zip(runs, begin[[lo for _, lo, _ in runs]].tolist(), strict=True):
            a, z = net.bounds[i], net.bounds[i + 1]
            block = q[at : at + (hi - lo) * (z - a)].reshape(hi - lo, z - a)
            np.dot(h[lo:hi], net.out[a:z].T, out=block)
            blocks.append((block, lo, hi, a, z))
        _errors(q, begin, width, target - net.bounds[c])
        if len(runs) < len(self.width):
            self.grad[:] = 0
        for block, lo, hi, a, z in blocks:
            back[lo:hi] += np.dot(block, net.out[a:z])
            np.dot(block.T, h[lo:hi], out=self.grad[a:z])
        self._step("out", self.grad)
        self._step("top", np.dot(p, h).T)
        g = back[:, :-1]
        g *= 1 - h[:, :-1] ** 2
        self._step("bias", g.sum(axis=0))
        # all places' tables as one: a row for each id at each place
        ids = len(net.embed) // context.shape[1]
        every = (context + np.arange(context.shape[1]) * ids).ravel()
        every = every.astype(np.uint16) if len(net.embed) <= 1 << 16 else every  # short keys are sorted by radix
        order = np.argsort(every, kind="stable")
        every = every[order]
        first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        rows = g.take(order // context.shape[1], axis=0).view(np.complex64)  # sums of two columns at a time
        self._step("embed", np.add.reduceat(rows, first).view(np.float32), every[first])


def _places(group: list[tuple[int, np.ndarray, int, int]], edge: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids with edges between, places of the words, text) of some parts of texts."""
    parts, place, text, at = [np.zeros(0, np.int32)], [], [], SIDE
    for i, x, lo, hi in group:
        a, z = max(0, lo - SIDE), min(len(x), hi + SIDE)
        parts += [np.full(SIDE - lo + a, edge, np.int32), x[a:z].astype(np.int32), np.full(SIDE + hi - z, edge, np.int32)]
        place.append(np.arange(at, at + hi - lo))
        text.append(np.full(hi - lo, i))
        at += hi - lo + 2 * SIDE
    return np.concatenate(parts), np.concatenate(place), np.concatenate(text)


def _around(every: np.ndarray, place: np.ndarray) -> np.ndarray:
    return np.stack([every[place + k] for k in range(-SIDE, SIDE + 1) if k], axis=1)


def contexts(group: list[tuple[int, np.ndarray, int, int]], edge: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(contexts, targets, text) of the words of some parts of texts; ``SIDE`` words on each side."""
    every, place, text = _places(group, edge)
    return _around(every, place), every[place], text


def _parts(ids: list[np.ndarray], words: int = 40_000):
    """Texts, or parts of long ones, in groups of about so many words: (text, its ids, from, to)."""
    group, size = [], 0
    for i, x in enumerate(ids):
        for lo in range(0, len(x), words):
            hi = min(lo + words, len(x))
            group.append((i, x, lo, hi))
            size += hi - lo
            if size >= words:
                yield group
                group, size = [], 0
    if group:
        yield group


def _ids(b: pa.RecordBatch, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) for x in b.column("ids")]


def _train(data, round_: int, rounds: int, mask: int, edge: int, batch: int, pieces: int, kind: type = np.uint16):
    def run(batches):
        net = data.value
        t, n, part, k = Trainer(net.like(net.flat().copy())), 0, TaskContext.get().partitionId(), 0
        for b in small(batches, 4000):
            for group in _parts(_ids(b, kind), max(40_000, mask * batch)):
                every, place, _ = _places(group, edge)
                residue = (np.arange(len(place)) * 2654435761 + k * 40503 + part * 97) % 4294967296 % mask
                k += 1
                for m in range(round_, mask, rounds):
                    own = np.flatnonzero(residue == m)
                    for x in np.array_split(own, -(-len(own) // batch)) if len(own) else ():
                        t.step(_around(every, place[x]), every[place[x]])
                    n += len(own)
        if n:
            for piece, x in enumerate(np.array_split(t.net.flat(), pieces)):
                yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([part], pa.int32()), pa.array([float(n)]), pa.array([x.tobytes()], pa.binary())], names=["piece", "part", "n", "mean"])

    return run


def train(encoded: DataFrame, vocab: Vocabulary, *, rounds: int = 2, mask: int = 8, batch: int = 512, pieces: int = 16) -> Network:
    """Rounds of training over every partition of ``encoded`` (ids) with averaging in between; together they take every word once."""
    spark = encoded.sparkSession
    net = Network.start(vocab)
    pieces = max(pieces, len(net.flat()) >> 16)
    side = max(1, math.isqrt(encoded.rdd.getNumPartitions()))
    shape = T.StructType().add("piece", "integer").add("part", "integer").add("n", "double").add("mean", "binary")
    for r in range(rounds):
        data = spark.sparkContext.broadcast(net)  # the parameters, once
        partial = encoded.select("ids").mapInArrow(_train(data, r, rounds, mask, vocab.edge, batch, pieces, vocab.kind), shape)
        half = partial.withColumn("part", F.pmod("part", F.lit(side))).groupBy("piece", "part").applyInArrow(_mean_table, shape)
        rows = half.groupBy("piece").applyInArrow(_mean_table, shape).collect()  # ``pieces`` rows, one set of parameters
        if not rows:
            break
        net = net.like(np.concatenate([np.frombuffer(x["mean"], np.float32) for x in sorted(rows, key=lambda x: x["piece"])]))
    return net


def _mean_table(table: pa.Table) -> pa.Table:
    total, n = 0.0, 0.0
    for w, x in zip(table.column("n").to_pylist(), table.column("mean"), strict=True):
        total, n = total + w * np.frombuffer(x.as_buffer(), np.float32).astype(np.float64), n + w
    return pa.table({"piece": table.column("piece").slice(0, 1), "part": table.column("part").slice(0, 1), "n": pa.array([n]), "mean": pa.array([(total / n).astype(np.float32).tobytes()], pa.binary())})


def score(documents: DataFrame, *, text_col: str = "text", classes: int = CLASSES, tail: int = TAIL, rounds: int = 2, mask: int = 8, carry: list[str] | None = None) -> DataFrame:
    """Every row (struct ``row``, without the text) with n_words, its summed log-probability (nats) and the mean a word."""
    df = documents.select(row_of(documents, carry, (text_col,)), F.col(text_col).cast("string").alias("text"))
    spark = documents.sparkSession
    counts = cut(word_counts(df.select("text")), "counts")
    vocab = vocabulary(counts, classes, tail)
    words = spark.sparkContext.broadcast(vocab)  # the square root of the corpus's words, of at most LONGEST bytes

    def encode(batches):
        v, uid = words.value, TaskContext.get().partitionId() << 40
        for b in small(batches):
            ids, rest = zip(*(v.encode(fold(t).split()) for t in b.column("text").to_pylist()), strict=True)
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(np.arange(uid, uid + b.num_rows)), pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([b" ".join(x) for x in rest], pa.binary()).cast(pa.string())], names=["row", "uid", "ids", "rest"])
            uid += b.num_rows

    encoded = cut(df.mapInArrow(encode, df.select("row").schema.add("uid", "long").add("ids", "binary").add("rest", "string")), "words")
    total = 0 if vocab.times is None else int(vocab.times.sum() + vocab.room.sum())
    batch = min(8192, max(512, math.isqrt(total) // 4))
    data = spark.sparkContext.broadcast(train(encoded, vocab, rounds=rounds, mask=mask, batch=batch))
    edge, kind = vocab.edge, vocab.kind

    def judge(batches):
        for b in small(batches, 4000):
            ids = _ids(b, kind)
            n, total = np.array([len(x) for x in ids], np.int64), np.zeros(len(ids))
            for group in _parts(ids):
                context, target, text = contexts(group, edge)
                p = data.value.log_probability(context, target)
                total += np.bincount(text, p.astype(np.float64) - words.value.log_room(target), len(ids))
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("uid"), pa.array(n), pa.array(total)], names=["row", "uid", "n_words", "part"])

    judged = encoded.select("row", "uid", "ids").mapInArrow(judge, encoded.select("row", "uid").schema.add("n_words", "long").add("part", "double"))
    # log n of every tail word; that of words counted once is 0
    once = encoded.where("rest != ''").select("uid", F.explode(F.split("rest", " ")).alias("word")).select("uid", F.xxhash64("word").alias("h"))
    shares = once.join(counts.where("n > 1").select(F.xxhash64("word").alias("h"), F.log("n").alias("log_n")), "h").groupBy("uid").agg(F.sum("log_n").alias("log_n"))
    total = F.col("part") + F.coalesce("log_n", F.lit(0.0))
    return judged.join(shares, "uid", "left").select("row", "n_words", total.alias("log_likelihood"), F.when(F.col("n_words") > 0, total / F.col("n_words")).alias("mean_log_likelihood"))
