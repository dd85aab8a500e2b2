"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on every document; most look for one defect and never vote good. Votes are counted by pattern over all documents (a
bounded table whatever the input), and expectation-maximisation over those counts estimates how each labeller votes on
good and on bad documents. The posterior of its pattern is a document's weak label. A linear scorer over hashed words and
hashed character-class 4-grams is trained on the weak labels of at most ``sample`` documents of at most ``max_chars``
characters (documented bounds), and scores every whole text.

Defined results: a null text counts as empty; every labeller abstains on it except the one on length, and the scorer gives
it its bias; repeated documents each get a row; an empty table gives no rows. Other columns are kept in ``row``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FOLD, Words, chunks, mix, row_of, small

BUCKETS, SAMPLE, MAX_CHARS = 1 << 17, 6000, 20_000
#: The commonest function words of the languages at hand, a fixed list.
STOP = "the of and to in is that it for as with on by this der die das und von zu den mit ist le la les de et des que pour en un une el los las por con del se una"
_CLASS = np.array([0 if c in (32, 9, 13) else 1 if c == 10 else 2 if 48 <= c <= 57 else 3 if 65 <= c <= 90 else 4 if 97 <= c <= 122 or c > 127 else 5 + c % 11 for c in range(256)], np.uint64)
_STOP_HASH = np.sort(Words([STOP.encode()]).hash())
LABELLERS = ("length", "symbols", "capitals", "digits", "line_repeats", "word_repeats", "stop_words", "word_length", "run_of_one")


def _share(mask: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    return (total[at + size] - total[at]) / np.maximum(size, 1)


def votes(raw: list[bytes]) -> np.ndarray:
    """Texts x labellers: 1 good, 0 bad, -1 nothing."""
    w = Words([t.translate(FOLD) for t in raw])
    size = np.array([len(t) for t in raw], np.int64)
    at = np.concatenate([[1], 1 + np.cumsum(size + 1)])[:-1].astype(np.int64)
    cls = _CLASS[np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)]
    n = np.maximum(w.n, 1)
    symbols, capitals, digits = (_share(m, at, size) for m in (cls >= 5, cls == 3, cls == 2))
    letters = _share((cls == 3) | (cls == 4), at, size)
    h = w.hash()
    doc = np.repeat(np.arange(len(raw)), w.n)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    runs = np.bincount(doc[same], minlength=len(raw)) / n
    with np.errstate(over="ignore"):
        own = mix(h + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    distinct = np.bincount(doc[np.unique(own, return_index=True)[1]], minlength=len(raw))
    stop = np.bincount(doc[np.isin(h, _STOP_HASH)], minlength=len(raw)) / n
    length = np.bincount(doc, w.end - w.start, len(raw)) / n
    lines = np.zeros(len(raw))
    for i, t in enumerate(raw):
        own = [x for x in t.split(b"\n") if x.strip()]
        lines[i] = 1 - len(set(own)) / len(own) if len(own) > 3 else 0
    bad = lambda x: np.where(x, 0, -1)
    either = lambda good, x: np.where(x, 0, np.where(good, 1, -1))
    out = np.stack(
        [
            either(w.n >= 60, w.n < 10),
            bad(symbols > 0.07),
            bad(capitals > 0.4 * np.maximum(letters, 1e-9)),
            bad(digits > 0.15),
            bad(lines > 0.3),
            bad(distinct < 0.15 * np.minimum(n, 400)),
            either(stop > 0.1, stop < 0.01),
            bad((length < 2.5) | (length > 14)),
            bad(runs > 0.2),
        ],
        axis=1,
    )
    out[w.n == 0, 1:] = -1
    return out.astype(np.int8)


def pattern_of(v: np.ndarray) -> np.ndarray:
    return ((v.astype(np.int64) + 1) * 3 ** np.arange(v.shape[1])).sum(axis=1)


@dataclass
class LabelModel:
    """P(good), and P(vote | class) as labellers x 2 x 3."""

    prior: float
    table: np.ndarray

    def posterior(self, pattern: np.ndarray) -> np.ndarray:
        v = (pattern[:, None] // 3 ** np.arange(len(self.table))) % 3
        p = np.log(self.table)[np.arange(len(self.table))[None, :], :, v].sum(axis=1)  # patterns x 2
        odds = p[:, 1] - p[:, 0] + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-odds))


def fit_labels(pattern: np.ndarray, count: np.ndarray, n: int = len(LABELLERS), rounds: int = 200) -> LabelModel:
    """Expectation-maximisation over counted vote patterns.

    It starts from the belief that a bad vote is ten times as likely on a bad document and a good one twice as likely on a
    good one, and that one document in seven is bad.
    """
    table = np.empty((n, 2, 3))
    table[:, 0], table[:, 1] = (0.4, 0.3, 0.3), (0.37, 0.03, 0.6)
    model = LabelModel(0.85, table)
    v = (pattern[:, None] // 3 ** np.arange(n)) % 3
    one = np.stack([v == k for k in range(3)], axis=2).astype(float)  # patterns x labellers x votes
    for _ in range(rounds):
        p = model.posterior(pattern)
        new = np.empty_like(table)
        for y, q in ((0, 1 - p), (1, p)):
            c = np.einsum("p,plv->lv", q * count, one) + model.table[:, y] * 2 + 0.01
            new[:, y] = c / c.sum(axis=1, keepdims=True)
        prior = float(np.clip((p * count).sum() / max(count.sum(), 1), 0.02, 0.98))
        moved = np.abs(new - model.table).max()
        model = LabelModel(prior, new)
        if moved < 1e-6:
            break
    return model


def features(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, weight): each text's hashed words and class 4-grams, each kind with squares that sum to 1."""
    w = Words([t.translate(FOLD) for t in raw])
    doc = np.repeat(np.arange(len(raw)), w.n)
    word = (w.hash() >> np.uint64(48)).astype(np.int64)
    size = np.array([len(t) for t in raw], np.int64)
    cls = _CLASS[np.frombuffer(b" " + b"    ".join(raw) + b"    ", np.uint8)]  # four blanks: no gram sees the next text
    with np.errstate(over="ignore"):
        gram = mix(cls[:-3] + cls[1:-2] * np.uint64(31) + cls[2:-1] * np.uint64(961) + cls[3:] * np.uint64(29791)) >> np.uint64(48)
    at = np.concatenate([[1], 1 + np.cumsum(size + 4)])[:-1]
    own = np.repeat(np.arange(len(raw)), size)
    place = np.repeat(at - (np.cumsum(size) - size), size) + np.arange(size.sum())
    parts = []
    for d, b in ((doc, word), (own, gram[place].astype(np.int64) + (1 << 16))):
        key, times = np.unique(d * BUCKETS + b, return_counts=True)
        d, b = key // BUCKETS, key % BUCKETS
        x = np.sqrt(times)
        parts.append((d, b, x / np.sqrt(np.bincount(d, x * x, len(raw)))[d]))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def score(self, raw: list[bytes]) -> np.ndarray:
        d, b, x = features(raw)
        return 1 / (1 + np.exp(-(np.bincount(d, x * self.weights[b], len(raw)) + self.bias)))


def fit_scorer(raw: list[bytes], target: np.ndarray, *, epochs: int = 8, batch: int = 200, rate: float = 0.5) -> Scorer:
    theta, seen, bias = np.zeros(BUCKETS), np.full(BUCKETS, 1e-4), 0.0
    order = np.random.default_rng(0).permutation(len(raw))
    ready = [(features([raw[i] for i in order[lo : lo + batch]]), target[order[lo : lo + batch]]) for lo in range(0, len(raw), batch)]
    for _ in range(epochs):
        for (d, b, x), y in ready:
            p = 1 / (1 + np.exp(-(np.bincount(d, x * theta[b], len(y)) + bias)))
            err = (y - p) / len(y)
            grad = np.bincount(b, x * err[d], BUCKETS) - 1e-6 * theta
            seen += grad**2
            theta += rate * grad / np.sqrt(seen)
            bias += rate * err.sum()
    return Scorer(theta, bias)


def _map(fn, names: list[str]):
    def run(batches):
        for b in small(batches):
            raw = [x or b"" for x in b.column("text").cast(pa.binary()).to_pylist()]
            cols = [[] for _ in names]
            for _, part in chunks(raw, 1 << 20):
                for c, x in zip(cols, fn(part), strict=True):
                    c.append(x)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in b.schema.names if c != "text"), *(pa.array(np.concatenate(c)) for c in cols)], names=[*(c for c in b.schema.names if c != "text"), *names])

    return run


def classify(documents: DataFrame, *, text_col: str = "text", sample: int = SAMPLE, max_chars: int = MAX_CHARS, carry: list[str] | None = None) -> DataFrame:
    """Every row (struct ``row``) with the labellers' posterior ``weak`` and the scorer's ``score``, both P(good)."""
    spark = documents.sparkSession
    df = documents.select(row_of(documents, carry), F.col(text_col).cast("string").alias("text"))
    text = df.select("text")
    voted = text.mapInArrow(_map(lambda part: [pattern_of(votes(part))], ["pattern"]), "pattern long")
    counts = voted.groupBy("pattern").agg(F.count("*").alias("n")).toPandas()  # at most 3 ** labellers rows
    if not len(counts):
        return df.select("row", F.lit(None).cast("double").alias("weak"), F.lit(None).cast("double").alias("score"))
    labels = fit_labels(counts["pattern"].to_numpy(np.int64), counts["n"].to_numpy(float))
    short = text.where(F.length("text") <= max_chars).select(F.xxhash64("text").alias("h"))
    least = short.distinct().orderBy("h").limit(sample)  # at most ``sample`` hashes
    chosen = text.where(F.length("text") <= max_chars).withColumn("h", F.xxhash64("text")).join(F.broadcast(least), "h").groupBy("h").agg(F.min("text").alias("text")).orderBy("h").toPandas()
    raw = [t.encode() for t in chosen["text"]]
    target = np.concatenate([labels.posterior(pattern_of(votes(p))) for _, p in chunks(raw, 1 << 20)]) if raw else np.zeros(0)
    data = spark.sparkContext.broadcast((labels, fit_scorer(raw, target)))  # a fixed size

    def judge(part):
        model, scorer = data.value
        return [model.posterior(pattern_of(votes(part))), scorer.score(part)]

    return df.mapInArrow(_map(judge, ["weak", "score"]), df.select("row").schema.add("weak", "double").add("score", "double"))
