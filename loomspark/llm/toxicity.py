"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Tokens are words; their features are hashes of the word, of its first bytes, and of its neighbours. Labels exist for
documents only, so tokens are labelled from them: a word or beginning that stands almost only in toxic documents marks
the tokens it covers there. The field is trained on those tokens; forward-backward marginals give each token's
probability of being toxic, a logistic layer over their sum, maximum and mean gives the document's, and tokens above
one half are the offending spans.

Training sees at most ``per_class`` toxic and twice as many clean labelled documents, of at most ``max_chars``
characters each (a documented bound; class weights restore the proportions). Scoring sees every whole text.

Defined results: a null text counts as empty; an empty text scores the logistic layer's base rate; labels that are null,
or that differ for one document id, take no part; repeated documents each get a row; without labels of both classes
every score is the share of toxic labels (0 without labels).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import FOLD, Words, chunks, fold, row_of

BUCKETS = 1 << 18
REJECT = 0.3
#: Feature templates: first bytes of the word (None: all) and the place relative to the token.
TEMPLATES = ((None, 0), (4, 0), (5, 0), (6, 0), (None, -1), (None, 1))
BLOCK = 256


def features(w: Words) -> np.ndarray:
    """Bucket numbers, tokens x templates."""
    out = np.empty((len(w.start), len(TEMPLATES)), np.int32)
    cache: dict = {}
    for j, (k, shift) in enumerate(TEMPLATES):
        h = cache.get(k)
        if h is None:
            h = cache[k] = w.hash(k)
        h = np.roll(h, -shift) if shift else h
        with np.errstate(over="ignore"):
            out[:, j] = ((h * np.uint64(2 * j + 3) + np.uint64(j)) >> np.uint64(46)).astype(np.int32)
        if shift:  # no neighbour beyond the text's ends
            some = w.n > 0
            edge = w.first[some] if shift < 0 else w.upto[some] - 1
            out[edge, j] = j
    return out


def boundaries(n: np.ndarray) -> np.ndarray:
    """True at the first token of each text; ``n``: the texts' numbers of tokens."""
    b = np.zeros(int(n.sum()), bool)
    b[(np.cumsum(n) - n)[n > 0]] = True
    return b


def _composites(m: np.ndarray, odds: np.ndarray, new: np.ndarray):
    """For each block (row) the two start vectors' images; odds, new: blocks x steps."""
    k = len(odds)
    a, b, c, d = np.ones(k), np.zeros(k), np.zeros(k), np.ones(k)
    for t in range(odds.shape[1]):
        e, s = odds[:, t], new[:, t]
        m00, m01, m10, m11 = (np.where(s, 1.0, x) for x in m.ravel())
        a, b = a * m00 + b * m10, (a * m01 + b * m11) * e
        c, d = c * m00 + d * m10, (c * m01 + d * m11) * e
        z = 1.0 / (a + b + c + d)
        a, b, c, d = a * z, b * z, c * z, d * z
    return a, b, c, d


def _ratios(m: np.ndarray, odds: np.ndarray, new: np.ndarray) -> np.ndarray:
    """alpha(1)/alpha(0) at each token of one long chain; at ``new`` tokens the chain starts afresh.

    The chain is cut into blocks that advance together: a block's map of ratios is a 2x2 matrix, so the ratios at the
    blocks' starts follow from one pass over the blocks.
    """
    n = len(odds)
    rows = -(-n // BLOCK)
    pad = rows * BLOCK - n
    e = np.concatenate([odds, np.ones(pad)]).reshape(rows, BLOCK)
    s = np.concatenate([new, np.ones(pad, bool)]).reshape(rows, BLOCK)
    start = np.ones(rows)
    a, b, c, d = _composites(m, e, s)
    r = 1.0
    for i in range(rows - 1):
        r = (b[i] + r * d[i]) / (a[i] + r * c[i])
        start[i + 1] = r
    out = np.empty((rows, BLOCK))
    r = start
    m00, m01, m10, m11 = m.ravel()
    for t in range(BLOCK):
        r = np.where(s[:, t], 1.0, (m01 + r * m11) / (m00 + r * m10)) * e[:, t]
        out[:, t] = r
    return out.ravel()[:n]


def forward_backward(score: np.ndarray, trans: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of label 1, and the forward and backward odds."""
    if not len(score):
        z = np.zeros(0)
        return z, z, z
    m, odds = np.exp(trans), np.exp(np.clip(score, -30, 30))
    r = _ratios(m, odds, new)
    # backward over the reversed chain: a token's message comes from its successor, whose odds it takes
    last = np.roll(new, -1)
    last[-1] = True
    back = _ratios(m.T, odds[::-1], last[::-1])[::-1]  # includes the token's own odds
    b = back / odds
    p = r * b
    return p / (1 + p), r, b


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    trans: np.ndarray
    layer: np.ndarray  # of the logistic layer: intercept, log1p(sum), max, mean

    def tokens(self, f: np.ndarray, new: np.ndarray) -> np.ndarray:
        return forward_backward(self.weights[f].sum(axis=1, dtype=np.float64) + self.bias, self.trans, new)[0]

    def documents(self, p: np.ndarray, n: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(summary(p, n) @ self.layer)))


def summary(p: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Per text: 1, log1p of the marginals' sum, their maximum and mean."""
    out = np.zeros((len(n), 4))
    out[:, 0] = 1
    some = n > 0
    if some.any():
        first = (np.cumsum(n) - n)[some]
        total = np.add.reduceat(p, first)
        out[some, 1], out[some, 2], out[some, 3] = np.log1p(total), np.maximum.reduceat(p, first), total / n[some]
    return out


def label_tokens(f: np.ndarray, doc: np.ndarray, toxic: np.ndarray, weight: np.ndarray, *, purity: float = 0.9, chance: float = 2.0) -> np.ndarray:
    """Tokens of toxic documents with a word or beginning that almost only toxic documents have.

    It must stand in so many of them that, were labels random, fewer than ``chance`` such buckets would be expected.
    """
    out = np.zeros(len(f), bool)
    share = min(max(toxic.mean(), 1e-6), 1 - 1e-6) if len(toxic) else 0.5
    for j, (_, shift) in enumerate(TEMPLATES):
        if shift:
            continue
        pair = np.unique(f[:, j].astype(np.int64) * len(toxic) + doc)
        bucket, who = pair // len(toxic), pair % len(toxic)
        least = max(3, np.ceil(np.log(max(len(np.unique(bucket)), 1) / chance) / np.log(1 / share)))
        n1 = np.bincount(bucket[toxic[who]], minlength=BUCKETS)
        w1 = np.bincount(bucket[toxic[who]], weight[who[toxic[who]]], BUCKETS)
        w0 = np.bincount(bucket[~toxic[who]], weight[who[~toxic[who]]], BUCKETS)
        out |= ((n1 >= least) & (w1 >= purity * (w1 + w0)))[f[:, j]]
    return out & toxic[doc]


def train(texts: list[str], toxic: list[int], class_weight: dict[int, float], *, epochs: int = 5, batch: int = 250, rate: float = 0.25) -> Model:
    """Fit the field by AdaGrad over batches of documents, then the logistic layer by Newton's method."""
    y = np.array(toxic, bool)
    weight = np.where(y, class_weight[1], class_weight[0])
    order = np.random.default_rng(0).permutation(len(texts))
    texts, y, weight = [texts[i] for i in order], y[order], weight[order]
    parts, sizes = [], []
    for _, part in chunks([fold(t) for t in texts], 1 << 20):
        w = Words(part)
        parts.append(features(w))
        sizes.append(w.n)
    f, n = np.concatenate(parts), np.concatenate(sizes)
    del parts, w
    new, upto = boundaries(n), np.cumsum(n)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), n)
    gold = label_tokens(f, doc, y, weight)
    usable = ~y | (np.bincount(doc[gold], minlength=len(texts)) > 0)  # toxic documents without a marked token say nothing here
    theta, seen = np.zeros(BUCKETS, np.float32), np.full(BUCKETS, 1e-3, np.float32)
    small, small_seen = np.array([-3.0, 1.0, 0.0, 0.0, 1.0]), np.full(5, 1e-3)
    for _ in range(max(epochs, -(-60 * batch // len(texts)))):  # at least 60 steps
        for lo in range(0, len(texts), batch):
            docs = np.flatnonzero(usable[lo : lo + batch]) + lo
            t = np.concatenate([np.arange(upto[i] - n[i], upto[i]) for i in docs]) if len(docs) else np.zeros(0, int)
            if not len(t):
                continue
            ff, nn, g = f[t], new[t], gold[t].astype(float)
            trans = small[1:].reshape(2, 2)
            p, r, b = forward_backward(theta[ff].sum(axis=1, dtype=np.float64) + small[0], trans, nn)
            size = 1.0 / len(docs)
            err = (g - p) * size
            grad = np.bincount(ff.ravel(), np.repeat(err, len(TEMPLATES)), BUCKETS) - 1e-5 * theta
            seen += grad**2
            theta += (rate * grad / np.sqrt(seen)).astype(np.float32)
            m, inner = np.exp(trans).ravel(), np.flatnonzero(~nn)
            odds = r[inner - 1]
            nxt = np.exp(np.clip(theta[ff[inner]].sum(axis=1, dtype=np.float64) + small[0], -30, 30)) * b[inner]
            joint = np.stack([np.full(len(inner), m[0]), m[1] * nxt, m[2] * odds, m[3] * odds * nxt])
            joint /= joint.sum(axis=0)
            was = (2 * g[inner - 1] + g[inner]).astype(int)
            gs = np.concatenate([[err.sum()], (np.bincount(was, minlength=4) - joint.sum(axis=1)) * size])
            small_seen += gs**2
            small += 0.1 * gs / np.sqrt(small_seen)
    model = Model(theta, float(small[0]), small[1:].reshape(2, 2), np.zeros(4))
    starts = np.arange(0, len(texts), batch)
    p = np.concatenate([model.tokens(f[a:b], new[a:b]) for a, b in ((upto[i] - n[i], upto[min(i + batch, len(texts)) - 1]) for i in starts)])
    x = summary(p, n)
    layer, ridge = np.zeros(4), np.diag([1e-6, 1e-2, 1e-2, 1e-2]) * weight.sum() / 100
    for _ in range(25):
        q = 1 / (1 + np.exp(-(x @ layer)))
        h = (x * (weight * q * (1 - q))[:, None]).T @ x + ridge
        layer = layer + np.clip(np.linalg.solve(h, x.T @ (weight * (y - q)) - ridge @ layer), -2, 2)
    model.layer = layer
    return model


def fit(documents: DataFrame, labels: DataFrame, keep: Column, *, doc_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = 1500, max_chars: int = 20_000) -> Model | float:
    """The model, or the share of toxic labels where there aren't both classes. ``keep``: labels that may be learned from."""
    known = labels.where(keep & F.col(doc_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(doc_col).alias("id")).agg(F.min(label_col).alias("y"), F.max(label_col).alias("y2")).where("y = y2")
    n = {int(r["y"]): int(r["n"]) for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return float(max(n, default=0))
    part = [known.where(F.col("y") == c).orderBy(F.xxhash64("id"), "id").limit(per_class * (1 if c else 2)) for c in n]
    chosen = F.broadcast(part[0].unionByName(part[1]).select("id", "y"))  # at most 3 x per_class rows
    own = documents.select(F.col(doc_col).alias("id"), F.col(text_col).cast("string").alias("text")).where(F.length("text") <= max_chars)
    rows = own.join(chosen, "id").groupBy("id").agg(F.min("text").alias("text"), F.first("y").alias("y")).orderBy("id").toPandas()
    got = rows["y"].value_counts().to_dict()
    if len(got) < 2:
        return n.get(1, 0) / sum(n.values())
    return train(rows["text"].tolist(), rows["y"].tolist(), {c: n[c] / got[c] for c in got})


def held_out(doc_col: str = "doc_id") -> Column:
    """Rows kept from learning: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.coalesce(F.col(doc_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def score(documents: DataFrame, model: Model | float, *, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Every row (struct ``row``) with its score and its offending spans (code points, with the token's probability)."""
    data = documents.sparkSession.sparkContext.broadcast(model)  # a fixed size
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def judge(text: pa.Array) -> pa.Array:
        m = data.value
        scores, spans = np.zeros(len(text)), [[] for _ in range(len(text))]
        if isinstance(m, float):
            scores[:] = m
            return pa.StructArray.from_arrays([pa.array(scores), pa.array(spans, span)], ["score", "spans"])
        for lo in range(0, len(text), 500):
            raw = [x or b"" for x in text.slice(lo, 500).cast(pa.binary()).to_pylist()]
            for at, part in chunks(raw):
                w = Words([x.translate(FOLD) for x in part])
                p = m.tokens(features(w), boundaries(w.n))
                scores[lo + at : lo + at + len(part)] = m.documents(p, w.n)
                hot = np.flatnonzero(p > 0.5)
                owner = np.searchsorted(w.upto, hot, side="right")
                base = np.concatenate([[1], 1 + np.cumsum([len(x) + 1 for x in part])])
                for i in np.unique(owner).tolist():
                    # code points before each byte: those that don't continue a character
                    before = np.concatenate([[0], np.cumsum((np.frombuffer(part[i], np.uint8) & 0xC0) != 0x80)])
                    own = hot[owner == i]
                    start, end = before[w.start[own] - base[i]], before[w.end[own] - base[i]]
                    spans[lo + at + i] = [{"start": x, "end": y, "p": z} for x, y, z in zip(start.tolist(), end.tolist(), p[own].tolist(), strict=True)]
        return pa.StructArray.from_arrays([pa.array(scores), pa.array(spans, span)], ["score", "spans"])

    judged = F.arrow_udf(judge, "score double, spans array<struct<start:long,end:long,p:double>>")
    out = documents.select(row_of(documents, carry), judged(F.col(text_col).cast("string")).alias("judged"))
    return out.select("row", "judged.score", "judged.spans")
