"""Quality score by positive-unlabelled learning.

A linear model over binned signals of the whole text (length, repetition,
symbols, case, lines) is fitted to minimise the non-negative unbiased risk

    pi E_p[l(g)] + max(0, E_u[l(-g)] - pi E_p[l(-g)])

with the logistic loss l: trusted positives p (label 1), unlabelled documents
u (no label is read for them) and the class prior pi, estimated as the share of
label 1 among the labelled training rows.  Where the second term falls below
zero its gradient is turned round, so the model cannot drive it negative.

Fitting uses at most ``max_positive`` and ``max_unlabelled`` documents (the
first ones by a hash of the id); the prior counts all labels of the training
folds, and every document is scored.  Ids, language and source are no inputs.

Null and empty texts have signals of zero and are scored like others.  Rows
are scored one by one.  Without positives or without texts to learn from every
score is the prior (0.5 if there is no label).  Labels with a null are unused.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import batches, blobs, prepare

MAX_POSITIVE = 8_000
MAX_UNLABELLED = 8_000
BINS = 12
_SYMBOLS, _UPPER, _DIGITS = b"#*$%&|<>", bytes(range(65, 91)), b"0123456789"
_STOPS, _MARKS = b".,;:?", b"!"
_HIGH = bytes(range(128, 256))


def signals(t: bytes) -> list[float]:
    """Signals of one whole text."""
    words = t.split()
    n, size = max(len(words), 1), max(len(t), 1)
    lines = [x for x in t.split(b"\n") if x.strip()]
    share = [(len(t) - len(t.translate(None, s))) / size for s in (_SYMBOLS, _UPPER, _DIGITS, _STOPS, _MARKS, _HIGH)]
    pairs = len(set(zip(words, words[1:], strict=False)))
    top = max(Counter(words).values(), default=0)
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [np.log1p(len(words)), sum(map(len, words)) / n, len(set(words)) / n, pairs / n, top / n, same / n,
            len(set(lines)) / max(len(lines), 1), len(words) / max(len(lines), 1), t.count(b"|") / n, *share]


SIGNALS = len(signals(b""))


class Model:
    """Bin edges of the signals, weights of the bins, bias."""

    def __init__(self, edges: np.ndarray, weights: np.ndarray, bias: float):
        self.edges, self.weights, self.bias = edges, weights, bias

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Column of each signal's bin, in the one-hot layout."""
        return np.stack([np.searchsorted(self.edges[j], x[:, j], "right") + j * BINS for j in range(SIGNALS)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.weights[self.bins(x)].sum(axis=1) + self.bias)))


def fit(p: np.ndarray, u: np.ndarray, prior: float, steps: int = 600, rate: float = 0.05,
        decay: float = 1e-4) -> Model:
    """Minimise the non-negative risk by Adam on the whole sample."""
    both = np.concatenate([p, u])
    edges = np.quantile(both, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    m = Model(edges, np.zeros(SIGNALS * BINS), float(np.log(prior / (1 - prior))))
    bp, bu = m.bins(p), m.bins(u)
    a = b = np.zeros(SIGNALS * BINS + 1)
    for step in range(1, steps + 1):
        gp, gu = (m.weights[x].sum(axis=1) + m.bias for x in (bp, bu))
        sp, su = 1 / (1 + np.exp(-gp)), 1 / (1 + np.exp(-gu))
        negative = np.log1p(np.exp(gu)).mean() - prior * np.log1p(np.exp(gp)).mean()
        if negative >= 0:                    # d l(g) = s - 1, d l(-g) = s
            cp, cu = prior * (sp - 1) - prior * sp, su
        else:
            cp, cu = prior * sp, -su
        grad = np.zeros(SIGNALS * BINS + 1)
        for idx, c in ((bp, cp / len(p)), (bu, cu / len(u))):
            grad[:-1] += np.bincount(idx.ravel(), np.repeat(c, SIGNALS), SIGNALS * BINS)
            grad[-1] += c.sum()
        grad[:-1] += decay * m.weights
        a, b = 0.9 * a + 0.1 * grad, 0.99 * b + 0.01 * grad**2
        move = rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
        m.weights, m.bias = m.weights - move[:-1], m.bias - move[-1]
    return m


def _collect(texts: DataFrame) -> np.ndarray:
    """Signals of the texts (a bounded sample)."""
    def run(it):
        for batch in it:
            x = np.array([signals(t) for t in blobs(batch)]).reshape(-1, SIGNALS)
            yield from batches({"x": (list(x), pa.list_(pa.float64()))})
    rows = texts.mapInArrow(run, "x array<double>").collect()
    return np.array([r.x for r in rows]).reshape(-1, SIGNALS)


def fold(id_col: str, of: int) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % of


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_positive: int = MAX_POSITIVE,
          max_unlabelled: int = MAX_UNLABELLED) -> tuple[Model | None, float]:
    """(model, prior) from the rows of both tables (pass training rows only)."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    n, ones = known.agg(F.count("*"), F.sum((F.col(label_col) == 1).cast("long"))).first()
    prior = min(max((ones or 0) / n, 0.01), 0.99) if n else 0.5
    texts = docs.select(F.col(id_col).alias("_d"), F.col(text_col).alias("_t"))
    order = F.xxhash64("_d")

    def first(ids: DataFrame, limit: int) -> np.ndarray:
        ids = ids.distinct().orderBy(order, "_d").limit(limit)         # small by its limit
        return _collect(texts.join(F.broadcast(ids), "_d", "left_semi"))

    p = first(known.filter(F.col(label_col) == 1).select(F.col(id_col).alias("_d")), max_positive)
    u = first(texts.select("_d"), max_unlabelled)
    return (fit(p, u, prior) if len(p) and len(u) else None), prior


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          folds: int = 5, held_out: int = 0, threshold: float = 0.3, **options) -> DataFrame:
    """(id, held_out, score, predicted) of every row (held_out is false for a
    null id, which is not learned from either); learned without the
    rows of the held-out fold."""
    prepare(docs.sparkSession)
    train = fold(id_col, folds) != held_out
    model, prior = learn(docs.filter(train), labels.filter(train), id_col, text_col, **options)

    def run(it):
        for batch in it:
            x = np.array([signals(t) for t in blobs(batch)]).reshape(-1, SIGNALS)
            s = model.score(x) if model else np.full(len(x), prior)
            yield from batches({"_d": (batch.column("_d"), batch.schema.field("_d").type), "score": (s, pa.float64())})

    kind = docs.schema[id_col].dataType.simpleString()
    d = docs.select(F.col(id_col).alias("_d"), F.col(text_col).alias("_t")).mapInArrow(run, f"_d {kind}, score double")
    return d.select(F.col("_d").alias(id_col), F.coalesce(fold("_d", folds) == held_out, F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted"))
