"""Language identification with string kernels.

A text's letters (lower case, other characters as one space) give the set of
its character n-grams for n = 1, 2, 3, hashed to a fixed number of places by
length.  The blended-spectrum presence kernel of two texts is the mean over n
of |X_n and Y_n| / sqrt(|X_n| |Y_n|).  With m landmark texts, drawn evenly over
the languages of the training sample, the Nystroem map sends a text to its m
kernel values times K_mm^(-1/2); one-versus-rest ridge regression on these
gives a weight vector a language.  Scoring is two matrix products by batch.

Fitting uses at most ``max_train`` labelled documents (the first ones by a
hash of the id).  Ids, language and source are no inputs.

The score is the winner's regression value, from -1..1 mapped to 0..1.  A text
that is null or has no letter is ``und`` with score 0; so is every text if
nothing could be learned.  Rows are scored one by one; long texts are taken
whole, by pieces.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import batches, prepare
from tillpoint.llm.hashing import mix
from tillpoint.llm.quality_classifier import fold

ORDERS = ((1, 512), (2, 1024), (3, 4096))      # (n, places)
SIZE = sum(p for _, p in ORDERS)
MAX_TRAIN = 4_000
LANDMARKS = 160
RIDGE = 1e-3
ROWS = 256
PIECE = 1 << 20
UNKNOWN = "und"
_letters: np.ndarray | None = None


def _is_letter(points: np.ndarray) -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters[points]


def _points(text: str | None) -> np.ndarray:
    """Code points of the letters in lower case; 32 for each other run."""
    p = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    p = np.where(_is_letter(p), p, 32)
    return p[np.concatenate([[True], (p[1:] != 32) | (p[:-1] != 32)])[:len(p)]] if len(p) else p


def presence(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(matrix of n-gram places by text, whether a text has a letter)."""
    out = np.zeros((len(texts), SIZE), bool)
    flat = out.reshape(-1)
    has = np.zeros(len(texts), bool)
    for i, t in enumerate(texts):
        p = _points(t)
        has[i] = bool((p != 32).any())
        for s in range(0, len(p), PIECE):
            q = np.concatenate([[32], p[s:s + PIECE + 2], [32]]).astype(np.uint64)
            base = i * SIZE
            h = np.zeros(len(q), np.uint64)
            for n, places in ORDERS:
                h = h[:len(q) - n + 1] * np.uint64(0x100000001B3) + q[n - 1:]
                flat[base + (mix(h) % np.uint64(places)).astype(np.int64)] = True
                base += places
    return out, has


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows whose inner products are the blended kernel."""
    out = x.astype(np.float32)
    at = 0
    for _, places in ORDERS:
        part = out[:, at:at + places]
        norm = np.sqrt(part.sum(axis=1, keepdims=True)) * np.sqrt(len(ORDERS))
        part /= np.maximum(norm, 1)
        at += places
    return out


class Model:
    """Landmarks and one weight vector a language."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        self.names = sorted(set(langs))
        x = _scaled(x)
        lang = np.array([self.names.index(v) for v in langs])
        rank = np.zeros(len(x), int)               # place within the language: drawn evenly
        for k in range(len(self.names)):
            rank[lang == k] = np.arange((lang == k).sum())
        chosen = np.lexsort((lang, rank))[:LANDMARKS]
        self.landmarks = np.ascontiguousarray(x[chosen].T)
        k = x[chosen] @ self.landmarks
        val, vec = np.linalg.eigh(k.astype(np.float64))
        root = vec @ np.diag(1 / np.sqrt(np.maximum(val, 1e-6))) @ vec.T
        z = (x @ self.landmarks).astype(np.float64) @ root
        y = np.where(lang[:, None] == np.arange(len(self.names)), 1.0, -1.0)
        z1 = np.concatenate([z, np.ones((len(z), 1))], axis=1)
        w = np.linalg.solve(z1.T @ z1 + RIDGE * len(z) * np.eye(z1.shape[1]), z1.T @ y)
        self.weights, self.bias = (root @ w[:-1]).astype(np.float32), w[-1].astype(np.float32)

    def values(self, x: np.ndarray) -> np.ndarray:
        return (_scaled(x) @ self.landmarks) @ self.weights + self.bias


def learn(docs: DataFrame, id_col: str, text_col: str, lang_col: str, max_train: int) -> Model | None:
    known = docs.filter(F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("_d"), F.col(text_col).alias("_t"), F.col(lang_col).alias("_l"))
    ids = known.select("_d").distinct().orderBy(F.xxhash64("_d"), "_d").limit(max_train)   # small by its limit

    def run(it):
        for batch in it:
            x, has = presence(batch.column("_t").to_pylist())
            keep = pa.array(np.flatnonzero(has))
            yield from batches({"d": (batch.column("_d").cast(pa.string()).take(keep), pa.string()),
                                "l": (batch.column("_l").take(keep), pa.string()),
                                "x": ([r.tobytes() for r in np.packbits(x[has], axis=1)], pa.binary())})

    rows = known.join(F.broadcast(ids), "_d", "left_semi").mapInArrow(run, "d string, l string, x binary").collect()
    rows.sort(key=lambda r: (r.l, r.d, bytes(r.x)))
    if not rows:
        return None
    x = np.unpackbits(np.array([np.frombuffer(r.x, np.uint8) for r in rows]), axis=1)[:, :SIZE].astype(bool)
    return Model(x, [r.l for r in rows])


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             folds: int = 4, held_out: int = 2, max_train: int = MAX_TRAIN) -> DataFrame:
    """(id, held_out, lang_pred, score) of every row (held_out is false for a
    null id, which is not learned from either); learned without the
    rows of the held-out fold."""
    prepare(docs.sparkSession)
    model = learn(docs.filter(fold(id_col, folds) != held_out), id_col, text_col, lang_col, max_train)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(it):
        for batch in it:
            ids, texts = batch.column("_d"), batch.column("_t").to_pylist()
            for s in range(0, len(texts), ROWS):
                x, has = presence(texts[s:s + ROWS])
                names, score = [UNKNOWN] * len(x), np.zeros(len(x))
                if model is not None and has.any():
                    v = model.values(x)
                    best = v.argmax(axis=1)
                    names = [model.names[b] if h else UNKNOWN for b, h in zip(best, has, strict=True)]
                    score = np.where(has, np.clip((v.max(axis=1) + 1) / 2, 0, 1), 0.0)
                yield from batches({"_d": (ids[s:s + ROWS], batch.schema.field("_d").type),
                                    "lang_pred": (names, pa.string()), "score": (score.astype(float), pa.float64())})

    d = docs.select(F.col(id_col).alias("_d"), F.col(text_col).alias("_t"))
    out = d.mapInArrow(run, f"_d {kind}, lang_pred string, score double")
    return out.select(F.col("_d").alias(id_col), F.coalesce(fold("_d", folds) == held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")
