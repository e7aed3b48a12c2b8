"""URL filtering: host and path rules, and a character language-model ratio.

A rule is ``host/path``; it fits a URL of that host or a subdomain whose path
starts with the rule's path; the longest rule that fits decides.  URLs that a
rule allows or blocks are the accepted and rejected examples of two
variable-order Markov models over characters: orders 0 to ``ORDER``, each
order's estimate smoothed into the next lower one by the Witten-Bell rule.
URLs without a rule are judged by the difference of both log-likelihoods by
character; those below the threshold are blocked.  The threshold is calibrated
on a fifth of the examples that the models have not seen: the largest one that
blocks at most ``max_false_pct`` percent of the accepted examples, but not above
0, where a URL is as likely among the accepted as among the rejected ones.

The models' counts come from all examples; contexts are hashed to a fixed
number of places and characters to 64 classes, so the counts that go to the
tasks have a fixed bound (ORDER + 1 orders, 2^12 contexts, 64 classes).

Null URLs and those without ``://`` have an empty host and path, no rule, and
are allowed by the method if null or empty.  Without examples of both kinds
the method allows.  Rows are judged one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import batches, blobs, materialize, prepare
from tillpoint.llm.hashing import mix

ORDER = 4
CONTEXTS = 1 << 12
CLASSES = 64
BINS = 4096
SPAN = 8.0                   # scores are binned from -SPAN to SPAN
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CLASS = np.full(256, CLASSES - 1, np.uint64)
for _i, _c in enumerate(b"abcdefghijklmnopqrstuvwxyz0123456789-._~:/?#[]@!$&'()*+,;=%"):
    _CLASS[_c] = _i + 1
for _i, _c in enumerate(UPPER.encode()):
    _CLASS[_c] = _i + 1


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r, v in sorted(rules, key=lambda x: (len(x[0]), x[1] == "block", x[0])):
        h, _, p = r.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule, verdict = F.when(fits, r).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def _symbols(urls: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Character classes of all URLs, each after ORDER zeros, and the URL of
    each place (-1 for the zeros)."""
    pad = bytes(ORDER)
    raw = np.frombuffer(b"".join([pad + u for u in urls]), np.uint8)
    size = np.array([len(u) for u in urls])
    row = np.repeat(np.arange(len(urls)), size + ORDER)
    inside = np.arange(len(raw)) - np.repeat(np.cumsum(size + ORDER) - size - ORDER, size + ORDER) >= ORDER
    sym = np.where(inside, _CLASS[raw], 0).astype(np.uint64)
    return sym, np.where(inside, row, -1)


def _places(sym: np.ndarray, at: np.ndarray):
    """For each order: place of (context, character) for the positions."""
    h = np.zeros(len(at), np.uint64)
    for k in range(ORDER + 1):
        if k:
            h = h * np.uint64(67) + sym[at - k]
        yield k, (mix(h + np.uint64(k << 40)) % np.uint64(CONTEXTS)).astype(np.int64) * CLASSES + sym[at].astype(np.int64)


class Markov:
    """Witten-Bell smoothed model from counts by (order, place)."""

    def __init__(self, counts: np.ndarray):
        n = counts.reshape(ORDER + 1, CONTEXTS, CLASSES)
        self.pair = n.reshape(ORDER + 1, -1).astype(np.float64)
        self.total = n.sum(axis=2).astype(np.float64)
        self.kinds = (n > 0).sum(axis=2).astype(np.float64)

    def log_probability(self, sym: np.ndarray, at: np.ndarray) -> np.ndarray:
        p = np.full(len(at), 1 / CLASSES)
        for k, place in _places(sym, at):
            total, kinds = self.total[k][place // CLASSES], self.kinds[k][place // CLASSES]
            p = np.where(total > 0, (self.pair[k][place] + kinds * p) / np.maximum(total + kinds, 1), p)
        return np.log(p)


def _count(examples: DataFrame) -> np.ndarray:
    """counts[class, order, place] of the examples (u, y)."""
    def run(it):
        for batch in it:
            urls, y = blobs(batch, "u"), batch.column("y").to_numpy()
            sym, row = _symbols(urls)
            at = np.flatnonzero(row >= 0)
            for k, place in _places(sym, at):
                key, n = np.unique(y[row[at]] * (CONTEXTS * CLASSES) + place, return_counts=True)
                yield from batches({"k": (np.full(len(key), k), pa.int32()), "p": (key, pa.int64()), "n": (n, pa.int64())})

    rows = examples.mapInArrow(run, "k int, p long, n long").groupBy("k", "p").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((2, ORDER + 1, CONTEXTS * CLASSES), np.int64)
    p = rows["p"].to_numpy(np.int64)
    counts[p // (CONTEXTS * CLASSES), rows["k"].to_numpy(np.int64), p % (CONTEXTS * CLASSES)] = rows["n"].to_numpy()
    return counts


def _ratios(urls: list[bytes], good: Markov, bad: Markov) -> np.ndarray:
    """Mean over a URL's characters of the log-likelihood difference."""
    sym, row = _symbols(urls)
    at = np.flatnonzero(row >= 0)
    d = good.log_probability(sym, at) - bad.log_probability(sym, at)
    size = np.array([len(u) for u in urls])
    return np.bincount(row[at], d, len(urls)) / np.maximum(size, 1)


def _score(good: Markov, bad: Markov):
    def run(it):
        for batch in it:
            yield from batches({"u": (batch.column("u"), pa.string()), "y": (batch.column("y"), pa.int32()),
                                "s": (_ratios(blobs(batch, "u"), good, bad), pa.float64())})
    return run


def _threshold(scored: DataFrame, max_false_pct: float) -> float:
    """From the binned scores of the accepted examples kept back."""
    b = F.floor((F.greatest(F.lit(-SPAN), F.least(F.lit(SPAN), F.col("s"))) + SPAN) * (BINS / (2 * SPAN)))
    rows = scored.filter("y = 1").groupBy(b.cast("int").alias("b")).count().collect()     # at most BINS + 1
    total, below = sum(r["count"] for r in rows), 0
    for r in sorted(rows):
        below += r["count"]
        if below * 100 > max_false_pct * total:
            return min(0.0, -SPAN + r["b"] * (2 * SPAN / BINS))
    return 0.0


def judge(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
          max_false_pct: float = 1.0) -> DataFrame:
    """(id, host, path, rule, verdict, ratio) of every row of ``pages``;
    ratio is null where a rule decides or nothing could be learned."""
    prepare(pages.sparkSession)
    url = F.col(url_col)
    d = pages.select(F.col(id_col), url.alias("u"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    d = d.withColumn("rule", rule).withColumn("ruled", verdict)
    y = F.when(F.col("ruled") == "allow", 1).otherwise(0)
    known = materialize(d.filter("ruled is not null").select("u", y.cast("int").alias("y")), "url_examples")
    back = F.pmod(F.xxhash64("u"), F.lit(5)) == 0
    counts = _count(known.filter(~back))
    kind = pages.schema[id_col].dataType.simpleString()
    if not counts[0].any() or not counts[1].any():
        return d.select(id_col, "host", "path", "rule", F.coalesce("ruled", F.lit("allow")).alias("verdict"),
                        F.lit(None).cast("double").alias("ratio"))
    good, bad = Markov(counts[1]), Markov(counts[0])
    limit = _threshold(known.filter(back).mapInArrow(_score(good, bad), "u string, y int, s double"), max_false_pct)

    def run(it):
        for batch in it:
            urls = blobs(batch, "u")
            s = _ratios(urls, good, bad)
            ruled = batch.column("ruled").to_pylist()
            v = [r or ("block" if u and x < limit else "allow") for r, u, x in zip(ruled, urls, s, strict=True)]
            x = [None if r else float(x) for r, x in zip(ruled, s, strict=True)]
            yield from batches({"i": (batch.column(id_col), batch.schema.field(id_col).type),
                                **{c: (batch.column(c), pa.string()) for c in ("host", "path", "rule")},
                                "verdict": (v, pa.string()), "ratio": (x, pa.float64())})

    out = d.mapInArrow(run, f"i {kind}, host string, path string, rule string, verdict string, ratio double")
    return out.withColumnRenamed("i", id_col)
