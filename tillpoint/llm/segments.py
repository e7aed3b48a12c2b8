"""Shared parts of the two repeated-passage operators: cutting texts into
chunks of windows, exchanging compressed runs, settling windows that meet in
several tasks, and collecting removed spans by document."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.llm.common import materialize, only_ids
from tillpoint.llm.hashing import CHUNK

#: bits of the text hash that tell rows with one id and different texts apart
#: in the exchanged records (two such texts meet by chance once in 65,536)
HASH_MASK = 0xFFFF
#: a reduced record: a removed span (n = 0: items lo to hi of a document) or a
#: window that other tasks may hold too (n: copies, start lo, hash k1 k2)
REDUCED = "n int, d long, h int, lo long, hi long, k1 long, k2 long"


def chunks(lengths: list[int], window: int, limit: int = CHUNK) -> Iterator[list[tuple[int, int, int]]]:
    """Groups of (text, start, length) of at most ``limit`` items.  Longer
    texts are cut into pieces that overlap by a window less one item, so every
    window lies in exactly one piece."""
    group, size = [], 0
    for i, n in enumerate(lengths):
        pos = 0
        while n - pos >= window:
            take = min(n - pos, limit)
            if size + take > limit:
                yield group
                group, size = [], 0
            group.append((i, pos, take))
            size += take
            pos += take - window + 1
    if group:
        yield group


def layout(group: list[tuple[int, int, int]], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For a group: offsets of its pieces, mask of the window starts that lie
    within one piece, text and start of each piece."""
    text, pos, take = (np.array(x, np.int64) for x in zip(*group, strict=True))
    off = np.cumsum(take) - take
    size = int(take.sum())
    edge = np.zeros(size + 1, np.int64)
    edge[off] += 1
    edge[off + take - window + 1] -= 1
    return off, np.cumsum(edge[:size]) > 0, text, pos


def pack(value: object) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(value, protocol=5))


def unpack(blob: bytes) -> object:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


def narrow(a: np.ndarray) -> np.ndarray:
    """The smallest unsigned type that holds the values."""
    return a.astype(np.min_scalar_type(int(a.max()))) if len(a) else a.astype(np.uint8)


def by_part(it) -> Iterator[tuple[int, list[bytes]]]:
    """(part, its blobs) for the (part, blob) rows of one task."""
    held: dict[int, list[bytes]] = {}
    for batch in it:
        for p, b in zip(batch.column("part").to_pylist(), batch.column("blob").to_pylist(), strict=True):
            held.setdefault(p, []).append(b)
    for p in sorted(held):
        yield p, held.pop(p)


def reduced(n, d, h, lo, hi, k1=None, k2=None) -> Iterator[pa.RecordBatch]:
    size = len(d)
    zero = np.zeros(size, np.int64)
    t = pa.table({"n": pa.array(n, pa.int32()), "d": pa.array(d, pa.int64()), "h": pa.array(h, pa.int32()),
                  "lo": pa.array(lo, pa.int64()), "hi": pa.array(hi, pa.int64()),
                  "k1": pa.array(zero if k1 is None else k1, pa.int64()),
                  "k2": pa.array(zero if k2 is None else k2, pa.int64())})
    yield from t.to_batches(max_chunksize=50_000)


def merge_spans(d: np.ndarray, h: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """Unite overlapping and touching spans of a document."""
    if not len(d):
        return d, h, lo, hi
    o = np.lexsort((lo, h, d))
    d, h, lo, hi = d[o], h[o], lo[o], hi[o]
    fresh = np.concatenate([[True], (d[1:] != d[:-1]) | (h[1:] != h[:-1])])
    doc = np.cumsum(fresh)
    reach = np.maximum.accumulate(hi + doc * (int(hi.max()) + 1)) - doc * (int(hi.max()) + 1)
    first = fresh.copy()
    first[1:] |= lo[1:] > reach[:-1]
    at = np.flatnonzero(first)
    return d[at], h[at], lo[at], np.maximum.reduceat(reach, at)


def earlier_elsewhere(shared: DataFrame, length: int) -> DataFrame:
    """Spans of the windows that stand earlier in another task.  A task sends
    each window once, so a key has at most as many rows as there are tasks.
    The first position itself stays, however often it was sent."""
    w = Window.partitionBy("k1", "k2").orderBy("d", "h", "lo")
    return (shared.withColumn("r", F.rank().over(w)).filter("r > 1")
            .select("d", "h", "lo", (F.col("lo") + length).alias("hi")))


def found_elsewhere(shared: DataFrame, length: int) -> DataFrame:
    """Spans of the windows of which all tasks together hold two or more."""
    twice = shared.groupBy("k1", "k2").agg(F.sum("n").alias("all")).filter("all > 1")
    return shared.join(twice, ["k1", "k2"]).select("d", "h", "lo", (F.col("lo") + length).alias("hi"))


def with_spans(texts: DataFrame, spans: DataFrame, digest, schema: str) -> DataFrame:
    """Apply ``digest`` (an Arrow function over _d, _t and the lists lo, hi)
    to every text: those with spans meet them in a join, the others pass by."""
    spans = materialize(spans.groupBy(F.col("d").alias("_d"), F.col("h").cast("long").alias("_h"))
                        .agg(F.collect_list(F.struct("lo", "hi")).alias("spans")), "spans")
    ids = spans.select("_d").distinct()
    hit = only_ids(texts, ids).join(spans, ["_d", "_h"])
    hit = hit.select("_d", "_t", F.col("spans.lo").alias("lo"), F.col("spans.hi").alias("hi"))
    none = F.array().cast("array<bigint>")
    free = texts.join(F.broadcast(spans.select("_d", "_h")) if spans.limit(1_000_001).count() <= 1_000_000
                      else spans.select("_d", "_h"), ["_d", "_h"], "left_anti")
    free = free.select("_d", "_t", none.alias("lo"), none.alias("hi"))
    return hit.mapInArrow(digest, schema).union(free.mapInArrow(digest, schema))


def span_lists(batch: pa.RecordBatch) -> Iterator[list[tuple[int, int]]]:
    """The merged spans of each row."""
    for lo, hi in zip(batch.column("lo").to_pylist(), batch.column("hi").to_pylist(), strict=True):
        out: list[list[int]] = []
        for a, b in sorted(zip(lo, hi, strict=True)):
            if out and a <= out[-1][1]:
                out[-1][1] = max(out[-1][1], b)
            else:
                out.append([a, b])
        yield out
