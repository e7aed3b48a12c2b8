"""Hard negatives for contrastive training, by zone maps over Hilbert-ordered blocks.

Vectors become integers (``floor(scale * x)``, x as double); a row's score is
its integer inner product with an anchor, higher first, ties by smaller id.
An anchor's positives are its best ``n_pos`` other rows of the same label; a
positive's negatives are the best ``n_neg`` rows of other labels whose score
lies in ``low`` to ``high`` percent of the positive's.

Blocks.  Rows are ordered by label and by their place on a Hilbert curve
through the 15 dimensions of largest variance (4 bits each), dealt by range to
parts, and written as Parquet rows of up to ``BLOCK`` vectors of one label,
each with the smallest and largest value of every dimension (its zone map).  A
part has a zone map too; those (one for at most ``PART_ROWS`` rows) are all
that the driver sees.

Search.  For an anchor a the products a_i * [min_i, max_i] bound every score
in a zone from both sides.  The task that writes a part finds the best rows in
it for the anchors it owns, which gives them a first threshold; an anchor then
goes to the parts, and in a part reads the blocks, whose bounds meet one of its
windows (positives: from the threshold up; negatives: the score range of each
positive, from the third best found so far up).  A task holds one part and lets
any number of anchors stream past it.  Anchors are a stated query set; where no
zone can be ruled out, each anchor meets all rows, in blocks.

Rows with a null id, a null label, a null vector or a null or non-finite
component take no part.  Of rows with one id the smallest by (label, vector)
counts.  Shorter vectors are as if filled up with zeros.  Components saturate at
2^62 and scores at the range of a long; below that all is exact.  An anchor with
no positive, and a positive without a row in its range (a score below zero has
none), gives no row.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.llm.common import batches, materialize, prepare, scratch

BLOCK = 512                  # vectors of a block
PART_ROWS = 1 << 18          # rows of a part (range bounds are sampled: about)
ANCHORS = 1024               # anchors scored at once
AXES, BITS = 15, 4
LEAST, MOST = -(1 << 63) + 1, (1 << 63) - 1
EXACT = float(1 << 53)
PACKED = ("kind int, part int, blk int, label long, label_hi long, id long, ids binary, vecs binary, lo binary, "
          "hi binary, w_lo array<bigint>, w_hi array<bigint>")
FOUND = "anchor long, w int, score long, id long"


def hilbert(axes: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of ``axes`` (unsigned, below 2^bits) on the Hilbert
    curve: undo the rotations and reflections of each level from the top, Gray
    decode, then interleave the bits."""
    x = axes.astype(np.int64).T.copy()
    n = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for i in range(n):
            set_ = (x[i] & level) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(set_, low, swap)
            x[i] ^= swap
        level >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        flip = np.where(x[n - 1] & level, flip ^ (level - 1), flip)
        level >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


def _matrix(lists: pa.Array, dim: int, scale: float) -> np.ndarray:
    """Integer components (rows x dim) of a list column."""
    sizes = np.diff(lists.offsets.to_numpy())
    flat = np.asarray(lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False))
    out = np.zeros((len(lists), dim), np.int64)
    at = np.repeat(np.arange(len(lists)), sizes)
    pos = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[at, pos] = np.clip(np.floor(flat * scale), -(2.0 ** 62), 2.0 ** 62).astype(np.int64)
    return out


def _blob(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a, "<i8").tobytes()


def bounds(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and most that the scores of anchors (rows of ``a``) can be in
    zones: arrays anchors x zones, by interval arithmetic."""
    plus, minus = np.maximum(a, 0).astype(float), np.minimum(a, 0).astype(float)
    lo, hi = lo.astype(float).T, hi.astype(float).T
    least, most = plus @ lo + minus @ hi, plus @ hi + minus @ lo
    slack = np.maximum(np.abs(least), np.abs(most)) * 1e-9       # rounding beyond 2^53 only widens
    wide = slack > EXACT * 1e-9
    return least - np.where(wide, slack, 0), most + np.where(wide, slack, 0)


def _scores(a: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer inner products, saturated to long."""
    size = float(np.abs(a).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(1, a.shape[1])
    if size < EXACT:
        return (a.astype(float) @ v.astype(float).T).astype(np.int64)
    s = a.astype(object) @ v.astype(object).T
    return np.clip(s, LEAST, MOST).astype(np.int64)


class Block:
    """Vectors of one label in order of id, with their zone map."""

    def __init__(self, label: int, ids: np.ndarray, vecs: np.ndarray, lo=None, hi=None):
        o = np.argsort(ids, kind="stable")
        self.label, self.ids, self.vecs = label, ids[o], vecs[o]
        self.lo = vecs.min(0) if lo is None else lo
        self.hi = vecs.max(0) if hi is None else hi


def wanted(a: np.ndarray, lo: np.ndarray, hi: np.ndarray, w_lo: np.ndarray, w_hi: np.ndarray) -> np.ndarray:
    """anchors x zones: whether a zone's bounds meet one of an anchor's windows."""
    least, most = bounds(a, lo, hi)
    out = np.zeros(least.shape, bool)
    for w in range(w_lo.shape[1]):
        out |= (most >= w_lo[:, w:w + 1]) & (least <= w_hi[:, w:w + 1]) & (w_lo[:, w:w + 1] <= w_hi[:, w:w + 1])
    return out


def best(a: np.ndarray, ids: np.ndarray, labels: np.ndarray, w_lo: np.ndarray, w_hi: np.ndarray,
         blocks: list[Block], k: int, same: bool) -> tuple[np.ndarray, np.ndarray, int]:
    """For every anchor and window the k best (score, id) among the blocks of
    the anchor's label (``same``; itself left out) or of other labels, and how
    many (anchor, block) pairs were read."""
    n, m = w_lo.shape
    top_s, top_i = np.full((n, m, k), LEAST), np.full((n, m, k), MOST)
    reads = 0
    for b in blocks:
        mine = np.flatnonzero((labels == b.label) == same)
        if not len(mine):
            continue
        floor = np.maximum(w_lo[mine], top_s[mine, :, k - 1])
        mine = mine[wanted(a[mine], b.lo[None], b.hi[None], floor, w_hi[mine])[:, 0]]
        if not len(mine):
            continue
        reads += len(mine)
        s = _scores(a[mine], b.vecs)
        own = (b.ids[None] == ids[mine, None]) if same else None
        rank = s if np.abs(s).max(initial=0) < EXACT else np.unique(s, return_inverse=True)[1].reshape(s.shape)
        order = rank * len(b.ids) + np.arange(len(b.ids) - 1, -1, -1)      # smaller ids first among equals
        for w in range(m):
            ok = (s >= w_lo[mine, w, None]) & (s <= w_hi[mine, w, None]) & (s >= top_s[mine, w, k - 1, None])
            if own is not None:
                ok &= ~own
            at = np.flatnonzero(ok.any(1))
            if not len(at):
                continue
            key = np.where(ok[at], order[at], LEAST)
            take = min(k, key.shape[1])
            pick = np.argpartition(key, key.shape[1] - take, axis=1)[:, -take:]
            fine = np.take_along_axis(ok[at], pick, 1)
            cat_s = np.concatenate([top_s[mine[at], w], np.where(fine, np.take_along_axis(s[at], pick, 1), LEAST)], 1)
            cat_i = np.concatenate([top_i[mine[at], w], np.where(fine, b.ids[pick], MOST)], 1)
            o = np.lexsort((cat_i, -cat_s), axis=1)[:, :k]
            top_s[mine[at], w], top_i[mine[at], w] = (np.take_along_axis(x, o, 1) for x in (cat_s, cat_i))
    return top_s, top_i, reads


def _keyed(dim: int, scale: float, axes: list[int], mid: np.ndarray, step: np.ndarray):
    """Rows as (label, place on the curve, id, components)."""
    def run(it):
        for batch in it:
            v = _matrix(batch.column("vec"), dim, scale)
            cell = np.clip(np.floor((v[:, axes] - mid) / step) + (1 << BITS - 1), 0, (1 << BITS) - 1)
            key = hilbert(cell, BITS) if axes else np.zeros(len(v), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(key), batch.column("id"), pa.array([_blob(x) for x in v], pa.binary())],
                names=["label", "place", "id", "vec"])
    return run


def _rows(out: list[dict]) -> Iterator[pa.RecordBatch]:
    kinds = {"kind": pa.int32(), "part": pa.int32(), "blk": pa.int32(), "label": pa.int64(), "label_hi": pa.int64(),
             "id": pa.int64(), "ids": pa.binary(), "vecs": pa.binary(), "lo": pa.binary(), "hi": pa.binary(),
             "w_lo": pa.list_(pa.int64()), "w_hi": pa.list_(pa.int64())}
    yield from batches({k: ([x.get(k) for x in out], t) for k, t in kinds.items()}, 64)


def _pack(dim: int, is_anchor, n_pos: int):
    """A sorted part as blocks (kind 0), the anchors in it with their first
    threshold (kind 1) and the part's zone map (kind 2)."""
    def run(it):
        label, ids, vecs = [], [], []
        for batch in it:
            label.append(batch.column("label").to_numpy())
            ids.append(batch.column("id").to_numpy())
            vecs.append(np.frombuffer(b"".join(batch.column("vec").to_pylist()), "<i8").reshape(-1, dim))
        if not label or not sum(map(len, label)):
            return
        label, ids, vecs = np.concatenate(label), np.concatenate(ids), np.concatenate(vecs)
        part = TaskContext.get().partitionId()
        cuts = [0, *(np.flatnonzero(np.diff(label)) + 1).tolist(), len(label)]
        blocks = [Block(int(label[x]), ids[x:min(x + BLOCK, z)], vecs[x:min(x + BLOCK, z)])
                  for y, z in zip(cuts, cuts[1:], strict=False) for x in range(y, z, BLOCK)]
        for i, b in enumerate(blocks):
            yield from _rows([{"kind": 0, "part": part, "blk": i, "label": b.label, "ids": _blob(b.ids),
                               "vecs": _blob(b.vecs), "lo": _blob(b.lo), "hi": _blob(b.hi)}])
        mine = np.flatnonzero(is_anchor(ids))
        for x in range(0, len(mine), ANCHORS):
            at = mine[x:x + ANCHORS]
            w_lo, w_hi = np.full((len(at), 1), LEAST), np.full((len(at), 1), MOST)
            s, _, _ = best(vecs[at], ids[at], label[at], w_lo, w_hi, blocks, n_pos, True)
            yield from _rows([{"kind": 1, "part": part, "label": int(label[j]), "id": int(ids[j]), "vecs": _blob(vecs[j]),
                               "w_lo": [int(t)], "w_hi": [MOST]} for j, t in zip(at, s[:, 0, -1], strict=True)])
        yield from _rows([{"kind": 2, "part": part, "label": int(label.min()), "label_hi": int(label.max()),
                           "lo": _blob(vecs.min(0)), "hi": _blob(vecs.max(0))}])
    return run


def _anchors(batch: pa.RecordBatch, dim: int):
    v = np.frombuffer(b"".join(batch.column("vecs").to_pylist()), "<i8").reshape(-1, dim)
    w_lo, w_hi = (batch.column(c).to_pylist() for c in ("w_lo", "w_hi"))
    m = max(map(len, w_lo))
    lo = np.array([x + [MOST] * (m - len(x)) for x in w_lo], np.int64)     # a missing window is empty
    hi = np.array([x + [LEAST] * (m - len(x)) for x in w_hi], np.int64)
    return v, batch.column("id").to_numpy(), batch.column("label").to_numpy(), lo, hi


def _send(dim: int, zones: list, same: bool):
    """Each anchor once for every part that it has to read."""
    part = np.array([z["part"] for z in zones])
    lo, hi = (np.frombuffer(b"".join(bytes(z[c]) for z in zones), "<i8").reshape(-1, dim) for c in ("lo", "hi"))
    first, last = (np.array([z[c] for z in zones]) for c in ("label", "label_hi"))

    def run(it):
        for batch in it:
            for x in range(0, batch.num_rows, ANCHORS):
                some = batch.slice(x, ANCHORS)
                v, _, label, w_lo, w_hi = _anchors(some, dim)
                within = (first[None] <= label[:, None]) & (label[:, None] <= last[None])
                pure = within & (first == last)[None]
                i, z = np.nonzero(wanted(v, lo, hi, w_lo, w_hi) & (within if same else ~pure))
                out = some.take(pa.array(i))
                at = out.schema.get_field_index("part")
                yield out.set_column(at, "part", pa.array(part[z], pa.int32()))
    return run


def _search(dim: int, k: int, same: bool):
    """Over a part's blocks followed by the anchors sent to it, part by part."""
    def run(it):
        part, blocks = None, []
        for batch in it:
            parts, kinds = batch.column("part").to_numpy(), batch.column("kind").to_numpy()
            edges = np.flatnonzero((np.diff(parts) != 0) | (np.diff(kinds) != 0)) + 1
            for x, y in zip([0, *edges.tolist()], [*edges.tolist(), len(parts)], strict=True):
                if x == y:
                    continue
                some = batch.slice(x, y - x)
                if parts[x] != part:
                    part, blocks = parts[x], []
                if kinds[x] == 0:
                    for row in some.select(["label", "ids", "vecs", "lo", "hi"]).to_pylist():
                        blocks.append(Block(row["label"], *(np.frombuffer(row[c], "<i8") if c == "ids" else
                                                            np.frombuffer(row[c], "<i8").reshape(-1, dim)
                                                            for c in ("ids", "vecs")),
                                            np.frombuffer(row["lo"], "<i8"), np.frombuffer(row["hi"], "<i8")))
                    continue
                for z in range(0, some.num_rows, ANCHORS):
                    a, ids, label, w_lo, w_hi = _anchors(some.slice(z, ANCHORS), dim)
                    s, i, _ = best(a, ids, label, w_lo, w_hi, blocks, k, same)
                    r, w, j = np.nonzero(i != MOST)
                    yield from batches({"anchor": (ids[r], pa.int64()), "w": (w, pa.int32()),
                                        "score": (s[r, w, j], pa.int64()), "id": (i[r, w, j], pa.int64())})
    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    """The k best of each anchor and window; at most k came from each part."""
    w = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _meet(blocks: DataFrame, anchors: DataFrame, zones: list, parts: int, dim: int, k: int, same: bool) -> DataFrame:
    sent = anchors.mapInArrow(_send(dim, zones, same), PACKED)
    both = blocks.union(sent).repartitionById(parts, "part").sortWithinPartitions("part", "kind", "blk")
    return _top(both.mapInArrow(_search(dim, k, same), FOUND), k)


def usable(emb: DataFrame, id_col: str, vec_col: str, label: Column) -> DataFrame:
    """(id, label, vec) of the rows that take part, one for each id."""
    rows = emb.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                      F.col(vec_col).alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()).filter(finite)
    return rows.groupBy("id").agg(F.min(F.struct("label", "vec")).alias("x")).select("id", "x.label", "x.vec")


def mine(emb: DataFrame, is_anchor, id_col: str = "vec_id", vec_col: str = "embedding", label: Column | None = None,
         scale: float = 256.0, n_pos: int = 5, n_neg: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score); ``is_anchor`` tells from an array of ids which are anchors."""
    spark = emb.sparkSession
    prepare(spark)
    with scratch() as block:
        rows = materialize(usable(emb, id_col, vec_col, F.col("label") if label is None else label), "vectors")
        stats = rows.select(F.posexplode("vec").alias("i", "x")).groupBy("i").agg(
            F.avg(F.col("x").cast("double")).alias("m"), F.stddev_pop(F.col("x").cast("double")).alias("s")).collect()
        n, dim = rows.count(), max(1, len(stats))
        wide = sorted((x for x in stats if x["s"]), key=lambda x: (-x["s"], x["i"]))[:AXES]
        keyed = rows.mapInArrow(_keyed(dim, scale, [x["i"] for x in wide], np.array([x["m"] * scale for x in wide]),
                                       np.array([x["s"] * scale / 3 for x in wide])),
                                "label long, place long, id long, vec binary")
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")) // 4, -(-n // PART_ROWS), 1)
        order = ("label", "place", "id")
        packed = materialize(keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                             .mapInArrow(_pack(dim, is_anchor, n_pos), PACKED), "blocks")
        zones = packed.filter("kind = 2").select("part", "label", "label_hi", "lo", "hi").collect()
        if not zones:
            return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                             "positive_score long, negative_score long")
        blocks, anchors = packed.filter("kind = 0"), packed.filter("kind = 1")
        pos = _meet(blocks, anchors, zones, parts, dim, n_pos, True).filter("score >= 0").select(
            "anchor", (F.col("rank") - 1).alias("w"), F.col("id").alias("positive_id"),
            F.col("score").alias("positive_score"))
        pos = materialize(pos, "positives")
        # integer bounds of low * p <= 100 * n <= high * p, without leaving the range of a long
        p = F.col("positive_score").cast("decimal(38,0)")
        wins = pos.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct(
            "w", F.ceil(p * low / 100).cast("long").alias("lo"), F.floor(p * high / 100).cast("long").alias("hi")))).alias("x"))
        hunters = anchors.drop("w_lo", "w_hi").join(wins, anchors["id"] == wins["anchor"]).select(
            *[c for c in anchors.columns if c not in ("w_lo", "w_hi")],
            F.col("x.lo").alias("w_lo"), F.col("x.hi").alias("w_hi"))
        neg = _meet(blocks, hunters, zones, parts, dim, n_neg, False)
        out = neg.join(pos, ["anchor", "w"]).select(
            F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"),
            F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        return block.keep(materialize(out, "negatives"))
