"""Exact substring removal by a distributed merge sort of suffixes.

Every byte that lies in a string of ``length`` bytes which also starts earlier
(a smaller document id, or the same document and a smaller start) goes.
Matches do not cross documents and are judged on the input.

Sparse suffixes.  Each window of ``length`` bytes has an anchor, its minimiser
among the ``gram``-byte strings in it; equal windows have it at equal offsets.
Only suffixes that begin at anchors are sorted.  A suffix stands for the run
of windows with that anchor: it carries the bytes from the anchor to the end
of the last window (the sort string) and the bytes before it (left context).

Map: a task sorts its suffixes in bounded runs, cuts each run at sampled
splitters (string, then position, so a string of any frequency is split), and
sends each part front coded: shared prefix length with its predecessor plus
the rest, compressed.  A suffix that equals another one of its run with its
whole left context is not sent, as all its windows start earlier too.

Reduce: a loser tree merges the runs of a part.  Every candidate keeps the
length of its common prefix with the last winner; two candidates whose lengths
differ are ordered by them alone, and else compared from that length on, so
no known prefix is read again.  Neighbours that share an anchor string form a
group; in it each window is compared with the windows of earlier positions.
Groups at the edge of a part may go on in the next one: their windows that are
first in the part go to a last exchange by hash (128 bits), at most one row a
window and task.

Null and empty texts have no bytes and stay empty.  Rows that agree in id and
text are one document; rows with one id and different texts are two
documents, ordered by a hash.  Null ids come after all ids.  A long text is
cut into overlapping pieces, so no step holds more than a chunk of it.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.llm import segments
from tillpoint.llm.common import batches, blobs, keyed_texts, materialize, real_id
from tillpoint.llm.hashing import byte_values, gram_hashes, window_runs

RUN_SUFFIXES = 150_000        # suffixes sorted at once by a map task
PART_BYTES = 48 << 20         # sort strings and contexts of a reduce part
EXPANSION = 3.7               # bytes of strings and contexts by byte of text
SAMPLES = 100                 # sampled suffixes by part


def suffixes(texts: list[bytes], d: list[int], h: list[int], length: int, gram: int):
    """(string, d, h, first window start, left context) of every anchor."""
    for group in segments.chunks([len(t) for t in texts], length):
        raw = b"".join([texts[i][p:p + n] for i, p, n in group])
        off, valid, text, pos = segments.layout(group, length)
        grams = gram_hashes(byte_values(np.frombuffer(raw, np.uint8)), gram)
        first, last, anchor = window_runs(grams, length - gram + 1, valid)
        piece = np.searchsorted(off, first, "right") - 1
        doc, start = text[piece], pos[piece] + first - off[piece]
        for f, e, a, i, s in zip(first.tolist(), (last + length).tolist(), anchor.tolist(), doc.tolist(),
                                 start.tolist(), strict=True):
            yield raw[a:e], d[i], h[i], s, raw[f:a]


def _common(a: bytes, b: bytes, i: int = 0) -> int:
    """Length of the common prefix, known to be at least i."""
    n = min(len(a), len(b))
    for i in range(i, min(i + 4, n)):
        if a[i] != b[i]:
            return i
    if a[i:n] == b[i:n]:
        return n
    hi = n
    while hi - i > 1:                      # a[:i] agrees, a[:hi] does not
        mid = (i + hi) // 2
        if a[i:mid] == b[i:mid]:
            i = mid
        else:
            hi = mid
    return i


def encode(run: list[tuple]) -> bytes:
    """Front-code a sorted run."""
    s = [x[0] for x in run]
    lens = np.fromiter(map(len, s), np.int64, len(s))
    width = int(lens.max())
    grid = np.frombuffer(b"".join([x.ljust(width, b"\0") for x in s]), np.uint8).reshape(-1, width)
    same = np.ones((len(s) - 1, width + 1), bool)
    same[:, :width] = grid[1:] == grid[:-1]
    same[:, width] = False
    shared = np.concatenate([[0], np.minimum(np.argmin(same, axis=1), np.minimum(lens[1:], lens[:-1]))])
    rest = b"".join([x[k:] for x, k in zip(s, shared.tolist(), strict=True)])
    left = [x[4] for x in run]
    num = [segments.narrow(np.array(v, np.int64)) for v in
           (lens, shared, [len(x) for x in left], [x[1] for x in run], [x[2] for x in run], [x[3] for x in run])]
    return segments.pack((num, rest, b"".join(left)))


class _Run:
    """One front-coded run, decoded suffix by suffix."""

    def __init__(self, blob: bytes):
        num, self.rest, self.left = segments.unpack(blob)
        self.items = zip(*[v.tolist() for v in num], strict=True)
        self.at = self.left_at = 0
        self.string = b""

    def step(self):
        """(shared prefix with the predecessor, suffix) or None."""
        x = next(self.items, None)
        if x is None:
            return None
        n, k, m, d, h, s = x
        at, la = self.at, self.left_at
        self.string = self.string[:k] + self.rest[at:at + n - k]
        self.at, self.left_at = at + n - k, la + m
        return k, (self.string, d, h, s, self.left[la:la + m])


def merge(blobs_: list[bytes]):
    """Merge front-coded runs with a loser tree; yields (common prefix with
    the last suffix, suffix) in order of string and position."""
    runs = [_Run(b) for b in blobs_]
    size = 1
    while size < len(runs):
        size *= 2
    cur, known = [None] * size, [0] * size
    for i, r in enumerate(runs):
        _, cur[i] = r.step()

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two candidates."""
        x, y = cur[a], cur[b]
        if x is None:
            return b, a
        if y is None:
            return a, b
        ka, kb = known[a], known[b]
        if ka != kb:                        # the longer shared prefix is smaller
            return (a, b) if ka > kb else (b, a)
        s, t = x[0], y[0]
        k = _common(s, t, ka)
        if k < len(s) and k < len(t):
            first = s[k] < t[k]
        else:
            first = x[:4] < y[:4]           # one is a prefix, or equal: then position
        if first:
            known[b] = k
            return a, b
        known[a] = k
        return b, a

    losers = [0] * size
    winners = [0] * (2 * size)
    for i in range(size):
        winners[size + i] = i
    for i in range(size - 1, 0, -1):
        winners[i], losers[i] = play(winners[2 * i], winners[2 * i + 1])
    top = winners[1] if size > 1 else 0
    while cur[top] is not None:
        yield known[top], cur[top]
        nxt = runs[top].step()
        if nxt is None:
            cur[top], known[top] = None, 0
        else:
            known[top], cur[top] = nxt
        i = (top + size) // 2
        while i:
            top, losers[i] = play(top, losers[i])
            i //= 2


def _offsets(e: tuple, length: int) -> tuple[int, int]:
    """Smallest and largest distance from a window start to the anchor."""
    return length - len(e[0]), len(e[4])


def _repeated(group: list[tuple], length: int) -> list[list[tuple[int, int]]]:
    """For each suffix of a group, in order of position, the offsets (lo, hi)
    of its windows that an earlier suffix has too."""
    if len(group) <= 12:
        out = []
        for j, e in enumerate(group):
            lo, hi = _offsets(e, length)
            found, back = [], e[4][::-1]
            for x in group[:j]:
                a, b = _offsets(x, length)
                a = max(a, lo, length - _common(x[0], e[0]))
                b = min(b, hi, _common(x[4][::-1], back))
                if a <= b:
                    found.append((a, b))
            out.append(found)
        return out
    out = [[] for _ in group]
    offs = np.array([_offsets(e, length) for e in group])
    for o in range(int(offs[:, 0].min()), int(offs[:, 1].max()) + 1):
        seen = set()
        for j in np.flatnonzero((offs[:, 0] <= o) & (o <= offs[:, 1])).tolist():
            e = group[j]
            w = e[4][len(e[4]) - o:] + e[0][:length - o]
            if w in seen:
                out[j].append((o, o))
            else:
                seen.add(w)
    return out


def _settle(group: list[tuple], length: int, edge: bool, spans: list, shared: list) -> None:
    if len(group) == 1 and not edge:
        return
    group.sort(key=lambda e: e[1:4])
    whole: dict[tuple, tuple] = {}
    distinct = []
    for e in group:                         # equal with all context: only the first stays
        old = whole.setdefault((e[0], e[4]), e)
        if old is e:
            distinct.append(e)
        elif old[1:4] != e[1:4]:            # else a repeated row brings the first one again
            spans.append((e[1], e[2], e[3], e[3] + len(e[4]) + len(e[0])))
    for e, found in zip(distinct, _repeated(distinct, length), strict=True):
        anchor = e[3] + len(e[4])
        for a, b in found:
            spans.append((e[1], e[2], anchor - b, anchor - a + length))
        if edge:
            gone = {o for a, b in found for o in range(a, b + 1)}
            lo, hi = _offsets(e, length)
            for o in range(lo, hi + 1):
                if o not in gone:
                    w = xxhash.xxh3_128_digest(e[4][len(e[4]) - o:] + e[0][:length - o])
                    shared.append((e[1], e[2], anchor - o, int.from_bytes(w[:8], "little", signed=True),
                                   int.from_bytes(w[8:], "little", signed=True)))


def _map(length: int, gram: int, splitters: list[tuple]):
    def flush(run: dict, spans: list):
        rows = sorted((s, d, h, p, left) for (s, left), (d, h, p) in run.items())
        cuts = [0, *[bisect_left(rows, x) for x in splitters], len(rows)]
        out = [(i, encode(rows[a:b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if a < b]
        if spans:
            d, h, lo, hi = segments.merge_spans(*np.array(spans, np.int64).T)
            # any part takes the spans along
            out.append((int(d[0]) % (len(splitters) + 1),
                        b"S" + segments.pack([segments.narrow(v) for v in (d, h, lo, hi)])))
        run.clear()
        spans.clear()
        yield from batches({"part": ([x[0] for x in out], pa.int32()), "blob": ([x[1] for x in out], pa.binary())}, 64)

    def run(it):
        held: dict[tuple, tuple] = {}
        spans: list[tuple] = []
        for batch in it:
            d, h = batch.column("_d").to_pylist(), batch.column("_h").to_pylist()
            for s, di, hi, p, left in suffixes(blobs(batch), d, h, length, gram):
                key, at = (s, left), (di, hi, p)
                old = held.setdefault(key, at)
                if old != at:
                    if at < old:
                        held[key], at = at, old
                    spans.append((*at, at[2] + len(left) + len(s)))
                if len(held) >= RUN_SUFFIXES or len(spans) >= 8 * RUN_SUFFIXES:
                    yield from flush(held, spans)
        if held or spans:
            yield from flush(held, spans)
    return run


def _reduce(length: int, gram: int):
    def run(it):
        for _, parts in segments.by_part(it):
            for b in parts:
                if b[:1] == b"S":
                    d, h, lo, hi = [v.astype(np.int64) for v in segments.unpack(b[1:])]
                    yield from segments.reduced(np.zeros(len(d), np.int32), d, h, lo, hi)
            runs = [b for b in parts if b[:1] != b"S"]
            spans, shared, group, edge = [], [], [], True
            for k, e in merge(runs) if runs else ():
                if k < gram and group:
                    _settle(group, length, edge, spans, shared)
                    group, edge = [], False
                    if len(spans) > 200_000:
                        yield from _rows(spans, [], length)
                        spans = []
                group.append(e)
            if group:
                _settle(group, length, True, spans, shared)
            yield from _rows(spans, shared, length)
    return run


def _rows(spans: list, shared: list, length: int):
    if spans:
        d, h, lo, hi = segments.merge_spans(*np.array(spans, np.int64).T)
        yield from segments.reduced(np.zeros(len(d), np.int32), d, h, lo, hi)
    if shared:
        d, h, lo, k1, k2 = np.array(shared, np.int64).T
        yield from segments.reduced(np.ones(len(d), np.int32), d, h, lo, lo + length, k1, k2)


def _splitters(texts: DataFrame, parts: int, total: int, length: int, gram: int) -> list[tuple]:
    """Bounds of the parts from a sample of the suffixes (a bounded number by
    part; it only balances the parts)."""
    def run(it):
        for batch in it:
            d, h = batch.column("_d").to_pylist(), batch.column("_h").to_pylist()
            x = [e for i, e in enumerate(suffixes(blobs(batch), d, h, length, gram)) if i % 16 == 0]
            yield from batches({c: ([e[i] for e in x], kind) for i, (c, kind) in
                                enumerate([("s", pa.binary()), ("d", pa.int64()), ("h", pa.int32()), ("p", pa.int64())])})

    if parts < 2:
        return []
    density = 2 / (length - gram + 2)
    fraction = min(1.0, 16 * SAMPLES * parts / (total * density))
    rows = texts.sample(fraction, 11).mapInArrow(run, "s binary, d long, h int, p long").limit(4 * SAMPLES * parts)
    x = sorted((bytes(r.s), r.d, r.h, r.p) for r in rows.collect())
    return sorted({x[len(x) * i // parts] for i in range(1, parts)}) if x else []


def repeated_spans(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(d, h, lo, hi): byte spans that go, overlapping."""
    spark = texts.sparkSession
    total = texts.agg(F.sum(F.octet_length("_t"))).first()[0] or 0
    parts = max(1, min(int(total * EXPANSION / PART_BYTES) + 1, 1 << 20))
    parts = max(parts, min(int(spark.conf.get("spark.sql.shuffle.partitions")), total >> 18))
    splitters = _splitters(texts, parts, total, length, gram)
    sent = texts.mapInArrow(_map(length, gram, splitters), "part int, blob binary")
    got = materialize(sent.repartition(len(splitters) + 1, "part").mapInArrow(_reduce(length, gram), segments.REDUCED),
                      "suffix_groups")
    first = got.filter("n = 0").select("d", "h", "lo", "hi")
    return first.union(segments.earlier_elsewhere(got.filter("n > 0"), length))


def _digest(it):
    for batch in it:
        ids, n, gone, spans, sha = batch.column("_d").to_pylist(), [], [], [], []
        for t, cut in zip(blobs(batch), segments.span_lists(batch), strict=True):
            n.append(len(t))
            gone.append(sum(b - a for a, b in cut))
            spans.append(len(cut))
            m, at = hashlib.sha256(), 0
            for a, b in cut:
                m.update(t[at:a])
                at = b
            m.update(t[at:])
            sha.append(m.hexdigest())
        yield from batches({"_d": (ids, pa.int64()), "n_bytes": (n, pa.int64()), "n_removed": (gone, pa.int64()),
                            "n_spans": (spans, pa.int64()), "kept_sha256": (sha, pa.string())})


def _cut(it):
    for batch in it:
        out = []
        for t, cut in zip(blobs(batch), segments.span_lists(batch), strict=True):
            out.append(b"".join([t[a:b] for a, b in zip([0, *[b for _, b in cut]], [*[a for a, _ in cut], len(t)],
                                                        strict=True)]))
        yield from batches({"_d": (batch.column("_d"), pa.int64()), "kept": (out, pa.binary())}, 2000)


def _apply(docs: DataFrame, id_col: str, text_col: str, length: int, gram: int, fn, schema: str) -> DataFrame:
    texts = keyed_texts(docs, id_col, text_col, segments.HASH_MASK)
    out = segments.with_spans(texts, repeated_spans(texts, length, gram), fn, "_d long, " + schema)
    return out.select(real_id("_d").alias(id_col), *out.columns[1:])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100,
                   gram: int = 24) -> DataFrame:
    """(id, kept): the bytes that remain of each text (a cut may split a
    character, so bytes, not text)."""
    return _apply(docs, id_col, text_col, length, gram, _cut, "kept binary")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100,
           gram: int = 24) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of each document."""
    return _apply(docs, id_col, text_col, length, gram, _digest,
                  "n_bytes long, n_removed long, n_spans long, kept_sha256 string")
