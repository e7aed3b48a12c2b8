"""Repeated word passages by suffix automata of reference shards.

Every word that lies in a window of ``length`` words which occurs anywhere
else too (same document included) goes; words are compared unchanged, windows
are judged on the input.

Reference shards.  Each window has an anchor, its minimiser among the
``gram``-word strings in it; equal windows have equal anchors.  A block is a
run of consecutive windows with one anchor.  Blocks go to the shard that owns
their anchor, a range of (anchor, block, position) with sampled bounds, so an
anchor of any frequency is split.  A shard's reference is its distinct blocks;
a block that occurs twice is repeated in whole.  Where an anchor has several
distinct blocks they are put into one suffix automaton over words, with the
number of occurrences of every state; the blocks are then streamed through it,
and the matching statistics at each word (the state of the last ``length``
words) tell whether that window occurs twice.  Spans of such windows are
united to maximal spans by document.

The reference grows with the corpus, so a shard's automaton is held by the
task that owns the shard and the blocks come to it, rather than all automata
going to all tasks.  An automaton has at most ``AUTOMATON_WORDS`` words: the
blocks of a more frequent anchor are cut into several, and, like the blocks at
a shard's edge, send each of their windows once (with the copies they know) to
a last exchange by hash (128 bits).

Null and empty texts have no words.  Rows that agree in id and text are one
document; with one id and different texts they are two.  Null ids come after
all ids.  Long texts are cut into overlapping pieces.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.llm import segments
from tillpoint.llm.common import batches, blobs, keyed_texts, materialize, real_id
from tillpoint.llm.hashing import gram_hashes, window_runs, word_chunks

RUN_BLOCKS = 200_000          # blocks sorted at once by a map task
PART_BYTES = 72 << 20         # words (8 bytes) of a shard's blocks
AUTOMATON_WORDS = 100_000
SAMPLES = 100                 # sampled blocks by shard
SECOND_BASE = 0xA0761D6478BD642F | 1


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices start[i] .. start[i] + size[i] - 1, one after the other."""
    n = int(size.sum())
    kind = np.int32 if n + int(start.max(initial=0)) < 1 << 31 else np.int64
    out = np.repeat((start - (np.cumsum(size) - size)).astype(kind), size)
    out += np.arange(n, dtype=kind)
    return out


def blocks(texts: list[bytes], d: np.ndarray, h: np.ndarray, length: int, gram: int):
    """Per chunk: dict of arrays (anchor, d, h, first window, windows) and the
    blocks' words one after the other."""
    for first_text, words, bounds in word_chunks(texts):
        sizes = np.diff(bounds)
        for group in segments.chunks(sizes.tolist(), length):
            w = np.concatenate([words[bounds[i] + p:bounds[i] + p + n] for i, p, n in group])
            off, valid, text, pos = segments.layout(group, length)
            grams = gram_hashes(w, gram)
            lo, hi, anchor = window_runs(grams, length - gram + 1, valid)
            piece = np.searchsorted(off, lo, "right") - 1
            doc = text[piece] + first_text
            n = hi - lo + length
            yield {"a": grams[anchor], "c": _block_hash(w, lo, n), "d": d[doc], "h": h[doc],
                   "s": pos[piece] + lo - off[piece], "n": n}, w[_ragged(lo, n)]


def _block_hash(w: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    from tillpoint.llm.hashing import mix, powers, prefix_sums
    h = prefix_sums(w)
    _, inv = powers(len(w))
    return mix((h[start + size] - h[start]) * inv[start] + size.astype(np.uint64))


def _window_hashes(w: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    return gram_hashes(w, length).view(np.int64), gram_hashes(w, length, SECOND_BASE).view(np.int64)


class Automaton:
    """Suffix automaton of several word sequences with occurrence counts."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len, self.count = [-1], [0], [0]

    def add(self, seq: list[int], copies: int) -> None:
        nxt, link, length, count = self.next, self.link, self.len, self.count
        last = 0
        for c in seq:
            q = nxt[last].get(c)
            if q is not None and length[q] == length[last] + 1:
                last = q
                count[q] += copies
                continue
            if q is not None:                      # split off the state of this very string
                last = self._clone(last, c, q)
                count[last] += copies
                continue
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            count.append(copies)
            p = last
            while p != -1 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p != -1:
                q = nxt[p][c]
                link[cur] = q if length[p] + 1 == length[q] else self._clone(p, c, q)
            last = cur

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        new = len(nxt)
        nxt.append(nxt[q].copy())
        length.append(length[p] + 1)
        link.append(link[q])
        self.count.append(0)
        link[q] = new
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = new
            p = link[p]
        return new

    def total(self) -> None:
        """Add the counts of longer strings to their suffixes."""
        for v in sorted(range(1, len(self.len)), key=self.len.__getitem__, reverse=True):
            if self.link[v] > 0:
                self.count[self.link[v]] += self.count[v]

    def windows(self, seq: list[int], length: int):
        """For every window of ``length`` words of a known sequence: how often
        it occurs (the matching statistics, cut to ``length``)."""
        nxt, link, lens, count = self.next, self.link, self.len, self.count
        v = n = 0
        for c in seq:
            while c not in nxt[v]:                 # only where the match is shorter
                v = link[v]
                n = lens[v]
            v = nxt[v][c]
            n += 1
            if n >= length:
                while lens[link[v]] >= length:
                    v = link[v]
                n = length
                yield count[v]


def _edges(f: np.ndarray) -> np.ndarray:
    """Boundaries of runs of equal values."""
    return np.concatenate([[0], np.flatnonzero(f[1:] != f[:-1]) + 1, [len(f)]])


def _cut(b: dict[str, np.ndarray], splitter: tuple) -> int:
    """First row of the sorted blocks that is not below the splitter."""
    lo, hi = 0, len(b["a"])
    for name, v in zip("acdhs", splitter, strict=True):
        x = b[name][lo:hi]
        v = x.dtype.type(v)
        lo, hi = lo + int(np.searchsorted(x, v, "left")), lo + int(np.searchsorted(x, v, "right"))
    return lo


def _sorted(b: dict[str, np.ndarray], words: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """In order of anchor, block and position; a position that comes again (a
    repeated row) counts once, with the most copies a run has met."""
    most = [-b["copies"]] if "copies" in b else []
    o = np.lexsort((*most, b["s"], b["h"], b["d"], b["c"], b["a"]))
    again = np.logical_and.reduce([b[k][o[1:]] == b[k][o[:-1]] for k in "acdhs"])
    o = o[np.concatenate([[True], ~again])]
    start = np.cumsum(b["n"]) - b["n"]
    return {k: v[o] for k, v in b.items()}, words[_ragged(start[o], b["n"][o])]


def _map(length: int, gram: int, splitters: list[tuple]):
    shards = len(splitters) + 1

    def flush(held: list):
        b = {k: np.concatenate([x[0][k] for x in held]) for k in held[0][0]}
        words = np.concatenate([x[1] for x in held])
        held.clear()
        b, words = _sorted(b, words)
        same = np.concatenate([[False], (b["a"][1:] == b["a"][:-1]) & (b["c"][1:] == b["c"][:-1])])
        first = np.flatnonzero(~same)
        copies = np.diff(np.concatenate([first, [len(same)]]))
        out = []
        twice = np.repeat(copies > 1, copies)              # all copies of a repeated block go
        if twice.any():
            d, h, lo, hi = segments.merge_spans(*[x[twice] for x in (b["d"], b["h"], b["s"], b["s"] + b["n"])])
            out.append((int(d[0]) % shards, b"S" + segments.pack([segments.narrow(v) for v in (d, h, lo, hi)])))
        start = np.cumsum(b["n"]) - b["n"]
        words = words[_ragged(start[first], b["n"][first])]
        b = {k: v[first] for k, v in b.items()} | {"copies": copies}
        cuts = [0, *[_cut(b, x) for x in splitters], len(first)]
        ends = np.concatenate([[0], np.cumsum(b["n"])])
        for i, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if x < y:
                part = {k: v[x:y] if k in "ac" else segments.narrow(v[x:y]) for k, v in b.items()}
                vocabulary, at = np.unique(words[ends[x]:ends[y]], return_inverse=True)
                out.append((i, segments.pack((part, vocabulary, segments.narrow(at)))))
        yield from batches({"part": ([x[0] for x in out], pa.int32()), "blob": ([x[1] for x in out], pa.binary())}, 64)

    def run(it):
        held, n = [], 0
        for batch in it:
            d, h = batch.column("_d").to_numpy(), batch.column("_h").to_numpy()
            for x in blocks(blobs(batch), d, h, length, gram):
                held.append(x)
                n += len(x[0]["a"])
                if n >= RUN_BLOCKS:
                    yield from flush(held)
                    n = 0
        if n:
            yield from flush(held)
    return run


def _settle(b: dict, words: np.ndarray, voc: np.ndarray, ends: np.ndarray, x: int, y: int, edge: bool, length: int, spans: list,
            shared: list) -> None:
    """Blocks x to y share an anchor, in order of block hash."""
    e = _edges(b["c"][x:y]) + x
    copies = np.add.reduceat(b["copies"][x:y], e[:-1] - x)
    for i in np.flatnonzero((copies > 1) & (np.diff(e) > 1)).tolist():   # met in several runs
        r = slice(e[i], e[i + 1])
        spans.append(np.array([b["d"][r], b["h"][r], b["s"][r], b["s"][r] + b["n"][r]]))
    seqs = [(int(k), words[ends[k]:ends[k + 1]]) for k in e[:-1]]
    size = sum(len(s) for _, s in seqs)
    if not edge and (len(seqs) == 1 or (copies > 1).all()):
        return
    pieces = -(-size // AUTOMATON_WORDS)
    edge = edge or pieces > 1
    for p in range(pieces):
        mine = list(zip(seqs[p::pieces], copies[p::pieces].tolist(), strict=True))
        auto = Automaton()
        lists = [s.tolist() for (_, s), _ in mine]
        for s, (_, c) in zip(lists, mine, strict=True):
            auto.add(s, c)
        auto.total()
        sent = set()
        for s, ((k, w), c) in zip(lists, mine, strict=True):
            if c > 1 and not edge:
                continue
            times = np.fromiter(auto.windows(s, length), np.int64, len(s) - length + 1)
            d, h, at = int(b["d"][k]), int(b["h"][k]), int(b["s"][k])
            if c == 1:
                for lo, hi in zip(*_runs(times > 1), strict=True):
                    spans.append(np.array([[d], [h], [at + lo], [at + hi + length - 1]]))
            if edge:
                k1, k2 = _window_hashes(voc[w], length)
                for j, key in enumerate(zip(k1.tolist(), k2.tolist(), strict=True)):
                    if key not in sent:
                        sent.add(key)
                        shared.append((min(int(times[j]), 2), d, h, at + j, *key))


def _runs(mask: np.ndarray) -> tuple[list[int], list[int]]:
    """(first, end) of the runs of true values."""
    d = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(d == 1).tolist(), np.flatnonzero(d == -1).tolist()


def _reduce(length: int):
    def run(it):
        for _, parts in segments.by_part(it):
            held = []
            while parts:
                blob = parts.pop()
                if blob[:1] == b"S":
                    d, h, lo, hi = [v.astype(np.int64) for v in segments.unpack(blob[1:])]
                    yield from segments.reduced(np.zeros(len(d), np.int32), d, h, lo, hi)
                else:
                    part, vocabulary, at = segments.unpack(blob)
                    held.append(({k: v if k in "ac" else v.astype(np.int64) for k, v in part.items()},
                                 vocabulary, at))
            if not held:
                continue
            b = {k: np.concatenate([x[0][k] for x in held]) for k in held[0][0]}
            # words as numbers in the part's own vocabulary: half the bytes of their hashes
            voc = np.unique(np.concatenate([x[1] for x in held]))
            for i, (_, vocabulary, at) in enumerate(held):
                held[i] = np.searchsorted(voc, vocabulary).astype(np.int32)[at]
            words = np.concatenate(held)
            held.clear()
            b, words = _sorted(b, words)
            ends = np.concatenate([[0], np.cumsum(b["n"])])
            e = _edges(b["a"])
            spans, shared = [], []
            for i in range(len(e) - 1):
                edge = i == 0 or i == len(e) - 2
                if edge or e[i + 1] - e[i] > 1:
                    _settle(b, words, voc, ends, int(e[i]), int(e[i + 1]), edge, length, spans, shared)
            if spans:
                d, h, lo, hi = segments.merge_spans(*np.concatenate(spans, axis=1))
                yield from segments.reduced(np.zeros(len(d), np.int32), d, h, lo, hi)
            if shared:
                n, d, h, lo, k1, k2 = np.array(shared, np.int64).T
                yield from segments.reduced(n, d, h, lo, lo + length, k1, k2)
    return run


def _splitters(texts: DataFrame, parts: int, total_blocks: float, length: int, gram: int) -> list[tuple]:
    def run(it):
        for batch in it:
            d, h = batch.column("_d").to_numpy(), batch.column("_h").to_numpy()
            for b, _ in blocks(blobs(batch), d, h, length, gram):
                yield from batches({k: (b[k][::16].view(np.int64) if k in "ac" else b[k][::16], pa.int64())
                                    for k in "acdhs"})

    if parts < 2:
        return []
    fraction = min(1.0, 16 * SAMPLES * parts / max(1.0, total_blocks))
    rows = texts.sample(fraction, 11).mapInArrow(run, "a long, c long, d long, h long, s long")
    mask = (1 << 64) - 1
    x = sorted((r.a & mask, r.c & mask, r.d, r.h, r.s) for r in rows.limit(4 * SAMPLES * parts).collect())
    return sorted({x[len(x) * i // parts] for i in range(1, parts)}) if x else []


def repeated_spans(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(d, h, lo, hi): spans of words that go, overlapping."""
    spark = texts.sparkSession
    total = texts.agg(F.sum(F.octet_length("_t"))).first()[0] or 0
    words = total / 5                                     # about; it only sizes the shards
    density = 2 / (length - gram + 2)
    parts = int(words * density * (length + 1 / density) * 8 / PART_BYTES) + 1
    parts = max(parts, min(int(spark.conf.get("spark.sql.shuffle.partitions")), total >> 18, 1 << 20))
    splitters = _splitters(texts, parts, words * density, length, gram)
    sent = texts.mapInArrow(_map(length, gram, splitters), "part int, blob binary")
    got = materialize(sent.repartitionById(len(splitters) + 1, "part").mapInArrow(_reduce(length), segments.REDUCED),
                      "passage_groups")
    first = got.filter("n = 0").select("d", "h", "lo", "hi")
    return first.union(segments.found_elsewhere(got.filter("n > 0"), length))


def _kept(t: bytes, cut: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """(words, removed words, kept words joined by a space)."""
    w = t.split()                     # bytes: splits at the six ASCII spaces only
    keep, at = [], 0
    for a, b in cut:
        keep += w[at:a]
        at = b
    keep += w[at:]
    return len(w), len(w) - len(keep), b" ".join(keep)


def _digest(it):
    for batch in it:
        x = [_kept(t, cut) for t, cut in zip(blobs(batch), segments.span_lists(batch), strict=True)]
        yield from batches({"_d": (batch.column("_d"), pa.int64()), "n_words": ([n for n, _, _ in x], pa.int64()),
                            "n_removed": ([n for _, n, _ in x], pa.int64()),
                            "kept_sha256": ([hashlib.sha256(k).hexdigest() for _, _, k in x], pa.string())})


def _texts(it):
    for batch in it:
        x = [_kept(t, cut)[2].decode() for t, cut in zip(blobs(batch), segments.span_lists(batch), strict=True)]
        yield from batches({"_d": (batch.column("_d"), pa.int64()), "kept": (x, pa.string())}, 2000)


def _apply(docs: DataFrame, id_col: str, text_col: str, length: int, gram: int, fn, schema: str) -> DataFrame:
    texts = keyed_texts(docs, id_col, text_col, segments.HASH_MASK)
    out = segments.with_spans(texts, repeated_spans(texts, length, gram), fn, "_d long, " + schema)
    return out.select(real_id("_d").alias(id_col), *out.columns[1:])


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 35,
                    gram: int = 4) -> DataFrame:
    """(id, kept): the kept words of each text, joined by spaces."""
    return _apply(docs, id_col, text_col, length, gram, _texts, "kept string")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 35,
           gram: int = 4) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) of each document."""
    return _apply(docs, id_col, text_col, length, gram, _digest, "n_words long, n_removed long, kept_sha256 string")
