"""Benchmark decontamination by spaced-seed hashing.

Texts become words: lower case, any run of ASCII letters, digits and non-ASCII
characters (punctuation parts words).  A spaced seed is a fixed mask over
consecutive words; the hash of the words under its ones ignores the others, so
a hit survives a changed word at an ignored position.  The masks' hashes of
all benchmark positions are joined with those of all document positions, and
every hit is verified on its diagonal: some ``window`` aligned words around it
of which at least ``agree_pct`` percent are equal.

The masks are chosen so that any placement of the changes that the verified
window tolerates leaves a hit (``uncovered`` lists exceptions: none, for the
window and percentage above).  An item shorter than the window is taken whole,
with masks of its own (``short_masks``): for ``c`` tolerated changes the
positions are dealt out in ``c + 1`` classes, of which one stays unchanged
wherever the changes fall.  Items under ``MIN_ITEM`` words are found where all
their words stand in a row, unchanged; an item of a word or two therefore
meets every document that has it, and the benchmark should not hold such.
Items without words match nothing.

The benchmark is the stated query set: it goes to the tasks as sorted hashes
and words, in blocks of at most ``block_words`` words (by hash of the item),
each block against all documents, so no broadcast grows with it.

Null and empty texts are clean, null benchmark texts are no items.  Verdicts
are per row: repeated rows get equal verdicts.  Other columns pass unchanged;
names that begin with ``__c_`` are taken by this module.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import batches, materialize, prepare, row_id
from tillpoint.llm.hashing import mix, word_chunks

WINDOW = 13
AGREE_PCT = 80
MIN_ITEM = 8
MASKS = ("111111", "1111011", "1110111", "11100111", "110110011", "1101011001")
BLOCK_WORDS = 200_000

_PLAIN = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(256))


def normal(text: str | None) -> bytes:
    """Lower-cased text with ASCII punctuation as spaces."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_PLAIN)


def uncovered(window: int, changes: int, masks: tuple[str, ...] = MASKS) -> list[tuple[int, ...]]:
    """Placements of changed words in a window that no mask avoids."""
    ones = [[i for i, c in enumerate(m) if c == "1"] for m in masks]
    return [p for p in combinations(range(window), changes)
            if not any(all(s + i not in p for i in o) for o in ones for s in range(window - o[-1]))]


def seed_hashes(words: np.ndarray, mask: str) -> np.ndarray:
    at = [i for i, c in enumerate(mask) if c == "1"]
    n = len(words) - at[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = np.full(n, len(mask), np.uint64)
    for i in at:
        acc = (acc ^ words[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        acc ^= acc >> np.uint64(29)
    return mix(acc)


def short_masks(words: int, agree_pct: int, min_item: int = MIN_ITEM) -> list[str]:
    """Masks over a whole item of ``words`` words, one of which ignores any
    placement of the tolerated changes."""
    classes = 1 if words < min_item else words * (100 - agree_pct) // 100 + 1
    return ["".join("1" if i % classes == k else "0" for i in range(words)) for k in range(classes)]


class Block:
    """Hashes and words of some benchmark items, for lookups in a task."""

    FILTER = 1 << 20

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW, agree_pct: int = AGREE_PCT):
        self.names, self.words = [], []
        self.window, self.agree_pct = window, agree_pct
        for name, text in items:
            for _, w, _ in word_chunks([text]):
                if len(w):
                    self.names.append(name)
                    self.words.append(w)
        by_mask: dict[str, list[int]] = {}
        for i, w in enumerate(self.words):
            for m in MASKS if len(w) >= window else short_masks(len(w), agree_pct):
                by_mask.setdefault(m, []).append(i)
        self.seeds = [(m, *self._table(m, of)) for m, of in by_mask.items()]

    def _table(self, mask: str, of: list[int]):
        """Sorted hashes of these items under a mask, with items and places."""
        h = [seed_hashes(self.words[i], mask) for i in of]
        item = np.repeat(np.array(of), [len(x) for x in h])
        pos = np.concatenate([np.arange(len(x)) for x in h])
        h = np.concatenate(h)
        o = np.argsort(h, kind="stable")
        seen = np.zeros(self.FILTER, bool)
        seen[h & np.uint64(self.FILTER - 1)] = True
        return h[o], item[o], pos[o], seen

    def matches(self, w: np.ndarray) -> set[int]:
        """Items of which ``w`` holds a verified overlap."""
        found, tried = set(), set()
        for m, hashes, items, places, seen in self.seeds:
            h = seed_hashes(w, m)
            at = np.flatnonzero(seen[h & np.uint64(self.FILTER - 1)])
            if not len(at):
                continue
            lo, hi = np.searchsorted(hashes, h[at], "left"), np.searchsorted(hashes, h[at], "right")
            for p, a, b in zip(at.tolist(), lo.tolist(), hi.tolist(), strict=True):
                for i in range(a, b):
                    item, shift = int(items[i]), p - int(places[i])
                    if item not in found and (item, shift) not in tried:
                        tried.add((item, shift))
                        if self._verified(w, item, shift):
                            found.add(item)
        return found

    def _verified(self, w: np.ndarray, item: int, shift: int) -> bool:
        x = self.words[item]
        size = min(self.window, len(x))
        lo, hi = max(0, -shift), min(len(x), len(w) - shift)
        if hi - lo < size:
            return False
        same = np.concatenate([[0], np.cumsum(x[lo:hi] == w[lo + shift:hi + shift])])
        need = 100 if len(x) < MIN_ITEM else self.agree_pct
        return int((same[size:] - same[:-size]).max()) * 100 >= need * size


def _scan(block: Block):
    def run(it):
        for batch in it:
            texts = [normal(t) for t in batch.column("_t").to_pylist()]
            rows, items = [], []
            for first, words, off in word_chunks(texts):
                for j in range(len(off) - 1):
                    for i in block.matches(words[off[j]:off[j + 1]]):
                        rows.append(first + j)
                        items.append(block.names[i])
            take = pa.array(rows, pa.int64())
            yield from batches({"_d": (batch.column("_d").take(take), pa.int64()),
                                "_h": (batch.column("_h").take(take), pa.int64()), "item": (items, pa.string())})
    return run


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
             agree_pct: int = AGREE_PCT, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(_d, _h, item): which documents hold which items."""
    prepare(docs.sparkSession)
    texts = docs.select(row_id(id_col, text_col).alias("_d"), F.xxhash64(text_col).alias("_h"),
                        F.col(text_col).alias("_t"))
    items = benchmark.filter(F.col(item_text_col).isNotNull()).select(
        F.col(item_col).cast("string").alias("i"), F.col(item_text_col).alias("t"))
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = int(total / 4 / block_words) + 1
    found = None
    for b in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).distinct().collect()
        block = Block(sorted((r.i or "", normal(r.t)) for r in rows), window, agree_pct)
        hits = texts.mapInArrow(_scan(block), "_d long, _h long, item string")
        found = hits if found is None else found.union(hits)
    return found.distinct()


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           **options) -> DataFrame:
    """(id, contaminated, n_items): one row per row of ``docs``."""
    hits = materialize(overlaps(docs, benchmark, id_col, text_col, **options), "overlaps")
    hits = hits.groupBy(F.col("_d").alias("__c_d"), F.col("_h").alias("__c_h")).agg(F.count("*").alias("__c_n"))
    d = docs.select(F.col(id_col), row_id(id_col, text_col).alias("__c_d"), F.xxhash64(text_col).alias("__c_h"))
    return d.join(hits, ["__c_d", "__c_h"], "left").select(
        id_col, F.col("__c_n").isNotNull().alias("contaminated"), F.coalesce("__c_n", F.lit(0)).alias("n_items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    hits = materialize(overlaps(docs, benchmark, id_col, text_col, **options), "overlaps")
    hits = hits.select(F.col("_d").alias("__c_d"), F.col("_h").alias("__c_h")).distinct()
    return (docs.withColumn("__c_d", row_id(id_col, text_col)).withColumn("__c_h", F.xxhash64(text_col))
            .join(hits, ["__c_d", "__c_h"], "left_anti").select(*docs.columns))
