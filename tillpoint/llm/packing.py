"""Packing documents into training sequences by cutting-stock column generation.

A document is its token ids and one end id.  Full pieces of ``capacity`` ids are
cut off its front; what is left over (shorter than ``capacity``) is one piece, so
that most documents stay whole.

Plan.  The histogram of the left-over lengths (exact to 256, then to 2, 4 and 8:
at most 640 classes, by their upper bound) is all that the driver sees.  A linear
program chooses how often to use each pattern, a multiset of classes that fits
one sequence; the dual value of a class prices new patterns by a knapsack dynamic
program, until none improves or the value is within ``GAP`` of the least possible.
Counts are rounded down; what they leave (a few sequences for each class) is
packed best fit, decreasing.  Patterns filled to less than ``MIN_FILL`` are given
up: their pieces are laid end to end and cut at the capacity, and the very last
sequence is cut into powers of two, which need no padding.

Assignment.  A piece's rank in its class is its rank within the map task that
read it plus the number of pieces in earlier tasks, so no class passes through
one task.  The rank tells pattern, sequence and slot; offsets add up within a
sequence, and positions of the laid-out pieces by task like the ranks.

Tokens.  Where the tokenizer cuts texts into words first, the ids of a text are
those of its words one after the other; a task keeps the ids of up to ``CACHE``
words.  Special tokens' strings in a text are what the tokenizer makes of them.

Null and empty texts are the end id alone.  Every row is packed, repeated rows
and null ids (null in the result) too.  Long texts are read whole.  No documents
give no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.llm.common import batches, blobs, materialize, prepare, scratch

CAPACITY = 2048
CACHE = 400_000              # words whose ids a task keeps
GAP = 0.0005                 # the program ends this close to its lower bound
MIN_FILL = 0.99
PIVOTS = 3000                # at most; what is then not optimal is only less tightly packed
PIECES = ("task int, size int, rank long, doc_id long, start long, length int, ids_crc32 long, doc_tokens long, "
          "ids binary")


def size_class(n: np.ndarray) -> np.ndarray:
    """Upper bound of a length's class: exact to 256, then steps of 2, 4, 8 ..."""
    step = np.maximum(1, 1 << np.maximum(0, np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64) - 8))
    return -(-n // step) * step


#: how a tokenizer must cut texts for the word-by-word path (fixed values)
CUTS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
FOLDS = ["NFC", "Replace", "Lowercase"]
#: the same cuts for lower-cased text of ASCII and U+00C0 to U+00FF, on which NFC changes nothing
PLAIN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|"
                   "[^a-z\u00df-\u00f6\u00f8-\u00ff0-9 \t-\r]+")
OTHER = re.compile("[^\x00-\x7f\u00c0-\u00ff]")


_kept: dict[str, "Words"] = {}


def words_of(path: str) -> "Words":
    """The tokenizer of a path, with the ids it has met in this process."""
    if path not in _kept:
        _kept[path] = Words(path)
    return _kept[path]


class Words:
    """Token ids (unsigned 16 or 32 bits, as bytes) of texts.  Where the
    tokenizer folds case and cuts at words, the ids of a word are looked up
    once; any other tokenizer, and texts with special tokens, go through whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.type = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        self.known: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        folds = (spec.get("normalizer") or {}).get("normalizers") or []
        cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.simple = ([x["type"] for x in folds] == FOLDS and cuts[0].get("pattern") == {"Regex": CUTS}
                       and not spec.get("post_processor"))
        self.special = [t["content"] for t in spec.get("added_tokens", [])]

    def _encode(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.type).tobytes()

    def _learn(self, words: list[str]) -> None:
        for at in range(0, len(words), 5000):
            some = words[at:at + 5000]
            e = self.tok.encode(" ".join(some), add_special_tokens=False)
            word, ids = np.array(e.word_ids), np.array(e.ids, self.type)
            edges = np.searchsorted(word, np.arange(len(some) + 1)).tolist()
            for w, x, y in zip(some, edges, edges[1:], strict=False):
                self.known[w] = ids[x:y].tobytes()

    def ids(self, texts: list[bytes]) -> Iterator[bytes]:
        for blob in texts:
            text = blob.decode()
            if not self.simple or any(t in text for t in self.special):
                yield self._encode(text)
                continue
            if OTHER.search(text):
                # words with other characters are encoded alone, those between them as usual
                parts = [self._encode(w) if OTHER.search(w) else self._plain(w) for w in re.split("[ \t-\r]+", text)]
                yield b"".join(parts)
                continue
            yield self._plain(text)

    def _plain(self, text: str) -> bytes:
        words = PLAIN.findall(text.lower())
        known = self.known
        if len(known) > CACHE:
            known.clear()
        new = [w for w in dict.fromkeys(words) if w not in known]
        if new:
            self._learn(new)
        return b"".join([known[w] for w in words])


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _pieces(path: str, end: int, capacity: int):
    def run(it):
        words, task, ranks = words_of(path), TaskContext.get().partitionId(), {}
        names = [x.split()[0] for x in PIECES.split(", ")]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        for batch in it:
            out, held = [], 0
            for doc, ids in zip(batch.column("doc_id").to_pylist(), words.ids(blobs(batch, "text")), strict=True):
                a = np.append(np.frombuffer(ids, words.type), np.array([end], words.type))
                for x in range(0, len(a), capacity):
                    p = a[x:x + capacity]
                    size = int(size_class(np.array([len(p)]))[0])
                    rank = ranks[size] = ranks.get(size, -1) + 1
                    left = p.tobytes() if len(p) < capacity else None       # only these may be cut again
                    out.append((task, size, rank, doc, x, len(p), _crc(p), len(a), left))
                    held += len(p)
                if held > 1 << 22:
                    yield from batches({n: (list(c), t) for n, c, t in zip(names, zip(*out, strict=True), types, strict=True)})
                    out, held = [], 0
            if out:
                yield from batches({n: (list(c), t) for n, c, t in zip(names, zip(*out, strict=True), types, strict=True)})
    return run


# the plan, on the driver, from the histogram alone -------------------------------
def _knapsack(sizes: np.ndarray, value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest value for every capacity, and the item that was added last (-1: none)."""
    use = np.flatnonzero(value > 1e-12)
    s, v = sizes[use], value[use]
    f, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        f[c] = f[c - 1]
        n = int(np.searchsorted(s, c, "right"))
        if n:
            gain = f[c - s[:n]] + v[:n]
            i = int(gain.argmax())
            if gain[i] > f[c] + 1e-12:
                f[c], last[c] = gain[i], use[i]
    return f, last


def _pattern(sizes: np.ndarray, last: np.ndarray, c: int, first: int) -> np.ndarray:
    out = np.zeros(len(sizes))
    out[first] += 1
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            out[last[c]] += 1
            c -= int(sizes[last[c]])
    return out


def _start(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> np.ndarray:
    """First basis: the largest class that is left is filled up (with a piece
    or a pair that fits exactly, else with the largest that fits) and the
    pattern used until a class runs out.  In the order in which classes run
    out the columns are triangular, hence a feasible basis."""
    left = demand.astype(float)
    place = np.full(capacity + 1, -1)
    place[sizes] = np.arange(len(sizes))
    columns = np.diag(np.maximum(1, capacity // sizes)).astype(float)
    while left.any():
        have = np.zeros(capacity + 1, bool)
        have[sizes[left > 0]] = True
        column, room = np.zeros(len(sizes)), capacity
        top = int(np.flatnonzero(left)[-1])
        while top >= 0:
            column[top] += 1
            room -= int(sizes[top])
            if not room or not have[:room + 1].any():
                break
            pair = np.flatnonzero(have[:room + 1] & have[room::-1])
            top = int(place[room if have[room] else pair[-1] if len(pair) else np.flatnonzero(have[:room + 1])[-1]])
        used = column > 0
        times = (left[used] / column[used]).min()
        out = np.flatnonzero(used)[np.argmin(left[used] / column[used])]
        columns[:, out] = column
        left = np.maximum(left - times * column, 0)
        left[out] = 0
        left[left < 1e-9 * demand] = 0
    return columns


def solve(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Patterns with their (fractional) counts: the fewest sequences that hold
    the demand, by the revised simplex method with priced columns."""
    m = len(sizes)
    b = demand.astype(float)
    least = float(sizes @ b) / capacity
    columns = _start(sizes, demand, capacity)
    inverse = np.linalg.inv(columns)
    x = np.maximum(inverse @ b, 0)
    pool = np.zeros((m, 0))
    for _ in range(PIVOTS):
        if x.sum() <= least * (1 + GAP) + 1e-9:
            break
        y = inverse.sum(0)
        gain = y @ pool - 1
        if not len(gain) or gain.max() <= 1e-7:
            f, last = _knapsack(sizes, y, capacity)
            worth = y + f[capacity - sizes]                               # best pattern with each class in it
            top = [i for i in np.argsort(-worth)[:60] if worth[i] > 1 + 1e-7]
            # dividing the dual values by the largest worth makes them feasible: a lower bound
            least = max(least, x.sum() / max(1.0, float(worth.max())))
            if not top or x.sum() <= least * (1 + GAP):
                break
            new = np.unique(np.stack([_pattern(sizes, last, capacity - int(sizes[i]), int(i)) for i in top]), axis=0).T
            pool = np.concatenate([pool[:, -1000:], new], 1)
            gain = y @ pool - 1
        enter = int(gain.argmax())
        d = inverse @ pool[:, enter]
        ok = d > 1e-9
        if not ok.any():
            break
        ratio = np.where(ok, x / np.where(ok, d, 1), np.inf)
        leave = int(ratio.argmin())
        step = max(0.0, float(ratio[leave]))
        x = np.maximum(x - step * d, 0)
        x[leave] = step
        row = inverse[leave] / d[leave]
        inverse -= np.outer(d, row)
        inverse[leave] = row
        columns[:, leave] = pool[:, enter]
    return [(columns[:, i], float(x[i])) for i in range(m) if x[i] > 1e-9]


def _best_fit(sizes: list[int], counts: list[int], capacity: int) -> list[dict[int, int]]:
    """Sequences for a few pieces: largest first, each where least room is left."""
    bins: list[dict[int, int]] = []
    room: list[tuple[int, int]] = []                    # (free, bin) in order
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        for _ in range(counts[i]):
            at = bisect_left(room, (sizes[i], -1))
            if at == len(room):
                bins.append({})
                insort(room, (capacity, len(bins) - 1))
                at = bisect_left(room, (sizes[i], -1))
            free, b = room.pop(at)
            bins[b][i] = bins[b].get(i, 0) + 1
            insort(room, (free - sizes[i], b))
    return bins


def plan(histogram: dict[int, int], capacity: int = CAPACITY, min_fill: float = MIN_FILL) -> list[tuple[dict[int, int], int]]:
    """(pattern {class: pieces}, number of sequences); pieces beyond them are
    laid end to end.  Full pieces are a pattern of their own."""
    out = [({capacity: 1}, histogram[capacity])] if histogram.get(capacity) else []
    sizes = np.array(sorted(s for s in histogram if s < capacity), np.int64)
    if not len(sizes):
        return out
    demand = np.array([histogram[int(s)] for s in sizes], np.int64)
    left = demand.copy()
    patterns: list[tuple[dict[int, int], int]] = []
    for column, times in solve(sizes, demand, capacity):
        n = int(times + 1e-6)
        col = column.astype(np.int64)
        n = min([n, *(left[col > 0] // col[col > 0]).tolist()])
        if n:
            left -= n * col
            patterns.append(({int(sizes[i]): int(col[i]) for i in np.flatnonzero(col)}, n))
    for b in _best_fit(sizes.tolist(), left.tolist(), capacity):
        patterns.append(({int(sizes[i]): n for i, n in b.items()}, 1))
    return out + [p for p in patterns if sum(s * n for s, n in p[0].items()) >= min_fill * capacity]


def _slots(patterns: list[tuple[dict[int, int], int]]):
    """Per class: first ranks, pieces a sequence, first sequence and first slot
    of its patterns; ranks and sequences used."""
    table: dict[int, list] = {}
    used: dict[int, int] = {}
    sequence = 0
    for pattern, times in patterns:
        slot = 0
        for size in sorted(pattern, reverse=True):
            n = pattern[size]
            table.setdefault(size, []).append((used.get(size, 0), n, sequence, slot))
            used[size] = used.get(size, 0) + n * times
            slot += n
        sequence += times
    return {s: np.array(v, np.int64).T for s, v in table.items()}, used, sequence


def _assign(table: dict, used: dict):
    """The sequence and slot of each ranked piece (sequence -1: laid end to end)."""
    def run(it):
        for batch in it:
            size, rank = batch.column("size").to_numpy(), batch.column("rank").to_numpy()
            seq, slot = np.full(len(size), -1), np.zeros(len(size), np.int64)
            for s in np.unique(size).tolist():
                at = np.flatnonzero((size == s) & (rank < used.get(s, 0)))
                if len(at):
                    first, n, sequence, base = table[s]
                    p = np.searchsorted(first, rank[at], "right") - 1
                    k = rank[at] - first[p]
                    seq[at], slot[at] = sequence[p] + k // n[p], base[p] + k % n[p]
            names = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(seq, pa.int64()),
                                              pa.array(slot, pa.int64())], names=[*names, "sequence_id", "slot"])
    return run


def _borders(total: int, capacity: int) -> np.ndarray:
    """Borders in the last, partial sequence: powers of two, largest first."""
    at, out = total - total % capacity, []
    while at < total:
        at += 1 << ((total - at).bit_length() - 1)
        out.append(at)
    return np.array(out, np.int64)


def _cut(total: int, capacity: int, first: int, wide: bool):
    """Cut pieces laid at ``at`` where sequences end."""
    tail = total - total % capacity
    small = _borders(total, capacity)

    def run(it):
        for batch in it:
            out = []
            cols = [batch.column(c).to_pylist() for c in ("doc_id", "start", "length", "doc_tokens", "at", "ids")]
            for doc, start, n, tokens, at, ids in zip(*cols, strict=True):
                a, done = np.frombuffer(ids, "<u4" if wide else "<u2"), 0
                while done < n:
                    here = at + done
                    if here < tail:
                        seq, begin, end = here // capacity, here // capacity * capacity, (here // capacity + 1) * capacity
                    else:
                        j = int(np.searchsorted(small, here, "right"))
                        seq, begin, end = tail // capacity + j, tail if j == 0 else int(small[j - 1]), int(small[j])
                    take = min(n - done, end - here)
                    out.append((doc, start + done, take, _crc(a[done:done + take]), tokens, first + seq, here - begin))
                    done += take
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if out:
                yield from batches({k: (list(c), pa.int64()) for k, c in zip(names, zip(*out, strict=True), strict=True)})
    return run


def _before(counts: DataFrame, value: str, out: str) -> DataFrame:
    """Running total of ``value`` over the earlier tasks of a class."""
    w = Window.partitionBy("size").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("size", "task", F.coalesce(F.sum(value).over(w), F.lit(0)).alias(out))


RESULT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end: int = 1,
         capacity: int = CAPACITY, min_fill: float = MIN_FILL) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) per
    piece; ``tokenizer`` is a file that the workers can read too."""
    spark = docs.sparkSession
    prepare(spark)
    with scratch() as block:
        d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        pieces = materialize(d.mapInArrow(_pieces(tokenizer, end, capacity), PIECES), "pieces")
        counts = materialize(pieces.groupBy("size", "task").agg(F.count(F.lit(1)).alias("n")), "piece_counts")
        histogram = {r["size"]: r["n"] for r in counts.groupBy("size").agg(F.sum("n").alias("n")).collect()}
        if not histogram:
            return spark.createDataFrame([], RESULT)
        table, used, sequences = _slots(plan(histogram, capacity, min_fill))
        plain = ["task", "size", "rank", "doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        ranked = pieces.select(*plain).join(_before(counts, "n", "earlier"), ["size", "task"]) \
            .withColumn("local", F.col("rank")).withColumn("rank", F.col("rank") + F.col("earlier"))
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
        ranked = ranked.mapInArrow(_assign(table, used), kinds + ", sequence_id long, slot long")
        ranked = materialize(ranked, "ranked")
        cols = ["doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens", "sequence_id"]
        full = ranked.filter(F.col("size") == capacity).select(*cols, F.lit(0).cast("long").alias("offset"))
        w = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
        fitted = ranked.filter((F.col("sequence_id") >= 0) & (F.col("size") < capacity)).select(
            *cols, F.coalesce(F.sum("length").over(w), F.lit(0)).cast("long").alias("offset"))

        laid = ranked.filter(F.col("sequence_id") < 0).select("size", "task", "local", "length")
        by_task = materialize(laid.groupBy("size", "task").agg(F.sum("length").alias("ids")), "laid")
        by_size = {r["size"]: r["ids"] for r in by_task.groupBy("size").agg(F.sum("ids").alias("ids")).collect()}
        out = full.union(fitted)
        if by_size:
            order = sorted(by_size)
            base = dict(zip(order, np.cumsum([0, *[by_size[s] for s in order]])[:-1].tolist(), strict=True))
            begin = F.create_map(*[F.lit(x) for kv in base.items() for x in kv])
            w = Window.partitionBy("size", "task").orderBy("local").rowsBetween(Window.unboundedPreceding, -1)
            laid = laid.withColumn("at", F.coalesce(F.sum("length").over(w), F.lit(0))) \
                .join(_before(by_task, "ids", "earlier"), ["size", "task"]) \
                .select("size", "task", F.col("local").alias("rank"), (F.col("at") + F.col("earlier") + begin[F.col("size")])
                        .cast("long").alias("at"))
            again = pieces.join(laid, ["size", "task", "rank"]).select("doc_id", "start", "length", "doc_tokens", "at", "ids")
            wide = words_of(tokenizer).type.itemsize == 4
            out = out.union(again.mapInArrow(_cut(sum(by_size.values()), capacity, sequences, wide), RESULT))
        return block.keep(materialize(out, "packed"))
