"""Near-duplicate groups by bottom-k sketches of one hash function.

A document is the set of its distinct word shingles, each a 64-bit hash.  The
smallest hashes of the set are its bottom-k sketch.

1. Documents with equal sets form a class (two 64-bit sums of the set); from
   here on only a class's smallest document takes part.
2. Inverted lists: a document is listed under its retained values, rare ones
   first, as many as a pair at the threshold needs to share one.  Rarity is a
   fixed-size table of counts of all retained values (a bounded broadcast).
   Any global order serves: two sets that differ in at most q of their k
   retained values share one of the first q + 1.  For sets that are retained
   whole q follows from the threshold; for larger ones it is the binomial
   quantile at 10^-10.
3. A list's smallest member leads it.  Every member is compared with its
   leader, so a list of any length gives one pair a member.  A pair is first
   screened by sizes, then by an estimate from the bottom of the union of both
   sketches, and then measured on the full sets; what moves between tasks gets
   wider only for what is left.
4. Members near their leader (distance up to a value of CORES) can be linked
   only with documents within that value + 1 - threshold of it (Jaccard distance is a metric).
   These are described by their differences from the group's majority set.
   Two members are linked if their differences are few enough together, or
   cancel because they share some.  Links of the first kind imply a link to
   the member with the fewest differences; those of the second kind are found
   in inverted lists of difference values under a prefix filter.
5. Members far from their leader form shorter lists with leaders of their own
   (steps 3 and 4 again, once for each of CORES while the lists are long).  What
   is then far is compared pair by pair: in each list those outside the
   largest component with those of other components.  A pair is made in the
   first list that both are in, and only if positions and sketches leave room
   for the threshold.  Pairs inside one component need no test, so the
   components are exact.

Null and empty texts have an empty set and are linked with nothing; a text
with fewer words than a shingle has its whole sequence as one shingle.
Repeated rows (equal id and text) are one document and get equal results;
rows with one id and different texts are one vertex.  A null id is ordered
after all ids and is reported as null.  Other columns are not read.
"""

from __future__ import annotations

from functools import cache
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.llm.common import (
    NULL_ID,
    batches,
    blobs,
    keyed_texts,
    materialize,
    only_ids,
    real_id,
    row_id,
    scratch,
)
from tillpoint.llm.components import extend
from tillpoint.llm.hashing import mix, sequence_hash, shingle_hashes, word_chunks

RETAINED = 96                # values in a sketch
RARITY_BITS = 22             # the rarity table has 2^22 one-byte counts
RARITY_VALUES = 2_500_000    # counted at once
# distance from the leader up to which differences are used, for leaders by
# list, one after the other, while lists stay long; the sketches still screen
# the many pairs of the first
CORES = (0.40, 0.55)
PLAIN = 4                    # pairs by listed member at which lists count as short
MISS = 1e-10                 # chance that a pair at the threshold shares no listed value


def shingle_sets(texts: list[bytes], k: int):
    """The sorted distinct shingle hashes of each text."""
    low = [t.lower() for t in texts]          # bytes.lower: A-Z only
    for first, words, off in word_chunks(low):
        grams = shingle_hashes(words, k)
        for j in range(len(off) - 1):
            s, e = int(off[j]), int(off[j + 1])
            if e - s >= k:
                yield first + j, np.unique(grams[s:e - k + 1])
            elif e > s:
                yield first + j, np.array([sequence_hash(words[s:e])], np.uint64)
            else:
                yield first + j, np.zeros(0, np.uint64)


@cache
def listed(n: int, num: int, den: int, retained: int = RETAINED) -> int:
    """How many retained values (in any global order) a set of n is listed
    under, so that a pair with intersection / union >= num / den shares one."""
    t = num / den
    if ceil(n / t) <= retained:               # this set and any partner are retained whole
        return n - ceil(t * n - 1e-9) + 1
    kept, tail = min(n, retained), 0.0
    for same in range(kept + 1):              # P(at most ``same`` shared values among kept)
        tail += comb(kept, same) * t**same * (1 - t) ** (kept - same)
        if tail > MISS:
            return kept - same + 1
    return kept


def _features(k: int, retained: int):
    schema = "_d long, _h long, n int, s1 long, s2 long, sketch array<long>"

    def run(it):
        for batch in it:
            texts = blobs(batch)
            n, s1, s2, sk = [], [], [], []
            for _, u in shingle_sets(texts, k):
                n.append(len(u))
                s1.append(int(u.sum(dtype=np.uint64).astype(np.int64)))
                s2.append(int(mix(u ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)))
                sk.append(u[:retained].view(np.int64))
            yield from batches({"_d": (batch.column("_d"), pa.int64()), "_h": (batch.column("_h"), pa.int64()),
                                "n": (n, pa.int32()), "s1": (s1, pa.int64()), "s2": (s2, pa.int64()),
                                "sketch": (sk, pa.list_(pa.int64()))})
    return run, schema


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    col = batch.column("sketch")
    return col.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.diff(col.offsets.to_numpy())


def _bucket(v: np.ndarray) -> np.ndarray:
    return (mix(v) >> np.uint64(64 - RARITY_BITS)).astype(np.int64)


def _rarity(features: DataFrame) -> np.ndarray:
    """Counts of the retained values that a task's documents hold more than
    once (by RARITY_VALUES values), summed over all tasks into 2^RARITY_BITS buckets and kept as
    logarithms (one byte each).  Values that repeat in no task count 0,
    so what is moved is what repeats."""
    def count(held: list[np.ndarray]):
        v, n = np.unique(np.concatenate(held), return_counts=True)
        v, n = v[n > 1], n[n > 1]
        i, where = np.unique(_bucket(v), return_inverse=True)
        yield from batches({"i": (i, pa.int32()),
                            "c": (np.bincount(where, n, len(i)).astype(np.int64), pa.int64())})

    def run(it):
        held, size = [], 0
        for batch in it:
            held.append(_flat(batch)[0])
            size += len(held[-1])
            if size > RARITY_VALUES:
                yield from count(held)
                held, size = [], 0
        if held:
            yield from count(held)

    table = np.zeros(1 << RARITY_BITS, np.uint8)
    counts = features.select("sketch").mapInArrow(run, "i int, c long").groupBy("i").agg(
        F.least(F.lit(255), F.floor(4 * F.log2(F.sum("c") + 1))).cast("short").alias("c"))
    found = counts.toPandas()                                  # at most 2^RARITY_BITS rows
    table[found["i"].to_numpy(np.int64)] = found["c"].to_numpy(np.uint8)
    return table


def _chosen(batch: pa.RecordBatch, table: np.ndarray, num: int, den: int,
            retained: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, value, rank) of the values that each row of ``batch`` is listed
    under, row by row, rare values first."""
    flat, lens = _flat(batch)
    n = batch.column("n").to_numpy()
    want = np.array([listed(int(x), num, den, retained) for x in n], np.int64)
    row = np.repeat(np.arange(len(lens)), lens)
    order = np.lexsort((flat, table[_bucket(flat)], row))
    rank = np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
    first = rank < want[row]
    return row[first], flat[order[first]].view(np.int64), rank[first].astype(np.int16)


def _lists(table: np.ndarray, num: int, den: int, retained: int):
    def run(it):
        for batch in it:
            if batch.num_rows:
                row, value, rank = _chosen(batch, table, num, den, retained)
                yield from batches({"k": (value, pa.int64()), "c": (batch.column("c").to_numpy()[row], pa.int64()),
                                    "r": (rank, pa.int16())})
    return run, "k long, c long, r short"


def _listing(table: np.ndarray, num: int, den: int, retained: int):
    """Each row with ``ls``, all values that it is listed under, in order."""
    def run(it):
        for batch in it:
            if batch.num_rows:
                row, value, _ = _chosen(batch, table, num, den, retained)
                ls = np.split(value, np.searchsorted(row, np.arange(1, batch.num_rows)))
                yield from batches({"c": (batch.column("c"), pa.int64()), "n": (batch.column("n"), pa.int32()),
                                    "sk": (batch.column("sketch"), pa.list_(pa.int64())),
                                    "ls": (ls, pa.list_(pa.int64()))})
    return run, "c long, n int, sk array<long>, ls array<long>"


def _pack(u: np.ndarray) -> bytes:
    """The upper 48 bits of each value: enough to tell the values of two sets
    apart, and a quarter less to move."""
    return np.unique(u >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(b) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(b, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def _sets(k: int):
    def run(it):
        for batch in it:
            ids = batch.column("_d").to_pylist()
            out = [(ids[i], _pack(u)) for i, u in shingle_sets(blobs(batch), k)]
            yield from batches({"_d": ([x[0] for x in out], pa.int64()), "s": ([x[1] for x in out], pa.binary())},
                               2000)
    return run


def _least_shared(num: int, den: int, retained: int) -> float:
    """How many values of the bottom of a union a pair at the threshold
    shares, with seven standard deviations of slack."""
    t = num / den
    return (t - 7 * (t * (1 - t) / retained) ** 0.5) * retained


def _estimate(num: int, den: int, retained: int):
    """Keep the pairs whose similarity, estimated from the bottom of the union
    of their sketches, may reach the threshold; sets that are retained whole
    pass."""
    least = _least_shared(num, den, retained)

    def near(a: np.ndarray, b: np.ndarray) -> bool:
        if min(len(a), len(b)) < retained:
            return True
        both = np.sort(np.concatenate([a, b]))
        twice = both[1:] == both[:-1]
        last = both[np.concatenate([[True], ~twice])][retained - 1]     # bottom of the union
        return int((both[1:][twice] <= last).sum()) >= least

    def values(x) -> np.ndarray:
        return x.values.to_numpy(zero_copy_only=False).view(np.uint64)

    def run(it):
        for batch in it:
            x, y = batch.column("sa"), batch.column("sb")
            ok = [i for i in range(batch.num_rows) if near(values(x[i]), values(y[i]))]
            yield batch.select(["a", "b"]).take(pa.array(ok, pa.int64()))
    return run


def _measure(num: int, den: int):
    """Sizes and differing values of the pairs whose full sets reach the
    threshold."""
    def run(it):
        for batch in it:
            x, y = batch.column("sa"), batch.column("sb")
            keep, na, nb, diff = [], [], [], []
            for i in range(batch.num_rows):
                a, b = _unpack(x[i].as_buffer()), _unpack(y[i].as_buffer())
                both = np.sort(np.concatenate([a, b]))
                twice = np.concatenate([[False], both[1:] == both[:-1], [False]])
                inter = int(twice.sum())
                if den * inter >= num * (len(both) - inter):
                    keep.append(i)
                    na.append(len(a))
                    nb.append(len(b))
                    diff.append(both[~(twice[1:] | twice[:-1])].view(np.int64))
            take = pa.array(keep, pa.int64())
            yield from batches({"a": (batch.column("a").take(take), pa.int64()),
                                "b": (batch.column("b").take(take), pa.int64()), "na": (na, pa.int32()),
                                "nb": (nb, pa.int32()), "diff": (diff, pa.list_(pa.int64()))}, 2000)
    return run, "a long, b long, na int, nb int, diff array<long>"


def _ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("_d")).union(pairs.select(F.col("b").alias("_d"))).distinct()


def _with_both(pairs: DataFrame, table: DataFrame, col: str) -> DataFrame:
    """``pairs`` with ``col`` of both documents as sa and sb."""
    return (pairs.join(table.select(F.col("_d").alias("a"), F.col(col).alias("sa")), "a")
            .join(table.select(F.col("_d").alias("b"), F.col(col).alias("sb")), "b"))


def _measured(pairs: DataFrame, feats: DataFrame, texts: DataFrame, k: int, num: int, den: int,
              retained: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach num / den, with sizes and
    differing values; the wider a column, the fewer pairs it moves for."""
    with scratch() as block:
        sized = _with_both(pairs, feats, "n").filter(F.least("sa", "sb") * den >= F.greatest("sa", "sb") * num)
        sized = materialize(sized.select("a", "b").distinct(), "sized_pairs")
        sketches = only_ids(feats.select("_d", "sketch"), _ids(sized))
        near = materialize(_with_both(sized, sketches, "sketch").mapInArrow(
            _estimate(num, den, retained), "a long, b long").distinct(), "near_pairs")
        sets = materialize(only_ids(texts, _ids(near)).mapInArrow(_sets(k), "_d long, s binary").distinct(), "sets")
        run, schema = _measure(num, den)
        return block.keep(materialize(_with_both(near, sets, "s").mapInArrow(run, schema), "measured_pairs"))


def _reaches(num: int, den: int, na, nb, differing):
    """den * intersection >= num * union for sets of na and nb values of which
    ``differing`` are in one only."""
    return den * (na + nb - differing) >= num * (na + nb + differing)


def _component_of(df: DataFrame, comp: DataFrame, col: str, name: str) -> DataFrame:
    return (df.join(comp.select(F.col("v").alias(col), F.col("comp").alias("_c")), col, "left")
            .withColumn(name, F.coalesce("_c", col)).drop("_c"))


def _links_by_difference(led: DataFrame, comp: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) between members of a leader's group that are not yet in
    one component.  ``led``: leader a, member b, na, nb, diff."""
    with scratch() as block:
        return block.keep(materialize(_difference_links(led, comp, num, den), "links"))


def _difference_links(led: DataFrame, comp: DataFrame, num: int, den: int) -> DataFrame:
    placed = _component_of(_component_of(led, comp, "b", "cb"), comp, "a", "ca")
    open_ = (placed.groupBy("a")
             .agg((F.count("*") + 1).alias("m"), F.min("cb").alias("x"), F.max("cb").alias("y"), F.min("ca").alias("z"))
             .filter("m > 2 and (x <> y or x <> z)").select("a", "m"))
    group = materialize(placed.join(open_, "a"), "open_groups")
    values = group.select("a", "m", "b", F.explode("diff").alias("v"))
    hot = materialize(values.groupBy("a", "v").agg(F.count("*").alias("c"), F.first("m").alias("m"))
                      .filter("2 * c > m").select("a", "v"), "majority")
    leaders = group.select("a", F.col("a").alias("b"), F.col("na").alias("nb"), F.col("ca").alias("cb")).distinct()
    members = group.select("a", "b", "nb", "cb").union(leaders)
    lacking = members.select("a", "b").join(hot, "a").join(values.select("a", "b", "v"), ["a", "b", "v"], "left_anti")
    diff = materialize(values.select("a", "b", "v").join(hot, ["a", "v"], "left_anti").select("a", "b", "v")
                       .union(lacking.select("a", "b", "v")), "differences")
    sized = materialize(members.join(diff.groupBy("a", "b").agg(F.count("*").alias("nd")), ["a", "b"], "left")
                        .fillna(0, ["nd"]), "difference_sizes")
    # nd - (1 - t) / (1 + t) * n, in integers: two members are linked exactly
    # if twice their shared differences make up for the sum of their scores
    unit = den + num
    sized = sized.withColumn("score", (F.col("nd") * unit - F.col("nb") * (den - num)).cast("long"))
    best = sized.groupBy("a").agg(F.min_by(F.struct("b", "score"), F.struct("score", "b")).alias("o"))
    sized = materialize(sized.join(best, "a"), "difference_scores")
    close = materialize(sized.filter("score + o.score <= 0 and b <> o.b").select("b", F.col("o.b").alias("y")), "close")
    # from here on all of these count as one component of the group
    sized = sized.withColumn("cb", F.when(F.col("score") + F.col("o.score") <= 0, F.lit(-1)).otherwise(F.col("cb")))
    # prefix filter over the differences that others have too, rare ones first:
    # of two members the one with the lower score is indexed
    common = diff.groupBy("a", "v").agg(F.count("*").alias("c")).filter("c > 1")
    w = Window.partitionBy("a", "b")
    ranked = (diff.join(common, ["a", "v"]).withColumn("r", F.row_number().over(w.orderBy("c", "v")))
              .withColumn("q", F.count("*").over(w)))
    ranked = materialize(ranked.join(sized.select("a", "b", "cb", "score", "o"), ["a", "b"]), "ranked_differences")

    def prefix(needed):
        return ranked.filter(F.col("r") <= F.col("q") - F.greatest(F.lit(1), F.ceil(needed / (2 * unit))) + 1)

    # left: how many differences can be shared from this one on; for the first
    # shared one of a linked pair that is enough
    left = (F.col("q") - F.col("r") + 1).alias("left")
    index = prefix(2 * F.col("score")).select("a", "v", "b", "cb", "score", left)
    probe = prefix(F.col("score") + F.col("o.score")).select(
        "a", "v", *[F.col(c).alias(c + "1") for c in ("b", "cb", "score")], left.alias("left1"))
    cand = (index.join(probe, ["a", "v"])
            .filter("cb <> cb1 and (score < score1 or (score = score1 and b < b1))")
            .filter(2 * unit * F.least("left", "left1") >= F.col("score") + F.col("score1"))
            .select("a", "b", "b1", (F.col("score") + F.col("score1")).alias("need")).distinct())
    lists = ranked.groupBy("a", "b").agg(F.collect_list("v").alias("vs"))      # at most a set's size
    cand = cand.join(lists, ["a", "b"]).join(lists.toDF("a", "b1", "vs1"), ["a", "b1"])
    crossed = cand.filter(2 * unit * F.size(F.array_intersect("vs", "vs1")) >= F.col("need"))
    return close.union(crossed.select("b", "b1")).toDF("a", "b").distinct()


def _led(lists: DataFrame) -> DataFrame:
    """(k, c, lo): the lists of two or more members with their smallest."""
    ends = lists.groupBy("k").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi")
    return materialize(lists.join(ends.drop("hi"), "k").select("k", "c", "lo"), "led_lists")


def _far_members(led: DataFrame, core: DataFrame, comp: DataFrame) -> DataFrame:
    """(k, c, comp, main): members that are not near their list's leader, in
    lists whose far members span several components; main is the largest."""
    far = led.filter("c <> lo").join(core, ["lo", "c"], "left_anti").select("k", "c")
    far = materialize(_component_of(far, comp, "c", "comp"), "far_members")
    sizes = far.groupBy("k", "comp").count()
    open_ = (sizes.groupBy("k").agg(F.count("*").alias("m"), F.max(F.struct("count", "comp"))["comp"].alias("main"))
             .filter("m > 1").select("k", "main"))
    return materialize(far.join(open_, "k"), "open_lists")


def _cross_size(members: DataFrame) -> int:
    """How many rows the comparison of all far members would make."""
    n = members.groupBy("k").agg(F.count("*").alias("n"), F.sum((F.col("comp") != F.col("main")).cast("long")).alias("o"))
    return n.agg(F.sum(F.col("n") * F.col("o"))).first()[0] or 0


def _cross_pairs(members: DataFrame, table: np.ndarray, feats: DataFrame, num: int, den: int,
                 retained: int) -> DataFrame:
    """Members outside a list's largest component with members of other
    components, once for each pair: in the list of the first value that both
    are listed under.  Where that list has lost one of them, the pair needs no
    test (the one was near a leader, or both were in one component).  Lists
    are met with sketches, so that the join itself drops what cannot reach the
    threshold: of sets that are retained whole, by positions and then exactly;
    of others, by the values that both sketches share."""
    ids = members.select(F.col("c").alias("_d")).distinct()
    own = only_ids(feats.select("_d", "n", "sketch"), ids).withColumnRenamed("_d", "c").dropDuplicates(["c"])
    known = materialize(members.join(own.mapInArrow(*_listing(table, num, den, retained)), "c")
                        .withColumn("r", F.array_position("ls", F.col("k")) - 1), "far_lists")
    rest = known.filter("comp <> main").select(
        "k", *[F.col(x).alias(x + "1") for x in ("c", "comp", "n", "ls", "r", "sk")])
    n, n1, r, r1 = (F.col(x) for x in ("n", "n1", "r", "r1"))
    both = F.size(F.array_intersect("sk", "sk1"))
    whole = F.greatest(n, n1) <= retained
    cross = (rest.join(known, "k").filter("comp1 <> comp and (comp = main or c1 < c)")
             .filter(F.least(n, n1) * den >= F.greatest(n, n1) * num)
             .filter(~whole | _reaches(num, den, n, n1, r + r1))
             .filter(F.array_intersect("ls", "ls1")[0] == F.col("k"))
             .filter(F.when(whole, _reaches(num, den, n, n1, n + n1 - 2 * both))
                     .otherwise((F.least(n, n1) < retained) | (both >= _least_shared(num, den, retained)))))
    return cross.select(F.least("c1", "c").alias("a"), F.greatest("c1", "c").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    num: int = 80, den: int = 100, retained: int = RETAINED) -> DataFrame:
    """(_d, _h, n_shingles, comp): one row per row of ``docs``; ``comp`` is the
    smallest document (internal id) of its group under the links
    ``den * intersection >= num * union``."""
    with scratch() as block:
        texts = keyed_texts(docs, id_col, text_col)
        run, schema = _features(shingle, retained)
        feats = materialize(texts.mapInArrow(run, schema), "sketches")
        sig = ["n", "s1", "s2"]
        classes = feats.filter("n > 0").groupBy(*sig).agg(F.min("_d").alias("c"))
        member = materialize(feats.select("_d", "_h", *sig).join(classes, sig, "left")
                             .select("_d", "_h", "n", F.coalesce("c", "_d").alias("c")), "classes")
        reps = feats.select("_d", *sig, "sketch").join(classes, sig).filter("_d = c").select("c", "n", "sketch")
        table = _rarity(feats)
        keys = materialize(reps.mapInArrow(*_lists(table, num, den, retained)), "lists")

        led, comp = _led(keys), None
        for core_reach in CORES:
            pairs = led.filter("c <> lo").select(F.col("lo").alias("a"), F.col("c").alias("b")).distinct()
            # partners of a member within core_reach of the leader are within this reach of it
            near = _measured(pairs, feats, texts, shingle, int((num / den - core_reach) * 100), 100, retained)
            comp = extend(comp, near.filter(_reaches(num, den, F.col("na"), F.col("nb"), F.size("diff"))).select("a", "b"))
            comp = extend(comp, _links_by_difference(near, comp, num, den))
            core = near.filter(_reaches(round(100 * (1 - core_reach)), 100, F.col("na"), F.col("nb"), F.size("diff"))).select(
                F.col("a").alias("lo"), F.col("b").alias("c")).distinct()
            far = _far_members(led, core, comp)
            work = _cross_size(far)
            if work <= PLAIN * far.count():
                break
            led = _led(far.select("k", "c"))
        if work:
            pairs = materialize(_cross_pairs(far, table, feats, num, den, retained), "far_pairs")
            comp = extend(comp, _measured(pairs, feats, texts, shingle, num, den, retained).select("a", "b"))
        out = member.join(comp.withColumnRenamed("v", "c"), "c", "left").select(
            "_d", "_h", F.col("n").cast("long").alias("n_shingles"), F.coalesce("comp", "c").alias("comp"))
        return block.keep(materialize(out, "near_duplicate_groups"))


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id, kept."""
    r = near_duplicates(docs, **options)
    return r.select(real_id("_d").alias("doc_id"), "n_shingles", real_id("comp").alias("component_id"),
                    (F.col("_d") == F.col("comp")).alias("kept"))


def _vertices(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with __n_d, the internal id, and __n_h, the text's hash.  Of an
    id with several texts all but one get ids of their own (above all ids), so
    that each is grouped by its own text."""
    docs = docs.withColumn("__n_d", row_id(id_col, text_col)).withColumn("__n_h", F.xxhash64(F.col(text_col)))
    several = materialize(docs.groupBy("__n_d").agg(F.min("__n_h").alias("__n_lo"), F.max("__n_h").alias("__n_hi"))
                          .filter("__n_lo <> __n_hi").select("__n_d", "__n_lo"), "ids_of_several_texts")
    if several.isEmpty():
        return docs
    own = F.lit(NULL_ID) + F.xxhash64("__n_d", "__n_h").bitwiseAND(F.lit(NULL_ID - 1))
    return (docs.join(several, "__n_d", "left")
            .withColumn("__n_d", F.when(F.col("__n_h") > F.col("__n_lo"), own).otherwise(F.col("__n_d"))).drop("__n_lo"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each group: that of its smallest document.  Rows that agree
    in id and text (a null id: in text) are one document; of these the row
    stays whose other columns have the smallest hash."""
    rows = _vertices(docs, id_col, text_col)
    key = [F.col("_d").alias("__n_d"), F.col("_h").alias("__n_h")]
    near = near_duplicates(rows, "__n_d", text_col, **options)
    gone = near.filter("_d <> comp").select(*key).distinct()
    twice = materialize(near.filter("_d = comp").groupBy("_d", "_h").count().filter("count > 1").select(*key),
                        "repeated_survivors")
    if twice.isEmpty():
        return rows.join(gone, ["__n_d", "__n_h"], "left_anti").select(*docs.columns)
    once = rows.join(gone.union(twice), ["__n_d", "__n_h"], "left_anti").select(*docs.columns)
    # min_by combines in each task first: a text of any frequency is no large group
    one = (rows.join(twice, ["__n_d", "__n_h"], "left_semi").groupBy("__n_d", "__n_h")
           .agg(F.min_by(F.struct(*docs.columns), F.xxhash64(F.to_json(F.struct(*docs.columns)))).alias("__n_row")))
    return once.union(one.select("__n_row.*"))
