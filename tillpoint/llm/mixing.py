"""Mixing sources to target weights by temperature.

With p the token shares of the sources, the mixture weights are p^t / sum p^t.
The exponent t is found by bisection (many points of the interval at a time,
as one aggregate over the table of sources) so that the weights' entropy
reaches a target, or so that no source is repeated more than a limit allows.

The weights are realised as budgeted block permutations.  A source's tokens
are cut into blocks of about ``block_tokens`` by a keyed hash of the document;
each epoch orders the blocks and the documents within them by keyed hashes of
its own.  A source with budget w B over T tokens gives floor(w B / T) whole
epochs, and from the last epoch whole blocks in order while they fit, and from
the next block documents in order while the tokens before them are below the
rest.  So a document's copies differ by at most one within its source, and a
source is at most one document over its budget.

Only tables of sources and of blocks are aggregated; rows of documents meet
their source's block table in an equi-join, and running sums go over the
blocks of a source and over the documents of one block per source.

Null and empty texts have no tokens and are not drawn (no tokens to count).
A null source is a source of its own.  Repeated rows are drawn alike.  An
empty table gives an empty result.  The input's columns are kept unchanged
and followed by ``mix_epoch`` and ``mix_block`` (for the reader's order);
names that begin with ``__m_`` or ``mix_`` are taken by this module.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.llm.common import materialize

POINTS = 32                  # exponents tried by one aggregate
ROUNDS = 9                   # 32^9 parts of the interval: beyond a double's precision
BLOCK_TOKENS = 1 << 17


def _key(seed: int, *parts: Column) -> Column:
    """A keyed order: the first 60 bits of a digest as a long."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]), 256),
                              1, 15), 16, 10).cast("long")


def _bisect(sources: DataFrame, value, target: float, rising: bool) -> float:
    """The exponent in [0, 1] at which ``value(t)``, an aggregate that is
    monotone in t, meets the target (an end if it lies outside)."""
    lo, hi = 0.0, 1.0
    for _ in range(ROUNDS):
        ts = [lo + (hi - lo) * i / POINTS for i in range(POINTS + 1)]
        got = sources.agg(*[value(t).alias(f"v{i}") for i, t in enumerate(ts)]).first()
        below = [i for i in range(POINTS + 1) if (got[i] <= target) == rising]
        i = max(below, default=0)
        if i == POINTS:
            return hi
        lo, hi = ts[i], ts[i + 1]
    return lo


def mixture_weights(sources: DataFrame, target_entropy: float | None = None,
                    repeat_limit: float | None = None) -> tuple[float, float]:
    """(exponent, sum of p^t) for a table of sources with token counts T.

    ``target_entropy`` is a share of the largest entropy (1: uniform weights);
    ``repeat_limit`` bounds the ratio of the largest to the smallest number of
    epochs.  The largest exponent (nearest to the natural shares) whose entropy
    reaches the target is taken, resp. the smallest one within the limit."""
    n, total, least, most = sources.agg(F.count("*"), F.sum("T"), F.min("T"), F.max("T")).first()
    if not n or least == most:
        return 1.0, 1.0 * bool(n)
    p = F.col("T") / F.lit(float(total))
    if target_entropy is not None:
        def entropy(t: float) -> Column:
            z = F.sum(F.pow(p, F.lit(t)))
            return F.log(z) - F.lit(t) * F.sum(F.pow(p, F.lit(t)) * F.log(p)) / z
        exponent = _bisect(sources, lambda t: -entropy(t), -target_entropy * math.log(n), True)
    else:
        def spread(t: float) -> Column:     # epochs go with p^(t - 1): falls as t rises
            e = F.pow(p, F.lit(t - 1))
            return -F.max(e) / F.min(e)
        exponent = _bisect(sources, lambda t: -spread(t), float(repeat_limit or 1.0), False)
        exponent = min(1.0, exponent + 1e-12)
    return exponent, sources.agg(F.sum(F.pow(p, F.lit(exponent)))).first()[0]


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        target_entropy: float | None = None, repeat_limit: float | None = 2.0, budget_tokens: int | None = None,
        block_tokens: int = BLOCK_TOKENS, seed: int = 7) -> DataFrame:
    """``docs`` drawn to the mixture: a row per copy, with mix_epoch and
    mix_block.  Without a budget it is the smallest one at which every
    document is drawn."""
    columns = docs.columns
    tokens = F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    d = docs.withColumn("__m_T", tokens).withColumn("__m_k", F.xxhash64(F.col(id_col), F.col(text_col)))
    d = d.withColumn("__m_s", F.col(source_col).cast("string")).filter("__m_T > 0")
    counts = materialize(d.groupBy("__m_s").agg(F.sum("__m_T").alias("T"), F.count("*").alias("n")), "source_tokens")
    exponent, z = mixture_weights(counts, target_entropy, repeat_limit)
    total = counts.agg(F.sum("T")).first()[0] or 0
    weight = F.pow(F.col("T") / F.lit(float(max(total, 1))), F.lit(exponent)) / F.lit(z or 1.0)
    if budget_tokens is None:
        budget_tokens = math.ceil((counts.agg(F.max(F.col("T") / weight)).first()[0] or 0.0) * (1 - 1e-12))
    plan = (counts.withColumn("B", F.floor(weight * F.lit(float(budget_tokens)) + 1e-6))
            .withColumn("whole", F.floor(F.col("B") / F.col("T"))).withColumn("rest", F.col("B") % F.col("T"))
            .withColumn("blocks", F.ceil(F.col("T") / block_tokens)).select("__m_s", "whole", "rest", "blocks"))
    plan = materialize(plan, "mixture")
    d = d.alias("d").join(plan.alias("p"), F.col("d.__m_s").eqNullSafe(F.col("p.__m_s"))).drop(F.col("p.__m_s"))
    d = d.withColumn("__m_b", F.pmod("__m_k", "blocks"))
    # the blocks of the last epoch in its order, with the tokens before them
    blocks = d.filter("rest > 0").groupBy("__m_s", "__m_b", "whole", "rest").agg(F.sum("__m_T").alias("t"))
    order = Window.partitionBy("__m_s").orderBy(_key(seed, F.coalesce("__m_s", F.lit("")), F.col("whole"),
                                                     F.col("__m_b")), "__m_b")
    before = F.coalesce(F.sum("t").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = (blocks.withColumn("before", before).filter("before < rest")
           .select("__m_s", "__m_b", F.col("before"), (F.col("before") + F.col("t") <= F.col("rest")).alias("all")))
    cut = materialize(cut, "last_epoch")
    split = cut.filter("not all").select(F.col("__m_s").alias("__m_cs"), F.col("__m_b").alias("__m_cb"), "before")
    inner = (d.select("__m_s", "__m_b", "__m_k", "__m_T", "whole", "rest")
             .join(split, F.col("__m_s").eqNullSafe(F.col("__m_cs")) & (F.col("__m_b") == F.col("__m_cb"))))
    inner = inner.groupBy("__m_s", "__m_b", "__m_k", "whole", "rest", "before").agg(F.sum("__m_T").alias("t"))
    within = Window.partitionBy("__m_s", "__m_b").orderBy(_key(seed + 1, F.col("whole"), F.col("__m_k")), "__m_k")
    ahead = F.col("before") + F.coalesce(F.sum("t").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    taken = inner.withColumn("ahead", ahead).filter("ahead < rest")
    taken = materialize(taken.select(F.col("__m_k").alias("__m_ck")).distinct(), "last_block")
    whole = cut.filter("all").select(F.col("__m_s").alias("__m_ws"), F.col("__m_b").alias("__m_wb"))
    d = (d.join(whole, F.col("__m_s").eqNullSafe(F.col("__m_ws")) & (F.col("__m_b") == F.col("__m_wb")), "left")
         .join(taken, F.col("__m_k") == F.col("__m_ck"), "left"))
    extra = F.when(F.col("__m_wb").isNotNull() | F.col("__m_ck").isNotNull(), 1).otherwise(0)
    copies = (F.col("whole") + extra).cast("int")
    return (d.withColumn("__m_n", copies).filter("__m_n > 0")
            .withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), F.col("__m_n") - 1)))
            .withColumn("mix_block", F.pmod(_key(seed, F.coalesce("__m_s", F.lit("")), F.col("mix_epoch"),
                                                 F.col("__m_b")), F.lit(1 << 40)))
            .select(*[F.col(c) for c in columns], "mix_epoch", "mix_block"))
