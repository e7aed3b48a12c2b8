"""Quality rules with host-level verdicts (native columns only).

Per document the signals of its whole text are computed as columns: words,
code points in words, symbols, repeated lines and words inside 8-word windows
that occur more than once.  A document fails the base rule when it is short
or repeats itself.  The failures are then aggregated by host (the domain or
source of a document), each host's failure rate is shrunk towards the rate of
all hosts with an empirical beta prior (method of moments over the hosts),
and the host's verdict is joined back: a document of a rejected host has to
pass a stricter rule as well, so clean documents of a bad host stay.

Beta prior: with hosts i of n_i documents and f_i failures, m = sum f / sum n
and v = the document-weighted variance of f_i / n_i; the prior's strength is
m (1 - m) / v - 1, at least 1 and at most 10^6 (equal rates give v = 0); the
shrunk rate is (f_i + strength m) / (n_i + strength).

Null or empty text: no words, all counts 0, base rule failed.  Null or empty
host: no host verdict.  Rows are judged one by one, so repeated rows get equal
verdicts; an empty table gives an empty result.  Other columns are carried
unchanged; names that begin with ``__q_`` are taken by this module.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import let, materialize

SPACES = r"[\x20\x09-\x0D]+"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
HOST_MAX_RATE = 0.5
STRICT_REPEAT_PCT = 10
STRICT_SYMBOL_PCT = 10


def _covered(hashes: Column, window: int) -> Column:
    """Words covered by windows whose hash occurs more than once."""
    def flagged(s: Column) -> Column:
        starts = F.transform(F.filter(s, lambda e, j: F.coalesce(F.get(s, j - 1)["h"] == e["h"], F.lit(False))
                                      | F.coalesce(F.get(s, j + 1)["h"] == e["h"], F.lit(False))),
                             lambda e: e["i"])
        zero = F.struct(F.lit(0).alias("n"), F.lit(-window).alias("p"))
        return F.aggregate(F.sort_array(starts), zero,
                           lambda a, i: F.struct((a["n"] + F.least(F.lit(window), i - a["p"])).alias("n"),
                                                 i.alias("p")))["n"]
    pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return let(F.sort_array(pairs), flagged)


def signals(text: Column, window: int = WINDOW) -> Column:
    """Struct of the signals of one whole text."""
    t = F.coalesce(text, F.lit(""))

    def of_words(ws: Column) -> Column:
        n = F.size(ws)
        hashes = F.when(n > window, F.transform(F.sequence(F.lit(1), n - window + 1),
                                                lambda i: F.xxhash64(F.slice(ws, i, window))))
        repeated = F.when(n > window, let(
            hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _covered(h, window))
            .otherwise(F.lit(0)))).otherwise(F.lit(0))
        return F.struct(n.cast("long").alias("n_words"),
                        F.aggregate(ws, F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
                        F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
                        repeated.cast("long").alias("n_repeat_words"))

    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    dup_lines = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")
    words = let(F.filter(F.split(t, SPACES), lambda w: w != ""), of_words)
    return let(words, lambda w: F.struct(*[w[c].alias(c) for c in
                                           ("n_words", "word_chars", "n_symbols", "n_repeat_words")],
                                         dup_lines.alias("n_dup_lines")))


def host_rates(judged: DataFrame) -> DataFrame:
    """(__q_host, n, f, rate): failures by host, shrunk.  ``judged`` has
    __q_host and __q_failed."""
    hosts = judged.filter(F.col("__q_host").isNotNull()).groupBy("__q_host").agg(
        F.count("*").alias("n"), F.sum(F.col("__q_failed").cast("long")).alias("f"))
    hosts = materialize(hosts, "host_failures")
    r = F.col("f") / F.col("n")
    m = F.sum("f") / F.sum("n")
    v = F.sum(F.col("n") * r * r) / F.sum("n") - m * m
    strength = F.when(v > 0, F.least(F.lit(1e6), F.greatest(F.lit(1.0), m * (1 - m) / v - 1))).otherwise(F.lit(1e6))
    prior = hosts.agg(m.alias("m"), strength.alias("k"))
    mean, k = prior.select("m").scalar(), prior.select("k").scalar()
    return hosts.withColumn("rate", (F.col("f") + k * mean) / (F.col("n") + k))


def _base_failed(q: Column, min_words: int, max_repeat_pct: int) -> Column:
    return (q["n_words"] < min_words) | (100 * q["n_repeat_words"] > max_repeat_pct * q["n_words"])


def _strict_failed(q: Column) -> Column:
    return ((100 * q["n_repeat_words"] > STRICT_REPEAT_PCT * q["n_words"])
            | (100 * q["n_symbols"] > STRICT_SYMBOL_PCT * q["word_chars"]) | (q["n_dup_lines"] > 0))


def _host(host_col: str) -> Column:
    host = F.col(host_col).cast("string")
    return F.when(host != "", host)


def _with_verdict(judged: DataFrame, rates: DataFrame, host_max_rate: float) -> DataFrame:
    """Join the hosts' rates back and decide."""
    bad_host = F.coalesce(F.col("__q_rate") > host_max_rate, F.lit(False))
    return (judged.join(rates.select("__q_host", F.col("rate").alias("__q_rate")), "__q_host", "left")
            .withColumn("__q_kept", ~F.col("__q_failed") & ~(bad_host & _strict_failed(F.col("__q")))))


def judge(docs: DataFrame, text_col: str = "text", host_col: str = "source",
          carry: list[str] | None = None, min_words: int = MIN_WORDS,
          max_repeat_pct: int = MAX_REPEAT_PCT, host_max_rate: float = HOST_MAX_RATE) -> DataFrame:
    """The columns in ``carry`` (default: all) with ``__q`` (the signals),
    ``__q_failed`` (base rule), ``__q_rate`` (shrunk failure rate of the host,
    null without host) and ``__q_kept``.  The texts are read once: signals
    and carried columns are written to the shared scratch folder."""
    carry = docs.columns if carry is None else carry
    one = docs.select(*[docs[c] for c in carry], _host(host_col).alias("__q_host"),
                      signals(F.col(text_col)).alias("__q"))
    one = one.withColumn("__q_failed", _base_failed(F.col("__q"), min_words, max_repeat_pct))
    one = materialize(one, "quality_signals")
    return _with_verdict(one, host_rates(one), host_max_rate)


def filter_documents(docs: DataFrame, text_col: str = "text", host_col: str = "source", min_words: int = MIN_WORDS,
                     max_repeat_pct: int = MAX_REPEAT_PCT, host_max_rate: float = HOST_MAX_RATE) -> DataFrame:
    """The documents that both the base rule and the host rule keep.  The
    signals are computed twice, for the hosts and for the verdicts, so that
    no second copy of the texts is written."""
    def judged(*columns: str) -> DataFrame:
        d = docs.select(*columns, _host(host_col).alias("__q_host"), signals(F.col(text_col)).alias("__q"))
        return d.withColumn("__q_failed", _base_failed(F.col("__q"), min_words, max_repeat_pct))

    rates = host_rates(judged())
    return _with_verdict(judged(*docs.columns), rates, host_max_rate).filter("__q_kept").select(*docs.columns)
