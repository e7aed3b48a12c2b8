"""Spelling variants of a corpus vocabulary, by permuterm rotations.

Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, lower-cased in A-Z
only.  Two words are near if they differ by exactly one inserted, deleted or
replaced code point; a word's form is its near word of largest count (ties: the
smallest in code-point order), if that count is at least ``ratio`` times its own.

Rotations.  Every word gets a terminator, and each of its rotations stands for
one edited character: the rotation that puts character i last is the prefix
``w[i+1:] + '$' + w[:i]`` followed by that character.  In the sorted rotations
all words that share the prefix stand together: those with one more character
differ from each other by a replacement at that place, and the word whose whole
rotation the prefix is (it has no character there) is one deletion away from
them.  A scan over each group emits for every word how many near words it met
there and the best of them.  A group has at most one word for each character of
the alphabet (90) and one without, whatever the corpus; two words meet in
exactly one group, since of a run of equal characters only the first counts as
the deleted one.  Counts add up and bests combine over a word's groups.

Roots.  A form's count is ``ratio`` times the word's or more, so chains are
short (27 forms reach 2^63 at a ratio of 5) and pointer jumping ends after five
rounds at most.

Null and empty texts have no words.  A row counts as often as it stands in the
table.  Long texts are read whole.  Words hold no other characters, so the
terminator is in none.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import batches, blobs, materialize, prepare, scratch

MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
HELD = 200_000               # distinct words that a task holds before it sends their counts on
#: U+00C0 to U+00FF are the bytes C3 80 to C3 BF
RUN = rb"(?:[a-z]+|\xc3[\x80-\xbf])+"


def length(word: bytes) -> int:
    return len(word) - word.count(b"\xc3")


def drop_by_crc(every: int = 199) -> Callable[[object, bytes], bytes]:
    """The rule of the query: where ``every`` divides the crc32 h of
    ``<id>:<run>`` the run loses its code point h % length.  A null id is
    written as nothing."""
    def rule(ident: object, run: bytes) -> bytes:
        h = zlib.crc32((b":" if ident is None else f"{ident}:".encode()) + run)
        if h % every:
            return run
        s = run.decode()
        i = h % len(s)
        return (s[:i] + s[i + 1:]).encode()
    return rule


def _count(rule, least: int):
    # a rule takes away one code point at most; shorter runs can be skipped at once
    words = re.compile(RUN)

    def run(it):
        held: Counter = Counter()

        def send():
            rows = list(held.items())
            held.clear()
            yield from batches({"word": ([w.decode() for w, _ in rows], pa.string()),
                                "n": ([n for _, n in rows], pa.int64())})

        for batch in it:
            for ident, text in zip(batch.column("id").to_pylist(), blobs(batch, "text"), strict=True):
                for w, n in Counter(words.findall(text.lower())).items():
                    if len(w) >= least and length(w) >= least:
                        w = rule(ident, w) if rule else w
                        if length(w) >= least:
                            held[w] += n
                if len(held) >= HELD:
                    yield from send()
        yield from send()
    return run


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule=None,
               min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the distinct words with their counts over all texts.  ``rule``
    may change a run of a document before it is counted (shorten it by at most
    one code point)."""
    prepare(docs.sparkSession)
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    parts = d.mapInArrow(_count(rule, min_length), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, word, n, last, first): every rotation of each word without its
    last character, which is ``last`` (null: the whole rotation); ``first``
    says whether that character is the first of a run of equal ones."""
    size = F.length("word")

    def cut(i):                                            # i: 0-based place of the character
        before, at = F.substr(F.col("word"), F.lit(1), i), F.substr(F.col("word"), i + 1, F.lit(1))
        return F.struct(F.concat(F.substr(F.col("word"), i + 2, size), F.lit("$"), before).alias("prefix"), at.alias("last"),
                        ((i == 0) | (at != F.substr(F.col("word"), i, F.lit(1)))).alias("first"))

    def whole(i):
        return F.struct(F.concat(F.substr(F.col("word"), i + 1, size), F.lit("$"), F.substr(F.col("word"), F.lit(1), i))
                        .alias("prefix"), F.lit(None).cast("string").alias("last"), F.lit(False).alias("first"))

    every = F.concat(F.transform(F.sequence(F.lit(0), size - 1), cut), F.transform(F.sequence(F.lit(0), size), whole))
    return words.select("word", "n", F.explode(every).alias("r")).select("r.*", "word", "n")


def _scan(it):
    """Groups of equal prefixes in the sorted rotations, the whole rotation
    first: (word, near words met, best of them) for each member."""
    prefix, base, members = None, None, []
    out: list[tuple] = []

    def emit():
        # best two, by count and then code-point order (the order of UTF-8 bytes)
        top = sorted(members, key=lambda x: (-x[1], x[0]))[:2]
        for word, n, first in members:
            near = len(members) - 1
            found = [x[:2] for x in top if x[0] != word][:1]
            if base is not None and first:
                near += 1
                found.append(base)
            if near:
                best = min(found, key=lambda x: (-x[1], x[0]))
                out.append((word.decode(), near, best[0].decode(), best[1]))
        if base is not None:
            mine = [x for x in members if x[2]]
            if mine:
                best = min(mine, key=lambda x: (-x[1], x[0]))
                out.append((base[0].decode(), len(mine), best[0].decode(), best[1]))

    def rows():
        w, near, form, n = zip(*out, strict=True) if out else ((), (), (), ())
        out.clear()
        yield from batches({"word": (w, pa.string()), "n_near": (near, pa.int64()), "form": (form, pa.string()),
                            "form_n": (n, pa.int64())})

    for batch in it:
        cols = [blobs(batch, "prefix"), batch.column("last").to_pylist(), batch.column("first").to_pylist(),
                blobs(batch, "word"), batch.column("n").to_pylist()]
        for p, last, first, word, n in zip(*cols, strict=True):
            if p != prefix:
                if len(members) + (base is not None) > 1:
                    emit()
                prefix, base, members = p, None, []
            if last is None:
                base = (word, n)
            else:
                members.append((word, n, first))
        yield from rows()
    if len(members) + (base is not None) > 1:
        emit()
    yield from rows()


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n) for the words that have a near one; form
    and form_n are the best near word and its count."""
    r = rotations(words).repartition("prefix").sortWithinPartitions("prefix", F.col("last").asc_nulls_first())
    met = r.mapInArrow(_scan, "word string, n_near long, form string, form_n long")
    # the largest count, then the smallest word: two plain aggregates
    most = met.groupBy("word", "form_n").agg(F.sum("n_near").alias("c"), F.min("form").alias("form"))
    return most.groupBy("word").agg(F.sum("c").alias("n_near"), F.max("form_n").alias("form_n"),
                                    F.max_by("form", "form_n").alias("form"))


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule=None,
             min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the vocabulary;
    form and form_n are null and the root is the word itself where no near
    word is frequent enough."""
    with scratch() as block:
        words = materialize(vocabulary(docs, id_col, text_col, rule, min_length, min_count), "words")
        near = neighbours(words)
        fits = F.col("form_n") >= ratio * F.col("n")
        table = materialize(words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(fits, F.col("form")).alias("form"), F.when(fits, F.col("form_n")).alias("form_n")), "near")
        links = materialize(table.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "links")
        while True:                                    # each round halves what is left of every chain
            jump = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
            far = links.join(jump, "root").select("word", F.col("next").alias("root"))
            far = materialize(far, "jumps")
            if far.isEmpty():
                break
            stay = links.join(far.select("word"), "word", "left_anti")
            links = materialize(stay.union(far), "links")
        out = table.join(links, "word", "left").select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
        return block.keep(materialize(out, "variants"))
