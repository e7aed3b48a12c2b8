"""Hard negatives, packing and spelling variants against plain versions."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillpoint.llm import language_id, negative_mining, packing, quality_classifier, spelling_variants

SF = "/root/testdata/sf0.001"


# hard negatives -------------------------------------------------------------------
def plain_negatives(rows, every=50):
    best = {}
    for i, label, vec in rows:
        if i is None or label is None or vec is None or any(x is None or not np.isfinite(x) for x in vec):
            continue
        best[i] = min(best.get(i, (label, list(vec))), (label, list(vec)))
    dim = max((len(v) for _, v in best.values()), default=0)
    q = {i: (lab, [int(np.floor(256 * float(np.float32(x)))) for x in v] + [0] * (dim - len(v)))
         for i, (lab, v) in best.items()}
    out = set()
    for a in (i for i in q if i % every == 0):
        s = sorted((-sum(x * y for x, y in zip(q[a][1], v, strict=True)), i, lab) for i, (lab, v) in q.items() if i != a)
        for ps, p, _ in [x for x in s if x[2] == q[a][0]][:5]:
            hits = [x for x in s if x[2] != q[a][0] and 50 * -ps <= 100 * -x[0] <= 95 * -ps][:3]
            out |= {(a, p, r, n, -ps, -ns) for r, (ns, n, _) in enumerate(hits, 1)}
    return out


def mined(spark, rows, schema="vec_id long, label int, embedding array<float>, d int, score string, part int"):
    df = spark.createDataFrame([(*r, 1, "x", None) for r in rows], schema)
    got = negative_mining.mine(df, lambda ids: ids % 50 == 0).collect()
    assert len(got) == len(set(got))
    return {tuple(r) for r in got}


def test_negatives_on_the_table(spark):
    emb = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in emb.collect()]
    want = plain_negatives(rows)
    assert want and mined(spark, rows) == want


def test_negatives_edge_cases(spark):
    rng = random.Random(1)
    rows = [(i, rng.randrange(3), [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(4)]) for i in range(400)]   # ties
    rows += rows[:60]                                                            # repeated rows
    rows += [(50, 2, [9.0] * 4), (100, 0, [0.0] * 4), (None, 1, [1.0] * 4), (401, None, [1.0] * 4), (402, 1, None),
             (403, 1, [1.0, None, 0.0, 0.0]), (404, 1, [float("nan")] * 4), (405, 1, [float("inf"), 0.0, 0.0, 0.0]),
             (406, 1, []), (450, 9, [1.0, 1.0]), (451, 1, [1.0] * 6)]
    assert mined(spark, rows) == plain_negatives(rows)
    assert mined(spark, []) == set()
    assert mined(spark, [(0, 1, [1.0])]) == set()


def test_large_components_are_exact(spark):
    rows = [(i, i % 2, [float(2 ** 26 + i), float(-(2 ** 25) + 3 * i)]) for i in range(120)]
    assert mined(spark, rows) == plain_negatives(rows)


def test_hilbert_curve_is_a_walk():
    n, bits = 3, 3
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n), -1).reshape(-1, n)
    key = negative_mining.hilbert(cells, bits)
    assert sorted(key.tolist()) == list(range(1 << n * bits))
    assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(1) == 1).all()


def test_zone_maps_spare_blocks():
    """Far clusters: bounds hold every score, and most blocks need not be read."""
    rng = np.random.default_rng(2)
    centres = rng.integers(-500, 500, (20, 6))
    v = centres[np.repeat(np.arange(20), 50)] + rng.integers(-5, 5, (1000, 6))
    blocks = [negative_mining.Block(0, np.arange(i, i + 50), v[i:i + 50]) for i in range(0, 1000, 50)]
    a = v[::100]
    lo, hi = negative_mining.bounds(a, np.stack([b.lo for b in blocks]), np.stack([b.hi for b in blocks]))
    s = a @ v.T
    for j in range(20):
        part = s[:, 50 * j:50 * j + 50]
        assert (lo[:, j] <= part.min(1)).all() and (part.max(1) <= hi[:, j]).all()
    m = negative_mining
    start = np.sort(s, 1)[:, [-5]]
    _, _, reads = m.best(a, np.arange(0, 1000, 100), np.zeros(10, int), start, np.full((10, 1), m.MOST), blocks, 5, True)
    assert reads < len(a) * len(blocks) / 4


# packing --------------------------------------------------------------------------
@pytest.fixture(scope="module")
def tokenizer():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def check_packing(rows, texts, tokenizer, least_fill):
    """Exact round trip of (doc_id, text) rows; returns the share of padding."""
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer)
    want = Counter()
    for doc, text in texts:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want[(doc, ids.tobytes())] += 1
    docs, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r["doc_id"], r["doc_tokens"]].append(r)
        seqs[r["sequence_id"]].append(r)
    assert sum(r["length"] for r in rows) == sum(len(i) // 4 * n for (_, i), n in want.items())
    for (doc, blob), n in want.items():
        ids = np.frombuffer(blob, "<u4")
        mine = docs[doc, len(ids)]
        right = [r for r in mine if zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"]]
        cover = np.zeros(len(ids), int)
        for r in right:
            cover[r["start"]:r["start"] + r["length"]] += 1
        assert (cover >= n).all(), doc
    pad = 0
    for s in seqs.values():
        end = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == end and r["length"] > 0
            end += r["length"]
        assert end <= 2048
        pad += 0 if end & (end - 1) == 0 else 2048 - end
    total = sum(r["length"] for r in rows)
    assert total / (total + pad) >= least_fill
    return pad / (total + pad)


def test_packing_the_table(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(5)
    rows = packing.pack(docs, tokenizer).collect()
    assert check_packing(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], tokenizer, 0.99) < 0.01


def test_packing_edge_cases(spark, tokenizer):
    rng = random.Random(4)
    word = "alpha beta gamma delta omega river stone".split()
    texts = [(1, None), (2, ""), (None, "null id"), (None, "null id"), (3, " \t\n\x0b\x0c\r\x1c\x85  x"),
             (4, " ".join(rng.choices(word, k=9000))), (5, "x" * 5000), (6, "It's <|endoftext|> I'LL é İ \U0001f600")]
    texts += [(i, " ".join(rng.choices(word, k=1100))) for i in range(10, 70)]       # a hot length that fits badly
    texts += [(7, "same text twice")] * 2
    schema = "doc_id long, text string, size int, rank string, task int, ids string"
    df = spark.createDataFrame([(*t, 1, "r", 2, "z") for t in texts], schema).repartition(3)
    rows = packing.pack(df, tokenizer).collect()
    check_packing(rows, texts, tokenizer, 0.98)
    assert packing.pack(df.limit(0), tokenizer).collect() == []
    one = packing.pack(df.filter("doc_id = 2"), tokenizer).collect()
    assert [(r["length"], r["offset"], r["doc_tokens"]) for r in one] == [(1, 0, 1)]


def test_plan_holds_the_demand():
    sizes, demand = np.array([600, 700, 720, 1400]), np.array([50, 300, 200, 40])
    columns = packing._start(sizes, demand, 2048)
    first = np.linalg.inv(columns) @ demand
    assert (first >= -1e-9).all()
    got = packing.solve(sizes, demand, 2048)
    # by hand: 1400 goes with 600 (40 sequences), 10 x 600 and 500 x 700 or 720 in pairs (255)
    assert sum(x for _, x in got) <= first.sum() + 1e-9
    assert 255 <= sum(x for _, x in got) <= 295 + 1e-6
    total = sum(c * x for c, x in got)
    assert np.allclose(total, demand) and all((c * sizes).sum() <= 2048 for c, _ in got)


# spelling variants ----------------------------------------------------------------
def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(texts):
    counts = Counter()
    for doc, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    shorter = defaultdict(set)                 # near words share a text of one deletion at most
    for w in n:
        for x in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            shorter[x].add(w)
    out, form = {}, {}
    for w in n:
        close = [u for u in set().union(*(shorter[x] for x in {w} | {w[:i] + w[i + 1:] for i in range(len(w))})) if near(w, u)]
        best = min(close, key=lambda u: (-n[u], u), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
        out[w] = len(close)
    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {(w, form[w], root(w), n[w], out[w], n.get(form[w])) for w in n}


def spelled(df):
    rows = spelling_variants.variants(df, rule=spelling_variants.drop_by_crc(199)).collect()
    assert len(rows) == len({r["word"] for r in rows})
    return {tuple(r) for r in rows}


def test_variants_of_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").repartition(6)
    want = plain_variants([tuple(r) for r in docs.collect()])
    assert any(w[1] for w in want) and spelled(docs) == want


def test_variants_edge_cases(spark):
    rng = random.Random(6)
    base = ["running", "résumés", "aaaaaaa", "Àbcdef×", "letter"]
    words = []
    for w in base:
        words += [w] * 200
        for _ in range(30):
            i = rng.randrange(len(w))
            v = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("abé") + w[i:], w[:i] + "x" + w[i + 1:]])
            words += [v] * rng.randint(4, 45)
            words += [v[:1] + v] * rng.randint(1, 8)
    rng.shuffle(words)
    texts = [(i % 40, rng.choice([" ", "-", "1", "\n"]).join(words[i::60]).upper() if i % 3 else " ".join(words[i::60]))
             for i in range(60)]
    texts += [(None, " ".join(words[:300])), (None, None), (7, ""), (8, "café Ābcdefgh \U0001f600"), texts[0]]
    df = spark.createDataFrame([(*t, 1, "p") for t in texts], "doc_id long, text string, n int, word string")
    want = plain_variants(texts)
    assert len({w[2] for w in want}) < len(want) and spelled(df) == want
    assert spelled(df.limit(0)) == set()


def test_groups_stay_within_the_alphabet(spark):
    words = spark.createDataFrame([(w, 5) for w in ("aabbcc", "aabbc", "xabbcc")], "word string, n long")
    r = spelling_variants.rotations(words)
    assert r.count() == sum(2 * len(w) + 1 for w in ("aabbcc", "aabbc", "xabbcc"))
    assert r.groupBy("prefix").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] == 2


# folds and letters of the two classifiers ------------------------------------------
def test_null_ids_and_symbols_in_the_classifiers(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(None, "a plain text without an id", "en"), (10 ** 9, "\U0001f600\U0001f680 12 !", "en"),
                                 (10 ** 9 + 1, "\U00010400\U00010401", "en")], "doc_id long, text string, lang string")
    got = language_id.identify(docs.union(odd))
    assert got.filter("held_out IS NULL").count() == 0
    und = {r["doc_id"] for r in got.filter("lang_pred = 'und' AND doc_id >= 1000000000").collect()}
    assert und == {10 ** 9}                                     # U+10400 is a letter, an emoji is none
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = quality_classifier.score(docs.union(odd), labels)
    assert scored.filter("held_out IS NULL").count() == 0 and scored.filter("doc_id IS NULL AND NOT held_out").count() == 1
