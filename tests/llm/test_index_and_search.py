"""Exact dedup, hard negatives and ranked search against brute force, hard cases included."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tradewell.llm import exact_dedup, hard_negatives, lexical_search

LONG = "ab " * 100_000
TEXTS = [None, "", " ", "\t\n", "a b", "a  b", "a b", "A b", "a b ", "x" * 5000, LONG, LONG + " ", "é", "é"]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---- exact dedup

def copies():
    rng = random.Random(5)
    rows = [(i, rng.choice(TEXTS)) for i in range(150)] + [(1000 + i, "hot  text") for i in range(400)]
    rows += [(3, "twice"), (3, "twice"), (None, "no id"), (None, "no id"), (7, "hot text"), (2000, "alone"), (None, "hot text"), (None, None)]
    rng.shuffle(rows)
    return rows


def groups(rows):
    out = {}
    for d, t in rows:
        out.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(d)
    return out


@pytest.mark.parametrize("options", [{}, {"capacity": 2, "bits": 6}, {"capacity": 1, "bits": 3, "words": 1},
                                     {"key": lambda c: F.pmod(F.xxhash64(c), F.lit(3))}])
def test_exact_dedup(spark, options):
    rows = copies()
    docs = spark.createDataFrame([(d, t, 1, "clash", i) for i, (d, t) in enumerate(rows)],
                                 "doc_id bigint, text string, h int, first string, at int").repartition(5)
    found = exact_dedup.digest(docs, **options).collect()
    assert len(found) == len(rows)
    by_text = groups(rows)
    want = sorted(((d, min((i for i in ids if i is not None), default=None), len(ids), hashlib.sha256(t.encode()).hexdigest())
                   for t, ids in by_text.items() for d in ids), key=repr)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=repr) == want
    kept = [r for r in found if r.kept]
    assert len(kept) == len({r.text_sha256 for r in kept}) == len(by_text) and all(r.doc_id == r.keep_id for r in kept)
    left = exact_dedup.keep(docs, **options)
    assert left.columns == docs.columns and set(groups([(r.doc_id, r.text) for r in left.collect()])) == set(by_text)


def test_exact_dedup_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert exact_dedup.digest(docs).collect() == [] and exact_dedup.keep(docs).collect() == []


def test_colliding_texts_are_links_of_one_chain(spark):
    docs = spark.createDataFrame([(i, f"t{i % 4}") for i in range(20)], "doc_id bigint, text string")
    links = exact_dedup.Index(docs, key=lambda c: F.lit(9)).links.collect()
    assert sorted((r.link, r.text, r.group_size, r["first"].doc_id) for r in links) == [(i + 1, f"t{i}", 5, i) for i in range(4)]


def test_directory_doubles_until_buckets_fit(spark):
    rng = random.Random(1)
    values = [rng.getrandbits(61) for _ in range(500)] + [(7 << 61) - (1 << 64) + rng.getrandbits(40) for _ in range(50)]  # the last share 21 bits
    keys = spark.createDataFrame([(v, 1) for v in values], "h bigint, n bigint")
    cells = exact_dedup.directory(keys, capacity=40, bits=10).collect()
    held = Counter()
    for v in values:
        cell = (v % (1 << 64)) >> 54
        held[next(r.bucket for r in cells if r.cell == cell)] += 1
    depth = {r.bucket: r.depth for r in cells}
    assert all(n <= 40 or depth[b] == 10 for b, n in held.items()) and len(set(depth.values())) > 1
    for b, d in depth.items():  # one bit less would have been too full
        if d:
            prefix = b >> (11 - d)
            assert sum(((v % (1 << 64)) >> (65 - d)) == prefix for v in values) > 40


# ---- hard negatives

def brute_negatives(rows, positives=5, negatives=10):
    rows = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, [math.floor(256 * float(x)) for x in v]) for i, lab, v in rows
            if None not in (i, lab, v) and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, lab, v in rows:
        if i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m == lab) for j, m, w in rows if j != i and len(w) == len(v))
        for neg, p, _ in [s for s in scored if s[2]][:positives]:
            fit = [s for s in scored if not s[2] and 30 * -neg <= 100 * -s[0] <= 90 * -neg][:negatives]
            out += [(i, p, r + 1, s[1], -neg, -s[0]) for r, s in enumerate(fit)]
    return sorted(out)


def vectors(n, dim, seed, scale=0.2, labels=4):
    rng = random.Random(seed)
    rows = [(i, rng.randrange(labels), [rng.gauss(0.1, scale) for _ in range(dim)]) for i in range(n)]
    for i in range(0, n, 9):  # equal vectors, so equal scores
        rows[i] = (rows[i][0], rows[i][1], rows[n // 2][2])
    return rows


def mined(spark, rows, kind="double"):
    df = spark.createDataFrame([(*r, "clash", 0) for r in rows], f"vec_id bigint, label int, embedding array<{kind}>, rank string, dim int")
    return sorted(map(tuple, hard_negatives.digest(df.repartition(3)).collect()))


@pytest.mark.parametrize("tile, leaf, fanout", [(4096, 256, 16), (64, 8, 2), (40, 3, 3)])
def test_hard_negatives(spark, monkeypatch, tile, leaf, fanout):
    for name, value in (("TILE_ROWS", tile), ("LEAF_ROWS", leaf), ("FANOUT", fanout), ("ANCHOR_BYTES", 200)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = vectors(700, 6, 2)
    rows += [(701, 1, None), (702, None, [1.0] * 6), (None, 1, [1.0] * 6), (703, 1, [float("nan")] * 6), (704, 1, [float("inf")] * 6),
             (705, 1, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (800, 1, [1.0]), (801, 1, [2.0]), (802, 2, [1.0]), (900, 3, []), (901, 3, []), (902, 1, [])]
    rows += [(11, 1, rows[11][2])] * 2  # repeated rows
    assert mined(spark, rows) == brute_negatives(rows) != []


def test_hard_negatives_beyond_doubles(spark):
    rows = [(i, lab, [x * 2.0 ** 22 for x in v]) for i, lab, v in vectors(220, 3, 4)]
    assert mined(spark, rows) == brute_negatives(rows) != []


def test_hard_negatives_of_nothing(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, 1, [1.0])]) == [] and mined(spark, [(100, 1, [1.0])]) == []


def test_a_box_bounds_its_scores():
    import numpy as np

    rng = np.random.default_rng(3)
    v = rng.integers(-300, 300, (500, 5))
    tree = hard_negatives.Tree(hard_negatives.pack_tile(np.arange(500), rng.integers(0, 3, 500), v))
    anchors = rng.integers(-300, 300, (7, 5))
    scores = tree.vectors @ anchors.T
    for depth, (low, high) in enumerate(tree.intervals(anchors)):
        rows = hard_negatives.LEAF_ROWS * hard_negatives.FANOUT ** depth
        for node in range(len(tree.levels[depth].least)):
            part = scores[node * rows:(node + 1) * rows]
            assert all(low[i][node] <= part[:, i].min() and part[:, i].max() <= high[i][node] for i in range(7))


# ---- ranked search

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text):
    return re.findall(TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_rank(docs, items, k):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, n_terms = len(counts), sum(c.total() for _, c in counts)
    out = []
    for item, text in items:
        found = []
        for d, c in counts:
            m = 75 + (25 * c.total() * n_docs) // n_terms
            score = 0
            for t in terms(text):
                if t in c:
                    df = sum(t in x for _, x in counts)
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                found.append((-score, d is None, d or 0))
        out += [(item, r + 1, None if f[1] else f[2], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("settings", [{}, {"BLOCK_ITEMS": 2, "BATCH_BYTES": 300, "LEAST_PLACES": 1, "MOST_PLACES": 4, "BOUNDS_AT_ONCE": 64, "PIECE": 50}])
def test_ranked_search(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(lexical_search, name, value)
    rng = random.Random(8)
    words = ["".join(rng.choice("abcÀé1Z") for _ in range(rng.randint(1, 4))) for _ in range(120)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(150)]
    docs += [(500 + i, docs[5][1]) for i in range(6)] + [(7, docs[5][1]), (None, docs[5][1]), (600, None), (601, ""), (602, "-- \n"), (603, "a,B-c\x7fd" * 200)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 30)))) for i in range(5)] + [(3, "a a b"), (3, "a a b"), (None, docs[5][1]), (9, None), (10, "?"),
                                                                                       (11, "nowhere")]
    found = lexical_search.rank(spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id bigint, text string, item int, score string").repartition(4),
                                spark.createDataFrame(items, "item_id bigint, text string"), k=8)
    assert rows_of(found) == brute_rank(docs, items, 8)


def test_ranked_search_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    item, no_item = (spark.createDataFrame(r, "item_id bigint, text string") for r in ([(1, "a")], []))
    doc = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    assert [lexical_search.rank(d, i).count() for d, i in ((none, item), (doc, no_item), (doc, item))] == [0, 0, 1]


def test_sketch_bounds_every_score():
    rng = random.Random(4)
    words = [f"w{i}".encode() for i in range(300)]
    docs = [lexical_search.Document(i, Counter(rng.choices(words, k=200)), 90 + i, 64) for i in range(20)]
    items = lexical_search.Items(list(range(9)), [Counter(rng.choices(words, k=25)) for _ in range(9)])
    search = lexical_search.Search(items, lexical_search.Statistics(20, 4000, {w: rng.randint(1, 9000) for w in words}))
    scores = [[search.score(q, d.counts, d.length) for q in range(9)] for d in docs]
    loose, tight = (search.bounds(lexical_search.sketches(docs, places)) for places in (64, 1 << 16))
    assert (loose >= scores).all() and (tight >= scores).all() and tight.mean() < loose.mean()
    assert tight.mean() < 1.01 * sum(map(sum, scores)) / 180
