"""What near duplicates hold in a Python worker, and how many workers a task needs."""

import tracemalloc

import numpy as np

from tradewell.llm import jaccard


def test_sets_of_many_texts_need_little_besides_themselves():
    rng = np.random.default_rng(1)
    texts = [b" ".join(b"w%d" % x for x in rng.integers(0, 1 << 30, 400)) for _ in range(3000)]
    assert sum(map(len, texts)) > 12 << 20
    jaccard.shingle_sets(texts[:1], 5)  # tables of powers are kept
    tracemalloc.start()
    sets = jaccard.shingle_sets(texts, 5)
    kept, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most - kept < 32 << 20
    alone = [jaccard.shingle_sets([t], 5)[0] for t in (texts[0], texts[1500], texts[-1])]
    assert all((a == b).all() for a, b in zip(alone, (sets[0], sets[1500], sets[-1])))


def test_sets_of_nothing_and_of_long_texts():
    long = b"a b c d e f " * (jaccard.PIECE // 8)
    sets = jaccard.shingle_sets([b"", long, b"", b"x y"], 5)
    assert [len(s) for s in sets] == [0, 6, 0, 1] and jaccard.shingle_sets([], 5) == []


def test_a_task_of_pivots_needs_one_worker(spark):
    """Two Python steps in one stage keep two workers a task, which share the executor's memory."""
    words = [" ".join(f"w{(k % 5) * 40 + i}" for i in range(40)) for k in range(30)]
    plain = spark.createDataFrame(list(enumerate(words)), "doc_id bigint, text string")
    sent = spark.sparkContext.broadcast(np.ones(1 << 16, np.uint32))
    postings = jaccard.map_batches(plain, jaccard._send_prefixes(5, (4, 5), sent, 3), jaccard.POSTINGS)
    pairs = jaccard.pivot_pairs(postings, sent, (4, 5))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    stage_of_groups = plan[:plan.index("FlatMapGroupsInArrow")].rsplit("Exchange", 1)[-1]
    assert "MapInArrow" not in stage_of_groups.replace("FlatMapGroupsInArrow", "")
    assert all(r.pivot <= r.doc_id and r.n == 36 for r in pairs.collect())


def test_pivots_of_common_shingles(spark, monkeypatch):
    """Documents of a common shingle get one pivot over all buckets, the smallest document."""
    texts = [(k, " ".join(["same"] * 5 + [f"u{k}_{i}" for i in range(12)])) for k in range(40, 0, -1)]
    plain = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    counts = np.zeros(1 << 16, np.uint32)
    first = jaccard.shingle_sets([b"same same same same same"], 5)[0]
    counts[jaccard._counter(first, len(counts))] = 40
    monkeypatch.setattr(jaccard, "COMMON", 10)

    class Sent:
        value = counts

    # All shingles count, so that the common one is in every prefix.
    monkeypatch.setattr(jaccard, "prefix", lambda s, *_: s)
    batch = next(iter(plain.toArrow().combine_chunks().to_batches()))
    rows = jaccard._send_prefixes(5, (4, 5), Sent, 3)(batch)
    postings = spark.createDataFrame([tuple(r.values()) for r in rows.to_pylist()], jaccard.POSTINGS)
    sent = spark.sparkContext.broadcast(counts)
    monkeypatch.setattr(jaccard, "_pivots", _pivots_with(jaccard._pivots, 10))
    found = jaccard.pivot_pairs(postings, sent, (4, 5)).collect()
    assert {(r.pivot, r.doc_id) for r in found} == {(1, k) for k in range(1, 41)}


def _pivots_with(pivots, common):
    def made(sent, threshold):
        run = pivots(sent, threshold)

        def work(table):
            jaccard.COMMON = common  # the worker has its own module
            return run(table)
        return work
    return made
