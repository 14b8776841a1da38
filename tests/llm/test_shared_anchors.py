import random

import numpy as np
import pyarrow as pa

from tradewell.llm import suffix_dedup


def anchor_rows(values, owners, docs, buckets=1):
    return suffix_dedup._anchor_rows(np.arange(docs), np.arange(docs) * 7 - 3, np.array(owners), np.array(values, np.uint64), 50, buckets, 64)


def test_shared_anchors_are_packed_by_home():
    """Rows of a bucket do not grow with its documents; all anchors that two documents have come back, by document."""
    rng = np.random.default_rng(4)
    owners, values = rng.integers(0, 2000, 40_000), rng.integers(0, 15_000, 40_000)
    both = pa.Table.from_batches([anchor_rows(values, owners, 2000), anchor_rows(values[:500], owners[:500] // 2, 2000)])
    packed = suffix_dedup._shared_anchors(3)(both)
    assert packed.num_rows <= 3 * (1 + 2)  # 3 homes: what the bucket found, and what each sender knew
    found = {}
    for home in range(3):
        of_home = packed.filter(pa.compute.equal(packed.column("home"), home))
        told = suffix_dedup._asked(of_home)
        keys = list(zip(told.column("doc_id").to_pylist(), told.column("text_hash").to_pylist()))
        assert len(set(keys)) == len(keys) and not set(keys) & set(found)
        found |= {k: set(np.frombuffer(a, np.uint32).tolist()) for k, a in zip(keys, told.column("anchors").to_pylist())}
    holders = {}
    for v, o in [*zip(values.tolist(), owners.tolist()), *zip(values[:500].tolist(), (owners[:500] // 2).tolist())]:
        holders.setdefault(v, set()).add(o)
    for v, docs in holders.items():
        if len(docs) > 1:
            assert all(v in found[d, d * 7 - 3] for d in docs)


def test_buckets_of_anchors_are_even():
    """An anchor is the least of 27 hashes: ranges of equal width put two thirds of them into the first of 26."""
    rng = random.Random(2)
    texts = [rng.randbytes(2000) for _ in range(200)]
    value = suffix_dedup.all_stretches(texts, 50)[3]
    load = np.bincount(suffix_dedup.bucket_of(value, 26, 50), minlength=26)
    assert len(load) == 26 and load.max() < 3 * load.mean()
    order = np.sort(value)
    assert (np.diff(suffix_dedup.bucket_of(order, 26, 50)) >= 0).all()


def test_a_stretch_alone_with_its_anchor_needs_no_transform(monkeypatch):
    seen = []
    inner = suffix_dedup.smallest_ids
    monkeypatch.setattr(suffix_dedup, "smallest_ids", lambda parts, *rest: seen.extend(parts) or inner(parts, *rest))
    rng = random.Random(6)
    same = [rng.randbytes(50) for _ in range(40)]
    parts = same + same
    doc = np.repeat([3, 9], 40)
    owner, begin, end = suffix_dedup._removed(parts, doc, np.repeat([0, 1], 40), np.tile(np.arange(40) * 50, 2), 50)
    assert not seen and (owner == 1).all() and sorted(begin.tolist()) == [k * 50 for k in range(40)] and (end - begin == 50).all()
