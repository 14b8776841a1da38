"""N-gram Jaccard join by T-occurrence search.

Two documents link when the Jaccard similarity of their word-shingle sets reaches a threshold, that is
when one occurs in at least T of the inverted lists of the other's shingles. The search is DivideSkip:
the few longest lists are put aside, a heap merges the short ones and skips ids that cannot reach T
less the number of lists put aside, and what it finds is probed in the long lists by binary search.

How the documents that must be compared meet:

1. Documents with equal sets are one (their smallest doc_id stands for them).
2. Shingles get an order, rare ones first, from a sketch of counts of bounded size. Two linked sets
   share one of their first n - ceil(t n) + 1 shingles (the prefix), in any order; a rare-first order
   keeps shingles of common passages out of it.
3. Prefix shingles are sent by hash, packed in arrays. All that share one, and have sets of compatible
   sizes, get the smallest doc_id among them as pivot; shingles that the sketch finds in very many documents are dealt over several tasks
   and their pivots are agreed on afterwards.
4. The sets of a pivot are a block. Blocks are searched in tasks of bounded size: from each document
   not yet reached, all linked ones are found, then those linked with these, so an all-alike block
   takes one search. A block beyond the bound is cut: each part is searched together with the pivot;
   only documents not connected with the pivot are then searched against all other parts.
5. Links found are stars; connected components give the smallest doc_id reachable.

Defined cases: null or wordless texts have an empty set and link with nothing; with fewer words than a
shingle the whole sequence is the one shingle; rows with equal doc_id are one document, so linked;
rows with a null doc_id take no part and get a null component; other columns are ignored by
``components`` and passed on by ``keep_first``.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewell.llm import graph
from tradewell.llm.common import ASCII_LOWER, buffer_of, map_batches, mix64, record_batch, release_memory, text_bytes, utf8
from tradewell.session import materialise

SKETCH_BYTES = 256  # corpus text for each counter of the shingle-count sketch
SKETCH_BITS = (16, 25)  # least and most counters, as powers of two: the sketch stays under 128 MB
SLICES = 16
BUCKET_BYTES = 64 << 20  # corpus text for each bucket of prefix shingles
COMMON = 100_000  # occurrences by the sketch for each task that deals with one shingle
BLOCK_SHINGLES = 1_500_000  # shingles searched in one task
PIECE = 1 << 20

Threshold = tuple[int, int]  # numerator and denominator

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE, _INVERSE = 0x5851F42D4C957F2D, pow(0x5851F42D4C957F2D, -1, 1 << 64)


# ---- shingle sets

def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_power_cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(PIECE + (1 << 16), 1 << (n - 1).bit_length() if n > PIECE + (1 << 16) else 0)
    if size not in _power_cache:
        _power_cache.clear()
        _power_cache[size] = _powers(_BASE, size), _powers(_INVERSE, size)
    return _power_cache[size]


def _hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Owner and 64-bit hash of every word of some texts."""
    buf, starts = buffer_of([t + b" " for t in texts])
    space = _SPACE[buf]
    first = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    end = np.flatnonzero(space & np.concatenate(([False], ~space[:-1])))
    power, inverse = _power_tables(len(buf))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * power[:len(buf)], dtype=np.uint64)))
    return np.searchsorted(starts, first, "right") - 1, mix64((total[end] - total[first]) * inverse[first])


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Owner and hash of every word, ASCII lower-cased; long texts in pieces cut at white space."""
    owners, hashes, group, ids, total = [], [], [], [], 0

    def flush():
        owner, h = _hashed(group)
        owners.append(np.array(ids, np.int64)[owner])
        hashes.append(h)

    for i, text in enumerate(texts):
        text, at = text.translate(ASCII_LOWER), 0
        while at < len(text):
            end = at + PIECE
            while end < len(text) and not _SPACE[text[end]]:
                end += 1
            group.append(text[at:end])
            ids.append(i)
            total += len(group[-1])
            at = end
            if total >= PIECE:
                flush()
                group, ids, total = [], [], 0
    if group:
        flush()
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(owners), np.concatenate(hashes)


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """The ascending distinct shingle hashes of each text; what is held besides them is bounded by PIECE or the longest text."""
    out, at, total = [], 0, 0
    for k, text in enumerate(texts):
        total += len(text)
        if total >= PIECE or k + 1 == len(texts):
            out += _sets_of(texts[at:k + 1], words)
            at, total = k + 1, 0
    return out


def _sets_of(texts: list[bytes], words: int) -> list[np.ndarray]:
    owner, h = word_hashes(texts)
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    factors = mix64(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    total = np.zeros(max(len(h) - words + 1, 0), np.uint64)
    for k in range(words):
        total += h[k:k + len(total)] * factors[k]
    full = mix64(total)
    out = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(full[a:b - words + 1]))
        elif b > a:
            short = (h[a:b] * factors[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix64(np.array([short], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def prefix(shingles: np.ndarray, counts: np.ndarray, threshold: Threshold) -> np.ndarray:
    """The rarest shingles, as many that a linked set must share one."""
    n, (t, of) = len(shingles), threshold
    rare_first = np.lexsort((shingles, counts[_counter(shingles, len(counts))]))
    return shingles[rare_first[:n - -(-t * n // of) + 1]] if n else shingles


def _counter(shingles: np.ndarray, counters: int) -> np.ndarray:
    """The counter of each shingle; ``counters`` is a power of two."""
    return (shingles & np.uint64(counters - 1)).astype(np.int64)


def sketch_size(corpus_bytes: int) -> int:
    low, high = SKETCH_BITS
    return 1 << min(high, max(low, (corpus_bytes // SKETCH_BYTES).bit_length()))


# ---- T-occurrence search

def occurring(lists: list[list[int]], least: int) -> Iterator[tuple[int, int]]:
    """Ids that occur in at least ``least`` of the ascending lists, with the count: a heap with skips."""
    heap = [(ids[0], k, 0) for k, ids in enumerate(lists)]
    heapq.heapify(heap)
    while len(heap) >= least:
        top, popped = heap[0][0], []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap))
        if len(popped) >= least:
            yield top, len(popped)
            target = top + 1
        else:
            while heap and len(popped) < least - 1:
                popped.append(heapq.heappop(heap))
            if not heap:
                return
            target = heap[0][0]
        for _, k, at in popped:
            at = bisect_left(lists[k], target, at)
            if at < len(lists[k]):
                heapq.heappush(heap, (lists[k][at], k, at))


def divide_skip(lists: list[list[int]], least: int) -> Iterator[tuple[int, int]]:
    """Ids in at least ``least`` lists: long lists are only probed for what the short ones leave possible."""
    lists = sorted(filter(None, lists), key=len)
    if len(lists) < least:
        return
    longest = len(lists[-1])
    apart = min(least - 1, int(least / (0.0085 * np.log2(longest) + 1)) if longest > 2 else 0)
    short, long = lists[:len(lists) - apart], lists[len(lists) - apart:]
    for found, count in occurring(short, least - apart):
        for ids in long:
            at = bisect_left(ids, found)
            count += at < len(ids) and ids[at] == found
        if count >= least:
            yield found, count


class Block:
    """Sets that are searched together; ids are places in the order of set size."""

    def __init__(self, sets: list[np.ndarray], threshold: Threshold):
        self.sets, (self.t, self.of) = sets, threshold
        self.sizes = [len(s) for s in sets]
        _, inverse = np.unique(np.concatenate(sets), return_inverse=True)
        self.tokens = np.split(inverse, np.cumsum(self.sizes)[:-1])
        self.index(range(len(sets)))

    def index(self, members) -> None:
        """Inverted lists of the members, ascending."""
        self.lists: dict[int, list[int]] = defaultdict(list)
        for k in members:
            for token in self.tokens[k].tolist():
                self.lists[token].append(k)
        self.indexed = len(members)

    def overlap(self, a: int, b: int) -> int:
        """Least common shingles of two linked sets of these sizes."""
        return -(-self.t * (a + b) // (self.t + self.of))

    def linked(self, k: int, waiting: list[bool]) -> list[int]:
        """The waiting members that link with one set."""
        n = self.sizes[k]
        low = bisect_left(self.sizes, -(-self.t * n // self.of))
        high = bisect_left(self.sizes, self.of * n // self.t + 1)
        lists = []
        for token in self.tokens[k].tolist():
            ids = self.lists.get(token)
            if ids:
                cut = ids[bisect_left(ids, low):bisect_left(ids, high)]
                if len(cut) > 1 or cut and cut[0] != k:
                    lists.append(cut)
        if low >= high or not lists:
            return []
        least = self.overlap(n, self.sizes[low])
        return [d for d, c in divide_skip(lists, least) if waiting[d] and c >= self.overlap(n, self.sizes[d])]

    def roots(self) -> list[int]:
        """For each member the first member of its component."""
        root = list(range(len(self.sets)))
        waiting = [True] * len(self.sets)
        left = len(self.sets)
        for start in range(len(self.sets)):
            if not waiting[start]:
                continue
            waiting[start] = False
            left -= 1
            queue = [start]
            while queue and left:
                for d in self.linked(queue.pop(), waiting):
                    waiting[d] = False
                    left -= 1
                    root[d] = start
                    queue.append(d)
                if left < self.indexed // 2:  # those already reached only lengthen the lists
                    self.index([k for k, w in enumerate(waiting) if w])
        return root


# ---- the stages

FEATURES = "kind int, doc_id bigint, n bigint, signature binary, slice int, counts binary"


def _features(words: int, counters: int):
    """kind 0: a document's set size and signature; kind 1: counts of a task's shingles, in slices, at most 255 each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(counters, np.uint32)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = shingle_sets(utf8(part.column("text")), words)
                np.add.at(counts, _counter(np.concatenate(sets), counters), np.uint32(1))
                none = [None] * len(sets)
                yield record_batch(kind=pa.array([0] * len(sets), pa.int32()), doc_id=part.column("doc_id"),
                                   n=[len(s) for s in sets], slice=pa.array(none, pa.int32()), counts=pa.array(none, pa.binary()),
                                   signature=[blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                                   ).select([c.split()[0] for c in FEATURES.split(", ")])
            del batch, part, sets
            release_memory()
        if counts.any():
            parts = np.minimum(counts, 255).astype(np.uint8).reshape(SLICES, -1)
            none = [None] * SLICES
            yield record_batch(kind=pa.array([1] * SLICES, pa.int32()), doc_id=pa.array(none, pa.int64()), n=pa.array(none, pa.int64()),
                               signature=pa.array(none, pa.binary()), slice=pa.array(range(SLICES), pa.int32()),
                               counts=[zlib.compress(p.tobytes(), 1) for p in parts])
    return run


def _sketch(features: DataFrame, counters: int) -> np.ndarray:
    """Counts of all tasks added up: SLICES rows of bounded size reach the driver."""
    def adding(kind: type):
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for k, data in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist()):
                    sums[k] = sums.get(k, 0) + np.frombuffer(zlib.decompress(data), kind).astype(np.uint32)
            if sums:
                yield record_batch(slice=pa.array(list(sums), pa.int32()), counts=[zlib.compress(s.tobytes(), 1) for s in sums.values()])
        return add

    columns = "slice int, counts binary"
    part = features.where("kind = 1").select("slice", "counts").mapInArrow(adding(np.uint8), columns)
    whole = part.repartition(SLICES, "slice").mapInArrow(adding(np.uint32), columns)
    counts = np.zeros((SLICES, counters // SLICES), np.uint32)
    for row in whole.toLocalIterator():
        counts[row["slice"]] = np.frombuffer(zlib.decompress(row["counts"]), np.uint32)
    return counts.ravel()


POSTINGS = "bucket bigint, docs binary, sizes binary, shingles binary, owners binary"


def _send_prefixes(words: int, threshold: Threshold, sent, buckets: int):
    """Prefix shingles of the documents by bucket; a common shingle has a bucket for each share of the documents."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = sent.value
        sets = shingle_sets(utf8(batch.column("text")), words)
        docs = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        # Of equal sets the smallest doc_id: the one that stands for all of them is the smallest wherever it is.
        first: dict[bytes, int] = {}
        for k in np.argsort(docs, kind="stable").tolist():
            if len(sets[k]):
                first.setdefault(sets[k].tobytes(), k)
        chosen_docs = sorted(first.values())
        sets, docs = [sets[k] for k in chosen_docs], docs[chosen_docs]
        if not sets:
            return None
        chosen = [prefix(s, counts, threshold) for s in sets]
        sizes = np.array([len(s) for s in sets], np.int64)
        value = np.concatenate(chosen)
        owner = np.repeat(np.arange(len(chosen)), [len(c) for c in chosen])
        shares = 1 + counts[_counter(value, len(counts))] // COMMON
        share = (mix64(docs.astype(np.uint64))[owner] % shares.astype(np.uint64))
        bucket = ((value ^ mix64(share)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((value, bucket))
        bucket, value, owner = bucket[order], value[order], owner[order]
        cuts = np.searchsorted(bucket, np.unique(bucket)).tolist() + [len(bucket)]
        rows = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            used, numbers = np.unique(owner[a:b], return_inverse=True)
            rows.append((int(bucket[a]), docs[used].tobytes(), sizes[used].tobytes(), value[a:b].tobytes(),
                         numbers.astype(np.int32).tobytes()))
        columns = list(zip(*rows)) or [[]] * 5
        return record_batch(**{n.split()[0]: pa.array(c, pa.int64() if k == 0 else pa.binary())
                               for k, (n, c) in enumerate(zip(POSTINGS.split(", "), columns))})
    return work


PIVOTS = "shingle bigint, pivot bigint, doc_id bigint, n bigint"
ROWS_SENT = 1 << 16  # in one Arrow batch


def _pivots(sent, threshold: Threshold):
    """Documents that share a shingle of a bucket, under the smallest of them; ``shingle`` is set where other buckets share it.

    In the order of set size, where one set is too small for the next no pair across the gap can link:
    there the documents of a shingle fall into groups of their own.
    """
    t, of = threshold

    def work(table: pa.Table) -> pa.Table:
        docs, sizes, value = [], [], []
        for row in table.to_pylist():
            owner = np.frombuffer(row["owners"], np.int32)
            docs.append(np.frombuffer(row["docs"], np.int64)[owner])
            sizes.append(np.frombuffer(row["sizes"], np.int64)[owner])
            value.append(np.frombuffer(row["shingles"], np.uint64))
        docs, sizes, value = map(np.concatenate, (docs, sizes, value))
        order = np.lexsort((sizes, value))
        docs, sizes, value = docs[order], sizes[order], value[order]
        common = sent.value[_counter(value, len(sent.value))] >= COMMON
        gap = (of * sizes[:-1] < t * sizes[1:]) & ~common[1:]  # a common shingle's other documents are not here
        run = np.concatenate(([0], np.flatnonzero((value[1:] != value[:-1]) | gap) + 1, [len(value)]))
        length = np.diff(run)
        least = np.minimum.reduceat(docs, run[:-1])
        pivot = np.repeat(least, length)
        use = ~common & np.repeat(length > 1, length)
        # A common shingle's documents all go on, lone ones too: other buckets have more of them.
        columns = [np.concatenate((x[common], y)) for x, y in zip((pivot, docs, sizes), _distinct(pivot[use], docs[use], sizes[use]))]
        shingle = np.zeros(len(columns[0]), np.int64)
        shingle[:common.sum()] = value[common].astype(np.int64)
        lone = np.arange(len(shingle)) >= common.sum()
        del docs, sizes, value, order, common, run, pivot, use
        release_memory()
        out = pa.table([pa.array(shingle, mask=lone), *map(pa.array, columns)], [c.split()[0] for c in PIVOTS.split(", ")])
        return pa.Table.from_batches(out.to_batches(ROWS_SENT), out.schema)
    return work


def _distinct(pivot: np.ndarray, docs: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each pair of pivot and document once."""
    order = np.lexsort((docs, pivot))
    pivot, docs, sizes = pivot[order], docs[order], sizes[order]
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (pivot[1:] != pivot[:-1])
    return pivot[new], docs[new], sizes[new]


def pivot_pairs(postings: DataFrame, sent, threshold: Threshold) -> DataFrame:
    """pivot, doc_id, n: each document with the pivots whose blocks it is in."""
    found = postings.groupBy("bucket").applyInArrow(_pivots(sent, threshold), PIVOTS)
    if (sent.value >= COMMON).any():
        found = materialise(found, "pivots")
        shared = found.where("shingle IS NOT NULL")
        agreed = shared.groupBy("shingle").agg(F.min("pivot").alias("agreed"))
        shared = shared.join(agreed, "shingle").select(F.col("agreed").alias("pivot"), "doc_id", "n")
        found = found.where("shingle IS NULL").select("pivot", "doc_id", "n").union(shared)
    return found.groupBy("pivot", "doc_id").agg(F.max("n").alias("n"))


def _sets_for_tasks(words: int):
    """A row for each task that needs a document's set."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [s.tobytes() for s in shingle_sets(utf8(batch.column("text")), words)]
        rows = [(t["task"], t["pivot"], t["asks"], d, s) for d, ts, s in zip(
            batch.column("doc_id").to_pylist(), batch.column("tasks").to_pylist(), sets) for t in ts if s]
        columns = list(zip(*rows)) or [[]] * 5
        return record_batch(**{n: pa.array(c, t) for n, c, t in zip(
            ("task", "pivot", "asks", "doc_id", "shingles"), columns,
            (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary()))})
    return work


SETS = "task bigint, pivot bigint, asks boolean, doc_id bigint, shingles binary"
LINKS = "pivot bigint, a bigint, b bigint"


def _blocks(table: pa.Table) -> Iterator[tuple[int, list[int], list[bool], list[np.ndarray]]]:
    """The blocks of a task, sets by size."""
    by: dict[int, list] = defaultdict(list)
    columns = (table.column(n) for n in ("pivot", "asks", "doc_id", "shingles"))
    for pivot, asks, doc, data in zip(*(c.to_pylist() for c in columns)):
        by[pivot].append((len(data), doc, asks, np.frombuffer(data, np.uint64)))
    for pivot, rows in by.items():
        rows.sort(key=lambda r: r[:2])
        yield pivot, [r[1] for r in rows], [r[2] for r in rows], [r[3] for r in rows]


def _links(rows: list[tuple[int, int, int]]) -> pa.Table:
    columns = list(zip(*rows)) or [[]] * 3
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("pivot", "a", "b"), columns)})


def _search_blocks(threshold: Threshold):
    """Each document with the first one of its component in the block."""
    def work(table: pa.Table) -> pa.Table:
        rows = []
        for pivot, docs, _, sets in _blocks(table):
            if len(docs) > 1:
                rows += [(pivot, docs[k], docs[r]) for k, r in enumerate(Block(sets, threshold).roots()) if r != k]
        release_memory()
        return _links(rows)
    return work


def _search_rest(threshold: Threshold):
    """The links of asking documents with all others of a task."""
    def work(table: pa.Table) -> pa.Table:
        rows = []
        for pivot, docs, asks, sets in _blocks(table):
            block, everyone = Block(sets, threshold), [True] * len(docs)
            for k in np.flatnonzero(asks).tolist():
                rows += [(pivot, docs[k], docs[d]) for d in block.linked(k, everyone) if d != k]
        return _links(rows)
    return work


def links(plain: DataFrame, pairs: DataFrame, words: int, threshold: Threshold) -> DataFrame:
    """a, b: links that connect all linked documents of every block."""
    blocks = pairs.groupBy("pivot").agg(F.sum("n").alias("total"), F.count("*").alias("members")).where("members > 1")
    blocks = materialise(blocks.withColumn("parts", (1 + F.floor(F.col("total") / BLOCK_SHINGLES)).cast("bigint")), "blocks")
    total = blocks.agg(F.sum("total"), F.max("parts")).first()
    tasks = int(1 + (total[0] or 0) // BLOCK_SHINGLES)
    placed = pairs.join(blocks.select("pivot", "parts"), "pivot").withColumn("part", F.pmod(F.xxhash64("doc_id"), "parts"))

    def task(*keys) -> F.Column:
        return F.pmod(F.xxhash64("pivot", *keys), F.lit(tasks))

    def searched(asked: DataFrame, search) -> DataFrame:
        wanted = asked.groupBy("doc_id").agg(F.collect_set(F.struct("task", "pivot", "asks")).alias("tasks"))
        sets = map_batches(plain.join(wanted, "doc_id"), _sets_for_tasks(words), SETS, 4 << 20)
        return sets.groupBy("task").applyInArrow(search(threshold), LINKS)

    # A cut block's pivot goes to every part.
    everywhere = placed.where("parts > 1 AND doc_id = pivot").select(
        "pivot", "doc_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))
    first = placed.select("pivot", "doc_id", "part").union(everywhere).distinct()
    found = searched(first.select("doc_id", "pivot", task("part").alias("task"), F.lit(False).alias("asks")), _search_blocks)
    if (total[1] or 1) == 1:
        return found.select("a", "b")
    found = materialise(found, "links")
    return found.select("a", "b").union(_rest(placed, found, task, searched))


def _rest(placed: DataFrame, found: DataFrame, task, searched) -> DataFrame:
    """Links between the parts of cut blocks, for documents that no link of their part ties to the pivot.

    Those tied to it are one component over all parts already. A star's centre is the document of least
    size, so a document is tied if its centre is the pivot's, or is the pivot.
    """
    cut = materialise(placed.where("parts > 1"), "cut-blocks")
    star = found.select("pivot", F.col("a").alias("doc_id"), F.col("b").alias("centre"))
    known = cut.select("pivot", "doc_id", "part", "parts", "n").join(star, ["pivot", "doc_id"], "left")
    centre = F.coalesce("centre", "doc_id")
    pivots = star.where("doc_id = pivot").select("pivot", F.col("centre").alias("pivot_centre"))
    tied = known.join(pivots.distinct(), "pivot", "left").withColumn(
        "tied", (centre == F.col("pivot")) | F.coalesce(centre == F.col("pivot_centre"), F.lit(False)))
    loose = tied.groupBy("pivot", "doc_id", "parts", "n").agg(F.max("tied").alias("tied")).where("NOT tied AND doc_id <> pivot")
    loose = materialise(loose.drop("tied"), "loose")
    shares = loose.groupBy("pivot").agg((1 + F.floor(F.sum("n") / BLOCK_SHINGLES)).cast("bigint").alias("shares"))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shares") - 1)).alias("share")
    against = cut.join(shares, "pivot").select("pivot", "doc_id", "part", every, F.lit(False).alias("asks"))
    asking = loose.join(shares, "pivot").select(
        "pivot", "doc_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"),
        F.pmod(F.xxhash64("doc_id"), "shares").alias("share"), F.lit(True).alias("asks"))
    both = against.unionByName(asking).groupBy("pivot", "doc_id", "part", "share").agg(F.max("asks").alias("asks"))
    return searched(both.select("doc_id", "pivot", task("part", "share").alias("task"), "asks"), _search_rest).select("a", "b")


def roots(docs: DataFrame, shingle_words: int, threshold: Threshold) -> DataFrame:
    """doc_id, n_shingles, component_id for every row with a doc_id."""
    spark = docs.sparkSession
    plain = docs.select(F.col("doc_id").cast("bigint"), "text").where("doc_id IS NOT NULL")
    size = text_bytes(docs)
    counters = sketch_size(size)
    features = materialise(plain.mapInArrow(_features(shingle_words, counters), FEATURES), "shingle-features")
    sent = spark.sparkContext.broadcast(_sketch(features, counters))
    sized = features.where("kind = 0").select("doc_id", "n", "signature")
    first = sized.where("n > 0").groupBy("signature").agg(F.min("doc_id").alias("first"))
    members = materialise(sized.join(first, "signature", "left"), "shingle-members")
    buckets = max(1, -(-size // BUCKET_BYTES))
    firsts = members.where("first IS NOT NULL").select(F.col("first").alias("doc_id")).distinct()
    postings = map_batches(plain, _send_prefixes(shingle_words, threshold, sent, buckets), POSTINGS, 16 << 20)
    pairs = materialise(pivot_pairs(postings, sent, threshold).join(firsts, "doc_id", "left_semi"), "pivot-pairs")
    found = links(plain, pairs, shingle_words, threshold)
    repeated = members.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id")
    same = members.join(repeated, "doc_id").where("first IS NOT NULL").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    tops = graph.components(found.union(same))
    return members.join(tops.withColumnRenamed("node", "first"), "first", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "first", "doc_id").alias("component_id"))


def components(docs: DataFrame, shingle_words: int = 5, threshold: Threshold = (4, 5)) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id."""
    none = docs.where("doc_id IS NULL").select(F.col("doc_id").cast("bigint"), F.lit(None).cast("bigint").alias("n_shingles"),
                                               F.lit(None).cast("bigint").alias("component_id"))
    return roots(docs, shingle_words, threshold).unionByName(none)


def keep_first(docs: DataFrame, shingle_words: int = 5, threshold: Threshold = (4, 5)) -> DataFrame:
    """One document of each component, with all its columns: the one of smallest doc_id. Rows without doc_id stay."""
    kept = roots(docs, shingle_words, threshold).where("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct()
    rows = docs.where("doc_id IS NOT NULL").join(kept, F.col("doc_id") == F.col("_kept")).drop("_kept")
    return rows.dropDuplicates(["doc_id"]).unionByName(docs.where("doc_id IS NULL"))
