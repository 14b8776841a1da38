"""Benchmark decontamination by Wu-Manber search for many patterns.

Patterns are the ten-word windows of the benchmark items (the whole item if it is shorter), written as
their words with single blanks between and around; documents are written the same way, so a match is a
match of words. All patterns of one kind are cut to their least length m. The shift table tells, for a
block of bytes at the end of an m-byte window, how far the window may move before a pattern could end
there; blocks in no pattern move it by the most. Where the shift is 0 the block is a suffix: its
bucket names the few patterns to compare directly. Windows of many stretches of text move in step.

The benchmark is a query set: it is read in blocks of a fixed number of bytes and each block is sent
to the executors, one pass over the texts for each.

Defined cases: null and empty texts have no words; null and empty items have no windows; equal items
count each; items with a null item_id are searched like any other, count as one item together and are
never listed by name; repeated rows are searched one by one; other columns are
ignored by ``find`` and passed on by ``drop``.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewell.llm.common import map_batches, record_batch, utf8

WINDOW = 10
BLOCK_BYTES = 2 << 20  # benchmark text per pass; its windows take about 40 times that in a task's memory
STRETCH = 512  # bytes of text between two windows that move in step
GAP = 8  # zero bytes between texts, so no block reaches over an end

# Word characters are digits, letters and every byte from 80 on; all else separates.
_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

Patterns = dict[bytes, tuple[int, list[str | None]]]  # pattern -> words in it, items that have it


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


def windows(items: list[tuple[str | None, bytes]], size: int = WINDOW) -> Patterns:
    found: Patterns = {}
    for item, text in items:
        words = words_of(text)
        for i in range(max(1, len(words) - size + 1) if words else 0):
            part = words[i:i + size]
            ids = found.setdefault(b" " + b" ".join(part) + b" ", (len(part), []))[1]
            if not ids or ids[-1] != item:
                ids.append(item)
    return found


class Tables:
    """Shift table and suffix buckets of patterns of similar length."""

    def __init__(self, patterns: list[bytes]):
        self.m = min(map(len, patterns))
        self.block = max(2, min(8, self.m // 3))
        self.mask = np.uint64((1 << 8 * self.block) - 1)
        heads, _ = np.frombuffer(b"".join(p[:self.m] for p in patterns), np.uint8).reshape(len(patterns), self.m), None
        reach = self.m - self.block + 1
        codes = np.zeros((len(patterns), reach), np.uint64)
        for k in range(self.block):
            codes |= heads[:, k:k + reach].astype(np.uint64) << np.uint64(8 * k)
        self.bits = np.uint64(64 - max(12, int(codes.size * 8 - 1).bit_length()))
        self.shift = np.full(1 << (64 - int(self.bits)), reach, np.int32)
        for j in range(reach):  # from far to near, so the least shift is what stays
            self.shift[self.slot(codes[:, j])] = reach - 1 - j
        self.buckets: dict[int, list[bytes]] = defaultdict(list)
        for code, p in zip(codes[:, -1].tolist(), patterns):
            self.buckets[code].append(p)
        self.suffixes = np.unique(codes[:, -1])

    def slot(self, codes: np.ndarray) -> np.ndarray:
        return (codes * np.uint64(0x9E3779B97F4A7C15)) >> self.bits

    def occurrences(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        """Every place in ``text`` (which ends in GAP zero bytes) where a pattern begins."""
        last = len(text) - GAP - self.m + 1
        if last <= 0:
            return
        # The eight bytes from every place on, as one number.
        eights = np.ndarray((len(text) - 7,), "<u8", text, strides=(1,))
        at = np.arange(0, last, STRETCH)
        ends = np.minimum(at + STRETCH, last)
        possible = []
        while len(at):
            codes = eights[at + (self.m - self.block)] & self.mask
            step = self.shift[self.slot(codes)]
            zero = step == 0
            if zero.any():
                places, found = at[zero], codes[zero]
                near = np.minimum(np.searchsorted(self.suffixes, found), len(self.suffixes) - 1)
                same = self.suffixes[near] == found
                possible.append((places[same], found[same]))
            at = at + np.maximum(step, 1)
            going = at < ends
            at, ends = at[going], ends[going]
        for places, codes in possible:
            for place, code in zip(places.tolist(), codes.tolist()):
                for p in self.buckets[code]:
                    if text.startswith(p, place):
                        yield place, p


class Search:
    """All patterns of one benchmark block: short items and full windows have tables of their own."""

    def __init__(self, patterns: Patterns, size: int = WINDOW):
        self.patterns = patterns
        kinds: dict[bool, list[bytes]] = defaultdict(list)
        for p, (n, _) in patterns.items():
            kinds[n < size].append(p)
        self.tables = [Tables(ps) for ps in kinds.values()]

    def hits(self, texts: list[bytes]) -> list[tuple[int, list[tuple[int, int]], set[str | None]]]:
        """Per text: number of words, hit stretches of words (begin, end), items that occur."""
        words = [words_of(t) for t in texts]
        normal = [b" " + b" ".join(w) + b" " for w in words]
        starts = np.cumsum([0] + [len(t) + GAP for t in normal])
        joined = bytes(GAP).join(normal) + bytes(GAP)
        found: dict[int, list[tuple[int, bytes]]] = defaultdict(list)
        for table in self.tables:
            for place, p in table.occurrences(joined):
                doc = int(np.searchsorted(starts, place, "right")) - 1
                found[doc].append((place - int(starts[doc]), p))
        out = []
        for doc, w in enumerate(words):
            spans, items = [], set()
            if doc in found:
                blanks = np.flatnonzero(np.frombuffer(normal[doc], np.uint8) == 32)
                for place, p in found[doc]:
                    first = int(np.searchsorted(blanks, place))
                    spans.append((first, first + self.patterns[p][0]))
                    items.update(self.patterns[p][1])
            out.append((len(w), sorted(spans), items))
        return out


@lru_cache(4)
def _search(sent: Broadcast, size: int) -> Search:
    return Search(sent.value, size)


def covered(spans: list[tuple[int, int]]) -> int:
    n = reached = 0
    for begin, end in sorted(spans):
        n += max(0, end - max(begin, reached))
        reached = max(reached, end)
    return n


def pattern_blocks(benchmark: DataFrame, size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> list[Broadcast]:
    """The benchmark's windows, a bounded number of bytes of text at a time."""
    spark = benchmark.sparkSession
    items = benchmark.where(F.col("text").isNotNull()).select(
        F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes)
    blocks = []
    for k in range(n):
        mine = items.where(F.pmod(F.when(F.col("item").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("item")), F.lit(n)) == k).orderBy("item").collect()
        found = windows([(r["item"], bytes(r["text"])) for r in mine], size)
        if found:
            blocks.append(spark.sparkContext.broadcast(found))
    return blocks


FOUND = "doc_id bigint, text string, n_words bigint, spans array<bigint>, items array<string>"
DIGEST = ("doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean")


def find(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents with their number of words, hit stretches of words (begin, end, ...) and occurring items."""
    plain = docs.select(F.col("doc_id").cast("bigint"), "text")
    blocks = pattern_blocks(benchmark, size, block_bytes)
    found = plain.select("*", F.lit(0).cast("bigint").alias("n_words"), F.expr("array()").cast("array<bigint>").alias("spans"),
                         F.expr("array()").cast("array<string>").alias("items"))

    def searching(sent: Broadcast | None):
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = utf8(batch.column("text"))
            hits = _search(sent, size).hits(texts) if sent else [(len(words_of(t)), [], set()) for t in texts]
            spans = [a + [x for s in h[1] for x in s] for a, h in zip(batch.column("spans").to_pylist(), hits)]
            items = [a + sorted(h[2], key=lambda i: (i is None, i)) for a, h in zip(batch.column("items").to_pylist(), hits)]
            return record_batch(doc_id=batch.column("doc_id"), text=batch.column("text"), n_words=[h[0] for h in hits],
                                spans=pa.array(spans, pa.list_(pa.int64())), items=pa.array(items, pa.list_(pa.string())))
        return work

    for sent in blocks or [None]:
        found = map_batches(found, searching(sent), FOUND, 8 << 20)
    return found


def digest(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: words, hit words, items and their hash, whether contaminated."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [list(zip(s[::2], s[1::2])) for s in batch.column("spans").to_pylist()]
        items = [set(i) for i in batch.column("items").to_pylist()]
        hit = [covered(s) for s in spans]
        return record_batch(doc_id=batch.column("doc_id"), n_words=batch.column("n_words"), n_hit=hit,
                            n_items=[len(i) for i in items],
                            items_sha256=[hashlib.sha256(",".join(sorted(i - {None})).encode()).hexdigest() for i in items],
                            contaminated=[h > 0 for h in hit])

    found = find(docs, benchmark, size, block_bytes).drop("text")
    return found.mapInArrow(lambda batches: (work(b) for b in batches), DIGEST)


def drop(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with all their columns."""
    def clean(sent: Broadcast):
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            hits = _search(sent, size).hits(utf8(batch.column("text")))
            return batch.filter(pa.array([not h[1] for h in hits], pa.bool_()))
        return work

    for sent in pattern_blocks(benchmark, size, block_bytes):
        docs = map_batches(docs, clean(sent), docs.schema, 8 << 20)
    return docs
