"""Ranked lexical search by hashed max-sketches.

The impact of a term in a document is what its frequency and the document's length give; a term's weight
follows from the number of documents that hold it. A document's score for an item is the sum of weight
times impact over the item's terms. All of it is integers.

A document's sketch is an array: each distinct term is hashed to one place, and a place holds the
greatest impact of the terms that fell on it. So the place of an item's term is never below that term's
impact, and the sum of weight times place is an upper bound of the score. The sketches of many documents,
at the places where some item has a term, times the folded weights of many items are one matrix product,
which looks up all bounds at once. Then each item's documents are scored exactly from the highest bound
down, until a bound is below the kth score found. A sketch has 16 to 32 places for each distinct term, up to
MOST_PLACES; a fuller one only bounds more loosely.

Counts cover all documents: one pass counts documents, terms, and the documents of each term of the
items; a second one searches. Every task returns its k best of each item, whose best are the result. The
items are the stated queries: they are read in blocks of bounded size, with two passes for each.

Defined cases: null and empty texts have no terms and are not counted; items without terms, or whose
terms occur nowhere, return nothing; repeated rows are documents of their own with a rank each; a null
doc_id comes after all others of equal score; equal items, and items without item_id, are ranked each on
their own; long texts are counted in pieces; an empty table on either side gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappush, heapreplace
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewell.llm.common import id_column, record_batch, release_memory, slices, utf8
from tradewell.llm.decontaminate import words_of
from tradewell.session import materialise

BLOCK_BYTES = 1 << 20  # text of the items searched in one pass
BLOCK_ITEMS = 2048
BATCH_BYTES = 4 << 20
PIECE = 1 << 20
LEAST_PLACES, MOST_PLACES, PLACES_A_TERM = 64, 1 << 16, 16
BOUNDS_AT_ONCE = 1 << 22
SHARES = 64
UNIT = 1_000_000_000


def pieces(text: bytes) -> Iterator[bytes]:
    """A text in pieces that cut no term."""
    at = 0
    while len(text) - at > PIECE:
        end = at + PIECE
        while end < len(text) and (text[end] >= 128 or chr(text[end]).isalnum()):
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def term_counts(text: bytes) -> Counter:
    counts: Counter = Counter()
    for piece in pieces(text):
        counts.update(words_of(piece))
    return counts


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def length_part(terms: int, documents: int, all_terms: int) -> int:
    return 100 - 25 + (25 * terms * documents) // all_terms


def impact(frequency: int, length: int) -> int:
    return (UNIT * frequency) // (1000 * frequency + 12 * length)


# ---- items

@dataclass
class Items:
    """A block of items: ids and, for each, its terms with their number of occurrences."""

    ids: list
    terms: list[Counter]

    def vocabulary(self) -> dict[bytes, int]:
        return {t: i for i, t in enumerate(sorted(set().union(*self.terms)))}


def item_blocks(items: DataFrame) -> Iterator[Items]:
    rows = items.where(F.col("text").isNotNull()).select("item_id", F.col("text").cast("binary").alias("text"))
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(-(-n // BLOCK_ITEMS), -(-size // BLOCK_BYTES))
    for k in range(blocks):
        mine = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        found = [(r["item_id"], term_counts(bytes(r["text"]))) for r in mine]
        if found := [f for f in found if f[1]]:
            yield Items([f[0] for f in found], [f[1] for f in found])


# ---- statistics

@dataclass
class Statistics:
    documents: int
    terms: int
    weights: dict[bytes, int]  # of the items' terms that some document holds


def statistics(docs: DataFrame, items: Items) -> Statistics:
    """Over all documents; tasks send one row for each term of the block that they met."""
    vocabulary = items.vocabulary()
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        documents = terms = 0
        holding = np.zeros(len(known), np.int64)
        for batch in batches:
            for part in slices(batch, BATCH_BYTES):
                for text in utf8(part.column("text")):
                    met: set[bytes] = set()
                    own = 0
                    for piece in pieces(text):
                        words = words_of(piece)
                        own += len(words)
                        met |= known.keys() & set(words)
                    documents += own > 0
                    terms += own
                    for t in met:
                        holding[known[t]] += 1
        found = np.flatnonzero(holding)
        yield record_batch(term=pa.array([-2, -1, *found.tolist()], pa.int64()),
                           n=pa.array([documents, terms, *holding[found].tolist()], pa.int64()))
        release_memory()

    counted = docs.select("text").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    n = {r["term"]: r["n"] for r in counted.collect()}
    documents = n.get(-2, 0)
    return Statistics(documents, n.get(-1, 0), {t: weight(documents, n[i]) for t, i in vocabulary.items() if i in n})


# ---- search

class Search:
    """A block of items ready to be looked up in sketches."""

    def __init__(self, items: Items, seen: Statistics):
        self.seen, self.ids = seen, items.ids
        self.weighted = [{t: c * seen.weights[t] for t, c in terms.items() if t in seen.weights} for terms in items.terms]
        self.hashes = [(crc32(t), q, w) for q, terms in enumerate(self.weighted) for t, w in terms.items()]
        self._folded: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def folded(self, places: int) -> tuple[np.ndarray, np.ndarray]:
        """Which places of a sketch of that many the items ask for, and their weights at each of these."""
        if places not in self._folded:
            h, q, w = (np.array(x, np.int64) for x in zip(*self.hashes)) if self.hashes else (np.zeros(0, np.int64),) * 3
            asked, row = np.unique(h & (places - 1), return_inverse=True)
            weights = np.zeros((len(asked), len(self.ids)))
            np.add.at(weights, (row, q), w)
            self._folded[places] = asked, weights.astype(np.float32)
        return self._folded[places]

    def bounds(self, sketches: np.ndarray) -> np.ndarray:
        """No score is above its bound: one row for each sketch, one column for each item."""
        asked, weights = self.folded(sketches.shape[1])
        # Single precision rounds each of the products and sums by less than 2 ** -23 of it.
        return (sketches[:, asked] @ weights) * (1 + (len(asked) + 8) * 2.0 ** -23) + 1

    def score(self, item: int, counts: Counter, length: int) -> int:
        total = 0
        for term, w in self.weighted[item].items():
            if frequency := counts.get(term):
                total += w * impact(frequency, length)
        return total


@dataclass
class Document:
    doc_id: int | None
    counts: Counter
    length: int
    places: int


def sketches(docs: list[Document], places: int) -> np.ndarray:
    """One row for each document: the greatest impact at each place."""
    out = np.zeros((len(docs), places), np.float32)
    for row, d in zip(out, docs):
        n = len(d.counts)
        at = np.fromiter(map(crc32, d.counts), np.int64, n) & (places - 1)
        f = np.fromiter(d.counts.values(), np.int64, n)
        np.maximum.at(row, at, ((UNIT * f) // (1000 * f + 12 * d.length)).astype(np.float32))  # below 2 ** 20, so exact
    return out


def place_count(distinct: int) -> int:
    return min(MOST_PLACES, max(LEAST_PLACES, 1 << (PLACES_A_TERM * distinct - 1).bit_length()))


class Top:
    """The k best documents of each item so far: scores down, then ids up, those without id last."""

    def __init__(self, search: Search, k: int):
        self.search, self.k = search, k
        self.heaps: list[list] = [[] for _ in search.ids]
        self.least = np.ones(len(search.ids))  # a bound below it cannot get in: the kth score, 1 before there are k

    def rescore(self, docs: list[Document], bounds: np.ndarray) -> None:
        for item in np.flatnonzero((bounds >= self.least).any(axis=0)).tolist():
            heap, column = self.heaps[item], bounds[:, item]
            open_ = np.flatnonzero(column >= self.least[item])
            for row in open_[np.argsort(-column[open_], kind="stable")].tolist():
                if column[row] < self.least[item]:
                    break
                d = docs[row]
                score = self.search.score(item, d.counts, d.length)
                entry = (score, d.doc_id is not None, -(d.doc_id or 0))
                if len(heap) < self.k:
                    if score > 0:
                        heappush(heap, entry)
                elif entry > heap[0]:
                    heapreplace(heap, entry)
                if len(heap) == self.k:
                    self.least[item] = heap[0][0]

    def add(self, docs: list[Document]) -> None:
        by_places: dict[int, list[Document]] = {}
        for d in docs:
            by_places.setdefault(d.places, []).append(d)
        for places, group in by_places.items():
            step = max(1, BOUNDS_AT_ONCE // max(len(self.search.ids), places))
            for a in range(0, len(group), step):
                part = group[a:a + step]
                self.rescore(part, self.search.bounds(sketches(part, places)))


def searched(docs: DataFrame, search: Search, k: int) -> DataFrame:
    """item (place in the block), share, doc_id, score: the k best of each task."""
    sent = docs.sparkSession.sparkContext.broadcast(search)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sent.value
        top = Top(found, k)
        for batch in batches:
            for part in slices(batch, BATCH_BYTES):
                ready = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), utf8(part.column("text"))):
                    counts = term_counts(text)
                    if counts:
                        length = length_part(counts.total(), found.seen.documents, found.seen.terms)
                        ready.append(Document(doc_id, counts, length, place_count(len(counts))))
                top.add(ready)
                del ready
                release_memory()
        out = [(i, -e[2] if e[1] else None, e[0]) for i, heap in enumerate(top.heaps) for e in heap]
        if out:
            items, ids, scores = zip(*out)
            yield record_batch(item=pa.array(items, pa.int32()), doc_id=pa.array(ids, pa.int64()), score=pa.array(scores, pa.int64()))

    return docs.select(id_column(docs), "text").mapInArrow(run, "item int, doc_id bigint, score bigint").withColumn(
        "share", F.spark_partition_id() % SHARES)


def best_of(found: DataFrame, k: int) -> DataFrame:
    """rank, within shares of the tasks first, so that no item's rows of all tasks are sorted in one place."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for keys in (["item", "share"], ["item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    return found


def rank(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k highest-scoring documents."""
    spark = docs.sparkSession
    schema = T.StructType([T.StructField("item_id", items.schema["item_id"].dataType), T.StructField("rank", T.IntegerType()),
                           T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    out = spark.createDataFrame([], schema)
    for block in item_blocks(items):
        names = spark.createDataFrame(list(enumerate(block.ids)), T.StructType([T.StructField("item", T.IntegerType()), schema["item_id"]]))
        best = best_of(searched(docs, Search(block, statistics(docs, block)), k), k)
        out = out.union(materialise(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "ranked"))
    return out
