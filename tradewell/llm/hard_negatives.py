"""Hard-negative mining by best-first search of STR-packed R-trees.

Vectors are rounded to integers; a score is their inner product, so it is exact. Rows are packed by
sort-tile-recursive: Spark deals them into slabs by (label, first coordinate), each slab is sorted by
(label, second coordinate) and cut into tiles, and inside a tile the next two coordinates give the order
of the leaves. Ties end in vec_id, so equal vectors spread over tiles like any others. A tile is one row of
a written table: its rows in leaf order and the minimum bounding box of each leaf; FANOUT boxes make one
of the level above.

A box gives an interval of the score with an anchor: each coordinate's product lies between those of the
box's two sides. A search keeps a queue of boxes, the highest upper end first, and leaves out a box whose
interval misses the score windows, that holds no fitting label, or whose upper end is strictly below the
kth score found. The bounds of all boxes of a tile with a block of anchors come from two matrix products.

Anchors are the stated queries: they are read in blocks of ANCHOR_BYTES, and each block takes two passes
over the tiles, one for its positives and one for the negatives of all their windows.

Defined cases: rows without vec_id or label, without a vector, or with a null or non-finite component
take no part; vectors of different length do not meet; empty vectors score 0 with each other; a row with
an anchor's vec_id is that anchor, so never its partner; repeated rows are partners of their own and
repeated anchors give their results each; components beyond 64 bits are the nearest such number, and a
score beyond 64 bits is returned as the nearest one; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush, heapreplace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewell.llm.common import record_batch, release_memory
from tradewell.session import materialise

TILE_ROWS = 4096
LEAF_ROWS = 256
FANOUT = 16
ANCHOR_BYTES = 2 << 20
EXACT = 1 << 53  # below it doubles hold integers exactly
LEAST, MOST = -(1 << 63), (1 << 63) - 1

TILE = "dim int, ids binary, labels binary, vectors binary, low binary, high binary"
FOUND = "anchor int, slot int, vec_id bigint, score bigint"


def prepared(rows: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id, label, v (integers): the rows that take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return (rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull()).where(finite)
            .select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), whole.alias("v")))


# ---- packing

def leaf_order(vectors: np.ndarray, labels: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Sort-tile-recursive inside a tile: slices along the third coordinate, leaves along the fourth."""
    n, dim = vectors.shape
    side = [vectors[:, k % dim] if dim else np.zeros(n) for k in (2, 3)]
    order = np.lexsort((ids, side[0], labels))
    leaves = -(-n // LEAF_ROWS)
    slice_rows = LEAF_ROWS * -(-leaves // math.isqrt(max(leaves, 1)))
    parts = [order[a:a + slice_rows] for a in range(0, n, slice_rows)]
    return np.concatenate([p[np.lexsort((ids[p], side[1][p], labels[p]))] for p in parts])


def pack_tile(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> dict:
    order = leaf_order(vectors, labels, ids)
    ids, labels, vectors = ids[order], labels[order], vectors[order]
    starts = np.arange(0, len(ids), LEAF_ROWS)
    return {"dim": vectors.shape[1], "ids": ids.tobytes(), "labels": labels.tobytes(), "vectors": vectors.tobytes(),
            "low": np.minimum.reduceat(vectors, starts, axis=0).tobytes(), "high": np.maximum.reduceat(vectors, starts, axis=0).tobytes()}


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("dim", pa.int32()), *((c, pa.binary()) for c in ("ids", "labels", "vectors", "low", "high"))])
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def tile(n: int) -> pa.RecordBatch:
        ids, labels, vectors = (np.concatenate([h[k] for h in held]) for k in range(3))
        held[:] = [(ids[n:], labels[n:], vectors[n:])] if len(ids) > n else []
        return pa.RecordBatch.from_pylist([pack_tile(ids[:n], labels[:n], vectors[:n])], schema)

    for batch in batches:
        dims = np.asarray(batch.column("dim"))
        for part in np.split(np.arange(len(dims)), np.flatnonzero(np.diff(dims)) + 1):
            if not len(part):
                continue
            piece, dim = batch.slice(int(part[0]), len(part)), int(dims[part[0]])
            values = np.asarray(piece.column("v").flatten(), np.int64).reshape(len(part), dim)
            if held and held[0][2].shape[1] != dim:
                yield tile(TILE_ROWS)
            held.append((np.asarray(piece.column("vec_id"), np.int64), np.asarray(piece.column("label"), np.int64), values))
            while sum(len(h[0]) for h in held) >= TILE_ROWS:
                yield tile(TILE_ROWS)
    if held:
        yield tile(TILE_ROWS)


def packed(rows: DataFrame) -> DataFrame:
    """The written tiles of ``prepared`` rows."""
    n = rows.count()
    tiles = max(1, -(-n // TILE_ROWS))
    slabs = min(tiles, max(math.isqrt(tiles - 1) + 1, rows.sparkSession.sparkContext.defaultParallelism))
    placed = rows.select(F.size("v").alias("dim"), "label", "vec_id", "v", F.get("v", F.lit(0)).alias("c0"), F.get("v", F.lit(1)).alias("c1"))
    slabbed = placed.repartitionByRange(slabs, "dim", "label", "c0", "vec_id").sortWithinPartitions("dim", "label", "c1", "vec_id")
    return materialise(slabbed.select("dim", "vec_id", "label", "v").mapInArrow(_pack, TILE), "tiles")


# ---- search

def numbers(anchors: np.ndarray, *others: np.ndarray) -> list[np.ndarray]:
    """The arrays as doubles if all inner products with an anchor are exact in doubles, else as Python's integers."""
    size = lambda a: max(abs(int(a.max())), abs(int(a.min()))) if a.size else 0
    exact = size(anchors) * max(map(size, others)) * anchors.shape[1] < EXACT
    return [a.astype(np.float64 if exact else object) for a in (anchors, *others)]


@dataclass
class Level:
    low: np.ndarray
    high: np.ndarray
    least: np.ndarray  # labels
    most: np.ndarray


class Tree:
    """The R-tree of a tile: levels[0] are the leaves, the last level is the root."""

    def __init__(self, row: dict):
        self.ids, self.labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
        n = len(self.ids)
        shape = lambda c, k: np.frombuffer(row[c], np.int64).reshape(k, row["dim"])
        starts = np.arange(0, n, LEAF_ROWS)
        self.vectors = shape("vectors", n)
        level = Level(shape("low", len(starts)), shape("high", len(starts)), np.minimum.reduceat(self.labels, starts),
                      np.maximum.reduceat(self.labels, starts))
        self.levels = [level]
        while len(level.least) > 1:
            at = np.arange(0, len(level.least), FANOUT)
            level = Level(np.minimum.reduceat(level.low, at, axis=0), np.maximum.reduceat(level.high, at, axis=0),
                          np.minimum.reduceat(level.least, at), np.maximum.reduceat(level.most, at))
            self.levels.append(level)

    def intervals(self, anchors: np.ndarray) -> list[tuple[list, list]]:
        """For each level, the least and greatest score that each anchor (row) can have in each box (column)."""
        out = []
        for level in self.levels:
            a, low, high = numbers(anchors, level.low, level.high)
            up, down = np.maximum(a, 0), np.minimum(a, 0)
            out.append(((up @ low.T + down @ high.T).tolist(), (up @ high.T + down @ low.T).tolist()))
        return out


class Best:
    """The k highest scores inside a window, ties by smaller vec_id."""

    __slots__ = ("low", "high", "k", "heap")

    def __init__(self, low: float, high: float, k: int):
        self.low, self.high, self.k, self.heap = low, high, k, []

    @property
    def least(self):
        """A score strictly below this cannot get in."""
        return self.heap[0][0] if len(self.heap) == self.k else self.low

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fits = np.flatnonzero((scores >= self.least) & (scores <= self.high))
        if len(fits) > self.k:
            fits = fits[np.lexsort((ids[fits], -scores[fits]))[:self.k]]
        for score, vec_id in zip(scores[fits].tolist(), ids[fits].tolist()):
            entry = (int(score), -vec_id)
            if len(self.heap) < self.k:
                heappush(self.heap, entry)
            elif entry > self.heap[0]:
                heapreplace(self.heap, entry)


@dataclass
class Block:
    """Anchors of one length, and for each what is searched."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    windows: list[list[tuple[float, float]]]
    same_label: bool
    k: int


def search(tree: Tree, block: Block, best: list[list[Best]]) -> None:
    """Best-first search of one tree for every anchor; what earlier trees gave already prunes."""
    intervals = tree.intervals(block.vectors)
    anchors, vectors = numbers(block.vectors, tree.vectors)
    top = len(tree.levels) - 1
    for i, (own, label) in enumerate(zip(block.ids.tolist(), block.labels.tolist())):
        goals = best[i]

        def fits(depth: int, node: int) -> bool:
            level = tree.levels[depth]
            if block.same_label and not level.least[node] <= label <= level.most[node]:
                return False
            if not block.same_label and level.least[node] == label == level.most[node]:
                return False
            low, high = intervals[depth][0][i][node], intervals[depth][1][i][node]
            return any(high >= g.least and low <= g.high for g in goals)

        queue = [(-intervals[top][1][i][0], top, 0)] if fits(top, 0) else []
        while queue:
            _, depth, node = heappop(queue)
            if not fits(depth, node):  # what was found since may have ruled it out
                continue
            if depth:
                for child in range(node * FANOUT, min((node + 1) * FANOUT, len(tree.levels[depth - 1].least))):
                    if fits(depth - 1, child):
                        heappush(queue, (-intervals[depth - 1][1][i][child], depth - 1, child))
                continue
            a = node * LEAF_ROWS
            ids, labels = tree.ids[a:a + LEAF_ROWS], tree.labels[a:a + LEAF_ROWS]
            scores = vectors[a:a + LEAF_ROWS] @ anchors[i]
            chosen = ((labels == label) == block.same_label) & (ids != own)
            scores, ids = scores[chosen], ids[chosen]
            if not len(scores):
                continue
            highest, lowest = scores.max(), scores.min()
            for g in goals:
                if highest >= g.least and lowest <= g.high:
                    g.add(scores, ids)


def searched(tiles: DataFrame, block: Block) -> DataFrame:
    """anchor (place in the block), slot (which window), vec_id, score: the best of each task's tiles."""
    sent = tiles.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = sent.value
        best = [[Best(*w, mine.k) for w in windows] for windows in mine.windows]
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if row["dim"] == mine.vectors.shape[1]:
                    search(Tree(row), mine, best)
        out = [(i, j, -e[1], min(max(e[0], LEAST), MOST)) for i, goals in enumerate(best) for j, g in enumerate(goals) for e in g.heap]
        if out:
            anchor, slot, ids, scores = zip(*out)
            yield record_batch(anchor=pa.array(anchor, pa.int32()), slot=pa.array(slot, pa.int32()), vec_id=pa.array(ids, pa.int64()),
                               score=pa.array(scores, pa.int64()))
        release_memory()

    return tiles.mapInArrow(run, FOUND)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The first k of each anchor and slot over all tasks."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def anchor_blocks(anchors: DataFrame) -> Iterator[list]:
    """The anchors, a bounded number of bytes at a time, those of a block all of one length."""
    sizes = anchors.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy("dim").collect()
    for dim, n in sizes:
        blocks = -(-n * (8 * dim + 16) // ANCHOR_BYTES)
        for k in range(blocks):
            mine = anchors.where((F.size("v") == dim) & (F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == k))
            if rows := mine.orderBy("vec_id", "label", "v").collect():
                yield rows


RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, window: tuple[int, int] = (30, 90)) -> DataFrame:
    """For each anchor and each of its first positives, the first rows of other labels in the score window.

    ``rows`` are ``prepared``; the window is in hundredths of the positive's score, both ends included.
    """
    spark = rows.sparkSession
    rows = materialise(rows, "vectors")
    tiles, results = packed(rows), []
    for chosen in anchor_blocks(rows.where(is_anchor)):
        block = Block(np.array([r["vec_id"] for r in chosen], np.int64), np.array([r["label"] for r in chosen], np.int64),
                      np.array([r["v"] for r in chosen], np.int64).reshape(len(chosen), -1),
                      [[(-math.inf, math.inf)]] * len(chosen), True, positives)
        near: list[list] = [[] for _ in chosen]
        for r in ranked(searched(tiles, block), positives).orderBy("anchor", "rank").collect():
            near[r["anchor"]].append(r)
        block.same_label, block.k = False, negatives
        block.windows = [[(-(-window[0] * r["score"] // 100), window[1] * r["score"] // 100) for r in found] for found in near]
        pairs = spark.createDataFrame(
            [(i, j, int(block.ids[i]), r["vec_id"], r["score"]) for i, found in enumerate(near) for j, r in enumerate(found)],
            "anchor int, slot int, anchor_id bigint, positive_id bigint, positive_score bigint")
        hard = ranked(searched(tiles, block), negatives).join(F.broadcast(pairs), ["anchor", "slot"])
        results.append(materialise(hard.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                                               F.col("score").alias("negative_score")), "negatives"))
    out = spark.createDataFrame([], RESULT)
    for r in results:
        out = out.union(r)
    return out


def digest(embeddings: DataFrame, **options) -> DataFrame:
    """Hard negatives of every hundredth row, labels of every seventh moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = prepared(embeddings.select("vec_id", moved.alias("label"), "embedding"))
    return mine(rows, F.col("vec_id") % 100 == 0, **options)
