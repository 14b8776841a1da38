"""Language identification by rank-order profiles.

A profile is the list of the most frequent n-grams (1 to 3 characters of lower-cased letters, every
run of other characters as one blank) of a language, most frequent first. A document's own list is
compared with each profile by the out-of-place distance: the sum over its n-grams of the difference
of the two ranks, or of a fixed penalty where the profile lacks the n-gram. The closest profile wins.

Profiles count all labelled training rows. Equal counts rank by the n-gram's code; equal distances go
to the language that sorts first. Defined cases: a null text or one without a letter is ``und`` with
score 0, as is every text when nothing could be learned; a null language teaches nothing; repeated
rows count as often as they occur; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewell.llm.common import map_batches, record_batch, release_memory, slices

PROFILE_SIZE = 400
UNDETERMINED = "und"
_BITS = np.uint64(21)  # a code point
_BLANK = 32


@lru_cache(1)
def _folded() -> np.ndarray:
    """For each code point: itself if a letter, else the blank."""
    return np.fromiter((i if chr(i).isalpha() else _BLANK for i in range(0x110000)), np.uint32, 0x110000)


def folded(text: str) -> np.ndarray:
    """Lower-cased letters with single blanks between, before and after the words; empty without a letter."""
    codes = _folded()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
    codes = np.concatenate(([_BLANK], codes, [_BLANK])).astype(np.uint64)
    kept = codes[np.concatenate(([True], (codes[1:] != _BLANK) | (codes[:-1] != _BLANK)))]
    return kept if len(kept) > 1 else kept[:0]


def grams(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of length 1 to 3 with their counts; a gram is its code points, 21 bits each.

    All come from the sorted trigrams: those that share the first characters are neighbours.
    """
    if not len(codes):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    padded = np.concatenate((codes, np.zeros(2, np.uint64)))
    tri, counts = np.unique((padded[:-2] << (_BITS * 2)) | (padded[1:-1] << _BITS) | padded[2:], return_counts=True)
    found = [(tri, counts)]
    for shift in (_BITS, _BITS * 2):
        short = (tri >> shift) << shift
        first = np.flatnonzero(np.concatenate(([True], short[1:] != short[:-1])))
        found.append((short[first], np.add.reduceat(counts, first)))
    low, middle = np.uint64((1 << 21) - 1), np.uint64(((1 << 21) - 1) << 21)
    keys = np.concatenate([found[0][0][(tri & low) > 0], found[1][0][(found[1][0] & middle) > 0], found[2][0]])
    sums = np.concatenate([counts[(tri & low) > 0], found[1][1][(found[1][0] & middle) > 0], found[2][1]])
    lone = keys == np.uint64(_BLANK) << (_BITS * 2)  # the blank alone says nothing
    return keys[~lone], sums[~lone]


def ranked(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first."""
    if len(keys) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        keys, counts = keys[counts >= least], counts[counts >= least]
    return keys[np.lexsort((keys, -counts))][:size]


def gram_counts(docs: DataFrame) -> DataFrame:
    """lang, gram, n over all rows: counted per piece of input and language, then summed."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, 32 << 20):
                frame = pd.DataFrame({"lang": piece.column("lang").to_pylist(), "text": piece.column("text").to_pylist()})
                for lang, texts in frame.dropna().groupby("lang")["text"]:
                    keys, n = grams(np.concatenate([folded(t) for t in texts]))
                    yield record_batch(lang=[lang] * len(keys), gram=keys.astype(np.int64), n=n)
            del batch
            release_memory()

    return (docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
            .mapInArrow(work, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def learn(docs: DataFrame, size: int = PROFILE_SIZE) -> dict[str, list[int]]:
    """Profile of each language: at most ``size`` numbers a language reach the driver.

    The languages of a corpus are few; the window holds the distinct n-grams of one language.
    """
    counts = gram_counts(docs)
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size)
    out: dict[str, list[int]] = {}
    for row in top.orderBy("lang", "place").toLocalIterator():
        out.setdefault(row["lang"], []).append(row["gram"])
    return out


class Profiles:
    """The ranks of all profiles, looked up for a whole document at once."""

    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE_SIZE):
        self.langs, self.size = sorted(profiles), size
        self.keys = np.unique(np.array([g for p in profiles.values() for g in p], np.int64).astype(np.uint64))
        self.ranks = np.full((len(self.keys) + 1, len(self.langs)), -1, np.int64)
        for column, lang in enumerate(self.langs):
            grams_ = np.array(profiles[lang], np.int64).astype(np.uint64)
            self.ranks[np.searchsorted(self.keys, grams_), column] = np.arange(len(grams_))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: how much closer than the farthest possible the winner is, 0 to 1."""
        codes = folded(text or "")
        if not len(codes) or not self.langs:
            return UNDETERMINED, 0.0
        own = ranked(*grams(codes), self.size)
        at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
        ranks = self.ranks[np.where(self.keys[at] == own, at, len(self.keys))]
        distance = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(distance.argmin())
        return self.langs[best], float(1 - distance[best] / (self.size * len(own)))


def predict(docs: DataFrame, profiles: dict[str, list[int]], held: Column, size: int = PROFILE_SIZE) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = Profiles(profiles, size)
        found = [model.predict(t) for t in batch.column("text").to_pylist()]
        return record_batch(doc_id=batch.column("doc_id"), held_out=batch.column("held_out"),
                            lang_pred=[f[0] for f in found], score=[f[1] for f in found])

    return map_batches(docs.select(F.col("doc_id").cast("bigint"), held.alias("held_out"), "text"), work,
                       "doc_id bigint, held_out boolean, lang_pred string, score double", 64 << 20)
