"""Token counts by heap-and-linked-list byte-pair merging.

A piece starts as its byte symbols in a doubly linked list. A heap holds the adjacent pairs that have
a merge rank; the lowest rank (leftmost among equals) is popped again and again, stale entries are
skipped, and each merge puts at most two new pairs on the heap. The count is the number of initial
symbols minus the number of merges; no identifier is made.

Text becomes pieces as the vocabulary file says: canonical composition, lower case, white space gone,
contractions, runs of letters, single digits, runs of other characters; the file's special strings
count as one token each. A piece never reaches over white space, so counts of words are kept in a
bounded table of each worker.

Defined cases: null and empty texts have no tokens; repeated rows are counted one by one; other
columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewell.llm.common import map_batches, record_batch, utf8

WORDS_KEPT = 1_000_000
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")


class Merges:
    """Merge ranks and special strings of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.end = spec["model"]["end_of_word_suffix"] or ""
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"])
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.special = [t["content"] for t in spec["added_tokens"]]
        # Printable stand-ins of bytes: printable Latin-1 for itself, all others counted up from 256.
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = iter(range(256, 512))
        self.symbols = [chr(b) if b in printable else chr(next(others)) for b in range(256)]

    def count_piece(self, piece: bytes) -> int:
        """Initial symbols minus merges."""
        symbols: list[str | None] = [self.symbols[b] for b in piece]
        symbols[-1] += self.end
        n = len(symbols)
        if n == 1:
            return 1
        ranks = self.ranks
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(rank, i, pair) for i, pair in enumerate(zip(symbols, symbols[1:])) if (rank := ranks.get(pair)) is not None]
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, (left, right) = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j < 0 or symbols[j] != right:
                continue  # one of the two has been merged since
            merges += 1
            symbols[i], symbols[j] = left + right, None
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (rank := ranks.get(pair := (symbols[i], symbols[k]))) is not None:
                    heapq.heappush(heap, (rank, i, pair))
            if (h := before[i]) >= 0 and (rank := ranks.get(pair := (symbols[h], symbols[i]))) is not None:
                heapq.heappush(heap, (rank, h, pair))
        return n - merges

    def pieces(self, text: str) -> list[bytes]:
        lowered = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return [p.encode() for p in _PIECES.findall(lowered)]


class Counter(dict):
    """Tokens of words without white space, found on first use; emptied when full."""

    def __init__(self, path: str):
        super().__init__()
        self.merges = Merges(path)
        self.by_piece: dict[bytes, int] = {}
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.merges.special)) + ")" if self.merges.special else "(?!)")

    def __missing__(self, word: bytes) -> int:
        n = 0
        for k, part in enumerate(self.split.split(word.decode())):
            if k % 2:
                n += 1
                continue
            for piece in self.merges.pieces(part):
                if (c := self.by_piece.get(piece)) is None:
                    c = self.by_piece[piece] = self.merges.count_piece(piece)
                n += c
        self[word] = n
        return n

    def count(self, text: bytes) -> int:
        if len(self) > WORDS_KEPT:
            self.clear()
        if len(self.by_piece) > WORDS_KEPT:
            self.by_piece.clear()
        return sum(map(self.__getitem__, text.split()))


@lru_cache(2)
def _counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row; ``vocabulary`` is a file on every worker."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, counter = utf8(batch.column("text")), _counter(vocabulary)
        counts = [counter.count(t) for t in texts]
        return record_batch(doc_id=batch.column("doc_id"), n_bytes=list(map(len, texts)), n_tokens=counts,
                            over_limit=[n > limit for n in counts])

    return map_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), work,
                       "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
