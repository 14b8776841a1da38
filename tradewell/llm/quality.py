"""Quality rules: compression bands.

Text that repeats itself compresses too well, random text (keys, encoded data) hardly at all. The
zstandard ratio (bytes / compressed bytes) of a whole text must lie in a band that depends on its
length, since short texts never reach the ratios of long ones. The ratios of fixed chunks find
stretches that the whole hides; a text fails when too large a share of its chunks lies outside the
chunk band.

The bands fit text of one byte a letter. Letters of two to four bytes share their leading bytes, which
alone lifts the ratio, so a text or chunk above its band counts as repeating itself only if it is above
the band of its length with one byte a letter too.

Defined cases: a null or empty text has no words, ratio 0 and fails the base rule; repeated rows are
judged one by one; other columns of the input are ignored by ``measure`` and passed on by ``keep``.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewell.llm.common import map_batches, record_batch, utf8

SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Bands:
    """Limits of the ratio by length: (bytes from which the row holds, least ratio, greatest ratio)."""

    whole: tuple[tuple[int, float, float], ...] = (
        (0, 0.0, 2.5), (100, 0.8, 3.0), (300, 1.1, 3.3), (1_000, 1.3, 3.6), (3_000, 1.45, 4.0), (10_000, 1.6, 5.0))
    chunk_bytes: int = 1_024
    chunk: tuple[float, float] = (1.05, 5.0)
    bad_chunk_share: float = 0.2
    level: int = 3

    def limits(self, size: int) -> tuple[float, float]:
        return next((low, high) for least, low, high in reversed(self.whole) if size >= least)


DEFAULT = Bands()
SCHEMA = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "base_failed boolean, ratio double, n_chunks bigint, n_bad_chunks bigint, kept boolean")


def base_measures(text: bytes) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, and words in repeated three-word windows."""
    words = text.split()
    continuation = len(text) - len(text.decode("utf-8", "replace")) if not text.isascii() else 0
    chars = sum(map(len, words)) - continuation
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        counts = Counter(windows)
        reached = 0  # the first word that no window so far covers
        for i, window in enumerate(windows):
            if counts[window] > 1:
                repeated += i + 3 - max(i, reached)
                reached = i + 3
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


def narrow(text: bytes) -> bytes:
    """The text with one byte for each of its 128 commonest code points beyond ASCII; only for comparing sizes."""
    letters = text.decode("utf-8", "replace")
    wide = [c for c, _ in Counter(c for c in letters if c > "\x7f").most_common()]
    table = {ord(c): chr(128 + i) if i < 128 else c.encode().decode("latin-1") for i, c in enumerate(wide)}
    return letters.translate(table).encode("latin-1")


def compression(text: bytes, bands: Bands, compressor: zstandard.ZstdCompressor) -> tuple[float, int, int, bool]:
    """Ratio of the whole, chunks, chunks outside the band, and the verdict.

    The last chunk takes the remainder with it, so no chunk is shorter than the chunk size unless the
    text is; a text under one chunk has none.
    """
    if not text:
        return 0.0, 0, 0, False
    def too_high(part: bytes, high: float, whole: bool) -> bool:
        if part.isascii():
            return True
        short = narrow(part)
        return len(short) / len(compressor.compress(short)) > (bands.limits(len(short))[1] if whole else high)

    ratio = len(text) / len(compressor.compress(text))
    low, high = bands.limits(len(text))
    fine = low <= ratio and (ratio <= high or not too_high(text, high, True))
    size = bands.chunk_bytes
    n = len(text) // size
    bad = 0
    for i in range(n):
        part = text[i * size: (i + 1) * size if i < n - 1 else len(text)]
        part_ratio = len(part) / len(compressor.compress(part))
        bad += part_ratio < bands.chunk[0] or (part_ratio > bands.chunk[1] and too_high(part, bands.chunk[1], False))
    return ratio, n, bad, fine and bad <= bands.bad_chunk_share * n


def judge(texts: list[bytes], bands: Bands) -> list[tuple]:
    """One tuple per text: base measures, base_failed, ratio, chunks, bad chunks, kept."""
    compressor = zstandard.ZstdCompressor(level=bands.level)
    out = []
    for text in texts:
        base = base_measures(text)
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        ratio, n, bad, fine = compression(text, bands, compressor)
        out.append((*base, failed, ratio, n, bad, fine and not failed))
    return out


def measure(docs: DataFrame, bands: Bands = DEFAULT) -> DataFrame:
    """One row per document with its measures and verdict."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = zip(*judge(utf8(batch.column("text")), bands))
        return record_batch(doc_id=batch.column("doc_id"), **dict(zip(names[1:], map(list, columns))))

    return map_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), work, SCHEMA)


def keep(docs: DataFrame, bands: Bands = DEFAULT) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array([r[-1] for r in judge(utf8(batch.column("text")), bands)], pa.bool_()))

    return map_batches(docs, work, docs.schema)
