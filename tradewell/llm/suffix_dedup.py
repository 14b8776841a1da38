"""Suffix-array dedup: removing long byte strings that an earlier document has too.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller
doc_id. The strings are found on a Burrows-Wheeler transform: the rows that begin with one string are
an interval, and extending all intervals of a length backwards by every character at once gives those
of the next length. That derives the common prefixes of neighbouring rows by increasing value; it
stops at ``LENGTH``, where what is still together shares at least that much.

No transform of the whole corpus fits a task, so the corpus is cut where no shared string is lost:

1. Of the 24-byte strings inside a window of LENGTH bytes the one with the least hash is its anchor.
   Equal windows have equal anchors. The anchors of all documents are sent out by hash, packed in
   arrays; those that only one document has are dropped, the rest go back to their documents, packed
   for a group of documents (a home) at a time and merged there into one row a document.
2. Neighbouring windows with one anchor are a stretch. Stretches with a shared anchor meet by its
   hash; equal ones are merged under their smallest doc_id. Those whose anchor no other has share nothing
   more; the rest of a bucket get one transform, and every window learns the smallest doc_id that has it.
3. Documents take back the windows that a smaller doc_id has, and drop the bytes.

An anchor whose stretches have more than ``HOT_BYTES`` (a phrase with other text around it in very many
documents) is hot: its single windows meet by a hash of all their bytes instead, so no group grows
with it. A sketch of the bytes of every anchor tells which are hot; an anchor that shares its counter
with a hot one is split too, which changes no result.

What many documents share is merged before it is sent: an anchor in many documents of a batch is sent
once and known to all of them; equal stretches of a batch are sent for the smallest doc_id, the others
know at once. So a bucket gets at most one copy per batch of anything common.

Defined cases: null text is empty; texts under LENGTH bytes stay whole; rows with a null doc_id take
no part and stay whole; rows with equal doc_ids never remove each other; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewell.llm.common import buffer_of, id_column, map_batches, mix64, record_batch, release_memory, text_bytes, utf8

LENGTH = 50
ANCHOR = 24  # bytes of an anchor
LONGEST = 64  # windows in a stretch
PIECE = 1 << 19  # windows hashed at once
FLUSH = 1 << 19  # anchors packed at once
COMMON = 8  # documents of one batch from which an anchor counts as shared without asking
BUCKET_BYTES = 32 << 20  # corpus text for each bucket of anchors; a document is named in every bucket it has anchors in
HOME_BYTES = 16 << 20  # corpus text for each home of documents
MEETING_BYTES = 2 << 20  # corpus text for each bucket of stretches
BLOCK_BYTES = 1 << 19  # bytes of stretches in one transform
HOT_BYTES = 4 << 20  # bytes of stretches with one anchor from which its windows meet singly
COUNTER_BYTES = 1 << 15  # corpus text for each counter of the sketch
UNIT = 64  # bytes that a counter counts in
SLICES = 8  # in which the sketch is added up
WINDOWS_KEPT = 1 << 18  # different windows merged at once

_LOW = np.uint64(0xFFFFFFFF)


# ---- anchors and stretches

def _stretches(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Owner, first window, windows and anchor hash of the stretches of some short texts."""
    buf, starts = buffer_of(texts)
    n = len(buf)
    if n < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    eights = np.ndarray((n - 7,), "<u8", buf.tobytes(), strides=(1,))
    k = n - ANCHOR + 1
    h = eights[:k] * np.uint64(0x9E3779B97F4A7C15)
    h += eights[8:8 + k] * np.uint64(0xC2B2AE3D27D4EB4F)
    h += eights[16:16 + k] * np.uint64(0xD6E8FEB86659FD93)
    least = mix64(h)
    width, reach = length - ANCHOR + 1, 1
    while reach * 2 <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[:reach - width], least[width - reach:])
    sizes = np.diff(starts)
    begins = starts[:-1]
    ends = begins + np.maximum(sizes - length + 1, 0)
    change = np.ones(len(least) + 1, bool)
    change[1:-1] = least[1:] != least[:-1]
    change[begins[begins < len(least)]] = True
    change[ends[ends <= len(least)]] = True
    cuts = np.flatnonzero(change)
    first, count = cuts[:-1], np.diff(cuts)
    owner = np.searchsorted(starts, first, "right") - 1
    valid = first < ends[owner]
    first, count, owner = first[valid], count[valid], owner[valid]
    value = least[first]
    parts = -(-count // LONGEST)
    if (parts > 1).any():  # text that repeats itself: one anchor for many windows
        step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        first = np.repeat(first, parts) + step * LONGEST
        count = np.minimum(np.repeat(count, parts) - step * LONGEST, LONGEST)
        owner, value = np.repeat(owner, parts), np.repeat(value, parts)
    return owner, first - begins[owner], count, value


def stretches(texts: list[bytes], length: int = LENGTH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The stretches of all texts, a bounded number of windows at a time; long texts in overlapping pieces."""
    group, owners, offsets, total = [], [], [], 0

    def flush():
        owner, first, count, value = _stretches(group, length)
        return np.array(owners, np.int64)[owner], first + np.array(offsets, np.int64)[owner], count, value

    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - length + 1, 0), PIECE):
            group.append(text[at:at + PIECE + length - 1])
            owners.append(i)
            offsets.append(at)
            total += len(group[-1])
            if total >= PIECE:
                yield flush()
                group, owners, offsets, total = [], [], [], 0
    if group:
        yield flush()


def all_stretches(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    found = list(stretches(texts, length)) or [_stretches([], length)]
    return tuple(np.concatenate(x) for x in zip(*found))


# ---- packed rows

def planes(numbers: np.ndarray) -> bytes:
    """Numbers with all their lowest bytes first and so on, so that the zero bytes lie together and shrink in the shuffle."""
    return np.ascontiguousarray(np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.itemsize).T).tobytes()


def numbers_of(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def pack(sorted_values: np.ndarray) -> bytes:
    """Differences of ascending numbers."""
    return planes(np.diff(sorted_values, prepend=sorted_values[:0].dtype.type(0)))


def unpack(data: bytes) -> np.ndarray:
    return np.cumsum(numbers_of(data, np.uint64), dtype=np.uint64)


def hash_bits(corpus_bytes: int) -> int:
    """Bits of an anchor hash that are sent: enough that one anchor in thousands looks shared by accident."""
    return min(64, max(40, corpus_bytes.bit_length() + 10))


def bucket_of(values: np.ndarray, buckets: int, length: int) -> np.ndarray:
    """Ranges of anchor hashes. Each is the least of many, so ranges of equal width would put most of them into the first."""
    above = 1 - (values >> np.uint64(11)).astype(np.float64) / (1 << 53)
    left, power = np.ones(len(values)), length - ANCHOR + 1
    while power:  # by products alone, which every machine rounds alike
        if power & 1:
            left *= above
        above, power = above * above, power >> 1
    return np.minimum(((1 - left) * buckets).astype(np.int64), buckets - 1)


def groups(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins, and the end."""
    if not len(sorted_keys):
        return np.zeros(1, np.int64)
    return np.concatenate(([0], np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1, [len(sorted_keys)]))


KEY = "doc_id bigint, text_hash bigint"
ANCHORS = f"bucket bigint, kind int, ids binary, hashes binary, numbers binary, owners binary"


def _anchor_rows(ids: np.ndarray, hashes: np.ndarray, owner: np.ndarray, value: np.ndarray, length: int, buckets: int, bits: int) -> pa.RecordBatch:
    """Rows for the buckets: anchors with the documents that ask about them (kind 0), and those known to be shared (kind 1).

    A common anchor is sent once without asker, and its documents are told by a kind 1 row.
    """
    dropped = np.uint64(64 - bits)
    value = value >> dropped
    order = np.lexsort((owner, value))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    owner, value = owner[new], value[new]
    runs = groups(value)
    sizes = np.diff(runs)
    common = np.repeat(sizes >= COMMON, sizes)
    known_owner, known_value = owner[common], value[common]
    first = np.zeros(len(value), bool)
    first[runs[:-1]] = True
    sent = ~common | first
    asker = np.where(common, -1, owner)[sent]
    value = value[sent]
    rows = []
    where = bucket_of(value << dropped, buckets, length)
    cuts = groups(where)
    for a, b in zip(cuts[:-1], cuts[1:]):
        used, numbers = np.unique(asker[a:b], return_inverse=True)
        has_none = int(len(used) > 0 and used[0] == -1)
        docs = used[has_none:]
        rows.append((int(where[a]), 0, ids[docs].tobytes(), hashes[docs].tobytes(), pack(value[a:b]),
                     planes((numbers - has_none + 1).astype(np.uint32))))
    if len(known_owner):
        order = np.lexsort((known_value & _LOW, known_owner))
        known_owner, low = known_owner[order], (known_value[order] & _LOW).astype(np.uint32)
        cuts = groups(known_owner)
        docs = known_owner[cuts[:-1]]
        rows.append((int(ids[docs[0]]) % buckets, 1, ids[docs].tobytes(), hashes[docs].tobytes(), low.tobytes(),
                     np.diff(cuts).astype(np.int32).tobytes()))
    names = [x.split()[0] for x in ANCHORS.split(", ")]
    return record_batch(**{n: pa.array(c, t) for n, c, t in zip(
        names, zip(*rows), (pa.int64(), pa.int32(), *[pa.binary()] * 4))})


def _send_anchors(length: int, buckets: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hashes, owners, values, rows, size = [], [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            return _anchor_rows(np.concatenate(ids), np.concatenate(hashes), np.concatenate(owners), np.concatenate(values), length, buckets, bits)

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids.append(part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64))
                hashes.append(part.column("text_hash").to_numpy(zero_copy_only=False).astype(np.int64))
                for owner, _, _, value in stretches(utf8(part.column("text")), length):
                    owners.append(owner + rows)
                    values.append(value)
                    size += len(value)
                rows += part.num_rows
                if size >= FLUSH:
                    yield flush()
                    ids, hashes, owners, values, rows, size = [], [], [], [], 0, 0
            del batch, part
            release_memory()
        if size:
            yield flush()
    return run


SHARED = "home bigint, ids binary, hashes binary, sizes binary, anchors binary"


def _homeward(ids: np.ndarray, hashes: np.ndarray, sizes: np.ndarray, low: np.ndarray, homes: int) -> Iterator[tuple]:
    """One row for each home of some documents: their keys, how many anchors each has, and the anchors in a row."""
    home = (mix64(ids.view(np.uint64) ^ mix64(hashes.view(np.uint64))) % np.uint64(homes)).astype(np.int64)
    order = np.argsort(home, kind="stable")
    begins = np.cumsum(sizes) - sizes
    moved = sizes[order]
    ends = np.concatenate(([0], np.cumsum(moved)))
    low = low[np.repeat(begins[order] - ends[:-1], moved) + np.arange(ends[-1])]
    ids, hashes, home = ids[order], hashes[order], home[order]
    cuts = groups(home)
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield (int(home[a]), ids[a:b].tobytes(), hashes[a:b].tobytes(), planes(moved[a:b].astype(np.int32)), low[ends[a]:ends[b]].tobytes())


def _shared_anchors(homes: int):
    """For each home the documents of a bucket and the anchors of each that another has too."""
    def work(table: pa.Table) -> pa.Table:
        ids, hashes, owner, value, base, out = [], [], [], [], 0, []
        for row in table.to_pylist():
            i, h = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["hashes"], np.int64)
            if row["kind"]:
                sizes = np.frombuffer(row["owners"], np.int32).astype(np.int64)
                out += _homeward(i, h, sizes, np.frombuffer(row["numbers"], np.uint32), homes)
                continue
            numbers = numbers_of(row["owners"], np.uint32).astype(np.int64) - 1  # -1: no asker
            owner.append(np.where(numbers < 0, -1, numbers + base))
            value.append(unpack(row["numbers"]))
            ids.append(i)
            hashes.append(h)
            base += len(i)
        if value:
            ids, hashes, owner, value = map(np.concatenate, (ids, hashes, owner, value))
            order = np.argsort(value, kind="stable")
            owner, value = owner[order], value[order]
            sizes = np.diff(groups(value))
            # An anchor without asker stands for many documents of its batch.
            several = np.repeat(np.add.reduceat(np.where(owner < 0, 2, 1), groups(value)[:-1]) > 1, sizes) & (owner >= 0)
            owner, low = owner[several], (value[several] & _LOW).astype(np.uint32)
            order = np.argsort(owner, kind="stable")
            owner, low = owner[order], low[order]
            if len(owner):
                cuts = groups(owner)
                docs = owner[cuts[:-1]]
                out += _homeward(ids[docs], hashes[docs], np.diff(cuts), low, homes)
        columns = list(zip(*out)) or [[]] * 5
        release_memory()
        return pa.table({n.split()[0]: pa.array(c, pa.int64() if n.startswith("home") else pa.binary())
                         for n, c in zip(SHARED.split(", "), columns)})
    return work


def _asked(table: pa.Table) -> pa.Table:
    """doc_id, text_hash, anchors: one row for each document of a home."""
    ids, hashes, sizes, low = ([np.frombuffer(v, kind) for v in table.column(n).to_pylist()]
                               for n, kind in (("ids", np.int64), ("hashes", np.int64), ("sizes", np.uint8), ("anchors", np.uint32)))
    ids, hashes, low = map(np.concatenate, (ids, hashes, low))
    sizes = np.concatenate([numbers_of(x, np.int32) for x in sizes]).astype(np.int64)
    order = np.lexsort((hashes, ids))
    begins = np.cumsum(sizes) - sizes
    moved = sizes[order]
    ends = np.concatenate(([0], np.cumsum(moved)))
    data = low[np.repeat(begins[order] - ends[:-1], moved) + np.arange(ends[-1])].tobytes()
    ids, hashes = ids[order], hashes[order]
    first = np.ones(len(ids), bool)
    first[1:] = (ids[1:] != ids[:-1]) | (hashes[1:] != hashes[:-1])
    cuts = np.append(np.flatnonzero(first), len(ids))
    anchors = [data[4 * a:4 * b] for a, b in zip(ends[cuts[:-1]].tolist(), ends[cuts[1:]].tolist())]
    release_memory()
    return pa.table({"doc_id": ids[first], "text_hash": hashes[first], "anchors": pa.array(anchors, pa.binary())})


# ---- stretches that meet

STRETCHES = "bucket bigint, ids binary, hashes binary, owners binary, firsts binary, sizes binary, text binary"
SPANS = f"{KEY}, span bigint"
SIZE_BITS = 24  # a span is its begin, shifted by these, and its size


WEIGHTS = "slice int, counts binary"


def _weigh(length: int, counters: int):
    """Bytes of the stretches of a task by counter of their anchor, in slices."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(counters, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                for _, _, count, value in stretches(utf8(batch.slice(at, 500).column("text")), length):
                    slot = (value & np.uint64(counters - 1)).astype(np.int64)
                    counts += np.bincount(slot, count + length - 1, counters).astype(np.int64)
            del batch
            release_memory()
        if counts.any():
            parts = np.minimum(-(-counts // UNIT), _LOW.astype(np.int64)).astype(np.uint32).reshape(SLICES, -1)
            yield record_batch(slice=pa.array(range(SLICES), pa.int32()), counts=[zlib.compress(planes(c), 1) for c in parts])
    return run


def _heavy(least: int):
    """The counters of each slice that reach ``least`` bytes over all tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, data in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist()):
                sums[k] = sums.get(k, 0) + numbers_of(zlib.decompress(data), np.uint32).astype(np.int64)
        if sums:
            yield record_batch(slice=pa.array(list(sums), pa.int32()),
                               counts=[np.flatnonzero(c * UNIT >= least).astype(np.int64).tobytes() for c in sums.values()])
    return run


def hot_counters(plain: DataFrame, length: int, corpus_bytes: int) -> np.ndarray:
    """For each counter of the sketch whether its anchors are hot; only the numbers of those reach the driver."""
    counters = 1 << max(12, (corpus_bytes // COUNTER_BYTES).bit_length())
    weights = plain.select("text").mapInArrow(_weigh(length, counters), WEIGHTS)
    hot = np.zeros(counters, bool)
    for row in weights.repartition(SLICES, "slice").mapInArrow(_heavy(HOT_BYTES), WEIGHTS).collect():
        hot[row["slice"] * (counters // SLICES) + np.frombuffer(row["counts"], np.int64)] = True
    return hot


def _window_rows(texts, ids, hashes, owner, first, count, length: int, buckets: int) -> Iterator[tuple]:
    """Rows of single windows by a hash of their bytes, from bucket ``buckets`` on; spans settled in the batch (bucket under 0).

    Stretches come by ascending doc_id, so the first document with a window has the smallest doc_id.
    """
    compressor = zstandard.ZstdCompressor(level=3)
    number: dict[bytes, int] = {}
    least: list[int] = []
    sent, settled = [], []

    def flush() -> Iterator[tuple]:
        if sent:
            content, o, f = np.array(sent, np.int64).T
            parts = list(number)
            bucket = buckets + np.fromiter((zlib.crc32(w) * buckets >> 32 for w in parts), np.int64, len(parts))[content]
            order = np.argsort(bucket, kind="stable")
            cuts = groups(bucket[order])
            for a, b in zip(cuts[:-1], cuts[1:]):
                mine = order[a:b]
                used, owners = np.unique(o[mine], return_inverse=True)
                different, which = np.unique(content[mine], return_inverse=True)
                yield (int(bucket[mine[0]]), ids[used].tobytes(), hashes[used].tobytes(), planes(owners.astype(np.int32)),
                       planes(f[mine]), planes(which.astype(np.int32)), compressor.compress(b"".join(parts[k] for k in different.tolist())))
        if settled:
            o, f, c = np.array(settled, np.int64).T
            used, owners = np.unique(o, return_inverse=True)
            yield (-1 - int(ids[used[0]] % buckets), ids[used].tobytes(), hashes[used].tobytes(), planes(owners.astype(np.int32)),
                   planes(f), planes(c.astype(np.int32)), b"")
        number.clear()
        least.clear()
        sent.clear()
        settled.clear()

    for o, f, c in zip(owner.tolist(), first.tolist(), count.tolist()):
        doc, text, begin = int(ids[o]), texts[o], None  # begin: of the windows settled one after another
        for at in range(f, f + c):
            k = number.setdefault(text[at:at + length], len(number))
            if k == len(least):
                least.append(doc)
            if least[k] < doc:
                begin = at if begin is None else begin
                continue
            if begin is not None:
                settled.append((o, begin, at - begin))
                begin = None
            sent.append((k, o, at))
        if begin is not None:
            settled.append((o, begin, f + c - begin))
        if len(number) >= WINDOWS_KEPT or len(sent) + len(settled) >= 4 * WINDOWS_KEPT:
            yield from flush()
    yield from flush()


def _send_stretches(length: int, buckets: int, bits: int, hot: Broadcast):
    """Stretches with shared anchors, by bucket; those that a smaller doc_id of the batch has too are settled here (bucket -1).

    Of hot anchors the single windows go out, in buckets of their own.
    """
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = utf8(batch.column("text"))
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        hashes = batch.column("text_hash").to_numpy(zero_copy_only=False).astype(np.int64)
        owner, first, count, value = all_stretches(texts, length)
        asked = [np.frombuffer(a, np.uint32).astype(np.uint64) | np.uint64(i << 32)
                 for i, a in enumerate(batch.column("anchors").to_pylist())]
        asked = np.unique(np.concatenate(asked))
        wanted = (owner.astype(np.uint64) << np.uint64(32)) | ((value >> np.uint64(64 - bits)) & _LOW)
        near = np.minimum(np.searchsorted(asked, wanted), len(asked) - 1)
        hit = asked[near] == wanted
        owner, first, count, value = owner[hit], first[hit], count[hit], value[hit]
        order = np.lexsort((first, ids[owner]))  # smallest doc_id first
        split = hot.value[(value[order] & np.uint64(len(hot.value) - 1)).astype(np.int64)]
        alone, order = order[split], order[~split]
        seen: dict[bytes, int] = {}
        sent, settled = [], []
        for k, o, f, c in zip(order.tolist(), owner[order].tolist(), first[order].tolist(), count[order].tolist()):
            part = texts[o][f:f + c + length - 1]
            doc = seen.setdefault(part, int(ids[o]))
            if doc < ids[o]:
                settled.append((o, f, c))
            else:
                sent.append((k, part))
        rows, compressor = [], zstandard.ZstdCompressor(level=3)
        if sent:
            index = np.array([k for k, _ in sent])
            where = bucket_of(value[index], buckets, length)
            order = np.argsort(where, kind="stable")
            cuts = groups(where[order])
            for a, b in zip(cuts[:-1], cuts[1:]):
                mine = order[a:b]
                at = index[mine]
                used, numbers = np.unique(owner[at], return_inverse=True)
                parts = [sent[j][1] for j in mine.tolist()]
                rows.append((int(where[order[a]]), ids[used].tobytes(), hashes[used].tobytes(), planes(numbers.astype(np.int32)),
                             planes(first[at].astype(np.int64)), planes(np.fromiter(map(len, parts), np.int32)),
                             compressor.compress(b"".join(parts))))
        if settled:
            o, f, c = np.array(settled, np.int64).T
            used, numbers = np.unique(o, return_inverse=True)
            rows.append((-1 - int(ids[used[0]] % buckets), ids[used].tobytes(), hashes[used].tobytes(),
                         planes(numbers.astype(np.int32)), planes(f), planes(c.astype(np.int32)), b""))
        rows += _window_rows(texts, ids, hashes, owner[alone], first[alone], count[alone], length, buckets)
        names = [x.split()[0] for x in STRETCHES.split(", ")]
        columns = list(zip(*rows)) or [[]] * len(names)
        return record_batch(**{n: pa.array(c, pa.int64() if n == "bucket" else pa.binary()) for n, c in zip(names, columns)})
    return work


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Rows of the suffix array of a circular text, sorted by the first ``depth`` symbols or more (prefix doubling)."""
    n = len(text)
    key = text.astype(np.int64)
    for k in (1, 2, 3):
        key = (key << 9) | np.roll(text, -k)
    reach = 4
    while True:
        order = np.argsort(key)
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], ranked[1:] != ranked[:-1])))
        if reach >= depth or rank[order[-1]] == n - 1:
            return order
        key = (rank << 32) | np.roll(rank, -reach)
        reach *= 2


def intervals(bwt: np.ndarray, length: int) -> np.ndarray:
    """For each row of a Burrows-Wheeler transform the number of its interval of ``length`` common symbols.

    The positions of a character in the transform, in order, are the rows that begin with it. Two
    neighbours of them fall apart at length l + 1 exactly if the rows they come from are in different
    intervals of length l. So each round extends all intervals of a length backwards and finds the rows
    whose common prefix with the row above has that very length; only rows still undecided are looked at.
    """
    n = len(bwt)
    source = np.argsort(bwt, kind="stable").astype(np.int32)
    symbol = bwt[source]
    bound = np.ones(n, bool)
    bound[1:] = symbol[1:] != symbol[:-1]
    undecided = np.flatnonzero(~bound)
    here, above = source[undecided], source[undecided - 1]
    for _ in range(length - 1):
        number = np.cumsum(bound, dtype=np.int32)
        apart = number[here] != number[above]
        if apart.any():
            bound[undecided[apart]] = True
            undecided, here, above = undecided[~apart], here[~apart], above[~apart]
        if not len(undecided):
            break
    return np.cumsum(bound) - 1


def smallest_ids(parts: list[bytes], ids: np.ndarray, length: int) -> list[np.ndarray]:
    """For each window of each text: the smallest id of a text that has it. Texts are compared on one transform."""
    if not parts:
        return []
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    starts = np.cumsum(sizes) - sizes
    text = np.zeros(int(sizes.sum()), np.uint16)  # 0 separates, a byte is itself plus 1
    inside = np.ones(len(text), bool)
    inside[starts + sizes - 1] = False
    text[inside] = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint16) + 1
    rows = suffix_order(text, length + 1)
    number = intervals(text[rows - 1], length)
    part = np.repeat(np.arange(len(parts)), sizes)
    place = np.arange(len(text)) - starts[part]
    window = place <= (sizes[part] - 1 - length)
    owner = np.where(window, ids[part], np.iinfo(np.int64).max)
    least = np.minimum.reduceat(owner[rows], groups(number)[:-1])
    found = np.empty(len(text), np.int64)
    found[rows] = least[number]
    return np.split(found[window], np.cumsum(sizes - length)[:-1])


def _span_rows(ids: np.ndarray, hashes: np.ndarray, owner: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Table:
    """One row per span. Their number follows from the texts alone; rows per document and bucket would grow with the buckets."""
    return pa.table({"doc_id": ids[owner], "text_hash": hashes[owner], "span": (begin << SIZE_BITS) | (end - begin)})


def _met_windows(rows: list[dict], length: int) -> pa.Table:
    """Spans of the windows of a bucket that a smaller doc_id has too."""
    number: dict[bytes, int] = {}
    ids, hashes, content, first = [], [], [], []
    for row in rows:
        owner = numbers_of(row["owners"], np.int32).astype(np.int64)
        ids.append(np.frombuffer(row["ids"], np.int64)[owner])
        hashes.append(np.frombuffer(row["hashes"], np.int64)[owner])
        first.append(numbers_of(row["firsts"], np.int64))
        text = zstandard.decompress(row["text"])
        mine = np.array([number.setdefault(text[a:a + length], len(number)) for a in range(0, len(text), length)], np.int64)
        content.append(mine[numbers_of(row["sizes"], np.int32)])
    ids, hashes, content, first = map(np.concatenate, (ids, hashes, content, first))
    least = np.full(len(number), np.iinfo(np.int64).max)
    np.minimum.at(least, content, ids)
    gone = np.flatnonzero(least[content] < ids)
    return _span_rows(ids, hashes, gone, first[gone], first[gone] + length)


def _met_stretches(length: int, buckets: int):
    def work(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() >= buckets:
            out = _met_windows(table.to_pylist(), length)
            release_memory()
            return out
        none = np.zeros(0, np.int64)
        out = [_span_rows(none, none, none, none, none)]
        ids, hashes, owner, first, parts, base = [], [], [], [], [], 0
        for row in table.to_pylist():
            i, h = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["hashes"], np.int64)
            o, f = numbers_of(row["owners"], np.int32).astype(np.int64), numbers_of(row["firsts"], np.int64)
            sizes = numbers_of(row["sizes"], np.int32).astype(np.int64)
            if row["bucket"] < 0:
                out.append(_span_rows(i, h, o, f, f + sizes + length - 1))
                continue
            at, text = np.concatenate(([0], np.cumsum(sizes))), zstandard.decompress(row["text"])
            parts += [text[a:b] for a, b in zip(at[:-1], at[1:])]
            ids.append(i)
            hashes.append(h)
            owner.append(o + base)
            first.append(f)
            base += len(i)
        if parts:
            ids, hashes, owner, first = map(np.concatenate, (ids, hashes, owner, first))
            out.append(_span_rows(ids, hashes, *_removed(parts, ids[owner], owner, first, length)))
        release_memory()
        return pa.concat_tables(out)
    return work


def _removed(parts: list[bytes], doc: np.ndarray, owner: np.ndarray, first: np.ndarray, length: int):
    """Owner, begin and end of the byte spans that a smaller doc_id has too.

    Equal stretches are one. One whose anchor no other has shares no window with another: its smallest doc_id holds
    for all its windows. The anchors of the others decide their blocks, and blocks get a transform each.
    """
    number: dict[bytes, int] = {}
    content = np.fromiter((number.setdefault(p, len(number)) for p in parts), np.int64, len(parts))
    distinct = list(number)
    least = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(least, content, doc)
    anchor = np.concatenate([_first_anchors(distinct[a:a + 4096], length) for a in range(0, len(distinct), 4096)])
    _, which, times = np.unique(anchor, return_inverse=True, return_counts=True)
    bytes_of = np.fromiter(map(len, distinct), np.int64, len(distinct))
    sizes = bytes_of - length + 1
    at = np.cumsum(sizes) - sizes
    flat = np.repeat(least, sizes)
    meet = np.flatnonzero(times[which] > 1)
    blocks = max(1, -(-int(bytes_of[meet].sum()) // BLOCK_BYTES))
    block = (mix64(anchor[meet]) % np.uint64(blocks)).astype(np.int64)
    for b in range(blocks):
        mine = meet[block == b]
        if len(mine):
            found = smallest_ids([distinct[k] for k in mine.tolist()], least[mine], length)
            n = sizes[mine]
            flat[np.repeat(at[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())] = np.concatenate(found)
    owners, begins, ends = [], [], []
    for a in range(0, len(parts), 65536):  # a bounded number of occurrences at a time
        c = content[a:a + 65536]
        reps = sizes[c]
        step = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
        gone = flat[np.repeat(at[c], reps) + step] < np.repeat(doc[a:a + 65536], reps)
        who, where = np.repeat(np.arange(len(c)), reps)[gone], step[gone]
        cut = np.ones(len(who), bool)
        cut[1:] = (who[1:] != who[:-1]) | (where[1:] != where[:-1] + 1)
        begin = np.flatnonzero(cut)
        end = np.concatenate((begin[1:], [len(who)])) - 1 if len(who) else begin
        w = who[begin] + a
        owners.append(owner[w])
        begins.append(first[w] + where[begin])
        ends.append(first[w] + where[end] + length)
    return np.concatenate(owners), np.concatenate(begins), np.concatenate(ends)


def _first_anchors(parts: list[bytes], length: int) -> np.ndarray:
    """The anchor hash of each stretch: all its windows have the same."""
    return np.concatenate([_stretches([p[:length] for p in parts], length)[3]])


# ---- the operator

def meeting_rows(plain: DataFrame, asked: DataFrame, hot: np.ndarray, length: int, meetings: int, bits: int) -> DataFrame:
    """The stretches, and of hot anchors the windows, in the buckets where equal ones meet."""
    sent = plain.sparkSession.sparkContext.broadcast(hot)
    return map_batches(plain.join(asked, ["doc_id", "text_hash"]), _send_stretches(length, meetings, bits, sent), STRETCHES, 4 << 20)


def removed_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, text_hash, text, spans (list of begin << SIZE_BITS | size, may overlap; null if none) for every row."""
    if not ANCHOR + 8 <= length <= 1 << 20:
        raise ValueError(f"strings must have {ANCHOR + 8} to {1 << 20} bytes")
    every = docs.select(id_column(docs), "text", F.xxhash64("text").alias("text_hash"))
    plain = every.where("doc_id IS NOT NULL")  # the same frame on both sides of the work, so it is shuffled once
    size = text_bytes(docs)
    buckets, bits = max(1, -(-size // BUCKET_BYTES)), hash_bits(size)
    anchors = plain.where(F.octet_length("text") >= length).mapInArrow(_send_anchors(length, buckets, bits), ANCHORS)
    shared = anchors.groupBy("bucket").applyInArrow(_shared_anchors(max(1, -(-size // HOME_BYTES))), SHARED)
    asked = shared.groupBy("home").applyInArrow(_asked, f"{KEY}, anchors binary")
    meetings = max(1, -(-size // MEETING_BYTES))
    meeting = meeting_rows(plain, asked, hot_counters(plain.where(F.octet_length("text") >= length), length, size), length, meetings, bits)
    spans = meeting.groupBy("bucket").applyInArrow(_met_stretches(length, meetings), SPANS)
    found = spans.groupBy("doc_id", "text_hash").agg(F.collect_list("span").alias("spans"))
    whole = every.where("doc_id IS NULL").withColumn("spans", F.lit(None).cast("array<bigint>"))
    return plain.join(found, ["doc_id", "text_hash"], "left").unionByName(whole)


def cut(text: bytes, spans: list[int]) -> tuple[bytes, int, int]:
    """What is left of a text, bytes removed, and maximal removed runs."""
    kept, at, runs = [], 0, 0
    for span in sorted(spans):
        begin = span >> SIZE_BITS
        end = begin + (span & ((1 << SIZE_BITS) - 1))
        if begin > at or not runs:
            kept.append(text[at:begin])
            runs += 1
            at = end
        at = max(at, end)
    kept.append(text[at:])
    left = b"".join(kept)
    return left, len(text) - len(left), runs


def digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = utf8(batch.column("text"))
        done = [cut(t, s) if s else (t, 0, 0) for t, s in zip(texts, batch.column("spans").to_pylist())]
        return record_batch(doc_id=batch.column("doc_id"), n_bytes=list(map(len, texts)), n_removed=[d[1] for d in done],
                            n_spans=[d[2] for d in done], kept_sha256=[hashlib.sha256(d[0]).hexdigest() for d in done])

    return map_batches(removed_spans(docs, length).select("doc_id", "text", "spans"), work,
                       "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string", 8 << 20)
