"""Token ids in length-delimited binary records.

Data file: one record per document, in ascending doc_id order:
    8 bytes  length of the payload, little endian
    4 bytes  masked CRC-32 of those 8 bytes
    payload  the ids, little endian, 2 bytes each where the vocabulary allows it, else 4
    4 bytes  masked CRC-32 of the payload
A checksum is masked by rotating it right by 15 bits and adding 0xA282EAD8, so that a checksum of
data that holds checksums stays sound. Index file, apart from the data: for each record doc_id (8
bytes) and its offset in the data file (8 bytes), so records can be read in any order. Row 0 of an
index holds the width of an id and the number of records.

Files carry a random part in their names; the manifest (a table) lists those of the tasks that
succeeded, so files of lost or repeated tasks are never read.

Defined cases: a null or empty text is the end id alone; a null doc_id sorts first and is read back
as null; equal doc_ids are ordered by text; an empty table gives no files; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewell.llm.common import ASCII_LOWER, record_batch, release_memory, slices, text_bytes, utf8
from tradewell.session import materialise, new_path

FILE_BYTES = 32 << 20  # text that goes to one data file
SLICE_BYTES = 2 << 20  # text that a task holds at once
WORDS_KEPT = 150_000  # in each of two generations
NO_ID = -(1 << 63)  # stands for a null doc_id in an index


# How word_bpe_49k.json parts words, and words that it parts into small letters of Latin-1 and marks of ASCII at most.
PARTED = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
PLAIN = re.compile(rb"((?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])*)([!-/:-@\[-`{-~]*)")


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return b"".join((head, struct.pack("<I", masked(head)), payload, struct.pack("<I", masked(payload))))


def payload_size(data: bytes, at: int = 0) -> int:
    """What the head of the record at ``at`` says; a wrong checksum raises."""
    n, check = struct.unpack_from("<QI", data, at)
    if masked(data[at:at + 8]) != check:
        raise ValueError(f"length of the record at {at} is damaged")
    return n


def unframe(data: bytes, at: int) -> bytes:
    """The payload of the record that begins at ``at``; a wrong checksum raises."""
    n = payload_size(data, at)
    payload = data[at + 12:at + 12 + n]
    if len(payload) != n or masked(payload) != struct.unpack_from("<I", data, at + 12 + n)[0]:
        raise ValueError(f"record at {at} is damaged")
    return payload


def _steps(part, kind: str) -> list[dict]:
    """The steps of a tokenizer's normaliser or pre-tokenizer, where it is a sequence."""
    return [] if part is None else json.loads(part.__getstate__()).get(kind, [])


class Encoder(dict):
    """Ids of words as bytes, asked of the tokenizer on first use; when full, words not used since it was last full go.

    The tokenizer splits at white space first, so a text's ids are those of its words in a row. It reads
    lower case, so words that differ in case are one, unless special strings may be among them; and it
    parts a last comma or full stop from a letter or digit. Where it parts words as ``PARTED`` says, a run
    of letters and a run of marks go to its model as they are, without its normaliser and pattern.
    """

    def __init__(self, path: str):
        super().__init__()
        self.older: dict[bytes, bytes] = {}
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        normal = self.tokenizer.normalizer
        self.lowers = normal is not None and normal.normalize_str("AZ") == "az"
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.model = self.tokenizer.model
        parts, cleans = _steps(self.tokenizer.pre_tokenizer, "pretokenizers"), _steps(normal, "normalizers")
        self.parted = ([p["type"] for p in parts] == ["Split", "ByteLevel"] and parts[0]["pattern"] == {"Regex": PARTED}
                       and not parts[1]["add_prefix_space"] and not parts[1]["use_regex"] and isinstance(self.model, models.BPE)
                       and [n["type"] for n in cleans] == ["NFC", "Replace", "Lowercase"]
                       and all(t.special and t.content.startswith("<|") for t in self.tokenizer.get_added_tokens_decoder().values()))
        symbols = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.symbols = {ord(c): symbols.pre_tokenize_str(c)[0][0] for c in LETTERS}

    def __missing__(self, word: bytes) -> bytes:
        found = self.older.pop(word, None)
        self[word] = found = self.ask(word) if found is None else found
        return found

    def ask(self, word: bytes) -> bytes:
        if self.parted and (plain := PLAIN.fullmatch(word)):
            letters, marks = plain.groups()
            if letters and marks:
                return self[letters] + self[marks]
            told = self.model.tokenize(word.decode().translate(self.symbols))
            return struct.pack(f"<{len(told)}{self.code}", *[t.id for t in told])
        if word[-1:] in (b",", b".") and word[-2:-1].isalnum():
            return self[word[:-1]] + self[word[-1:]]
        return np.array(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids, self.kind).tobytes()

    def encode(self, text: bytes, end_id: int) -> bytes:
        if len(self) > WORDS_KEPT:
            self.older = dict(self)
            self.clear()
        if self.lowers and b"<|" not in text:
            text = text.translate(ASCII_LOWER)
        return b"".join(map(self.__getitem__, text.split())) + np.array([end_id], self.kind).tobytes()


@lru_cache(2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def write(docs: DataFrame, vocabulary: str, end_id: int, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Encode and write all documents; returns the manifest: part, name, records, ids.

    Ranges of doc_id become files; ``folder`` is a place that all executors reach.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, place, root = _encoder(vocabulary), *fs.FileSystem.from_uri(folder)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        index, at, ids, data = [], 0, 0, None
        for batch in batches:
            for piece in slices(batch, SLICE_BYTES):
                for doc, text in zip(piece.column("doc_id").to_pylist(), utf8(piece.column("text"))):
                    if data is None:
                        place.create_dir(root, recursive=True)
                        data = place.open_output_stream(f"{root}/{name}.rec", compression=None)
                    payload = encoder.encode(text, end_id)
                    index.append((NO_ID if doc is None else doc, at))
                    data.write(record := frame(payload))
                    at += len(record)
                    ids += len(payload) // encoder.kind.itemsize
                del piece
            del batch
            release_memory()
        if data is not None:
            data.close()
            with place.open_output_stream(f"{root}/{name}.idx", compression=None) as f:
                f.write(np.array([(encoder.kind.itemsize, len(index)), *index], "<i8").tobytes())
            yield record_batch(part=[part], name=[name], records=[len(index)], ids=[ids])

    parts = max(1, -(-text_bytes(docs) // file_bytes))
    rows = docs.select(F.col("doc_id").cast("bigint"), "text").repartitionByRange(parts, "doc_id")
    return materialise(rows.sortWithinPartitions("doc_id", "text").mapInArrow(
        run, "part bigint, name string, records bigint, ids bigint"), "record-manifest")


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32, from the files of the manifest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with place.open_input_file(f"{root}/{row['name']}.idx") as f:
                    index = np.frombuffer(f.read(), "<i8").reshape(-1, 2)
                width, n = index[0].tolist()
                sizes, crcs, place_in = [], [], 0
                with place.open_input_stream(f"{root}/{row['name']}.rec", compression=None, buffer_size=1 << 20) as f:
                    for at in index[1:, 1].tolist():
                        if at != place_in:
                            raise ValueError(f"the index of {row['name']} has a record at {at}, the file at {place_in}")
                        head = f.read(12)
                        record = head + f.read(payload_size(head) + 4)
                        place_in += len(record)
                        ids = np.frombuffer(unframe(record, 0), f"<u{width}")
                        sizes.append(len(ids))
                        crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                if len(sizes) != n or n != row["records"] or sum(sizes) != row["ids"]:
                    raise ValueError(f"{row['name']} does not hold what the manifest says")
                docs = index[1:, 0]
                starts = row["base"] + np.concatenate(([0], np.cumsum(sizes)[:-1]))
                yield record_batch(doc_id=pa.array(docs, mask=docs == NO_ID), start=starts, n_tokens=sizes, ids_crc32=crcs)

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    spread = files.repartition(max(1, min(manifest.count(), 10_000)), "part")
    return spread.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def read_records(folder: str, name: str, numbers: list[int]) -> list[tuple[int | None, np.ndarray]]:
    """Single records of a file by number, in the order asked: a shuffled read by way of the index."""
    place, root = fs.FileSystem.from_uri(folder)
    with place.open_input_file(f"{root}/{name}.idx") as f:
        index = np.frombuffer(f.read(), "<i8").reshape(-1, 2)
    out, width = [], int(index[0, 0])
    with place.open_input_file(f"{root}/{name}.rec") as f:
        for k in numbers:
            doc, at = index[k + 1].tolist()
            n = struct.unpack("<Q", f.read_at(8, at))[0]
            out.append((None if doc == NO_ID else doc, np.frombuffer(unframe(f.read_at(n + 16, at), 0), f"<u{width}")))
    return out


def round_trip(docs: DataFrame, vocabulary: str, end_id: int = 2) -> DataFrame:
    """Write to a new shared folder and read back."""
    folder = new_path(docs.sparkSession, "records")
    return read(write(docs, vocabulary, end_id, folder), folder)
