"""API pages: any number of JSON objects back to back in a text file.

Spark's JSON readers see only the first of several objects in a document or on a line, so files are
read as text, in stretches that end at a closing brace. Spark splits a large file between tasks at
such places. A task cannot know whether its block begins inside a page or inside a string, so the
blocks are read twice:

1. Each block reports what it does to both: for a begin outside and inside a string, the state and the
   change of depth at its end, and the least depth after a closing bracket. One row per block.
2. The blocks of a file are put in order and these reports are chained, which gives every block its
   true begin.
3. Each task cuts its block where the depth returns to nothing. What lies before the first and after the
   last such place goes, by file and block, to where its other parts go and is joined.

Tasks only find where one page ends and the next begins and hand on the text of each page as it is;
records are taken out of it and typed in the JVM, so all digits are kept. A page must fit a task, a
file need not. Compressed files are one block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewell.config import EXPECTED_API_ROWS
from tradewell.session import materialise

NEXT_LINK = "@odata.nextLink"
STRING = r'"(?:[^"\\]|\\.)*"'
# What may move a page boundary: a whole string (brackets inside do not count) or a bracket.
_MARKS = re.compile(STRING + r'|[][{}"]', re.DOTALL)
# The rest of a string that has begun, and a run of backslashes at an end.
_REST, _ESCAPES = re.compile(r'(?:[^"\\]|\\.)*"', re.DOTALL), re.compile(r"\\*\Z")
_STRINGS = re.compile(STRING, re.DOTALL)
# What may stand between pages: blanks and values that are neither an object nor a list.
_BETWEEN = re.compile(r'(?:\s|' + STRING + r'|-?\d[\d.eE+-]*|true|false|null)*', re.DOTALL)
_STEP = np.zeros(256, np.int64)
_STEP[list(b"{[")], _STEP[list(b"}]")] = 1, -1
OUTSIDE, INSIDE, ESCAPED = 0, 1, 2  # of a string; escaped: after a backslash in one
NONE = 1 << 40  # the least depth after a closing bracket where there is none


# ---- pages of one text --------------------------------------------------------------------------

def _skip_string(text: str, state: int) -> int | None:
    """Where the string that a text begins in is over, if it is."""
    if state == OUTSIDE:
        return 0
    found = _REST.match(text, 1 if state == ESCAPED else 0)
    return found.end() if found else None


def _state_in_string(text: str, state: int) -> int:
    """The state at the end of a text that never leaves the string it begins in."""
    escapes = len(_ESCAPES.search(text).group()) + (state == ESCAPED and set(text) <= {"\\"})
    return ESCAPED if escapes % 2 else INSIDE


def effect(text: str, state: int) -> tuple[int, int, int]:
    """State at the end, change of depth, least change after a closing bracket, for a text that begins in a state."""
    begin = _skip_string(text, state)
    if begin is None:
        return _state_in_string(text, state), 0, NONE
    bare = _STRINGS.sub("", text[begin:])
    open_, end = bare.find('"'), OUTSIDE
    if open_ >= 0:
        end, bare = _state_in_string(bare[open_ + 1:], INSIDE), bare[:open_]
    steps = _STEP[np.frombuffer(bare.encode("utf-8", "replace"), np.uint8)]
    depth = np.cumsum(steps)
    closed = depth[steps < 0]
    return end, int(depth[-1]) if len(depth) else 0, int(closed.min()) if len(closed) else NONE


class Cutter:
    """Cuts a stream of text where the depth returns to nothing."""

    def __init__(self, state: int = OUTSIDE, depth: int = 0, at: int = 0):
        self.state, self.depth, self.at = state, depth, at
        self.held: list[str] = []  # since the last cut

    def feed(self, text: str) -> Iterator[str]:
        """The stretches that end in ``text``, each up to the end of one page."""
        begin = _skip_string(text, self.state)
        if begin is None:
            self.state = _state_in_string(text, self.state)
            self.held.append(text)
            return
        self.state, cut = OUTSIDE, 0
        for mark in _MARKS.finditer(text, begin):
            sign = mark.group()
            if sign == '"':
                self.state = _state_in_string(text[mark.end():], INSIDE)
                break
            if sign in "{[":
                self.depth += 1
            elif sign in "}]":
                self.depth -= 1
                if self.depth < 0:
                    raise ValueError(f"bad JSON: brackets do not match near character {self.at + mark.start()}")
                if self.depth == 0:
                    yield "".join([*self.held, text[cut:mark.end()]])
                    self.held, cut = [], mark.end()
        self.held.append(text[cut:])
        self.at += len(text)

    def rest(self) -> str:
        return "".join(self.held)


_FIRST = re.compile(r'(?:[^][{}"]|' + STRING + r')*', re.DOTALL)


def page_of(stretch: str) -> str | None:
    """The page that a stretch ends in. A leading byte order mark and other outermost values are passed over."""
    text = stretch.removeprefix("\ufeff")
    before = _FIRST.match(text).end()
    if not _BETWEEN.fullmatch(text[:before]):
        raise ValueError(f"bad JSON between pages: {text[:before][:50]!r}")
    return text[before:] or None


def page_texts(text: str) -> Iterator[str]:
    """The text of every outermost object or list, in order; an unfinished page is an error."""
    cutter = Cutter()
    for stretch in cutter.feed(text):
        yield page_of(stretch)
    if cutter.depth or cutter.state != OUTSIDE:
        raise ValueError("bad JSON: brackets do not match or a string does not end")
    if page_of(cutter.rest()):
        raise ValueError("bad JSON: brackets do not match")


# ---- pages of files -----------------------------------------------------------------------------

REPORT = ("file string, block bigint, size bigint, chars bigint, bytes bigint, "
          + ", ".join(f"end{s} int, delta{s} bigint, low{s} bigint" for s in (OUTSIDE, INSIDE, ESCAPED)))
BEGIN = "file string, block bigint, state int, depth bigint, at bigint, chain bigint, cut_end boolean, is_last boolean"
PIECE = "file string, at bigint, chain bigint, block bigint, part int, is_last boolean, text string"


def _blocks(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, str, bool]]:
    """Runs of rows of one block: the rows, their text, whether the block begins with them."""
    last = None
    for frame in frames:
        keys = frame["file"] + ":" + frame["block"].astype(str)
        for k, rows in frame.groupby((keys != keys.shift()).cumsum(), sort=False):
            key = keys[rows.index[0]]
            yield rows, "}".join([*rows["value"], ""]), key != last
            last = key


def _report(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What each block does to the state and the depth."""
    held: dict | None = None
    for rows, text, fresh in _blocks(frames):
        if fresh:
            if held:
                yield _reported(held)
            first = rows.iloc[0]
            held = {"file": first["file"], "block": first["block"], "size": first["size"], "chars": 0, "bytes": 0,
                    "effects": [(s, 0, NONE) for s in (OUTSIDE, INSIDE, ESCAPED)]}
        held["chars"] += len(text)
        held["bytes"] += len(text.encode("utf-8", "replace"))
        known = {s: effect(text, s) for s in {e[0] for e in held["effects"]}}
        held["effects"] = [(known[s][0], delta + known[s][1], min(low, delta + known[s][2])) for s, delta, low in held["effects"]]
    if held:
        yield _reported(held)


def _reported(held: dict) -> pd.DataFrame:
    effects = {f"{n}{s}": [v] for s, e in enumerate(held["effects"]) for n, v in zip(("end", "delta", "low"), e)}
    return pd.DataFrame({**{c: [held[c]] for c in ("file", "block", "size", "chars", "bytes")}, **effects})


def _chain(blocks: pd.DataFrame) -> pd.DataFrame:
    """The true begin of each block of one file.

    Every stretch was given a brace at its end; the last one of a file has none if the bytes say so (three
    fewer where a byte order mark was skipped), or, in a compressed file, if it closes one bracket too many.
    """
    state, depth, at, chain, rows = OUTSIDE, 0, 0, -1, []
    blocks = blocks.sort_values("block")
    total, size = int(blocks["bytes"].sum()), int(blocks["size"].iloc[0])
    for i, b in enumerate(blocks.itertuples()):
        end, delta, low = (getattr(b, f"{n}{state}") for n in ("end", "delta", "low"))
        is_last = i == len(blocks) - 1
        extra = is_last and (total in (size + 1, size - 2) or (total not in (size, size - 3) and depth + delta < 0))
        rows.append((b.file, b.block, state, depth, at, chain, extra, is_last))
        state, depth, at, chain = end, depth + delta, at + b.chars, b.block if depth + low <= 0 else chain
    return pd.DataFrame(rows, columns=["file", "block", "state", "depth", "at", "chain", "cut_end", "is_last"])


def _pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The parts of every block: before its first cut (0), between cuts (1, whole pages), after its last cut (2)."""
    columns = ["file", "at", "chain", "block", "part", "is_last", "text"]
    cutter, begin, cuts, kept = None, None, 0, ""

    def finished() -> pd.DataFrame:
        # Before the first cut of a block that has none, all of it is one part of a longer chain.
        chain = begin.block if cuts else begin.chain
        return pd.DataFrame([(begin.file, cutter.at, chain, begin.block, 2 if cuts else 0, begin.is_last, cutter.rest())], columns=columns)

    def cut(text: str) -> Iterator[pd.DataFrame]:
        nonlocal cuts
        rows = []
        for stretch in cutter.feed(text):
            rows.append((begin.file, cutter.at, begin.chain if not cuts else begin.block, begin.block, 0 if not cuts else 1, False, stretch))
            cuts += 1
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    for rows, text, fresh in _blocks(frames):
        if fresh:
            if begin is not None:
                yield from cut(kept[:-1] if begin.cut_end else kept)
                yield finished()
            begin = next(rows.itertuples())
            cutter, cuts, kept = Cutter(begin.state, begin.depth, begin.at), 0, ""
        yield from cut(kept)  # one run behind, as the last brace of a file may not be there
        kept = text
    if begin is not None:
        yield from cut(kept[:-1] if begin.cut_end else kept)
        yield finished()


def _page_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """file, at, text of the page in each stretch."""
    for frame in frames:
        pages = [page_of(t) for t in frame["text"]]
        found = [p is not None for p in pages]
        yield pd.DataFrame({"file": frame["file"][found], "at": frame["at"][found], "text": [p for p in pages if p is not None]})


def _joined_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The same for stretches joined from several blocks, among them what follows the last page of a file."""
    for frame in frames:
        rows = [(f, at, p) for f, at, t in zip(frame["file"], frame["at"], frame["text"]) for p in page_texts(t)]
        yield pd.DataFrame(rows, columns=["file", "at", "text"])


def page_rows(spark: SparkSession, path: str) -> DataFrame:
    """file, at (about how many characters precede it) and text of every page."""
    stretches = (spark.read.option("recursiveFileLookup", True).option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"), "value"))
    begins = materialise(stretches.mapInPandas(_report, REPORT).groupBy("file").applyInPandas(_chain, BEGIN), "page-blocks")
    # One row for each block of a hundred megabytes or so; a sorted join would lose the order inside blocks.
    told = stretches.drop("size").join(F.broadcast(begins), ["file", "block"])
    pieces = materialise(told.mapInPandas(_pieces, PIECE), "page-pieces")
    whole = pieces.where("part = 1").select("file", "at", "text").mapInPandas(_page_rows, "file string, at bigint, text string")
    parts = F.sort_array(F.collect_list(F.struct("block", "part", "text")))
    joined = pieces.where("part <> 1").groupBy("file", "chain").agg(F.min("at").alias("at"), F.array_join(
        F.transform(parts, lambda p: p["text"]), "").alias("text"))
    return whole.union(joined.select("file", "at", "text").mapInPandas(_joined_rows, "file string, at bigint, text string"))


def _pages(spark: SparkSession, path: str) -> DataFrame:
    """file, at, text, is_object, value (text of the record list, null if there is none), next_link."""
    envelope = T.StructType([T.StructField(c, T.StringType()) for c in ("value", NEXT_LINK, "_broken")])
    read = page_rows(spark, path).withColumn("e", F.from_json("text", envelope, {"columnNameOfCorruptRecord": "_broken"}))
    is_object = F.col("text").startswith("{")
    bad = is_object & F.col("e._broken").isNotNull()
    message = F.concat(F.lit("bad JSON in the page near character "), F.col("at").cast("string"), F.lit(" of "), F.col("file"))
    value = F.when(bad, F.raise_error(message)).when(is_object & F.col("e.value").startswith("["), F.col("e.value"))
    return read.select("file", "at", "text", is_object.alias("is_object"), value.cast("string").alias("value"),
                       F.when(is_object, F.nullif(F.col(f"e.`{NEXT_LINK}`"), F.lit(""))).alias("next_link"))


def read_pages(spark: SparkSession, path: str, types: dict[str, str] | None = None, require_rows: bool = True) -> DataFrame:
    """S04 + P07: all records of all pages of all files, typed.

    Fields declared decimal are read as such, with all their digits. Every other field is first taken
    as text, so 3 and 3.0 in the same field both arrive and whole numbers keep all digits; the declared
    type follows by a lenient cast. Spark's text of an unquoted fraction is that of a double (1.50 reads
    1.5). Without declared types, every field that any record has is returned as text.
    """
    pages = _pages(spark, path)
    each = F.from_json("value", "array<string>")
    if require_rows and pages.where(F.json_array_length("value") > 0).isEmpty():
        raise ValueError(f"no API records found under {path}")
    if types is None:
        found = pages.select(F.explode(each).alias("r")).select(F.explode(F.json_object_keys("r")).alias("c"))
        types = {r.c: "string" for r in found.distinct().orderBy("c").collect()}
    as_text = T.StructType([T.StructField(c, _read_type(t)) for c, t in types.items()])
    envelope = T.StructType([T.StructField("value", T.ArrayType(as_text))])
    # A list is read in one go, through its page; one that holds anything but objects, item by item.
    rows = F.coalesce(F.from_json("text", envelope)["value"], F.transform(each, lambda r: F.from_json(r, as_text)))
    row = pages.where("value IS NOT NULL").select(F.explode(rows).alias("r")).select("r.*")
    return row.select(*[_typed(c, t).alias(c) for c, t in types.items()])


def _read_type(type_name: str) -> T.DataType:
    return T.DataType.fromDDL(type_name) if type_name.startswith("decimal") else T.StringType()


def _typed(column: str, type_name: str) -> Column:
    text = F.col(f"`{column}`")
    if type_name in ("bigint", "int"):
        return text.try_cast("decimal(38,10)").try_cast(type_name)
    return text.try_cast(type_name)


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per JSON object or list found, in the file it was found in."""
    return _pages(spark, path).select(
        "file", "at", "is_object", F.col("value").isNotNull().alias("has_value"),
        F.coalesce(F.json_array_length("value"), F.lit(0)).cast("bigint").alias("records"), "next_link")


def page_diagnostic(pages: DataFrame, table: str, expected: int | None = None) -> DataFrame:
    """Page statistics of a table, and whether the feed is complete."""
    wanted = F.lit(EXPECTED_API_ROWS.get(table) if expected is None else expected).cast("bigint")
    total = F.coalesce(F.sum("records"), F.lit(0))
    facts = pages.agg(
        F.count_distinct("file").alias("files"),
        F.count("*").alias("objects"),
        F.count_if("has_value").alias("pages"),
        F.min(F.when(F.col("has_value"), F.col("records"))).alias("min_page"),
        F.max(F.when(F.col("has_value"), F.col("records"))).alias("max_page"),
        total.alias("records"),
        F.count("next_link").alias("next_links"),
    )
    verdict = (F.when(F.col("records") == wanted, "COMPLETE").when(F.col("records") < wanted, "INCOMPLETE")
               .when(F.col("records") > wanted, "MORE_THAN_EXPECTED"))
    return facts.select(F.lit(table).alias("table_name"), "*", wanted.alias("expected"),
                        (wanted - F.col("records")).alias("missing"), verdict.alias("verdict"))
