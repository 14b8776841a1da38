"""Exact dedup by an extendible-hash index on shared files, in DataFrame functions only.

Texts are equal when they are the same bytes after each run of white space became one blank. The key
of a text is a 64-bit hash of that form.

1. Keys are counted (copies meet in the map tasks first, so a hot text is one row per task) and written.
2. The directory: keys are counted by their first bits. It doubles, one bit more each time, as long as a
   bucket holds more than ``capacity`` keys, and only overfull buckets split: so a bucket is the shortest
   run of first bits with few enough keys. It has at most 2 ** DIRECTORY_BITS entries, which is what bounds
   its broadcast; a bucket that is overfull at that depth stays one and is sorted with spilling.
3. Texts of keys that occur more than once go, with their bucket, to shared files. Which keys those are is
   told by a bitmap of FILTER_WORDS words. A key that occurs once may pass it too and ends up alone in its
   chain, so the bitmap decides what is moved and never what is found.
4. Owner tasks take ranges of buckets. Texts of one key form a chain: they were grouped by their bytes, so
   two texts with one hash are two links. The index, one row per link, is written: bucket, key, link,
   text, the id that stays, the number of rows.
5. Rows look their text up by bucket, key and bytes. The rows of a hot text are split by Spark's skew join.

Defined cases: a null text is an empty one; of equal texts the row with the smallest doc_id stays, a null
doc_id comes after all others; of repeated rows with that id exactly one stays; keep_id is null where all
ids of a group are; an empty table gives an empty result; other columns may have any names, ``keep``
passes them on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewell.session import materialise

SPACES = r"[\x20\x09-\x0D]+"
CAPACITY = 1 << 14  # keys in a bucket before it splits
DIRECTORY_BITS = 16  # the directory's greatest depth
FILTER_WORDS = 1 << 17  # words of 64 bits in the bitmap of keys that occur more than once: 1 MB
KEYS_AN_OWNER = 1 << 17

Key = Callable[[Column], Column]


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def first_bits(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("bigint")


def directory(keys: DataFrame, capacity: int = CAPACITY, bits: int = DIRECTORY_BITS) -> DataFrame:
    """cell (the first ``bits`` bits of a key), bucket (its first cell), depth (bits that its keys share)."""
    cells = keys.groupBy(first_bits(F.col("h"), bits).alias("cell")).agg(F.count("*").alias("n"))
    runs = cells.select("n", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(bits)), lambda d: F.call_function(
        "shiftright", F.col("cell"), F.lit(bits) - d))).alias("depth", "prefix"))
    held = runs.groupBy("depth", "prefix").agg(F.sum("n").alias("held"))
    overfull = held.where((F.col("held") > capacity) & (F.col("depth") < bits)).select(
        (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("split"))
    # A bucket is there because the one it came from was overfull, and it does not split again.
    split = held.where("depth > 0").withColumn("split", F.shiftright("prefix", 1)).join(overfull, ["depth", "split"])
    stays = (F.col("held") <= capacity) | (F.col("depth") == bits)
    buckets = held.where("depth = 0").select("depth", "prefix", "held").union(split.select("depth", "prefix", "held")).where(stays)
    first, last = (F.expr(f"shiftleft(prefix + {k}L, {bits} - depth)") for k in (0, 1))
    return buckets.select(F.explode(F.sequence(first, last - 1)).alias("cell"), first.alias("bucket"), "depth")


def repeated(keys: DataFrame, words: int = FILTER_WORDS) -> DataFrame:
    """word, bits: the bitmap of keys that occur more than once, at most ``words`` rows."""
    slot = F.col("h").bitwiseAND(F.lit(words * 64 - 1).cast("bigint"))
    one = F.expr("shiftleft(1L, cast(slot & 63L as int))")
    return (keys.where("n > 1").select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word"))
            .agg(F.bit_or(one).alias("bits")))


class Index:
    """The written index of a table, and the rows that it was built from."""

    def __init__(self, docs: DataFrame, key: Key = F.xxhash64, capacity: int = CAPACITY, bits: int = DIRECTORY_BITS,
                 words: int = FILTER_WORDS):
        rows = docs.select(F.struct("*").alias("row")).withColumn("h", key(normalised(F.col("row.text"))).cast("bigint"))
        keys = materialise(rows.groupBy("h").agg(F.count("*").alias("n")), "dedup-keys")
        self.directory = materialise(directory(keys, capacity, bits), "dedup-directory")
        bitmap = repeated(keys, words)
        word = F.shiftright(F.col("h").bitwiseAND(F.lit(words * 64 - 1).cast("bigint")), 6)
        bit = F.expr("coalesce((shiftright(bits, cast(h & 63L as int)) & 1L) = 1L, false)")
        told = rows.join(F.broadcast(bitmap), word == F.col("word"), "left").select("row", "h", bit.alias("again"))
        self.alone = told.where(~F.col("again")).drop("again")
        paged = told.where("again").join(F.broadcast(self.directory), first_bits(F.col("h"), bits) == F.col("cell"))
        # A number of its own tells repeated rows apart; it is fixed once the pages are written.
        self.pages = materialise(paged.select(F.monotonically_increasing_id().alias("at"), "bucket", "h", "row"), "dedup-pages")
        first = F.struct(F.col("row.doc_id").isNull().alias("unnamed"), F.col("row.doc_id").alias("doc_id"), F.col("at").alias("at"))
        texts = self.pages.groupBy("bucket", "h", normalised(F.col("row.text")).alias("text")).agg(
            F.count("*").alias("group_size"), F.min(first).alias("first"))
        owners = 1 + (keys.agg(F.count_if(F.col("n") > 1).alias("n")).first()["n"] or 0) // KEYS_AN_OWNER
        chain = Window.partitionBy("bucket", "h").orderBy("first")
        chained = texts.repartitionByRange(owners, "bucket", "h").withColumn("link", F.row_number().over(chain))
        self.links = materialise(chained, "dedup-index")

    def marked(self) -> DataFrame:
        """row (all columns of the input), text_sha256, keep_id, group_size, kept."""
        sha = F.sha2(normalised(F.col("row.text")), 256).alias("text_sha256")
        links = self.links.select(F.col("bucket").alias("_bucket"), F.col("h").alias("_h"), F.col("text").alias("_text"), "first", "group_size")
        same = ((F.col("bucket") == F.col("_bucket")) & (F.col("h") == F.col("_h"))
                & (normalised(F.col("row.text")) == F.col("_text")))
        found = self.pages.join(links, same).select(
            "row", sha, F.col("first.doc_id").alias("keep_id"), "group_size", (F.col("at") == F.col("first.at")).alias("kept"))
        alone = self.alone.select("row", sha, F.col("row.doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
                                  F.lit(True).alias("kept"))
        return alone.union(found)


def digest(docs: DataFrame, **options) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    return Index(docs.select("doc_id", "text"), **options).marked().select(
        F.col("row.doc_id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def keep(docs: DataFrame, **options) -> DataFrame:
    """One row of each group of equal texts, with all its columns."""
    return Index(docs, **options).marked().where("kept").select("row.*")
