"""Mixing sources to target weights by systematic sampling.

Each source gets a target number of words: its share of all words by weight, at most three times its
own size, the excess shared among the others by weight. A document's expected copies are target /
size of its source. Along an order of the source's documents the expected copies are summed, one
random offset is added, and a document is emitted once for each integer boundary that its own share
crosses: so copies differ from the expectation by less than one, and a source by less than one
document for each size class.

Order: by bit length of the size, a hash of the id (so that a source of any size is many blocks), then
size and id. Blocks are summed first, their totals give each block's start, and only the rows of a
block are sorted together. Sums are exact: expected copies are counted in billionths.

Everything is DataFrame functions. Defined cases: a null text has size 0, a null source is one source
that sorts last, a null id falls into one block per class; repeated rows are documents of their own; sources
without words get target 0 and no copies; input columns may have any names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewell.llm.common import WORD

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
ROWS_A_BLOCK = 20_000
UNIT = 1_000_000_000  # parts of one expected copy


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def hex_number(text: Column, digits: int) -> Column:
    """The first hexadecimal digits of the text's MD5 as a number."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, target from one row (source, source_size) per source.

    With sources in order of cap / weight, those that reach their cap come first: a source is capped if
    the level (words left / weight left), with all before it capped, lies above its own ratio.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    number = (F.row_number().over(by_name) - 1) % len(weights)
    rows = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (number + 1).cast("int")).cast("bigint"))
    rows = rows.withColumn("cap", most * F.col("source_size"))
    order = [F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weight_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    rows = rows.withColumn("level", left / weight_left)
    rows = rows.withColumn("capped", F.col("level") > F.col("cap") / F.col("weight"))
    level = F.max(F.when(~F.col("capped"), F.col("level"))).over(whole)  # the first's; it only falls after that
    return rows.select("source", "source_size",
                       F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("weight") * level).alias("target"))


def plan(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES, seed: int = 1,
         rows_a_block: int = ROWS_A_BLOCK) -> DataFrame:
    """``row`` (all columns of the input), size, source_size, target, copies."""
    sized = docs.select(F.struct("*").alias("row"), F.col("source"), F.col("doc_id"), word_count(F.col("text")).alias("size"))
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    blocks = 1 + (totals.agg(F.sum("n")).first()[0] or 0) // rows_a_block
    expected = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * UNIT)).otherwise(0)
    shares = targets(totals.drop("n"), weights, most).select(
        F.col("source").alias("_source"), "source_size", "target", expected.cast("bigint").alias("expected"),
        (hex_number(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit(""))), 7) * UNIT / 16 ** 7).cast("bigint").alias("offset"))
    placed = sized.withColumns({
        "band": F.length(F.bin("size")),
        "sub": F.coalesce(hex_number(F.col("doc_id").cast("string"), 8) % blocks, F.lit(0))})
    key = [F.col("source"), F.col("band"), F.col("sub")]
    same = F.col("source").eqNullSafe(F.col("_source"))
    counts = placed.groupBy(*key).agg(F.count("*").alias("n")).join(shares, same)
    earlier = Window.partitionBy("source").orderBy("band", "sub").rowsBetween(Window.unboundedPreceding, -1)
    passed = F.coalesce(F.sum(F.col("n").cast("decimal(20,0)") * F.col("expected")).over(earlier), F.lit(0))
    starts = counts.select(
        F.col("_source"), F.col("band").alias("_band"), F.col("sub").alias("_sub"), "source_size", "target", "expected",
        ((passed + F.col("offset")) % UNIT).cast("bigint").alias("begin"))
    in_block = Window.partitionBy(*key).orderBy("size", "doc_id")
    ranked = placed.withColumn("place", F.row_number().over(in_block).cast("bigint"))
    joined = ranked.join(starts, same & (F.col("band") == F.col("_band")) & (F.col("sub") == F.col("_sub")))
    crossed = [F.expr(f"(begin + (place - {k}) * expected) div {UNIT}") for k in (0, 1)]
    return joined.select("row", "size", "source_size", "target", (crossed[0] - crossed[1]).alias("copies"))


def digest(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken."""
    return plan(docs.select("doc_id", "source", "text"), **options).select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it was drawn."""
    drawn = plan(docs, **options).where("copies > 0")
    return drawn.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("_copy")).select("row.*")
