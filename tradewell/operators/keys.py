"""Keys found in the data, and references between tables."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_KEY_SIZE = 3
# Relative standard error of a distinct-value sketch, and by how many errors it must fall short to rule a key out.
SKETCH_ERROR, SURE = 0.02, 8
SKETCHES_A_PASS = 400


@dataclass(frozen=True)
class Key:
    """Columns of a primary key, and whether they were shown to be unique and never null."""

    columns: list[str]
    proven: bool


def id_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.lower().endswith("id")]


def infer_key(df: DataFrame, max_size: int = MAX_KEY_SIZE) -> Key:
    """The first id column, else the smallest combination of them, that is unique and never null.

    One aggregate counts nulls and takes a distinct-value sketch of every combination of up to
    ``max_size`` id columns. A combination whose sketch falls short of the rows by eight standard errors cannot be unique;
    the others are counted exactly, in order, until one holds. An empty table has no key. A table
    without id columns has its first column, one without a unique combination has all ids; whether
    these are unique is counted too, and said.
    """
    ids = id_columns(df)
    if not ids:
        if not df.columns or df.isEmpty():
            return Key([], False)
        return Key([df.columns[0]], _is_key(df, [df.columns[0]]))
    tried = [list(c) for size in range(1, min(max_size, len(ids)) + 1) for c in combinations(ids, size)]
    total, complete = 0, []
    for a in range(0, len(tried), SKETCHES_A_PASS):
        total, complete, possible = _sketched(df, ids, tried[a:a + SKETCHES_A_PASS])
        if total == 0:
            return Key([], False)
        for columns in possible:
            if _is_key(df, columns):
                return Key(columns, True)
    return Key(ids, complete == ids and len(ids) > max_size and _is_key(df, ids))


def infer_primary_key(df: DataFrame, max_size: int = MAX_KEY_SIZE) -> list[str]:
    """The columns of the inferred key."""
    return infer_key(df, max_size).columns


def _sketched(df: DataFrame, ids: list[str], tried: list[list[str]]) -> tuple[int, list[str], list[list[str]]]:
    """Rows, id columns without nulls, and the combinations of such that may have as many values as there are rows."""
    filled = [F.count(f"`{c}`").alias(f"f{i}") for i, c in enumerate(ids)]
    sketches = [F.approx_count_distinct(F.struct(*c), SKETCH_ERROR).alias(f"c{i}") for i, c in enumerate(tried)]
    row = df.agg(F.count(F.lit(1)).alias("n"), *filled, *sketches).first()
    complete = [c for i, c in enumerate(ids) if row[f"f{i}"] == row["n"]]
    enough = row["n"] * (1 - SURE * SKETCH_ERROR)
    possible = [c for i, c in enumerate(tried) if row[f"c{i}"] >= enough and set(c) <= set(complete)]
    return row["n"], complete, possible


def _is_key(df: DataFrame, columns: list[str]) -> bool:
    """Whether no value repeats and none is null; plain counts per value, which end at the first repeat found."""
    nulls = reduce(Column.__or__, [F.col(f"`{c}`").isNull() for c in columns])
    wrong = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows")).where((F.col("_rows") > 1) | nulls)
    return wrong.isEmpty()


def infer_foreign_keys(table: str, columns: list[str], keys: Mapping[str, list[str]]) -> list[tuple[str, str, str]]:
    """Non-key columns named, case aside, like a key column of another table."""
    owners = defaultdict(list)
    for owner, names in keys.items():
        for name in names:
            owners[name.lower()].append((owner, name))
    free = [c for c in columns if c not in keys.get(table, ())]
    return [(c, *target) for c in free for target in owners[c.lower()] if target[0] != table]


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """One row with the number of rows whose reference has no target; null references do not count.

    References are counted per value first, so a hot value reaches the join as one row.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_ref")).agg(F.count("*").alias("_rows"))
    known = parent.where(F.col(parent_column).isNotNull()).select(F.col(parent_column).alias("_known")).distinct()
    lost = used.join(known, F.col("_ref") == F.col("_known"), "left_anti")
    return lost.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("orphan_count"))
