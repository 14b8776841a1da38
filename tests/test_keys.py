import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tradewell.operators import keys


def model(rows, columns):
    ids = [i for i, c in enumerate(columns) if c.lower().endswith("id")]
    if not rows:
        return []
    if not ids:
        return [columns[0]]
    for size in (1, 2, 3):
        for combo in combinations(ids, size):
            picked = [tuple(r[i] for i in combo) for r in rows]
            if len(set(picked)) == len(rows) and all(None not in p for p in picked):
                return [columns[i] for i in combo]
    return [columns[i] for i in ids]


@pytest.mark.parametrize("seed", range(6))
def test_inferred_key_matches_a_model(spark, seed):
    rng = random.Random(seed)
    columns = ["aID", "name", "bId", "c_id", "dID"]
    domain = [3, 5, 4, 40][seed % 4]
    rows = [tuple(rng.choice([*range(domain), *([None] if seed % 2 else [])]) for _ in columns) for _ in range(rng.choice([5, 20, 40]))]
    df = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in columns))
    assert keys.infer_primary_key(df) == model(rows, columns)


@pytest.mark.parametrize("columns, rows, expected", [
    ("x int, OrderID int", [(1, 1), (1, 2)], ["OrderID"]),
    ("NoteID int, OrderID int", [(7, 1), (8, 2)], ["NoteID"]),
    ("a_id int, b_id int", [(1, 1), (1, 2), (2, 1)], ["a_id", "b_id"]),
    ("a_id int, b_id int, c_id int", [(1, 1, 1), (1, 1, 2), (1, 2, 1), (2, 1, 1), (2, 2, 2), (1, 2, 2), (2, 1, 2), (2, 2, 1)], ["a_id", "b_id", "c_id"]),
    ("a_id int, b_id int", [(1, 1), (None, 2)], ["b_id"]),
    ("a_id int, b_id int", [(1, 1), (1, 1)], ["a_id", "b_id"]),
    ("x int, y int", [(1, 1)], ["x"]),
    ("a_id int", [], []), ("x int", [], [])])
def test_inferred_key_cases(spark, columns, rows, expected):
    assert keys.infer_primary_key(spark.createDataFrame(rows, columns)) == expected


def test_the_fallback_says_whether_it_is_proven(spark):
    wide = [(i % 2, i // 2 % 2, i // 4 % 2, i // 8) for i in range(32)]
    schema = "a_id int, b_id int, c_id int, d_id int"
    assert keys.infer_key(spark.createDataFrame(wide, schema)) == keys.Key(["a_id", "b_id", "c_id", "d_id"], True)
    assert keys.infer_key(spark.createDataFrame([*wide, wide[0]], schema)) == keys.Key(["a_id", "b_id", "c_id", "d_id"], False)
    assert keys.infer_key(spark.createDataFrame([(1, None)], "a_id int, b_id int")) == keys.Key(["a_id"], True)
    assert keys.infer_key(spark.createDataFrame([(1,), (1,)], "x int")) == keys.Key(["x"], False)


def test_keys_of_many_rows(spark):
    df = spark.range(200_000).select((F.col("id") % 1000).alias("a_id"), (F.col("id") / 1000).cast("int").alias("b_id"), (F.col("id") % 7).alias("c_id"))
    assert keys.infer_key(df) == keys.Key(["a_id", "b_id"], True)


def test_foreign_keys_ignore_case_and_own_keys():
    known = {"Orders": ["OrderID"], "Customers": ["CustomerID"], "Details": ["OrderID", "ProductID"]}
    assert keys.infer_foreign_keys("Orders", ["OrderID", "customerid", "x"], known) == [("customerid", "Customers", "CustomerID")]


def test_orphans_skip_nulls(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "ref int")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    assert keys.orphans(child, "ref", parent, "id").first().orphan_count == 2
    assert keys.orphans(parent, "id", parent, "id").first().orphan_count == 0
