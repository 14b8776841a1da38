import datetime
import random

import pytest
from pyspark.sql import functions as F

from tradewell.functions.dates import as_date, parse_timestamp, us_week
from tradewell.functions.text import clean_names, fill, fixed, percent, whole
from tradewell.operators import clean


def values(df, column=0):
    return [r[column] for r in df.collect()]


def test_names_are_cleaned_and_collisions_numbered():
    assert clean_names(["Order ID", "a,b;c", "__x__", "%%%", "order__id", "Order-ID"]) == [
        "Order_ID", "a_b_c", "x", "unnamed_column", "order_id_2", "Order_ID_3"]


def test_trim_and_fill(spark):
    df = spark.createDataFrame([(" a ", "x"), ("   ", None), (None, " ")], "t string, source_note string")
    trimmed = clean.trim_text(df)
    assert values(trimmed) == ["a", None, None]
    filled = clean.fill_text(trimmed)
    assert values(filled) == ["a", "Unknown", "Unknown"]
    assert values(filled, 1) == ["x", None, None]


@pytest.mark.parametrize("text, expected", [
    ("1996-07-04", (1996, 7, 4)), ("1996-07-04 00:00:00", (1996, 7, 4)), ("1996-07-04T00:00:00", (1996, 7, 4)),
    ("1996-07-04T00:00:00Z", (1996, 7, 4)), ("07/04/1996", (1996, 7, 4)), ("07/04/1996 00:00:00", (1996, 7, 4)), ("junk", None)])
def test_dates_in_any_known_pattern(spark, text, expected):
    got = spark.createDataFrame([(text,)], "t string").select(parse_timestamp(F.col("t"))).first()[0]
    assert got == (expected and datetime.datetime(*expected))


def test_date_columns_exclude_keys(spark):
    df = spark.createDataFrame([("1996-07-04", "1", "x", "1996-07-04")], "OrderDate string, DateID string, Note string, created_key string")
    assert dict(clean.parse_dates(df).dtypes) == {
        "OrderDate": "timestamp", "DateID": "string", "Note": "string", "created_key": "string"}


def test_as_date_is_lenient(spark):
    df = spark.createDataFrame([("1996-07-04 10:00:00",), ("x",), (None,)], "t string")
    assert values(df.select(as_date(F.col("t")))) == [datetime.date(1996, 7, 4), None, None]


def test_us_week_against_counting_days(spark):
    days = spark.sql("SELECT explode(sequence(DATE'1993-12-25', DATE'2001-01-05')) AS d")
    for row in days.select("d", us_week(F.col("d")).alias("w")).collect():
        new_year = row.d.replace(month=1, day=1)
        sundays = sum((new_year + datetime.timedelta(i)).weekday() == 6 for i in range(1, (row.d - new_year).days + 1))
        assert row.w == 1 + sundays, row.d


def test_casts_never_raise(spark):
    df = spark.createDataFrame([("1", "2.5"), ("x", "y")], "ProductID string, UnitPrice string")
    got = clean.cast_columns(df, {"ProductID": "bigint", "UnitPrice": "double", "Absent": "bigint"}).collect()
    assert [tuple(r) for r in got] == [(1, 2.5), (None, None)]


def test_hash_prints_equal_numbers_alike(spark):
    def hashes(rows, schema):
        df = spark.createDataFrame(rows, schema)
        return values(df.select(clean.row_hash(df, ["k", "v"])))

    a, b, c = hashes([(1, 0.0), (1, -0.0), (1, 1.0)], "k int, v double")
    assert a == b != c
    null, text = hashes([("1", None), ("1", "<NULL>")], "k string, v string")
    assert null == text  # the format cannot tell them apart, by definition


def test_project_adds_missing_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    got = clean.project(df, ["b", "c"])
    assert got.columns == ["b", "c"] and got.first()["c"] is None


def test_dedup_matches_a_model(spark):
    rng = random.Random(7)
    rows = [(rng.choice([None, *range(20)]), rng.randint(0, 3), rng.choice(["x", None, "y"])) for _ in range(600)]
    rows += [(3, rng.randint(0, 3), "x") for _ in range(400)]
    best = {}
    for r in rows:
        rank = (r[1], r[2] is not None, r[2] or "")
        if r[0] not in best or rank < best[r[0]][0]:
            best[r[0]] = (rank, r)
    df = spark.createDataFrame(rows, "k int, a int, b string").repartition(5)
    got = {r.k: tuple(r) for r in clean.dedup(df, ["k"]).collect()}
    assert got == {k: r for k, (_, r) in best.items()}


def test_dedup_keeps_history_tables(spark):
    df = spark.createDataFrame([(1, True), (1, False)], "k int, is_current boolean")
    assert clean.dedup(df, ["k"]).count() == 2


def test_hot_keys_shrink_before_the_dedup_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = clean.dedup(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_number_formats(spark):
    df = spark.createDataFrame([(1234567.5, 0.125)], "x double, p double")
    row = df.select(whole(F.col("x")), fixed(F.col("x"), 1), percent(F.col("p")), percent(F.col("p"), 1)).first()
    assert tuple(row) == ("1,234,568", "1234567.5", "13%", "12.5%")


def test_sentences_skip_blanks(spark):
    row = spark.createDataFrame([("a", None)], "x string, y string").select(
        fill("{x} and {y}; ${x}.", x=F.col("x"), y=F.col("y"))).first()
    assert row[0] == "a and ; $a."
