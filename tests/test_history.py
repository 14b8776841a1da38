import random

import pytest
from pyspark.sql import functions as F

from tradewell.config import Entity
from tradewell.operators import history
from tradewell.operators.clean import prepare_feed

RUN = "2026-03-01 00:00:00"
ONE = Entity("T", ["k"], ["v", "w"])
TWO = Entity("T", ["k", "j"], ["v"])


def merged(spark, old, new, entity=ONE, schema="k int, v string, w double"):
    old, new = (prepare_feed(spark.createDataFrame(rows, schema), entity) for rows in (old, new))
    return history.merge(old, new, entity, RUN)


def brief(df, *columns):
    rows = df.select(*columns, "source_system", "is_current", "operation", F.col("effective_end").cast("string").alias("e")).collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_every_outcome(spark):
    old = [(1, "same", 1.0), (2, "old", 2.0), (3, "only", 3.0), (None, "n", 0.0)]
    new = [(1, "same", 1.0), (2, "new", 2.0), (4, "added", 4.0), (4, "zz duplicate", 4.0), (None, "m", 0.0)]
    assert brief(merged(spark, old, new), "k", "v") == sorted([
        (1, "same", "API", True, "I", None), (2, "old", "API", False, "I", RUN), (2, "new", "Excel", True, "U", None),
        (3, "only", "API", True, "I", None), (4, "added", "Excel", True, "I", None), (None, "n", "API", True, "I", None),
        (None, "m", "Excel", True, "I", None)], key=str)


def test_small_changes_count_and_signed_zeros_do_not(spark):
    df = merged(spark, [(1, "a", 1.0), (2, "b", 0.0)], [(1, "a", 1.00000000001), (2, "b", -0.0)])
    assert brief(df, "k") == sorted([(1, "API", False, "I", RUN), (1, "Excel", True, "U", None), (2, "API", True, "I", None)], key=str)


def test_times_of_versions(spark):
    rows = {r.v: r for r in merged(spark, [(1, "old", 1.0)], [(1, "new", 1.0)]).collect()}
    assert str(rows["old"].effective_start) == str(rows["old"].created_at) == "2026-01-01 00:00:00"
    assert str(rows["old"].modified_at) == str(rows["new"].effective_start) == str(rows["new"].modified_at) == RUN


@pytest.mark.parametrize("old, new", [([(1, "a", 1.0)], []), ([], [(1, "a", 1.0)]), ([(1, "a", 1.0)], [(1, "b", 1.0)])])
def test_one_sided_and_all_changed(spark, old, new):
    df = merged(spark, old, new)
    assert df.where("is_current").count() == 1
    assert df.count() == max(len(old) + len(new), 1)


def test_types_of_the_baseline_win(spark):
    old = spark.createDataFrame([(1, "a", 1.0)], "k int, v string, w double")
    new = spark.createDataFrame([("1", "a", "1"), ("x", "b", "?")], "k string, v string, w string")
    df = history.merge(prepare_feed(old, ONE), prepare_feed(new, ONE), ONE, RUN)
    assert brief(df, "k", "v", "w") == sorted([(1, "a", 1.0, "API", True, "I", None), (None, "b", None, "Excel", True, "I", None)], key=str)


@pytest.mark.parametrize("seed", range(4))
def test_merge_matches_a_model(spark, seed):
    rng = random.Random(seed)
    def feed(n):
        return {(rng.randint(0, 30), rng.randint(0, 2)): rng.choice("abc") for _ in range(n)}

    old, new = feed(40), feed(40)
    want = []
    for key, v in old.items():
        changed = key in new and new[key] != v
        want.append((*key, v, "API", not changed, "I", RUN if changed else None))
    for key, v in new.items():
        if key not in old:
            want.append((*key, v, "Excel", True, "I", None))
        elif old[key] != v:
            want.append((*key, v, "Excel", True, "U", None))
    rows = [[(*k, v) for k, v in f.items()] for f in (old, new)]
    schema = "k int, j int, v string"
    got = brief(merged(spark, *rows, TWO, schema), "k", "j", "v")
    assert got == sorted(want, key=str)
    a, b = (prepare_feed(spark.createDataFrame(r, schema), TWO) for r in rows)
    c = history.merge_counts(history.classify(a, b, TWO)).first()
    assert c.total_rows == c.api_rows + c.changed_rows + c.new_rows == len(got)
    assert c.historical_rows == c.changed_rows and c.excel_rows == len(new)


def test_merge_is_one_join(spark):
    plan = merged(spark, [(1, "a", 1.0)], [(1, "b", 1.0)])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 1 and plan.count("Join ") == 1
