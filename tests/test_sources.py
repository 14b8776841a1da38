import json
import pathlib
import random
import threading

import pytest
from pyspark.sql import functions as F

from tradewell.sources import pages, reader, sinks
from tradewell.sources.pages import page_texts

TYPES = {"OrderID": "bigint", "Quantity": "bigint", "UnitPrice": "double", "Note": "string"}


def write(root, name, text):
    with open(f"{root}/{name}", "w", encoding="utf-8") as f:
        f.write(text)


def test_objects_back_to_back():
    text = '﻿{"a": "}{\\""} {"b": [1]}\n\t{"c": 1}[1, 2] "x"  '
    assert list(page_texts(text)) == ['{"a": "}{\\""}', '{"b": [1]}', '{"c": 1}', "[1, 2]"]


def pages_of(spark, root, block):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        return sorted(r.text for r in pages.page_rows(spark, root).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_one_file_is_read_by_several_tasks(spark, root):
    rng = random.Random(3)
    hard = ["}", "{", '"', "\\", "\\\"", "]", "é", "\\\\", "a", "\n", "\\\"}{"]

    def value():
        return json.dumps("".join(rng.choice(hard) for _ in range(rng.randint(0, 12))), ensure_ascii=rng.random() < 0.5)

    texts = []
    for k in range(16):
        records = ",".join("{" + f'"k":{value()},"n":{{"x":[{value()},{i}]}}' + "}" for i in range(rng.randint(0, 9)))
        texts.append('{"value":[' + records + f'],"c":{value()}' + "}")
    texts.insert(7, "[1, [2], " + value() + "]")
    between = [" ", "", "\n\t", ' "a}{" ', " 12 ", " null\n"]
    whole = "\ufeff" + "".join(t + rng.choice(between) for t in texts)
    write(root, "a.json", whole)
    write(root, "b.json", texts[0] + "  ")
    write(root, "c.json", "")
    want = sorted([*page_texts(whole), texts[0]])
    assert want == sorted([*texts, texts[0]])
    for block in (150, 1000, 1 << 27):
        assert pages_of(spark, root, block) == want


def test_many_blocks_make_many_tasks(spark, root):
    write(root, "a.json", "".join('{"value":[{"OrderID":%d,"Note":"}{"}]}' % i for i in range(400)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        stretches = spark.read.option("lineSep", "}").text(root)
        assert stretches.rdd.getNumPartitions() > 4
        assert sorted(r[0] for r in pages.read_pages(spark, root, {"OrderID": "bigint"}).collect()) == list(range(400))
        write(root, "b.json", '{"value":[' + '{"OrderID":1},' * 400)
        with pytest.raises(Exception, match="bad JSON"):
            pages.read_pages(spark, root, TYPES).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("tail", ['{"value":[{"OrderID":1}]', '{"value":[]}}', '{"value":[]} x', '{"value":["', '{"value":[]}]'])
def test_broken_ends_fail(spark, root, tail):
    write(root, "a.json", '{"value":[{"OrderID":1}]}' * 5 + tail)
    with pytest.raises(Exception, match="bad JSON"):
        pages_of(spark, root, 30)


def test_broken_tail_raises():
    with pytest.raises(ValueError, match="bad JSON"):
        list(page_texts('{"value": []}{"value": ['))
    for text in ('{"a": 1} rest', '{"a": "open}', '{"a": 1}}'):
        with pytest.raises(ValueError, match="bad JSON"):
            list(page_texts(text))


def test_digits_are_kept(spark, root):
    write(root, "a.json", '{"value":[{"a":0.12345678901234567891,"b":1.50,"c":1234567890123456.12}]}')
    row = pages.read_pages(spark, root, {"a": "decimal(38,20)", "b": "decimal(5,2)", "c": "decimal(20,2)"}).first()
    assert [str(v) for v in row] == ["0.12345678901234567891", "1.50", "1234567890123456.12"]


def test_items_that_are_no_objects_cost_no_records(spark, root):
    write(root, "a.json", '{"value":[{"OrderID":1},5,{"OrderID":2,"Note":{"x":1}}]}')
    got = [r[0] for r in pages.read_pages(spark, root, TYPES).collect()]
    assert sorted(v for v in got if v is not None) == [1, 2]


def test_unbalanced_kinds_of_brackets_fail_the_job(spark, root):
    write(root, "a.json", '{"value":[{"OrderID":1}}]')
    with pytest.raises(Exception, match="bad JSON"):
        pages.read_pages(spark, root, TYPES, require_rows=False).collect()


def test_resolve_reads_every_page(spark, root):
    (pathlib.Path(root) / "bronze_Orders").mkdir()
    write(f"{root}/bronze_Orders", "a.json", '{"value":[{"OrderID":1,"x":1},{"OrderID":2}]}{"value":[{"OrderID":3,"@odata.etag":"e","y":"2.50"}]}')
    got = reader.resolve(spark, root, "Orders")
    assert sorted(map(tuple, got.select("OrderID", "x", "y").collect())) == [(1, "1", None), (2, None, None), (3, None, "2.50")]
    assert set(got.columns) == {"OrderID", "x", "y"}


def test_pages_of_all_files(spark, root):
    write(root, "a.json", '﻿{"value":[{"OrderID":1,"Quantity":3,"UnitPrice":4},{"OrderID":9007199254740993,"Quantity":3.0}],'
                          '"@odata.nextLink":"n"}{"value":[{"OrderID":2,"Note":"a}{\\"b"}]}')
    write(root, "b.json", '{"no_value":1}\n[{"value":[]}]\n{"value":{"OrderID":7}}\n{"value":[{"OrderID":3,"Quantity":"x"}]}')
    got = sorted(tuple(r) for r in pages.read_pages(spark, root, TYPES).collect())
    assert got == [(1, 3, 4.0, None), (2, None, None, 'a}{"b'), (3, None, None, None), (9007199254740993, 3, None, None)]
    facts = pages.page_diagnostic(pages.scan_pages(spark, root), "Orders", 5).first()
    assert (facts.files, facts.objects, facts.pages, facts.records, facts.next_links, facts.missing, facts.verdict) == (
        2, 6, 3, 4, 1, 1, "INCOMPLETE")


def test_pages_without_records_raise(spark, root):
    write(root, "a.json", '{"value":[]}')
    with pytest.raises(ValueError, match="no API records"):
        pages.read_pages(spark, root, TYPES)


def test_broken_page_fails_the_job(spark, root):
    write(root, "a.json", '{"value":[{"OrderID":1}]}{"value"')
    with pytest.raises(Exception, match="bad JSON"):
        pages.read_pages(spark, root, TYPES, require_rows=False).collect()


def test_resolve_order(spark, root):
    assert reader.resolve(spark, root, "Order_Details") is None
    spark.range(2).write.parquet(f"{root}/bronze_orderdetails")
    assert reader.resolve(spark, root, "Order_Details").count() == 2
    spark.range(3).write.json(f"{root}/bronze_OrderDetails")
    assert reader.resolve(spark, root, "Order_Details").count() == 3
    spark.range(4).write.parquet(f"{root}/bronze_Order_Details")
    assert reader.resolve(spark, root, "Order_Details").count() == 4
    assert reader.resolve(spark, root, "Order_Details", "Excel") is None


def test_json_tree_unwraps_the_envelope(spark, root):
    write(root, "a.json", json.dumps({"@odata.context": "c", "value": [{"x": 1}, {"x": 2}]}))
    assert sorted(r.x for r in reader.read_json_tree(spark, root).collect()) == [1, 2]


def test_publish_over_itself_and_with_new_schema(spark, root):
    sinks.publish(spark.range(5), "t_publish", root)
    sinks.publish(spark.table("t_publish").where("id > 2"), "t_publish", root)
    assert spark.table("t_publish").count() == 2
    sinks.publish(spark.table("t_publish").withColumn("x", F.lit("a")), "t_publish", root)
    assert spark.table("t_publish").columns == ["id", "x"]


def test_readers_see_whole_versions_while_the_schema_changes(spark, root):
    sinks.publish(spark.range(100), "t_live", root)
    held = spark.table("t_live")
    stop, seen = threading.Event(), []

    def read():
        while not stop.is_set():
            rows = spark.table("t_live").collect()
            seen.append((len(rows), tuple(rows[0].asDict())))

    reader_thread = threading.Thread(target=read)
    reader_thread.start()
    try:
        for n, extra in ((200, "a"), (300, "b")):
            sinks.publish(spark.range(n).withColumn(extra, F.lit(1)), "t_live", root, keep=3)
    finally:
        stop.set()
        reader_thread.join()
    assert seen and set(seen) <= {(100, ("id",)), (200, ("id", "a")), (300, ("id", "b"))}
    assert held.count() == 100  # a reader goes on with the version that it began with


def test_old_versions_go(spark, root):
    for n in range(5):
        sinks.publish(spark.range(n + 1), "t_versions", root, keep=2)
    assert len(sinks.versions(spark, "t_versions", root)) == 2 == len(list((pathlib.Path(root) / "t_versions").iterdir()))
    assert spark.table("t_versions").count() == 5 and sinks.stored(spark, "t_versions", root).count() == 5


def test_hidden_and_bucketed_versions(spark, root):
    df = spark.range(20).select("id", (F.col("id") % 3).alias("k"), F.lit("x").alias("_secret"))
    shown = sinks.publish(df, "t_hidden", root, hidden=["_secret"], bucket_by=["k"])
    assert shown.columns == ["id", "k"] and sinks.stored(spark, "t_hidden", root).columns == df.columns
    sinks.publish(df.where("k = 1"), "t_hidden", root, keep=1, bucket_by=["k"])
    assert spark.table("t_hidden").count() == 7 and len(sinks.versions(spark, "t_hidden", root)) == 1


def test_a_run_replaces_its_own_rows(spark, root):
    def run(name, rows, schema="a int"):
        sinks.append_run(spark.createDataFrame(rows, schema).withColumn("run_id", F.lit(name)), f"{root}/runs")

    run("2026-01-01", [(1,), (2,)])
    before = {p: p.stat().st_mtime_ns for p in pathlib.Path(f"{root}/runs").rglob("*.parquet")}
    run("7", [(3, "x")], "a int, b string")
    assert {p: p.stat().st_mtime_ns for p in pathlib.Path(f"{root}/runs").rglob("*.parquet") if p in before} == before  # nothing is copied
    run("7", [(4, "y")], "a int, b string")
    log = sinks.read_log(spark, f"{root}/runs")
    assert sorted((r.run_id, r.a, r.b) for r in log.collect()) == [("2026-01-01", 1, None), ("2026-01-01", 2, None), ("7", 4, "y")]


def test_row_difference(spark):
    a = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None), (3, "c")], "k int, v string")
    b = spark.createDataFrame([("a", 1), (None, 2), ("d", 4), ("d", 4)], "v string, k int")
    found = sinks.row_difference(a, b)
    assert sorted(tuple(r) for r in found.collect()) == [(1, "a", "left", 2), (3, "c", "left", 1), (4, "d", "right", 2)]
    assert sinks.row_difference(a, b)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sinks.row_difference(a, a).count() == 0


def test_failed_publish_leaves_the_table(spark, root):
    sinks.publish(spark.range(5), "t_failed", root)
    with pytest.raises(Exception):
        sinks.publish(spark.range(5).select(F.raise_error(F.lit("no")).cast("bigint").alias("id")), "t_failed", root)
    assert spark.table("t_failed").count() == 5


def test_sync_by_name(spark, root):
    first = spark.createDataFrame([(1, "a")], "k int, v string")
    assert sinks.sync(first, "t_sync", root) == "REBUILT"
    assert sinks.sync(spark.createDataFrame([("b", 2)], "v string, k int"), "t_sync", root) == "REFILLED"
    assert [tuple(r) for r in spark.table("t_sync").collect()] == [(2, "b")]
    assert sinks.sync(first.withColumn("extra", F.lit(1)), "t_sync", root) == "REBUILT"
    assert sinks.sync(first.select("k"), "t_sync", root) == "REBUILT"
    assert spark.table("t_sync").columns == ["k"]


def test_logs_widen(spark, root):
    sinks.append(spark.createDataFrame([(1,)], "a int"), f"{root}/log")
    sinks.append(spark.createDataFrame([(2, "x")], "a int, b string"), f"{root}/log")
    assert sorted(tuple(r) for r in sinks.read_log(spark, f"{root}/log").select("a", "b").collect()) == [(1, None), (2, "x")]
