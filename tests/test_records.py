"""Whole records: numbered chunks of long sales, dead letters that can be
replayed, messages split into both routes."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tillpoint.operators import sales as SA
from tillpoint.sinks import tables as TB
from tillpoint.streaming import ingest as IG


def _lines(spark, n, hot):
    """``hot`` lines of sale 1 among others, in shuffled input order."""
    rows = [(f"S{1 if i < hot else 2 + i % 7}", "bad date", "BB", "C", "Cash: N5", None, "N5", "3", str(i), f"item {i}", "1",
             "N5", "5", i * 37 % n) for i in range(n)]
    schema = ", ".join(f"{c} string" for c in ("sale_id", *TB.RAW_FIELDS[1:6], "invoice_total", "pos_customer_id", "pos_item_id",
                                              "item_name", "quantity", "unit_price", "line_total")) + ", _row_no long"
    return SA.parsed_lines(spark.createDataFrame(rows, schema).repartition(5))


def test_a_sale_of_a_thousand_lines_is_split(spark):
    lines = _lines(spark, 1600, 1000)
    n = SA.nest_items(lines, F.floor(F.col("_row_no") / 100), 200).collect()
    hot = sorted((r for r in n if r["sale_id"] == 1), key=lambda r: r["chunk"])
    assert [(r["chunk"], len(r["items"])) for r in hot] == [(i, 200) for i in range(5)]
    want = [r["item_name"] for r in lines.filter("sale_id = 1").orderBy("_row_no").collect()]
    assert [i["item_name"] for r in hot for i in r["items"]] == want
    assert sum(len(r["items"]) for r in n) == 1600
    again = SA.number_lines(lines).groupBy("sale_id").agg(F.min("_line"), F.max("_line"), F.count("*"),
                                                          F.count_distinct("_line")).collect()
    assert all(r[1] == 0 and r[2] + 1 == r[3] == r[4] for r in again)
    assert SA.nest_items(lines.limit(0)).count() == 0


def test_dead_letters_are_replayed(spark):
    lines = _lines(spark, 700, 450)
    bad = SA.validate_sales(lines).filter("NOT accepted").select("sale_id", "reasons", "items_sold")
    letters = TB.raw_letters(lines, bad, chunk_size=100)
    assert letters.filter("pos_sale_id = 1").count() == 5 and letters.count() == 5 + 7
    other = letters.select("payload").union(spark.createDataFrame([("{oops",), (None,), ('{"a": 1}',)], "payload string"))
    again = SA.validate_sales(SA.parsed_lines(TB.replay(other, chunk_size=100))).select("sale_id", "reasons", "items_sold")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, bad.collect()))
    first = lines.filter("sale_id = 1").orderBy("_row_no").first()
    head = json.loads(letters.filter("pos_sale_id = 1 AND chunk = 0").first()["payload"])["lines"][0]
    assert head == {c: first[c] for c in TB.RAW_FIELDS}


def test_messages_of_a_sale(spark):
    sales = spark.createDataFrame([(1, 10.0, 23, "C", "BB", "2024-01-01T00:00:00", None, False, 3, 3, 0),
                                   (2, 1.0, 23, "C", "BB", "2024-01-01T00:00:00", "x", True, 0, 0, 0)],
                                  "pos_sale_id long, invoice_total double, pos_customer_id long, customer_name string, "
                                  "salesperson string, invoice_datetime string, comment string, is_anonymous_customer boolean, "
                                  "items_net long, items_sold long, items_returned long")
    items = spark.createDataFrame([(1, i, "n", 1, 2.5, 2.5, i) for i in range(5)],
                                  "sale_id long, pos_item_id long, name string, quantity long, unit_price double, "
                                  "total double, _row_no long")
    pays = spark.createDataFrame([(1, 1, "CASH PAYMENT", "b", 4.0), (1, 0, "ACCESS BANK", "a", 6.0)],
                                 "sale_id long, pos int, account string, account_id string, amount double")
    got = {(r["pos_sale_id"], r["chunk"]): json.loads(r["payload"])
           for r in TB.sale_messages(sales, items, pays, F.lit("node-1"), chunk_size=2).collect()}
    assert sorted(got) == [(1, 0), (1, 1), (1, 2), (2, 0)]
    assert [i["pos_item_id"] for c in range(3) for i in got[1, c]["items"]] == list(range(5))
    assert [p["account_id"] for p in got[1, 0]["payments"]] == ["a", "b"] and got[1, 1]["payments"] == []
    assert got[1, 2]["_meta"] == {"node_id": "node-1", "routing_key": "sales.node-1", "chunk": 2, "chunks": 3}
    assert got[2, 0]["items"] == [] and got[2, 0]["comment"] == "x" and got[1, 0]["comment"] is None


def test_a_failed_write_is_replayed(spark, tmpdir_path):
    landing, out, ck = (os.path.join(tmpdir_path, x) for x in ("in", "out", "ck"))
    rows = [(json.dumps({"id": i}),) for i in range(6)] + [('{"id": 1', ), ("{oops}",)]
    spark.createDataFrame(rows, "payload string").repartition(2).write.parquet(landing)
    calls = []

    def fails_once(batch, batch_id, schema, folder):
        calls.append(batch_id)
        if len(calls) == 2:
            raise RuntimeError("the table is not there")
        IG.message_batch(batch, batch_id, schema, folder)

    with pytest.raises(Exception, match="not there"):
        IG.start_messages(spark, landing, "id long", out, ck, write=fails_once).awaitTermination()
    IG.start_messages(spark, landing, "id long", out, ck, write=fails_once).awaitTermination()
    assert calls[1] in calls[2:]
    assert sorted(r["id"] for r in spark.read.parquet(f"{out}/good").collect()) == list(range(6))
    assert spark.read.parquet(f"{out}/bad").count() == 2
