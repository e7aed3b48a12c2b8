"""Plan shape: no cross products, no window over all rows, filters and
projections reach the scans."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tests.conftest import SF_SMALL
from tillpoint.operators import fuzzy_match as FZ
from tillpoint.operators import sales as SA
from tillpoint.plans import catalog as C
from tillpoint.plans import standin as SI
from tillpoint.sinks import tables as TB
from tillpoint.sources import receipts as RC

STREAMING_OR_SCAN = {"stream_ingest", "stream_dedup", "stale_sessions", "windowed_errors_stream",
                     "workbook_scan"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(set(queries()) - STREAMING_OR_SCAN))
def test_no_cross_products_or_global_windows(spark, key):
    p = _plan(queries()[key](spark, SF_SMALL))
    assert "CartesianProduct" not in p, key
    assert "BroadcastNestedLoopJoin" not in p, key
    # a window without partition keys is only allowed right above a top-k
    for m in re.finditer(r"Window \[.*?\], \[(.*?)\], \[", p):
        if m.group(1).strip() == "":
            assert "TakeOrderedAndProject" in p or "GlobalLimit" in p, key


@pytest.mark.parametrize("key", ["clean_lines", "kpi_totals"])
def test_report_date_filter_reaches_orders_scan(spark, key):
    p = _plan(queries()[key](spark, SF_SMALL))
    scans = [ln for ln in p.split("\n") if "orders.parquet" in ln or "o_orderdate" in ln and "FileScan" in ln]
    assert any("PushedFilters" in ln and "o_orderdate" in ln and "GreaterThanOrEqual" in ln
               for ln in scans), scans


def test_projection_pruned_at_scan(spark):
    p = _plan(queries()["kpi_totals"](spark, SF_SMALL))
    li = [ln for ln in p.split("\n") if "FileScan parquet" in ln and "l_orderkey" in ln]
    assert li and all("l_shipdate" not in ln and "l_tax" not in ln for ln in li)


def test_sheet_broadcasts_neither_items_nor_customers(spark):
    plan = SI.driver_sheet(spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("SortMergeJoin") >= 2 and plan.count("BroadcastHashJoin") <= 2


def test_sheet_broadcasts_no_table_and_deals_no_line_by_customer(spark):
    plan = SI.driver_sheet(spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("SortMergeJoin") == 4 and "Broadcast" not in plan
    by_customer = plan[plan.index("SortMergeJoin [o_custkey"):]
    assert "l_orderkey" not in by_customer


def test_rarest_tokens_are_not_broadcast(spark):
    q = spark.createDataFrame([("ada obi",)], "_q string")
    freq = FZ._frequency(FZ._keys(spark.createDataFrame([("ada",)], "_r string"), "_r", [], False))
    out = FZ._rarest_tokens(q, "_q", freq)
    assert "Broadcast" not in out._jdf.queryExecution().sparkPlan().toString()
    assert sorted(r["_key"] for r in out.collect()) == ["wobi"]


def test_line_counts_of_sales_are_not_broadcast(spark):
    # rows of a known, small size
    lines = spark.sql("SELECT * FROM VALUES (1L, 5L), (1L, 200007L), (2L, 9L), (1L, 6L), (null, 4L) AS t(sale_id, _row_no)")
    out = SA.number_lines(lines)
    assert "Broadcast" not in out._jdf.queryExecution().sparkPlan().toString()
    assert sorted(tuple(r) for r in out.select("sale_id", "_row_no", "_line").collect()) == [
        (1, 5, 0), (1, 6, 1), (1, 200_007, 2), (2, 9, 0)]


def test_letters_read_the_sheet_once(spark):
    lines = SA.parsed_lines(SI.driver_sheet(spark, SF_SMALL))
    letters = TB.raw_letters(lines, lines.filter("sale_id % 3 = 0").select("sale_id").distinct(), F.col("_row_no.l_linenumber"))
    assert all("/tables/rejected_lines-" in f for f in letters.inputFiles())
    assert letters.select(F.explode(F.from_json("payload", TB._RAW_SCHEMA)["lines"])).count() == \
        lines.filter("sale_id % 3 = 0").count()


def _reads(df) -> str:
    return " ".join(df.inputFiles())


def test_nesting_reads_the_lines_once(spark):
    lines = spark.range(450).selectExpr("id % 3 AS sale_id", "id AS _row_no", *[f"CAST(id AS STRING) AS {c}" for c in SA.ITEM_FIELDS])
    n = SA.nest_items(lines, chunk_size=60)
    assert "Range (" not in _plan(n) and "/tables/lines_to_nest-" in _reads(n)
    assert sorted((r["sale_id"], r["chunk"], len(r["items"])) for r in n.collect()) == [
        (s, c, 60 if c < 2 else 30) for s in range(3) for c in range(3)]


@pytest.mark.parametrize("key", ["dead_letter", "dead_letter_replay", "sale_message"])
def test_the_sheet_is_built_once(spark, key, monkeypatch):
    built, real = [], SI.driver_sheet
    monkeypatch.setattr(SI, "driver_sheet", lambda *a: (built.append(a), real(*a))[1])
    df = queries()[key](spark, SF_SMALL)
    assert len(built) == 1 and "lineitem" not in _reads(df) and "orders" not in _reads(df)


def test_payments_are_parsed_once_over_all_tasks(spark):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert C.headers(spark, SF_SMALL).rdd.getNumPartitions() == parts > 1
    sales = spark.createDataFrame([(1, "Cash: N5 Access Bank: N7"), (2, "Cash: x"), (3, None), (4, "Chips: N1")], "sale_id long, t string")
    paid, lost = C.RV.payment_rows(sales.select("sale_id", C.S.parse_payments("t").alias("payments")), C.RV.account_table(spark))
    for df in (paid, lost):
        assert "/tables/payments-" in _reads(df) and "regexp_extract_all" not in _plan(df)
    assert sorted((r["sale_id"], r["pos"], r["account"], r["amount"]) for r in paid.collect()) == [
        (1, 0, "CASH PAYMENT", "5"), (1, 1, "ACCESS BANK", "7")]
    assert [(r["sale_id"], r["channel"]) for r in lost.collect()] == [(4, "CHIPS")]


def test_report_lines_are_not_dealt_by_customer(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = C.clean(spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    by_customer = plan[plan.index("SortMergeJoin [o_custkey"):]
    assert "l_orderkey" not in by_customer


def test_receipts_move_no_page_text_and_cut_each_text_once(spark):
    plan = C.receipt_pages(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "collect_list" in x and "tbody" in x]
    cut = RC.extract_receipts(spark.createDataFrame([(1, "u", "")], "page_id long, url string, html string"))
    assert cut._jdf.queryExecution().optimizedPlan().toString().count("transform(") <= 20
