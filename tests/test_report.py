"""Ordered tables, the report in one pass, the tracker's quarantine."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tests.conftest import SF_SMALL
from tillpoint.operators import compare as CP
from tillpoint.operators import rollups as R
from tillpoint.plans import catalog as C
from tillpoint.plans import report as RP
from tillpoint.sinks import ordered as OD
from tillpoint.sources import sheets as SH


def test_files_follow_the_order_and_a_hot_key_is_split(spark, tmpdir_path):
    rows = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 37 % 101).alias("k"),
                                    (F.col("id") * 991 % 6000).alias("t"), F.lit(None).cast("string").alias("empty"))
    path = OD.write_in_order(rows, os.path.join(tmpdir_path, "t"), F.desc("k"), "t", files=8)
    files = OD.files_in_order(spark, path)
    assert len(files) == 8 and sum(n for _, n in files) == 6000
    ends = {r["f"]: r for r in spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("f")).agg(
        F.min(F.struct(-F.col("k"), "t")).alias("lo"), F.max(F.struct(-F.col("k"), "t")).alias("hi")).collect()}
    assert all(ends[a]["hi"] < ends[b]["lo"] for (a, _), (b, _) in zip(files, files[1:]))
    assert sum(1 for f in ends.values() if f["lo"][0] <= -7 <= f["hi"][0]) > 1
    got = [(r["k"], r["t"]) for r in OD.read_in_order(spark, path).orderBy("position").collect()]
    assert got == sorted(((r["k"], r["t"]) for r in rows.collect()), key=lambda r: (-r[0], r[1]))
    assert [r["position"] for r in OD.read_in_order(spark, path).orderBy("position").collect()] == list(range(1, 6001))


def test_order_with_ties_nulls_and_limited_files(spark, tmpdir_path):
    rows = spark.createDataFrame([(None, 1), (2, 1), (2, 1), (None, 0), (1, 5)] * 20, "k int, v int")
    path = os.path.join(tmpdir_path, "t")
    with_limit = rows.repartitionByRange(3, "k", "v").sortWithinPartitions("k", "v").write.option("maxRecordsPerFile", 7)
    with_limit.parquet(path)
    got = [(r["k"], r["v"]) for r in OD.read_in_order(spark, path).orderBy("position").collect()]
    assert got == [(None, 0)] * 20 + [(None, 1)] * 20 + [(1, 5)] * 20 + [(2, 1)] * 40
    empty = OD.write_in_order(rows.limit(0), os.path.join(tmpdir_path, "e"), "k")
    assert OD.read_in_order(spark, empty).count() == 0


def _same(a, b):
    def canon(df):
        cols = sorted(df.columns)
        return sorted(repr([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.select(*cols).collect())
    assert sorted(a.columns) == sorted(b.columns)
    assert canon(a) == canon(b)


LINES = ("sale_id long, invoice_datetime timestamp_ntz, item_name string, category string, customer_name string, "
         "salesperson string, quantity double, unit_price double, subtotal double")


def _lines(spark, n=400):
    """Null keys, null amounts, several dates and hours in one sale."""
    def day(i):
        return None if i % 17 == 0 else dt.datetime(1996, 1, 1) + dt.timedelta(hours=i * 41)
    rows = [(None if i % 23 == 0 else i % 90, day(i), None if i % 19 == 0 else f"p{i % 31}", None if i % 13 == 0 else f"c{i % 5}",
             None if i % 11 == 0 else f"u{i % 20}", None if i % 7 == 0 else f"s{i % 4}", float(i % 6), None if i % 29 == 0 else i * 311.0,
             None if i % 37 == 0 else i * 7.25) for i in range(n)]
    return spark.createDataFrame(rows, LINES)


P1, P2 = ("1996-01-01", "1997-01-01"), ("1997-01-01", "1998-01-01")


def test_sheets_of_one_pass_equal_the_single_rollups(spark):
    lines = _lines(spark)
    c = RP.cube(lines, P1, P2)
    for sheet, one in (("executive_kpis", RP._executive_kpis), ("categories", RP._categories), ("weekdays", RP._weekdays),
                       ("daily", RP._daily), ("price_bands", RP._price_bands), ("top_products", RP._top_products),
                       ("best_day", RP._best_day), ("top_customers", RP._top_customers), ("staff", RP._staff)):
        _same(one(c), RP.SHEETS[sheet](lines))
    _same(RP._hours(c), R.hour_buckets(lines))
    _same(RP._comparison(c, P1, P2), CP.period_metrics(lines, P1, P2))
    _same(CP.changes(RP._both_periods(c, "period_categories", "category"), "category"), CP.period_categories(lines, P1, P2))
    _same(CP.newcomers(RP._both_periods(c, "period_products", "item_name"), "item_name", 3, 10),
          CP.new_products(lines, P1, P2, prior_top=3))


def test_report_of_no_lines(spark):
    none = _lines(spark).limit(0)
    c = RP.cube(none, P1, P2)
    assert RP._categories(c).count() == 0 and RP._weekdays(c).filter("revenue = 0").count() == 7
    _same(RP._executive_kpis(c), R.kpi_totals(none))


@pytest.mark.parametrize("key", ["period_categories", "new_products", "decision_flags"])
def test_lines_are_scanned_once(spark, key, monkeypatch):
    scans = []

    def counted(spark, sf, name, _table=C.SI.table):
        scans.append(name)
        return _table(spark, sf, name)

    monkeypatch.setattr(C.SI, "table", counted)
    queries()[key](spark, SF_SMALL)
    assert scans.count("lineitem") == 1


def test_cube_scans_the_lines_once(spark):
    lines = C.clean(spark, SF_SMALL)
    seen = []
    real = RP.materialize
    try:
        RP.materialize = lambda df, name: (seen.append(df._jdf.queryExecution().executedPlan().toString()), real(df, name))[1]
        c = RP.cube(lines, P1, P2)
    finally:
        RP.materialize = real
    plan = seen[0].split("Initial Plan")[-1]
    assert sum("FileScan parquet" in ln and "l_orderkey" in ln for ln in plan.split("\n")) == 1
    for sheet in (RP._categories(c), RP._top_products(c), RP._best_day(c)):
        assert "l_orderkey" not in sheet._jdf.queryExecution().executedPlan().toString()


def test_cube_sums_are_exact_and_not_decimal(spark):
    """Amounts whose cents together exceed a long, next to single cents."""
    big = [(1, 9.9e15), (1, 9.9e15), (2, 0.01), (2, -0.03), (3, None)] * 30
    lines = spark.createDataFrame([(s, dt.datetime(1996, 5, 1, 9), "i", "c", "n", "p", 1.5, None, x) for s, x in big], LINES)
    c = RP.cube(lines, P1, P2)
    r = c.all("all").first()
    assert str(r["rev"]) == "593999999999999999.40" and r["transactions"] == 3 and r["units"] == 225.0 and r["n_prices"] == 0
    seen, real = [], RP.materialize
    try:
        RP.materialize = lambda df, name: (seen.append(df._jdf.queryExecution().optimizedPlan().toString()), real(df, name))[1]
        RP.cube(lines, P1, P2)
    finally:
        RP.materialize = real
    assert [x for x in seen[0].split("\n") if "Aggregate" in x] and "sum(rev_u" in seen[0] and "sum(rev#" not in seen[0]


def test_tracker_quarantine(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t.csv")
    with open(path, "w") as f:
        f.write("product,posted_date,first_sale_date,days_to_first_sale,sold_within_3_days\n"
                "a,2024-01-01,2024-01-03,2,true\n"
                "\"b, c\",2024-01-01,,,\n"
                "d,soon,2024-01-03,2,true\n"
                "e,2024-01-01,2024-01-03,two,true\n"
                "f,2024-01-01,2024-01-03,2,perhaps\n"
                ",2024-01-01,,,\n"
                "g,,,,\n"
                "h,2024-01-05,2024-01-03,-2,false\n"
                "i,2024-01-01,2024-01-03,3,true\n"
                "j,2024-01-01\n")
    good, held = SH.read_tracker_csv(spark, path)
    assert sorted(r["product"] for r in good.collect()) == ["a", "b, c"]
    assert {(r["product"], r["reason"]) for r in held.collect()} == {
        ("d", "unreadable"), ("e", "unreadable"), ("f", "unreadable"), (None, "missing_product"),
        ("g", "missing_posted_date"), ("h", "sold_before_posted"), ("i", "days_mismatch"), ("j", "unreadable")}
    assert {r["raw"] for r in held.filter("reason = 'unreadable'").collect()} >= {"d,soon,2024-01-03,2,true", "j,2024-01-01"}
    with open(path, "w") as f:
        f.write("item,posted_date,first_sale_date,days_to_first_sale,sold_within_3_days\na,2024-01-01,,,\n")
    with pytest.raises(Exception, match="(?i)header"):
        SH.read_tracker_csv(spark, path)
