"""T-invariant and brute-force checks of operators whose edge cases the
driver tables do not reach."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tillpoint.operators import conversion as CV
from tillpoint.operators import quality as QY
from tillpoint.operators import rollups as R
from tillpoint.plans import catalog as C
from tillpoint.sinks import tables as TB


def test_shares_sum_to_one(spark):
    for key, col in [("category_rollup", "share"), ("weekday_rollup", "share"),
                     ("hour_buckets", "share"), ("price_bands", "pct_revenue"),
                     ("staff_rollup", "share"), ("payment_mix", "share")]:
        total = C.QUERIES[key](spark, SF_SMALL).agg(F.sum(col)).first()[0]
        assert abs(total - 1.0) < 1e-9, key


def test_rollups_add_up_to_total(spark):
    lines = C.clean(spark, SF_SMALL, ("category",))
    total = R.kpi_totals(lines).first()["revenue"]
    for df in [R.category_rollup(lines), R.daily_rollup(lines), R.price_bands(lines)]:
        assert abs(df.agg(F.sum("revenue")).first()[0] - total) < 1e-3


def test_best_day_is_a_sales_day(spark):
    bd = C.QUERIES["best_day"](spark, SF_SMALL).collect()
    wk = {r.day_of_week for r in C.QUERIES["weekday_rollup"](spark, SF_SMALL).filter("revenue > 0").collect()}
    assert all(r.day_of_week in wk for r in bd)


def test_run_summary_adds_up(spark):
    r = C.QUERIES["run_summary"](spark, SF_SMALL).first()
    assert r.loaded == r.inserted + r.duplicates + r.failed


def test_rolling_failure_brute_force_across_chunks(spark):
    random.seed(3)
    base = dt.datetime(2024, 1, 1, 0, 59, 30)
    rows = []
    for comp in (1, 2):
        t = base
        for _ in range(300):
            t = t + dt.timedelta(microseconds=random.randint(1, 900_000))
            rows.append((comp, t, random.random() < 0.6))
    ev = spark.createDataFrame(rows, "component long, ts timestamp_ntz, is_error boolean")
    got = {(r.component, r.ts): (r.calls, r.failures, r.trip)
           for r in QY.rolling_failure(ev, chunk_s=20).collect()}
    exp = {}
    for comp, ts, err in rows:
        if not err:
            continue
        win = [e for c, t2, e in rows if c == comp and ts - dt.timedelta(seconds=10) < t2 <= ts]
        calls, fails = len(win), sum(win)
        exp[(comp, ts)] = (calls, fails, fails >= 5 or (calls >= 10 and fails / calls >= 0.5))
    assert got == exp


def test_first_sale_after_brute_force(spark):
    random.seed(5)
    d0 = dt.date(2026, 1, 1)
    posts = [(random.choice("ABC"), d0 + dt.timedelta(days=random.randint(0, 30))) for _ in range(60)]
    sales = [(random.choice("ABC"), d0 + dt.timedelta(days=random.randint(0, 30))) for _ in range(25)]
    p = spark.createDataFrame(posts, "product string, posted_date date")
    s = spark.createDataFrame(sales, "product string, sale_date date")
    got = sorted((r.product, r.posted_date, r.first_sale_date)
                 for r in CV.first_sale_after(p, s).collect())
    exp = sorted((pr, pd_, min([sd for sp, sd in sales if sp == pr and sd >= pd_], default=None))
                 for pr, pd_ in posts)
    assert got == exp


def test_upsert_and_replace_are_idempotent(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "pos_sale_id long, v string")
    incoming = spark.createDataFrame([(2, "B"), (4, "d")], "pos_sale_id long, v string")
    once = TB.upsert(target, incoming)
    twice = TB.upsert(once, incoming)
    assert sorted(once.collect()) == sorted(twice.collect())
    assert sorted(tuple(r) for r in once.collect()) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    kids = spark.createDataFrame([(1, 10), (2, 20), (2, 21), (3, 30)], "pos_sale_id long, item long")
    parents = spark.createDataFrame([(2,), (3,)], "pos_sale_id long")
    new_kids = spark.createDataFrame([(2, 22)], "pos_sale_id long, item long")
    out = sorted(tuple(r) for r in TB.replace_children(kids, parents, new_kids).collect())
    assert out == [(1, 10), (2, 22)]   # sale 3 arrived without children: cleared


def test_ledger_scope(spark):
    from tillpoint.operators import ledger as LG
    inc = spark.createDataFrame([(1, True), (2, True), (3, False)], "sale_id long, accepted boolean")
    led = spark.createDataFrame([(1, "x")], "sale_id long, fingerprint string")
    assert sorted(r.sale_id for r in LG.new_sales(inc, led).collect()) == [2]
    assert sorted(r.sale_id for r in LG.new_sales(inc, led, scope="run").collect()) == [1, 2]
    s = LG.run_summary(LG.tag_outcomes(inc, led)).first()
    assert (s.loaded, s.inserted, s.duplicates, s.failed) == (3, 1, 1, 1)
