"""Operator tests on the fixture rows described in FIXTURES.md."""

import datetime as dt

from pyspark.sql import functions as F

from tillpoint import constants as K
from tillpoint.functions.fuzzy import best_match
from tillpoint.operators import conversion as CV
from tillpoint.operators import fuzzy_match as FZ
from tillpoint.operators import quality as QY
from tillpoint.operators import resolve as RV
from tillpoint.operators import sales as SA


def test_conversion_fixture(spark):
    d = dt.date(2026, 4, 1)
    posts = spark.createDataFrame([("A", d), ("B", d), ("C", d), ("D", d), ("D", d)],
                                  "product string, posted_date date")
    sales = spark.createDataFrame([("A", d), ("B", d + dt.timedelta(3)), ("C", d + dt.timedelta(5)),
                                   ("C", d - dt.timedelta(1))], "product string, sale_date date")
    t = {(r.product): r for r in CV.tracker(CV.first_sale_after(posts, sales)).collect()}
    assert (t["A"].days_to_first_sale, t["A"].status) == (0, "YES")
    assert (t["B"].days_to_first_sale, t["B"].status) == (3, "YES")
    assert (t["C"].days_to_first_sale, t["C"].status) == (5, "Delayed")
    assert (t["D"].first_sale_date, t["D"].status) == (None, "No Sale")
    conv = CV.first_sale_after(posts, sales)
    assert conv.count() == 5                                  # duplicate post kept
    assert CV.non_converting(conv).count() == 1               # ... but counted once
    k = CV.conversion_kpis(conv).first()
    assert (k.posts, k.converted, k.non_converted) == (5, 3, 1)
    assert abs(k.avg_days - 8 / 3) < 1e-12 and abs(k.share_within_3 - 2 / 3) < 1e-12


def _page(headers):
    ths = "".join(f"<th> {h} </th>" for h in headers)
    return f"<!DOCTYPE html><html><table class='sales-table'><thead><tr>{ths}</tr></thead></table></html>"


def test_schema_drift_and_page_checks(spark):
    pages = spark.createDataFrame([
        (1, "u", _page(["Sale Id", "Date", "Total"])),
        (2, "u", "<html><body>no records found" + " " * 100 + "</body></html>"),   # no headers
        (3, "u", _page(["Sale Id", "Date", "Total"])),
        (4, "u", _page(["Sale ID", "When", "Total"])),        # changed headers
        (5, "u", "short"),
    ], "page_id long, url string, html string")
    drift = {r.page_id: r.drift for r in QY.schema_drift(pages, QY.TH_TEXT).collect()}
    assert drift == {1: False, 3: False, 4: True}
    q = {r.page_id: r for r in QY.page_quality(pages).collect()}
    assert q[5].is_short and q[5].not_html and q[5].is_empty
    assert q[2].is_empty and not q[2].not_html and not q[2].is_short
    assert not q[1].is_empty and not q[1].not_html


def test_error_rate_zero_processed_guard(spark):
    reports = spark.createDataFrame([("a", False), ("a", True), ("b", False)],
                                    "component string, is_error boolean")
    r = {x.component: x for x in QY.error_rate(reports).collect()}
    assert r["a"].error_rate == 0.5 and r["a"].alert and r["b"].error_rate == 0.0


def test_payment_accounts_match_brute_force(spark):
    sales = spark.createDataFrame([
        (1, "Cash: N5,000.00 Store Account: -N2,000"), (2, "Moniepoint: N300 Access Bank: N10"),
        (3, "Trade by Barter: N50"), (4, "Stanbic IBTC: N7 Moniepoint POS: N1")],
        "sale_id long, payment_type string")
    pays = SA.sale_payments(sales)
    accounts = RV.account_table(spark)
    best = FZ.fuzzy_best(pays.select("channel").distinct(), "channel", accounts, "bank_name", "_ord") \
        .select("channel", F.col("match").alias("matched"))
    res = RV.resolve_payment_accounts(pays.join(best, "channel", "left"), accounts)
    ok, dropped = RV.split_unresolved(res)
    got = {(r.sale_id, r.channel): r.account for r in ok.collect()}
    exp = {}
    for sid, text in [(1, "CASH"), (1, "STORE ACCOUNT"), (2, "MONIEPOINT"), (2, "ACCESS BANK"),
                      (3, "TRADE BY BARTER"), (4, "STANBIC IBTC"), (4, "MONIEPOINT POS")]:
        acc = K.STORE_ACCOUNT_TARGET if K.STORE_ACCOUNT_MARKER in text else best_match(text, K.ACCOUNT_NAMES)
        if acc is not None:
            exp[(sid, text)] = acc
    assert got == exp
    assert {(r.sale_id, r.channel) for r in dropped.collect()} == {(3, "TRADE BY BARTER"), (4, "MONIEPOINT POS")}
    ids = {r.bank_name: r.id for r in accounts.collect()}
    assert all(r.account_id == ids[r.account] for r in ok.collect())
