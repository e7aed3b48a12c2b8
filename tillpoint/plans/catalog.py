"""Query catalog: every implemented operator as a query over the driver
tables, with its DuckDB oracle SQL next to it.

``QUERIES[key](spark, sf_dir) -> DataFrame`` and ``ORACLE[key] -> str``.
Keys without an ``ORACLE`` entry are not expressible in SQL (fuzzy match,
HTML extraction, streaming) and are checked on row counts by the driver and
against brute force in ``tests/``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpoint.operators import lines as L
from tillpoint.operators import rollups as R
from tillpoint.plans import standin as SI
from tillpoint.plans.sqlparts import (CLEAN, EVENT_LINES, LINES, div, money, qty,
                                      with_)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def clean(spark, sf, need=("category", "customer", "salesperson")) -> DataFrame:
    """Report filter P5 over the stand-in lines; the item name it tests
    comes from ``part``, so that dimension is always joined."""
    return L.clean_lines(SI.driver_lines(spark, sf, tuple(need) + ("item_name",)),
                         SI.REPORT_START)


WC = with_(LINES, CLEAN)

# --------------------------------------------------------------- filters


@register("clean_lines", WC + """
SELECT sale_id, invoice_datetime, item_name, category, quantity, subtotal FROM clean""")
def q_clean_lines(spark, sf):
    return clean(spark, sf, ("category",)).select(
        "sale_id", "invoice_datetime", "item_name", "category", "quantity", "subtotal")


@register("clean_lines_cat", with_(LINES) + """
SELECT sale_id, category, line_total FROM lines WHERE category IS DISTINCT FROM 'Discount'""")
def q_clean_lines_cat(spark, sf):
    return L.clean_lines_cat(SI.driver_lines(spark, sf, ("category",))).select(
        "sale_id", "category", "line_total")


# --------------------------------------------------------------- rollups

@register("kpi_totals", WC + f"""
SELECT revenue, transactions, units, days, {div('revenue', 'days')} AS revenue_per_day,
       {div('revenue', 'transactions')} AS avg_basket, {div('_ps', '_pn')} AS avg_price
FROM (SELECT {money('subtotal')} AS revenue, COUNT(DISTINCT sale_id) AS transactions,
             {qty('quantity')} AS units, COUNT(DISTINCT CAST(invoice_datetime AS DATE)) AS days,
             {money('unit_price')} AS _ps, COUNT(unit_price) AS _pn FROM clean) t""")
def q_kpi_totals(spark, sf):
    return R.kpi_totals(clean(spark, sf, ()))


@register("category_rollup", WC + f"""
SELECT category, revenue, units, transactions, {div('revenue', 'units')} AS avg_price,
       {div('revenue', f'(SELECT {money("subtotal")} FROM clean)')} AS share
FROM (SELECT category, {money('subtotal')} AS revenue, {qty('quantity')} AS units,
             COUNT(DISTINCT sale_id) AS transactions
      FROM clean WHERE category IS NOT NULL GROUP BY category) g""")
def q_category_rollup(spark, sf):
    return R.category_rollup(clean(spark, sf, ("category",)))


@register("category_rollup_mean", with_(LINES) + f"""
SELECT category, revenue, qty, {div('_ps', '_pn')} AS avg_price
FROM (SELECT category, {money('line_total')} AS revenue, {qty('quantity')} AS qty,
             {money('unit_price')} AS _ps, COUNT(unit_price) AS _pn
      FROM lines WHERE category IS DISTINCT FROM 'Discount' AND category IS NOT NULL
      GROUP BY category) g""")
def q_category_rollup_mean(spark, sf):
    return R.category_rollup_mean(L.clean_lines_cat(SI.driver_lines(spark, sf, ("category",))))


_CAL = """cal AS (SELECT * FROM (VALUES (0,'Monday'),(1,'Tuesday'),(2,'Wednesday'),
  (3,'Thursday'),(4,'Friday'),(5,'Saturday'),(6,'Sunday')) t(day_ord, day_of_week))"""


@register("weekday_rollup", with_(LINES, CLEAN, _CAL) + f"""
, g AS (SELECT dayname(invoice_datetime) AS day_of_week, {money('subtotal')} AS revenue,
               {qty('quantity')} AS units, COUNT(DISTINCT sale_id) AS transactions
        FROM clean WHERE invoice_datetime IS NOT NULL GROUP BY 1)
SELECT cal.day_ord, cal.day_of_week, COALESCE(g.revenue, 0.0) AS revenue,
       COALESCE(g.units, 0.0) AS units, COALESCE(g.transactions, 0) AS transactions,
       {div('COALESCE(g.revenue, 0.0)', f'(SELECT {money("subtotal")} FROM clean WHERE invoice_datetime IS NOT NULL)')} AS share
FROM cal LEFT JOIN g USING (day_of_week)""")
def q_weekday_rollup(spark, sf):
    return R.weekday_rollup(clean(spark, sf, ()))


_DAILY = f"""daily AS (
  SELECT CAST(invoice_datetime AS DATE) AS sale_date, {money('subtotal')} AS revenue,
         {qty('quantity')} AS units, COUNT(DISTINCT sale_id) AS transactions
  FROM clean WHERE invoice_datetime IS NOT NULL GROUP BY 1)"""


@register("daily_rollup", with_(LINES, CLEAN, _DAILY) + f"""
SELECT sale_date, dayname(sale_date) AS day_of_week, revenue, units, transactions,
       {div('revenue', 'transactions')} AS avg_basket FROM daily""")
def q_daily_rollup(spark, sf):
    return R.daily_rollup(clean(spark, sf, ()))


@register("daily_vs_avg", with_(LINES, CLEAN, _DAILY) + f"""
, a AS (SELECT {div(money('subtotal'), 'COUNT(DISTINCT CAST(invoice_datetime AS DATE))')} AS avg FROM clean)
SELECT sale_date, dayname(sale_date) AS day_of_week, revenue, transactions, a.avg AS period_avg,
       {div('revenue - a.avg', 'a.avg')} AS vs_avg,
       CASE WHEN {div('revenue - a.avg', 'a.avg')} > 0 THEN 'up'
            WHEN {div('revenue - a.avg', 'a.avg')} < -0.2 THEN 'down' ELSE 'flat' END AS band
FROM daily, a""")
def q_daily_vs_avg(spark, sf):
    return R.daily_vs_avg(clean(spark, sf, ()))


@register("peak_day", with_(LINES, CLEAN, _DAILY) + f"""
SELECT sale_date, dayname(sale_date) AS day_of_week, revenue, units, transactions,
       {div('revenue', 'transactions')} AS avg_basket FROM daily
ORDER BY revenue DESC, sale_date LIMIT 1""")
def q_peak_day(spark, sf):
    return R.peak_day(clean(spark, sf, ()))


@register("top_products", WC + f"""
SELECT *, CAST(row_number() OVER (ORDER BY revenue DESC, item_name, category) AS INTEGER) AS rank
FROM (SELECT item_name, category, revenue, units, transactions,
             {div('revenue', 'units')} AS avg_price, {div('revenue', 'transactions')} AS rev_per_txn
      FROM (SELECT item_name, category, {money('subtotal')} AS revenue, {qty('quantity')} AS units,
                   COUNT(DISTINCT sale_id) AS transactions FROM clean
            WHERE item_name IS NOT NULL AND category IS NOT NULL GROUP BY 1, 2) g
      ORDER BY revenue DESC, item_name, category LIMIT 25) t""")
def q_top_products(spark, sf):
    return R.top_products(clean(spark, sf, ("category",)))


@register("top_products_mean", with_(LINES) + f"""
SELECT item_name, category, revenue, qty, transactions, {div('_ps', '_pn')} AS avg_price,
       {div('revenue', 'transactions')} AS rev_per_txn
FROM (SELECT item_name, category, {money('line_total')} AS revenue, {qty('quantity')} AS qty,
             COUNT(DISTINCT sale_id) AS transactions, {money('unit_price')} AS _ps,
             COUNT(unit_price) AS _pn
      FROM lines WHERE category IS DISTINCT FROM 'Discount'
        AND item_name IS NOT NULL AND category IS NOT NULL GROUP BY 1, 2) g
ORDER BY revenue DESC, item_name, category LIMIT 20""")
def q_top_products_mean(spark, sf):
    return R.top_products_mean(L.clean_lines_cat(SI.driver_lines(spark, sf, ("category",))))


_HB = """CASE WHEN hour(invoice_datetime) < 11 THEN 'Morning(<11)' WHEN hour(invoice_datetime) < 13
  THEN 'Midday(11-1)' WHEN hour(invoice_datetime) < 18 THEN 'Afternoon(1-6)' ELSE 'Evening(6-9)' END"""
_HBO = """CASE WHEN hour(invoice_datetime) < 11 THEN 0 WHEN hour(invoice_datetime) < 13 THEN 1
  WHEN hour(invoice_datetime) < 18 THEN 2 ELSE 3 END"""


@register("hour_buckets", with_(EVENT_LINES) + f"""
SELECT bucket_ord, time_bucket, transactions, revenue,
       {div('revenue', f'(SELECT {money("subtotal")} FROM elines WHERE invoice_datetime IS NOT NULL)')} AS share
FROM (SELECT {_HBO} AS bucket_ord, {_HB} AS time_bucket, COUNT(DISTINCT sale_id) AS transactions,
             {money('subtotal')} AS revenue FROM elines WHERE invoice_datetime IS NOT NULL
      GROUP BY 1, 2) g""")
def q_hour_buckets(spark, sf):
    return R.hour_buckets(SI.driver_event_lines(spark, sf))


_H6 = "hour(invoice_datetime)"
_HB6 = f"""CASE WHEN {_H6} > 0 AND {_H6} <= 6 THEN 'Night(0-6)' WHEN {_H6} > 6 AND {_H6} <= 11 THEN 'Morning(7-11)'
  WHEN {_H6} > 11 AND {_H6} <= 13 THEN 'Midday(11-1)' WHEN {_H6} > 13 AND {_H6} <= 18 THEN 'Afternoon(1-6)'
  WHEN {_H6} > 18 AND {_H6} <= 21 THEN 'Evening(6-9)' WHEN {_H6} > 21 AND {_H6} <= 24 THEN 'Late(9+)' END"""
_HB6O = f"""CASE WHEN {_H6} > 0 AND {_H6} <= 6 THEN 0 WHEN {_H6} > 6 AND {_H6} <= 11 THEN 1
  WHEN {_H6} > 11 AND {_H6} <= 13 THEN 2 WHEN {_H6} > 13 AND {_H6} <= 18 THEN 3
  WHEN {_H6} > 18 AND {_H6} <= 21 THEN 4 WHEN {_H6} > 21 AND {_H6} <= 24 THEN 5 END"""


@register("hour_buckets_six", with_(EVENT_LINES) + f"""
SELECT {_HB6O} AS bucket_ord, {_HB6} AS hb, COUNT(DISTINCT sale_id) AS transactions,
       {money('line_total')} AS revenue
FROM elines WHERE {_HB6} IS NOT NULL GROUP BY 1, 2""")
def q_hour_buckets_six(spark, sf):
    return R.hour_buckets_six(SI.driver_event_lines(spark, sf))


def _band_sql(x: str, capped: bool, labels: bool) -> str:
    edges = [0, 5000, 10000, 20000, 30000, 50000, 100000, 500000 if capped else None]
    names = ["<5k", "5-10k", "10-20k", "20-30k", "30-50k", "50-100k", ">100k"]
    parts = []
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        cond = f"{x} > {lo}" + (f" AND {x} <= {hi}" if hi is not None else "")
        val = f"'{names[i]}'" if labels else str(i)
        parts.append(f"WHEN {cond} THEN {val}")
    return "CASE " + " ".join(parts) + " END"


@register("price_bands", WC + f"""
, b AS (SELECT {_band_sql('unit_price', False, False)} AS band_ord,
               {_band_sql('unit_price', False, True)} AS price_bucket, * FROM clean)
SELECT band_ord, price_bucket, COUNT(item_name) AS line_items, {qty('quantity')} AS units,
       {money('subtotal')} AS revenue,
       {div(money('subtotal'), f'(SELECT {money("subtotal")} FROM b WHERE price_bucket IS NOT NULL)')} AS pct_revenue
FROM b WHERE price_bucket IS NOT NULL GROUP BY 1, 2""")
def q_price_bands(spark, sf):
    return R.price_bands(clean(spark, sf, ("category",)))


@register("price_bands_capped", with_(LINES) + f"""
, b AS (SELECT {_band_sql('unit_price', True, False)} AS band_ord,
               {_band_sql('unit_price', True, True)} AS price_bucket, * FROM lines
        WHERE category IS DISTINCT FROM 'Discount')
SELECT band_ord, price_bucket, COUNT(pos_item_id) AS count, {qty('quantity')} AS qty,
       {money('line_total')} AS revenue,
       {div(money('line_total'), f'(SELECT CAST(TRUNC(COALESCE(SUM(CAST(line_total AS DECIMAL(18,2))), 0)) AS BIGINT) FROM b WHERE price_bucket IS NOT NULL)')} * 100 AS pct
FROM b WHERE price_bucket IS NOT NULL GROUP BY 1, 2""")
def q_price_bands_capped(spark, sf):
    return R.price_bands_capped(L.clean_lines_cat(SI.driver_lines(spark, sf, ("category",))))


@register("top_customers", WC + f"""
SELECT trim(customer_name) AS customer_name, revenue, transactions, units,
       {div('revenue', 'transactions')} AS avg_basket,
       {div('revenue', f'(SELECT {money("subtotal")} FROM clean)')} AS share,
       CAST(row_number() OVER (ORDER BY revenue DESC, customer_name) AS INTEGER) AS rank
FROM (SELECT customer_name, {money('subtotal')} AS revenue, COUNT(DISTINCT sale_id) AS transactions,
             {qty('quantity')} AS units FROM clean WHERE customer_name IS NOT NULL GROUP BY 1
      ORDER BY revenue DESC, customer_name LIMIT 15) t""")
def q_top_customers(spark, sf):
    return R.top_customers(clean(spark, sf, ("customer",)))


@register("top_customers_share", with_(LINES) + f"""
, g AS (SELECT customer_name, COALESCE(SUM(CAST(line_total AS DECIMAL(18,2))), 0) AS _rev,
               COUNT(DISTINCT sale_id) AS transactions FROM lines
        WHERE category IS DISTINCT FROM 'Discount' AND customer_name IS NOT NULL GROUP BY 1
        ORDER BY _rev DESC, customer_name LIMIT 10)
SELECT customer_name, CAST(_rev AS DOUBLE) AS revenue, transactions,
       {div('CAST(_rev AS DOUBLE)', 'transactions')} AS spend_per_visit,
       {div('CAST(_rev AS DOUBLE)', '(SELECT CAST(TRUNC(SUM(_rev)) AS BIGINT) FROM g)')} * 100 AS share_pct
FROM g""")
def q_top_customers_share(spark, sf):
    return R.top_customers_share(L.clean_lines_cat(SI.driver_lines(spark, sf, ("category", "customer"))))


@register("top3_share", WC + f"""
, g AS (SELECT customer_name, COALESCE(SUM(CAST(subtotal AS DECIMAL(18,2))), 0) AS _rev
        FROM clean WHERE customer_name IS NOT NULL GROUP BY 1 ORDER BY _rev DESC, customer_name LIMIT 3)
SELECT top3_revenue, total_revenue, {div('top3_revenue', 'total_revenue')} AS top3_share
FROM (SELECT COALESCE(CAST(SUM(_rev) AS DOUBLE), 0.0) AS top3_revenue,
             (SELECT {money('subtotal')} FROM clean) AS total_revenue FROM g) t""")
def q_top3_share(spark, sf):
    return R.top3_share(clean(spark, sf, ("customer",)))


LOOKUP_CUSTOMER = "Customer#000000001"


@register("customer_lookup", WC + f"""
SELECT '{LOOKUP_CUSTOMER}' AS customer_name, {money('subtotal')} AS revenue,
       COUNT(DISTINCT sale_id) AS transactions
FROM clean WHERE trim(customer_name) = '{LOOKUP_CUSTOMER}'""")
def q_customer_lookup(spark, sf):
    return R.customer_lookup(clean(spark, sf, ("customer",)), LOOKUP_CUSTOMER)


@register("best_day", WC + f"""
SELECT category, day_of_week, revenue FROM (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY revenue DESC, day_of_week) AS rn
  FROM (SELECT category, dayname(invoice_datetime) AS day_of_week, {money('subtotal')} AS revenue
        FROM clean WHERE category IS NOT NULL AND invoice_datetime IS NOT NULL GROUP BY 1, 2) g) t
WHERE rn = 1""")
def q_best_day(spark, sf):
    return R.best_day(clean(spark, sf, ("category",)))


@register("staff_rollup", WC + f"""
SELECT salesperson, {money('subtotal')} AS revenue, COUNT(DISTINCT sale_id) AS transactions,
       {div(money('subtotal'), f'(SELECT {money("subtotal")} FROM clean)')} AS share
FROM clean WHERE salesperson IS NOT NULL GROUP BY 1""")
def q_staff_rollup(spark, sf):
    return R.staff_rollup(clean(spark, sf, ("salesperson",)))


# =============================================================== ingestion / ETL
from tillpoint.functions import scalars as S  # noqa: E402
from tillpoint.operators import ledger as LG  # noqa: E402
from tillpoint.operators import resolve as RV  # noqa: E402
from tillpoint.operators import sales as SA  # noqa: E402
from tillpoint.plans.sqlparts import (PAYMENT_TEXT as PAYMENT_TEXT_O, PLINES,  # noqa: E402
                                      SALE_AGG, SHEET, change_due,
                                      clean_text, is_anon, parse_dt_multi, parse_int,
                                      parse_money, parse_sale_id, payments, stable_shard)
from tillpoint.session import by_shuffle, materialize, release_shuffles, scratch, settle  # noqa: E402
from tillpoint.sources.tables import table  # noqa: E402

WS = with_(SHEET, PLINES, SALE_AGG)


def sheet_lines(spark, sf):
    return SA.parsed_lines(SI.driver_sheet(spark, sf))


@register("sale_id_parse", with_(SHEET) + f"""
SELECT sale_id AS sale_id_raw, {parse_sale_id('sale_id')} AS sale_id FROM sheet""")
def q_sale_id_parse(spark, sf):
    return SI.driver_sheet(spark, sf).select(
        F.col("sale_id").alias("sale_id_raw"), S.parse_sale_id("sale_id").alias("sale_id"))


@register("normalise_lines", with_(SHEET, PLINES) + """
SELECT sale_id, pos_item_id, item_name, quantity FROM plines""")
def q_normalise_lines(spark, sf):
    return sheet_lines(spark, sf).select("sale_id", "pos_item_id", "item_name", "quantity")


@register("build_sales", WS + f"""
SELECT sale_id, {clean_text('invoice_datetime')} AS invoice_datetime_raw,
       {clean_text('salesperson')} AS salesperson, {clean_text('customer_name')} AS customer_name,
       {is_anon(clean_text('customer_name'))} AS is_anonymous_customer,
       NULLIF(trim(invoice_total), '') AS invoice_total_raw, {clean_text('comment')} AS comment, n_lines,
       items_sold, items_returned, CAST(len({payments('payment_type')}) AS INTEGER) AS n_payments,
       {change_due(payments('payment_type'))} AS change_due
FROM sagg""")
def q_build_sales(spark, sf):
    return SA.build_sales(sheet_lines(spark, sf))


@register("invoice_counts", WS + """
SELECT sale_id, items_sold, items_returned, items_sold - items_returned AS items_net, qty_exact
FROM sagg""")
def q_invoice_counts(spark, sf):
    return SA.invoice_counts(sheet_lines(spark, sf))


_REASONS_SQL = f"""list_filter([
  CASE WHEN {clean_text('salesperson')} IS NULL THEN 'missing_salesperson' END,
  CASE WHEN {parse_dt_multi('invoice_datetime')} IS NULL THEN 'bad_datetime' END,
  CASE WHEN {parse_money('invoice_total')} IS NULL THEN 'bad_invoice_total' END,
  CASE WHEN n_bad_item_id > 0 THEN 'bad_item_id' END,
  CASE WHEN n_bad_price > 0 THEN 'bad_item_price' END,
  CASE WHEN n_bad_qty > 0 THEN 'bad_item_quantity' END,
  CASE WHEN n_bad_total > 0 THEN 'bad_item_total' END,
  CASE WHEN COALESCE(list_bool_or(list_transform({payments('payment_type')},
       lambda p: {parse_money('p.amount')} IS NULL)), false) THEN 'bad_payment_amount' END
  ], lambda x: x IS NOT NULL)"""

_VALIDATED = f"""validated AS (
  SELECT sale_id, {parse_dt_multi('invoice_datetime')} AS invoice_datetime,
    {clean_text('salesperson')} AS salesperson,
    COALESCE({clean_text('customer_name')}, 'Unknown Customer') AS customer_name,
    {is_anon(clean_text('customer_name'))} AS is_anonymous_customer,
    CAST({parse_money('invoice_total')} AS DOUBLE) AS invoice_total,
    CAST({parse_money(change_due(payments('payment_type')))} AS DOUBLE) AS change_due,
    items_sold, items_returned, items_sold - items_returned AS items_net,
    {clean_text('comment')} AS comment, pos_customer_id,
    len({_REASONS_SQL}) = 0 AS accepted, array_to_string({_REASONS_SQL}, ',') AS reasons
  FROM sagg)"""

VALID_COLS = ["sale_id", "invoice_datetime", "salesperson", "customer_name",
              "is_anonymous_customer", "invoice_total", "change_due", "items_sold",
              "items_returned", "items_net", "comment", "accepted", "reasons"]


def written_lines(spark, sf, more=()):
    """What sales and their items are taken from of the sheet's lines, written
    once for a query that reads the lines in several steps."""
    return settle(sheet_lines(spark, sf).select("sale_id", "_row_no", *SA.HEADER_FIELDS, *SA.ITEM_FIELDS, *more), "lines")


def validated(spark, sf, lines=None):
    v = SA.validate_sales(sheet_lines(spark, sf) if lines is None else lines)
    return v.withColumn("invoice_total", F.col("invoice_total").cast("double")) \
        .withColumn("change_due", F.col("change_due").cast("double"))


@register("validate_sales", with_(SHEET, PLINES, SALE_AGG, _VALIDATED) + f"""
SELECT {', '.join(VALID_COLS)} FROM validated""")
def q_validate_sales(spark, sf):
    return validated(spark, sf).select(*VALID_COLS)


_REF = """ref AS (
  SELECT regexp_replace(lower(c_name), '^\\s+|\\s+$', '', 'g') AS _key,
         arg_max(c_custkey, c_custkey) AS _ref_id
  FROM customer WHERE c_name IS NOT NULL AND trim(c_name) <> '' GROUP BY 1)"""

# the stand-in drops the second letter of some names, so the right match of
# such a name is known; it is the only one without further edits
_RESOLVED = """typo AS (SELECT substr(_key, 1, 1) || substr(_key, 3) AS _typo, _key, _ref_id FROM ref),
resolved AS (
  SELECT v.*, COALESCE(r._ref_id, t._ref_id, 23) AS pos_customer_id_r,
         r._ref_id IS NULL AND t._ref_id IS NULL AS pos_customer_id_defaulted
  FROM (SELECT *, regexp_replace(lower(customer_name), '^\\s+|\\s+$', '', 'g') AS _name FROM validated) v
  LEFT JOIN ref r ON v._name = r._key LEFT JOIN typo t ON v._name = t._typo)"""


def resolved(spark, sf, v=None):
    v = validated(spark, sf) if v is None else v
    return RV.resolve_customers(v, table(spark, sf, "customer"))


@register("customer_resolve_exact", with_(SHEET, PLINES, SALE_AGG, _VALIDATED, _REF, _RESOLVED) + """
SELECT sale_id, customer_name, pos_customer_id_r AS pos_customer_id, pos_customer_id_defaulted
FROM resolved""")
def q_customer_resolve_exact(spark, sf):
    return resolved(spark, sf).select("sale_id", "customer_name", "pos_customer_id",
                                      "pos_customer_id_defaulted")


@register("db_row", with_(SHEET, PLINES, SALE_AGG, _VALIDATED, _REF, _RESOLVED) + """
SELECT sale_id AS pos_sale_id, invoice_total, pos_customer_id_r AS pos_customer_id, customer_name,
  salesperson, CASE WHEN epoch_us(invoice_datetime) % 1000000 = 0
    THEN strftime(invoice_datetime, '%Y-%m-%dT%H:%M:%S')
    ELSE strftime(invoice_datetime, '%Y-%m-%dT%H:%M:%S.%f') END AS invoice_datetime,
  comment, is_anonymous_customer, items_net, items_sold, items_returned
FROM resolved WHERE accepted""")
def q_db_row(spark, sf):
    return SA.db_row(resolved(spark, sf))


@register("reference_scan", """
SELECT c_custkey AS id, c_name AS first_name FROM customer
WHERE c_name IS NOT NULL AND c_name <> ''""")
def q_reference_scan(spark, sf):
    from tillpoint.sources.reference import read_reference
    return read_reference(table(spark, sf, "customer"), {"c_custkey": "id", "c_name": "first_name"},
                          key="first_name")


# ledger: sales loaded by earlier runs = accepted sales dated before the report start


# what the ledger and the outcome of a sale are taken from; the other columns of
# the validated sales need not be parsed nor written for them
LEDGER_COLS = ["sale_id", "invoice_datetime", "accepted"]


def ledger_of(v):
    return LG.ledger_rows(v.filter(F.col("accepted") & (F.col("invoice_datetime") <
                                   F.lit(SI.REPORT_START).cast("timestamp_ntz"))))


_LEDGER = f"""ledger AS (SELECT DISTINCT sale_id FROM validated
  WHERE accepted AND invoice_datetime < TIMESTAMP '{SI.REPORT_START}')"""


@register("dedup_ledger", with_(SHEET, PLINES, SALE_AGG, _VALIDATED, _LEDGER) + """
SELECT DISTINCT v.sale_id, sha256(CAST(v.sale_id AS VARCHAR)) AS fingerprint FROM validated v
WHERE v.accepted AND v.sale_id NOT IN (SELECT sale_id FROM ledger)""")
def q_dedup_ledger(spark, sf):
    v = materialize(validated(spark, sf).select(*LEDGER_COLS), "validated")
    return LG.ledger_rows(LG.new_sales(v, ledger_of(v)))


@register("run_summary", with_(SHEET, PLINES, SALE_AGG, _VALIDATED, _LEDGER) + """
SELECT COUNT(*) AS loaded,
  COUNT(*) FILTER (WHERE accepted AND sale_id NOT IN (SELECT sale_id FROM ledger)) AS inserted,
  COUNT(*) FILTER (WHERE accepted AND sale_id IN (SELECT sale_id FROM ledger)) AS duplicates,
  COUNT(*) FILTER (WHERE NOT accepted) AS failed
FROM validated""")
def q_run_summary(spark, sf):
    v = materialize(validated(spark, sf).select(*LEDGER_COLS), "validated")
    return LG.run_summary(LG.tag_outcomes(v, ledger_of(v)))


# ---------------------------------------------------------------- scalar parse family

@register("money_parse", with_(SHEET) + f"""
SELECT unit_price AS unit_price_raw, CAST({parse_money('unit_price')} AS DOUBLE) AS unit_price,
       invoice_total AS invoice_total_raw, CAST({parse_money('invoice_total')} AS DOUBLE) AS invoice_total
FROM sheet""")
def q_money_parse(spark, sf):
    return SI.driver_sheet(spark, sf).select(
        F.col("unit_price").alias("unit_price_raw"),
        S.parse_money("unit_price").cast("double").alias("unit_price"),
        F.col("invoice_total").alias("invoice_total_raw"),
        S.parse_money("invoice_total").cast("double").alias("invoice_total"))


@register("int_parse", with_(SHEET) + f"""
SELECT quantity AS quantity_raw, {parse_int('quantity')} AS quantity,
       pos_item_id AS pos_item_id_raw, {parse_int('pos_item_id')} AS pos_item_id FROM sheet""")
def q_int_parse(spark, sf):
    return SI.driver_sheet(spark, sf).select(
        F.col("quantity").alias("quantity_raw"), S.parse_int("quantity").alias("quantity"),
        F.col("pos_item_id").alias("pos_item_id_raw"), S.parse_int("pos_item_id").alias("pos_item_id"))


@register("date_parse", with_(SHEET) + """
SELECT invoice_datetime AS raw, try_strptime(regexp_replace(invoice_datetime, '^\\s+|\\s+$', '', 'g'), '%m/%d/%Y-%I:%M %p') AS parsed,
       CAST(try_strptime(regexp_replace(invoice_datetime, '^\\s+|\\s+$', '', 'g'), '%m/%d/%Y-%I:%M %p') AS DATE) AS sale_date,
       CAST(hour(try_strptime(regexp_replace(invoice_datetime, '^\\s+|\\s+$', '', 'g'), '%m/%d/%Y-%I:%M %p')) AS INTEGER) AS hour,
       dayname(try_strptime(regexp_replace(invoice_datetime, '^\\s+|\\s+$', '', 'g'), '%m/%d/%Y-%I:%M %p')) AS day_of_week
FROM sheet""")
def q_date_parse(spark, sf):
    t = S.parse_sheet_datetime("invoice_datetime")
    return SI.driver_sheet(spark, sf).select(
        F.col("invoice_datetime").alias("raw"), t.alias("parsed"), F.to_date(t).alias("sale_date"),
        F.hour(t).alias("hour"), S.day_name(t).alias("day_of_week"))


@register("date_parse_multi", f"""
WITH t AS (SELECT o_orderkey, CASE o_orderkey % 3
    WHEN 0 THEN strftime(o_orderdate + to_hours(o_orderkey % 24), '%m/%d/%Y-%I:%M %p')
    WHEN 1 THEN strftime(o_orderdate + to_hours(o_orderkey % 24), '%Y-%m-%dT%H:%M:%S')
    ELSE strftime(o_orderdate + to_hours(o_orderkey % 24), '%d/%m/%Y %H:%M:%S') END AS raw FROM orders)
SELECT o_orderkey, raw, {parse_dt_multi('raw')} AS parsed FROM t""")
def q_date_parse_multi(spark, sf):
    o = table(spark, sf, "orders")
    ts = F.timestamp_add("HOUR", F.col("o_orderkey") % 24, F.col("o_orderdate"))
    k = F.col("o_orderkey") % 3
    raw = F.when(k == 0, F.date_format(ts, "MM/dd/yyyy-hh:mm a")) \
        .when(k == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")) \
        .otherwise(F.date_format(ts, "dd/MM/yyyy HH:mm:ss"))
    return o.select("o_orderkey", raw.alias("raw")).select(
        "o_orderkey", "raw", S.parse_datetime_multi("raw").alias("parsed"))


@register("clean_text", with_(SHEET) + f"""
SELECT salesperson AS salesperson_raw, {clean_text('salesperson')} AS salesperson,
       customer_name AS customer_name_raw, {clean_text('customer_name')} AS customer_name FROM sheet""")
def q_clean_text(spark, sf):
    return SI.driver_sheet(spark, sf).select(
        F.col("salesperson").alias("salesperson_raw"), S.clean_text("salesperson").alias("salesperson"),
        F.col("customer_name").alias("customer_name_raw"),
        S.clean_text("customer_name").alias("customer_name"))


@register("anonymous_flag", with_(SHEET) + f"""
SELECT customer_name, {is_anon('customer_name')} AS is_anonymous_customer,
       COUNT(*) AS n_lines FROM sheet GROUP BY customer_name""")
def q_anonymous_flag(spark, sf):
    return SI.driver_sheet(spark, sf).groupBy("customer_name").agg(
        F.count(F.lit(1)).alias("n_lines")).select(
        "customer_name", S.is_anonymous("customer_name").alias("is_anonymous_customer"), "n_lines")


@register("fingerprints", """
SELECT o_orderkey AS sale_id, sha256(CAST(o_orderkey AS VARCHAR)) AS sale_fingerprint,
       md5(o_comment_text) AS text_fingerprint
FROM (SELECT o_orderkey, o_orderpriority || '|' || o_orderstatus AS o_comment_text FROM orders) t""")
def q_fingerprints(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("sale_id"),
                    S.fingerprint_sale("o_orderkey").alias("sale_fingerprint"),
                    S.fingerprint_page(F.concat_ws("|", "o_orderpriority", "o_orderstatus"))
                    .alias("text_fingerprint"))


SHARDS = 8


@register("stable_shard", f"""
SELECT o_orderkey AS sale_id, {stable_shard('o_orderkey', SHARDS)} AS shard FROM orders""")
def q_stable_shard(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("sale_id"), S.stable_shard("o_orderkey", SHARDS).alias("shard"))


# ------------------------------------------------------------------- payments

_HDR = f"""hdr AS (SELECT o_orderkey AS sale_id, o_orderdate AS invoice_datetime,
  {PAYMENT_TEXT_O} AS payment_type FROM orders o)"""


def headers(spark, sf):
    """The sale headers, dealt out over all tasks: their texts cost far more to
    parse than the few file splits they come from have cores."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return SI.driver_sale_headers(spark, sf).repartition(parts)


@register("payments_parse", with_(_HDR) + f"""
SELECT sale_id, CAST(i - 1 AS INTEGER) AS pos, pays[i].channel AS channel, pays[i].amount AS amount
FROM (SELECT sale_id, {payments('payment_type')} AS pays FROM hdr) t,
     range(1, len(pays) + 1) r(i)""")
def q_payments_parse(spark, sf):
    return SA.sale_payments(headers(spark, sf))


@register("change_due", with_(_HDR) + f"""
SELECT sale_id, {change_due(payments('payment_type'))} AS change_due FROM hdr""")
def q_change_due(spark, sf):
    return headers(spark, sf).select("sale_id", S.change_due(S.parse_payments("payment_type"))
                                     .alias("change_due"))


_RISK = """CASE WHEN contains(upper(channel), 'STORE ACCOUNT') THEN 'HIGH'
  WHEN contains(upper(channel), 'ACCESS BANK') THEN 'LOW' WHEN contains(upper(channel), 'MONIEPOINT') THEN 'LOW'
  WHEN contains(upper(channel), 'CASH') THEN 'MEDIUM' ELSE 'UNKNOWN' END"""


@register("payment_mix", with_(_HDR) + f"""
, p AS (SELECT sale_id, x.channel AS channel, {parse_money('x.amount')} AS amount
        FROM (SELECT sale_id, unnest({payments('payment_type')}) AS x FROM hdr) t)
SELECT channel, COUNT(DISTINCT sale_id) AS transactions, {money('amount')} AS revenue,
       {div(money('amount'), f"(SELECT {money('amount')} FROM p WHERE amount > 0)")} AS share,
       {_RISK} AS risk
FROM p WHERE amount > 0 GROUP BY channel""")
def q_payment_mix(spark, sf):
    return R.payment_mix(headers(spark, sf))


# =============================================================== comparisons
from tillpoint.operators import compare as CP  # noqa: E402
from tillpoint.operators import conversion as CV  # noqa: E402

P1, P2 = SI.PERIOD_1, SI.PERIOD_2


def _tag_sql(src: str) -> str:
    return f"""t AS (SELECT *, CASE WHEN invoice_datetime >= TIMESTAMP '{P1[0]}'
      AND invoice_datetime < TIMESTAMP '{P1[1]}' THEN 1 ELSE 2 END AS period FROM {src}
    WHERE (invoice_datetime >= TIMESTAMP '{P1[0]}' AND invoice_datetime < TIMESTAMP '{P1[1]}')
       OR (invoice_datetime >= TIMESTAMP '{P2[0]}' AND invoice_datetime < TIMESTAMP '{P2[1]}'))"""


@register("period_metrics", with_(LINES, CLEAN.replace(
        f"AND invoice_datetime >= TIMESTAMP '{SI.REPORT_START}'", ""), _tag_sql("clean")) + f"""
, g AS (SELECT period, {money('subtotal')} AS rev, COUNT(DISTINCT sale_id) AS txn,
          COUNT(DISTINCT CAST(invoice_datetime AS DATE)) AS days, {qty('quantity')} AS units
        FROM t GROUP BY period)
, s AS (SELECT period, 0 AS metric_ord, 'Revenue' AS metric, rev AS value FROM g
  UNION ALL SELECT period, 1, 'Transactions', CAST(txn AS DOUBLE) FROM g
  UNION ALL SELECT period, 2, 'Days', CAST(days AS DOUBLE) FROM g
  UNION ALL SELECT period, 3, 'AvgDaily', {div('rev', 'days')} FROM g
  UNION ALL SELECT period, 4, 'AvgBasket', {div('rev', 'txn')} FROM g
  UNION ALL SELECT period, 5, 'Units', units FROM g)
SELECT metric_ord, metric, p1, p2, p2 - p1 AS change, {div('p2 - p1', 'p1')} AS pct_change
FROM (SELECT metric_ord, metric, COALESCE(MAX(CASE WHEN period = 1 THEN value END), 0.0) AS p1,
             COALESCE(MAX(CASE WHEN period = 2 THEN value END), 0.0) AS p2
      FROM s GROUP BY 1, 2) x""")
def q_period_metrics(spark, sf):
    lines = L.clean_lines(SI.driver_lines(spark, sf, ("item_name",)), None)
    return CP.period_metrics(lines, P1, P2)


_CLEAN_ALL = CLEAN.replace(f"AND invoice_datetime >= TIMESTAMP '{SI.REPORT_START}'", "")


def clean_all(spark, sf, need=("item_name",)):
    return L.clean_lines(SI.driver_lines(spark, sf, need), None)


@register("period_categories", with_(LINES, _CLEAN_ALL, _tag_sql("clean")) + f"""
, cur AS (SELECT category, {money('subtotal')} AS p2 FROM t WHERE period = 2 AND category IS NOT NULL GROUP BY 1)
, prev AS (SELECT category, {money('subtotal')} AS p1 FROM t WHERE period = 1 AND category IS NOT NULL GROUP BY 1)
SELECT category, COALESCE(prev.p1, 0.0) AS p1, p2, p2 - COALESCE(prev.p1, 0.0) AS change,
       {div('p2 - COALESCE(prev.p1, 0.0)', 'COALESCE(prev.p1, 0.0)')} AS pct_change
FROM cur LEFT JOIN prev USING (category)""")
def q_period_categories(spark, sf):
    return CP.period_categories(clean_all(spark, sf), P1, P2)


@register("new_products", with_(LINES, _CLEAN_ALL, _tag_sql("clean")) + f"""
, prev AS (SELECT item_name, {money('subtotal')} AS revenue FROM t WHERE period = 1 AND item_name IS NOT NULL
           GROUP BY 1 ORDER BY revenue DESC, item_name LIMIT 20)
SELECT item_name, {money('subtotal')} AS revenue FROM t
WHERE period = 2 AND item_name IS NOT NULL AND item_name NOT IN (SELECT item_name FROM prev)
GROUP BY 1 ORDER BY revenue DESC, item_name LIMIT 10""")
def q_new_products(spark, sf):
    return CP.new_products(clean_all(spark, sf), P1, P2)


LISTED_PRODUCTS = ["red plate", "small widget", "hot ring"]


@register("new_products_list", WC + f"""
SELECT item_name, category, revenue, units, transactions, {div('revenue', 'units')} AS avg_price,
       {div('revenue', 'transactions')} AS rev_per_txn
FROM (SELECT item_name, category, {money('subtotal')} AS revenue, {qty('quantity')} AS units,
             COUNT(DISTINCT sale_id) AS transactions FROM clean
      WHERE item_name IS NOT NULL AND category IS NOT NULL GROUP BY 1, 2) g
WHERE item_name IN ({', '.join(f"'{n}'" for n in LISTED_PRODUCTS)})""")
def q_new_products_list(spark, sf):
    return CP.products_in(R.product_rollup(clean(spark, sf, ("category",))), LISTED_PRODUCTS)


# =============================================================== conversion
POST_EPOCH = "1995-01-01"
POST_SPAN = 2600


def posts(spark, sf):
    """Posts: each part is a post of its product name, on a date derived
    from the part key."""
    p = table(spark, sf, "part")
    return p.select(F.col("p_name").alias("product"),
                    F.date_add(F.lit(POST_EPOCH).cast("date"),
                               ((F.col("p_partkey") * 37) % POST_SPAN).cast("int")).alias("posted_date"))


def sale_dates(spark, sf):
    return SI.driver_lines(spark, sf, ("item_name",)).select(
        F.col("item_name").alias("product"), F.to_date("invoice_datetime").alias("sale_date"))


def conv(spark, sf):
    return CV.first_sale_after(posts(spark, sf), sale_dates(spark, sf))


_CONV = f"""posts AS (SELECT p_name AS product,
    CAST(DATE '{POST_EPOCH}' + CAST((p_partkey * 37) % {POST_SPAN} AS INTEGER) AS DATE) AS posted_date FROM part),
sd AS (SELECT DISTINCT p.p_name AS product, CAST(o.o_orderdate AS DATE) AS sale_date
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey),
conv AS (SELECT product, posted_date, first_sale_date,
    CAST(date_diff('day', posted_date, first_sale_date) AS INTEGER) AS days_to_first_sale,
    CASE WHEN first_sale_date IS NOT NULL THEN date_diff('day', posted_date, first_sale_date) <= 3 END
      AS sold_within_3_days
  FROM (SELECT p.*, (SELECT MIN(sd.sale_date) FROM sd WHERE sd.product = p.product
          AND sd.sale_date >= p.posted_date) AS first_sale_date FROM posts p) x)"""


@register("post_to_sale", with_(_CONV) + "SELECT * FROM conv")
def q_post_to_sale(spark, sf):
    return conv(spark, sf)


@register("conversion_tracker", with_(_CONV) + """
SELECT *, CASE WHEN COALESCE(sold_within_3_days, false) THEN 'YES'
  WHEN first_sale_date IS NOT NULL THEN 'Delayed' ELSE 'No Sale' END AS status FROM conv""")
def q_conversion_tracker(spark, sf):
    """S2 + F30: the tracker CSV written, read by its schema, with a status."""
    path = _scratch(spark, "tracker")
    conv(spark, sf).write.option("header", True).csv(path)
    return CV.tracker(SH.read_tracker_csv(spark, path)[0])


_TRACKER_DAY = "day(posted_date)"


@register("tracker_quarantine", with_(_CONV) + f"""
, w AS (SELECT CASE WHEN {_TRACKER_DAY} <> 14 THEN product END AS product, posted_date,
               CASE WHEN {_TRACKER_DAY} = 16 AND first_sale_date IS NOT NULL
                    THEN CAST(posted_date - 1 AS DATE) ELSE first_sale_date END AS first_sale_date,
               CASE WHEN {_TRACKER_DAY} = 15 THEN COALESCE(days_to_first_sale, 0) + 1 ELSE days_to_first_sale END AS days,
               sold_within_3_days AS quick FROM conv)
SELECT product, CASE WHEN {_TRACKER_DAY} <> 13 THEN posted_date END AS posted_date,
       CASE WHEN {_TRACKER_DAY} = 13 THEN 'unreadable' WHEN {_TRACKER_DAY} = 14 THEN 'missing_product'
            WHEN {_TRACKER_DAY} = 16 AND first_sale_date IS NOT NULL THEN 'sold_before_posted'
            WHEN {_TRACKER_DAY} = 15 THEN 'days_mismatch' END AS reason,
       CASE WHEN {_TRACKER_DAY} = 13 THEN COALESCE(product, '') || ',soon,' || COALESCE(CAST(first_sale_date AS VARCHAR), '')
            || ',' || COALESCE(CAST(days AS VARCHAR), '') || ',' || COALESCE(CAST(quick AS VARCHAR), '') END AS raw,
       CASE WHEN {_TRACKER_DAY} NOT IN (13, 14, 15) AND ({_TRACKER_DAY} <> 16 OR first_sale_date IS NULL) THEN
         CASE WHEN COALESCE(quick, false) THEN 'YES' WHEN first_sale_date IS NOT NULL THEN 'Delayed'
              ELSE 'No Sale' END END AS status
FROM w""")
def q_tracker_quarantine(spark, sf):
    """A tracker CSV with faults that follow the posted day of the month:
    unreadable dates on the 13th, no product on the 14th, wrong days on the
    15th, sales before the post on the 16th."""
    day = F.dayofmonth("posted_date")
    sold = F.col("first_sale_date").isNotNull()
    path = _scratch(spark, "tracker")
    conv(spark, sf).select(
        F.when(day != 14, F.col("product")).alias("product"),
        F.when(day == 13, "soon").otherwise(F.col("posted_date").cast("string")).alias("posted_date"),
        F.when((day == 16) & sold, F.date_sub("posted_date", 1)).otherwise(F.col("first_sale_date")).alias("first_sale_date"),
        F.when(day == 15, F.coalesce("days_to_first_sale", F.lit(0)) + 1).otherwise(F.col("days_to_first_sale"))
        .alias("days_to_first_sale"), "sold_within_3_days").write.option("header", True).csv(path)
    good, held = SH.read_tracker_csv(spark, path)
    return CV.tracker(good).select("product", "posted_date", F.lit(None).cast("string").alias("reason"),
                                   F.lit(None).cast("string").alias("raw"), "status").unionByName(
        held.select("product", "posted_date", "reason", "raw", F.lit(None).cast("string").alias("status")))


@register("conversion_hist", with_(_CONV) + """
SELECT days_to_first_sale AS days, COUNT(*) AS count FROM conv
WHERE days_to_first_sale IS NOT NULL GROUP BY 1""")
def q_conversion_hist(spark, sf):
    return CV.conversion_hist(conv(spark, sf))


@register("non_converting", with_(_CONV) + """
SELECT DISTINCT product, posted_date FROM conv WHERE first_sale_date IS NULL""")
def q_non_converting(spark, sf):
    return CV.non_converting(conv(spark, sf))


@register("conversion_kpis", with_(_CONV) + f"""
SELECT posts, converted, {div('converted', 'posts')} AS conversion_rate,
       {div('_days', 'converted')} AS avg_days, {div('within_3', 'converted')} AS share_within_3,
       (SELECT COUNT(*) FROM (SELECT DISTINCT product, posted_date FROM conv
                              WHERE first_sale_date IS NULL) n) AS non_converted
FROM (SELECT COUNT(*) AS posts, COUNT(first_sale_date) AS converted,
             SUM(days_to_first_sale) AS _days,
             COUNT(*) FILTER (WHERE sold_within_3_days) AS within_3 FROM conv) t""")
def q_conversion_kpis(spark, sf):
    return CV.conversion_kpis(conv(spark, sf))


@register("decision_flags", with_(_CONV) + f"""
, pr AS (SELECT p.p_name AS product, {div(money('l.l_extendedprice'), 'COUNT(l.l_extendedprice)')} AS avg_price
         FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
         GROUP BY 1)
, as_of_d AS (SELECT MAX(CAST(o_orderdate AS DATE)) AS d FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
, x AS (SELECT c.product, c.posted_date, c.days_to_first_sale, pr.avg_price,
          COALESCE(c.days_to_first_sale, CAST(date_diff('day', c.posted_date, (SELECT d FROM as_of_d)) AS INTEGER)) AS days_unsold
        FROM (SELECT DISTINCT product, posted_date, days_to_first_sale FROM conv) c LEFT JOIN pr USING (product))
SELECT *, COALESCE(days_unsold >= 8 AND avg_price > 50000, false) AS slow_mover,
       COALESCE(days_unsold >= 5, false) AS repost,
       COALESCE(days_unsold >= 4 AND avg_price > 30000 AND avg_price <= 50000, false) AS discount
FROM x""")
def q_decision_flags(spark, sf):
    """Sale dates, average prices and the last day come from one grouping of
    the lines by product and date, written once."""
    by_day = materialize(SI.driver_lines(spark, sf, ("item_name",)).groupBy(
        F.col("item_name").alias("product"), F.to_date("invoice_datetime").alias("sale_date")).agg(
            S.money_dec("unit_price").alias("_sum"), F.count("unit_price").alias("_n")), "product_days")
    prices = by_day.groupBy("product").agg(S.safe_div(F.sum("_sum").cast("double"), F.sum("_n")).alias("avg_price"))
    as_of = by_day.select(F.max("sale_date")).scalar()
    return CV.decision_flags(CV.first_sale_after(posts(spark, sf), by_day), prices, as_of)


# =============================================================== quality / monitoring
from tillpoint.operators import quality as QY  # noqa: E402


def pages(spark, sf):
    return table(spark, sf, "pages")


@register("page_quality", """
SELECT page_id, CAST(length(html) AS INTEGER) AS n_chars, length(html) < 100 AS is_short,
       NOT regexp_matches(html, '^\\s*<!DOCTYPE') AND NOT contains(lower(html), '<html') AS not_html,
       NOT contains(html, '<tr') OR contains(lower(html), 'no records') AS is_empty,
       md5(html) AS fingerprint FROM pages""")
def q_page_quality(spark, sf):
    return QY.page_quality(pages(spark, sf))


_LI_SQL = r"<li(?:\s[^>]*)?>\s*(?:<a(?:\s[^>]*)?>)?([^<]*)"


@register("schema_drift", f"""
WITH fp AS (SELECT page_id, CASE WHEN len(regexp_extract_all(html, '{_LI_SQL}', 1)) > 0 THEN
    array_to_string(list_transform(regexp_extract_all(html, '{_LI_SQL}', 1), lambda x: trim(lower(x))), '|')
    END AS fingerprint FROM pages),
b AS (SELECT arg_min(fingerprint, page_id) AS baseline FROM fp WHERE fingerprint IS NOT NULL)
SELECT page_id, fingerprint, b.baseline, fingerprint <> b.baseline AS drift
FROM fp, b WHERE fingerprint IS NOT NULL""")
def q_schema_drift(spark, sf):
    return QY.schema_drift(pages(spark, sf))


def component_events(spark, sf):
    """Events as component reports: component = user, failure = error event."""
    return table(spark, sf, "events").select(
        F.col("user_id").alias("component"), "ts",
        (F.col("event_type") == "error").alias("is_error"))


@register("error_rate", f"""
SELECT user_id AS component, COUNT(*) AS processed, COUNT(*) FILTER (WHERE event_type = 'error') AS errors,
       {div("COUNT(*) FILTER (WHERE event_type = 'error')", 'COUNT(*)')} AS error_rate,
       {div("COUNT(*) FILTER (WHERE event_type = 'error')", 'COUNT(*)')} > 0.1 AS alert
FROM events GROUP BY user_id""")
def q_error_rate(spark, sf):
    return QY.error_rate(component_events(spark, sf))


@register("rolling_failure", f"""
WITH w AS (SELECT user_id AS component, ts, event_type = 'error' AS is_error,
    COUNT(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 9999999 PRECEDING AND CURRENT ROW) AS calls,
    COUNT(*) FILTER (WHERE event_type = 'error') OVER (PARTITION BY user_id ORDER BY epoch_us(ts)
      RANGE BETWEEN 9999999 PRECEDING AND CURRENT ROW) AS failures FROM events)
SELECT component, ts, calls, failures, {div('failures', 'calls')} AS failure_rate,
       failures >= 5 OR (calls >= 10 AND {div('failures', 'calls')} >= 0.5) AS trip
FROM w WHERE is_error""")
def q_rolling_failure(spark, sf):
    return QY.rolling_failure(component_events(spark, sf))


@register("stale_nodes", """
SELECT user_id AS node_id, MAX(ts) AS last_seen,
       CAST(epoch_us((SELECT MAX(ts) FROM events)) - epoch_us(MAX(ts)) AS DOUBLE) / 1000000 AS silent_seconds,
       CAST(epoch_us((SELECT MAX(ts) FROM events)) - epoch_us(MAX(ts)) AS DOUBLE) / 1000000 > 60 AS stale
FROM events GROUP BY user_id""")
def q_stale_nodes(spark, sf):
    hb = table(spark, sf, "events").select(F.col("user_id").alias("node_id"), "ts")
    return QY.stale_nodes(hb)


@register("windowed_errors", f"""
SELECT time_bucket(INTERVAL 1 minute, ts) AS window_start, COUNT(*) AS calls,
       COUNT(*) FILTER (WHERE event_type = 'error') AS failures,
       {div("COUNT(*) FILTER (WHERE event_type = 'error')", 'COUNT(*)')} AS failure_rate
FROM events GROUP BY 1""")
def q_windowed_errors(spark, sf):
    return QY.windowed_errors(component_events(spark, sf))


@register("kpi_display", WC + """
SELECT format('{:,}', CAST(TRUNC(revenue) AS BIGINT)) AS revenue_text,
       format('{:,}', transactions) AS transactions_text,
       format('{:,}', CAST(TRUNC(revenue / transactions) AS BIGINT)) AS basket_text
FROM (SELECT CAST(SUM(CAST(subtotal AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
             COUNT(DISTINCT sale_id) AS transactions FROM clean) t""")
def q_kpi_display(spark, sf):
    k = R.kpi_totals(clean(spark, sf, ()))
    return k.select(
        F.format_number(F.col("revenue").cast("bigint"), 0).alias("revenue_text"),
        F.format_number(F.col("transactions"), 0).alias("transactions_text"),
        F.format_number((F.col("revenue") / F.col("transactions")).cast("bigint"), 0)
        .alias("basket_text"))


# =============================================================== sinks
from tillpoint.sinks import dated as DT  # noqa: E402
from tillpoint.sinks import tables as TB  # noqa: E402

UPSERT_TARGET_END = "1997-01-01"
UPSERT_INCOMING_START = "1996-07-01"


def db_rows(spark, sf, v=None):
    return SA.db_row(resolved(spark, sf, v)).withColumn(
        "_ts", F.col("invoice_datetime").cast("timestamp_ntz"))


def upsert_inputs(spark, sf):
    # both sides come from the same sales rows: build them once
    d = settle(db_rows(spark, sf), "db_rows")
    target = d.filter(F.col("_ts") < F.lit(UPSERT_TARGET_END).cast("timestamp_ntz")).drop("_ts")
    incoming = d.filter(F.col("_ts") >= F.lit(UPSERT_INCOMING_START).cast("timestamp_ntz")) \
        .drop("_ts").withColumn("comment", F.concat(F.coalesce("comment", F.lit("")), F.lit(" (edited)")))
    return target, incoming


_DB = with_(SHEET, PLINES, SALE_AGG, _VALIDATED, _REF, _RESOLVED) + """
, db AS (SELECT sale_id AS pos_sale_id, invoice_total, pos_customer_id_r AS pos_customer_id, customer_name,
  salesperson, strftime(invoice_datetime, '%Y-%m-%dT%H:%M:%S') AS invoice_datetime,
  comment, is_anonymous_customer, items_net, items_sold, items_returned, invoice_datetime AS _ts
  FROM resolved WHERE accepted)
, target AS (SELECT * EXCLUDE (_ts) FROM db WHERE _ts < TIMESTAMP '1997-01-01')
, incoming AS (SELECT * EXCLUDE (_ts) REPLACE (COALESCE(comment, '') || ' (edited)' AS comment)
  FROM db WHERE _ts >= TIMESTAMP '1996-07-01')
"""


@register("upsert_sales", _DB + """
SELECT * FROM target WHERE pos_sale_id NOT IN (SELECT pos_sale_id FROM incoming)
UNION ALL SELECT * FROM incoming""")
def q_upsert_sales(spark, sf):
    target, incoming = upsert_inputs(spark, sf)
    return TB.upsert(target, incoming, incoming_unique=True)   # one row per sale by construction


def items_of(spark, sf):
    return SA.typed_items(sheet_lines(spark, sf)).select(
        F.col("sale_id").alias("pos_sale_id"), "pos_item_id", "name", "quantity",
        F.col("unit_price").cast("double").alias("unit_price"),
        F.col("total").cast("double").alias("total"))


@register("replace_children", _DB + f"""
, items AS (SELECT sale_id AS pos_sale_id, {parse_int('pos_item_id')} AS pos_item_id,
    {clean_text('item_name')} AS name, {parse_int('quantity')} AS quantity,
    CAST({parse_money('unit_price')} AS DOUBLE) AS unit_price,
    CAST({parse_money('line_total')} AS DOUBLE) AS total FROM plines)
SELECT * FROM items WHERE pos_sale_id IN (SELECT pos_sale_id FROM target)
  AND pos_sale_id NOT IN (SELECT pos_sale_id FROM incoming)
UNION ALL
SELECT * FROM items WHERE pos_sale_id IN (SELECT pos_sale_id FROM incoming) AND quantity > 0""")
def q_replace_children(spark, sf):
    target, incoming = upsert_inputs(spark, sf)
    items = settle(items_of(spark, sf), "items")   # used by both sides
    t_items = items.join(by_shuffle(target.select("pos_sale_id")), "pos_sale_id", "left_semi")
    in_items = items.join(by_shuffle(incoming.select("pos_sale_id")), "pos_sale_id", "left_semi") \
        .filter(F.col("quantity") > 0)
    return TB.replace_children(t_items, incoming, in_items)


ENVELOPE_FIELDS = ["pos_sale_id", "customer_name", "salesperson", "invoice_datetime",
                   "invoice_total"]


def envelopes(spark, sf, keep=(), v=None):
    d = db_rows(spark, sf, v)
    node = F.concat(F.lit("node-"), S.stable_shard("pos_sale_id", SHARDS).cast("string"))
    e = d.select(F.col("pos_sale_id").cast("string").alias("pos_sale_id"), "customer_name",
                 "salesperson", "invoice_datetime",
                 F.col("invoice_total").cast("decimal(18,2)").cast("string").alias("invoice_total"),
                 "items_net", node.alias("_node"))
    return TB.envelope(e, F.col("_node"), ENVELOPE_FIELDS, keep)


_ENV_SQL = _DB + f"""
, env AS (SELECT pos_sale_id, items_net, 'node-' || CAST({stable_shard('pos_sale_id', SHARDS)} AS VARCHAR) AS node_id,
  to_json(struct_pack(pos_sale_id := CAST(pos_sale_id AS VARCHAR), customer_name := customer_name,
    salesperson := salesperson, invoice_datetime := invoice_datetime,
    invoice_total := CAST(CAST(invoice_total AS DECIMAL(18,2)) AS VARCHAR),
    _meta := struct_pack(node_id := 'node-' || CAST({stable_shard('pos_sale_id', SHARDS)} AS VARCHAR),
      routing_key := 'sales.node-' || CAST({stable_shard('pos_sale_id', SHARDS)} AS VARCHAR)))) AS payload
  FROM db)
"""


@register("publish_envelope", _ENV_SQL + """
SELECT CAST(pos_sale_id AS VARCHAR) AS pos_sale_id, node_id, CAST(payload AS VARCHAR) AS payload FROM env""")
def q_publish_envelope(spark, sf):
    return envelopes(spark, sf)


MESSAGE_SCHEMA = ("pos_sale_id string, customer_name string, salesperson string, "
                  "invoice_datetime string, invoice_total string, "
                  "_meta struct<node_id:string, routing_key:string>")


def messages(spark, sf, v=None):
    """Envelopes as they arrive from the queue: a sale whose returns
    exceed its sales arrives cut short (undecodable), one with a multiple of
    seven items has a broken object between sound braces (undecodable), and
    one that leaves a remainder of one has line breaks (decodable)."""
    out = envelopes(spark, sf, keep=("items_net",), v=v)
    return out.select(F.col("pos_sale_id").alias("source_id"),
                    F.when(F.col("items_net") < 0, F.substring("payload", 1, 20))
                    .when(F.col("items_net") % 7 == 0,
                          F.concat(F.lit('{"pos_sale_id": "'), "pos_sale_id", F.lit('", oops}')))
                    .when(F.col("items_net") % 7 == 1, F.concat(F.lit("{\n"), F.substr("payload", F.lit(2)), F.lit("\n")))
                    .otherwise(F.col("payload")).alias("payload"))


_MSG_SQL = _ENV_SQL + """
, msg AS (SELECT CAST(pos_sale_id AS VARCHAR) AS source_id,
   CASE WHEN items_net < 0 THEN substr(CAST(payload AS VARCHAR), 1, 20)
        WHEN items_net % 7 = 0 THEN '{"pos_sale_id": "' || CAST(pos_sale_id AS VARCHAR) || '", oops}'
        WHEN items_net % 7 = 1 THEN '{' || chr(10) || substr(CAST(payload AS VARCHAR), 2) || chr(10)
        ELSE CAST(payload AS VARCHAR) END AS payload FROM env)
"""


@register("message_decode", _MSG_SQL + """
SELECT source_id, json_valid(payload) AS ok,
  CASE WHEN json_valid(payload) THEN TRY_CAST(json_extract_string(payload, '$.pos_sale_id') AS BIGINT) END AS pos_sale_id,
  CASE WHEN json_valid(payload) THEN json_extract_string(payload, '$._meta.node_id') END AS node_id
FROM msg""")
def q_message_decode(spark, sf):
    d = TB.decode(messages(spark, sf), MESSAGE_SCHEMA)
    return d.select("source_id", F.col("_ok").alias("ok"),
                    F.when(F.col("_ok"), F.col("_msg.pos_sale_id").try_cast("bigint")).alias("pos_sale_id"),
                    F.when(F.col("_ok"), F.col("_msg._meta.node_id")).alias("node_id"))


_LETTER_SQL = ", ".join(f"{c} := CAST({c} AS VARCHAR)" for c in TB.RAW_FIELDS)


@register("dead_letter", _MSG_SQL + f"""
SELECT 'validation' AS source, CAST(to_json(struct_pack(chunk := chunk, lines := list(struct_pack({_LETTER_SQL})
         ORDER BY _line))) AS VARCHAR) AS payload, sale_id AS pos_sale_id,
       'node-' || CAST({stable_shard('sale_id', SHARDS)} AS VARCHAR) AS node_id
FROM (SELECT *, _line // 200 AS chunk FROM (SELECT *, row_number() OVER (PARTITION BY sale_id
        ORDER BY l_linenumber, l_partkey, l_suppkey, subtotal) - 1 AS _line FROM plines
      WHERE sale_id IN (SELECT sale_id FROM validated WHERE NOT accepted)) n) c GROUP BY sale_id, chunk
UNION ALL
SELECT 'decode', payload, CAST(source_id AS BIGINT), NULL FROM msg WHERE NOT json_valid(payload)""")
def q_dead_letter(spark, sf):
    """The raw lines of rejected sales and the texts of undecodable
    messages.  Both start from the same validation: it is built once."""
    lines = written_lines(spark, sf, ["sale_id_raw"])
    v_all = settle(validated(spark, sf, lines), "validated")
    raw = TB.raw_letters(lines, v_all.filter(~F.col("accepted")), F.col("_row_no.l_linenumber"))
    a = TB.dead_letters(raw, F.col("payload"), "pos_sale_id",
                        F.concat(F.lit("node-"), S.stable_shard("pos_sale_id", SHARDS).cast("string")))
    d = TB.decode(messages(spark, sf, v_all), MESSAGE_SCHEMA).filter(~F.col("_ok"))
    b = TB.dead_letters(d, F.col("payload"), "source_id")
    return a.withColumn("source", F.lit("validation")).unionByName(
        b.withColumn("source", F.lit("decode")))


# =============================================================== fuzzy resolution (rows-only)
from tillpoint import constants as KC  # noqa: E402
from tillpoint.operators import fuzzy_match as FZ  # noqa: E402


@register("customer_resolve_fuzzy", with_(SHEET, PLINES, SALE_AGG, _VALIDATED, _REF, _RESOLVED) + """
SELECT DISTINCT _name AS key, t._key AS match,
  CASE WHEN t._key IS NOT NULL THEN 200.0::DOUBLE * length(_name) / (2 * length(_name) + 1) END AS score,
  COALESCE(t._ref_id, 23) AS pos_customer_id
FROM resolved LEFT JOIN typo t ON _name = _typo
WHERE _name IS NOT NULL AND _name NOT IN (SELECT _key FROM ref)""")
def q_customer_resolve_fuzzy(spark, sf):
    """Sale customers with no exact key -> best customer name >= 90 ->
    id; still unmatched -> default id."""
    cust = table(spark, sf, "customer")
    keys = by_shuffle(RV.reference_keys(cust, "c_name", "c_custkey"))
    names = validated(spark, sf).select(S.name_key("customer_name").alias("key")).distinct()
    unmatched = names.join(keys.select(F.col("_key").alias("key")), "key", "left_anti")
    ref = cust.select(S.name_key("c_name").alias("key"), "c_custkey")
    best = FZ.fuzzy_best(unmatched, "key", ref, "key", "c_custkey")
    return best.join(keys.withColumnRenamed("_key", "match"), "match", "left").select(
        "key", "match", "score",
        F.coalesce("_ref_id", F.lit(KC.DEFAULT_CUSTOMER_ID)).alias("pos_customer_id"))


_PAID = f""", p AS (SELECT sale_id, CAST(i - 1 AS INTEGER) AS pos, pays[i].channel AS channel, pays[i].amount AS amount
  FROM (SELECT sale_id, {payments('payment_type')} AS pays FROM hdr) t, range(1, len(pays) + 1) r(i)),
a AS (SELECT *, CASE WHEN contains(channel, 'STORE ACCOUNT') THEN 'STANBIC IBTC BANK'
    WHEN channel = 'ACCESS BANK' THEN 'ACCESS BANK' WHEN channel = 'MONIEPOINT' THEN 'MONIEPOINT MFB'
    WHEN channel = 'STANBIC IBTC' THEN 'STANBIC IBTC BANK' WHEN channel = 'CASH' THEN 'CASH PAYMENT' END AS account
  FROM p),
h AS (SELECT *, md5(account) AS x FROM a WHERE account IS NOT NULL),
paid AS (SELECT sale_id, pos, channel, account, substr(x, 1, 8) || '-' || substr(x, 9, 4) || '-' || substr(x, 13, 4)
  || '-' || substr(x, 17, 4) || '-' || substr(x, 21, 12) AS account_id,
  CAST({parse_money('amount')} AS DOUBLE) AS amount FROM h)
"""


@register("payment_account", with_(_HDR) + _PAID + "SELECT * FROM paid")
def q_payment_account(spark, sf):
    """J2 + J5 + F16: payment channel -> best settlement account (fixed list
    of four, >= 90) -> store-account reroute -> account id; payments with
    no account are dropped."""
    pays = SA.sale_payments(headers(spark, sf))
    accounts = RV.account_table(spark)
    chans = pays.select("channel").distinct()
    best = FZ.fuzzy_best(chans, "channel", accounts, "bank_name", "_ord") \
        .select("channel", F.col("match").alias("matched"))
    res = RV.resolve_payment_accounts(pays.join(best, "channel", "left"), accounts)
    ok, _dropped = RV.split_unresolved(res)
    return ok.select("sale_id", "pos", "channel", "account", "account_id",
                     S.parse_money("amount").cast("double").alias("amount"))


@register("replace_payments", _DB + f", {_HDR}" + _PAID + """
, pay AS (SELECT sale_id AS pos_sale_id, account, account_id, amount FROM paid)
SELECT * FROM pay WHERE pos_sale_id IN (SELECT pos_sale_id FROM target)
  AND pos_sale_id NOT IN (SELECT pos_sale_id FROM incoming)
UNION ALL
SELECT * FROM pay WHERE pos_sale_id IN (SELECT pos_sale_id FROM incoming) AND amount > 0""")
def q_replace_payments(spark, sf):
    """S7/N-3: the payments of the incoming sales replace those in the table."""
    target, incoming = upsert_inputs(spark, sf)
    sales = headers(spark, sf).select("sale_id", S.parse_payments("payment_type").alias("payments"))
    paid = RV.payment_table_rows(RV.payment_rows(sales, RV.account_table(spark))[0])
    return TB.replace_children(
        paid.join(by_shuffle(target.select("pos_sale_id")), "pos_sale_id", "left_semi"), incoming,
        paid.join(by_shuffle(incoming.select("pos_sale_id")), "pos_sale_id", "left_semi").filter("amount > 0"))


# =============================================================== sources and streams (rows-only)
import uuid  # noqa: E402

from tillpoint.session import checkpoint_dir  # noqa: E402
from tillpoint.sources import receipts as RC  # noqa: E402
from tillpoint.sources import sheets as SH  # noqa: E402
from tillpoint.streaming import ingest as IG  # noqa: E402

# Header row of the sheet export, in the order the export writes it.
SHEET_HEADERS = ["Sale Id", "Date", "Sold By", "Sold To", "Payment Type", "Comments", "Person Id",
                 "Item Id", "Name", "Category", "Quantity Sold", "Selling Price", "Subtotal",
                 "Total", "Total"]
_SHEET_ORDER = ["sale_id", "invoice_datetime", "salesperson", "customer_name", "payment_type",
                "comment", "pos_customer_id", "pos_item_id", "item_name", "category", "quantity",
                "unit_price", "subtotal", "line_total", "invoice_total"]


def _scratch(spark, what: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


@register("workbook_scan", with_(SHEET, PLINES) + """
SELECT sale_id, sale_id_raw, invoice_datetime, salesperson, item_name, quantity, line_total,
       invoice_total FROM plines""")
def q_workbook_scan(spark, sf):
    """Sheet exports read back through the header-mapping reader
    (duplicate "Total" resolved by position), lines parsed."""
    path = _scratch(spark, "sheet-export")
    sh = SI.driver_sheet(spark, sf).select(
        *[F.col(c).cast("string").alias(h) for c, h in zip(_SHEET_ORDER, SHEET_HEADERS)])
    # exports are text of many equal parts; each task writes and reads its own file
    sh.write.option("header", True).option("ignoreLeadingWhiteSpace", False) \
        .option("ignoreTrailingWhiteSpace", False).option("compression", "snappy").csv(path)
    return SA.parsed_lines(SH.read_sheet_csv(spark, path)).select(
        "sale_id", "sale_id_raw", "invoice_datetime", "salesperson", "item_name", "quantity",
        "line_total", "invoice_total")


@register("receipt_extract")
def q_receipt_extract(spark, sf):
    return RC.extract_receipts(table(spark, sf, "pages"))


def receipt_pages(spark, sf):
    """Receipts of the orders as the shop prints them: items as attributes of
    ``tbody`` tags (a third of the pages with a note between them), payments as
    footer values."""
    li = table(spark, sf, "lineitem").withColumn("l_quantity", F.col("l_quantity").cast("bigint"))
    two = lambda c: F.col(c).cast("decimal(18,2)").cast("string")

    def tag(x):
        return F.concat(F.lit('<tbody data-item-class="item" data-sale-id="'), "l_orderkey", F.lit('" data-item-id="'),
                        x["l_partkey"], F.lit('" data-item-qty="'), x["l_quantity"], F.lit('" data-item-price="'),
                        x["l_extendedprice"].cast("decimal(18,2)").cast("string"), F.lit('"><tr><td>&nbsp;</td></tr></tbody>'))

    # the lines move without their text; pages are printed and read in the same tasks,
    # which cost far more than the bytes that came in, so these are not merged by size
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = li.repartition(parts, "l_orderkey").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"))).alias("t"),
        F.sum("l_quantity").alias("q"))
    o = table(spark, sf, "orders").join(rows, F.col("o_orderkey") == F.col("l_orderkey"))
    channel = F.when(F.col("o_custkey") % 2 == 0, "Cash").otherwise("Access Bank")
    note = F.when(F.col("o_orderkey") % 3 == 0, '<tbody data-item-class="note" data-item-id="0"></tbody>').otherwise("")
    html = F.concat(
        F.lit('<html><ul class="invoice-address invoiceto"><li>Bill to</li><li>Customer: '),
        F.when(F.col("o_custkey") % 5 == 0, "INDOOR").otherwise(F.concat(F.lit("C &amp; "), "o_custkey")),
        F.lit('</li></ul>\n<ul class="invoice-detail"><li>1</li><li>2</li><li><strong>'),
        F.date_format("o_orderdate", "MM/dd/yyyy"), F.lit('</strong></li><li><span>Sold by: </span> '), "o_orderstatus",
        F.lit('</li></ul><table id="receipt-draggable">'), note, F.array_join(F.transform("t", tag), "\n"),
        F.lit('</table><div class="invoice-footer"><div class="invoice-footer-heading">Total</div>'
              '<div class="invoice-footer-value invoice-total">N'), two("o_totalprice"),
        F.lit('</div><div class="invoice-footer-value">'), channel,
        F.lit('</div><div class="invoice-footer-value invoice-payment">'), two("o_totalprice"),
        F.lit('</div><div class="invoice-footer-value">Moniepoint</div>'
              '<div class="invoice-footer-heading">Number of items sold</div><div class="invoice-footer-value">'),
        F.col("q").cast("string"), F.lit("</div></div></html>"))
    return o.select(F.col("o_orderkey").alias("page_id"), F.lit("u").alias("url"), html.alias("html"))


@register("receipt_sales", """
WITH t AS (SELECT l_orderkey, list(struct_pack(pos_sale_id := CAST(l_orderkey AS VARCHAR),
    pos_item_id := CAST(l_partkey AS VARCHAR), quantity := CAST(CAST(l_quantity AS BIGINT) AS VARCHAR),
    unit_price := CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR))
    ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS items, sum(CAST(l_quantity AS BIGINT)) AS q
  FROM lineitem GROUP BY 1)
SELECT o_orderkey AS page_id, CAST(o_orderkey AS VARCHAR) AS pos_sale_id,
  CASE WHEN o_custkey % 5 = 0 THEN 'INDOOR' ELSE 'C & ' || CAST(o_custkey AS VARCHAR) END AS customer_name,
  o_custkey % 5 = 0 AS is_anonymous_customer, strftime(o_orderdate, '%m/%d/%Y') AS invoice_datetime,
  o_orderstatus AS salesperson, 'N' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS invoice_total,
  CAST(CAST(q AS BIGINT) AS VARCHAR) AS items_sold, '0' AS items_returned, CAST(to_json(items) AS VARCHAR) AS items_json,
  CAST(to_json([struct_pack(channel := CASE WHEN o_custkey % 2 = 0 THEN 'CASH' ELSE 'ACCESS BANK' END,
      amount := CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)),
    struct_pack(channel := 'MONIEPOINT', amount := '0.0')]) AS VARCHAR) AS payments_json
FROM orders JOIN t ON o_orderkey = l_orderkey""")
def q_receipt_sales(spark, sf):
    """Receipts printed from the tables and read back."""
    r = RC.extract_receipts(receipt_pages(spark, sf))
    return r.select("page_id", "pos_sale_id", "customer_name", "is_anonymous_customer", "invoice_datetime", "salesperson",
                    "invoice_total", "items_sold", "items_returned", F.to_json(F.transform("items", lambda i: F.struct(
                        *[i[c].alias(c) for c in ("pos_sale_id", "pos_item_id", "quantity", "unit_price")])))
                    .alias("items_json"), F.to_json("payments").alias("payments_json"))


@register("stream_dedup", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def q_stream_dedup(spark, sf):
    """Events replayed by a stream (the events file read twice) keep
    one row per event id within the 24 h life."""
    schema = table(spark, sf, "events").schema
    rd = lambda: spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet") \
        .parquet(sf)
    s = rd().unionByName(rd())
    out, ck = _scratch(spark, "dedup-out"), _scratch(spark, "dedup-ck")
    q = IG.dedup_stream(s, "event_id", "ts").writeStream.format("parquet") \
        .option("checkpointLocation", ck).trigger(availableNow=True).start(out)
    q.awaitTermination()
    r = spark.read.parquet(out)
    return r.withColumn("ts", F.col("ts").cast("timestamp_ntz")).select(*schema.names)


@register("stream_ingest", ORACLE["db_row"])
def q_stream_ingest(spark, sf):
    """Four sheet exports landing as compressed files, ingested by an
    availableNow stream in micro-batches of two exports with idempotent
    upserts by date.  An export comes in several files, each of which holds
    whole invoices with their lines in line order (as a point-of-sale export
    does), so the ingested tables equal the batch ``db_row``."""
    landing, out, ck = _scratch(spark, "landing"), _scratch(spark, "tables"), _scratch(spark, "ck")
    sid = S.parse_sale_id("sale_id")   # whole invoices per file ("S1 Edit" and "S1" together)
    files = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)   # of an export
    with scratch():
        sheet = SI.driver_sheet(spark, sf)
        sheet = settle(sheet.select("_row_no", *[F.col(c) if c in sheet.columns else F.lit(None).cast("string").alias(c)
                                                 for c in SH.SHEET_FIELDS]), "sheet")
        sheet.repartition(4 * files, sid).sortWithinPartitions(sid, "_row_no").drop("_row_no") \
            .write.option("header", True).option("ignoreLeadingWhiteSpace", False) \
            .option("ignoreTrailingWhiteSpace", False).option("compression", "gzip").csv(landing)
    release_shuffles(spark)
    q = IG.start_ingest(spark, landing, table(spark, sf, "customer"), out, ck, max_files=2 * files)
    q.awaitTermination()
    return DT.read_dated(spark, f"{out}/sales")


# =============================================================== more lookups, rounding, stream twins
SALE_LOOKUP_ID = 1000


@register("sale_lookup", WS + f"""
SELECT sale_id, {clean_text('invoice_datetime')} AS invoice_datetime_raw,
       {clean_text('salesperson')} AS salesperson, {clean_text('customer_name')} AS customer_name,
       {is_anon(clean_text('customer_name'))} AS is_anonymous_customer,
       NULLIF(trim(invoice_total), '') AS invoice_total_raw, {clean_text('comment')} AS comment, n_lines,
       items_sold, items_returned, CAST(len({payments('payment_type')}) AS INTEGER) AS n_payments,
       {change_due(payments('payment_type'))} AS change_due
FROM sagg WHERE sale_id = {SALE_LOOKUP_ID}""")
def q_sale_lookup(spark, sf):
    """One sale by id from the built sales (the filter on the grouping
    key is pushed below the aggregation by Catalyst)."""
    return SA.sale_lookup(SA.build_sales(sheet_lines(spark, sf)), SALE_LOOKUP_ID)


@register("product_display", with_(LINES) + f"""
SELECT item_name, category, revenue, qty, transactions,
       round_even({div('_ps', '_pn')}, 0) AS avg_price_r,
       round_even({div('revenue', 'transactions')}, 0) AS rev_per_txn_r,
       CAST(TRUNC(qty) AS BIGINT) AS qty_int
FROM (SELECT item_name, category, {money('line_total')} AS revenue, {qty('quantity')} AS qty,
             COUNT(DISTINCT sale_id) AS transactions, {money('unit_price')} AS _ps,
             COUNT(unit_price) AS _pn
      FROM lines WHERE category IS DISTINCT FROM 'Discount'
        AND item_name IS NOT NULL AND category IS NOT NULL GROUP BY 1, 2) g
ORDER BY revenue DESC, item_name, category LIMIT 20""")
def q_product_display(spark, sf):
    """report rounding — half-to-even ``round(x, 0)`` of prices and
    ``int()`` truncation of counts, over the top-20 product table."""
    t = R.top_products_mean(L.clean_lines_cat(SI.driver_lines(spark, sf, ("category",))))
    return t.select("item_name", "category", "revenue", "qty", "transactions",
                    F.bround("avg_price", 0).alias("avg_price_r"),
                    F.bround("rev_per_txn", 0).alias("rev_per_txn_r"),
                    F.col("qty").cast("bigint").alias("qty_int"))


def _events_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


def _drain(spark, df, mode="append"):
    out, ck = _scratch(spark, "stream-out"), _scratch(spark, "stream-ck")
    df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", ck) \
        .trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.parquet(out)


@register("stale_sessions", """
WITH e AS (SELECT user_id AS node_id, ts,
    CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
           OR ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 60 SECOND
         THEN 1 ELSE 0 END AS new_session FROM events),
s AS (SELECT node_id, ts, SUM(new_session) OVER (PARTITION BY node_id ORDER BY ts
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM e),
g AS (SELECT node_id, MIN(ts) AS first_beat, MAX(ts) + INTERVAL 60 SECOND AS silent_from,
        COUNT(*) AS beats FROM s GROUP BY node_id, sid)
SELECT * FROM g WHERE silent_from <= (SELECT MAX(ts) FROM events) - INTERVAL 60 SECOND""")
def q_stale_sessions(spark, sf):
    """X4 (stream): heartbeat sessions per node with a 60 s gap; each
    closed session is a silence longer than the heartbeat life."""
    hb = _events_stream(spark, sf).select(F.col("user_id").alias("node_id"), "ts")
    r = _drain(spark, IG.silent_sessions(hb))
    return r.select("node_id", F.col("first_beat").cast("timestamp_ntz").alias("first_beat"),
                    F.col("silent_from").cast("timestamp_ntz").alias("silent_from"), "beats")


@register("windowed_errors_stream", """
SELECT time_bucket(INTERVAL 1 minute, ts) AS window_start, COUNT(*) AS calls,
       COUNT(*) FILTER (WHERE event_type = 'error') AS failures FROM events
GROUP BY 1 HAVING time_bucket(INTERVAL 1 minute, ts) + INTERVAL 1 minute
                  <= (SELECT MAX(ts) FROM events) - INTERVAL 10 second""")
def q_windowed_errors_stream(spark, sf):
    """X5 (stream): one-minute tumbling failure counts with a watermark."""
    ev = _events_stream(spark, sf).select(
        F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") == "error").alias("is_error"))
    r = _drain(spark, IG.windowed_failures(ev))
    return r.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


CHUNK = 3                    # lines of a chunk in the stand-in, whose sales are short


@register("nest_items", with_(SHEET, PLINES) + f"""
SELECT sale_id, chunk, CAST(count(*) AS INTEGER) AS n_items,
  CAST(to_json(list(struct_pack(pos_item_id := pos_item_id, item_name := item_name,
    quantity := quantity, unit_price := unit_price, line_total := line_total) ORDER BY _line)) AS VARCHAR) AS items_json
FROM (SELECT *, _line // {CHUNK} AS chunk FROM (SELECT *, row_number() OVER (PARTITION BY sale_id
        ORDER BY l_linenumber, l_partkey, l_suppkey, subtotal) - 1 AS _line FROM plines) n) c GROUP BY 1, 2""")
def q_nest_items(spark, sf):
    """N-1: items in numbered chunks; the span is the printed line number."""
    n = SA.nest_items(sheet_lines(spark, sf), F.col("_row_no.l_linenumber"), CHUNK)
    return n.select("sale_id", "chunk", F.size("items").alias("n_items"),
                    F.to_json("items").alias("items_json"))


def _two(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,2)) AS VARCHAR)"


@register("sale_message", _DB + f", {_HDR}" + _PAID + f"""
, numbered AS (SELECT *, row_number() OVER (PARTITION BY sale_id ORDER BY l_linenumber, l_partkey, l_suppkey, subtotal) - 1 AS _line
  FROM plines)
, chunked AS (SELECT sale_id, _line // {CHUNK} AS chunk, list(struct_pack(
    pos_item_id := {parse_int('pos_item_id')}, name := {clean_text('item_name')}, quantity := {parse_int('quantity')},
    unit_price := {_two(parse_money('unit_price'))}, total := {_two(parse_money('line_total'))}) ORDER BY _line) AS items
  FROM numbered GROUP BY 1, 2)
, last AS (SELECT sale_id, max(chunk) + 1 AS chunks FROM chunked GROUP BY 1)
, pays AS (SELECT sale_id, list(struct_pack(account_id := account_id, account := account,
    amount := {_two('amount')}) ORDER BY pos) AS payments FROM paid GROUP BY 1)
SELECT pos_sale_id, chunk, node_id, CAST(to_json(struct_pack(pos_sale_id := pos_sale_id,
  pos_customer_id := pos_customer_id, customer_name := customer_name, salesperson := salesperson,
  invoice_datetime := invoice_datetime, comment := comment, is_anonymous_customer := is_anonymous_customer,
  items_net := items_net, items_sold := items_sold, items_returned := items_returned,
  invoice_total := {_two('invoice_total')}, items := items,
  payments := CASE WHEN chunk = 0 THEN coalesce(payments, []) ELSE [] END,
  _meta := struct_pack(node_id := node_id, routing_key := 'sales.' || node_id, chunk := chunk, chunks := chunks)))
  AS VARCHAR) AS payload
FROM (SELECT *, 'node-' || CAST({stable_shard('pos_sale_id', SHARDS)} AS VARCHAR) AS node_id FROM db) d
JOIN chunked c ON d.pos_sale_id = c.sale_id JOIN last ON last.sale_id = c.sale_id
LEFT JOIN pays ON pays.sale_id = c.sale_id""")
def q_sale_message(spark, sf):
    """S5/N-1: whole sales as messages: resolved ids, items in chunks, payments."""
    lines = written_lines(spark, sf)
    res = settle(resolved(spark, sf, validated(spark, sf, lines)).filter("accepted"), "accepted")
    paid, _ = RV.payment_rows(res, RV.account_table(spark))
    paid = paid.withColumn("amount", S.parse_money("amount"))
    items = SA.typed_items(lines).join(by_shuffle(res.select("sale_id")), "sale_id", "left_semi")
    node = F.concat(F.lit("node-"), S.stable_shard("pos_sale_id", SHARDS).cast("string"))
    return TB.sale_messages(SA.db_row(res), items, paid, node, F.col("_row_no.l_linenumber"), CHUNK)


@register("message_stream", _MSG_SQL + """
SELECT json_valid(payload) AS ok,
  CASE WHEN json_valid(payload) THEN TRY_CAST(json_extract_string(payload, '$.pos_sale_id') AS BIGINT) END AS pos_sale_id,
  CASE WHEN json_valid(payload) THEN json_extract_string(payload, '$.invoice_total') END AS invoice_total,
  CASE WHEN json_valid(payload) THEN NULL ELSE payload END AS payload FROM msg""")
def q_message_stream(spark, sf):
    """The messages as a stream, split in each micro-batch."""
    landing, out, ck = _scratch(spark, "messages"), _scratch(spark, "decoded"), _scratch(spark, "ck")
    messages(spark, sf).select("payload").repartition(4).write.parquet(landing)
    IG.start_messages(spark, landing, MESSAGE_SCHEMA, out, ck, max_files=2).awaitTermination()
    good, bad = spark.read.parquet(f"{out}/good"), spark.read.parquet(f"{out}/bad")
    return good.select(F.lit(True).alias("ok"), F.col("pos_sale_id").try_cast("bigint").alias("pos_sale_id"),
                       "invoice_total", F.lit(None).cast("string").alias("payload")).unionByName(
        bad.select(F.lit(False).alias("ok"), F.lit(None).cast("bigint").alias("pos_sale_id"),
                   F.lit(None).cast("string").alias("invoice_total"), "payload"))


@register("dead_letter_replay", with_(SHEET, PLINES, SALE_AGG, _VALIDATED)
          + f"SELECT {', '.join(VALID_COLS)} FROM validated WHERE NOT accepted")
def q_dead_letter_replay(spark, sf):
    """The dead letters of the rejected sales, written, decoded and
    validated again, give the same sales."""
    lines = written_lines(spark, sf, ["sale_id_raw"])
    bad = settle(SA.validate_sales(lines).filter("NOT accepted").select("sale_id"), "rejected")
    letters = settle(TB.raw_letters(lines, bad, F.col("_row_no.l_linenumber"), CHUNK), "letters")
    again = SA.validate_sales(SA.parsed_lines(TB.replay(letters, chunk_size=CHUNK)))
    return again.withColumn("invoice_total", F.col("invoice_total").cast("double")) \
        .withColumn("change_due", F.col("change_due").cast("double")).select(*VALID_COLS)


# =============================================================== report sink
from functools import reduce  # noqa: E402

from tillpoint.plans import report as RP  # noqa: E402
from tillpoint.sinks import ordered as OD  # noqa: E402

# sheet -> the query whose SQL states the same result
_REPORT_SQL = {"executive_kpis": "kpi_totals", "categories": "category_rollup",
               "weekdays": "weekday_rollup", "daily": "daily_vs_avg",
               "price_bands": "price_bands", "top_products": "top_products",
               "best_day": "best_day", "top_customers": "top_customers", "staff": "staff_rollup"}
_REPORT_NEED = {"top_customers": ("category", "customer"), "staff": ("category", "salesperson")}


def _report_query(sheet: str):
    def q(spark, sf):
        lines = clean(spark, sf, _REPORT_NEED.get(sheet, ("category",)))
        out = _scratch(spark, "report")
        paths = RP.write_report(RP.report(lines, [sheet]), out)
        return spark.read.parquet(paths[sheet])
    q.__name__ = f"q_report_{sheet}"
    q.__doc__ = f"S9: report sheet '{sheet}' written to its folder and read back."
    return q


for _sheet, _key in _REPORT_SQL.items():
    register(f"report_{_sheet}", ORACLE[_key])(_report_query(_sheet))


# all sheets from one scan, in long form: value and other (units, or the prior
# period's value), n (transactions) and ratio (a share, an average or a change)
_CONV_CLEAN = _CONV.replace("ON l.l_partkey = p.p_partkey),", f"""ON l.l_partkey = p.p_partkey
    WHERE l.l_quantity > 0 AND p.p_name IS DISTINCT FROM 'Discount' AND o.o_orderdate >= TIMESTAMP '{SI.REPORT_START}'),""")
_SHEET_ROWS = {
    # sheet: SQL of the sheet, order, label, value, other, n, ratio
    "executive_kpis": (ORACLE["kpi_totals"], "revenue", "CAST(days AS {text})", "revenue", "units", "transactions", "avg_basket"),
    "categories": (ORACLE["category_rollup"], "revenue DESC, category", "category", "revenue", "units", "transactions", "share"),
    "weekdays": (ORACLE["weekday_rollup"], "day_ord", "day_of_week", "revenue", "units", "transactions", "share"),
    "daily": (ORACLE["daily_vs_avg"], "sale_date", "CAST(sale_date AS {text})", "revenue", "period_avg", "transactions",
              "vs_avg"),
    "price_bands": (ORACLE["price_bands"], "band_ord", "price_bucket", "revenue", "units", "line_items", "pct_revenue"),
    "top_products": (ORACLE["top_products"], "rank", "concat(item_name, '|', category)", "revenue", "units", "transactions",
                     "avg_price"),
    "best_day": (ORACLE["best_day"], "revenue DESC, category", "concat(category, '|', day_of_week)", "revenue", "NULL", "NULL",
                 "NULL"),
    "top_customers": (ORACLE["top_customers"], "rank", "customer_name", "revenue", "units", "transactions", "share"),
    "staff": (ORACLE["staff_rollup"], "revenue DESC, salesperson", "salesperson", "revenue", "NULL", "transactions", "share"),
    "hours": (ORACLE["hour_buckets"].replace(EVENT_LINES, LINES + ",\n" + CLEAN).replace("elines", "clean"), "bucket_ord",
              "time_bucket", "revenue", "NULL", "transactions", "share"),
    "comparison": (ORACLE["period_metrics"], "metric_ord", "metric", "p2", "p1", "NULL", "pct_change"),
    "period_categories": (ORACLE["period_categories"], "p2 DESC, category", "category", "p2", "p1", "NULL", "pct_change"),
    "new_products": (ORACLE["new_products"], "revenue DESC, item_name", "item_name", "revenue", "NULL", "NULL", "NULL"),
    "payments": (ORACLE["payment_mix"], "revenue DESC, channel", "concat(channel, '|', risk)", "revenue", "NULL",
                 "transactions", "share"),
    "conversion": (ORACLE["conversion_kpis"].replace(_CONV, _CONV_CLEAN), "posts",
                   "concat(CAST(posts AS {text}), '|', CAST(non_converted AS {text}))", "conversion_rate", "avg_days",
                   "converted", "share_within_3"),
}


def _long(sheet: str, text: str, position: str) -> list[str]:
    _, _, label, value, other, n, ratio = _SHEET_ROWS[sheet]
    return [f"'{sheet}' AS sheet", f"CAST({position} AS BIGINT) AS position", f"{label.format(text=text)} AS label",
            f"CAST({value} AS DOUBLE) AS value", f"CAST({other} AS DOUBLE) AS other", f"CAST({n} AS BIGINT) AS n",
            f"CAST({ratio} AS DOUBLE) AS ratio"]


@register("report_full", "\nUNION ALL\n".join(
    f"SELECT {', '.join(_long(_name, 'VARCHAR', f'row_number() OVER (ORDER BY {_row[1]})'))} FROM ({_row[0]}) s"
    for _name, _row in _SHEET_ROWS.items()))
def q_report_full(spark, sf):
    """Fifteen sheets from one scan of the lines, each written in
    its order and read back with the rows' positions."""
    sheets = RP.report_in_one_pass(clean(spark, sf), headers(spark, sf), posts(spark, sf), P1, P2)
    paths = RP.write_report_in_order(sheets, _scratch(spark, "report"))
    return reduce(DataFrame.unionByName, [
        OD.read_in_order(spark, path).selectExpr(*_long(name, "STRING", "position")) for name, path in paths.items()])


@register("sales_in_order", "SELECT sale_id, invoice_total_raw, n_lines, items_sold, "
          f"row_number() OVER (ORDER BY sale_id) AS position FROM ({ORACLE['build_sales']}) s")
def q_sales_in_order(spark, sf):
    """Sales written in ascending sale id, read back with their positions."""
    path = OD.write_in_order(SA.build_sales(sheet_lines(spark, sf)).select(
        "sale_id", "invoice_total_raw", "n_lines", "items_sold"), _scratch(spark, "sales-in-order"), "sale_id")
    return OD.read_in_order(spark, path)


@register("lines_by_day", WC + """
SELECT sale_id, invoice_datetime, l_linenumber AS line, subtotal, row_number() OVER (ORDER BY
  invoice_datetime, sale_id, l_linenumber, pos_item_id, l_suppkey, subtotal) AS position FROM clean""")
def q_lines_by_day(spark, sf):
    """All cleaned lines in date order; days, however busy, are split by
    sale and line."""
    lines = clean(spark, sf, ()).select("sale_id", "invoice_datetime", F.col("_row_no.l_linenumber").alias("line"), "subtotal",
                                        F.col("_row_no").alias("_tie"))
    path = OD.write_in_order(lines, _scratch(spark, "lines-by-day"), "invoice_datetime", "sale_id", "_tie", "subtotal")
    return OD.read_in_order(spark, path).drop("_tie")
