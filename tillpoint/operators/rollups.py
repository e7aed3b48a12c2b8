"""Business rollups over sales lines.

Conventions, kept the same in every rollup:

* group keys that are null are dropped before grouping (a pandas group-by
  drops them too);
* money is summed as ``decimal(18,2)`` so totals do not depend on row
  order, then exposed as double; an all-null group sums to 0;
* a share of a total is computed from the grouped result, not from the
  lines: the grouping (null key kept until the end, so the total is still
  the total of all lines) is written once as a small table under the
  checkpoint folder, and the total is a scalar subquery over it
  (``DataFrame.scalar()``).  The fact table is scanned once; there is no
  cross join and no window without partition keys (which would move every
  row to one task);
* every aggregation is partial + final (map-side combine), so a group
  holding a third of the rows is pre-aggregated on every mapper before the
  shuffle.  Distinct counts shuffle on (key, sale_id), which spreads a hot
  key over all reducers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillpoint import constants as K
from tillpoint.functions import scalars as S
from tillpoint.operators.lines import with_time_parts
from tillpoint.session import materialize


def _m1(revenue="subtotal", qty="quantity", sale="sale_id"):
    return [S.money_sum(revenue).alias("revenue"), S.qty_sum(qty).alias("units"),
            F.countDistinct(sale).alias("transactions")]


def _total(df: DataFrame, revenue: str):
    """Scalar subquery with the money total of ``df``."""
    return df.select(S.money_sum(revenue)).scalar()


def _grouped(lines: DataFrame, keys: list, aggs: list, name: str):
    """Group once (null keys kept), materialize, return (groups with non-null
    keys, exact total of ``_rev`` over all groups as a scalar subquery)."""
    g = materialize(lines.groupBy(*keys).agg(*aggs), name)
    total = g.select(F.coalesce(F.sum("_rev"), F.lit(0)).cast("double")).scalar()
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return g.filter(cond).withColumn("revenue", F.col("_rev").cast("double")), total


# A1 + A2 ----------------------------------------------------------------------
def kpi_totals(lines: DataFrame, revenue="subtotal", qty="quantity", sale="sale_id",
               ts="invoice_datetime", price="unit_price") -> DataFrame:
    out = lines.agg(
        S.money_sum(revenue).alias("revenue"),
        F.countDistinct(sale).alias("transactions"),
        S.qty_sum(qty).alias("units"),
        F.countDistinct(F.to_date(ts)).alias("days"),
        S.money_sum(price).alias("_price_sum"),
        F.count(price).alias("_price_n"))
    return out.select(
        "revenue", "transactions", "units", "days",
        S.safe_div("revenue", "days").alias("revenue_per_day"),
        S.safe_div("revenue", "transactions").alias("avg_basket"),
        S.safe_div("_price_sum", "_price_n").alias("avg_price"))


# A3 + J7 ----------------------------------------------------------------------
def category_rollup(lines: DataFrame, key="category", revenue="subtotal") -> DataFrame:
    g, total = _grouped(lines, [key], [S.money_dec(revenue).alias("_rev"),
                                       S.qty_sum("quantity").alias("units"),
                                       F.countDistinct("sale_id").alias("transactions")],
                        "category_rollup")
    return g.select(key, "revenue", "units", "transactions",
                    S.safe_div("revenue", "units").alias("avg_price"),
                    S.safe_div("revenue", F.lit(total)).alias("share"))


# A4 ---------------------------------------------------------------------------
def category_rollup_mean(lines: DataFrame, key="category", revenue="line_total",
                         price="unit_price") -> DataFrame:
    g = lines.filter(F.col(key).isNotNull()).groupBy(key).agg(
        S.money_sum(revenue).alias("revenue"), S.qty_sum("quantity").alias("qty"),
        S.money_sum(price).alias("_ps"), F.count(price).alias("_pn"))
    return g.select(key, "revenue", "qty", S.safe_div("_ps", "_pn").alias("avg_price"))


# A5 + J6 ----------------------------------------------------------------------
def weekday_calendar(spark) -> DataFrame:
    """The seven weekdays with their display order."""
    return spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("day_ord"), F.lit(d).alias("day_of_week"))
        for i, d in enumerate(K.DAY_ORDER)])))


def weekday_rollup(lines: DataFrame, revenue="subtotal", fill_zero: bool = True) -> DataFrame:
    """All seven weekdays in calendar order; absent days are 0 (or null with
    ``fill_zero=False``); ``share`` is the day's part of the week total."""
    spark = lines.sparkSession
    t = with_time_parts(lines)
    g, week_total = _grouped(t.filter(F.col("day_of_week").isNotNull()), ["day_of_week"],
                             [S.money_dec(revenue).alias("_rev"), S.qty_sum("quantity").alias("units"),
                              F.countDistinct("sale_id").alias("transactions")], "weekday_rollup")
    out = weekday_calendar(spark).join(g.drop("_rev"), "day_of_week", "left")
    if fill_zero:
        out = out.fillna(0, subset=["revenue", "units", "transactions"])
    return out.select("day_ord", "day_of_week", "revenue", "units", "transactions",
                      S.safe_div("revenue", F.lit(week_total)).alias("share"))


# A6 ---------------------------------------------------------------------------
def daily_rollup(lines: DataFrame, revenue="subtotal") -> DataFrame:
    t = lines.withColumn("sale_date", F.to_date("invoice_datetime")) \
        .filter(F.col("sale_date").isNotNull())
    g = t.groupBy("sale_date").agg(*_m1(revenue))
    return g.select("sale_date", S.day_name("sale_date").alias("day_of_week"), "revenue",
                    "units", "transactions",
                    S.safe_div("revenue", "transactions").alias("avg_basket"))


# W4 + F31 ---------------------------------------------------------------------
def daily_vs_avg(lines: DataFrame, revenue="subtotal") -> DataFrame:
    """Each day's revenue against the period average (total / trading days)."""
    t = lines.withColumn("sale_date", F.to_date("invoice_datetime"))
    g = materialize(t.groupBy("sale_date").agg(
        S.money_dec(revenue).alias("_rev"), F.countDistinct("sale_id").alias("transactions")),
        "daily_vs_avg")
    # period average = total of all lines / trading days (one scalar subquery)
    avg = g.select(S.safe_div(F.sum("_rev").cast("double"),
                              F.count("sale_date"))).scalar()
    d = g.filter(F.col("sale_date").isNotNull()).select(
        "sale_date", S.day_name("sale_date").alias("day_of_week"),
        F.col("_rev").cast("double").alias("revenue"), "transactions",
        avg.alias("period_avg"))
    ratio = S.safe_div(F.col("revenue") - F.col("period_avg"), F.col("period_avg"))
    return d.withColumn("vs_avg", ratio).withColumn("band", S.vs_avg_band(F.col("vs_avg")))


# A7 / A8 ----------------------------------------------------------------------
def product_rollup(lines: DataFrame, revenue="subtotal") -> DataFrame:
    g = lines.filter(F.col("item_name").isNotNull() & F.col("category").isNotNull()) \
        .groupBy("item_name", "category").agg(*_m1(revenue))
    return g.select("item_name", "category", "revenue", "units", "transactions",
                    S.safe_div("revenue", "units").alias("avg_price"),
                    S.safe_div("revenue", "transactions").alias("rev_per_txn"))


def product_rollup_mean(lines: DataFrame, revenue="line_total", price="unit_price") -> DataFrame:
    g = lines.filter(F.col("item_name").isNotNull() & F.col("category").isNotNull()) \
        .groupBy("item_name", "category").agg(
            S.money_sum(revenue).alias("revenue"), S.qty_sum("quantity").alias("qty"),
            F.countDistinct("sale_id").alias("transactions"),
            S.money_sum(price).alias("_ps"), F.count(price).alias("_pn"))
    return g.select("item_name", "category", "revenue", "qty", "transactions",
                    S.safe_div("_ps", "_pn").alias("avg_price"),
                    S.safe_div("revenue", "transactions").alias("rev_per_txn"))


# A9 / A10 ---------------------------------------------------------------------
def hour_buckets(lines: DataFrame, revenue="subtotal") -> DataFrame:
    h = F.hour("invoice_datetime")
    t = lines.select(S.hour_bucket(h).alias("time_bucket"),
                     S.hour_bucket_order(h).alias("bucket_ord"), "sale_id", revenue) \
        .filter(F.col("time_bucket").isNotNull())
    g, tb_total = _grouped(t, ["bucket_ord", "time_bucket"], [
        F.countDistinct("sale_id").alias("transactions"), S.money_dec(revenue).alias("_rev")],
        "hour_buckets")
    return g.select("bucket_ord", "time_bucket", "transactions", "revenue",
                    S.safe_div("revenue", F.lit(tb_total)).alias("share"))


def hour_buckets_six(lines: DataFrame, revenue="line_total",
                     include_midnight: bool = False) -> DataFrame:
    h = F.hour("invoice_datetime")
    t = lines.select(S.hour_bucket_six(h, include_midnight).alias("hb"),
                     S.hour_bucket_six_order(h, include_midnight).alias("bucket_ord"),
                     "sale_id", revenue).filter(F.col("hb").isNotNull())
    return t.groupBy("bucket_ord", "hb").agg(
        F.countDistinct("sale_id").alias("transactions"), S.money_sum(revenue).alias("revenue"))


# A11 / A12 --------------------------------------------------------------------
def price_bands(lines: DataFrame, revenue="subtotal", price="unit_price") -> DataFrame:
    """Open-top bands: line count (non-null names), units, revenue and share
    of the banded revenue."""
    t = lines.select(S.price_band(price).alias("price_bucket"),
                     S.price_band_order(price).alias("band_ord"), "item_name", "quantity",
                     revenue).filter(F.col("price_bucket").isNotNull())
    g, banded = _grouped(t, ["band_ord", "price_bucket"], [
        F.count("item_name").alias("line_items"), S.qty_sum("quantity").alias("units"),
        S.money_dec(revenue).alias("_rev")], "price_bands")
    return g.select("band_ord", "price_bucket", "line_items", "units", "revenue",
                    S.safe_div("revenue", F.lit(banded)).alias("pct_revenue"))


def price_bands_capped(lines: DataFrame, revenue="line_total", price="unit_price") -> DataFrame:
    """Capped bands (last (100k, 500k]): item-id count, units, revenue and
    percent of the whole-unit (truncated) banded total."""
    t = lines.select(S.price_band(price, capped=True).alias("price_bucket"),
                     S.price_band_order(price, capped=True).alias("band_ord"),
                     "pos_item_id", "quantity", revenue) \
        .filter(F.col("price_bucket").isNotNull())
    g = materialize(t.groupBy("band_ord", "price_bucket").agg(
        F.count("pos_item_id").alias("count"), S.qty_sum("quantity").alias("qty"),
        S.money_dec(revenue).alias("_rev")), "price_bands_capped") \
        .withColumn("revenue", F.col("_rev").cast("double"))
    trunc_total = g.select(F.coalesce(F.sum("_rev"), F.lit(0)).cast("bigint")).scalar()
    return g.select("band_ord", "price_bucket", "count", "qty", "revenue",
                    (S.safe_div("revenue", F.lit(trunc_total)) * 100).alias("pct"))


# A13 / A14 / A24 --------------------------------------------------------------
def customer_rollup(lines: DataFrame, revenue="subtotal", key="customer_name") -> DataFrame:
    return lines.filter(F.col(key).isNotNull()).groupBy(key).agg(*_m1(revenue))


def top_customers(lines: DataFrame, k: int = 15, revenue="subtotal") -> DataFrame:
    """Top-k customers by revenue: basket and share of the grand total."""
    g, total = _grouped(lines, ["customer_name"], [
        S.money_dec(revenue).alias("_rev"), F.countDistinct("sale_id").alias("transactions"),
        S.qty_sum("quantity").alias("units")], "top_customers")
    top = g.orderBy(F.desc("revenue"), F.asc("customer_name")).limit(k)
    return with_rank(top.select(
        F.trim("customer_name").alias("customer_name"), "revenue", "transactions", "units",
        S.safe_div("revenue", "transactions").alias("avg_basket"),
        S.safe_div("revenue", F.lit(total)).alias("share")), "revenue", "customer_name")


def top_customers_share(lines: DataFrame, k: int = 10, revenue="line_total") -> DataFrame:
    """Top-k customers; share is of the (truncated) top-k subtotal, in %."""
    g = lines.filter(F.col("customer_name").isNotNull()).groupBy("customer_name").agg(
        S.money_dec(revenue).alias("_rev"), F.countDistinct("sale_id").alias("transactions")) \
        .withColumn("revenue", F.col("_rev").cast("double"))
    # the top-k rows (k of them) are written once, then both listed and summed
    top = materialize(g.orderBy(F.desc("_rev"), F.asc("customer_name")).limit(k), "top_k")
    top_total = top.select(F.sum("_rev").cast("bigint")).scalar()
    return top.select("customer_name", "revenue", "transactions",
                      S.safe_div("revenue", "transactions").alias("spend_per_visit"),
                      (S.safe_div("revenue", F.lit(top_total)) * 100).alias("share_pct"))


def top3_share(lines: DataFrame, revenue="subtotal") -> DataFrame:
    """Customer concentration: revenue of the top three customers / total."""
    g, total = _grouped(lines, ["customer_name"], [S.money_dec(revenue).alias("_rev")],
                        "top3_share")
    top3 = g.orderBy(F.desc("_rev"), "customer_name").limit(3)
    return top3.agg(F.coalesce(F.sum("_rev").cast("double"), F.lit(0.0)).alias("top3_revenue")).select(
        "top3_revenue", F.lit(total).alias("total_revenue"),
        S.safe_div("top3_revenue", F.lit(total)).alias("top3_share"))


def customer_lookup(lines: DataFrame, name: str, revenue="subtotal") -> DataFrame:
    """P10: revenue of one customer by trimmed name; 0 when absent."""
    hit = lines.filter(F.trim("customer_name") == F.lit(name.strip()))
    return hit.agg(S.money_sum(revenue).alias("revenue"),
                   F.countDistinct("sale_id").alias("transactions")) \
        .select(F.lit(name.strip()).alias("customer_name"), "revenue", "transactions")


# A18 --------------------------------------------------------------------------
def payment_mix(sales: DataFrame, text="payment_type") -> DataFrame:
    """Payment channels of sale headers: transactions, revenue (positive
    amounts; change given back is left out), share and risk class."""
    p = sales.select("sale_id", F.explode(S.parse_payments(text)).alias("p")).select(
        "sale_id", F.col("p.channel").alias("channel"),
        S.parse_money(F.col("p.amount")).alias("amount")).filter(F.col("amount") > 0)
    g, total = _grouped(p, ["channel"], [F.countDistinct("sale_id").alias("transactions"),
                                         S.money_dec("amount").alias("_rev")], "payment_mix")
    return g.select("channel", "transactions", "revenue",
                    S.safe_div("revenue", F.lit(total)).alias("share"),
                    S.payment_risk("channel").alias("risk"))


# A19 --------------------------------------------------------------------------
def staff_rollup(lines: DataFrame, revenue="subtotal") -> DataFrame:
    g, total = _grouped(lines, ["salesperson"], [
        S.money_dec(revenue).alias("_rev"), F.countDistinct("sale_id").alias("transactions")],
        "staff_rollup")
    return g.select("salesperson", "revenue", "transactions",
                    S.safe_div("revenue", F.lit(total)).alias("share"))


# W2 ---------------------------------------------------------------------------
def with_rank(top: DataFrame, by: str, tie: str) -> DataFrame:
    """Display rank 1..k of an already limited top-k frame.

    ``top`` comes out of ``orderBy().limit(k)`` (TakeOrderedAndProject, one
    partition of at most k rows), so this window adds no shuffle.
    """
    w = Window.orderBy(F.desc(by), F.asc(tie))
    return top.withColumn("rank", F.row_number().over(w))


# A15 + W1 ---------------------------------------------------------------------
def best_day(lines: DataFrame, revenue="subtotal") -> DataFrame:
    """Best weekday per category; ties go to the alphabetically first day."""
    t = with_time_parts(lines).filter(F.col("category").isNotNull() &
                                      F.col("day_of_week").isNotNull())
    g = t.groupBy("category", "day_of_week").agg(S.money_sum(revenue).alias("revenue"))
    w = Window.partitionBy("category").orderBy(F.desc("revenue"), F.asc("day_of_week"))
    return g.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


# T1-T6 ------------------------------------------------------------------------
def top_products(lines: DataFrame, k: int = 25, revenue="subtotal") -> DataFrame:
    top = product_rollup(lines, revenue).orderBy(
        F.desc("revenue"), "item_name", "category").limit(k)
    w = Window.orderBy(F.desc("revenue"), "item_name", "category")
    return top.withColumn("rank", F.row_number().over(w))


def top_products_mean(lines: DataFrame, k: int = 20, revenue="line_total") -> DataFrame:
    return product_rollup_mean(lines, revenue).orderBy(
        F.desc("revenue"), "item_name", "category").limit(k)


def peak_day(lines: DataFrame, revenue="subtotal") -> DataFrame:
    return daily_rollup(lines, revenue).orderBy(F.desc("revenue"), "sale_date").limit(1)
