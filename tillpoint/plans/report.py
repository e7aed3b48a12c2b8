"""Report sink (S9): the named result tables of the sales report, built
from one cleaned line set and written one parquet folder per sheet.

``report`` builds single sheets from the lines; ``report_in_one_pass`` builds
all of them from one scan."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.functions import scalars as S
from tillpoint.operators import compare as CP
from tillpoint.operators import conversion as CV
from tillpoint.operators import rollups as R
from tillpoint.session import materialize, release_shuffles
from tillpoint.sinks.ordered import write_in_order

SHEETS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "executive_kpis": R.kpi_totals,
    "categories": R.category_rollup,
    "weekdays": R.weekday_rollup,
    "daily": R.daily_vs_avg,
    "price_bands": R.price_bands,
    "top_products": R.top_products,
    "best_day": R.best_day,
    "top_customers": R.top_customers,
    "staff": R.staff_rollup,
}


def report(lines: DataFrame, sheets=None) -> dict[str, DataFrame]:
    """Sheet name -> DataFrame (all sheets, or the ``sheets`` named)."""
    return {n: SHEETS[n](lines) for n in (sheets or SHEETS)}


def write_report(sheets: dict[str, DataFrame], out: str) -> dict[str, str]:
    """Write each sheet to ``out/<sheet>``; returns sheet -> path."""
    paths = {}
    for name, df in sheets.items():
        p = f"{out.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(p)
        paths[name] = p
    return paths


# ------------------------------------------------------------------ one pass over the lines

#: sums that distinct sales are counted in; they are first summed by sale
BY_SALE = {
    "all": [], "categories": ["category"], "weekdays": ["day_of_week"], "daily": ["sale_date"],
    "price_bands": ["band_ord", "price_bucket"], "products": ["item_name", "category"], "customers": ["customer_name"],
    "staff": ["salesperson"], "hours": ["bucket_ord", "time_bucket"], "periods": ["period"]}
#: sums without distinct sales
PLAIN = {"best_day": ["category", "day_of_week"], "period_categories": ["period", "category"],
         "period_products": ["period", "item_name"], "sale_dates": ["item_name", "sale_date"]}
DIMENSIONS = ["category", "day_of_week", "sale_date", "band_ord", "price_bucket", "item_name", "customer_name",
              "salesperson", "bucket_ord", "time_bucket", "period"]
#: exact sums with their decimal places, and counts
SUMS, COUNTS = {"rev": 2, "units": 4, "prices": 2}, ["n_prices", "n_names"]
#: an amount is summed as two longs, its units of 10^6 smallest parts and the rest of them,
#: which stays exact for some 10^12 lines a group; decimal sums would cost half the pass
UNIT = 1_000_000


def _halves(name: str, amount: Column) -> list[Column]:
    """The two longs of an amount (null: null)."""
    whole = (amount.cast(f"decimal(18,{SUMS[name]})") * 10 ** SUMS[name]).cast("long")
    return [F.call_function("div", whole, F.lit(UNIT)).alias(f"{name}_u"), (whole % UNIT).alias(f"{name}_r")]


def _whole(name: str) -> Column:
    """The exact amount of two summed longs."""
    parts = F.col(f"{name}_u").cast("decimal(19,0)") * UNIT + F.col(f"{name}_r").cast("decimal(19,0)")
    return (parts * F.lit(Decimal(1).scaleb(-SUMS[name]))).alias(name)


def _grouping(keys: list[str]) -> int:
    """``grouping_id`` of a set over DIMENSIONS: a bit is 1 where the set
    lacks the column."""
    return int("".join("01"[d not in keys] for d in DIMENSIONS), 2)


class Cube:
    """The grouped sums of all sheets, written once.  Reading a set costs its
    rows, not the lines."""

    def __init__(self, table: DataFrame):
        self.table = table

    def all(self, name: str) -> DataFrame:
        """The groups of a set, those with null keys too (their lines count
        in totals)."""
        keys = (BY_SALE | PLAIN)[name]
        return self.table.filter(F.col("gid") == _grouping(keys)).select(
            *keys, "rev", F.col("rev").cast("double").alias("revenue"), F.col("units").cast("double").alias("units"),
            "transactions", F.col("prices").cast("double").alias("prices"), "n_prices", "n_names")

    def groups(self, name: str) -> DataFrame:
        """The groups of a set whose keys are all known."""
        return self.all(name).dropna(subset=(BY_SALE | PLAIN)[name])

    def total(self, name: str):
        """Scalar subquery: the revenue of a set's known groups."""
        return self.groups(name).select(F.coalesce(F.sum("rev"), F.lit(0)).cast("double")).scalar()


def cube(lines: DataFrame, period_1: tuple[str, str], period_2: tuple[str, str]) -> Cube:
    """All sums of the report from one scan of the lines.

    One pass of grouping sets sums by group and sale, a second by group, so
    that distinct sales are counted without keeping a set of them: a group
    that holds a third of the lines is spread by its sales.  Lines are
    multiplied by the number of sets in memory only; partial sums are
    shuffled."""
    sale = "sale_id"
    hour = F.hour("invoice_datetime")
    day = F.to_date("invoice_datetime")

    def within(p):
        return (day >= F.lit(p[0]).cast("date")) & (day < F.lit(p[1]).cast("date"))

    t = lines.select(
        "category", S.day_name("invoice_datetime").alias("day_of_week"), day.alias("sale_date"),
        S.price_band_order("unit_price").alias("band_ord"), S.price_band("unit_price").alias("price_bucket"), "item_name",
        "customer_name", "salesperson", S.hour_bucket_order(hour).alias("bucket_ord"),
        S.hour_bucket(hour).alias("time_bucket"), F.when(within(period_1), 1).when(within(period_2), 2).alias("period"),
        sale, *_halves("rev", F.col("subtotal")), *_halves("units", F.col("quantity")), *_halves("prices", F.col("unit_price")),
        F.col("unit_price").isNotNull().cast("long").alias("n_prices"),
        # a name is also a key: as a key it is null outside its sets
        F.col("item_name").isNotNull().cast("long").alias("n_names"))
    sets = [[*keys, sale] for keys in BY_SALE.values()] + list(PLAIN.values())
    parts = [f"{c}_{h}" for c in SUMS for h in "ur"] + COUNTS
    by_sale = t.groupingSets(sets, *DIMENSIONS, sale).agg(
        F.grouping_id().alias("gid"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in parts])
    sums = by_sale.groupBy(F.shiftright("gid", 1).cast("long").alias("gid"), *DIMENSIONS).agg(
        F.count(sale).alias("transactions"), *[F.sum(c).alias(c) for c in parts])
    c = Cube(materialize(sums.select("gid", *DIMENSIONS, "transactions", *[_whole(c) for c in SUMS], *COUNTS), "report_cube"))
    release_shuffles(c.table.sparkSession)
    return c


def _executive_kpis(c: Cube) -> DataFrame:
    days = c.groups("daily").select(F.count("*")).scalar()
    k = c.all("all").agg(*[F.coalesce(F.max(x), F.lit(0)).alias(x)            # one row, or none without lines
                           for x in ("revenue", "transactions", "units", "prices", "n_prices")])
    return k.withColumn("days", days).select("revenue", "transactions", "units", "days", S.safe_div("revenue", "days").alias("revenue_per_day"),
                    S.safe_div("revenue", "transactions").alias("avg_basket"),
                    S.safe_div("prices", "n_prices").alias("avg_price"))


def _categories(c: Cube) -> DataFrame:
    total = c.all("all").select("revenue").scalar()
    return c.groups("categories").select("category", "revenue", "units", "transactions",
                                         S.safe_div("revenue", "units").alias("avg_price"),
                                         S.safe_div("revenue", total).alias("share"))


def _weekdays(c: Cube) -> DataFrame:
    out = R.weekday_calendar(c.table.sparkSession).join(c.groups("weekdays"), "day_of_week", "left").fillna(
        0, subset=["revenue", "units", "transactions"])
    return out.select("day_ord", "day_of_week", "revenue", "units", "transactions",
                      S.safe_div("revenue", c.total("weekdays")).alias("share"))


def _daily(c: Cube) -> DataFrame:
    avg = S.safe_div(c.all("all").select("revenue").scalar(), c.groups("daily").select(F.count("*")).scalar())
    d = c.groups("daily").select("sale_date", S.day_name("sale_date").alias("day_of_week"), "revenue", "transactions",
                                 avg.alias("period_avg"))
    d = d.withColumn("vs_avg", S.safe_div(F.col("revenue") - F.col("period_avg"), "period_avg"))
    return d.withColumn("band", S.vs_avg_band("vs_avg"))


def _price_bands(c: Cube) -> DataFrame:
    return c.groups("price_bands").select("band_ord", "price_bucket", F.col("n_names").alias("line_items"), "units",
                                          "revenue", S.safe_div("revenue", c.total("price_bands")).alias("pct_revenue"))


def _top_products(c: Cube, k: int = 25) -> DataFrame:
    top = c.groups("products").orderBy(F.desc("revenue"), "item_name", "category").limit(k).select(
        "item_name", "category", "revenue", "units", "transactions", S.safe_div("revenue", "units").alias("avg_price"),
        S.safe_div("revenue", "transactions").alias("rev_per_txn"))
    w = Window.orderBy(F.desc("revenue"), "item_name", "category")          # over the k rows
    return top.withColumn("rank", F.row_number().over(w))


def _best_day(c: Cube) -> DataFrame:
    w = Window.partitionBy("category").orderBy(F.desc("revenue"), "day_of_week")
    return (c.groups("best_day").withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
            .select("category", "day_of_week", "revenue"))


def _top_customers(c: Cube, k: int = 15) -> DataFrame:
    top = c.groups("customers").orderBy(F.desc("revenue"), "customer_name").limit(k)
    return R.with_rank(top.select(
        F.trim("customer_name").alias("customer_name"), "revenue", "transactions", "units",
        S.safe_div("revenue", "transactions").alias("avg_basket"),
        S.safe_div("revenue", c.all("all").select("revenue").scalar()).alias("share")), "revenue", "customer_name")


def _staff(c: Cube) -> DataFrame:
    total = c.all("all").select("revenue").scalar()
    return c.groups("staff").select("salesperson", "revenue", "transactions", S.safe_div("revenue", total).alias("share"))


def _hours(c: Cube) -> DataFrame:
    return c.groups("hours").select("bucket_ord", "time_bucket", "transactions", "revenue",
                                    S.safe_div("revenue", c.total("hours")).alias("share"))


def _comparison(c: Cube, period_1, period_2) -> DataFrame:
    def days(p):
        return c.groups("daily").filter(F.col("sale_date").between(p[0], F.date_sub(F.lit(p[1]).cast("date"), 1))).select(
            F.count("*")).scalar()
    return CP.metrics(c.groups("periods").select(
        "period", F.col("revenue").alias("rev"), F.col("transactions").alias("txn"),
        F.when(F.col("period") == 1, days(period_1)).otherwise(days(period_2)).alias("days"), "units"))


def _both_periods(c: Cube, name: str, key: str) -> DataFrame:
    def of(p):
        return F.col("period") == p
    return c.groups(name).groupBy(key).agg(
        F.coalesce(F.max(F.when(of(1), F.col("revenue"))), F.lit(0.0)).alias("p1"),
        F.coalesce(F.max(F.when(of(2), F.col("revenue"))), F.lit(0.0)).alias("p2"),
        (F.count_if(of(1)) > 0).alias("_before"), (F.count_if(of(2)) > 0).alias("_now"))


def report_in_one_pass(lines: DataFrame, sales: DataFrame, posts: DataFrame, period_1: tuple[str, str],
                       period_2: tuple[str, str]) -> dict[str, DataFrame]:
    """All sheets (S9) from one scan of the cleaned lines.  ``sales`` (headers
    with ``payment_type``) gives the payment sheet, ``posts`` (product,
    posted_date) the conversion sheet.  A period is [start, end); lines
    outside both count in the other sheets only.  No lines: empty sheets, and
    zeros in those of one row."""
    c = cube(lines, period_1, period_2)
    sold = c.groups("sale_dates").select(F.col("item_name").alias("product"), "sale_date")
    return {
        "executive_kpis": _executive_kpis(c), "categories": _categories(c), "weekdays": _weekdays(c), "daily": _daily(c),
        "price_bands": _price_bands(c), "top_products": _top_products(c), "best_day": _best_day(c),
        "top_customers": _top_customers(c), "staff": _staff(c), "hours": _hours(c),
        "comparison": _comparison(c, period_1, period_2),
        "period_categories": CP.changes(_both_periods(c, "period_categories", "category"), "category"),
        "new_products": CP.newcomers(_both_periods(c, "period_products", "item_name"), "item_name", 20, 10),
        "payments": R.payment_mix(sales),
        "conversion": CV.conversion_kpis(CV.first_sale_after(posts, sold)),
    }


#: the order of each sheet's rows
ORDER = {
    "executive_kpis": ["revenue"], "categories": ["-revenue", "category"], "weekdays": ["day_ord"], "daily": ["sale_date"],
    "price_bands": ["band_ord"], "top_products": ["rank"], "best_day": ["-revenue", "category"], "top_customers": ["rank"],
    "staff": ["-revenue", "salesperson"], "hours": ["bucket_ord"], "comparison": ["metric_ord"],
    "period_categories": ["-p2", "category"], "new_products": ["-revenue", "item_name"], "payments": ["-revenue", "channel"],
    "conversion": ["posts"]}


def write_report_in_order(sheets: dict[str, DataFrame], out: str) -> dict[str, str]:
    """Write each sheet to ``out/<sheet>``, rows in the sheet's order."""
    return {name: write_in_order(df, f"{out.rstrip('/')}/{name}",
                                 *[F.desc(k[1:]) if k[0] == "-" else F.asc(k) for k in ORDER[name]])
            for name, df in sheets.items()}
