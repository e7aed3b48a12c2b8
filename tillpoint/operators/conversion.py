"""Post -> first sale conversion.

``first_sale_after`` is an as-of join: for each post, the first sale date of
the same product on or after the posted date.  It is not a range join over
all pairs: posts and sale dates are first reduced to distinct (product,
date) pairs — bounded by products x calendar days whatever the data size —
then one window per product, ordered by date descending, carries a
running minimum of sale dates (an incremental frame, linear in the
partition).  The answer is joined back to every post on (product, date).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillpoint import constants as K
from tillpoint.functions import scalars as S


def first_sale_after(posts: DataFrame, sale_dates: DataFrame, product="product",
                     posted="posted_date", sold="sale_date") -> DataFrame:
    """posts(product, posted_date, ...) -> + first_sale_date,
    days_to_first_sale, sold_within_3_days."""
    p = posts.select(F.col(product).alias("_p"), F.col(posted).alias("_d")).distinct() \
        .withColumn("_sale", F.lit(0))
    s = sale_dates.select(F.col(product).alias("_p"), F.col(sold).alias("_d")).distinct() \
        .withColumn("_sale", F.lit(1))
    u = p.unionByName(s)
    # date descending, sales before posts on the same date: the running
    # minimum up to a post covers exactly the sales on or after its date
    w = Window.partitionBy("_p").orderBy(F.desc("_d"), F.desc("_sale")) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    nxt = u.withColumn("_first", F.min(F.when(F.col("_sale") == 1, F.col("_d"))).over(w)) \
        .filter(F.col("_sale") == 0).select(F.col("_p").alias(product), F.col("_d").alias(posted),
                                            F.col("_first").alias("first_sale_date"))
    days = F.datediff("first_sale_date", posted)
    return posts.join(nxt, [product, posted], "left") \
        .withColumn("days_to_first_sale", days) \
        .withColumn("sold_within_3_days",
                    F.when(days.isNotNull(), days <= K.QUICK_SALE_DAYS))


def tracker(conv: DataFrame) -> DataFrame:
    """S2 columns + F30 status."""
    return conv.withColumn("status", S.conversion_status("sold_within_3_days", "first_sale_date"))


def conversion_hist(conv: DataFrame) -> DataFrame:
    """Posts per days-to-first-sale (converted posts only)."""
    return conv.filter(F.col("days_to_first_sale").isNotNull()).groupBy(
        F.col("days_to_first_sale").alias("days")).agg(F.count(F.lit(1)).alias("count"))


def non_converting(conv: DataFrame, product="product", posted="posted_date") -> DataFrame:
    """P8 + U1: distinct posts that never sold."""
    return conv.filter(F.col("first_sale_date").isNull()).select(product, posted).distinct()


def conversion_kpis(conv: DataFrame, product="product", posted="posted_date") -> DataFrame:
    """Posts, converted, rate, average days, share sold within 3 days
    (of converted), distinct non-converting posts — one aggregation."""
    never = F.when(F.col("first_sale_date").isNull(), F.struct(product, posted))
    return conv.agg(
        F.count(F.lit(1)).alias("posts"),
        F.count("first_sale_date").alias("converted"),
        F.sum("days_to_first_sale").alias("_days"),
        F.count_if(F.col("sold_within_3_days")).alias("within_3"),
        F.countDistinct(never).alias("non_converted")).select(
        "posts", "converted", S.safe_div("converted", "posts").alias("conversion_rate"),
        S.safe_div("_days", "converted").alias("avg_days"),
        S.safe_div("within_3", "converted").alias("share_within_3"), "non_converted")


def decision_flags(conv: DataFrame, prices: DataFrame, as_of, product="product",
                   posted="posted_date") -> DataFrame:
    """Q3: rule flags per distinct post from the product's average selling
    price and the days it stayed unsold (to its first sale, else to
    ``as_of``)."""
    posts = conv.select(product, posted, "days_to_first_sale").distinct()
    j = posts.join(prices, product, "left")
    unsold = F.coalesce(F.col("days_to_first_sale"), F.datediff(F.lit(as_of), F.col(posted)))
    price = F.col("avg_price")
    out = j.withColumn("days_unsold", unsold)
    for rule, lo, hi, min_days in K.DECISION_RULES:
        cond = F.col("days_unsold") >= min_days
        if lo is not None:
            cond = cond & (price > lo)
        if hi is not None:
            cond = cond & (price <= hi)
        out = out.withColumn(rule, F.coalesce(cond, F.lit(False)))
    return out
