"""Sales lines built from the driver's TPC-H-like tables.

Mapping (one row per ``lineitem`` row):

======================  ==============================================
sales-line column       driver column
======================  ==============================================
sale_id                 l_orderkey (= orders.o_orderkey)
invoice_datetime        o_orderdate (TIMESTAMP_NTZ, midnight)
salesperson             supplier.s_name via l_suppkey
customer_name           customer.c_name via o_custkey
payment_type            text built from o_orderpriority / o_totalprice
pos_item_id             l_partkey
item_name / category    part.p_name / part.p_type
quantity                l_quantity
unit_price              l_extendedprice  ("Selling Price" for bands)
subtotal / line_total   l_extendedprice
invoice_total           o_totalprice
_row_no                 struct(l_linenumber, l_partkey, l_suppkey) — file order
======================  ==============================================

Only the dimensions a query needs are joined: every join of the fact table
is a shuffle at scale (part, customer and supplier grow with the data, so
none is hinted as broadcast; AQE turns a join into a broadcast only when
the runtime size is under ``autoBroadcastJoinThreshold``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpoint.session import by_shuffle
from tillpoint.sources.tables import table

# Parameters of the stand-in queries (fixed once, not tuned to results).
REPORT_START = "1996-01-01"
PERIOD_1 = ("1996-01-01", "1997-01-01")
PERIOD_2 = ("1997-01-01", "1998-01-01")

LINE_COLS = ["sale_id", "invoice_datetime", "salesperson", "customer_name",
             "payment_type", "pos_item_id", "item_name", "category", "quantity",
             "unit_price", "subtotal", "line_total", "invoice_total"]


def payment_text(priority, totalprice, custkey):
    """Payment text of an order: ``<channel>: N<total>`` with one channel for
    each order priority plus, for every fifth customer, a change line
    ``Cash: --N<custkey>``."""
    channel = priority
    for p, name in (("1-URGENT", "Access Bank"), ("2-HIGH", "Moniepoint"), ("3-MEDIUM", "Stanbic IBTC"),
                    ("4-NOT SPECIFIED", "Store Account"), ("5-LOW", "Trade By Barter")):
        channel = F.when(priority == p, name).otherwise(channel)
    main = F.concat(channel, F.lit(": N"), totalprice.cast("decimal(18,2)").cast("string"))
    change = F.when(custkey % 5 == 0, F.concat(F.lit(" Cash: --N"), custkey.cast("string"))) \
        .otherwise(F.lit(""))
    return F.concat(main, change)


def misspelt(name):
    """A name as typed in haste: without its second letter."""
    return F.concat(F.substring(name, 1, 1), F.substr(name, F.lit(3)))


def driver_lines(spark: SparkSession, sf_dir: str, need=("category", "customer",
                 "salesperson")) -> DataFrame:
    need = set(need)
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    if "customer" in need:    # orders meet their customers before their lines do: no line is dealt out by customer
        c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
        o = o.join(c, o.o_custkey == c.c_custkey)
    # the joined rows are several times as wide as the shuffled ones, and distinct
    # sales are counted behind the join without another shuffle: a task holds the
    # groups of its whole partition, so small partitions are not merged by their bytes
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = li.repartition(parts, "l_orderkey").join(o, li.l_orderkey == o.o_orderkey)
    cols = [
        F.col("l_orderkey").alias("sale_id"),
        F.col("o_orderdate").alias("invoice_datetime"),
        payment_text(F.col("o_orderpriority"), F.col("o_totalprice"), F.col("o_custkey"))
        .alias("payment_type"),
        F.col("o_orderpriority").alias("channel"),
        F.col("l_partkey").alias("pos_item_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        F.col("l_extendedprice").alias("subtotal"),
        F.col("l_extendedprice").alias("line_total"),
        F.col("o_totalprice").alias("invoice_total"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("_row_no"),
        F.col("o_custkey").alias("pos_customer_id"),
    ]
    if need & {"category", "item_name"}:
        p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
        df = df.join(p, df.l_partkey == p.p_partkey)
        cols += [F.col("p_name").alias("item_name"), F.col("p_type").alias("category")]
    if "customer" in need:
        cols.append(F.col("c_name").alias("customer_name"))
    if "salesperson" in need:
        s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
        df = df.join(s, df.l_suppkey == s.s_suppkey)
        cols.append(F.col("s_name").alias("salesperson"))
    return df.select(*cols)


def driver_event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as hourly sales lines: transaction = user, revenue = value."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("sale_id"), F.col("ts").alias("invoice_datetime"),
        F.col("value").alias("subtotal"), F.col("value").alias("line_total"),
        F.lit(1.0).alias("quantity"))


def driver_sale_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One header row per order (sale): id, date, payment text, total."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("sale_id"), F.col("o_orderdate").alias("invoice_datetime"),
        payment_text(F.col("o_orderpriority"), F.col("o_totalprice"), F.col("o_custkey"))
        .alias("payment_type"),
        F.col("o_totalprice").alias("invoice_total"), F.col("o_custkey").alias("pos_customer_id"))


def driver_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw sales-detail sheet (all text, as a workbook or CSV export holds
    it) derived from the driver tables, one row per ``lineitem`` row.

    The text carries the shapes real exports have, each tied to a data
    attribute so it scales with the tables: ``S<id>`` ids with `` Edit`` on
    first lines, ``MM/dd/yyyy-hh:mm a`` dates (a placeholder text on pending
    low-priority orders), salespeople padded with spaces (blank when the
    supplier balance is negative), walk-in customers named ``INDOOR``
    (building segment), names without their second letter (machinery segment
    with a negative balance), ``Discount`` lines (10 % discount), returns as
    negative quantities (flag R), a non-numeric quantity (part size 2), a
    blank item id (part size 1), ``N``/``₦`` money text.
    """
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    # every one of them grows with the shop: their compressed files would pass for small
    # tables and be gathered on the driver.  Orders meet their customers before their lines
    # do, so that no line is dealt out by customer
    sales = o.join(by_shuffle(c), o.o_custkey == c.c_custkey)
    df = li.join(by_shuffle(p), li.l_partkey == p.p_partkey) \
        .join(by_shuffle(s), li.l_suppkey == s.s_suppkey) \
        .join(by_shuffle(sales), li.l_orderkey == sales.o_orderkey)
    dec = lambda x: F.col(x).cast("decimal(18,2)").cast("string")
    qty = F.col("l_quantity").cast("bigint").cast("string")
    stamp = F.timestamp_add("HOUR", (F.col("l_orderkey") % 12) + 8, F.col("o_orderdate"))
    return df.select(
        F.concat(F.lit("S"), F.col("l_orderkey").cast("string"),
                 F.when(F.col("l_linenumber") == 1, F.lit(" Edit")).otherwise(F.lit("")))
        .alias("sale_id"),
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"),
               F.lit("pending")).otherwise(F.date_format(stamp, "MM/dd/yyyy-hh:mm a"))
        .alias("invoice_datetime"),
        F.when(F.col("s_acctbal") < 0, F.lit("  "))
        .otherwise(F.concat(F.lit(" "), F.col("s_name"), F.lit("  "))).alias("salesperson"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("INDOOR"))
        .when((F.col("c_mktsegment") == "MACHINERY") & (F.col("c_acctbal") < 0), misspelt(F.col("c_name")))
        .otherwise(F.col("c_name")).alias("customer_name"),
        payment_text(F.col("o_orderpriority"), F.col("o_totalprice"), F.col("o_custkey"))
        .alias("payment_type"),
        F.col("o_orderstatus").alias("comment"),
        F.col("o_custkey").cast("string").alias("pos_customer_id"),
        F.when(F.col("p_size") == 1, F.lit("")).otherwise(F.col("l_partkey").cast("string"))
        .alias("pos_item_id"),
        F.when(F.col("l_discount") >= 0.095, F.lit("Discount")).otherwise(F.col("p_name"))
        .alias("item_name"),
        F.col("p_type").alias("category"),
        F.when(F.col("p_size") == 2, F.lit("abc"))
        .when(F.col("l_returnflag") == "R", F.concat(F.lit("-"), qty)).otherwise(qty)
        .alias("quantity"),
        F.concat(F.lit("N"), dec("l_extendedprice")).alias("unit_price"),
        F.col("l_extendedprice").alias("subtotal"),
        dec("l_extendedprice").alias("line_total"),
        F.concat(F.lit("₦"), dec("o_totalprice")).alias("invoice_total"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("_row_no"),
    )
