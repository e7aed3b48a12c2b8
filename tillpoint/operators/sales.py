"""Sheet lines -> sales (A20, A21, P11/Q2, F11-F13, N-4).

A sale (invoice) is the group of sheet lines sharing a parsed sale id.
Everything a sale needs is computed in **one** aggregation over the lines:
header fields come from the first line in file order (``min_by`` over
``_row_no``), item checks and item counts are conditional aggregates.  All
of these are partial aggregates, so an invoice with millions of lines is
pre-combined on every mapper and never gathered into one task; the item
rows themselves stay flat (``sale_items``) instead of being nested.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.functions import scalars as S
from tillpoint.session import by_shuffle, settle

HEADER_FIELDS = ["invoice_datetime", "salesperson", "customer_name", "payment_type",
                 "comment", "invoice_total", "pos_customer_id"]

REASONS = ["missing_salesperson", "bad_datetime", "bad_invoice_total", "bad_item_id",
           "bad_item_price", "bad_item_quantity", "bad_item_total", "bad_payment_amount"]


def parsed_lines(sheet: DataFrame) -> DataFrame:
    """Sheet lines with a parsed sale id; lines without one are dropped."""
    return sheet.withColumn("sale_id_raw", F.col("sale_id")) \
        .withColumn("sale_id", S.parse_sale_id("sale_id_raw")) \
        .filter(F.col("sale_id").isNotNull())


def _qty_dec(c):
    return S.coerce_number(c).cast("decimal(18,4)")


def sale_aggregate(lines: DataFrame, strict_item_id: bool = True) -> DataFrame:
    """One row per sale id with raw header fields and item statistics.
    Optional sheet columns that are absent are taken as empty (null)."""
    for f in HEADER_FIELDS + ["item_name", "quantity", "unit_price", "line_total", "pos_item_id"]:
        if f not in lines.columns:
            lines = lines.withColumn(f, F.lit(None).cast("string"))
    hdr = F.min_by(F.struct(*HEADER_FIELDS), F.col("_row_no")).alias("h")
    q = _qty_dec("quantity")
    real = ~S.is_discount("item_name")
    aggs = [
        hdr,
        F.count(F.lit(1)).alias("n_lines"),
        F.coalesce(F.sum(F.when(real & (q > 0), q)), F.lit(0)).alias("_sold"),
        F.coalesce(F.sum(F.when(real & (q < 0), q)), F.lit(0)).alias("_returned"),
        F.count_if(S.parse_int("quantity").isNull()).alias("n_bad_qty"),
        F.count_if(S.parse_money("unit_price").isNull()).alias("n_bad_price"),
        F.count_if(S.parse_money("line_total").isNull()).alias("n_bad_total"),
    ]
    bad_id = S.parse_int("pos_item_id").isNull()
    if not strict_item_id:
        bad_id = bad_id & real
    aggs.append(F.count_if(bad_id).alias("n_bad_item_id"))
    g = lines.groupBy("sale_id").agg(*aggs)
    return g.select("sale_id", "h.*", "n_lines", "n_bad_qty", "n_bad_price", "n_bad_total",
                    "n_bad_item_id",
                    F.col("_sold").cast("bigint").alias("items_sold"),
                    F.abs(F.col("_returned")).cast("bigint").alias("items_returned"),
                    (F.col("_sold") + F.col("_returned")).cast("double").alias("qty_exact"))


def build_sales(lines: DataFrame) -> DataFrame:
    """Invoice header per sale with parsed payments and counts."""
    a = sale_aggregate(lines)
    cust = S.clean_text("customer_name")
    pays = S.parse_payments("payment_type")
    return a.select(
        "sale_id", S.clean_text("invoice_datetime").alias("invoice_datetime_raw"),
        S.clean_text("salesperson").alias("salesperson"), cust.alias("customer_name"),
        S.is_anonymous(cust).alias("is_anonymous_customer"),
        F.nullif(F.trim("invoice_total"), F.lit("")).alias("invoice_total_raw"),
        S.clean_text("comment").alias("comment"), "n_lines", "items_sold", "items_returned",
        F.size(pays).alias("n_payments"), S.change_due(pays).alias("change_due"))


def invoice_counts(lines: DataFrame) -> DataFrame:
    """Items sold / returned (each sum truncated), net, exact sum."""
    a = sale_aggregate(lines)
    return a.select("sale_id", "items_sold", "items_returned",
                    (F.col("items_sold") - F.col("items_returned")).alias("items_net"),
                    "qty_exact")


def sale_payments(sales: DataFrame, text="payment_type") -> DataFrame:
    """one row per parsed payment of a sale, in text order."""
    return sales.select("sale_id", F.posexplode(S.parse_payments(text)).alias("pos", "p")) \
        .select("sale_id", "pos", F.col("p.channel").alias("channel"),
                F.col("p.amount").alias("amount"))


def validate_sales(lines: DataFrame, strict_item_id: bool = True) -> DataFrame:
    """Typed sales plus ``reasons`` (empty when accepted).

    The run goes on for every sale; ``accepted`` splits the typed sales from
    the quarantine.  Checks: salesperson present, date parses (record
    formats), invoice total parses, every item's id / price / quantity /
    total parses, every payment amount parses.
    """
    a = sale_aggregate(lines, strict_item_id)
    # stages: a parse that several results use is a column of its own, and the
    # error list is one column behind both ``accepted`` and ``reasons``
    a = (a.withColumn("_pays", S.parse_payments("payment_type"))
         .withColumn("_dt", S.parse_datetime_multi("invoice_datetime"))
         .withColumn("_total", S.parse_money("invoice_total"))
         .withColumn("_person", S.clean_text("salesperson")))
    pays, dt, total = F.col("_pays"), F.col("_dt"), F.col("_total")
    bad_pay = F.exists(pays, lambda p: S.parse_money(p["amount"]).isNull())
    checks = [
        F.col("_person").isNull(), dt.isNull(), total.isNull(),
        F.col("n_bad_item_id") > 0, F.col("n_bad_price") > 0, F.col("n_bad_qty") > 0,
        F.col("n_bad_total") > 0, bad_pay,
    ]
    a = a.withColumn("_errs", F.filter(F.array(*[F.when(c, F.lit(r)) for c, r in zip(checks, REASONS)]),
                                       lambda x: x.isNotNull()))
    errs = F.col("_errs")
    cust = S.clean_text("customer_name")
    return a.select(
        "sale_id", dt.alias("invoice_datetime"),
        F.col("_person").alias("salesperson"),
        S.default_customer_name("customer_name").alias("customer_name"),
        S.is_anonymous(cust).alias("is_anonymous_customer"),
        total.alias("invoice_total"),
        S.parse_money(S.change_due(pays)).alias("change_due"),
        "items_sold", "items_returned",
        (F.col("items_sold") - F.col("items_returned")).alias("items_net"),
        S.clean_text("comment").alias("comment"),
        F.col("pos_customer_id"), pays.alias("payments"),
        (F.size(errs) == 0).alias("accepted"), F.concat_ws(",", errs).alias("reasons"))


def typed_items(lines: DataFrame) -> DataFrame:
    """N-2: typed item rows (flat; children of a sale)."""
    return lines.select(
        "sale_id", S.parse_int("pos_item_id").alias("pos_item_id"),
        S.clean_text("item_name").alias("name"), S.parse_int("quantity").alias("quantity"),
        S.parse_money("unit_price").alias("unit_price"),
        S.parse_money("line_total").alias("total"), "_row_no")


def db_row(sales: DataFrame) -> DataFrame:
    """N-4/F10: accepted sales as ``sales`` table rows (money as double,
    datetime as ISO text)."""
    return sales.filter("accepted").select(
        F.col("sale_id").alias("pos_sale_id"),
        F.col("invoice_total").cast("double").alias("invoice_total"),
        "pos_customer_id", "customer_name", "salesperson",
        S.iso_text("invoice_datetime").alias("invoice_datetime"), "comment",
        "is_anonymous_customer", "items_net", "items_sold", "items_returned")


def sale_lookup(sales: DataFrame, sale_id: int) -> DataFrame:
    """Point lookup of one sale by id."""
    return sales.filter(F.col("sale_id") == F.lit(sale_id))


ITEM_FIELDS = ["pos_item_id", "item_name", "quantity", "unit_price", "line_total"]


def number_lines(lines: DataFrame, span=None, key: str = "sale_id", order: str = "_row_no",
                 out: str = "_line") -> DataFrame:
    """Adds the running number (from 0) of each line within its sale, in order
    of ``order``, without gathering a sale: lines are counted by (sale, span
    of the input), the counts of the spans before give an offset, and only the
    lines of one span are numbered one after the other.  ``span`` must grow with
    ``order`` and bound its rows; by default 100,000 consecutive row numbers."""
    span = F.floor(F.col(order) / 100_000) if span is None else span
    lines = lines.withColumn("_span", span.cast("bigint"))
    counts = lines.groupBy(key, "_span").agg(F.count(F.lit(1)).alias("_c"))
    spans = Window.partitionBy(key).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col(key).alias("_k"), F.col("_span").alias("_s"),
                           F.coalesce(F.sum("_c").over(spans), F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy(key, "_span").orderBy(order))
    numbered = lines.withColumn("_local", local)
    return numbered.join(by_shuffle(before), (numbered[key] == before["_k"]) & (numbered["_span"] == before["_s"])) \
        .withColumn(out, (F.col("_before") + F.col("_local") - 1).cast("bigint")) \
        .drop("_span", "_local", "_k", "_s", "_before")


def nest_items(lines: DataFrame, span=None, chunk_size: int = 200, fields: list[str] | None = None,
               name: str = "lines_to_nest") -> DataFrame:
    """N-1: the items of each sale nested in file order, as a message body.

    A sale's lines are numbered and split into chunks of ``chunk_size``, so no
    nested array, and no task building one, grows with the size of an invoice;
    a consumer reassembles a sale from its chunks by key.  Numbering reads the
    lines twice, so what is needed of them is written once (as ``name``)."""
    fields = fields or ITEM_FIELDS
    span = F.floor(F.col("_row_no") / 100_000) if span is None else span
    lines = settle(lines.select("sale_id", "_row_no", span.cast("bigint").alias("_at"), *fields), name)
    numbered = number_lines(lines, F.col("_at"))
    entry = F.struct(F.col("_line").alias("_o"), *[F.col(c) for c in fields])
    g = numbered.groupBy("sale_id", F.floor(F.col("_line") / chunk_size).cast("bigint").alias("chunk")).agg(
        F.array_sort(F.collect_list(entry)).alias("_items"))
    items = F.transform("_items", lambda x: F.struct(*[x[c].alias(c) for c in fields]))
    return g.select("sale_id", "chunk", items.alias("items"))
