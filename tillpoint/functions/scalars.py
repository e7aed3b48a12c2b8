"""Scalar functions of the sales domain as native Column expressions.

All of these compile into whole-stage codegen; none is a Python UDF.
Parsing uses ``try_*`` forms so that ANSI mode never fails a job on one bad
cell; bad values become null and are counted by validation instead.
Java regexes run with ``(?U)`` where Python's Unicode-aware ``\\s``/``\\d``
semantics are needed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillpoint import constants as K

__all__ = [
    "clean_text", "name_key", "default_customer_name", "parse_money", "parse_int",
    "coerce_number", "parse_sheet_datetime", "parse_datetime_multi", "day_name",
    "iso_text", "parse_payments", "normalise_amount", "change_due", "is_anonymous",
    "is_discount", "store_account_reroute", "stringify_number", "fingerprint_sale",
    "fingerprint_page", "header_fingerprint", "stable_shard", "price_band",
    "price_band_order", "hour_bucket", "hour_bucket_order", "hour_bucket_six",
    "hour_bucket_six_order", "conversion_status", "vs_avg_band", "money_sum",
    "qty_sum", "money_dec", "as_col", "utrim", "parse_sale_id", "safe_div", "payment_risk",
]

NUMBER_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utrim(c) -> Column:
    """Remove leading/trailing whitespace of any kind (Python ``strip()``);
    Spark's ``trim`` removes spaces only."""
    return F.regexp_replace(as_col(c).cast("string"), r"(?U)^\s+|\s+$", "")


# F1 ---------------------------------------------------------------------------
def clean_text(c) -> Column:
    """Collapse any Unicode whitespace run to one space, trim, empty -> null."""
    return F.nullif(F.trim(F.regexp_replace(as_col(c), r"(?U)\s+", " ")), F.lit(""))


# F2 ---------------------------------------------------------------------------
def name_key(c) -> Column:
    """Lookup key of a name: lower case, surrounding whitespace removed."""
    return F.regexp_replace(F.lower(as_col(c)), r"(?U)^\s+|\s+$", "")


# F3 ---------------------------------------------------------------------------
def default_customer_name(c) -> Column:
    return F.coalesce(clean_text(c), F.lit(K.DEFAULT_CUSTOMER_NAME))


# P3 ---------------------------------------------------------------------------
def parse_sale_id(c) -> Column:
    """First run of digits in the text ("S107 Edit" -> 107); null otherwise."""
    digits = F.regexp_extract(as_col(c).cast("string"), r"(?U)\d+", 0)
    return F.nullif(digits, F.lit("")).try_cast("bigint")


# F4 ---------------------------------------------------------------------------
def parse_money(c, scale: int = 4) -> Column:
    """Drop the naira sign, thousands commas, upper-case N and whitespace,
    then read a decimal; unparseable -> null."""
    stripped = F.regexp_replace(as_col(c).cast("string"), r"(?U)[₦,N\s]", "")
    return F.nullif(stripped, F.lit("")).try_cast(f"decimal(18,{scale})")


# F5 ---------------------------------------------------------------------------
def parse_int(c) -> Column:
    """``int(float(text))``: truncate toward zero.  Guarded by a strict number
    pattern because Spark would also accept suffixes such as ``1d``."""
    t = utrim(c)
    return F.when(t.rlike(NUMBER_RE), t.try_cast("double").try_cast("bigint"))


# F6 ---------------------------------------------------------------------------
def coerce_number(c) -> Column:
    """Numeric coercion with bad/blank -> 0.0."""
    t = utrim(c)
    return F.coalesce(F.when(t.rlike(NUMBER_RE), t.try_cast("double")), F.lit(0.0))


# F7 ---------------------------------------------------------------------------
def _ts(c: Column, fmt: str) -> Column:
    return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")


def parse_sheet_datetime(c) -> Column:
    """Strict sheet format; anything else -> null."""
    return _ts(utrim(c), K.SHEET_DATE_FORMAT)


# F8 ---------------------------------------------------------------------------
def parse_datetime_multi(c) -> Column:
    """First of the record formats that fits, then ISO-like fallbacks."""
    t = utrim(c)
    return F.coalesce(*[_ts(t, f) for f in K.DATE_FORMATS + K.ISO_FALLBACK_FORMATS])


# F9 ---------------------------------------------------------------------------
def day_name(c) -> Column:
    return F.date_format(as_col(c), "EEEE")


# F10 --------------------------------------------------------------------------
def iso_text(c) -> Column:
    """ISO text with a ``T`` separator; microseconds only when non-zero."""
    ts = as_col(c)
    frac = F.date_format(ts, "SSSSSS")
    return F.when(frac == "000000", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")) \
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


# F12 --------------------------------------------------------------------------
def normalise_amount(c) -> Column:
    """Drop spaces, upper-case N and the naira sign; leading ``--`` -> ``-``."""
    return F.regexp_replace(F.translate(as_col(c), " N₦", ""), "^--", "-")


# F11 --------------------------------------------------------------------------
def parse_payments(c) -> Column:
    """Every ``Channel: amount`` pair of a payment text, as
    ``array<struct<channel string, amount string>>``; empty text -> [].

    Channel names are whitespace-collapsed, trimmed and upper-cased; pairs
    with an empty channel are dropped.
    """
    text = clean_text(c)
    chans = F.regexp_extract_all(text, F.lit(K.PAYMENT_PATTERN), 1)
    amts = F.regexp_extract_all(text, F.lit(K.PAYMENT_PATTERN), 2)
    pairs = F.transform(
        F.arrays_zip(chans.alias("c"), amts.alias("a")),
        lambda x: F.struct(
            F.upper(F.trim(F.regexp_replace(x["c"], r"(?U)\s+", " "))).alias("channel"),
            normalise_amount(x["a"]).alias("amount")))
    parsed = F.filter(pairs, lambda p: p["channel"] != "")
    return F.when(text.isNull(), F.array().cast(
        "array<struct<channel:string,amount:string>>")).otherwise(parsed)


# F13 --------------------------------------------------------------------------
def change_due(payments) -> Column:
    """Amount of the first negative payment without its minus signs, else "0"."""
    neg = F.filter(as_col(payments), lambda p: p["amount"].startswith("-"))
    return F.coalesce(F.regexp_replace(F.get(neg, 0)["amount"], "^-+", ""), F.lit("0"))


# F14 --------------------------------------------------------------------------
def is_anonymous(c) -> Column:
    low = F.lower(as_col(c))
    hit = None
    for m in K.ANONYMOUS_MARKERS:
        e = low.contains(m)
        hit = e if hit is None else (hit | e)
    return F.coalesce(hit, F.lit(False))


# F15 --------------------------------------------------------------------------
def is_discount(c) -> Column:
    """Item name contains "discount" in any case; null name is not a discount."""
    return F.coalesce(F.lower(as_col(c)).contains("discount"), F.lit(False))


# F16 --------------------------------------------------------------------------
def store_account_reroute(channel, matched) -> Column:
    """Store-account payments settle to a fixed account; others keep the match."""
    return F.when(as_col(channel).contains(K.STORE_ACCOUNT_MARKER),
                  F.lit(K.STORE_ACCOUNT_TARGET)).otherwise(as_col(matched))


# F17 --------------------------------------------------------------------------
def stringify_number(c) -> Column:
    """Number -> text; integral values print without decimals; blank -> null.
    For text input use ``nullif(trim(c), '')`` (text passes through)."""
    x = as_col(c)
    d = x.try_cast("double")
    return F.when(x.isNull(), F.lit(None).cast("string")) \
        .when(d == F.floor(d), d.cast("bigint").cast("string")) \
        .otherwise(x.cast("string"))


# F19 --------------------------------------------------------------------------
def fingerprint_sale(c) -> Column:
    return F.sha2(as_col(c).cast("string"), 256)


def fingerprint_page(c) -> Column:
    return F.md5(as_col(c))


# F20 --------------------------------------------------------------------------
def header_fingerprint(html, pattern: str) -> Column:
    """``|``-joined, lower-cased, trimmed texts of the header cells matched by
    ``pattern`` (group 1); null when the page has none."""
    cells = F.transform(F.regexp_extract_all(as_col(html), F.lit(pattern), 1),
                        lambda x: F.lower(F.trim(x)))
    return F.when(F.size(cells) > 0, F.concat_ws("|", cells))


# F21 --------------------------------------------------------------------------
def stable_shard(c, n: int) -> Column:
    """``int(md5(str(id)), 16) % n`` over the full 128 bits, folded digit by
    digit so every intermediate stays in a long."""
    h = F.md5(as_col(c).cast("string"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(32)), F.lit(0).cast("bigint"),
        lambda acc, i: (acc * 16 + F.conv(F.substring(h, i, 1), 16, 10).cast("bigint")) % n)


# F22 / F23 --------------------------------------------------------------------
def _bins(x: Column, edges, labels, values) -> Column:
    expr = None
    for lo, hi, v in zip(edges[:-1], edges[1:], values):
        cond = (x > lo) if hi == float("inf") else ((x > lo) & (x <= hi))
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    return expr


def price_band(c, capped: bool = False) -> Column:
    edges = K.PRICE_EDGES_CAPPED if capped else K.PRICE_EDGES_OPEN
    return _bins(as_col(c).cast("double"), edges, K.PRICE_LABELS, [F.lit(v) for v in K.PRICE_LABELS])


def price_band_order(c, capped: bool = False) -> Column:
    edges = K.PRICE_EDGES_CAPPED if capped else K.PRICE_EDGES_OPEN
    return _bins(as_col(c).cast("double"), edges, K.PRICE_LABELS,
                 [F.lit(i) for i in range(len(K.PRICE_LABELS))])


# F24 --------------------------------------------------------------------------
def hour_bucket(hour) -> Column:
    h = as_col(hour)
    e, lab = K.HOUR_BUCKET_EDGES, K.HOUR_BUCKET_LABELS
    return F.when(h.isNull(), F.lit(None).cast("string")).when(h < e[0], lab[0]) \
        .when(h < e[1], lab[1]).when(h < e[2], lab[2]).otherwise(lab[3])


def hour_bucket_order(hour) -> Column:
    h = as_col(hour)
    e = K.HOUR_BUCKET_EDGES
    return F.when(h.isNull(), F.lit(None).cast("int")).when(h < e[0], 0) \
        .when(h < e[1], 1).when(h < e[2], 2).otherwise(3)


# F25 --------------------------------------------------------------------------
def hour_bucket_six(hour, include_midnight: bool = False) -> Column:
    """Right-closed six-bin cut; hour 0 falls outside (0,6] and is null unless
    ``include_midnight``."""
    h = as_col(hour)
    edges = list(K.HOUR_SIX_EDGES)
    expr = _bins(h, edges, K.HOUR_SIX_LABELS, [F.lit(v) for v in K.HOUR_SIX_LABELS])
    if include_midnight:
        expr = F.when(h == 0, F.lit(K.HOUR_SIX_LABELS[0])).otherwise(expr)
    return expr


def hour_bucket_six_order(hour, include_midnight: bool = False) -> Column:
    h = as_col(hour)
    expr = _bins(h, K.HOUR_SIX_EDGES, K.HOUR_SIX_LABELS,
                 [F.lit(i) for i in range(len(K.HOUR_SIX_LABELS))])
    if include_midnight:
        expr = F.when(h == 0, F.lit(0)).otherwise(expr)
    return expr


# F30 --------------------------------------------------------------------------
def conversion_status(sold_within, first_sale_date) -> Column:
    return F.when(F.coalesce(as_col(sold_within), F.lit(False)), F.lit("YES")) \
        .when(as_col(first_sale_date).isNotNull(), F.lit("Delayed")) \
        .otherwise(F.lit("No Sale"))


# F31 --------------------------------------------------------------------------
def vs_avg_band(ratio) -> Column:
    r = as_col(ratio)
    return F.when(r > K.VS_AVG_UP, "up").when(r < K.VS_AVG_DOWN, "down").otherwise("flat")


# A18 risk class ---------------------------------------------------------------
def payment_risk(channel) -> Column:
    ch = F.upper(as_col(channel))
    expr = None
    for marker, risk in K.PAYMENT_RISK:
        expr = F.when(ch.contains(marker), risk) if expr is None else expr.when(ch.contains(marker), risk)
    return expr.otherwise(F.lit("UNKNOWN"))


# measures ---------------------------------------------------------------------
def money_sum(c) -> Column:
    """Exact money total: decimal sum (order independent), double at the edge;
    an all-null group sums to 0."""
    return F.coalesce(F.sum(as_col(c).cast("decimal(18,2)")).cast("double"), F.lit(0.0))


def money_dec(c) -> Column:
    """Decimal money total (kept exact for later sums of group totals)."""
    return F.coalesce(F.sum(as_col(c).cast("decimal(18,2)")), F.lit(0).cast("decimal(18,2)"))


def qty_sum(c) -> Column:
    return F.coalesce(F.sum(as_col(c).cast("decimal(18,4)")).cast("double"), F.lit(0.0))


def safe_div(a, b) -> Column:
    """a / b as double, 0 when the divisor is 0 or null."""
    b = as_col(b).cast("double")
    return F.when(b.isNull() | (b == 0), F.lit(0.0)).otherwise(as_col(a).cast("double") / b)
