"""DuckDB SQL fragments shared by the oracle queries.

The oracle side restates each query in plain SQL over the same parquet
views; these helpers keep the money / ratio conventions identical to the
Spark side (decimal sums, zero-guarded double division).
"""

from __future__ import annotations

from tillpoint.plans import standin as SI


def money(x: str) -> str:
    return f"COALESCE(CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE), 0.0)"


def qty(x: str) -> str:
    return f"COALESCE(CAST(SUM(CAST({x} AS DECIMAL(18,4))) AS DOUBLE), 0.0)"


def div(a: str, b: str) -> str:
    return (f"(CASE WHEN ({b}) IS NULL OR CAST({b} AS DOUBLE) = 0 THEN 0.0 "
            f"ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END)")


PAYMENT_TEXT = ("CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Access Bank' WHEN '2-HIGH' THEN 'Moniepoint'"
                " WHEN '3-MEDIUM' THEN 'Stanbic IBTC' WHEN '4-NOT SPECIFIED' THEN 'Store Account'"
                " WHEN '5-LOW' THEN 'Trade By Barter' ELSE o.o_orderpriority END"
                " || ': N' || CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"
                " || CASE WHEN o.o_custkey % 5 = 0 THEN ' Cash: --N' || CAST(o.o_custkey AS VARCHAR)"
                " ELSE '' END")

LINES = f"""lines AS (
  SELECT l.l_orderkey AS sale_id, o.o_orderdate AS invoice_datetime,
         s.s_name AS salesperson, c.c_name AS customer_name,
         {PAYMENT_TEXT} AS payment_type, o.o_orderpriority AS channel,
         l.l_partkey AS pos_item_id, p.p_name AS item_name, p.p_type AS category,
         l.l_quantity AS quantity, l.l_extendedprice AS unit_price,
         l.l_extendedprice AS subtotal, l.l_extendedprice AS line_total,
         o.o_totalprice AS invoice_total, o.o_custkey AS pos_customer_id,
         l.l_linenumber, l.l_suppkey
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
)"""

CLEAN = f"""clean AS (
  SELECT * FROM lines WHERE quantity > 0 AND item_name IS DISTINCT FROM 'Discount'
    AND invoice_datetime >= TIMESTAMP '{SI.REPORT_START}'
)"""

EVENT_LINES = """elines AS (
  SELECT user_id AS sale_id, ts AS invoice_datetime, value AS subtotal,
         value AS line_total, 1.0 AS quantity FROM events
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SHEET = f"""sheet AS (
  SELECT 'S' || CAST(l.l_orderkey AS VARCHAR) || CASE WHEN l.l_linenumber = 1 THEN ' Edit' ELSE '' END AS sale_id,
    CASE WHEN o.o_orderstatus = 'P' AND o.o_orderpriority = '5-LOW' THEN 'pending'
         ELSE strftime(o.o_orderdate + to_hours(CAST(l.l_orderkey % 12 + 8 AS BIGINT)), '%m/%d/%Y-%I:%M %p') END AS invoice_datetime,
    CASE WHEN s.s_acctbal < 0 THEN '  ' ELSE ' ' || s.s_name || '  ' END AS salesperson,
    CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'INDOOR'
         WHEN c.c_mktsegment = 'MACHINERY' AND c.c_acctbal < 0 THEN substr(c.c_name, 1, 1) || substr(c.c_name, 3)
         ELSE c.c_name END AS customer_name,
    {PAYMENT_TEXT} AS payment_type, o.o_orderstatus AS comment,
    CAST(o.o_custkey AS VARCHAR) AS pos_customer_id,
    CASE WHEN p.p_size = 1 THEN '' ELSE CAST(l.l_partkey AS VARCHAR) END AS pos_item_id,
    CASE WHEN l.l_discount >= 0.095 THEN 'Discount' ELSE p.p_name END AS item_name,
    p.p_type AS category,
    CASE WHEN p.p_size = 2 THEN 'abc'
         WHEN l.l_returnflag = 'R' THEN '-' || CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR)
         ELSE CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR) END AS quantity,
    'N' || CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS unit_price,
    l.l_extendedprice AS subtotal,
    CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS line_total,
    '₦' || CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS invoice_total,
    l.l_linenumber, l.l_partkey, l.l_suppkey
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
)"""

NUM_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def clean_text(x: str) -> str:
    return f"NULLIF(trim(regexp_replace({x}, '\\s+', ' ', 'g')), '')"


def utrim(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def parse_int(x: str) -> str:
    t = utrim(x)
    return (f"(CASE WHEN regexp_full_match({t}, '{NUM_RE}') "
            f"THEN CAST(TRUNC(TRY_CAST({t} AS DOUBLE)) AS BIGINT) END)")


def coerce(x: str) -> str:
    t = utrim(x)
    return (f"COALESCE(CASE WHEN regexp_full_match({t}, '{NUM_RE}') "
            f"THEN TRY_CAST({t} AS DOUBLE) END, 0.0)")


def parse_money(x: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_replace({x}, '[₦,N\\s]', '', 'g'), '') AS DECIMAL(18,4))"


def parse_sale_id(x: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract({x}, '\\d+', 0), '') AS BIGINT)"


DATE_FMTS = ["%m/%d/%Y-%I:%M %p", "%m/%d/%Y %I:%M %p", "%m/%d/%Y %H:%M", "%Y-%m-%dT%H:%M:%S",
             "%d/%m/%Y %H:%M:%S", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%d"]


def parse_dt_multi(x: str) -> str:
    return "COALESCE(" + ", ".join(f"try_strptime({utrim(x)}, '{f}')" for f in DATE_FMTS) + ")"


PAY_RE = r"(?i)([A-Za-z ]+):\s*([+-]?\s*[-]?\s*(?:N|₦)?[\d,]+(?:\.\d{1,2})?)"


def payments(x: str) -> str:
    """list<struct(channel, amount)> of a payment text."""
    t = clean_text(x)
    ch = f"regexp_extract_all({t}, '{PAY_RE}', 1)"
    am = f"regexp_extract_all({t}, '{PAY_RE}', 2)"
    return (f"CASE WHEN {t} IS NULL THEN [] ELSE list_filter(list_transform(range(1, len({ch}) + 1), "
            f"lambda i: {{'channel': upper(trim(regexp_replace({ch}[i], '\\s+', ' ', 'g'))), "
            f"'amount': regexp_replace(translate({am}[i], ' N₦', ''), '^--', '-')}}), "
            f"lambda p: p.channel <> '') END")


def change_due(pays: str) -> str:
    return (f"COALESCE(regexp_replace(list_filter({pays}, lambda p: starts_with(p.amount, '-'))[1].amount, "
            f"'^-+', ''), '0')")


def is_anon(x: str) -> str:
    return (f"COALESCE(contains(lower({x}), 'indoor') OR contains(lower({x}), 'online') "
            f"OR contains(lower({x}), 'online customers'), false)")


def is_disc(x: str) -> str:
    return f"COALESCE(contains(lower({x}), 'discount'), false)"


PLINES = f"""plines AS (
  SELECT * REPLACE ({parse_sale_id('sale_id')} AS sale_id), sale_id AS sale_id_raw FROM sheet
  WHERE {parse_sale_id('sale_id')} IS NOT NULL)"""

SALE_AGG = f"""first_line AS (
  SELECT * FROM plines QUALIFY row_number() OVER (PARTITION BY sale_id
    ORDER BY l_linenumber, l_partkey, l_suppkey) = 1),
stats AS (
  SELECT sale_id, COUNT(*) AS n_lines,
    COALESCE(SUM(CASE WHEN NOT {is_disc('item_name')} AND q > 0 THEN q END), 0) AS _sold,
    COALESCE(SUM(CASE WHEN NOT {is_disc('item_name')} AND q < 0 THEN q END), 0) AS _returned,
    COUNT(*) FILTER (WHERE {parse_int('quantity')} IS NULL) AS n_bad_qty,
    COUNT(*) FILTER (WHERE {parse_money('unit_price')} IS NULL) AS n_bad_price,
    COUNT(*) FILTER (WHERE {parse_money('line_total')} IS NULL) AS n_bad_total,
    COUNT(*) FILTER (WHERE {parse_int('pos_item_id')} IS NULL) AS n_bad_item_id
  FROM (SELECT *, CAST({coerce('quantity')} AS DECIMAL(18,4)) AS q FROM plines) x GROUP BY sale_id),
sagg AS (
  SELECT f.sale_id, f.invoice_datetime, f.salesperson, f.customer_name, f.payment_type,
    f.comment, f.invoice_total, f.pos_customer_id, s.n_lines, s.n_bad_qty, s.n_bad_price,
    s.n_bad_total, s.n_bad_item_id, CAST(TRUNC(s._sold) AS BIGINT) AS items_sold,
    CAST(TRUNC(ABS(s._returned)) AS BIGINT) AS items_returned,
    CAST(s._sold + s._returned AS DOUBLE) AS qty_exact
  FROM first_line f JOIN stats s USING (sale_id))"""


def stable_shard(x: str, n: int) -> str:
    """md5(text) as a 128-bit number mod n: (hi mod n * 2^64 mod n + lo mod n) mod n."""
    h = f"md5(CAST({x} AS VARCHAR))"
    hi = f"('0x' || substr({h}, 1, 16))::UBIGINT"
    lo = f"('0x' || substr({h}, 17, 16))::UBIGINT"
    return f"CAST((({hi} % {n}) * {(1 << 64) % n} + ({lo} % {n})) % {n} AS BIGINT)"
