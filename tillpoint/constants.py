"""Fixed values.

These must equal the source system's values for results to agree, so they
are written out plainly and in their natural order.  Nothing else in the
package hard-codes a business constant.
"""

# ---------------------------------------------------------------- fixed values
# Weekday order used to complete weekday rollups.
DAY_ORDER = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Price bands on "Selling Price": right-closed bins.  Open-top variant (last
# edge infinity) and capped variant (last edge 500,000).
PRICE_EDGES_OPEN = [0, 5000, 10000, 20000, 30000, 50000, 100000, float("inf")]
PRICE_EDGES_CAPPED = [0, 5000, 10000, 20000, 30000, 50000, 100000, 500000]
PRICE_LABELS = ["<5k", "5-10k", "10-20k", "20-30k", "30-50k", "50-100k", ">100k"]

# Four time-of-day buckets: hour < 11, < 13, < 18, else.
HOUR_BUCKET_EDGES = [11, 13, 18]
HOUR_BUCKET_LABELS = ["Morning(<11)", "Midday(11-1)", "Afternoon(1-6)", "Evening(6-9)"]

# Six right-closed hour bins (0,6] (6,11] (11,13] (13,18] (18,21] (21,24].
HOUR_SIX_EDGES = [0, 6, 11, 13, 18, 21, 24]
HOUR_SIX_LABELS = ["Night(0-6)", "Morning(7-11)", "Midday(11-1)", "Afternoon(1-6)",
                   "Evening(6-9)", "Late(9+)"]

# Sheet date format (strptime "%m/%d/%Y-%I:%M %p") and the multi-format list
# tried in order by the record parser, as Spark datetime patterns.
SHEET_DATE_FORMAT = "M/d/yyyy-h:m a"
DATE_FORMATS = [
    "M/d/yyyy-h:m a",        # %m/%d/%Y-%I:%M %p
    "M/d/yyyy h:m a",        # %m/%d/%Y %I:%M %p
    "M/d/yyyy H:m",          # %m/%d/%Y %H:%M
    "yyyy-M-d'T'H:m:s",      # %Y-%m-%dT%H:%M:%S
    "d/M/yyyy H:m:s",        # %d/%m/%Y %H:%M:%S
]
# ISO-like fallbacks standing in for the free-form parser (see README).
ISO_FALLBACK_FORMATS = ["yyyy-M-d H:m:s", "yyyy-M-d H:m", "yyyy-M-d"]

# Sheet header -> internal column name (after lower-casing and replacing
# runs of non [a-z0-9] with "_").  The second "Total" column is "total_1".
HEADER_MAP = {
    "sale_id": "sale_id",
    "date": "invoice_datetime",
    "sold_by": "salesperson",
    "sold_to": "customer_name",
    "items_purchased": "items_sold",
    "payment_type": "payment_type",
    "comments": "comment",
    "item_id": "pos_item_id",
    "name": "item_name",
    "quantity_sold": "quantity",
    "selling_price": "unit_price",
    "total": "line_total",
    "total_1": "invoice_total",
    "person_id": "pos_customer_id",
    "category": "category",
    "subtotal": "subtotal",
}

# Payment text: every "Channel: amount" pair (case-insensitive).
PAYMENT_PATTERN = r"(?iU)([A-Za-z ]+):\s*([+-]?\s*[-]?\s*(?:N|₦)?[\d,]+(?:\.\d{1,2})?)"

# Customer-name markers of walk-in / online (anonymous) customers.
ANONYMOUS_MARKERS = ["indoor", "online", "online customers"]
DEFAULT_CUSTOMER_NAME = "Unknown Customer"
DEFAULT_CUSTOMER_ID = 23

# Settlement accounts payments are matched against, and the store-account
# reroute target.
ACCOUNT_NAMES = ["ACCESS BANK", "STANBIC IBTC BANK", "MONIEPOINT MFB", "CASH PAYMENT"]
STORE_ACCOUNT_MARKER = "STORE ACCOUNT"
STORE_ACCOUNT_TARGET = "STANBIC IBTC BANK"
# Payment channels the receipt pages use.
PAYMENT_CHANNELS = ["MONIEPOINT", "ACCESS BANK", "CASH", "STORE ACCOUNT",
                    "TRADE BY BARTER", "STANBIC IBTC"]

# Fuzzy name match cutoff (0-100, inclusive).
FUZZY_CUTOFF = 90.0

# Daily revenue against the period average: above 0 -> up, below -0.2 -> down.
VS_AVG_UP = 0.0
VS_AVG_DOWN = -0.2

# Post-to-sale conversion: sold within this many days counts as quick.
QUICK_SALE_DAYS = 3

# Page checks.
MIN_PAGE_CHARS = 100

# Monitoring: component error-rate alert above 10 %, heartbeat life 60 s,
# de-duplication life 24 h, rolling failure window 10 s with a minimum of 10
# calls and a 50 % failure-rate trip, and 5 failures as the count trip.
ERROR_RATE_ALERT = 0.10
HEARTBEAT_TTL_SECONDS = 60
DEDUP_TTL = "24 hours"
ROLLING_WINDOW_SECONDS = 10
ROLLING_MIN_CALLS = 10
ROLLING_FAILURE_RATE = 0.5
ROLLING_FAILURE_COUNT = 5

# Micro-batch ingest: flush every 5 s or 200 records; refresh loop 250 s.
FLUSH_SECONDS = 5

# Payment-channel risk classes.
PAYMENT_RISK = [
    ("STORE ACCOUNT", "HIGH"),
    ("ACCESS BANK", "LOW"),
    ("MONIEPOINT", "LOW"),
    ("CASH", "MEDIUM"),
]

# Decision rules over (unit price, days since posted, days unsold):
# (rule, min price exclusive, max price inclusive, min days unsold)
DECISION_RULES = [
    ("slow_mover", 50000, None, 8),      # > 50k and more than 7 days unsold
    ("repost", None, None, 5),           # unsold 5+ days
    ("discount", 30000, 50000, 4),       # 30-50k and unsold 4+ days
]
# ---------------------------------------------------------------- end fixed values
