"""Data-quality and monitoring operators.

All are keyed aggregations or keyed windows; none moves all rows to one
task.  The rolling failure window is computed per (component, time chunk)
with the window's reach copied across chunk edges, so a component that
produces a third of all events is still spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillpoint import constants as K
from tillpoint.functions import scalars as S

# <li> texts stand in for table-head cells on pages without tables.
# (tag name followed by whitespace or ">", so <link>, <thead>, <article> do not match)
LI_TEXT = r"<li(?:\s[^>]*)?>\s*(?:<a(?:\s[^>]*)?>)?([^<]*)"
TH_TEXT = r"<th(?:\s[^>]*)?>([^<]*)"


def page_quality(pages: DataFrame, html="html") -> DataFrame:
    """Short page, not HTML, past-the-last-page (no ``<tr`` or a
    "no records" text), plus the page fingerprint."""
    h = F.col(html)
    return pages.select(
        "page_id", F.length(h).alias("n_chars"),
        (F.length(h) < K.MIN_PAGE_CHARS).alias("is_short"),
        (~h.rlike(r"^\s*<!DOCTYPE") & ~F.lower(h).contains("<html")).alias("not_html"),
        (~h.contains("<tr") | F.lower(h).contains("no records")).alias("is_empty"),
        S.fingerprint_page(h).alias("fingerprint"))


def schema_drift(pages: DataFrame, pattern: str = LI_TEXT, order="page_id") -> DataFrame:
    """Q1: the first page (in ``order``) with headers sets the baseline
    fingerprint; every later page whose fingerprint differs is flagged.
    Pages without headers are ignored.  The baseline is a scalar subquery
    (a partial ``min_by``), not a window over all pages."""
    fp = pages.select(order, S.header_fingerprint("html", pattern).alias("fingerprint")) \
        .filter(F.col("fingerprint").isNotNull())
    baseline = fp.select(F.min_by("fingerprint", order)).scalar()
    return fp.select(order, "fingerprint", F.lit(baseline).alias("baseline"),
                     (F.col("fingerprint") != F.lit(baseline)).alias("drift"))


def error_rate(reports: DataFrame, component="component", failed="is_error") -> DataFrame:
    """Processed, errors and error rate per component; alert > 10 %."""
    g = reports.groupBy(component).agg(F.count(F.lit(1)).alias("processed"),
                                       F.count_if(F.col(failed)).alias("errors"))
    rate = S.safe_div("errors", "processed")
    return g.select(component, "processed", "errors", rate.alias("error_rate"),
                    (rate > K.ERROR_RATE_ALERT).alias("alert"))


def rolling_failure(events: DataFrame, component="component", ts="ts", failed="is_error",
                    window_s: int = K.ROLLING_WINDOW_SECONDS, chunk_s: int = 3600) -> DataFrame:
    """At every failure, calls and failures of the same component in
    the preceding ``window_s`` seconds (lower edge exclusive) and whether
    the breaker trips (failures >= 5, or >= 10 calls with a failure rate
    >= 50 %).

    Skew: rows are split into ``chunk_s`` time chunks per component; rows
    within ``window_s`` of the next chunk are copied into it as context
    rows, so each (component, chunk) window partition is complete and
    bounded by the chunk length, not by the component's size.
    """
    span = window_s * 1_000_000
    chunk = chunk_s * 1_000_000
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    base = events.select(F.col(component).alias("component"), F.col(ts).alias("ts"),
                         F.col(failed).alias("is_error"), us.alias("_us"))
    c = F.floor(F.col("_us") / chunk)
    own = base.withColumn("_chunk", c).withColumn("_ctx", F.lit(False))
    # rows close to the end of their chunk also serve as history of the next
    ctx = base.filter(F.col("_us") >= (c + 1) * chunk - span) \
        .withColumn("_chunk", c + 1).withColumn("_ctx", F.lit(True))
    u = own.unionByName(ctx)
    w = Window.partitionBy("component", "_chunk").orderBy("_us").rangeBetween(-(span - 1), 0)
    r = u.withColumn("calls", F.count(F.lit(1)).over(w)) \
        .withColumn("failures", F.count_if(F.col("is_error")).over(w)) \
        .filter(~F.col("_ctx") & F.col("is_error"))
    rate = S.safe_div("failures", "calls")
    trip = (F.col("failures") >= K.ROLLING_FAILURE_COUNT) | \
        ((F.col("calls") >= K.ROLLING_MIN_CALLS) & (rate >= K.ROLLING_FAILURE_RATE))
    return r.select("component", "ts", "calls", "failures", rate.alias("failure_rate"),
                    trip.alias("trip"))


def stale_nodes(heartbeats: DataFrame, as_of=None, node="node_id", ts="ts",
                ttl_s: int = K.HEARTBEAT_TTL_SECONDS) -> DataFrame:
    """X4 (batch): last heartbeat per node and whether it is older than the
    TTL at ``as_of`` (default: the newest heartbeat seen)."""
    g = heartbeats.groupBy(node).agg(F.max(ts).alias("last_seen"))
    if as_of is None:
        as_of = heartbeats.select(F.max(ts)).scalar()
    silent = F.unix_micros(F.lit(as_of).cast("timestamp")) - \
        F.unix_micros(F.col("last_seen").cast("timestamp"))
    secs = (silent / 1_000_000).cast("double")
    return g.select(node, "last_seen", secs.alias("silent_seconds"), (secs > ttl_s).alias("stale"))


def windowed_errors(events: DataFrame, ts="ts", failed="is_error",
                    width: str = "1 minute") -> DataFrame:
    """X5 (batch twin): calls, failures and failure rate per tumbling window."""
    g = events.groupBy(F.window(ts, width).alias("w")).agg(
        F.count(F.lit(1)).alias("calls"), F.count_if(F.col(failed)).alias("failures"))
    return g.select(F.col("w.start").alias("window_start"), "calls", "failures",
                    S.safe_div("failures", "calls").alias("failure_rate"))
