"""Seen-sales ledger and run summary.

The ledger holds the fingerprints of sales already loaded.  New sales are
the incoming accepted sales that are not in it (left anti join on the sale
id; the ledger also keeps the SHA-256 fingerprint the source system keys
by).  Only accepted sales enter the ledger, so a corrected record that was
rejected before can still come in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.functions import scalars as S
from tillpoint.session import by_shuffle


def ledger_rows(sales: DataFrame) -> DataFrame:
    return sales.select(F.col("sale_id"), S.fingerprint_sale("sale_id").alias("fingerprint"))


def _scoped(ledger: DataFrame, scope: str) -> DataFrame:
    """``scope="persisted"`` uses the stored ledger; ``scope="run"`` starts
    from an empty one, as a seen-set that lives only for one run does."""
    if scope == "run":
        return ledger.limit(0)
    if scope != "persisted":
        raise ValueError(f"unknown ledger scope: {scope}")
    return ledger


def new_sales(incoming: DataFrame, ledger: DataFrame, scope: str = "persisted") -> DataFrame:
    """Accepted incoming sales not yet in the ledger, one row per id."""
    acc = incoming.filter("accepted").dropDuplicates(["sale_id"])
    return acc.join(by_shuffle(_scoped(ledger, scope).select("sale_id")), "sale_id", "left_anti")


def tag_outcomes(incoming: DataFrame, ledger: DataFrame, scope: str = "persisted") -> DataFrame:
    """Each incoming sale tagged inserted / duplicate / failed."""
    seen = _scoped(ledger, scope).select("sale_id").distinct().withColumn("_seen", F.lit(True))
    t = incoming.join(by_shuffle(seen), "sale_id", "left")
    return t.withColumn("outcome", F.when(~F.col("accepted"), "failed")
                        .when(F.col("_seen"), "duplicate").otherwise("inserted")).drop("_seen")


def run_summary(tagged: DataFrame) -> DataFrame:
    """Loaded / inserted / duplicates / failed counts in one pass."""
    return tagged.agg(F.count(F.lit(1)).alias("loaded"),
                      F.count_if(F.col("outcome") == "inserted").alias("inserted"),
                      F.count_if(F.col("outcome") == "duplicate").alias("duplicates"),
                      F.count_if(F.col("outcome") == "failed").alias("failed"))
