"""Reference tables (customers, accounts): column-pruned scan, usable rows
only (S3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def read_reference(df: DataFrame, columns: dict[str, str], key: str) -> DataFrame:
    """Select and rename ``columns`` (source -> target) and keep rows whose
    ``key`` (a target name) is non-empty.  The projection reaches the scan,
    so only these columns are read."""
    out = df.select(*[F.col(s).alias(t) for s, t in columns.items()])
    return out.filter(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
