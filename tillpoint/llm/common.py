"""Helpers of the operators: Arrow batches as bytes, row keys, size checks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpoint.session import materialize, scratch, ship_package  # noqa: F401  (for the operators)

#: ids from here on stand for a null document id (with bits of the text's
#: hash, so that such rows stay apart); they sort after every real id
NULL_ID = 1 << 62


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once: a lambda variable over a
    one-element array, which the optimizer does not inline."""
    return F.transform(F.array(value), body)[0]


def prepare(spark: SparkSession) -> None:
    """Ship the package, and bound an Arrow batch to 2,000 rows or 16 MB where
    the session has Spark's defaults: a worker holds a few copies of one."""
    ship_package(spark)
    for key, default, value in (("maxRecordsPerBatch", "10000", "2000"),
                                ("maxBytesPerBatch", "67108864b", "16777216b")):
        name = f"spark.sql.execution.arrow.{key}"
        if spark.conf.get(name) == default:
            spark.conf.set(name, value)


def row_id(id_col: str, text_col: str) -> Column:
    null_id = F.lit(NULL_ID) + F.xxhash64(F.col(text_col)).bitwiseAND(F.lit(NULL_ID - 1))
    return F.coalesce(F.col(id_col).cast("long"), null_id)


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                mask: int = -1) -> DataFrame:
    """(_d, _h, _t): document id (null: above all ids), hash of the text
    (its bits in ``mask``), text.  Rows that agree in id and text are one
    document."""
    prepare(docs.sparkSession)
    t = F.col(text_col)
    return docs.select(row_id(id_col, text_col).alias("_d"),
                       F.xxhash64(t).bitwiseAND(F.lit(mask)).alias("_h"), t.alias("_t"))


def real_id(col: str = "_d") -> Column:
    return F.when(F.col(col) < NULL_ID, F.col(col))


def blobs(batch: pa.RecordBatch, name: str = "_t") -> list[bytes]:
    """The UTF-8 bytes of a string column; null gives no bytes."""
    return [x or b"" for x in batch.column(name).cast(pa.large_binary()).to_pylist()]


def batches(rows: dict[str, tuple[object, pa.DataType]], size: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Record batches of at most ``size`` rows from {name: (values, type)}."""
    t = pa.table({k: pa.array(v, type=kind) for k, (v, kind) in rows.items()})
    yield from t.to_batches(max_chunksize=size)


def small_enough(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows: the size check that comes
    before a broadcast."""
    return df.limit(rows + 1).count() <= rows


def only_ids(texts: DataFrame, ids: DataFrame, limit: int = 1_000_000) -> DataFrame:
    """The rows of ``texts`` whose _d is in ``ids`` (_d, distinct): the ids
    are broadcast if at most ``limit`` (8 bytes each), else joined."""
    return texts.join(F.broadcast(ids) if small_enough(ids, limit) else ids, "_d", "left_semi")
