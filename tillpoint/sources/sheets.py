"""Sales-detail sheets from CSV exports and workbooks.

Header names are normalised and mapped by position, which is the only way
to keep the two "Total" columns apart (line total first, invoice total
second).  Every value is read as text: parsing is the job of the typed,
null-safe functions downstream.  ``_src`` (file) and ``_row_no`` (file
order) are added so "first line of a sale" survives the shuffle.
"""

from __future__ import annotations

import csv
import io
import re
import zipfile
import xml.etree.ElementTree as ET

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillpoint.operators.lines import header_mapping, require_columns
from tillpoint.session import materialize

SHEET_FIELDS = ["sale_id", "invoice_datetime", "salesperson", "customer_name", "items_sold",
                "payment_type", "comment", "pos_customer_id", "pos_item_id", "item_name",
                "category", "quantity", "unit_price", "subtotal", "line_total", "invoice_total"]
SHEET_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in SHEET_FIELDS] +
                            [T.StructField("_src", T.StringType()),
                             T.StructField("_row_no", T.LongType())])


def _finish(df: DataFrame, present: list[str]) -> DataFrame:
    for f in SHEET_FIELDS:
        if f not in present:
            df = df.withColumn(f, F.lit(None).cast("string"))
    return require_columns(df, ("sale_id",))


def read_sheet_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """CSV export(s) of the sales-detail sheet with the canonical columns."""
    first = spark.read.text(path).first()
    if first is None:
        raise ValueError(f"empty sheet: {path}")
    headers = next(csv.reader(io.StringIO(first[0]), delimiter=sep))
    mapping = header_mapping(headers)
    if "sale_id" not in [n for _, n in mapping]:
        raise ValueError(f"sales sheet is missing required column(s): ['sale_id']")
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(headers))])
    raw = spark.read.schema(schema).option("header", True).option("sep", sep) \
        .option("multiLine", False).csv(path)
    df = raw.select(*[F.col(f"_c{i}").alias(n) for i, n in mapping],
                    F.input_file_name().alias("_src"),
                    F.monotonically_increasing_id().alias("_row_no"))
    return _finish(df, [n for _, n in mapping]).select(*SHEET_SCHEMA.names)


TRACKER_SCHEMA = ("product string, posted_date date, first_sale_date date, "
                  "days_to_first_sale int, sold_within_3_days boolean")


def read_tracker_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The post-to-sale tracker CSV by its declared schema, as (good rows,
    quarantine).  A header of other names is an error.  Quarantined rows keep
    what could be read of them and add ``raw`` (the line, if a value could not
    be read) and ``reason``: unreadable, missing_product, missing_posted_date,
    sold_before_posted or days_mismatch, the first that holds.  The file is
    parsed once, into a table that both results read."""
    rows = materialize(
        spark.read.schema(TRACKER_SCHEMA + ", raw string").option("header", True).option("enforceSchema", False)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "raw").csv(path), "tracker")
    days = F.datediff("first_sale_date", "posted_date")
    reason = (F.when(F.col("raw").isNotNull(), "unreadable")
              .when(F.coalesce(F.trim("product"), F.lit("")) == "", "missing_product")
              .when(F.col("posted_date").isNull(), "missing_posted_date")
              .when(days < 0, "sold_before_posted")
              .when(~days.eqNullSafe(F.col("days_to_first_sale")), "days_mismatch"))
    rows = rows.withColumn("reason", reason)
    return rows.filter("reason IS NULL").drop("raw", "reason"), rows.filter("reason IS NOT NULL")


# ------------------------------------------------------------------ workbook (.xlsx)

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_CELL = re.compile(r"([A-Z]+)(\d+)")


def _col_index(ref: str) -> int:
    letters = _CELL.match(ref).group(1)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _number_text(v: str) -> str:
    try:
        f = float(v)
    except ValueError:
        return v
    return str(int(f)) if f.is_integer() else repr(f)


def workbook_rows(data: bytes, sheet: int = 1):
    """Rows (lists of text) of one worksheet of an .xlsx file."""
    z = zipfile.ZipFile(io.BytesIO(data))
    shared: list[str] = []
    if "xl/sharedStrings.xml" in z.namelist():
        root = ET.fromstring(z.read("xl/sharedStrings.xml"))
        for si in root.findall("m:si", _NS):
            shared.append("".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")))
    root = ET.fromstring(z.read(f"xl/worksheets/sheet{sheet}.xml"))
    for row in root.iter(f"{{{_NS['m']}}}row"):
        cells: dict[int, str | None] = {}
        for c in row.findall("m:c", _NS):
            t = c.get("t")
            v = c.find("m:v", _NS)
            if t == "s" and v is not None:
                val = shared[int(v.text)]
            elif t == "inlineStr":
                val = "".join(x.text or "" for x in c.iter(f"{{{_NS['m']}}}t"))
            elif v is not None and v.text is not None:
                val = v.text if t in ("str", "b", "e") else _number_text(v.text)
            else:
                val = None
            cells[_col_index(c.get("r"))] = val
        width = max(cells) + 1 if cells else 0
        yield [cells.get(i) for i in range(width)]


try:
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    class _FilePartition(InputPartition):
        def __init__(self, path: str):
            self.path = path

    class WorkbookReader(DataSourceReader):
        def __init__(self, paths: list[str], sheet: int):
            self.paths, self.sheet = paths, sheet

        def partitions(self):
            return [_FilePartition(p) for p in self.paths]

        def read(self, partition):
            with open(partition.path, "rb") as fh:
                data = fh.read()
            rows = workbook_rows(data, self.sheet)
            header = next(rows, None)
            if header is None:
                return
            mapping = header_mapping([h or "" for h in header])
            pos = {n: i for i, n in mapping}
            for no, r in enumerate(rows):
                if not any(x not in (None, "") for x in r):
                    continue
                vals = [r[pos[f]] if f in pos and pos[f] < len(r) else None for f in SHEET_FIELDS]
                yield tuple(vals) + (partition.path, no)

    class WorkbookDataSource(DataSource):
        """``spark.read.format("sales_workbook").option("sheet", 1).load(paths)``:
        one partition per workbook file."""

        @classmethod
        def name(cls):
            return "sales_workbook"

        def schema(self):
            return SHEET_SCHEMA

        def reader(self, schema):
            paths = self.options.get("paths") or self.options.get("path")
            if paths and paths.startswith("["):
                import json
                paths = json.loads(paths)
            elif paths:
                paths = paths.split(",")
            return WorkbookReader(list(paths or []), int(self.options.get("sheet", 1)))

except ImportError:  # pragma: no cover - Python data sources need Spark 4
    WorkbookDataSource = None


def read_workbooks(spark: SparkSession, paths: list[str], sheet: int = 1) -> DataFrame:
    """One or more .xlsx sales workbooks (one partition per file)."""
    spark.dataSource.register(WorkbookDataSource)
    df = spark.read.format("sales_workbook").option("paths", ",".join(paths)) \
        .option("sheet", sheet).load()
    return require_columns(df, ("sale_id",))
