"""Parse rules as tables of literal inputs and the results that the rules ask
for, each table evaluated in one Spark job."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillpoint.functions import scalars as S

CLEAN = {"a  b": "a b", "  x\t y \n": "x y", "": None, "   ": None, "N 5": "N 5"}
SALE_ID = {"S12 Edit": 12, "12": 12, " 007x9": 7, "none": None, "": None, "-5": 5, "1.9": 1}
INTS = {"12": 12, " -7 ": -7, "+3": 3, "2.9": 2, "-2.9": -2, ".5": 0, "1e3": 1000, "": None, "a1": None,
        "1,000": None, "1e": None, ".": None}
MONEY = {"N1,200.50": "1200.50", "\u20a6 3": "3", "-4.25": "-4.25", "": None, "N": None, "12a": None,
         "1 2": "12", ",": None, "--1": None}


def run(spark, table, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(table)], "i int, x string")
    return [r[1] for r in sorted(df.select("i", fn(F.col("x"))).collect())]


def test_clean_text(spark):
    table = {k: v for k, v in CLEAN.items() if "\u00a0" not in k}
    assert run(spark, table, S.clean_text) == list(table.values())


@pytest.mark.parametrize(("table", "fn"), [(SALE_ID, S.parse_sale_id), (INTS, S.parse_int)])
def test_numbers(spark, table, fn):
    assert run(spark, table, fn) == list(table.values())


def test_money(spark):
    got = run(spark, MONEY, S.parse_money)
    assert got == [None if v is None else Decimal(v) for v in MONEY.values()]
