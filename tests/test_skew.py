"""A sale holding a third of all lines: invoices are built by partial
aggregation, and the result equals a plain Python computation."""

import random

from tillpoint.operators import sales as SA


def test_hot_invoice(spark):
    random.seed(1)
    rows = []
    n = 0
    for sid, k in [("S1", 600)] + [(f"S{i}", random.randint(1, 6)) for i in range(2, 300)]:
        for j in range(k):
            n += 1
            q = random.choice(["1", "2", "-1", "2.5", "abc"])
            rows.append((sid, "04/11/2026-02:30 PM", "BB" if j else " BB ", "Ali",
                         "Cash: N100", str(j + 1), "Lace" if j % 7 else "Discount", q,
                         "N100", "100", "N100", n))
    cols = ("sale_id invoice_datetime salesperson customer_name payment_type pos_item_id "
            "item_name quantity unit_price line_total invoice_total _row_no").split()
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols[:-1]) + ", _row_no long")
    df = spark.createDataFrame(df.rdd, df.schema).repartition(8)   # hot sale spread over tasks
    got = {r.sale_id: r for r in SA.validate_sales(SA.parsed_lines(df)).collect()}
    for sid in {r[0] for r in rows}:
        lines = [r for r in rows if r[0] == sid]
        qs = []
        for r in lines:
            try:
                v = float(r[7])
            except ValueError:
                v = 0.0
            if r[6] != "Discount":
                qs.append(v)
        sold = int(sum(x for x in qs if x > 0))
        returned = int(abs(sum(x for x in qs if x < 0)))
        g = got[int(sid[1:])]
        assert (g.items_sold, g.items_returned) == (sold, returned), sid
        assert g.salesperson == "BB"
        assert g.accepted == (not any(r[7] == "abc" for r in lines)), sid


def test_nested_items_are_chunked(spark):
    """N-1: a 450-line invoice is nested in chunks of at most 200 items, in
    line order, and no item is lost."""
    rows = [("S7", str(i), f"item{i:03d}", "1", "N10", "10", i) for i in range(450)]
    rows += [("S8", "1", "x", "2", "N5", "10", 1000)]
    df = spark.createDataFrame(rows, "sale_id string, pos_item_id string, item_name string, "
                                     "quantity string, unit_price string, line_total string, "
                                     "_row_no long").repartition(5)
    n = SA.nest_items(SA.parsed_lines(df)).collect()
    s7 = sorted((r for r in n if r.sale_id == 7), key=lambda r: r.chunk)
    assert all(len(r["items"]) <= 200 for r in n)
    names = [it.item_name for r in s7 for it in r["items"]]
    assert names == [f"item{i:03d}" for i in range(450)]
    assert [len(r["items"]) for r in n if r.sale_id == 8] == [1]


def test_lines_keep_small_partitions(spark):
    """The lines behind the sale join come in all shuffle partitions,
    not merged by the few bytes of the shuffled columns."""
    from tests.conftest import SF_SMALL
    from tillpoint.plans import standin as SI
    lines = SI.driver_lines(spark, SF_SMALL, ("category",))
    assert lines.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_positions_need_no_shuffle_of_the_rows(spark, tmpdir_path):
    """rows of an ordered table get their position where they are read."""
    from tillpoint.sinks import ordered as OD
    path = OD.write_in_order(spark.range(1000).repartition(4), f"{tmpdir_path}/t", "id", files=3)
    got = OD.read_in_order(spark, path)
    assert "hashpartitioning" not in got._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in got._jdf.queryExecution().sparkPlan().toString()
    assert all(r.position == r.id + 1 for r in got.collect())


def test_ledger_writes_only_what_it_needs(spark, monkeypatch):
    """the validated sales are written without the columns that no
    outcome is taken from."""
    from tests.conftest import SF_SMALL
    from tillpoint.plans import catalog as C
    written = []
    monkeypatch.setattr(C, "materialize", lambda df, name: written.append(df.columns) or df)
    for key in ("run_summary", "dedup_ledger"):
        C.QUERIES[key](spark, SF_SMALL)
    assert written == [C.LEDGER_COLS] * 2
