"""Sources: duplicate "Total" headers, workbook reader, receipt pages,
missing sale-id column."""

import io
import os
import zipfile

import pytest

from tillpoint.operators import sales as SA
from tillpoint.sources import receipts as RC
from tillpoint.sources import sheets as SH

HEADER = "Sale Id,Date,Sold By,Sold To,Payment Type,Item Id,Name,Quantity Sold,Selling Price,Total,Total\n"
ROWS = [
    "S107,04/11/2026-02:30 PM, BB ,Online customers,Cash: N5000 Store Account: -N2000,5,Lace,2,5000,10000,13000\n",
    "S107 Edit,04/11/2026-02:30 PM,BB,Online customers,,6,Discount,-1,0,0,13000\n",
    "S108,4/1/2026-2:05 pm,,Ali,Moniepoint: N300,7,Voile,abc,300,300,300\n",
    "none,garbage,X,Y,,8,Z,1,1,1,1\n",
]


def test_csv_duplicate_total_and_sales(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "sheet.csv")
    with open(p, "w") as fh:
        fh.write(HEADER + "".join(ROWS))
    df = SH.read_sheet_csv(spark, p)
    r = df.orderBy("_row_no").first()
    assert (r.line_total, r.invoice_total) == ("10000", "13000")
    v = {x.sale_id: x for x in SA.validate_sales(SA.parsed_lines(df)).collect()}
    assert set(v) == {107, 108}                     # "none" has no id -> dropped
    assert v[107].accepted and v[107].items_sold == 2 and v[107].items_returned == 0
    assert float(v[107].change_due) == 2000.0 and v[107].is_anonymous_customer
    assert not v[108].accepted
    assert set(v[108].reasons.split(",")) == {"missing_salesperson", "bad_item_quantity"}


def test_missing_sale_id_column(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "bad.csv")
    with open(p, "w") as fh:
        fh.write("Date,Name\n04/11/2026-02:30 PM,Lace\n")
    with pytest.raises(ValueError):
        SH.read_sheet_csv(spark, p)


def _xlsx(rows):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        cells = []
        for ri, row in enumerate(rows, 1):
            cs = []
            for ci, v in enumerate(row):
                ref = f"{chr(65 + ci)}{ri}"
                if isinstance(v, (int, float)):
                    cs.append(f'<c r="{ref}"><v>{v}</v></c>')
                elif v is not None:
                    cs.append(f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>')
            cells.append(f'<row r="{ri}">{"".join(cs)}</row>')
        z.writestr("xl/worksheets/sheet1.xml",
                   '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
                   f'<sheetData>{"".join(cells)}</sheetData></worksheet>')
    return buf.getvalue()


def test_workbook_reader(spark, tmpdir_path):
    rows = [["Sale Id", "Date", "Sold By", "Name", "Quantity Sold", "Selling Price", "Total", "Total"],
            ["S1", "04/11/2026-02:30 PM", "BB", "Lace", 2.5, 5000, 12500, 20000.5],
            ["S1", "04/11/2026-02:30 PM", "BB", "Voile", 1, 7500, 7500, 20000.5]]
    p = os.path.join(tmpdir_path, "wb.xlsx")
    with open(p, "wb") as fh:
        fh.write(_xlsx(rows))
    df = SH.read_workbooks(spark, [p])
    got = sorted((r.item_name, r.quantity, r.line_total, r.invoice_total) for r in df.collect())
    assert got == [("Lace", "2.5", "12500", "20000.5"), ("Voile", "1", "7500", "20000.5")]


RECEIPT = """<html><body><ul class="invoice-address invoiceto"><li>Bill to</li><li><b>Customer:</b> Online customers</li></ul>
<ul class="invoice-detail"><li>a</li><li>b</li><li><strong> 04/11/2026-02:30 PM </strong></li>
<li><span>Sold by</span> BB &amp; Co</li></ul>
<table id="receipt-draggable"><thead><tr><th>x</th></tr></thead><tbody data-item-class="item" data-sale-id="107" data-item-id="5"
 data-item-name="Lace &quot;A&quot;" data-item-qty="2" data-item-price="5000" data-item-total="10000"><tr><td>x</td></tr></tbody>
<tbody data-item-class="note" data-item-id="9"></tbody>
<tbody data-sale-id="107" data-item-class="item" data-item-id="6" data-item-qty="-1"><tr><td>y</td></tr></tbody></table>
<div class="invoice-footer"><div class="invoice-footer-heading">Total</div>
<div class="invoice-footer-value invoice-total">N10,000</div>
<div class="invoice-footer-value">Cash</div><div class="invoice-footer-value invoice-payment"> N6,000 </div>
<div class="invoice-footer-value invoice-payment"></div><div class="invoice-footer-value"> Moniepoint</div>
<div class="invoice-footer-heading">Number of items sold</div><div class="invoice-footer-value">2</div>
<div class="invoice-footer-heading">Change Due</div><span class="invoice-footer-value">N5</span></div>
<div class="invoice-policy">No refunds</div></body></html>"""


def test_receipt_extract(spark):
    pages = spark.createDataFrame([(1, "u", RECEIPT), (2, "u", "<html></html>")],
                                  "page_id long, url string, html string")
    out = {r.page_id: r for r in RC.extract_receipts(pages).collect()}
    r = out[1]
    assert r.customer_name == "Online customers" and r.is_anonymous_customer
    assert r.invoice_datetime == "04/11/2026-02:30 PM" and r.invoice_total == "N10,000"
    assert [(p.channel, p.amount) for p in r.payments] == [("CASH", "N6,000"), ("MONIEPOINT", "0.0")]
    assert [(i.pos_item_id, i.name, i.quantity) for i in r["items"]] == [("5", 'Lace "A"', "2"), ("6", None, "-1")]
    assert (r.salesperson, r.pos_sale_id, r.comment) == ("BB & Co", "107", "No refunds")
    assert (r.items_sold, r.items_returned, r.change_due) == ("2", "0", "N5")
    assert out[2]["items"] == [] and out[2].customer_name is None and not out[2].is_anonymous_customer


def test_workbook_shared_strings(spark, tmpdir_path):
    ns = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    strings = ["Sale Id", "Name", "Total", "S9 Edit", "Lace"]
    sst = "".join(f"<si><t>{s}</t></si>" for s in strings)
    sheet = (f'<worksheet xmlns="{ns}"><sheetData>'
             '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c>'
             '<c r="C1" t="s"><v>2</v></c><c r="D1" t="s"><v>2</v></c></row>'
             '<row r="2"><c r="A2" t="s"><v>3</v></c><c r="B2" t="s"><v>4</v></c>'
             '<c r="C2"><v>100.5</v></c><c r="D2"><v>250</v></c></row>'
             '<row r="3"></row></sheetData></worksheet>')
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{ns}">{sst}</sst>')
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    p = os.path.join(tmpdir_path, "shared.xlsx")
    with open(p, "wb") as fh:
        fh.write(buf.getvalue())
    rows = SH.read_workbooks(spark, [p]).collect()
    assert [(r.sale_id, r.item_name, r.line_total, r.invoice_total) for r in rows] == \
        [("S9 Edit", "Lace", "100.5", "250")]       # blank row skipped


def test_receipt_without_footer_and_short_page(spark):
    no_footer = RECEIPT.split('<div class="invoice-footer">')[0] + "</body></html>"
    pages = spark.createDataFrame([(1, "u", no_footer), (2, "u", "<p>x</p>")],
                                  "page_id long, url string, html string")
    out = {r.page_id: r for r in RC.extract_receipts(pages).collect()}
    assert out[1].invoice_total is None and out[1].payments == []
    assert out[1].customer_name == "Online customers" and len(out[1]["items"]) == 2
    assert out[2].n_chars < 100 and out[2]["items"] == [] and out[2].salesperson is None


def test_receipt_parts_are_searched_once_and_read_as_before(spark):
    """an element is matched once more to be taken apart, an attribute's text is
    compared before what stands in front of it; odd markup reads as it did."""
    pages = spark.createDataFrame([
        (1, "u", '<div class="invoice-footer"><p class="x>y invoice-footer-value">a</p><p CLASS = "invoice-footer-value  '
                 'invoice-payment">  5 <b>1</b>0 &amp;lt; "q" </P ><p class="invoice-footer-value">cash</p></div>'),
        (2, "u", '<tbody data-item-class="item" data-item-id="9"><table id = "receipt-draggable"><tbody data-item-class="item" '
                 'data-sale-id="" data-item-id = "7" data-item-qty="2>3"></tbody><tbody xdata-item-id="2" data-item-id="3" '
                 'data-item-class="item" data-item-name="a &quot;b&quot; &amp;lt;" data-item-id="4">')],
        "page_id long, url string, html string")
    cut = RC.extract_receipts(pages)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "|\\s)data-item" not in plan and "lower(_html" not in plan
    one, two = cut.orderBy("page_id").collect()
    assert [tuple(p) for p in one["payments"]] == [("CASH", '510 &lt; "q"')]
    assert [(i["pos_sale_id"], i["pos_item_id"], i["name"]) for i in two["items"]] == [("", "7", None), (None, "3", 'a "b" &lt;')]


def test_landing_is_compressed_in_several_files(spark, monkeypatch):
    """the exports that ``stream_ingest`` writes."""
    from tests.conftest import SF_SMALL
    from tillpoint.plans import catalog as C

    class Landed(Exception):
        pass

    def start(spark, landing, customers, out, ck, max_files):
        files = [f.split(".", 1)[1] for f in spark.read.text(landing).inputFiles()]
        raise Landed(max_files, len(files), all(f.endswith("csv.gz") for f in files))
    monkeypatch.setattr(C.IG, "start_ingest", start)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        with pytest.raises(Landed) as e:
            C.q_stream_ingest(spark, SF_SMALL)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert e.value.args == (6, 12, True)


def test_sheet_export_is_compressed(spark):
    """the export that ``workbook_scan`` writes and reads back."""
    from tests.conftest import SF_SMALL
    from tillpoint.plans.catalog import QUERIES
    assert all(f.endswith(".csv.snappy") for f in QUERIES["workbook_scan"](spark, SF_SMALL).inputFiles())
