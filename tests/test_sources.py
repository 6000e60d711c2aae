"""Feed sources: delimited text, workbooks, file names, complete batches."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL, D, T, rows_of
from vigil.functions import parse_amount
from vigil.plans import bindings
from vigil.sources import delimited, files, workbook
from xlsx_util import write_xlsx

HEADER = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_delimited_edges(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    _write(land / "transactions_01032021.txt", HEADER
           + 'NA;2021-03-01 10:00:00;1234,56;1111 2222 3333 4444;PAYMENT;SUCCESS;"T;1"\n'
           + "2;2021-03-01 10:05:00;100;1111 2222 3333 4444;WITHDRAW;REJECT\n"    # missing field
           + "3;not a time;5,5;x;PAYMENT;SUCCESS;T2\n"
           + "4;2021-03-01 11:00:00;1;c;PAYMENT;SUCCESS;T;extra\n")                # extra field
    _write(land / "transactions_nodate.txt", HEADER + "9;2021-03-01 10:00:00;1;c;PAYMENT;SUCCESS;T\n")
    rows = delimited.read_transactions(spark, str(land)).cache()
    by_id = {r.transaction_id: r for r in rows.collect()}
    assert by_id["NA"].terminal == "T;1" and by_id["NA"].amount == "1234,56"
    assert by_id["NA"].transaction_date == T("2021-03-01 10:00:00")
    assert by_id["NA"].batch_date == D("2021-03-01")
    assert by_id["2"].terminal is None
    assert by_id["3"].transaction_date is None
    assert by_id["9"].batch_date is None
    rejected = delimited.rejected_transactions(spark, str(land))
    assert "4" not in by_id
    assert {r.transaction_id for r in rejected.collect()} == {"4", "9"}


def test_delimited_round_trip(spark, tmp_path):
    staged = bindings.staged_transactions(spark, SF_SMALL)
    out = delimited.write_transactions(staged, str(tmp_path), D("2024-01-31"))
    back = delimited.read_transactions(spark, out).drop("batch_date")
    assert back.exceptAll(staged).count() == 0 and staged.exceptAll(back).count() == 0


def test_parse_amount(spark):
    df = spark.createDataFrame([("1234,56",), ("1234",), ("",), ("abc",), ("12x",), (None,)], "a string")
    got = [r.v for r in df.select(parse_amount("a").alias("v")).collect()]
    assert got == [1234.56, 1234.0, None, None, None, None]


def test_file_names_and_batches(spark):
    names = spark.createDataFrame([
        ("transactions_02032021.txt",), ("passport_blacklist_02032021.xlsx",),
        ("terminals_02032021.xlsx",),
        ("transactions_01042021.txt",), ("passport_blacklist_01042021.xlsx",),
        ("terminals_01042021.xlsx",),
        ("transactions_03032021.txt",),                      # incomplete day
        ("notes.txt",), ("transactions_99999999.txt",)], "file_name string")
    f = files.feed_files(names).cache()
    assert rows_of(files.quarantined_files(f), "file_name") == [("notes.txt",),
                                                                ("transactions_99999999.txt",)]
    complete = files.complete_batches(f)
    assert rows_of(complete, "batch_date") == [(D("2021-03-02"),), (D("2021-04-01"),)]
    # by date, not by name: 01 April sorts before 02 March as text
    assert files.next_batch(complete).first()["batch_date"] == D("2021-03-02")
    processed = spark.createDataFrame([(D("2021-03-02"),)], "batch_date date")
    assert files.next_batch(complete, processed).first()["batch_date"] == D("2021-04-01")


def test_list_files(spark, tmp_path):
    for name in ("transactions_01032021.txt", "terminals_01032021.xlsx"):
        _write(tmp_path / name, "x")
    listed = files.feed_files(files.list_files(spark, str(tmp_path)))
    assert rows_of(listed, "file_name", "feed", "batch_date") == [
        ("terminals_01032021.xlsx", "terminals", D("2021-03-01")),
        ("transactions_01032021.txt", "transactions", D("2021-03-01"))]


def test_workbooks(spark, tmp_path):
    write_xlsx(os.path.join(tmp_path, "passport_blacklist_01032021.xlsx"), ["date", "passport"],
               [[D("2021-02-15"), "8732 868620"], [D("2021-02-16"), "NA"], [None, "1234 000000"]])
    write_xlsx(os.path.join(tmp_path, "passport_blacklist_02032021.xlsx"), ["passport", "date"],
               [["5100 810950", D("2021-03-01")]])
    write_xlsx(os.path.join(tmp_path, "terminals_01032021.xlsx"),
               ["terminal_id", "terminal_type", "terminal_city", "terminal_address"],
               [["P1", "POS", "Moscow", "Lenina 1"], [42, "ATM", "Kazan", "Pushkina 2"]])
    bl = workbook.read_blacklist(spark, str(tmp_path))
    assert rows_of(bl, "passport", "date", "batch_date") == [
        ("1234 000000", None, D("2021-03-01")),
        ("5100 810950", D("2021-03-01"), D("2021-03-02")),
        ("8732 868620", D("2021-02-15"), D("2021-03-01")),
        ("NA", D("2021-02-16"), D("2021-03-01"))]
    te = workbook.read_terminals(spark, str(tmp_path))
    assert rows_of(te, "terminal_id", "terminal_city") == [("42", "Kazan"), ("P1", "Moscow")]
    assert te.filter(F.col("batch_date") != F.lit(D("2021-03-01"))).count() == 0


def _raw_workbook(path, sheet_rows, styles_xml, date1904=False):
    import zipfile
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    pr = '<workbookPr date1904="1"/>' if date1904 else ""
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml",
                   f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/'
                   f'relationships">{pr}<sheets><sheet name="S" sheetId="1" r:id="rId9"/></sheets>'
                   "</workbook>")
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/'
                   'relationships"><Relationship Id="rId9" Type="worksheet" '
                   'Target="/xl/worksheets/data.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f"<styleSheet {ns}>{styles_xml}</styleSheet>")
        z.writestr("xl/worksheets/data.xml",
                   f"<worksheet {ns}><sheetData>{sheet_rows}</sheetData></worksheet>")


def test_workbook_cell_kinds(spark, tmp_path):
    styles = ('<numFmts count="1"><numFmt numFmtId="164" formatCode="dd/mm/yyyy"/></numFmts>'
              '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="164"/></cellXfs>')
    rows = ('<row r="1"><c r="A1" t="inlineStr"><is><t>passport</t></is></c>'
            '<c r="C1" t="inlineStr"><is><t>date</t></is></c></row>'
            '<row r="2"><c r="A2" t="inlineStr"><is><t>1111 222222</t></is></c>'
            '<c r="B2" t="b"><v>1</v></c><c r="C2" s="1"><v>44256</v></c></row>'
            '<row r="3"><c r="A3"><v>12345</v></c><c r="C3" t="str"><v>2021-03-05</v></c></row>')
    _raw_workbook(os.path.join(tmp_path, "passport_blacklist_01032021.xlsx"), rows, styles)
    got = rows_of(workbook.read_blacklist(spark, str(tmp_path)), "passport", "date")
    assert got == [("1111 222222", D("2021-03-01")), ("12345", D("2021-03-05"))]


def test_workbook_1904_dates(spark, tmp_path):
    styles = '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs>'
    rows = ('<row r="1"><c r="A1" t="inlineStr"><is><t>passport</t></is></c>'
            '<c r="B1" t="inlineStr"><is><t>date</t></is></c></row>'
            '<row r="2"><c r="A2" t="inlineStr"><is><t>P</t></is></c>'
            '<c r="B2" s="1"><v>42794</v></c></row>')
    _raw_workbook(os.path.join(tmp_path, "passport_blacklist_01032021.xlsx"), rows, styles,
                  date1904=True)
    assert rows_of(workbook.read_blacklist(spark, str(tmp_path)), "passport", "date") == [
        ("P", D("2021-03-01"))]


def test_feed_folders_written_by_a_job(spark, tmp_path):
    """A feed may be a Parquet or CSV folder named as the file would be."""
    from vigil.sources import workbook
    rows = spark.createDataFrame([("T1", "ATM", "X", "a"), ("T2", "POS", "Y", None)],
                                 "terminal_id string, terminal_type string, terminal_city string, "
                                 "terminal_address string")
    one, two = (str(tmp_path / f"terminals_0{i}032021.parquet") for i in (1, 2))
    rows.repartition(2).write.parquet(one)
    rows.limit(1).write.parquet(two)
    got = workbook.read_terminals(spark, [one, two]).collect()
    assert sorted((r.terminal_id, r.terminal_address, str(r.batch_date)) for r in got) == [
        ("T1", "a", "2021-03-01"), ("T1", "a", "2021-03-02"), ("T2", None, "2021-03-01")]
