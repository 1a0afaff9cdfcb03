"""Sheets of workbooks: parts written by hand, round trips, broken files."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from peerlens.sources.workbooks import BrokenWorkbook, Sheet, column_letters, column_number, read_sheet, workbook_bytes, write_workbooks

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"

ROWS = """
<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="C1" t="s"><v>2</v></c></row>
<row r="2"><c r="A2" t="s"><v>3</v></c><c r="C2"><v>1.5E-2</v></c><c r="AB2" t="b"><v>1</v></c></row>
<row r="3"/><row r="4"><c r="B4" s="3"/></row>
<row r="5"><c t="inlineStr"><is><r><t>ri</t></r><r><rPr/><t>ch</t></r><rPh><t>no</t></rPh></is></c><c><v>7</v></c><c t="e"><v>#N/A</v></c></row>
<row><c r="A6" t="str"><f>x</f><v>made &amp; kept</v></c><c r="B6"><v>-4</v></c><c r="C6" t="s"><v>4</v></c></row>
"""
ITEMS = "<si><t>code</t></si><si><t>n</t></si><si><t>x</t></si><si><r><t>on</t></r><r><t xml:space='preserve'>e </t></r></si><si><t>NA</t></si><si><t>unused</t></si>"


def by_hand(path, rows=ROWS, items=ITEMS, target="worksheets/other.xml"):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{REL}"><sheets><sheet name="First" r:id="a"/><sheet name="A &amp; B" r:id="b"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships><Relationship Id="a" Target="/xl/no.xml"/><Relationship Id="b" Target="{target}"/></Relationships>')
        z.writestr("xl/worksheets/other.xml", f'<worksheet xmlns="{MAIN}"><cols/><sheetData>{rows}</sheetData></worksheet>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">{items}</sst>')
    return str(path)


FIELDS = [(3, "x", "double"), (1, "code", "string"), (2, "n", "bigint"), (28, "flag", "boolean")]


def test_cells_of_every_kind(spark, tmp_path):
    for target in ("worksheets/other.xml", "/xl/worksheets/other.xml", "../xl/worksheets/other.xml"):
        sheet = Sheet(by_hand(tmp_path / "a.xlsx", target=target), "A & B")
        found = read_sheet(spark, sheet, FIELDS)
        assert [tuple(r) for r in found.collect()] == [(0.015, "one ", None, True), (None, "rich", 7, None), (None, "made & kept", -4, None)]
    assert [r.a for r in read_sheet(spark, sheet, [(1, "a", "string")], header=False).collect()] == ["code", "one ", "rich", "made & kept"]


def test_columns_and_letters():
    for n, letters in ((1, "A"), (26, "Z"), (27, "AA"), (28, "AB"), (702, "ZZ"), (703, "AAA"), (16384, "XFD")):
        assert column_letters(n) == letters and column_number(f"{letters}12") == n


def test_round_trip_in_several_files(spark, tmp_path):
    rows = spark.range(7000).select(
        F.concat(F.lit("E<&>"), F.col("id") % 500).alias("code"), F.lit(None).cast("string").alias("gap"),
        F.when(F.col("id") % 9 > 0, F.col("id") / 7).alias("x"), F.col("id").alias("n"),
    )
    write_workbooks({"many": rows.repartition(4), "few": rows.limit(3).select("n"), "none": rows.limit(0)}, f"{tmp_path}/out", 2000)
    files = [p.name for p in (tmp_path / "out").iterdir() if p.suffix == ".xlsx"]
    assert len(files) == 4
    many = read_sheet(spark, Sheet(f"{tmp_path}/out", "many"), [(1, "code", "string"), (2, "gap", "string"), (3, "x", "double"), (4, "n", "bigint")])
    assert many.rdd.getNumPartitions() == 4
    assert many.count() == 7000 and many.exceptAll(rows).isEmpty()
    assert read_sheet(spark, Sheet(f"{tmp_path}/out", "few"), [(1, "n", "bigint")]).count() == 3
    assert read_sheet(spark, Sheet(f"{tmp_path}/out", "none"), [(3, "x", "double")]).collect() == []


def test_what_is_no_workbook_fails_by_name(spark, tmp_path):
    sheet = Sheet(by_hand(tmp_path / "a.xlsx"), "Absent")
    with pytest.raises(Exception, match=r"(?s)a.xlsx: no sheet 'Absent' among \['A & B', 'First'\]"):
        read_sheet(spark, sheet, FIELDS).collect()
    (tmp_path / "b.xlsx").write_bytes(b"PK no zip")
    for path, name, says in (("b.xlsx", "A & B", "b.xlsx"), ("a.xlsx", "First", "a.xlsx, sheet First")):
        with pytest.raises(Exception, match=f"(?s){says}"):
            read_sheet(spark, Sheet(f"{tmp_path}/{path}", name), FIELDS).collect()
    broken = by_hand(tmp_path / "c.xlsx", items=ITEMS[:40])
    with pytest.raises(Exception, match="(?s)c.xlsx"):
        read_sheet(spark, Sheet(broken, "A & B"), FIELDS).collect()
    mistyped = by_hand(tmp_path / "d.xlsx")
    with pytest.raises(Exception, match="(?s)CAST_INVALID_INPUT|cannot be cast"):
        read_sheet(spark, Sheet(mistyped, "A & B"), [(1, "code", "int")]).collect()
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(Exception, match="no .xlsx"):
        read_sheet(spark, Sheet(str(empty), "A"), FIELDS).collect()


def test_memory_does_not_follow_the_sheet(tmp_path):
    """Rows that were read are let go."""
    import tracemalloc

    from peerlens.sources import workbooks

    path = tmp_path / "long.xlsx"
    path.write_bytes(workbook_bytes({"s": [[i, f"text {i}", i / 3] for i in range(60_000)]}))
    with zipfile.ZipFile(path) as book:
        tracemalloc.start()
        assert sum(1 for _ in workbooks.rows_of(book, "xl/worksheets/sheet1.xml", [1], 0)) == 60_000
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
    assert peak < 2 << 20
    assert issubclass(BrokenWorkbook, ValueError)


def test_rows_of_a_sheet_are_written_as_they_come():
    """A workbook's rows are not held as objects: 100,000 of them cost no more than their packed bytes and a few lines."""
    import tracemalloc

    rows = (["code", i, None, i / 7] for i in range(100_000))
    tracemalloc.start()
    content = workbook_bytes({"many": rows, "few": iter([["x"]])})
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 * len(content) + 5_000_000
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        assert book.read("xl/worksheets/sheet1.xml").count(b"<row ") == 100_000


def test_rows_of_many_workbooks_stay_in_order(spark, tmp_path):
    rows = spark.range(900).selectExpr("IF(id % 7 = 0, NULL, id) AS n", "concat('t', id) AS t").coalesce(1)
    write_workbooks({"a": rows, "b": rows.where("n < 5"), "none": rows.limit(0)}, f"{tmp_path}/out", 100)
    back = read_sheet(spark, Sheet(f"{tmp_path}/out", "a"), [(1, "n", "bigint"), (2, "t", "string")])
    assert back.count() == 900 and back.exceptAll(rows).isEmpty()
    for part in back.rdd.glom().collect():
        assert [int(r.t[1:]) for r in part] == sorted(int(r.t[1:]) for r in part)
