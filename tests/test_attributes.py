"""Attribute tables: bytes by hand, partitioned reads, broken headers."""

import datetime
import struct

import pytest
from pyspark.sql import functions as F

from peerlens.sources.attributes import header_bytes, read_attributes, record_bytes, write_attributes

FIELDS = [("LSOA11CD", "C", 9, 0), ("Shape__Are", "N", 19, 11), ("N", "N", 6, 0), ("MADE", "D", 8, 0), ("OK", "L", 1, 0)]
WIDTHS = [f[2] for f in FIELDS]
ROWS = [
    ("E01000001", "  129865.31447601", "12", "20110327", "T"),
    ("É two", "", "-7", "", "n"),
    ("", "*******************", "", "19991231", "?"),
    (None, "1.5E+3", "0", None, None),
]


def write(path, rows, fields=FIELDS, extra=b"\x1a"):
    path.write_bytes(header_bytes(fields, len(rows)) + b"".join(record_bytes(r, [f[2] for f in fields]) for r in rows) + extra)
    return str(path)


def test_every_type_and_missing_values(spark, tmp_path):
    found = read_attributes(spark, write(tmp_path / "a.dbf", ROWS))
    assert [t for _, t in found.dtypes] == ["string", "double", "bigint", "date", "boolean"]
    assert [tuple(r) for r in found.collect()] == [
        ("E01000001", 129865.31447601, 12, datetime.date(2011, 3, 27), True),
        ("É two", None, -7, None, False),
        (None, None, None, datetime.date(1999, 12, 31), None),
        (None, 1500.0, 0, None, None),
    ]


def test_header_of_another_program(spark, tmp_path):
    """Bytes put together here, with a wide text, a gap behind the fields and a deleted record."""
    head = struct.pack("<BBBBIHH", 0x03, 122, 7, 1, 3, 32 + 2 * 32 + 1 + 5, 1 + 300 + 4).ljust(32, b"\0")
    wide = b"NAME".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([300 & 255, 300 >> 8]) + b"\0" * 14
    number = b"X".ljust(11, b"\0") + b"F" + b"\0" * 4 + bytes([4, 1]) + b"\0" * 14
    records = [b" " + b"a" * 300 + b" 1.5", b"*" + b"b" * 300 + b" 2.5", b" " + "ü".encode("latin-1").ljust(300) + b"-3.0"]
    (tmp_path / "x.DBF").write_bytes(head + wide + number + b"\r" + b"\0" * 5 + b"".join(records))
    found = read_attributes(spark, str(tmp_path), encoding="latin-1").collect()
    assert [tuple(r) for r in found] == [("a" * 300, 1.5), ("ü", -3.0)]


def test_ranges_and_chosen_columns_equal_the_table(spark, tmp_path):
    table = spark.range(20_000).select(
        F.concat(F.lit("E"), F.lpad(F.col("id").cast("string"), 8, "0")).alias("LSOA11CD"),
        F.when(F.col("id") % 7 != 0, F.col("id") / 8).alias("Shape__Are"), F.col("id").alias("N"),
        F.date_format(F.date_add(F.lit("2000-01-01"), (F.col("id") % 900).cast("int")), "yyyyMMdd").alias("MADE"),
        F.when(F.col("id") % 3 == 0, "T").alias("OK"),
    )
    write_attributes(table.repartition(3), f"{tmp_path}/out", FIELDS, records_per_file=4000)
    found = read_attributes(spark, f"{tmp_path}/out", ["N", "Shape__Are"], partition_bytes=50_000)
    assert found.columns == ["N", "Shape__Are"] and found.rdd.getNumPartitions() > 15
    assert found.exceptAll(table.select("N", "Shape__Are")).isEmpty() and found.count() == 20_000
    dates = read_attributes(spark, f"file:{tmp_path}/out", ["MADE"])
    assert dates.exceptAll(table.select(F.to_date("MADE", "yyyyMMdd").alias("MADE"))).isEmpty()


def test_no_records(spark, tmp_path):
    assert read_attributes(spark, write(tmp_path / "a.dbf", [])).collect() == []


@pytest.mark.parametrize(
    "harm, says",
    [
        (lambda b: b[:20], "no header"), (lambda b: b[:50], "cut off|do not end"), (lambda b: b[:-30], "do not fit"),
        (lambda b: b[:10] + b"\x63\x00" + b[12:], "records 99"), (lambda b: b[:43] + b"M" + b[44:], "unknown type"),
        (lambda b: b[:192] + b"\x00" + b[193:], "do not end|cut off|unknown"), (lambda b: b.replace(b"12    ", b"1x    "), "field N"),
    ],
)
def test_broken_files_fail_by_name(spark, tmp_path, harm, says):
    path = write(tmp_path / "broken.dbf", ROWS)
    (tmp_path / "broken.dbf").write_bytes(harm((tmp_path / "broken.dbf").read_bytes()))
    with pytest.raises(Exception, match=f"(?s)broken.dbf.*({says})"):
        read_attributes(spark, path).collect()


def test_lacking_columns_and_files_fail(spark, tmp_path):
    path = write(tmp_path / "a.dbf", ROWS)
    with pytest.raises(Exception, match="no fields"):
        read_attributes(spark, path, ["OTHER"]).collect()
    with pytest.raises(Exception, match="FileNotFound|nowhere"):
        read_attributes(spark, f"{tmp_path}/nowhere.dbf").collect()
    with pytest.raises(ValueError, match="wider"):
        record_bytes(["0123456789"], [9])
