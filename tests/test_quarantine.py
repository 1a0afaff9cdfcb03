"""Lines that do not fit, by file and line."""

import pytest

from peerlens.sources.quarantine import BadLines, read_csv_checked, read_csv_parts_checked

FIELDS = [(1, "code", "string"), (3, "n", "int"), (4, "x", "double")]


def write(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


LINES = [
    "code,name,n,x",
    "a,one,1,1.5",
    "b,two,2",  # 3: short
    'c,"three, or 3",3,NA',
    "",
    "d,four,4,4.5,more",  # 6: long
    "e,five,five,5.5",  # 7: no int
    'f,"say ""six""",6,6.5',
    "g,seven,7,x7",  # 9: no double
    "h,eight,NA,8.5",
]


def test_short_long_and_mistyped_lines(spark, tmp_path):
    path = write(tmp_path / "one.csv", LINES)
    found = read_csv_checked(spark, path, FIELDS, most_bad=0.5)
    assert sorted(tuple(r) for r in found.rows.collect() if r.code != "h") == [("a", 1, 1.5), ("c", 3, None), ("f", 6, 6.5)]
    assert [tuple(r) for r in found.rows.where("code = 'h'").collect()] == [("h", None, 8.5)]
    bad = found.bad.orderBy("line").collect()
    assert [(r.line, r.reason) for r in bad] == [
        (3, "3 fields, not 4"), (6, "5 fields, not 4"), (7, "n is no int"), (9, "x is no double"),
    ]
    assert bad[0].text == "b,two,2" and bad[0].file.endswith("one.csv")
    assert (found.n_rows, found.n_bad) == (4, 4)


def test_too_many_fail_with_their_lines(spark, tmp_path):
    path = write(tmp_path / "one.csv", LINES)
    with pytest.raises(BadLines, match=r"4 of 8 lines .*one.csv:3: 3 fields, not 4; .*one.csv:6"):
        read_csv_checked(spark, path, FIELDS, most_bad=0.4)
    clean = write(tmp_path / "clean.csv", LINES[:2])
    found = read_csv_checked(spark, clean, FIELDS)
    assert (found.n_rows, found.n_bad, found.bad.count()) == (1, 0, 0)


def test_lines_of_files_read_in_blocks(spark, tmp_path):
    lines = ["code,name,n,x"] + [f"k{i},some name,{i},{'bad' if i % 997 == 5 else i / 2}" for i in range(20_000)]
    (tmp_path / "many").mkdir()
    write(tmp_path / "many" / "a.csv", lines)
    write(tmp_path / "many" / "b.csv", [lines[0], "short,line", *lines[1:50]])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    try:
        found = read_csv_checked(spark, f"{tmp_path}/many", FIELDS, most_bad=0.1)
        got = {(r.file.rpartition("/")[2], r.line) for r in found.bad.collect()}
        assert found.rows.count() == found.n_rows
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = {("a.csv", i + 2) for i in range(20_000) if i % 997 == 5} | {("b.csv", 2), ("b.csv", 5 + 3)}
    assert got == want and found.n_bad == len(want)


def test_several_extracts_and_no_header(spark, tmp_path):
    paths = [write(tmp_path / f"{i}.csv", LINES[: 4 + i]) for i in range(3)]
    found = read_csv_parts_checked(spark, paths, FIELDS, most_bad=0.5)
    assert found.n_bad == 4 and {r.line for r in found.bad.collect()} == {3, 6}
    bare = write(tmp_path / "bare.csv", LINES[1:3])
    found = read_csv_checked(spark, bare, FIELDS, header=False, most_bad=0.5)
    assert [(r.line, r.reason) for r in found.bad.collect()] == [(2, "3 fields, not 4")]


def test_empty_files(spark, tmp_path):
    (tmp_path / "none.csv").write_text("")
    with pytest.raises(BadLines, match="no lines"):
        read_csv_checked(spark, f"{tmp_path}/none.csv", [(1, "a", "string")])
    only = write(tmp_path / "only.csv", LINES[:1])
    assert read_csv_checked(spark, only, FIELDS).n_rows == 0
    with pytest.raises(BadLines, match="4 columns"):
        read_csv_checked(spark, only, [(9, "z", "int")])
