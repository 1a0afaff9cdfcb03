"""Delimited files with lines that do not fit: the good rows, and the others by file and line.

One pass parses the files as they are and tells good rows from bad ones.  Where
these stand is found, when that is asked for, by reading the files as text:
Spark reads a file in blocks, so a line's number is its place in its block and
the lines of the blocks before.  No line is shuffled but the bad ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from peerlens.sources.readers import MISSING_TEXT

CORRUPT, REASON = "__corrupt", "__reason"
QUOTED = r'"(?:[^"]|"")*"'


class BadLines(ValueError):
    """More lines than allowed do not fit; says where the first ones are."""


@dataclass
class Checked:
    """Good rows; bad lines ``(file, line, reason, text)``; how many of each there are."""

    rows: DataFrame
    bad: DataFrame
    n_rows: int
    n_bad: int


def _options(header: bool) -> dict[str, str]:
    return {
        "header": str(header).lower(),
        "nullValue": MISSING_TEXT,
        "escape": '"',
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
    }


def _width(spark: SparkSession, path: str) -> int:
    """Fields of the first line."""
    first = spark.read.text(path).select(_fields(F.col("value")).alias("n")).first()
    if first is None:
        raise BadLines(f"{path} has no lines")
    return first.n


def _fields(line: Column) -> Column:
    """Number of fields: separators outside quotes, and one."""
    bare = F.regexp_replace(line, QUOTED, "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def _mistyped(fields: Sequence[tuple[int, str, str]]) -> Column:
    """The name of the first column whose value does not fit its type, null if all do."""
    tests = [
        F.when(F.col(f"c{p}").isNotNull() & F.expr(f"try_cast(c{p} AS {kind}) IS NULL"), F.lit(f"{name} is no {kind}"))
        for p, name, kind in fields
    ]
    return F.coalesce(*tests, F.lit(None).cast("string"))


def read_csv_checked(
    spark: SparkSession, path: str, fields: Sequence[tuple[int, str, str]], header: bool = True, most_bad: float = 0.0
) -> Checked:
    """Chosen 1-based columns ``(position, name, type)`` of a file or folder, bad lines set apart.

    A line is bad if it has more or fewer fields than the first one, or if a
    chosen value does not fit its type.  Blank lines do not count.  If more than
    the share ``most_bad`` of the lines are bad, the read fails and names the
    first of them.  Every file has its own header line; quoted line ends are not
    supported.
    """
    width = _width(spark, path)
    if max(p for p, _, _ in fields) > width:
        raise BadLines(f"{path} has {width} columns")
    schema = ", ".join(f"c{i} string" for i in range(1, width + 1)) + f", {CORRUPT} string"
    parsed = spark.read.schema(schema).options(**_options(header)).option("columnPruning", False).csv(path)
    fits = F.col(CORRUPT).isNull() & _mistyped(fields).isNull()
    typed = [F.expr(f"try_cast(c{p} AS {kind})").alias(name) for p, name, kind in fields]
    rows = parsed.where(fits).select(*typed)
    # All columns are named, as Spark does not count by the corrupt column alone.
    n, n_bad = parsed.select(*parsed.columns).agg(F.count(F.struct(*parsed.columns)), F.count_if(~fits)).first()
    bad = _bad_lines(spark, path, schema, fields, header, width)
    if n_bad > most_bad * n:
        first = "; ".join(f"{r.file}:{r.line}: {r.reason}" for r in bad.orderBy("file", "line").limit(5).collect())
        raise BadLines(f"{n_bad} of {n} lines of {path} do not fit: {first}")
    return Checked(rows, bad, n - n_bad, n_bad)


def _bad_lines(
    spark: SparkSession, path: str, schema: str, fields: Sequence[tuple[int, str, str]], header: bool, width: int
) -> DataFrame:
    where = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    # Rows of a block are read one after the other, so their ids are consecutive.
    lines = spark.read.text(path).select(*where, F.monotonically_increasing_id().alias("id"), F.col("value").alias("text"))
    blocks = lines.groupBy("file", "start").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("lines"))
    before = F.sum("lines").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select("file", "start", "first", F.coalesce(before, F.lit(0)).alias("before"))

    parsed = lines.where(F.trim("text") != "").withColumn("row", F.from_csv("text", schema, _options(False)))
    parsed = parsed.select("file", "start", "id", "text", "row.*")
    n = _fields(F.col("text"))
    reason = F.when(n != width, F.concat(n, F.lit(f" fields, not {width}")))
    reason = F.coalesce(reason, F.when(F.col(CORRUPT).isNotNull(), F.lit("not parsed")), _mistyped(fields))
    found = parsed.withColumn(REASON, reason).where(F.col(REASON).isNotNull()).select("file", "start", "id", "text", REASON)
    placed = found.join(blocks, ["file", "start"])
    line = F.col("before") + F.col("id") - F.col("first") + 1
    numbered = placed.select("file", line.alias("line"), F.col(REASON).alias("reason"), "text")
    return numbered.where("line > 1") if header else numbered


def read_csv_parts_checked(
    spark: SparkSession, paths: Sequence[str], fields: Sequence[tuple[int, str, str]], most_bad: float = 0.0
) -> Checked:
    """Several extracts of one layout under one another; the share counts for each."""
    parts = [read_csv_checked(spark, p, fields, True, most_bad) for p in paths]
    rows, bad = parts[0].rows, parts[0].bad
    for part in parts[1:]:
        rows, bad = rows.unionByName(part.rows), bad.unionByName(part.bad)
    return Checked(rows, bad, sum(p.n_rows for p in parts), sum(p.n_bad for p in parts))

