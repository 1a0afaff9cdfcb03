"""Column-name work: done on the driver against the schema, never on data."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column name safe to hand to ``F.col`` whatever it contains."""
    return "`" + name.replace("`", "``") + "`"


def pick_positions(df: DataFrame, fields: Sequence[tuple[int, str, str]]) -> DataFrame:
    """Select 1-based source positions as ``(position, name, type)``."""
    return df.select(
        *[F.col(quoted(df.columns[pos - 1])).cast(kind).alias(name) for pos, name, kind in fields]
    )


def names_containing(df: DataFrame, text: str) -> list[str]:
    """Column names containing ``text``, whatever the case."""
    return [c for c in df.columns if text.lower() in c.lower()]


def rename_all(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    """Rename every column by a function of its name."""
    return df.toDF(*[rule(c) for c in df.columns])


def over_columns(columns: Sequence[str], rule: Callable[[Column], Column]) -> list[Column]:
    """The same expression over several columns, names kept."""
    return [rule(F.col(quoted(c))).alias(c) for c in columns]
