"""Long to wide and back, with the schema fixed when the plan is made."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlens.functions.columns import quoted
from peerlens.functions.missing import only_value


def _mapping(names: Mapping[str, str] | Sequence[str]) -> dict[str, str]:
    return dict(names) if isinstance(names, Mapping) else {n: n for n in names}


def long_to_wide(
    df: DataFrame,
    ids: Sequence[str],
    name_col: str,
    value_col: str,
    names: Mapping[str, str] | Sequence[str],
    absent: float | None = None,
) -> DataFrame:
    """One row per ``ids``, one column per listed name.

    ``names`` maps each value of ``name_col`` to its column, so no job has to
    look the values up first.  Two rows for the same id and name fail the job.
    ``absent`` fills only combinations that do not occur; a stored missing
    value stays missing.
    """
    names = _mapping(names)
    value = F.col(quoted(value_col))
    if absent is None:
        wide = df.groupBy(*ids).pivot(name_col, list(names)).agg(only_value(value, name_col))
        return wide.toDF(*ids, *names.values())
    wide = (
        df.groupBy(*ids)
        .pivot(name_col, list(names))
        .agg(only_value(F.struct(value.alias("v")), name_col))
        .toDF(*ids, *names.values())
    )
    filled = [
        F.when(F.col(quoted(c)).isNull(), F.lit(absent)).otherwise(F.col(quoted(c)).getField("v")).alias(c)
        for c in names.values()
    ]
    return wide.select(*ids, *filled)


def long_to_wide_many(
    df: DataFrame,
    ids: Sequence[str],
    name_col: str,
    value_cols: Sequence[str],
    names: Sequence[str],
    template: str = "{value}_{name}",
) -> DataFrame:
    """Several value columns at once, column names built from ``template``."""
    wide = (
        df.groupBy(*ids)
        .pivot(name_col, list(names))
        .agg(*[only_value(v, name_col).alias(v) for v in value_cols])
    )
    by_name = [template.format(value=v, name=n) for n in names for v in value_cols]
    ordered = [template.format(value=v, name=n) for v in value_cols for n in names]
    return wide.toDF(*ids, *by_name).select(*ids, *[F.col(quoted(c)) for c in ordered])


def wide_to_long(
    df: DataFrame,
    ids: Sequence[str],
    columns: Sequence[str] | None = None,
    name: str = "metric",
    value: str = "value",
) -> DataFrame:
    """Unpivot the columns (all but the ids by default); missing values keep their row."""
    columns = [c for c in df.columns if c not in ids] if columns is None else list(columns)
    widened = df.select(*ids, *[F.col(quoted(c)).cast("double").alias(c) for c in columns])
    return widened.unpivot(list(ids), columns, name, value)
