"""Left lookups and the guarded feature join.

No broadcast hints on lookups: Spark broadcasts a side only when its size is
known to be under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts
and merges, with skewed partitions split at run time.  Such hints are given only
where rows of a stored table were counted first; chains of tables as long as
their base are always merged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlens.functions.columns import quoted
from peerlens.sources.staging import stage

BROADCAST_BYTES = 256 * 1024 * 1024


#: A key with more than this share of the rows is hot, so there are at most 1024 hot keys.
HOT_SHARE = 1 / 1024


def hot_keys(big: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """The keys that hold more than ``share`` of the rows: a stored table of less than 1 / ``share`` rows.

    Rows are counted where they are read, so what is shuffled is a row a task and key.
    """
    counts = stage(big.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows")), "key-counts")
    limit = (counts.agg(F.sum("rows")).first()[0] or 0) * share
    return stage(counts.where(F.col("rows") > limit).select(key), "hot-keys")


def heavy_hitter_join(big: DataFrame, small: DataFrame, key: str, how: str = "inner", share: float = HOT_SHARE) -> DataFrame:
    """``big`` joined with ``small`` on ``key``, whatever share of the rows one key holds.

    Rows of hot keys stay where they are and meet the few rows that ``small``
    has for these keys by broadcast; the others, none of which can fill a task,
    are sorted and merged.  ``how`` is ``inner`` or ``left``; a missing key
    matches nothing.  ``big`` is read twice, so it should be a stored table or
    a scan.  For ``small`` with few rows a key, as in a lookup: what is broadcast
    are the rows of at most 1 / ``share`` keys.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"no {how} join here")
    hot = hot_keys(big, key, share)
    is_hot = hot.withColumn("is_hot", F.lit(True))
    hot_rows = big.join(F.broadcast(hot), key, "left_semi")
    hot_side = small.join(F.broadcast(is_hot), key).drop("is_hot")
    joined = hot_rows.join(F.broadcast(hot_side), key, how)
    rest = big.join(F.broadcast(hot), key, "left_anti").join(small.hint("merge"), key, how)
    return joined.unionByName(rest)


class FeatureNameClash(ValueError):
    """A feature table brings a column the index already has."""


def left_lookup(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[tuple[str, str]],
    null_safe: bool = False,
) -> DataFrame:
    """Left join on ``(left name, right name)`` pairs; the right keys are dropped.

    ``null_safe`` lets a missing key meet a missing key (still an equi-join).
    """
    renamed = {r: f"__{i}_{r}" for i, (_, r) in enumerate(keys)}
    side = right.withColumnsRenamed(renamed)
    condition = None
    for l_name, r_name in keys:
        a, b = left[quoted(l_name)], side[quoted(renamed[r_name])]
        term = a.eqNullSafe(b) if null_safe else a == b
        condition = term if condition is None else condition & term
    return left.join(side, condition, "left").drop(*renamed.values())


def unique_by(df: DataFrame, key: str, what: str) -> DataFrame:
    """The rows of a lookup; two rows with one key fail the job by name.  Rows without a key meet nothing and are not judged."""
    rest = [c for c in df.columns if c != key]
    named = F.concat(F.lit(f"{what}: more than one row for "), F.coalesce(F.col(quoted(key)).cast("string"), F.lit("NULL")))
    row = F.first(F.struct(*[F.col(quoted(c)) for c in rest]))
    counted = df.groupBy(quoted(key)).agg(F.count(F.lit(1)).alias("__rows"), row.alias("__row"))
    checked = F.when((F.col("__rows") == 1) | F.col(quoted(key)).isNull(), F.col("__row")).otherwise(F.raise_error(named))
    one = counted.select(F.col(quoted(key)), checked.alias("__row"))
    return one.select(F.col(quoted(key)), *[F.col("__row").getField(c).alias(c) for c in rest]).select(*map(quoted, df.columns))


def clashing_names(features: DataFrame, index: DataFrame, key: str) -> list[str]:
    """Feature columns that collide with the index, compared without case."""
    taken = {c.lower() for c in index.columns}
    return [c for c in features.columns if c != key and c.lower() in taken]


def guarded_feature_join(index: DataFrame, features: DataFrame, key: str, feature_key: str | None = None) -> DataFrame:
    """Left-join a feature table to the index; any name clash is an error."""
    if feature_key is not None and feature_key != key:
        features = features.withColumnRenamed(feature_key, key)
    clash = clashing_names(features, index, key)
    if clash:
        raise FeatureNameClash(f"already in the index: {', '.join(clash)}")
    return index.join(features, key, "left")


def chain_left(base: DataFrame, others: Sequence[DataFrame], key: str) -> DataFrame:
    """Left-join several tables on one key; the key's partitioning is reused.

    Every table is as long as the base, so all are sorted and merged: sizes
    guessed from packed files are far below those of the rows in memory, and
    several such tables broadcast at once do not fit in the driver.
    """
    out = base
    for other in others:
        out = out.join(other.hint("merge"), key, "left")
    return out


def registered_only(orgs: DataFrame, registrations: DataFrame, key: str) -> DataFrame:
    """Organisations that occur in the registrations.

    The registrations are reduced to their distinct keys first, on the map side
    already, so the join never shuffles them row by row.
    """
    return orgs.join(registrations.select(F.col(quoted(key))).distinct(), key, "left_semi")
