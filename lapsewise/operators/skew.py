"""Joins and keys that stand a key with very many rows.

Sums, counts, minima and maxima need no care: Spark combines them on the map side, so a hot key
arrives at its reducer as one row per task. Inner joins need none either: adaptive execution
splits an overfull partition of either side. An outer join it can split on one side only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_names(key: str | Sequence[str]) -> list[str]:
    """A key is one column name or a list of them."""
    return [key] if isinstance(key, str) else list(key)


def same_key(keys: Sequence[str], prefix: str) -> Column:
    """Null-safe match of ``keys`` with the other side's prefixed copies."""
    return reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys]
    )


def prefixed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """``df`` with its key columns renamed, so that a join condition is unambiguous."""
    return df.withColumnsRenamed({k: f"{prefix}{k}" for k in keys})


def attach_group_values(df: DataFrame, values: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Add per-group ``values`` (one row per group) to every row of ``df``, by an inner join.

    Groups missing from ``values`` are left out.
    """
    keys = as_names(key)
    joined = df.join(prefixed(values, keys, "__val_"), same_key(keys, "__val_"))
    return joined.drop(*[f"__val_{k}" for k in keys])


def left_join_many(
    left: DataFrame, many: DataFrame, key: str | Sequence[str], salts: int = 1
) -> DataFrame:
    """Left equi-join whose right side may repeat a key any number of times.

    In a left outer join Spark cannot split the right side, so a key that fills it would end in
    one task. With ``salts`` above one the right rows of every key are dealt over so many buckets,
    and the left rows are copied to each. Rows are dealt by a hash of all their columns, so a task
    that runs again deals them as before; rows equal in every column are counted first and unfolded
    after the join, so copies cannot fill a bucket. A left row that meets nothing stays once.
    """
    keys = as_names(key)
    many = many.dropna(subset=keys)  # a null key never matches
    if salts <= 1:
        return left.join(many, keys, "left")
    others = [c for c in many.columns if c not in keys]
    dealt = (
        many.groupBy(*many.columns)
        .agg(F.count(F.lit(1)).alias("__copies"))
        .withColumn("__salt", F.pmod(F.xxhash64(*many.columns), F.lit(salts)).cast("int"))
    )
    first = dealt.groupBy(*keys).agg(F.min("__salt").alias("__first"))
    # A key on the right needs its left rows in all buckets; any other key in one.
    copied = left.join(first, keys, "left").withColumn(
        "__salt",
        F.explode(F.sequence(F.lit(0), F.when(F.col("__first").isNull(), F.lit(0)).otherwise(F.lit(salts - 1)))),
    )
    joined = copied.join(dealt, [*keys, "__salt"], "left")
    met = joined.where(F.col("__copies").isNotNull() | F.col("__first").isNull())
    copies = F.sequence(F.lit(1).cast("long"), F.coalesce("__copies", F.lit(1)))
    return met.withColumn("__copy", F.explode(copies)).select(*left.columns, *others)
