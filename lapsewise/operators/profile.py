"""Counts, sums and rankings that describe one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.functions.timeparse import TIME_PARTS
from lapsewise.operators.skew import as_names


def sum_by(df: DataFrame, key: str | Sequence[str], amount: str, out: str | None = None) -> DataFrame:
    """Sum of ``amount`` per key, named ``SumAggregated_<amount>`` unless ``out`` is given."""
    return df.groupBy(*as_names(key)).agg(F.sum(amount).alias(out or f"SumAggregated_{amount}"))


def sum_by_time_part(
    df: DataFrame, timestamp_column: str, amount: str, out: str | None = None
) -> DataFrame:
    """Sum of ``amount`` by hour, by weekday (1 = Sunday) and by day of month.

    Long form: ``part``, ``value`` and the sum. Rows without a timestamp form a null group
    in each part. The rows are grouped once, by all three parts together (at most
    25 x 8 x 32 groups), and only those groups are unfolded into the three profiles.
    """
    out = out or f"sum_{amount}"
    cells = df.groupBy(
        *[part(F.col(timestamp_column)).alias(name) for name, part in TIME_PARTS.items()]
    ).agg(F.sum(amount).alias("__sum"))
    unfolded = F.inline(
        F.array(
            *[
                F.struct(F.lit(name).alias("part"), F.col(name).alias("value"))
                for name in TIME_PARTS
            ]
        )
    )
    return (
        cells.select("__sum", unfolded)
        .groupBy("part", "value")
        .agg(F.sum("__sum").alias(out))
        .orderBy("part", "value")
    )


def count_by(df: DataFrame, key: str | Sequence[str], weight: str | None = None) -> DataFrame:
    """Rows per category, nulls included. ``weight`` names a column of counts made before."""
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(*as_names(key)).agg(rows.alias("count"))


def top_k(df: DataFrame, col_name: str, k: int, weight: str | None = None) -> DataFrame:
    """The ``k`` most frequent values; of equally frequent ones the smaller comes first."""
    return count_by(df, col_name, weight).orderBy(F.desc("count"), F.asc_nulls_first(col_name)).limit(k)


def value_counts(df: DataFrame, col_name: str) -> DataFrame:
    """Rows per value, most frequent first, without nulls."""
    counted = count_by(df.where(F.col(col_name).isNotNull()), col_name)
    return counted.orderBy(F.desc("count"), F.asc(col_name))


def top_k_of_many(df: DataFrame, col_name: str, k: int, slots: int = 1 << 16) -> DataFrame:
    """As :func:`top_k`, for a column of so many values that counting them all would shuffle most rows.

    Rows are first counted by a hash of the value in ``slots`` slots: a value has no more rows than its slot.
    The values in the fullest slots are counted exactly, and the k-th count among them is one that
    the answer must reach; only values in slots that reach it are counted in the end. So what is
    shuffled by value are candidates, and the result is exact, ties included. The table is read three times.
    """
    slot = F.pmod(F.xxhash64(col_name), F.lit(slots)).cast("int")
    rows = df.select(col_name, slot.alias("__slot"))
    counts = rows.groupBy("__slot").agg(F.count(F.lit(1)).alias("__rows"))

    def of(chosen: DataFrame) -> DataFrame:
        # No more rows than slots, so they can be sent to every task.
        return count_by(rows.join(F.broadcast(chosen.select("__slot")), "__slot", "left_semi"), col_name)

    first = of(counts.orderBy(F.desc("__rows"), "__slot").limit(2 * k)).orderBy(F.desc("count")).limit(k)
    reach = first.agg(F.when(F.count(F.lit(1)) == k, F.min("count")).otherwise(F.lit(0))).scalar()
    found = of(counts.where(F.col("__rows") >= reach))
    return found.orderBy(F.desc("count"), F.asc_nulls_first(col_name)).limit(k)


def preview_sample(df: DataFrame, n: int = 20, seed: int = 0) -> DataFrame:
    """``n`` rows drawn by a hash of their content: the same whatever the order or partitions of ``df``.

    One pass that keeps ``n`` rows a task. Equal rows have equal hashes and come together.
    """
    text = F.concat_ws("\x1f", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in df.columns])
    return df.withColumn("__drawn", F.md5(F.encode(text, "UTF-8"))).orderBy("__drawn").limit(n).drop("__drawn")


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """Any ``n`` rows, to look at."""
    return df.limit(n)
