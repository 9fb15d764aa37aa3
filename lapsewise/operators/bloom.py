"""A blocked Bloom filter as a table, to drop rows before they are shuffled.

A key sets ``_BITS`` bits of one 64-bit word out of ``WORDS``. The filter has a row for each word that is not
empty, so however many keys there are it has a bounded size and can be sent to every task. With very many
keys it lets everything pass; what passes is to be checked exactly in any case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of a filter: 2 MB with their numbers, some 8 bits for each of a million keys.
WORDS = 1 << 17
_BITS = 4


def _word(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(WORDS)).cast("int")


def _mask() -> Column:
    """Bits of the key whose hash is in ``__drawn``."""
    return F.expr(" | ".join(f"shiftleft(1L, cast(__drawn >> {6 * i} & 63 AS int))" for i in range(_BITS)))


def bloom_filter(keys: DataFrame, column: str) -> DataFrame:
    """(``__word``, ``__set``) of all keys; nulls are none."""
    drawn = keys.where(F.col(column).isNotNull()).select(
        _word(F.col(column)).alias("__word"), F.xxhash64(column, F.lit(1)).alias("__drawn")
    )
    return drawn.groupBy("__word").agg(F.bit_or(_mask()).alias("__set"))


def possible_members(rows: DataFrame, column: str, filter_: DataFrame) -> DataFrame:
    """The rows whose key may be in the filter: all that are, and a few others. No row is shuffled."""
    probed = rows.withColumns({"__word": _word(F.col(column)), "__drawn": F.xxhash64(column, F.lit(1))})
    probed = probed.withColumn("__mask", _mask())
    # Bounded by WORDS rows, whatever the keys.
    hit = F.col("__set").bitwiseAND(F.col("__mask")) == F.col("__mask")
    met = probed.join(F.broadcast(filter_.withColumnRenamed("__word", "__at")), (F.col("__word") == F.col("__at")) & hit, "left_semi")
    return met.drop("__word", "__drawn", "__mask")
