"""Mixing sources to target weights by a curriculum that changes over training time.

Each source has a weight that varies over training time 0 to 1. Its integral says how many words of
the source the mix wants (no more than the source has, times the allowed repeats; what that leaves
over goes to the other sources by weight). The running integral is the source's cumulative demand:
a document whose words lie at u of all words that the source gives is wanted at the time when u
of its demand has been met. So each document's place in its source is turned into a training position
by inverting the demand, and sorting all documents by position, over ranges, is the curriculum.

Nothing is gathered by source. Word counts are written once, and all else works on those small
rows. Running sums within a source are taken in two steps, over buckets of a hash of the document
and inside each bucket, so a source with a third of all documents is spread over as many tasks as
any other rows. The hash depends on the document alone, so reruns agree.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lapsewise.llm.store import drop, written

#: The mix has so many words for each one given, and takes no document more often than this.
SHARE = 1.5
REPEATS = 2
#: About so many rows come into one bucket of a source.
BUCKET_ROWS = 1 << 14
_KEY_BITS = 60


@dataclass(frozen=True)
class Schedule:
    """A source's weight over training time, linear between knots (time, weight) from 0 to 1."""

    knots: tuple[tuple[float, float], ...]

    def __post_init__(self) -> None:
        times = [t for t, _ in self.knots]
        if len(times) < 2 or times[0] != 0 or times[-1] != 1 or any(b <= a for a, b in zip(times, times[1:])):
            raise ValueError("knots need increasing times from 0 to 1")
        if any(w < 0 for _, w in self.knots):
            raise ValueError("weights must not be negative")

    def _pieces(self):
        """Start, length, first and last weight of each linear piece, and the integral before it."""
        before = 0.0
        for (t0, w0), (t1, w1) in zip(self.knots, self.knots[1:]):
            yield t0, t1 - t0, w0, w1, before
            before += (w0 + w1) / 2 * (t1 - t0)

    @property
    def integral(self) -> float:
        return sum((w0 + w1) / 2 * length for _, length, w0, w1, _ in self._pieces())

    def demand(self, t: float) -> float:
        """Integral of the weight up to time ``t``."""
        done = 0.0
        for start, length, w0, w1, before in self._pieces():
            x = min(max(t - start, 0.0), length)
            done = before + w0 * x + (w1 - w0) * x * x / (2 * length) if t >= start else done
        return done

    def time_of(self, met: Column) -> Column:
        """The time at which a part ``met`` (0 to 1) of the whole demand has been met."""
        wanted, out = met * self.integral, F.lit(0.0)
        for start, length, w0, w1, before in self._pieces():
            more = F.greatest(wanted - before, F.lit(0.0))
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + more * (2 * (w1 - w0) / length), F.lit(0.0)))
            inside = F.coalesce(2 * more / F.nullif(w0 + root, F.lit(0.0)), F.lit(0.0))
            out = F.when(wanted >= before, F.lit(start) + F.least(inside, F.lit(float(length)))).otherwise(out)
        return out


class Mix(NamedTuple):
    """``plan``: a row for each document; ``order``: a row for each time that one is taken."""

    plan: DataFrame
    order: DataFrame


def word_count(text: Column) -> Column:
    """Number of runs of characters other than space and 0x09-0x0D; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _numbered(sources: DataFrame) -> DataFrame:
    """``source_no``: the place of each source by code point from 0, null last. No task sorts all sources."""
    by = F.col("source").asc_nulls_last()
    ranged = sources.repartitionByRange(by).sortWithinPartitions(by)
    # Such an id is the partition's number, shifted by 33 bits, and the row's place in it.
    rows = written(ranged.withColumn("row_id", F.monotonically_increasing_id()), "sources")
    rows = rows.withColumn("shard", F.shiftright("row_id", 33))
    # One row for each partition goes through this window.
    earlier = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    shards = rows.groupBy("shard").agg(F.count("*").alias("n"))
    shards = shards.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    place = F.col("base") + F.col("row_id") - F.shiftleft("shard", 33)
    return rows.join(shards, "shard").select("source", "source_size", place.alias("source_no"))


def targets(sources: DataFrame, schedules: Sequence[Schedule], share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """``sources`` (source, source_size) with source_no, ``schedule`` (its number) and ``target`` words.

    Sources take the schedules in turn, by code point, null last. All targets add up to ``share``
    times all sizes, dealt by the schedules' integrals; none is above ``repeats`` times its
    source's size, and what that cuts off is dealt anew among the others until none is above.
    """
    rows = _numbered(sources).withColumn("schedule", (F.col("source_no") % len(schedules)).cast("int"))
    weight = F.element_at(F.array(*[F.lit(float(s.integral)) for s in schedules]), F.col("schedule") + 1)
    rows = rows.withColumns({"weight": weight, "most": F.col("source_size").cast("double") * repeats})
    whole = share * (rows.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:  # each turn fills one source more at least, as a rule several
        filled = F.col("most") <= F.lit(level) * F.col("weight")
        cut, open_, n = rows.agg(
            F.sum(F.when(filled, F.col("most"))), F.sum(F.when(~filled, F.col("weight"))), F.count(F.when(filled, 1))
        ).first()
        if n == full or not open_:
            break
        level, full = (whole - (cut or 0.0)) / open_, n
    target = F.when(filled, F.col("most")).otherwise(F.lit(level) * F.col("weight"))
    return rows.select("source", "source_no", "source_size", "schedule", target.alias("target"))


def _running(rows: DataFrame, bucket: Column, order: Sequence[str]) -> DataFrame:
    """``before``: the words of the rows that come earlier in the source; ``place``: how many rows do."""
    rows = rows.withColumn("bucket", bucket)
    earlier = W.partitionBy("source_no").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    parts = rows.groupBy("source_no", "bucket").agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
    parts = parts.select(
        "source_no",
        "bucket",
        F.coalesce(F.sum("words").over(earlier), zero).alias("words_base"),
        F.coalesce(F.sum("rows").over(earlier), zero).alias("rows_base"),
    )
    inside = W.partitionBy("source_no", "bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (
        rows.join(parts, ["source_no", "bucket"])
        .withColumns(
            {
                "before": F.col("words_base") + F.coalesce(F.sum("size").over(inside), zero),
                "place": F.col("rows_base") + F.coalesce(F.count("*").over(inside), zero),
            }
        )
        .drop("bucket", "words_base", "rows_base")
    )


def _first_fits(ranked: DataFrame) -> DataFrame:
    """source_no, place and ``part_at`` of the documents taken in the part of an epoch that is left over.

    In the order of their places, each document is taken that still fits what is left (``rest``) of its
    source's target. That is a stretch of documents up to one that doesn't fit, then a stretch of
    smaller ones, and so on: each turn finds one stretch of every source. ``part_at`` is the number
    of words taken before.
    """
    keys = ["source_no", "place"]
    fits = F.col("before") + F.col("size") <= F.col("room")
    turn = ranked.where("size > 0 AND rest >= 1")
    turn = turn.select(*keys, "size", "before", F.col("rest").alias("room"), F.lit(0).cast("bigint").alias("met"))
    found = []
    while True:
        found.append(turn.where(fits).select(*keys, (F.col("met") + F.col("before")).alias("part_at")))
        used = turn.groupBy("source_no").agg(F.coalesce(F.sum(F.when(fits, F.col("size"))), F.lit(0)).alias("used"))
        rest = turn.where(~fits).join(used, "source_no").where(F.col("size") <= F.col("room") - F.col("used"))
        rest = written(
            rest.select(*keys, "size", (F.col("room") - F.col("used")).alias("room"), (F.col("met") + F.col("used")).alias("met")),
            "unfitted",
        )
        if rest.isEmpty():
            return reduce(DataFrame.unionAll, found)
        rows = _running(rest.withColumnRenamed("place", "at"), F.floor(F.col("at") / BUCKET_ROWS), ["at"])
        turn = written(rows.select("source_no", F.col("at").alias("place"), "size", "before", "room", "met"), "turn")
        drop(rest)


def mix(
    docs: DataFrame,
    schedules: Sequence[Schedule],
    share: float = SHARE,
    repeats: int = REPEATS,
    whole: bool = False,
) -> Mix:
    """Mix ``docs`` (doc_id, source, text) by the schedules.

    ``plan`` has a row for each row of ``docs``: source_no and place (together the row's key),
    doc_id, source, size, source_size, target and ``copies``, the (copy, position) at which it is
    taken. Documents are taken whole: in each source all of them so often as the target covers the
    source, and then, in hash order, each that still fits. ``order`` has the copies alone, by
    position over ranges; with ``whole`` both carry the row of ``docs`` as ``document``.

    A null or empty text has size 0 and is never taken. Rows without source are a source, the last. Repeated rows
    and null ids are rows like others; equal rows are interchangeable. An empty table gives empty frames.
    Other columns are not read but for ``whole``.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text)
    key = F.conv(F.substring(F.md5(F.encode(name, "UTF-8")), 1, _KEY_BITS // 4), 16, 10).cast("bigint")
    carried = [F.struct(*docs.columns).alias("document")] if whole else []
    sized = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("key"), *carried), "sized")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    wanted = written(targets(sources, schedules, share, repeats), "targets")
    rows = sized.withColumnRenamed("source", "from").join(wanted, F.col("from").eqNullSafe(F.col("source"))).drop("from")
    bits = min(24, max(4, math.ceil(math.log2(max(1, sized.count()) / BUCKET_ROWS + 1))))
    epochs = F.least(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(repeats))
    rows = rows.withColumn("epochs", F.coalesce(epochs, F.lit(0)).cast("int"))
    rows = rows.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    ranked = _running(rows, F.shiftright("key", _KEY_BITS - bits), ["key", "doc_id", "size"])
    ranked = written(ranked.drop("key"), "ranked")
    parts = _first_fits(ranked)
    start = F.when(F.col("copy") < F.col("epochs"), F.col("before")).otherwise(F.col("part_at"))
    met = (F.col("copy") * F.col("source_size") + start + F.col("size") / 2) / F.col("target")
    position = F.lit(None).cast("double")
    for number, schedule in enumerate(schedules):
        position = F.when(F.col("schedule") == number, schedule.time_of(met)).otherwise(position)
    taken = F.when(F.col("size") == 0, F.lit(0)).otherwise(F.col("epochs") + F.col("part_at").isNotNull().cast("int"))
    keys = ["source_no", "place"]
    plan = ranked.join(parts, keys, "left").withColumn("taken", taken)
    copies = plan.where("taken > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("taken") - 1)))
    ordered = copies.select(*keys, "doc_id", "size", "copy", position.alias("position"), *(["document"] if whole else []))
    by = ["position", *keys]
    plan = plan.select(*keys, "doc_id", "source", "size", "source_size", "target", "taken", *(["document"] if whole else []))
    return Mix(plan, ordered.repartitionByRange(*by).sortWithinPartitions(*by))
