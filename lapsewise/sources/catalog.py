"""Where each (table, month) lives, and how to read it."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from lapsewise.sources.manifest import read_manifest
from lapsewise.sources.schemas import schema_for

CORRUPT_TEXT = "_corrupt_record"


class FeatureInputs(NamedTuple):
    """The tables one month's features are made of; the loan tables only if asked for."""

    assign: DataFrame | None
    recovery: DataFrame | None
    package: DataFrame
    recharge: DataFrame
    user: DataFrame


class LabelInputs(NamedTuple):
    """Activity tables of a month and of the one after it."""

    current_package: DataFrame
    current_recharge: DataFrame
    next_package: DataFrame
    next_recharge: DataFrame


@dataclass(frozen=True)
class Catalog:
    """Tables by key and month.

    Months are opaque text in the order of ``months``; the position in that list is the
    period number, and the month after is the next entry. A path is a template with
    ``{month}`` in it, below ``base`` if that is given.

    A Parquet template that ends in a folder like ``month={month}`` makes a partitioned table: all
    its months are one table, which is found and pruned by that column and stored in one job. Any
    other template is a folder for each month.
    """

    spark: SparkSession
    keys: Sequence[str]
    months: Sequence[str]
    csv_paths: Mapping[str, str]
    parquet_paths: Mapping[str, str]
    base: str = ""

    @classmethod
    def from_config(cls, spark: SparkSession, config: Mapping, base: str = "") -> Catalog:
        """From a dict with ``keys``, ``months`` and ``paths`` (``csv`` and ``parquet``
        templates per key), the last at the top or inside one of its sections."""
        sections = [config, *[v for v in config.values() if isinstance(v, Mapping)]]
        paths = next((s["paths"] for s in sections if "paths" in s), None)
        if paths is None:
            raise KeyError("the configuration has no 'paths'")
        return cls(
            spark, config["keys"], config["months"], paths.get("csv", {}), paths["parquet"], base
        )

    def _path(self, templates: Mapping[str, str], key: str, month: str) -> str:
        if key not in templates:
            raise KeyError(f"no path for table {key!r}")
        path = templates[key].format(month=month)
        return f"{self.base.rstrip('/')}/{path}" if self.base else path

    def csv_path(self, key: str, month: str) -> str:
        """Path of a month's CSV extract: a file, a folder or a glob."""
        return self._path(self.csv_paths, key, month)

    def parquet_path(self, key: str, month: str) -> str:
        """Folder of a month's Parquet files."""
        return self._path(self.parquet_paths, key, month)

    def period(self, month: str) -> int:
        """Position of a month in the list of months."""
        if month not in self.months:
            raise ValueError(f"unknown month {month!r}: expected one of {list(self.months)}")
        return list(self.months).index(month)

    def month_after(self, month: str) -> str:
        """The next month in the list; ``ValueError`` for the last one."""
        following = self.period(month) + 1
        if following == len(self.months):
            raise ValueError(f"no month follows {month!r}")
        return self.months[following]

    def partitioned(self, key: str) -> tuple[str, str] | None:
        """Root folder and partition column of a partitioned table, else nothing."""
        found = re.fullmatch(r"(?:(.*)/)?([^/{}=]+)=\{month\}/*", self.parquet_paths.get(key, ""))
        if not found:
            return None
        return self._path({key: found[1] or "."}, key, ""), found[2]

    def _stored(self, key: str, months: Sequence[str]) -> DataFrame:
        """The rows of some months, ``month`` being text as it is in the list of months.

        A partitioned table is one scan of its root, and Spark opens only files of the months wanted.
        Otherwise it is a scan for each month's folder, so no row's month hangs on how a path is written.
        """
        # Explicit layout: no footer is read to find it, and a folder without rows is an empty
        # table.
        layout = StructType(list(schema_for(key).fields)).add(CORRUPT_TEXT, StringType())
        table = self.partitioned(key)
        if table is None:
            each = [self.spark.read.schema(layout).parquet(self.parquet_path(key, m)).withColumn("month", F.lit(m)) for m in months]
            return reduce(DataFrame.unionAll, each)
        root, column = table
        # What a month left behind before it became empty is no longer part of it.
        known = read_manifest(self.spark, root)
        wanted = [m for m in months if m not in known or known[m]["rows"] + known[m]["quarantined"]]
        # Without the type given here, a month like "01" would be found as a number.
        rows = self.spark.read.schema(layout.add(column, StringType())).parquet(root)
        return rows.where(F.col(column).isin(wanted)).withColumnRenamed(column, "month")

    def read(self, key: str, months: str | Sequence[str] | None = None) -> DataFrame:
        """Good rows of a table. With one month as text: the table's own columns. With a list
        (or ``None``: all months) also ``month`` and its ``period`` number.

        Files of other writers, which know no bad rows, count as good.
        """
        names = schema_for(key).names
        good = F.col(CORRUPT_TEXT).isNull()
        if isinstance(months, str):
            self.period(months)
            return self._stored(key, [months]).where(good).select(*names)
        wanted = list(self.months if months is None else months)
        for m in wanted:
            self.period(m)
        period = F.array_position(F.array(*[F.lit(m) for m in self.months]), F.col("month")) - 1
        rows = self._stored(key, wanted).where(good)
        return rows.select(*names, "month", period.cast("int").alias("period"))

    def quarantine(self, key: str, months: Sequence[str] | None = None) -> DataFrame:
        """Rows that did not fit the layout: ``month`` and the line as it was read."""
        rows = self._stored(key, list(self.months if months is None else months))
        return rows.where(F.col(CORRUPT_TEXT).isNotNull()).select("month", CORRUPT_TEXT)

    def feature_inputs(self, month: str, include_loans: bool = False) -> FeatureInputs:
        """The inputs of one month's features."""
        return FeatureInputs(
            self.read("loan_assign", month) if include_loans else None,
            self.read("loan_recovery", month) if include_loans else None,
            self.read("package", month),
            self.read("recharge", month),
            self.read("user", month),
        )

    def label_inputs(self, current_month: str, next_month: str) -> LabelInputs:
        """Package and recharge tables of two months."""
        return LabelInputs(
            *[self.read(k, m) for m in (current_month, next_month) for k in ("package", "recharge")]
        )
