"""One row per subscriber and period, kept in tables bucketed by the subscriber.

Labels and training tables need of a month only what can be said of each subscriber in one row: first and last
activity, and the features. ``fold`` brings a month down to that, reading no other month, and keeps
it in tables that are bucketed and sorted by the subscriber. What is asked later joins such tables
bucket by bucket: nothing is shuffled by the subscriber any more. As a subscriber has one row in each, a very
active one makes no bucket larger than others (a user table that repeats a key keeps its rows).
"""

from __future__ import annotations

import datetime as dt
import hashlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise.operators.activity import CHURN_AFTER_DAYS, activity_stream, churn_flag
from lapsewise.operators.features import (
    Features,
    merge_dataframes,
    prepare_package_df,
    prepare_recharge_df,
    prepare_user_df,
)
from lapsewise.operators.sketches import merge_sketches, sketch_by, summarise_sketches
from lapsewise.sources.catalog import Catalog

_KEY = "bib_id"
#: The layouts of the stored tables.
_LAYOUTS = {
    "activity": "bib_id string, first_seen timestamp, last_seen timestamp",
    "package": "bib_id string, AveragePackageAmount double, MedianPackageAmount double, AveragePackageDuration double, "
    "MedianPackageDuration double, CountPackage bigint",
    "recharge": "bib_id string, AverageRechargeAmount double, MedianRechargeAmount double, CountRecharge bigint",
    "user": "bib_id string, contract_type_v string, gender_v string, registration_date_d string, "
    "date_of_birth_d string, ability_status string, account_balance double",
    "recharge_sketch": "bib_id string, rows bigint, n_recharge_value_amt bigint, sum_recharge_value_amt double, "
    "sketch_recharge_value_amt binary",
    "package_sketch": "bib_id string, rows bigint, n_offer_amount bigint, sum_offer_amount double, sketch_offer_amount binary",
}
#: Of each kind of sketch: the amount that it is of, and what its features are called.
_SKETCHES = {"recharge_sketch": ("recharge_value_amt", "Recharge"), "package_sketch": ("offer_amount", "Package")}


@dataclass(frozen=True)
class SubscriberStore:
    """Bucketed tables below ``folder``, one for each kind and period.

    ``buckets`` is fixed when a store is begun: tables with other numbers of buckets would be shuffled to meet. A
    store that an earlier session wrote is found again by its folder.
    """

    spark: SparkSession
    folder: str
    buckets: int = 64

    def _name(self, kind: str, period: int) -> str:
        return f"subscribers_{hashlib.md5(self.folder.encode()).hexdigest()[:12]}_{kind}_{period}"

    def _path(self, kind: str, period: int) -> str:
        return f"{self.folder.rstrip('/')}/{kind}/period={period}"

    def _keep(self, kind: str, period: int, rows: DataFrame) -> None:
        columns = [part.split()[0] for part in _LAYOUTS[kind].split(", ")]
        rows = rows.select(F.col(_KEY).cast("string").alias(_KEY), *columns[1:])
        # Dealt as buckets are, so that each bucket is one file.
        dealt = rows.repartition(self.buckets, _KEY).sortWithinPartitions(_KEY)
        writer = dealt.write.mode("overwrite").format("parquet").bucketBy(self.buckets, _KEY).sortBy(_KEY)
        writer.option("path", self._path(kind, period)).saveAsTable(self._name(kind, period))

    def table(self, kind: str, period: int) -> DataFrame:
        """One kind of row of one period; the table is made known to the session if it isn't."""
        name = self._name(kind, period)
        if not self.spark.catalog.tableExists(name):
            place = self.spark._jvm.org.apache.hadoop.fs.Path(self._path(kind, period))
            if not place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place):
                raise ValueError(f"period {period} has not been folded in: no {kind} at {self._path(kind, period)!r}")
            location = self._path(kind, period).replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE {name} ({_LAYOUTS[kind]}) USING parquet "
                f"CLUSTERED BY ({_KEY}) SORTED BY ({_KEY}) INTO {self.buckets} BUCKETS LOCATION '{location}'"
            )
        return self.spark.table(name)

    def fold(self, catalog: Catalog, month: str, features: bool = True) -> None:
        """Take a month in, or in anew, from its own stored tables alone."""
        period = catalog.period(month)
        package, recharge = catalog.read("package", month), catalog.read("recharge", month)
        seen = activity_stream(package, recharge).groupBy(_KEY)
        self._keep("activity", period, seen.agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen")))
        if features:
            self._keep("package", period, prepare_package_df(package))
            self._keep("recharge", period, prepare_recharge_df(recharge))
            self._keep("user", period, catalog.read("user", month))
            for kind, rows in (("recharge_sketch", recharge), ("package_sketch", package)):
                self._keep(kind, period, sketch_by(rows, _KEY, [_SKETCHES[kind][0]]))

    def churn_label(self, period: int, threshold_days: int = CHURN_AFTER_DAYS) -> DataFrame:
        """``(bib_id, label)`` of a period, judged by the one after it; no shuffle."""
        now = self.table("activity", period).select(_KEY, "last_seen")
        then = self.table("activity", period + 1).select(_KEY, F.col("first_seen").alias("next_seen"))
        flag = churn_flag(F.col("last_seen"), F.col("next_seen"), threshold_days)
        return now.join(then, _KEY, "left").select(_KEY, flag.alias("label"))

    def churn_labels(self, periods: int, threshold_days: int = CHURN_AFTER_DAYS) -> DataFrame:
        """``(bib_id, period, label)`` of all of the first ``periods`` periods but the last."""
        each = [
            self.churn_label(p, threshold_days).select(_KEY, F.lit(p).alias("period"), "label") for p in range(periods - 1)
        ]
        return reduce(DataFrame.unionAll, each)

    def training_table(
        self, period: int, as_of: dt.date | str | None = None, threshold_days: int = CHURN_AFTER_DAYS
    ) -> DataFrame:
        """The label of a period with its features; no shuffle."""
        user = prepare_user_df(self.table("user", period), as_of)
        features = Features(None, None, self.table("package", period), self.table("recharge", period), user)
        return merge_dataframes(features, self.churn_label(period, threshold_days))

    def features_over(self, kind: str, periods: list[int]) -> DataFrame:
        """Mean, approximate median and number of a subscriber's recharges (``recharge_sketch``) or packages
        (``package_sketch``) over some periods, from what was kept of each."""
        amount, name = _SKETCHES[kind]
        # Read as files: a union of bucketed tables counts as dealt by the subscriber already, and Spark 4.1
        # then leaves out both the shuffle and the bucket-wise reading, which parts a subscriber's rows.
        each = self.spark.read.schema(_LAYOUTS[kind]).parquet(*[self._path(kind, p) for p in periods])
        return summarise_sketches(
            merge_sketches(each, _KEY, [amount]),
            _KEY,
            {amount: {f"Median{name}Amount": 0.5}},
            {amount: f"Average{name}Amount"},
            f"Count{name}",
        )
