"""Time the registered queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local cores. Each query is
built and fully evaluated (no-op sink, so that nothing is pruned but what the plan prunes
itself); the better of two runs counts. ``--shapes`` also times, for the composite
operators, the plain multi-join, multi-job way of asking for the same result.
"""

from __future__ import annotations

import json
import os
import sys
import time

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise.workload.domain import Domain
from lapsewise.workload.registry import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 2


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("lapsewise-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "4g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def best_of(action, runs: int = RUNS) -> float:
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def plain_shapes(d: Domain) -> dict:
    """The same results asked for with one job per part: outer joins, repeated scans."""

    def label():
        sides = []
        for period, pick, across in ((0, F.max, F.greatest), (1, F.min, F.least)):
            p = d.signups(period).groupBy("bib_id").agg(pick("activation_date").alias("p"))
            r = d.purchases(period).groupBy("bib_id").agg(pick("recharge_dt").alias("r"))
            both = p.join(r, "bib_id", "full_outer")
            sides.append(both.select("bib_id", across("p", "r").alias(f"t{period}")))
        flag = F.when(F.col("t1").isNull() | (F.datediff("t1", "t0") > 2), 1).otherwise(0)
        return sides[0].join(sides[1], "bib_id", "left").select("bib_id", flag.alias("label"))

    def package():
        days = F.datediff("deactivation_date", "activation_date")
        return d.package().withColumn("days", days).groupBy("bib_id").agg(
            F.mean("offer_amount"), F.median("offer_amount"), F.mean("days"), F.median("days"),
            F.count("*"),
        )

    def recharge():
        return d.recharge().groupBy("bib_id").agg(
            F.mean("recharge_value_amt"), F.median("recharge_value_amt"), F.count("*")
        )

    def training():
        wide = label().join(package(), "bib_id", "left")
        return wide.join(
            recharge().withColumnsRenamed({"count(1)": "n"}), "bib_id", "left"
        ).join(d.user(), "bib_id", "left")

    def profile():
        loans = d.loan_assign()
        for part in (F.hour, F.dayofweek, F.dayofmonth):
            run(loans.groupBy(part("date_timestamp").alias("k")).agg(F.sum("loan_amount")))

    def ratio():
        d.loan_assign().createOrReplaceTempView("assigned")
        d.loan_recovery().createOrReplaceTempView("paid")
        for amount in ("loan_amount", "hsdp_recovery"):
            query = f"SELECT sum({amount}) FROM paid WHERE EXISTS (SELECT 1 FROM assigned a WHERE a.loan_id = paid.loan_id)"
            run(d.spark.sql(query))

    def hist():
        values = d.table("events").select("value").toPandas()["value"]
        np.histogram(values, bins="auto")

    return {
        "churn_label": lambda: run(label()),
        "package_features": lambda: run(package()),
        "recharge_features": lambda: run(recharge()),
        "training_table": lambda: run(training()),
        "time_profile_loans": profile,
        "loan_recovery_ratio": ratio,
        "dist_hist": hist,
    }


def main() -> None:
    spark = session()
    for name in ("training_table", "dist_violin"):  # start the JVM's compilers
        run(QUERIES[name](spark, SF_DIR))
    seconds = {n: best_of(lambda q=q: run(q(spark, SF_DIR))) for n, q in QUERIES.items()}
    report = {
        "metric": "sum over the registered queries of the better of two runs",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    if "--shapes" in sys.argv:
        report["plain_shapes"] = {
            n: best_of(lambda n=n: plain_shapes(Domain(spark, SF_DIR))[n]())
            for n in plain_shapes(Domain(spark, SF_DIR))
        }
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
