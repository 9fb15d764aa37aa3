"""Write the given tables as monthly CSV extracts and take them in again."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise.functions import LONG_FORMAT
from lapsewise.plans.subscriber_store import SubscriberStore
from lapsewise.sources import Catalog, ingest, schema_for
from lapsewise.workload.domain import FIRST_DAY, PERIOD_DAYS, Domain

MONTHS = ["0", "1", "2"]


def scratch(spark: SparkSession) -> str:
    """A new folder that every executor reaches, below the one the cluster shares, else below the
    warehouse; what is in it goes when the session's JVM ends."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{shared.rstrip('/')}/extracts-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def _catalog(spark: SparkSession, keys: list[str]) -> Catalog:
    return Catalog(
        spark,
        keys,
        MONTHS,
        csv_paths={k: f"csv/{k}/month={{month}}" for k in keys},
        parquet_paths={k: f"parquet/{k}/month={{month}}" for k in keys},
        base=scratch(spark),
    )


def _write_extracts(catalog: Catalog, key: str, rows: DataFrame) -> None:
    """One folder per month, columns in file order, those without a source left empty."""
    present = set(rows.columns)
    columns = [
        (F.col(n) if n in present else F.lit(None)).cast("string").alias(n)
        for n in schema_for(key).names
    ]
    rows.select("month", *columns).write.partitionBy("month").csv(
        f"{catalog.base}/csv/{key}", header=True
    )


def _event_rows(d: Domain) -> DataFrame:
    period = F.floor(F.datediff("ts", F.lit(FIRST_DAY).cast("date")) / PERIOD_DAYS)
    return d.table("events").select(
        "*",
        period.alias("month"),
        F.col("user_id").alias("bib_id"),
        F.col("event_id").alias("fake_id"),
        F.date_format("ts", LONG_FORMAT).alias("at"),
    )


def recharges(d: Domain, spoil: Column | None = None) -> Catalog:
    """All events as recharges. The amount of rows where ``spoil`` holds is no number."""
    catalog = _catalog(d.spark, ["recharge"])
    amount = F.col("value").cast("string")
    if spoil is not None:
        amount = F.when(spoil, F.lit("n/a")).otherwise(amount)
    rows = _event_rows(d).withColumns({"recharge_value_amt": amount, "recharge_dt": F.col("at")})
    _write_extracts(catalog, "recharge", rows)
    ingest(catalog)
    return catalog


def _tables(d: Domain) -> dict[str, DataFrame]:
    """Sign-ups as packages, other events as recharges, every customer in each month, and loans by
    the year of their order."""
    events = _event_rows(d)
    signups = events.where(F.col("event_type") == "signup").withColumns(
        {
            "offering_name": F.col("props"),
            "offer_amount": F.col("value"),
            "activation_date": F.col("at"),
            "deactivation_date": F.date_format(
                F.date_add("ts", F.floor("value").cast("int")), LONG_FORMAT
            ),
        }
    )
    others = events.where(F.col("event_type") != "signup").withColumns(
        {
            "recharge_value_amt": F.col("value"),
            "recharge_dt": F.col("at"),
            "origin_host_nm": F.col("event_type"),
        }
    )
    ordered = F.year("o_orderdate") % len(MONTHS)
    orders = d.table("orders").select("o_orderkey", ordered.alias("month"))
    assigned = d.loan_assign().withColumn("month", F.year("date_timestamp") % len(MONTHS))
    paid = d.loan_recovery().join(orders, F.col("loan_id") == F.col("o_orderkey"))
    return {
        "loan_assign": assigned,
        "loan_fee": assigned.withColumn("hsdp_fee", F.col("loan_amount") / 10),
        "loan_recovery": paid,
        "package": signups,
        "recharge": others,
        "user": d.user().withColumn("month", F.explode(F.array(*[F.lit(m) for m in MONTHS]))),
    }


def extracts(d: Domain, wanted: Mapping[str, Sequence[str]]) -> Catalog:
    """The wanted months of the wanted tables, written and taken in, one job a table for each."""
    catalog, tables = _catalog(d.spark, list(wanted)), _tables(d)

    def write(key: str) -> None:
        _write_extracts(catalog, key, tables[key].where(F.col("month").cast("string").isin(*wanted[key])))

    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(write, wanted))
    for months in dict.fromkeys(map(tuple, wanted.values())):
        ingest(catalog, [key for key in wanted if tuple(wanted[key]) == months], months)
    return catalog


def subscribers(d: Domain, wanted: Mapping[str, Sequence[str]], features: bool) -> SubscriberStore:
    """A subscriber store into which the wanted months were folded one after the other."""
    catalog = extracts(d, wanted)
    store = SubscriberStore(d.spark, f"{catalog.base}/subscribers", buckets=8)
    for month in sorted(set().union(*wanted.values()), key=catalog.period):
        store.fold(catalog, month, features)
    return store
