"""The given tables seen as the domain's tables: once as DataFrames, once as SQL text.

A view selects only what its name promises; which columns are read is left to pruning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the queries.
AS_OF = "2024-02-01"
FIRST_DAY = "2024-01-01"
PERIOD_DAYS = 10
THRESHOLD_DAYS = 1


class Domain:
    """Domain tables over one folder of Parquet files."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._opened: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A given table; its footers are looked at once per domain, not once per use."""
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._opened[name]

    def _lines_with_orders(self) -> DataFrame:
        orders = self.table("orders")
        return self.table("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    def loan_assign(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_custkey").alias("bib_id"),
            (F.col("o_custkey") % 100).alias("nid_hash"),
            F.col("o_orderkey").alias("loan_id"),
            F.col("o_totalprice").alias("loan_amount"),
            F.col("o_orderdate").alias("date_timestamp"),
        )

    def loan_recovery(self) -> DataFrame:
        return self._lines_with_orders().select(
            F.col("o_custkey").alias("bib_id"),
            F.col("l_orderkey").alias("loan_id"),
            F.col("l_extendedprice").alias("loan_amount"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("hsdp_recovery"),
            F.col("l_shipdate").alias("date_timestamp"),
        )

    def loan_payments(self) -> DataFrame:
        """``loan_recovery`` without the subscriber: every line has its order, so the join
        with orders adds nothing else."""
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("loan_id"),
            F.col("l_extendedprice").alias("loan_amount"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("hsdp_recovery"),
        )

    def package(self) -> DataFrame:
        """Packages without the names of what was offered: no join with part."""
        return self._lines_with_orders().select(
            F.col("o_custkey").alias("bib_id"),
            F.col("l_partkey").alias("offering_id"),
            F.col("l_extendedprice").alias("offer_amount"),
            F.col("o_orderdate").alias("activation_date"),
            F.col("l_shipdate").alias("deactivation_date"),
        )

    def _offerings(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("offering_id"),
            F.col("p_brand").alias("offering_code"),
            F.col("p_type").alias("offering_name"),
        )

    def named_package(self) -> DataFrame:
        return self.package().join(self._offerings(), "offering_id")

    def packages_by_offering(self) -> DataFrame:
        """Number of packages (``packages``) of each offering: line items are counted before they
        meet the names, and their orders add nothing."""
        counted = (
            self.table("lineitem")
            .groupBy(F.col("l_partkey").alias("offering_id"))
            .agg(F.count(F.lit(1)).alias("packages"))
        )
        return counted.join(self._offerings(), "offering_id")

    def recharge(self) -> DataFrame:
        return self._event_stream(signups=False).select(
            F.col("user_id").alias("bib_id"),
            F.col("event_type").alias("origin_host_nm"),
            F.col("value").alias("recharge_value_amt"),
            F.col("ts").alias("recharge_dt"),
        )

    def user(self) -> DataFrame:
        first_order = (
            self.table("orders")
            .groupBy(F.col("o_custkey").alias("c_custkey"))
            .agg(F.min("o_orderdate").alias("first_order"))
        )
        born = F.date_add(
            F.lit("1950-01-01").cast("date"), (F.col("c_custkey") * 37 % 18000).cast("int")
        )
        return (
            self.table("customer")
            .join(first_order, "c_custkey", "left")
            .select(
                F.col("c_custkey").alias("bib_id"),
                F.col("c_nationkey").cast("string").alias("contract_type_v"),
                F.col("c_mktsegment").alias("gender_v"),
                F.when(F.col("c_acctbal") < 0, "neg").otherwise("pos").alias("ability_status"),
                F.col("c_acctbal").alias("account_balance"),
                F.date_format(born, "yyyyMMdd").alias("date_of_birth_d"),
                F.date_format("first_order", "yyyyMMdd").alias("registration_date_d"),
            )
        )

    def _event_stream(self, signups: bool) -> DataFrame:
        """Sign-ups, or all other events."""
        period = F.floor(F.datediff("ts", F.lit(FIRST_DAY).cast("date")) / PERIOD_DAYS)
        return (
            self.table("events")
            .where((F.col("event_type") == "signup") == F.lit(signups))
            .withColumn("period", period.cast("int"))
        )

    def signups(self, period: int | None = None) -> DataFrame:
        """Activity in the role of packages."""
        rows = self._event_stream(signups=True).select(
            F.col("user_id").alias("bib_id"), "period", F.col("ts").alias("activation_date")
        )
        return rows if period is None else rows.where(F.col("period") == period)

    def purchases(self, period: int | None = None) -> DataFrame:
        """Activity in the role of recharges."""
        rows = self._event_stream(signups=False).select(
            F.col("user_id").alias("bib_id"), "period", F.col("ts").alias("recharge_dt")
        )
        return rows if period is None else rows.where(F.col("period") == period)


SQL_VIEWS = {
    "loan_assign": """
        SELECT o_custkey AS bib_id, o_custkey % 100 AS nid_hash, o_orderkey AS loan_id,
               o_totalprice AS loan_amount, o_orderdate AS date_timestamp
        FROM orders""",
    "loan_recovery": """
        SELECT o_custkey AS bib_id, l_orderkey AS loan_id, l_extendedprice AS loan_amount,
               l_extendedprice * (1 - l_discount) AS hsdp_recovery,
               l_shipdate AS date_timestamp
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "package": """
        SELECT o_custkey AS bib_id, p_brand AS offering_code, p_type AS offering_name,
               l_extendedprice AS offer_amount, o_orderdate AS activation_date,
               l_shipdate AS deactivation_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                      JOIN part ON l_partkey = p_partkey""",
    "recharge": """
        SELECT user_id AS bib_id, value AS recharge_value_amt, ts AS recharge_dt
        FROM events WHERE event_type <> 'signup'""",
    "subscriber": """
        SELECT c_custkey AS bib_id, CAST(c_nationkey AS VARCHAR) AS contract_type_v,
               c_mktsegment AS gender_v,
               CASE WHEN c_acctbal < 0 THEN 'neg' ELSE 'pos' END AS ability_status,
               c_acctbal AS account_balance,
               strftime(DATE '1950-01-01' + CAST(c_custkey * 37 % 18000 AS INTEGER), '%Y%m%d')
                   AS date_of_birth_d,
               strftime(first_order, '%Y%m%d') AS registration_date_d
        FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order
                                 FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey""",
    "activity": f"""
        SELECT user_id AS bib_id, event_type, ts,
               date_diff('day', DATE '{FIRST_DAY}', CAST(ts AS DATE)) // {PERIOD_DAYS} AS period
        FROM events""",
}


def with_views(views: str, body: str) -> str:
    """A SELECT with the named views (and further ``name AS (...)`` parts) in front."""
    parts = [f"{name} AS ({SQL_VIEWS[name]})" for name in views.split()]
    return "WITH " + ",\n".join(parts) + "\n" + body
