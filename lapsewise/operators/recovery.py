"""Loans that were recovered: which, how much, and what share of the amount."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.functions.numbers import percent_of
from lapsewise.operators.bloom import bloom_filter, possible_members


def common_loans(assign: DataFrame, recovery: DataFrame, loan: str = "loan_id") -> DataFrame:
    """Distinct loan ids present in both tables.

    Each side is made distinct first, on the map side, so that an id repeated very often
    does not travel to one task.
    """
    return assign.select(loan).distinct().intersect(recovery.select(loan).distinct())


def recovery_by_loan(
    assign: DataFrame, recovery: DataFrame, loan: str = "loan_id", prefilter: bool = False
) -> DataFrame:
    """Sums of loan amount and recovered amount over each assigned loan's recovery rows.

    Sums first, join after: the recovery rows are reduced to one per loan before they meet
    the assigned ids, whatever share of them one loan holds. Where few of the recovered loans are assigned ones,
    ``prefilter`` drops the others by a Bloom filter of the assigned ids before sums are
    shuffled; the exact join stays.
    """
    if prefilter:
        recovery = possible_members(recovery, loan, bloom_filter(assign, loan))
    sums = recovery.groupBy(loan).agg(
        F.sum("loan_amount").alias("sum_of_loan_amount"),
        F.sum("hsdp_recovery").alias("sum_of_recovery"),
    )
    return sums.join(assign.select(loan).distinct(), loan, "left_semi")


def loan_recovery_ratio(
    assign: DataFrame, recovery: DataFrame, base: str = "recovery", loan: str = "loan_id"
) -> DataFrame:
    """One row: recovered sum, assigned sum, and the first as a percentage of the second.

    ``base`` tells where the assigned amount is read: from the recovery rows, which counts a
    loan once per payment, or from the assigned loans themselves. Nulls if nothing matches.
    """
    if base not in ("recovery", "assign"):
        raise ValueError(f"unknown base {base!r}: expected 'recovery' or 'assign'")
    by_loan = recovery_by_loan(assign, recovery, loan)
    if base == "assign":
        lent = assign.groupBy(loan).agg(F.sum("loan_amount").alias("sum_of_loan_amount"))
        by_loan = by_loan.drop("sum_of_loan_amount").join(lent, loan)
    totals = by_loan.agg(
        F.sum("sum_of_recovery").alias("recovered_sum"),
        F.sum("sum_of_loan_amount").alias("assigned_sum"),
    )
    return totals.withColumn(
        "percentage_of_recovered", percent_of(F.col("recovered_sum"), F.col("assigned_sum"))
    )
