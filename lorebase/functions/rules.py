"""Documented business rules, as column expressions and as SQL functions."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

# Days without an order after which a customer is at risk, and churned.
AT_RISK_DAYS = 60
CHURN_DAYS = 90


def churn_label(days):
    """The documented bands overlap between 60 and 90 days; there, at risk wins. No order at all is churned."""
    return (
        F.when(days.isNull() | (days > CHURN_DAYS), "churned")
        .when(days >= AT_RISK_DAYS, "at risk")
        .otherwise("active")
    )


def fiscal_year(day):
    """The fiscal year is the calendar year."""
    return F.year(day)


def fiscal_quarter(day):
    return F.quarter(day)


def quarter_start(day):
    return F.trunc(day, "quarter")


def quarter_end(day):
    return F.date_sub(F.add_months(F.trunc(day, "quarter"), 3), 1)


def register_rules(spark: SparkSession) -> None:
    """Make the rules callable from SQL."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION fiscal_quarter(d DATE) RETURNS INT RETURN quarter(d)"
    )
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION fiscal_year(d DATE) RETURNS INT RETURN year(d)")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION churn_label(days INT) RETURNS STRING RETURN "
        f"CASE WHEN days IS NULL OR days > {CHURN_DAYS} THEN 'churned' "
        f"WHEN days >= {AT_RISK_DAYS} THEN 'at risk' ELSE 'active' END"
    )
