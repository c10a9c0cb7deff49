"""Fact: settled invoices converted to USD and summed per organization and day."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import LOOKBACK_DAYS, LOOKBACK_FLOOR, SETTLED_STATUSES, to_usd
from ledgerlens.sources.tables import high_water_mark

# Partition column of stored staged invoices: month of CREATED_DATE.
STAGED_MONTH = "CREATED_MONTH"


def settled(stg: DataFrame, status_col: str = "STATUS", already_upper: bool = False) -> DataFrame:
    """Invoices whose status (case-insensitive) is CREDITED, REFUNDED or PAID.

    Staging already upper-cases STATUS; with ``already_upper=True`` the bare
    column is compared, which keeps the predicate sargable (it reaches the
    Parquet scan as an ``In`` filter).
    """
    c = F.col(status_col) if already_upper else F.upper(F.col(status_col))
    return stg.where(c.isin(*SETTLED_STATUSES))


def lookback_start(target: DataFrame | _dt.date | None, days: int = LOOKBACK_DAYS, date_col: str = "DATE",
                   first_of_month: bool = False) -> Column:
    """First day to recompute: ``max(target.DATE) - days``, or 1900-01-01;
    with ``first_of_month`` the first day of its month.

    ``target`` may also be the newest day itself; then the start is a literal.
    Otherwise it is a scalar subquery: Catalyst evaluates it once and the
    comparison reaches the scan of the source as a pushed filter.
    """
    floor = F.lit(LOOKBACK_FLOOR).cast("date")
    if target is None:
        return floor
    if isinstance(target, _dt.date):
        day = target - _dt.timedelta(days=days)
        return F.lit(day.replace(day=1) if first_of_month else day)
    # The whole start date is computed inside the subquery, so the source
    # filter is a bare ``CREATED_DATE >= ScalarSubquery`` that Parquet takes
    # as a pushed filter (row-group skipping on date-clustered files). On a
    # stored, month-partitioned target only its newest month is read.
    def start(mx: Column) -> Column:
        day = F.coalesce(F.date_sub(mx, days), floor)
        return F.trunc(day, "month") if first_of_month else day

    return high_water_mark(target, date_col, wrap=start)


def lookback(stg: DataFrame, target: DataFrame | _dt.date | None, days: int = LOOKBACK_DAYS,
             created_col: str = "CREATED_DATE") -> DataFrame:
    """Rows on or after ``lookback_start``; null dates never pass (null >= x).

    Of stored staged invoices only the months from the start's on are listed.
    """
    out = stg.where(F.col(created_col) >= lookback_start(target, days))
    if STAGED_MONTH in stg.columns:
        out = out.where(F.col(STAGED_MONTH) >= lookback_start(target, days, first_of_month=True)).drop(STAGED_MONTH)
    return out


def usd_rows(stg: DataFrame) -> DataFrame:
    """Per-invoice USD value (null when no rate is usable)."""
    return stg.select(
        "ORGANIZATION_ID",
        F.col("CREATED_DATE").cast("date").alias("DATE"),
        to_usd("AMOUNT", "FX_RATE", "PAYMENT_AMOUNT", "FX_RATE_PAYMENT").alias("PAYMENT_AMOUNT_USD"),
    )


def fact_daily_payment(stg: DataFrame, target: DataFrame | _dt.date | None = None,
                       days: int = LOOKBACK_DAYS, already_upper: bool = False) -> DataFrame:
    """Sum of USD per (ORGANIZATION_ID, DATE) over settled invoices.

    With ``target`` (an existing fact, or its newest day) only invoices created on or after
    ``max(target.DATE) - days`` are read: the delta of an incremental run.
    The aggregation is partial + final (map-side combine), so a hot
    organization or day is reduced inside each task before the shuffle.
    """
    src = settled(stg, already_upper=already_upper)
    if target is not None:
        src = lookback(src, target, days)
    rows = usd_rows(src).where(F.col("PAYMENT_AMOUNT_USD").isNotNull())
    return rows.groupBy("ORGANIZATION_ID", "DATE").agg(
        F.sum("PAYMENT_AMOUNT_USD").cast("decimal(38,8)").alias("PAYMENT_AMOUNT_USD"))
