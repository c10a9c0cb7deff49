"""Mart: daily USD per organization with the previous available day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import pct_change
from ledgerlens.sources.schemas import FACT_PARTITION


def with_prev(df: DataFrame, key: str, date: str, value: str, prev_name: str | None = None,
              prev_date_name: str | None = None) -> DataFrame:
    """Add the value of the previous *available* day of the same key (``lag``).

    Gap days are skipped; the first day of a key gets null. Input is at
    (key, date) grain, so a partition holds at most one row per calendar day
    of one key: skew in the raw rows cannot reach this window.
    """
    w = Window.partitionBy(key).orderBy(F.col(date).asc_nulls_last())
    out = df.withColumn(prev_name or f"PREV_{value}", F.lag(value).over(w))
    if prev_date_name:
        out = out.withColumn(prev_date_name, F.lag(date).over(w))
    return out


def _mart_rows(f: DataFrame, keep: list[str] | None = None) -> DataFrame:
    w = with_prev(f, "ORGANIZATION_ID", "DATE", "DAILY_PAYMENT_AMOUNT", "PREV_DAILY_PAYMENT_AMOUNT")
    return w.select(
        "ORGANIZATION_ID",
        "DATE",
        F.coalesce(F.col("DAILY_PAYMENT_AMOUNT"), F.lit(0)).cast("decimal(38,8)").alias("DAILY_PAYMENT_AMOUNT"),
        F.col("PREV_DAILY_PAYMENT_AMOUNT").cast("decimal(38,8)").alias("PREV_DAILY_PAYMENT_AMOUNT"),
        pct_change("DAILY_PAYMENT_AMOUNT", "PREV_DAILY_PAYMENT_AMOUNT").alias("DOD_CHANGE_PCT"),
        *(keep or []),
    )


def _amounts(fact: DataFrame) -> DataFrame:
    return fact.select("ORGANIZATION_ID", "DATE", F.col("PAYMENT_AMOUNT_USD").alias("DAILY_PAYMENT_AMOUNT"))


def mart_daily_balance(fact: DataFrame) -> DataFrame:
    """ORGANIZATION_ID, DATE, DAILY_PAYMENT_AMOUNT (null -> 0),
    PREV_DAILY_PAYMENT_AMOUNT, DOD_CHANGE_PCT (fraction, null if prev null or 0)."""
    return _mart_rows(_amounts(fact))


def last_days(fact: DataFrame, start: Column, kept: DataFrame | None = None) -> DataFrame:
    """Each organization's last day before ``start`` and its amount, of
    ``fact`` and the earlier last days ``kept``: ORGANIZATION_ID, DATE,
    DAILY_PAYMENT_AMOUNT. One row per organization and task before the shuffle."""
    rows = _amounts(fact)
    if kept is not None:
        rows = rows.unionByName(kept)
    return (rows.where(F.col("DATE") < start).groupBy("ORGANIZATION_ID")
            .agg(F.max(F.struct("DATE", "DAILY_PAYMENT_AMOUNT")).alias("_LAST"))
            .select("ORGANIZATION_ID", "_LAST.DATE", "_LAST.DAILY_PAYMENT_AMOUNT"))


def mart_daily_balance_since(fact: DataFrame, start: Column, seeds: DataFrame | None = None) -> DataFrame:
    """The rows of :func:`mart_daily_balance` with ``DATE >= start`` or a null
    DATE (which sorts after every day), computed without the older history.

    Each organization's last day before ``start`` (``seeds``, or found here by
    :func:`last_days`) supplies the previous amount of the first recomputed
    day and is then dropped. When ``fact`` carries the month partition
    column, its reads are pruned by it.
    """
    if FACT_PARTITION in fact.columns:
        month = F.trunc(start, "month")
        recent_src = fact.where((F.col(FACT_PARTITION) >= month) | F.col(FACT_PARTITION).isNull())
        before_src = fact.where(F.col(FACT_PARTITION) <= month)
    else:
        recent_src = before_src = fact
    date = F.col("DATE")
    recent = _amounts(recent_src).where((date >= start) | date.isNull()).withColumn("_SEED", F.lit(False))
    seeds = last_days(before_src, start) if seeds is None else seeds
    rows = _mart_rows(recent.unionByName(seeds.withColumn("_SEED", F.lit(True))), keep=["_SEED"])
    return rows.where(~F.col("_SEED")).drop("_SEED")
