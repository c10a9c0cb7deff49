"""Staging: RAW landing rows -> typed, cleaned rows (one ``select`` each)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import clean_code, lenient_date, lenient_timestamp
from ledgerlens.operators.quality import enforce_contract
from ledgerlens.sources.schemas import STG_INVOICES, STG_ORGANIZATIONS


def stage_organizations(raw: DataFrame, enforce: bool = True) -> DataFrame:
    """Typed organizations: dates parsed leniently, country code cleaned.

    Casts of ids and counts are strict (ANSI): malformed values raise.
    """
    out = raw.select(
        F.col("ORGANIZATION_ID").cast("decimal(38,0)").alias("ORGANIZATION_ID"),
        lenient_date("FIRST_PAYMENT_DATE").alias("FIRST_PAYMENT_DATE"),
        lenient_date("LAST_PAYMENT_DATE").alias("LAST_PAYMENT_DATE"),
        clean_code("LEGAL_ENTITY_COUNTRY_CODE").alias("LEGAL_ENTITY_COUNTRY_CODE"),
        F.col("COUNT_TOTAL_CONTRACTS_ACTIVE").cast("decimal(38,0)").alias("COUNT_TOTAL_CONTRACTS_ACTIVE"),
        lenient_date("CREATED_DATE").alias("CREATED_DATE"),
    )
    return enforce_contract(out, STG_ORGANIZATIONS) if enforce else out


def stage_invoices(raw: DataFrame, enforce: bool = True) -> DataFrame:
    """Typed invoices: codes upper-cased, money as decimals, CREATED_AT parsed.

    ``CREATED_DATE`` is the calendar day of the parsed ``CREATED_AT``; it is
    null when the text does not parse, and such rows are kept.
    """
    created_at = lenient_timestamp("CREATED_AT")
    out = raw.select(
        F.col("INVOICE_ID").cast("string").alias("INVOICE_ID"),
        F.col("PARENT_INVOICE_ID").cast("string").alias("PARENT_INVOICE_ID"),
        F.col("TRANSACTION_ID").cast("string").alias("TRANSACTION_ID"),
        F.col("ORGANIZATION_ID").cast("decimal(38,0)").alias("ORGANIZATION_ID"),
        clean_code("TYPE").alias("TYPE"),
        clean_code("STATUS").alias("STATUS"),
        clean_code("CURRENCY").alias("CURRENCY"),
        clean_code("PAYMENT_CURRENCY").alias("PAYMENT_CURRENCY"),
        clean_code("PAYMENT_METHOD").alias("PAYMENT_METHOD"),
        F.col("AMOUNT").cast("decimal(18,2)").alias("AMOUNT"),
        F.col("PAYMENT_AMOUNT").cast("decimal(18,2)").alias("PAYMENT_AMOUNT"),
        F.col("FX_RATE").cast("decimal(18,6)").alias("FX_RATE"),
        F.col("FX_RATE_PAYMENT").cast("decimal(18,6)").alias("FX_RATE_PAYMENT"),
        created_at.alias("CREATED_AT"),
        F.to_date(created_at).alias("CREATED_DATE"),
    )
    return enforce_contract(out, STG_INVOICES) if enforce else out
