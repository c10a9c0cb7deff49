"""Declared schemas of every layer.

RAW tables keep the loose landing types (ids and dates as text, money as
double); staging tables carry the enforced contract.
"""

from __future__ import annotations

from pyspark.sql import types as T

ID = T.DecimalType(38, 0)

RAW_ORGANIZATIONS = T.StructType([
    T.StructField("ORGANIZATION_ID", ID),
    T.StructField("FIRST_PAYMENT_DATE", T.StringType()),
    T.StructField("LAST_PAYMENT_DATE", T.StringType()),
    T.StructField("LEGAL_ENTITY_COUNTRY_CODE", T.StringType()),
    T.StructField("COUNT_TOTAL_CONTRACTS_ACTIVE", ID),
    T.StructField("CREATED_DATE", T.StringType()),
])

RAW_INVOICES = T.StructType([
    T.StructField("INVOICE_ID", T.StringType()),
    T.StructField("PARENT_INVOICE_ID", T.StringType()),
    T.StructField("TRANSACTION_ID", T.StringType()),
    T.StructField("ORGANIZATION_ID", ID),
    T.StructField("TYPE", T.StringType()),
    T.StructField("STATUS", T.StringType()),
    T.StructField("CURRENCY", T.StringType()),
    T.StructField("PAYMENT_CURRENCY", T.StringType()),
    T.StructField("PAYMENT_METHOD", T.StringType()),
    T.StructField("AMOUNT", T.DoubleType()),
    T.StructField("PAYMENT_AMOUNT", T.DoubleType()),
    T.StructField("FX_RATE", T.DoubleType()),
    T.StructField("FX_RATE_PAYMENT", T.DoubleType()),
    T.StructField("CREATED_AT", T.StringType()),
])

# Keys of the RAW upserts.
RAW_ORGANIZATIONS_KEY = ("ORGANIZATION_ID",)
RAW_INVOICES_KEY = ("INVOICE_ID", "TRANSACTION_ID")
# Stored layout of RAW invoices: partitioned by the month of CREATED_AT.
RAW_INVOICES_PARTITION = "CREATED_MONTH"

STG_ORGANIZATIONS = T.StructType([
    T.StructField("ORGANIZATION_ID", ID),
    T.StructField("FIRST_PAYMENT_DATE", T.DateType()),
    T.StructField("LAST_PAYMENT_DATE", T.DateType()),
    T.StructField("LEGAL_ENTITY_COUNTRY_CODE", T.StringType()),
    T.StructField("COUNT_TOTAL_CONTRACTS_ACTIVE", ID),
    T.StructField("CREATED_DATE", T.DateType()),
])

STG_INVOICES = T.StructType([
    T.StructField("INVOICE_ID", T.StringType()),
    T.StructField("PARENT_INVOICE_ID", T.StringType()),
    T.StructField("TRANSACTION_ID", T.StringType()),
    T.StructField("ORGANIZATION_ID", ID),
    T.StructField("TYPE", T.StringType()),
    T.StructField("STATUS", T.StringType()),
    T.StructField("CURRENCY", T.StringType()),
    T.StructField("PAYMENT_CURRENCY", T.StringType()),
    T.StructField("PAYMENT_METHOD", T.StringType()),
    T.StructField("AMOUNT", T.DecimalType(18, 2)),
    T.StructField("PAYMENT_AMOUNT", T.DecimalType(18, 2)),
    T.StructField("FX_RATE", T.DecimalType(18, 6)),
    T.StructField("FX_RATE_PAYMENT", T.DecimalType(18, 6)),
    T.StructField("CREATED_AT", T.TimestampNTZType()),
    T.StructField("CREATED_DATE", T.DateType()),
])

FACT_KEY = ("ORGANIZATION_ID", "DATE")
FACT_PAYMENTS = T.StructType([
    T.StructField("ORGANIZATION_ID", ID),
    T.StructField("DATE", T.DateType()),
    T.StructField("PAYMENT_AMOUNT_USD", T.DecimalType(38, 8)),
])

# Stored layout of the fact: partitioned by MONTH (first day of DATE's month).
# A month of the fact is already aggregated (one row per active organization
# and day), so monthly directories keep files large while an incremental
# merge rewrites at most the two months its 8-day window touches.
FACT_PARTITION = "MONTH"

MART_DAILY_BALANCE = T.StructType([
    T.StructField("ORGANIZATION_ID", ID),
    T.StructField("DATE", T.DateType()),
    T.StructField("DAILY_PAYMENT_AMOUNT", T.DecimalType(38, 8)),
    T.StructField("PREV_DAILY_PAYMENT_AMOUNT", T.DecimalType(38, 8)),
    T.StructField("DOD_CHANGE_PCT", T.DoubleType()),
])
MART_KEY = ("ORGANIZATION_ID", "DATE")
