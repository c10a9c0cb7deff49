"""Registered queries: one per operator of the inventory.

Each callable takes ``(spark, sf_dir)``, derives the RAW landing tables
from the driver's test tables, and runs the library's operators on them.
The final projection is a *comparison view*: ids as bigint, money as
``round(double, 4)``, fractions as ``round(double, 6)`` (the library itself
keeps decimals). :mod:`ledgerlens.oracle` holds the DuckDB twin of each.
Queries that exercise sinks write to a fresh folder below the shared
scratch root (``spark.checkpoint.dir``) before returning a scan.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import oracle
from ledgerlens.functions import money_text, percent_text, to_usd
from ledgerlens.operators.alerts import (
    alert_digest,
    alert_messages,
    alerts,
    alerts_macro,
    latest_day,
    top_alerts,
)
from ledgerlens.operators.dims import dim_organizations
from ledgerlens.operators.facts import fact_daily_payment, lookback, settled
from ledgerlens.operators.marts import mart_daily_balance, with_prev
from ledgerlens.operators.merge import upsert
from ledgerlens.operators.quality import (
    check_not_null,
    check_pct_guard,
    check_prev,
    check_unique,
    enforce_contract,
    freshness,
    row_rules,
    run_checks,
)
from ledgerlens.operators.staging import stage_invoices, stage_organizations
from ledgerlens.plans.build import Warehouse, build, load_raw, refresh_fact, refresh_mart, register
from ledgerlens.plans.docs import catalog_comments
from ledgerlens.plans.sinks import merge_partitions, replace_table, stage, stage_counted, write_fact
from ledgerlens.plans.sql_functions import create_alert_function
from ledgerlens.session import new_scratch
from ledgerlens.sources.csv import INVOICES_GLOB, read_raw_csv, write_csv
from ledgerlens.sources.fixtures import raw_invoices, raw_organizations, read_test_table
from ledgerlens.sources.schemas import FACT_KEY, FACT_PAYMENTS, MART_DAILY_BALANCE, RAW_INVOICES, STG_INVOICES
from ledgerlens.sources.tables import read_table


# --- comparison projection ------------------------------------------------------
def _m4(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 4)


def _r6(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 6)


def _oid(c: str = "ORGANIZATION_ID") -> Column:
    return F.col(c).cast("bigint").alias(c)


def stg_inv_view(df: DataFrame) -> DataFrame:
    return df.select(
        "INVOICE_ID", "PARENT_INVOICE_ID", "TRANSACTION_ID", _oid(), "TYPE", "STATUS", "CURRENCY",
        "PAYMENT_CURRENCY", "PAYMENT_METHOD", _m4("AMOUNT").alias("AMOUNT"),
        _m4("PAYMENT_AMOUNT").alias("PAYMENT_AMOUNT"), _r6("FX_RATE").alias("FX_RATE"),
        _r6("FX_RATE_PAYMENT").alias("FX_RATE_PAYMENT"), "CREATED_AT", "CREATED_DATE")


def org_view(df: DataFrame) -> DataFrame:
    return df.select(_oid(), "FIRST_PAYMENT_DATE", "LAST_PAYMENT_DATE", "LEGAL_ENTITY_COUNTRY_CODE",
                     _oid("COUNT_TOTAL_CONTRACTS_ACTIVE"), "CREATED_DATE")


def raw_inv_view(df: DataFrame) -> DataFrame:
    return df.select(*[_oid() if f.name == "ORGANIZATION_ID" else F.col(f.name) for f in RAW_INVOICES.fields])


def fact_view(df: DataFrame) -> DataFrame:
    return df.select(_oid(), "DATE", _m4("PAYMENT_AMOUNT_USD").alias("PAYMENT_AMOUNT_USD"))


def mart_view(df: DataFrame) -> DataFrame:
    return df.select(_oid(), "DATE", _m4("DAILY_PAYMENT_AMOUNT").alias("DAILY_PAYMENT_AMOUNT"),
                     _m4("PREV_DAILY_PAYMENT_AMOUNT").alias("PREV_DAILY_PAYMENT_AMOUNT"),
                     _r6("DOD_CHANGE_PCT").alias("DOD_CHANGE_PCT"))


def alert_view(df: DataFrame) -> DataFrame:
    return df.select(_oid(), "DATE", _m4("DAILY_PAYMENT_AMOUNT").alias("DAILY_PAYMENT_AMOUNT"),
                     _m4("PREV_DAILY_PAYMENT_AMOUNT").alias("PREV_DAILY_PAYMENT_AMOUNT"),
                     _r6("PCT_CHANGE").alias("PCT_CHANGE"), _m4("ABS_CHANGE").alias("ABS_CHANGE"))


# --- lazily composed layers -------------------------------------------------------
def stg_inv(spark: SparkSession, sf: str) -> DataFrame:
    return stage_invoices(raw_invoices(spark, sf))


def stg_org(spark: SparkSession, sf: str) -> DataFrame:
    return stage_organizations(raw_organizations(spark, sf))


def fact(spark: SparkSession, sf: str) -> DataFrame:
    return fact_daily_payment(stg_inv(spark, sf))


def mart(spark: SparkSession, sf: str) -> DataFrame:
    return mart_daily_balance(fact(spark, sf))


def _order_key(df: DataFrame) -> Column:
    return F.substring("INVOICE_ID", 4, 32).cast("bigint")


# --- queries ----------------------------------------------------------------------
def q_stg_invoices(spark, sf):
    return stg_inv_view(stg_inv(spark, sf))


def q_check_contract(spark, sf):
    # Staging built without the gate, then passed through the contract check.
    return stg_inv_view(enforce_contract(stage_invoices(raw_invoices(spark, sf), enforce=False), STG_INVOICES))


def q_stg_organizations(spark, sf):
    return org_view(stg_org(spark, sf))


def q_settled_invoices(spark, sf):
    return settled(stg_inv(spark, sf)).select("INVOICE_ID", _oid(), "STATUS", "CREATED_DATE")


def q_fx_to_usd(spark, sf):
    s = stg_inv(spark, sf)
    return s.select("INVOICE_ID", _oid(), F.col("CREATED_DATE").alias("DATE"),
                    _m4(to_usd("AMOUNT", "FX_RATE", "PAYMENT_AMOUNT", "FX_RATE_PAYMENT")).alias("PAYMENT_AMOUNT_USD"))


def q_fact_daily_payment(spark, sf):
    return fact_view(fact(spark, sf))


def q_dim_organizations(spark, sf):
    return org_view(dim_organizations(stg_org(spark, sf)))


def q_prev_available_day(spark, sf):
    w = with_prev(fact(spark, sf), "ORGANIZATION_ID", "DATE", "PAYMENT_AMOUNT_USD",
                  "PREV_PAYMENT_AMOUNT_USD", "PREV_DATE")
    return w.select(_oid(), "DATE", _m4("PAYMENT_AMOUNT_USD").alias("PAYMENT_AMOUNT_USD"),
                    _m4("PREV_PAYMENT_AMOUNT_USD").alias("PREV_PAYMENT_AMOUNT_USD"), "PREV_DATE")


def q_pct_change(spark, sf):
    return mart(spark, sf).select(_oid(), "DATE", _r6("DOD_CHANGE_PCT").alias("DOD_CHANGE_PCT"))


def q_mart_daily_balance(spark, sf):
    return mart_view(mart(spark, sf))


def q_latest_day(spark, sf):
    return latest_day(mart(spark, sf))


def q_alerts(spark, sf):
    return alert_view(alerts(mart(spark, sf), min_abs=1000.0))


def q_alerts_top50(spark, sf):
    return alert_view(top_alerts(mart(spark, sf), 50, min_abs=0.0))


def q_alerts_macro(spark, sf):
    return mart_view(alerts_macro(mart(spark, sf)))


def q_alerts_allow_deny(spark, sf):
    return mart_view(alerts_macro(mart(spark, sf), allow=oracle.ALLOW_IDS, deny=oracle.DENY_IDS))


def q_alert_messages(spark, sf):
    return alert_messages(alerts(mart(spark, sf), min_abs=0.0)).select(
        _oid(), "MESSAGE_LINE", "MESSAGE_BLOCK", "MESSAGE_TABLE")


def q_alert_digest(spark, sf):
    return alert_digest(stage(spark, mart(spark, sf), "digest-mart"), min_abs=1000.0)


def monthly_mart(spark: SparkSession, sf: str) -> DataFrame:
    """The mart at month grain (every invoice moved to the first of its month):
    its newest day has a row for a large part of all organizations."""
    return mart_daily_balance(fact_daily_payment(stg_inv(spark, sf).withColumn(
        "CREATED_DATE", F.trunc("CREATED_DATE", "month"))))


def busy_day(m: DataFrame) -> DataFrame:
    """``m`` up to the newest of its days with the most rows."""
    per_day = m.where("DATE is not null").groupBy("DATE").agg(F.count(F.lit(1)).alias("N"))
    return m.where(F.col("DATE") <= per_day.agg(F.max(F.struct("N", "DATE"))["DATE"]).scalar())


def q_alerts_monthly(spark, sf):
    return alert_view(alerts(busy_day(monthly_mart(spark, sf)), min_abs=1000.0))


def q_alerts_top50_monthly(spark, sf):
    return alert_view(top_alerts(busy_day(monthly_mart(spark, sf)), 50, min_abs=0.0))


def q_alerts_macro_monthly(spark, sf):
    return mart_view(alerts_macro(busy_day(monthly_mart(spark, sf)), threshold=0.25, min_abs=50000.0))


def q_alerts_allow_deny_monthly(spark, sf):
    return mart_view(alerts_macro(busy_day(monthly_mart(spark, sf)), allow=oracle.SHORT_ALLOW_IDS, deny=oracle.SHORT_DENY_IDS))


def q_alert_messages_monthly(spark, sf):
    return alert_messages(alerts(busy_day(monthly_mart(spark, sf)), min_abs=0.0)).select(
        _oid(), "MESSAGE_LINE", "MESSAGE_BLOCK", "MESSAGE_TABLE")


def q_message_numbers(spark, sf):
    """Number texts over every invoice: percents that tie, and amounts far
    beyond what a double holds exactly."""
    raw = raw_invoices(spark, sf)
    k = _order_key(raw).cast("decimal(38,0)")
    pct = ((k % 2001 - 1000) / 800).cast("double")
    big = (k * F.lit("1000000000000").cast("decimal(13,0)") + F.col("AMOUNT").cast("decimal(18,2)") / 8).cast("decimal(38,8)")
    return raw.select("INVOICE_ID", percent_text(pct).alias("PCT_TEXT"), money_text(big).alias("MONEY_TEXT"),
                      money_text(-big, grouped=False).alias("PLAIN_TEXT"))


def _corrupt(m: DataFrame) -> DataFrame:
    """Some rows with a percentage they must not have, some with a wrong
    previous amount."""
    c = F.col("ORGANIZATION_ID").cast("bigint")
    prev = F.col("PREV_DAILY_PAYMENT_AMOUNT")
    return m.withColumn("DOD_CHANGE_PCT", F.when(c % 3 == 0, F.coalesce("DOD_CHANGE_PCT", F.lit(0.25))).otherwise(
        F.col("DOD_CHANGE_PCT"))).withColumn("PREV_DAILY_PAYMENT_AMOUNT", F.when(c % 5 == 0, prev + 1).otherwise(prev).cast("decimal(38,8)"))


def q_check_pct_guard_violations(spark, sf):
    return mart_view(check_pct_guard(_corrupt(mart(spark, sf))))


def q_check_prev_violations(spark, sf):
    return check_prev(_corrupt(mart(spark, sf))).select(
        _oid(), "DATE", _m4("DAILY_PAYMENT_AMOUNT").alias("DAILY_PAYMENT_AMOUNT"),
        _m4("PREV_DAILY_PAYMENT_AMOUNT").alias("PREV_DAILY_PAYMENT_AMOUNT"), _m4("PREV_CALC").alias("PREV_CALC"))


def q_freshness_raw_invoices(spark, sf):
    nows = [_dt.datetime.fromisoformat(n) for n in oracle.INVOICE_NOWS]
    return freshness(raw_invoices(spark, sf), "CREATED_AT", nows)


def q_upsert_newest(spark, sf):
    """All later snapshots of every organization, the newest of each winning."""
    raw = raw_organizations(spark, sf)
    c = F.col("ORGANIZATION_ID").cast("bigint")
    v = F.col("COUNT_TOTAL_CONTRACTS_ACTIVE").cast("bigint") - c % 50
    return org_view(upsert(raw.where(v == 0), raw.where(v > 0), ["ORGANIZATION_ID"], order_by=["COUNT_TOTAL_CONTRACTS_ACTIVE"]))


def q_schema_sync(spark, sf):
    """A stored merge whose delta has a new column and lacks another."""
    table = Warehouse(new_scratch(spark, "schema_sync")).fact
    s = stg_inv(spark, sf)
    old = fact_daily_payment(s.where(F.col("CREATED_DATE") <= _cutoff())).withColumn("OLD_NOTE", F.lit("old"))
    write_fact(old, table)
    delta = fact_daily_payment(s.where(F.col("CREATED_DATE") > F.date_sub(_cutoff(), 30)))
    delta = delta.withColumn("N_DIGITS", F.length(F.col("PAYMENT_AMOUNT_USD").cast("bigint").cast("string")))
    merge_partitions(spark, delta, table, FACT_KEY)
    out = read_table(spark, table)
    return out.select(_oid(), "DATE", _m4("PAYMENT_AMOUNT_USD").alias("PAYMENT_AMOUNT_USD"), *out.columns[3:])


def q_check_not_null(spark, sf):
    return fact_view(check_not_null(fact(spark, sf), "DATE"))


def q_check_unique(spark, sf):
    return check_unique(stg_org(spark, sf), ["ORGANIZATION_ID"]).select(_oid(), "N_RECORDS")


def q_check_unique_combo(spark, sf):
    return check_unique(settled(stg_inv(spark, sf)), ["ORGANIZATION_ID", "CREATED_DATE"]).select(
        _oid(), "CREATED_DATE", "N_RECORDS")


def q_check_pct_guard(spark, sf):
    return mart_view(check_pct_guard(mart(spark, sf)))


def q_check_prev_matches_lag(spark, sf):
    return check_prev(mart(spark, sf)).select(
        _oid(), "DATE", _m4("DAILY_PAYMENT_AMOUNT").alias("DAILY_PAYMENT_AMOUNT"),
        _m4("PREV_DAILY_PAYMENT_AMOUNT").alias("PREV_DAILY_PAYMENT_AMOUNT"), _m4("PREV_CALC").alias("PREV_CALC"))


def q_check_summary(spark, sf):
    # As in a build, the layers are made once, the single-row checks are
    # counted as they are written, and only the others read them back.
    tables, counted = {}, {}

    def layer(model, df):
        tables[model], broken = stage_counted(spark, df, f"checked-{model}", row_rules(model))
        counted.update(broken)
        return tables[model]

    layer("raw_organizations", raw_organizations(spark, sf))
    raw = layer("raw_invoices", raw_invoices(spark, sf))
    so = layer("stg_organizations", stage_organizations(tables["raw_organizations"]))
    layer("dim_organizations", dim_organizations(so))
    f = layer("fact_organizations_payment", fact_daily_payment(stage_invoices(raw)))
    layer("mart_daily_org_balance", mart_daily_balance(f))
    return run_checks(tables, counted=counted)


def q_source_freshness(spark, sf):
    nows = [_dt.datetime.fromisoformat(n) for n in oracle.FRESHNESS_NOWS]
    return freshness(read_test_table(spark, sf, "events"), "ts", nows)


def q_csv_scan(spark, sf):
    path = new_scratch(spark, "csv_scan") + "/invoices.csv"
    write_csv(raw_invoices(spark, sf), path)
    return raw_inv_view(read_raw_csv(spark, path, RAW_INVOICES))


def q_csv_multi_file(spark, sf):
    root = new_scratch(spark, "csv_multi")
    raw = raw_invoices(spark, sf)
    k = _order_key(raw)
    write_csv(raw.where(k % 2 == 0), f"{root}/invoices_1.csv")
    write_csv(raw.where(k % 2 == 1), f"{root}/invoices_2.csv.gz", compression="gzip")
    # Files that must be ignored: another table, and a name without the extension.
    write_csv(raw_organizations(spark, sf), f"{root}/organizations.csv")
    write_csv(raw.where(k % 5 == 0), f"{root}/invoices_notes.txt")
    return raw_inv_view(read_raw_csv(spark, root, RAW_INVOICES, INVOICES_GLOB))


def q_upsert_invoices(spark, sf):
    raw = raw_invoices(spark, sf)
    k = _order_key(raw)
    base = raw.where((k % 2 == 0) | (k % 3 == 0))
    upd = raw.where(k % 3 == 0).withColumn("AMOUNT", F.col("AMOUNT") + 1).unionByName(
        raw.where((k % 2 != 0) & (k % 3 != 0)))
    return raw_inv_view(upsert(base, upd, ["INVOICE_ID", "TRANSACTION_ID"], null_as=""))


def q_upsert_organizations(spark, sf):
    """Every row that is not in the base updates it, the greatest of a key winning."""
    raw = raw_organizations(spark, sf)
    c = F.col("ORGANIZATION_ID").cast("bigint")
    v = F.col("COUNT_TOTAL_CONTRACTS_ACTIVE").cast("bigint") - c % 50
    in_base = (v == 0) & ((c % 2 == 0) | (c % 3 == 0))
    return org_view(upsert(raw.where(in_base), raw.where(~in_base), ["ORGANIZATION_ID"], order_by=["COUNT_TOTAL_CONTRACTS_ACTIVE"]))


def _cutoff() -> Column:
    return F.lit(oracle.INCREMENTAL_CUTOFF).cast("date")


def q_incremental_window(spark, sf):
    s = stg_inv(spark, sf)
    target = fact_daily_payment(s.where(F.col("CREATED_DATE") <= _cutoff()))
    return lookback(s, target).select("INVOICE_ID", _oid(), "STATUS", "CREATED_DATE")


def q_incremental_merge(spark, sf):
    wh = Warehouse(new_scratch(spark, "incremental"))
    s = stg_inv(spark, sf)
    write_fact(fact_daily_payment(s.where(F.col("CREATED_DATE") <= _cutoff())), wh.fact)
    refresh_fact(spark, wh, s)
    return fact_view(read_table(spark, wh.fact, FACT_PAYMENTS))


def q_incremental_mart(spark, sf):
    wh = Warehouse(new_scratch(spark, "incremental_mart"))
    s = stg_inv(spark, sf)
    created = F.col("CREATED_DATE")
    write_fact(fact_daily_payment(s.where((created <= _cutoff()) | created.isNull())), wh.fact)
    refresh_mart(spark, wh)                              # mart built on the cut-off fact
    refresh_mart(spark, wh, refresh_fact(spark, wh, s))  # fact merged, mart restated from the window
    return mart_view(read_table(spark, wh.mart, MART_DAILY_BALANCE))


def q_full_refresh(spark, sf):
    wh = Warehouse(new_scratch(spark, "full_refresh"))
    raw = raw_invoices(spark, sf)
    replace_table(spark, raw_organizations(spark, sf), wh.raw_organizations)   # snapshots, several per organization
    load_raw(spark, wh, invoices=raw)
    build(spark, wh, run_tests=False)
    # Later load: some invoices leave the settled statuses.
    k = _order_key(raw)
    load_raw(spark, wh, invoices=raw.where(k % 23 == 0).withColumn("STATUS", F.lit("open")))
    build(spark, wh, full_refresh=True)
    return fact_view(read_table(spark, wh.fact, FACT_PAYMENTS))


def q_upsert_months(spark, sf):
    """Loads into stored RAW invoices, month by month through the key index:
    rows that change, rows that move to another month, and new ones."""
    wh = Warehouse(new_scratch(spark, "upsert_months"))
    raw = raw_invoices(spark, sf)
    k = _order_key(raw)
    load_raw(spark, wh, invoices=raw.where(k % 4 != 0))
    load_raw(spark, wh, invoices=raw.where(k % 4 == 0))
    load_raw(spark, wh, invoices=raw.where(k % 50 == 7).withColumn("AMOUNT", F.col("AMOUNT") + 1).withColumn(
        "CREATED_AT", F.when(k % 100 == 7, F.lit("1995-05-05 00:00:00")).otherwise(F.col("CREATED_AT"))))
    return raw_inv_view(read_table(spark, wh.raw_invoices, RAW_INVOICES))


def q_catalog_comments(spark, sf):
    """The descriptions that the catalog has of a built warehouse."""
    wh = Warehouse(new_scratch(spark, "catalog_comments"))
    replace_table(spark, raw_organizations(spark, sf), wh.raw_organizations)
    load_raw(spark, wh, invoices=raw_invoices(spark, sf))
    build(spark, wh, run_tests=False)
    return catalog_comments(spark, wh.models())


def q_following_views(spark, sf):
    """Views registered before a later load and build: they show its rows."""
    wh = Warehouse(new_scratch(spark, "following_views"))
    views = wh.fact.database + "_views"
    raw = raw_invoices(spark, sf)
    replace_table(spark, raw_organizations(spark, sf), wh.raw_organizations)
    load_raw(spark, wh, invoices=raw.where(F.col("CREATED_AT") < oracle.INCREMENTAL_CUTOFF))
    build(spark, wh, run_tests=False)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {views} LOCATION '{wh.path('views')}'")
    register(spark, wh, views)
    load_raw(spark, wh, invoices=raw.where(~(F.col("CREATED_AT") < oracle.INCREMENTAL_CUTOFF)))
    build(spark, wh, full_refresh=True)
    return mart_view(spark.table(f"{views}.mart_daily_org_balance"))


def q_alerts_function(spark, sf):
    """The templated alerts as a SQL table function over the stored mart, with
    literal, named and bound arguments."""
    wh = Warehouse(new_scratch(spark, "alerts_function"))
    write_fact(busy_day(monthly_mart(spark, sf)), wh.mart)
    f = create_alert_function(spark, wh)
    calls = [
        spark.sql(f"SELECT 'literal' AS CALL, * FROM {f}(NULL, 0.25D, 50000D)"),
        spark.sql(f"SELECT 'default' AS CALL, * FROM {f}()"),
        spark.sql(f"SELECT 'bound' AS CALL, * FROM {f}(allowlist => :allow, denylist => :deny)",
                  args={"allow": oracle.SHORT_ALLOW_IDS, "deny": oracle.SHORT_DENY_IDS}),
    ]
    out = calls[0].unionAll(calls[1]).unionAll(calls[2])
    return out.select("CALL", _oid(), "DATE", _m4("DAILY_PAYMENT_AMOUNT").alias("DAILY_PAYMENT_AMOUNT"),
                      _m4("PREV_DAILY_PAYMENT_AMOUNT").alias("PREV_DAILY_PAYMENT_AMOUNT"), _r6("DOD_CHANGE_PCT").alias("DOD_CHANGE_PCT"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stg_invoices": q_stg_invoices,
    "check_contract": q_check_contract,
    "stg_organizations": q_stg_organizations,
    "settled_invoices": q_settled_invoices,
    "fx_to_usd": q_fx_to_usd,
    "fact_daily_payment": q_fact_daily_payment,
    "dim_organizations": q_dim_organizations,
    "prev_available_day": q_prev_available_day,
    "pct_change": q_pct_change,
    "mart_daily_balance": q_mart_daily_balance,
    "latest_day": q_latest_day,
    "alerts": q_alerts,
    "alerts_top50": q_alerts_top50,
    "alerts_macro": q_alerts_macro,
    "alerts_allow_deny": q_alerts_allow_deny,
    "alert_messages": q_alert_messages,
    "alert_digest": q_alert_digest,
    "check_not_null": q_check_not_null,
    "check_unique": q_check_unique,
    "check_unique_combo": q_check_unique_combo,
    "check_pct_guard": q_check_pct_guard,
    "check_prev_matches_lag": q_check_prev_matches_lag,
    "check_summary": q_check_summary,
    "source_freshness": q_source_freshness,
    "csv_scan": q_csv_scan,
    "csv_multi_file": q_csv_multi_file,
    "upsert_invoices": q_upsert_invoices,
    "upsert_organizations": q_upsert_organizations,
    "incremental_window": q_incremental_window,
    "incremental_merge": q_incremental_merge,
    "incremental_mart": q_incremental_mart,
    "full_refresh": q_full_refresh,
    "alerts_monthly": q_alerts_monthly,
    "alerts_top50_monthly": q_alerts_top50_monthly,
    "alerts_macro_monthly": q_alerts_macro_monthly,
    "alerts_allow_deny_monthly": q_alerts_allow_deny_monthly,
    "alert_messages_monthly": q_alert_messages_monthly,
    "message_numbers": q_message_numbers,
    "check_pct_guard_violations": q_check_pct_guard_violations,
    "check_prev_violations": q_check_prev_violations,
    "freshness_raw_invoices": q_freshness_raw_invoices,
    "upsert_newest": q_upsert_newest,
    "schema_sync": q_schema_sync,
    "upsert_months": q_upsert_months,
    "catalog_comments": q_catalog_comments,
    "following_views": q_following_views,
    "alerts_function": q_alerts_function,
}
