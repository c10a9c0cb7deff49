"""Each of the sixteen reference checks catches a deliberately bad input.

A warehouse is built once from the small fixture; for every check, the
model it guards is corrupted in the one way that check exists to catch, and
its failure count must rise over the clean build.
"""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.quality import reference_checks, run_checks
from ledgerlens.plans.build import Warehouse, build, counted_breaches, load_raw, tables
from ledgerlens.plans.sinks import replace_table
from ledgerlens.sources.fixtures import raw_invoices, raw_organizations

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    wh = Warehouse(str(tmp_path_factory.mktemp("checks")))
    replace_table(spark, raw_organizations(spark, SF_SMALL), wh.raw_organizations)
    load_raw(spark, wh, invoices=raw_invoices(spark, SF_SMALL))
    summary = {r.CHECK_NAME: r.FAILURES for r in build(spark, wh, full_refresh=False).collect()}
    return tables(spark, wh), summary


def _one_row(df, where=None):
    src = df.where(where) if where is not None else df
    return src.orderBy(*df.columns).limit(1)


def _corrupt(t, check):
    """The guarded model with one bad row added or changed."""
    df = t[check.model]
    if check.kind == "not_null":
        col = check.columns[0]
        bad = _one_row(df, F.col(col).isNotNull()).withColumn(col, F.lit(None).cast(df.schema[col].dataType))
        return df.unionByName(bad)
    if check.kind == "unique":
        cols = list(check.columns)
        singles = df.groupBy(*cols).count().where("count = 1").drop("count")
        once = df.join(singles, cols, "left_semi").where(F.col(cols[0]).isNotNull())
        return df.unionByName(_one_row(once))
    if check.name == "mart_dod_null_when_prev_zero_or_null":
        first_days = F.col("PREV_DAILY_PAYMENT_AMOUNT").isNull()
        key = _one_row(df, first_days & F.col("DATE").isNotNull()).first()
        hit = (F.col("ORGANIZATION_ID") == key.ORGANIZATION_ID) & (F.col("DATE") == key.DATE)
        return df.withColumn("DOD_CHANGE_PCT", F.when(hit, F.lit(0.25)).otherwise(F.col("DOD_CHANGE_PCT")))
    if check.name == "mart_prev_matches_window":
        key = _one_row(df, F.col("PREV_DAILY_PAYMENT_AMOUNT").isNotNull()).first()
        hit = (F.col("ORGANIZATION_ID") == key.ORGANIZATION_ID) & (F.col("DATE") == key.DATE)
        prev = F.col("PREV_DAILY_PAYMENT_AMOUNT")
        typ = df.schema["PREV_DAILY_PAYMENT_AMOUNT"].dataType
        return df.withColumn("PREV_DAILY_PAYMENT_AMOUNT", F.when(hit, prev + F.lit(1)).otherwise(prev).cast(typ))
    raise AssertionError(f"no corruption for {check.name}")


def test_sixteen_checks_ran(built):
    _, summary = built
    assert len(summary) == 16


CHECK_NAMES = [
    "not_null_raw_organizations_organization_id",
    "not_null_raw_invoices_organization_id",
    "not_null_stg_organizations_organization_id",
    "unique_stg_organizations_organization_id",
    "not_null_dim_organizations_organization_id",
    "unique_dim_organizations_organization_id",
    "not_null_dim_organizations_legal_entity_country_code",
    "not_null_fact_organizations_payment_organization_id",
    "not_null_fact_organizations_payment_date",
    "not_null_fact_organizations_payment_payment_amount_usd",
    "unique_combination_fact_organizations_payment_organization_id_date",
    "not_null_mart_daily_org_balance_organization_id",
    "not_null_mart_daily_org_balance_date",
    "not_null_mart_daily_org_balance_daily_payment_amount",
    "mart_dod_null_when_prev_zero_or_null",
    "mart_prev_matches_window",
]


@pytest.mark.parametrize("name", CHECK_NAMES)
def test_check_catches_bad_input(built, name):
    t, summary = built
    [check] = [c for c in reference_checks(t) if c.name == name]
    bad_tables = dict(t)
    bad_tables[check.model] = _corrupt(t, check)
    [bad] = [c for c in reference_checks(bad_tables) if c.name == name]
    got = {r.CHECK_NAME: r.FAILURES for r in run_checks(bad_tables, [bad]).collect()}
    assert got[name] > summary[name]
