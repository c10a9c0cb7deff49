"""CSV landing reads, table sinks, incremental build vs full refresh."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import fact_daily_payment, mart_daily_balance, stage_invoices
from ledgerlens.plans.build import (
    Warehouse,
    build,
    ingest_landing,
    load_raw,
    refresh_fact,
    refresh_mart,
    tables,
)
from ledgerlens.plans.sinks import replace_table, write_fact
from ledgerlens.sources.csv import INVOICES_GLOB, read_raw_csv
from ledgerlens.sources.fixtures import raw_invoices, raw_organizations
from ledgerlens.sources.schemas import FACT_PAYMENTS, MART_DAILY_BALANCE, RAW_INVOICES, RAW_ORGANIZATIONS
from ledgerlens.sources import versions
from ledgerlens.sources.tables import read_table

from conftest import SF_SMALL

HEADER = ("INVOICE_ID,PARENT_INVOICE_ID,TRANSACTION_ID,ORGANIZATION_ID,TYPE,STATUS,CURRENCY,PAYMENT_CURRENCY,"
          "PAYMENT_METHOD,AMOUNT,PAYMENT_AMOUNT,FX_RATE,FX_RATE_PAYMENT,CREATED_AT\n")


def _write(path, text, gz=False):
    if gz:
        with gzip.open(path, "wt") as f:
            f.write(text)
    else:
        with open(path, "w") as f:
            f.write(text)


def test_csv_edge_cases(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "invoices_a.csv"), HEADER +
           'i1,,NULL,1,"",paid,usd,,wire,10.5,NULL,1,0.8,2024-01-01\n'
           'i2,p,"t ""q""",2,"multi\nline",open,eur,usd,,NULL,3,1,1,"2024-01-02T10:00:00"\n')
    _write(os.path.join(tmp_dir, "invoices_b.csv.gz"), HEADER + "i3,,t3,3,x,paid,usd,usd,wire,1,1,1,1,n/a\n", gz=True)
    _write(os.path.join(tmp_dir, "organizations.csv"), "ORGANIZATION_ID\n1\n")
    _write(os.path.join(tmp_dir, "invoices_notes.txt"), HEADER + "bad,row\n")
    df = read_raw_csv(spark, tmp_dir, RAW_INVOICES, INVOICES_GLOB)
    rows = {r.INVOICE_ID: r for r in df.collect()}
    assert set(rows) == {"i1", "i2", "i3"}
    assert rows["i1"].PARENT_INVOICE_ID is None and rows["i1"].TRANSACTION_ID is None
    assert rows["i1"].TYPE is None and rows["i1"].PAYMENT_AMOUNT is None
    assert rows["i2"].TRANSACTION_ID == 't "q"' and rows["i2"].TYPE == "multi\nline"
    assert rows["i2"].AMOUNT is None and rows["i3"].CREATED_AT == "n/a"


def test_csv_failfast_on_bad_number(spark, tmp_dir):
    p = os.path.join(tmp_dir, "invoices.csv")
    _write(p, HEADER + "i1,,t,1,x,paid,usd,usd,wire,not-a-number,1,1,1,2024-01-01\n")
    with pytest.raises(Exception):
        read_raw_csv(spark, p, RAW_INVOICES).collect()


def _fact_rows(df):
    return sorted(((int(r.ORGANIZATION_ID), r.DATE, r.PAYMENT_AMOUNT_USD) for r in df.collect()),
                  key=lambda t: (t[0], t[1] is None, t[1] or 0))


def test_incremental_equals_full_over_window(spark, tmp_dir):
    """Property: a target built up to a cut-off day, then merged over all
    invoices, equals a full build (non-null days)."""
    stg = stage_invoices(raw_invoices(spark, SF_SMALL))
    full = fact_daily_payment(stg)
    for cut in ("1999-12-31", "2001-06-30"):
        wh = Warehouse(os.path.join(tmp_dir, cut))
        write_fact(fact_daily_payment(stg.where(F.col("CREATED_DATE") <= cut)), wh.fact)
        refresh_fact(spark, wh, stg)
        got = read_table(spark, wh.fact, FACT_PAYMENTS)
        assert _fact_rows(got) == _fact_rows(full.where("DATE is not null"))


def _mart_rows(df):
    return sorted(((int(r.ORGANIZATION_ID), r.DATE, r.DAILY_PAYMENT_AMOUNT, r.PREV_DAILY_PAYMENT_AMOUNT,
                    r.DOD_CHANGE_PCT) for r in df.collect()), key=lambda t: (t[0], t[1] is None, t[1]))


def test_incremental_mart_equals_full_rebuild(spark, tmp_dir):
    """Property: restating the mart from the first changed day (with seed
    rows) equals rebuilding it, null-dated rows included; a run that stopped
    after the fact merge is caught up by the next run."""
    stg = stage_invoices(raw_invoices(spark, SF_SMALL))
    created = F.col("CREATED_DATE")
    want = _mart_rows(mart_daily_balance(fact_daily_payment(stg)))
    for cut, mid in (("1996-03-31", None), ("1997-12-31", "1998-03-31")):
        wh = Warehouse(os.path.join(tmp_dir, cut))
        write_fact(fact_daily_payment(stg.where((created <= cut) | created.isNull())), wh.fact)
        refresh_mart(spark, wh)                      # full build of the mart
        if mid:                                      # fact merged, mart not
            refresh_fact(spark, wh, stg.where(created <= mid))
        refresh_mart(spark, wh, refresh_fact(spark, wh, stg))
        got = _mart_rows(read_table(spark, wh.mart, MART_DAILY_BALANCE))
        assert got == want
        assert any(r[1] is None for r in got)


def test_build_stale_key_survives_incremental_not_full_refresh(spark, tmp_dir):
    wh = Warehouse(tmp_dir)
    raw = raw_invoices(spark, SF_SMALL)
    load_raw(spark, wh, organizations=None, invoices=raw)
    replace_table(spark, raw_organizations(spark, SF_SMALL), wh.raw_organizations)
    summary = {r.CHECK_NAME: r.FAILURES for r in build(spark, wh).collect()}
    assert len(summary) == 16
    assert summary["not_null_fact_organizations_payment_date"] == 13
    assert summary["unique_stg_organizations_organization_id"] == 100
    latest = read_table(spark, wh.fact, FACT_PAYMENTS).where("DATE is not null").orderBy(F.desc("DATE")).first()
    stg = read_table(spark, wh.stg_invoices)
    victims = stg.where((F.col("ORGANIZATION_ID") == latest.ORGANIZATION_ID) & (F.col("CREATED_DATE") == latest.DATE))
    keys = [r.INVOICE_ID for r in victims.collect()]
    update = raw.where(F.col("INVOICE_ID").isin(keys)).withColumn("STATUS", F.lit("open"))
    load_raw(spark, wh, invoices=update)

    def has_key():
        f = read_table(spark, wh.fact, FACT_PAYMENTS)
        return f.where((F.col("ORGANIZATION_ID") == latest.ORGANIZATION_ID) & (F.col("DATE") == latest.DATE)).count()

    build(spark, wh, run_tests=False)
    assert has_key() == 1          # a merge never deletes
    build(spark, wh, full_refresh=True)
    assert has_key() == 0          # a full refresh does
    assert read_table(spark, wh.raw_invoices, RAW_INVOICES).count() == raw.count()
    assert set(tables(spark, wh)) >= {"mart_daily_org_balance", "dim_organizations"}


def test_ingest_landing_upserts(spark, tmp_dir):
    wh = Warehouse(os.path.join(tmp_dir, "wh"))
    land = os.path.join(tmp_dir, "landing")
    os.makedirs(land)
    _write(os.path.join(land, "organizations.csv"),
           "ORGANIZATION_ID,FIRST_PAYMENT_DATE,LAST_PAYMENT_DATE,LEGAL_ENTITY_COUNTRY_CODE,"
           "COUNT_TOTAL_CONTRACTS_ACTIVE,CREATED_DATE\n1,2020-01-01,,de,3,2020-01-02\n")
    _write(os.path.join(land, "invoices.csv"), HEADER + "i1,,,1,x,paid,usd,usd,wire,10,,1,,2024-01-01\n"
                                                        "i2,,t2,1,x,paid,usd,usd,wire,20,,1,,2024-01-01\n")
    ingest_landing(spark, wh, land)
    _write(os.path.join(land, "invoices.csv"), HEADER + "i1,,,1,x,paid,usd,usd,wire,11,,1,,2024-01-01\n"
                                                        "i3,,,1,x,paid,usd,usd,wire,30,,1,,2024-01-01\n")
    ingest_landing(spark, wh, land)
    got = sorted((r.INVOICE_ID, r.AMOUNT) for r in read_table(spark, wh.raw_invoices, RAW_INVOICES).collect())
    assert got == [("i1", 11.0), ("i2", 20.0), ("i3", 30.0)]
    assert read_table(spark, wh.raw_organizations, RAW_ORGANIZATIONS).count() == 1


def test_failing_checks_gate_the_alerts(spark, tmp_dir):
    from ledgerlens.plans.build import ChecksFailed, daily_run
    wh = Warehouse(tmp_dir)
    load_raw(spark, wh, invoices=raw_invoices(spark, SF_SMALL).where("CREATED_AT <> 'n/a'"))
    orgs = raw_organizations(spark, SF_SMALL).dropDuplicates(["ORGANIZATION_ID"]).withColumn(
        "LEGAL_ENTITY_COUNTRY_CODE", F.lit("de"))
    replace_table(spark, orgs, wh.raw_organizations)
    assert "MESSAGE_LINE" in daily_run(spark, wh, min_abs=0.0).columns
    bad = orgs.withColumn("ORGANIZATION_ID", F.lit(None).cast("decimal(38,0)")).limit(1)
    replace_table(spark, orgs.unionByName(bad), wh.raw_organizations)
    with pytest.raises(ChecksFailed) as e:
        daily_run(spark, wh)
    assert ("not_null_raw_organizations_organization_id", 1) in e.value.failures
    summary = {r.CHECK_NAME: r.STATUS for r in build(spark, wh, on_failure="report").collect()}
    assert summary["not_null_raw_organizations_organization_id"] == "fail"


def folders(spark, t):
    """Partition value -> where the catalog has its files."""
    return {k: versions.folder_of(spark, t, k) for k in versions.keys(spark, t)}


def test_fact_and_downstream_refresh_leaves_staging_alone(spark, tmp_dir):
    from ledgerlens.plans.build import refresh_downstream
    wh = Warehouse(tmp_dir)
    load_raw(spark, wh, invoices=raw_invoices(spark, SF_SMALL))
    replace_table(spark, raw_organizations(spark, SF_SMALL), wh.raw_organizations)
    build(spark, wh, run_tests=False)
    before = [folders(spark, t) for t in (wh.stg_invoices, wh.dim_organizations, wh.fact, wh.mart)]
    refresh_downstream(spark, wh)
    after = [folders(spark, t) for t in (wh.stg_invoices, wh.dim_organizations, wh.fact, wh.mart)]
    assert after[:2] == before[:2]
    for old, new in zip(before[2:], after[2:]):
        assert old.keys() == new.keys() and not set(old.values()) & set(new.values())


def test_stored_merge_syncs_added_and_dropped_columns(spark, tmp_dir):
    from ledgerlens.plans.sinks import merge_partitions
    t = Warehouse(tmp_dir).fact
    old = spark.sql("select cast(1 as decimal(38,0)) ORGANIZATION_ID, date'2024-01-01' DATE, 1 A, 2 B, 1.5 PAYMENT_AMOUNT_USD union all "
                    "select 2, date'2024-02-01', 3, 4, 2.5")
    write_fact(old, t)
    before = folders(spark, t)
    merge_partitions(spark, spark.sql("select cast(2 as decimal(38,0)) ORGANIZATION_ID, date'2024-02-01' DATE, 5 A, 'n' C, 3.5 PAYMENT_AMOUNT_USD"),
                     t, ["ORGANIZATION_ID", "DATE"])
    got = read_table(spark, t)
    assert got.columns == ["ORGANIZATION_ID", "DATE", "A", "C", "PAYMENT_AMOUNT_USD"]
    assert sorted((int(r[0]), r.A, r.C) for r in got.collect()) == [(1, 1, None), (2, 5, "n")]
    assert folders(spark, t)["2024-01-01"] == before["2024-01-01"]


def _raw_rows(df):
    return sorted(tuple("" if v is None else str(v) for v in r) for r in df.select(*RAW_INVOICES.fieldNames()).collect())


def _month_files(path):
    out = {}
    for d, _, fs in os.walk(path):
        for f in fs:
            if f.endswith(".parquet"):
                p = os.path.join(d, f)
                out[os.path.relpath(p, path)] = os.stat(p).st_mtime_ns
    return out


def test_raw_invoice_upsert_rewrites_only_involved_months(spark, tmp_dir):
    from ledgerlens.operators import upsert
    wh = Warehouse(tmp_dir)
    raw = raw_invoices(spark, SF_SMALL)
    load_raw(spark, wh, invoices=raw)
    before = folders(spark, wh.raw_invoices)
    files = _month_files(wh.raw_invoices.location)
    assert len(before) > 40      # stored by month of CREATED_AT
    k = F.substring("INVOICE_ID", 4, 32).cast("bigint")
    in_month = raw.where(F.col("CREATED_AT").startswith("1996-03"))
    moved_key = in_month.orderBy("INVOICE_ID").first().INVOICE_ID
    upd = (in_month.where(k % 2 == 0).withColumn("STATUS", F.lit("open"))             # same month
           .unionByName(raw.where(F.col("INVOICE_ID") == moved_key)
                        .withColumn("CREATED_AT", F.lit("1998-07-01 00:00:00")))      # moves month
           .unionByName(raw.where(k < 40).withColumn("INVOICE_ID", F.concat(F.lit("NEW"), "INVOICE_ID"))
                        .withColumn("CREATED_AT", F.lit("1998-07-02 00:00:00"))))     # inserts
    upd = upd.dropDuplicates(["INVOICE_ID", "TRANSACTION_ID"])
    want = _raw_rows(upsert(raw, upd, ["INVOICE_ID", "TRANSACTION_ID"], null_as=""))
    load_raw(spark, wh, invoices=upd)
    got = read_table(spark, wh.raw_invoices, RAW_INVOICES)
    assert _raw_rows(got) == want
    after = folders(spark, wh.raw_invoices)
    assert {k for k in after if after[k] != before.get(k)} == {"1996-03-01", "1998-07-01"}
    assert all(_month_files(wh.raw_invoices.location)[p] == t for p, t in files.items())

    # An update that moves every invoice out of a month: the month drops out,
    # the others but the receiving one keep their files.
    cur = read_table(spark, wh.raw_invoices, RAW_INVOICES)
    upd2 = cur.where(F.col("CREATED_AT").startswith("1996-03")).withColumn("CREATED_AT", F.lit("1996-04-15 00:00:00"))
    want2 = _raw_rows(upsert(cur, upd2, ["INVOICE_ID", "TRANSACTION_ID"], null_as=""))
    load_raw(spark, wh, invoices=upd2)
    assert _raw_rows(read_table(spark, wh.raw_invoices, RAW_INVOICES)) == want2
    last = folders(spark, wh.raw_invoices)
    assert after.keys() - last.keys() == {"1996-03-01"}
    assert {k for k in last if last[k] != after[k]} == {"1996-04-01"}


def test_newest_update_wins_when_asked(spark, tmp_dir):
    from ledgerlens.operators import DuplicateKeyError
    wh = Warehouse(tmp_dir)
    raw = raw_invoices(spark, SF_SMALL).limit(20)
    twice = raw.unionByName(raw.withColumn("AMOUNT", F.col("AMOUNT") + 1))
    with pytest.raises(DuplicateKeyError):
        load_raw(spark, wh, invoices=twice)
    load_raw(spark, wh, invoices=twice, order_by=["AMOUNT"])
    want = {r.INVOICE_ID: r.AMOUNT + 1 for r in raw.collect()}
    assert {r.INVOICE_ID: r.AMOUNT for r in read_table(spark, wh.raw_invoices, RAW_INVOICES).collect()} == want


def test_large_csv_files_are_split_without_multi_line(spark, tmp_dir):
    path = os.path.join(tmp_dir, "invoices.csv")
    _write(path, HEADER + "".join(f"i{i},,t{i},1,x,paid,usd,usd,wire,{i},1,1,1,2024-01-01\n" for i in range(4000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        parts = [read_raw_csv(spark, path, RAW_INVOICES, multi_line=m).rdd.getNumPartitions() for m in (True, False)]
        assert parts[0] == 1 and parts[1] > 4
        assert read_raw_csv(spark, path, RAW_INVOICES, multi_line=False).count() == 4000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
