"""Tables, views, descriptions, functions and counts that live in the catalog."""

import os
import re

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import alerts_macro, fact_daily_payment, mart_daily_balance, run_checks, stage_invoices
from ledgerlens.plans import key_index
from ledgerlens.plans.build import (
    RAW_INVOICES_KEY, Warehouse, build, counted_breaches, load_raw, refresh_fact, register, tables)
from ledgerlens.plans.docs import described, persist_comments
from ledgerlens.plans.sinks import cluster, holders, merge_partitions, replace_table, write_fact
from ledgerlens.plans.sql_functions import create_alert_function
from ledgerlens.sources import versions
from ledgerlens.sources.fixtures import raw_invoices, raw_organizations
from ledgerlens.sources.schemas import FACT_PAYMENTS, MART_DAILY_BALANCE, RAW_INVOICES
from ledgerlens.sources.tables import read_partitioned, read_table

from conftest import SF_SMALL
from test_plans import plan
from test_sources_sinks import _fact_rows, _raw_rows, folders


class Lost(RuntimeError):
    """A driver that goes away."""


def lose_at(monkeypatch, step):
    """The driver is gone before its ``step``-th statement on the catalog."""
    left, run = [step], versions._run

    def maybe(spark, statement):
        if not left[0]:
            raise Lost()
        left[0] -= 1
        run(spark, statement)

    monkeypatch.setattr(versions, "_run", maybe)


def day_rows(spark, first, n, start="2024-01-30"):
    return spark.sql(f"select cast({first} + id as decimal(38,0)) ORGANIZATION_ID, date_add(date'{start}', cast(id as int)) DATE, "
                     f"cast({first} as decimal(38,8)) PAYMENT_AMOUNT_USD from range({n})")


@pytest.mark.parametrize("change", ["rebuild", "merge", "first"])
def test_a_run_lost_at_any_statement_leaves_the_old_rows_or_an_error(spark, tmp_path, monkeypatch, change):
    """Before each statement of a switch in turn the driver is lost. Readers
    then see the old rows, the new rows, or no table, and the same run again
    gives the new rows."""
    old, new = day_rows(spark, 1, 4), day_rows(spark, 5, 4)
    for step in range(12):
        t = Warehouse(str(tmp_path / f"{change}{step}")).fact
        if change != "first":
            write_fact(old, t)
        before = _fact_rows(read_table(spark, t)) if change != "first" else None

        def run():
            if change == "merge":
                merge_partitions(spark, new, t, ["ORGANIZATION_ID", "DATE"])
            else:
                write_fact(new, t)

        with monkeypatch.context() as m:
            lose_at(m, step)
            try:
                run()
                finished = True
            except Lost:
                finished = False
        want = sorted((before if change == "merge" else []) + _fact_rows(new))
        if versions.exists(spark, t):
            assert _fact_rows(read_table(spark, t)) in ([before] if not finished else []) + [want]
        else:
            assert not finished
        versions.settle(spark, t)
        assert change == "first" or versions.exists(spark, t)
        run()
        assert _fact_rows(read_table(spark, t)) == want
        if finished:
            break
    assert finished and step > 3


def test_one_changed_month_is_one_statement(spark, tmp_path, monkeypatch):
    t = Warehouse(str(tmp_path)).fact
    write_fact(day_rows(spark, 1, 4), t)
    said = []
    run = versions._run
    monkeypatch.setattr(versions, "_run", lambda spark, statement: (said.append(statement), run(spark, statement)))
    merge_partitions(spark, day_rows(spark, 9, 2, "2024-02-05"), t, ["ORGANIZATION_ID", "DATE"])     # a month that is there
    merge_partitions(spark, day_rows(spark, 9, 2, "2024-03-05"), t, ["ORGANIZATION_ID", "DATE"])     # a new one
    assert [re.search("SET LOCATION|ADD PARTITION|RENAME", s).group() for s in said] == ["SET LOCATION", "ADD PARTITION"]
    assert versions.keys(spark, t) == ["2024-01-01", "2024-02-01", "2024-03-01"]
    assert read_table(spark, t).count() == 8


def test_interrupted_build_is_never_read(spark, tmp_path, monkeypatch):
    wh = Warehouse(str(tmp_path))
    raw = raw_invoices(spark, SF_SMALL)
    load_raw(spark, wh, invoices=raw)
    replace_table(spark, raw_organizations(spark, SF_SMALL), wh.raw_organizations)
    build(spark, wh, run_tests=False)
    n = read_table(spark, wh.fact, FACT_PAYMENTS).count()
    with monkeypatch.context() as m:
        m.setattr(versions, "_swap", lambda *a: (_ for _ in ()).throw(Lost()))
        with pytest.raises(Lost):
            build(spark, wh, full_refresh=True)
        assert read_table(spark, wh.fact, FACT_PAYMENTS).count() == n
    build(spark, wh, run_tests=False)
    assert _fact_rows(read_table(spark, wh.fact, FACT_PAYMENTS)) == _fact_rows(fact_daily_payment(stage_invoices(raw)))


def test_superseded_folders_are_removed_and_live_ones_kept(spark, tmp_path):
    t = Warehouse(str(tmp_path)).fact
    write_fact(day_rows(spark, 1, 4), t)                                             # January and February
    merge_partitions(spark, day_rows(spark, 9, 2, "2024-02-05"), t, ["ORGANIZATION_ID", "DATE"])
    rows = _fact_rows(read_table(spark, t))
    assert versions.remove_superseded(spark, t, keep_hours=0) == []                  # January still lies in the first
    write_fact(day_rows(spark, 1, 4), t)
    assert versions.superseded(spark, t) == []                                       # too young
    assert len(versions.remove_superseded(spark, t, keep_hours=0)) == 2
    assert len([d for d in os.listdir(t.location) if d.startswith("version-")]) == 1
    assert _fact_rows(read_table(spark, t)) == _fact_rows(day_rows(spark, 1, 4)) != rows


def test_empty_tables_and_null_months(spark, tmp_path):
    wh = Warehouse(str(tmp_path))
    none = day_rows(spark, 1, 4).limit(0)
    write_fact(none, wh.fact)
    assert read_table(spark, wh.fact).count() == 0 and versions.keys(spark, wh.fact) == []
    undated = day_rows(spark, 1, 2).withColumn("DATE", F.lit(None).cast("date"))
    merge_partitions(spark, undated, wh.fact, ["ORGANIZATION_ID", "DATE"])
    assert versions.keys(spark, wh.fact) == [versions.NULL]
    merge_partitions(spark, undated.limit(1), wh.fact, ["ORGANIZATION_ID", "DATE"])
    assert read_partitioned(spark, wh.fact, FACT_PAYMENTS).where("MONTH is null").count() == 2
    merge_partitions(spark, none, wh.fact, ["ORGANIZATION_ID", "DATE"])
    assert read_table(spark, wh.fact).count() == 2


# --- descriptions and views ------------------------------------------------------------
@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    wh = Warehouse(str(tmp_path_factory.mktemp("catalog")))
    replace_table(spark, raw_organizations(spark, SF_SMALL), wh.raw_organizations)
    load_raw(spark, wh, invoices=raw_invoices(spark, SF_SMALL).where("CREATED_AT < '1998'"))
    build(spark, wh, run_tests=False)
    return wh


def test_descriptions_are_in_the_catalog(spark, built):
    cols = {c.name: c.description for c in spark.catalog.listColumns(built.mart.name)}
    assert cols["DOD_CHANGE_PCT"].startswith("Percent change vs previous available day") and not cols["DATE"]
    assert described(spark, built.dim_organizations.name) == {"": "Organization dimension with key dates and metadata."}
    t = versions.Table(built.mart.database, built.mart.model, built.mart.location, built.mart.partition,
                       "it's new", {"DATE": "the \\ day"})
    persist_comments(spark, t)
    assert described(spark, t.name) == {"": "it's new", "DATE": "the \\ day"}
    persist_comments(spark, built.mart)
    assert described(spark, t.name)["DAILY_PAYMENT_AMOUNT"] == "USD payment amount for the day"
    assert "DATE" not in described(spark, t.name)


def test_views_follow_their_tables(spark, tmp_path):
    wh = Warehouse(str(tmp_path))
    raw = raw_invoices(spark, SF_SMALL)
    replace_table(spark, raw_organizations(spark, SF_SMALL), wh.raw_organizations)
    load_raw(spark, wh, invoices=raw.where("CREATED_AT < '1996'"))
    build(spark, wh, run_tests=False)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS reg_test LOCATION '{tmp_path}/views'")
    register(spark, wh)
    register(spark, wh, "reg_test")
    register(spark, wh, "reg_test")                        # our own views are replaced
    n = spark.table("reg_test.fact_organizations_payment").count()
    load_raw(spark, wh, invoices=raw.where("CREATED_AT >= '1996'"))
    build(spark, wh, run_tests=False)                      # merged
    rows = read_table(spark, wh.fact).count()
    assert rows > n and spark.table("reg_test.fact_organizations_payment").count() == rows
    assert spark.table("fact_organizations_payment").count() == rows
    build(spark, wh, full_refresh=True)                    # rebuilt
    rows = read_table(spark, wh.mart).count()
    assert spark.table("reg_test.mart_daily_org_balance").count() == rows == spark.table("mart_daily_org_balance").count()
    assert described(spark, "reg_test.dim_organizations")[""] == "Organization dimension with key dates and metadata."
    assert described(spark, "reg_test.mart_daily_org_balance")["DAILY_PAYMENT_AMOUNT"] == "USD payment amount for the day"
    # a column that a merge adds is in the view at once
    merge_partitions(spark, day_rows(spark, 1, 1).withColumn("NOTE", F.lit("n")), wh.fact, ["ORGANIZATION_ID", "DATE"])
    assert "NOTE" in spark.table("reg_test.fact_organizations_payment").columns
    for t in spark.catalog.listTables():
        if t.isTemporary:
            spark.catalog.dropTempView(t.name)


def test_register_leaves_foreign_tables_alone(spark, built, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS foreign_test LOCATION '{tmp_path}/db'")
    spark.createDataFrame([(1,)], "x int").write.option("path", str(tmp_path / "foreign")).saveAsTable(
        "foreign_test.raw_organizations")
    with pytest.raises(ValueError, match="left as it is"):
        register(spark, built, "foreign_test")
    assert spark.table("foreign_test.raw_organizations").columns == ["x"]


# --- checks that were counted on the way ---------------------------------------------------
def test_counted_checks_equal_scanned_ones(spark, tmp_path):
    wh = Warehouse(str(tmp_path))
    raw = raw_invoices(spark, SF_SMALL)
    nameless = raw.withColumn("ORGANIZATION_ID", F.when(F.col("INVOICE_ID").endswith("7"), F.lit(None)).otherwise(
        F.col("ORGANIZATION_ID")).cast("decimal(38,0)"))
    replace_table(spark, raw_organizations(spark, SF_SMALL), wh.raw_organizations)

    def both():
        scanned = {r.CHECK_NAME: r.FAILURES for r in run_checks(tables(spark, wh)).collect()}
        counted = counted_breaches(spark, wh)
        assert len(counted) == 12 and {k: scanned[k] for k in counted} == counted
        assert {r.CHECK_NAME: r.FAILURES for r in run_checks(tables(spark, wh), counted=counted).collect()} == scanned
        return counted

    load_raw(spark, wh, invoices=nameless.where("CREATED_AT < '1997'"))
    build(spark, wh, run_tests=False)
    first = both()
    assert first["not_null_raw_invoices_organization_id"] > 0 and first["not_null_fact_organizations_payment_organization_id"] > 0
    load_raw(spark, wh, invoices=nameless.where("CREATED_AT >= '1997'"))      # more months with breaches, and undated rows
    build(spark, wh, run_tests=False)
    assert both()["not_null_raw_invoices_organization_id"] > first["not_null_raw_invoices_organization_id"]
    load_raw(spark, wh, invoices=raw)                                         # every row mended
    build(spark, wh, full_refresh=True)
    mended = both()
    assert mended["not_null_raw_invoices_organization_id"] == 0 and mended["not_null_fact_organizations_payment_date"] == 13


def test_counted_checks_read_nothing(spark, built):
    t = tables(spark, built)
    def scans(df):
        return len(re.findall(r"^\(\d+\) Scan parquet", plan(df), re.M))

    # three uniqueness checks and one window; the other twelve are literals
    assert scans(run_checks(t, counted=counted_breaches(spark, built))) == 4
    assert scans(run_checks(t)) == 4 + 6 + 1  # one for the not-null checks of each of six models, one for the percentages


# --- the key index --------------------------------------------------------------------------
def test_a_small_load_reads_no_key_of_an_untouched_month(spark, tmp_path):
    wh = Warehouse(str(tmp_path))
    raw = raw_invoices(spark, SF_SMALL)
    load_raw(spark, wh, invoices=raw)
    some = raw.where(F.col("CREATED_AT").startswith("1996-03")).orderBy("INVOICE_ID").limit(10)
    keys = spark.createDataFrame(
        [(r.INVOICE_ID, r.TRANSACTION_ID or "") for r in some.collect()], "K0 string, K1 string").withColumn(
        "MONTH", F.lit("1998-01-01").cast("date"))
    known = key_index.lookup(spark, wh.raw_invoices_keys, keys)
    p = plan(known)
    scan = [ln for ln in p.splitlines() if "PartitionFilters: [" in ln and "BUCKET" in ln]
    assert scan and len(re.findall(r"\b\d+\b", re.search(r"BUCKET#\d+ IN \(([^)]*)\)", p).group(1))) <= 10
    assert {str(r.MONTH) for r in known.collect()} == {"1996-03-01"} and known.count() == 10
    found = holders(versions.read(spark, wh.raw_invoices), "CREATED_MONTH", ["1996-03-01"], RAW_INVOICES_KEY, "", keys)
    p = plan(found)
    assert re.search(r"PartitionFilters: \[isnotnull\(CREATED_MONTH#\d+\), \(CREATED_MONTH#\d+ = 1996-03-01\)\]", p)
    assert re.search(r"ReadSchema: struct<INVOICE_ID:string,TRANSACTION_ID:string>", p) and found.count() == 10


def test_loads_through_the_index_equal_a_plain_upsert(spark, tmp_path, monkeypatch):
    """Rows that move between months, back again, and a rebuilt index."""
    from ledgerlens.operators import upsert
    monkeypatch.setattr(key_index, "LOADS", 2)
    wh = Warehouse(str(tmp_path))
    raw = raw_invoices(spark, SF_SMALL)
    load_raw(spark, wh, invoices=raw.where("INVOICE_ID <> 'INV1'"))
    want = raw.where("INVOICE_ID <> 'INV1'")
    steps = [raw.where("INVOICE_ID like 'INV%3'").withColumn("CREATED_AT", F.lit("2005-01-01 00:00:00")),
             raw.where("INVOICE_ID like 'INV%33'"),                                     # some move back
             raw.where("INVOICE_ID = 'INV1' or INVOICE_ID = 'INV2'").withColumn("CREATED_AT", F.lit("n/a")),
             raw.where("INVOICE_ID like 'INV%3'").withColumn("TRANSACTION_ID", F.nullif("TRANSACTION_ID", F.lit(""))),
             raw.limit(0)]
    for upd in steps:
        load_raw(spark, wh, invoices=upd)
        want = upsert(want, upd, RAW_INVOICES_KEY, null_as="")
        assert _raw_rows(read_table(spark, wh.raw_invoices, RAW_INVOICES)) == _raw_rows(want)
    assert "2005-01-01" not in versions.keys(spark, wh.raw_invoices)


def test_a_table_rebuilt_by_other_means_is_indexed_anew(spark, tmp_path):
    from ledgerlens.plans.build import raw_invoice_month
    wh = Warehouse(str(tmp_path))
    raw = raw_invoices(spark, SF_SMALL)
    load_raw(spark, wh, invoices=raw.where("CREATED_AT < '1994'"))
    replace_table(spark, raw.withColumn("CREATED_MONTH", raw_invoice_month()), wh.raw_invoices, ["INVOICE_ID"])
    moved = raw.where("INVOICE_ID like 'INV%3'").withColumn("CREATED_AT", F.lit("2005-01-01 00:00:00"))
    load_raw(spark, wh, invoices=moved)
    got = read_table(spark, wh.raw_invoices, RAW_INVOICES)
    assert got.count() == raw.count() and got.where("CREATED_AT = '2005-01-01 00:00:00'").count() == moved.count()


def test_a_load_that_was_lost_is_loaded_by_the_next_run(spark, tmp_path, monkeypatch):
    wh = Warehouse(str(tmp_path))
    raw = raw_invoices(spark, SF_SMALL)
    load_raw(spark, wh, invoices=raw)
    moved = raw.where("INVOICE_ID like 'INV%3'").withColumn("CREATED_AT", F.lit("2005-01-01 00:00:00"))
    with monkeypatch.context() as m:
        lose_at(m, 3)
        with pytest.raises(Lost):
            load_raw(spark, wh, invoices=moved)
    load_raw(spark, wh, invoices=moved)
    got = read_table(spark, wh.raw_invoices, RAW_INVOICES)
    assert got.count() == raw.count() and got.where("CREATED_AT = '2005-01-01 00:00:00'").count() == moved.count()


# --- layout ---------------------------------------------------------------------------------
def test_files_of_a_month_and_skipped_row_groups(spark, tmp_path):
    """A month is one file where it is small, several where it is hot, and
    sorted by day inside, so a day's filter skips row groups."""
    import pyarrow.parquet as pq
    rows = spark.sql("select cast(id % 7000 as decimal(38,0)) ORGANIZATION_ID, date_add(date'2024-01-01', cast(id % 60 as int)) DATE, "
                     "cast(id as decimal(38,8)) PAYMENT_AMOUNT_USD from range(400000)").repartition(8)
    wh = Warehouse(str(tmp_path))
    spark.conf.set("parquet.block.size", 64 << 10)
    try:
        write_fact(rows, wh.fact)
    finally:
        spark.conf.unset("parquet.block.size")
    folder = versions.folder_of(spark, wh.fact, "2024-01-01").removeprefix("file:")
    files = [f for f in os.listdir(folder) if f.endswith(".parquet")]
    assert len(files) == 1
    meta = pq.ParquetFile(os.path.join(folder, files[0])).metadata
    column = [i for i in range(meta.num_columns) if meta.schema.column(i).name == "DATE"][0]
    ranges = [(s.min, s.max) for s in (meta.row_group(i).column(column).statistics for i in range(meta.num_row_groups))]
    assert len(ranges) > 4 and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))     # in order of DATE
    day = ranges[len(ranges) // 2][0]
    assert sum(a <= day <= b for a, b in ranges) <= len(ranges) // 2
    assert f"PushedFilters: [IsNotNull(DATE), EqualTo(DATE,{day})]" in plan(read_table(spark, wh.fact).where(F.col("DATE") == F.lit(day)))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        write_fact(rows, wh.fact)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    folder = versions.folder_of(spark, wh.fact, "2024-01-01").removeprefix("file:")
    assert 1 < len([f for f in os.listdir(folder) if f.endswith(".parquet")]) <= 16
    assert "repartitionByRange" not in plan(cluster(rows, ["DATE"], "DATE")) and "REBALANCE" in plan(cluster(rows, ["DATE"], "DATE"))


# --- the table function ------------------------------------------------------------------------
def test_alert_function_gives_the_rows_of_the_macro(spark, built):
    f = create_alert_function(spark, built)
    mart = read_table(spark, built.mart, MART_DAILY_BALANCE)
    day = str(mart.where("DOD_CHANGE_PCT <> 0").groupBy("DATE").count().orderBy(F.desc("count"), "DATE").first().DATE)
    ids = [str(r[0]) for r in mart.where(F.col("DATE") == day).orderBy("DOD_CHANGE_PCT").select("ORGANIZATION_ID").collect()][::-1]

    def rows(df):
        return [tuple(r) for r in df.orderBy("ORGANIZATION_ID").collect()]

    for date, threshold, least, allow, deny in [
            (None, 0.5, 0.0, "", ""), (day, 0.0, 0.0, "", ""), (day, 0.1, 1000.0, "", ids[0]),
            (day, 0.0, 0.0, ",".join(ids[:3]), ids[1]), (day, 0.0, 0.0, " " + ids[0], ""), (day, 0.0, 0.0, "it's", "")]:
        want = rows(alerts_macro(mart, date, threshold, least, allow, deny))
        bound = spark.sql(f"SELECT * FROM {f}(:day, :t, :m, :a, :d)", args={"day": date, "t": threshold, "m": least, "a": allow, "d": deny})
        assert rows(bound) == want
        literal = f"SELECT * FROM {f}(alert_date => {versions.text(date) if date else 'NULL'}, threshold => {threshold}D, " \
                  f"min_abs => {least}D, allowlist => {versions.text(allow)}, denylist => {versions.text(deny)})"
        assert rows(spark.sql(literal)) == want
    assert rows(spark.sql(f"SELECT * FROM {f}(alert_date => '{day}', threshold => 0D)")) != []
    here = spark.catalog.currentDatabase()
    create_alert_function(spark, built, built.mart.database)
    spark.sql(f"DROP TEMPORARY FUNCTION {f}")
    spark.sql(f"USE {built.mart.database}")
    try:
        assert rows(spark.sql(f"SELECT * FROM {f}(alert_date => '{day}', threshold => 0D)")) != []
    finally:
        spark.sql(f"USE {here}")
    create_alert_function(spark, built)
    p = plan(spark.sql(f"SELECT * FROM {f}(alert_date => '{day}')"))
    assert re.search(r"PartitionFilters: \[isnotnull\(MONTH#\d+\), \(MONTH#\d+ = ", p)


def test_a_build_leaves_no_stray_table(spark, built):
    names = {t.name for t in spark.catalog.listTables(built.mart.database) if not t.isTemporary}
    assert names == {t.model for t in [*built.models(), built.raw_invoices_keys]}
    refresh_fact(spark, built, stage_invoices(raw_invoices(spark, SF_SMALL)), full_refresh=True)
    assert _fact_rows(read_table(spark, built.fact)) == _fact_rows(fact_daily_payment(stage_invoices(raw_invoices(spark, SF_SMALL))))
    assert mart_daily_balance(read_table(spark, built.fact)).count() > read_table(spark, built.mart).count()
