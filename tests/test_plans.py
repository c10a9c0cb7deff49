"""Plan guards: the scale properties the design relies on, pinned via EXPLAIN,
plus behaviour at scale boundaries (untouched partitions, a hot key)."""

import contextlib
import io
import os
import re
from decimal import Decimal as D

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import (
    alerts,
    dim_organizations,
    fact_daily_payment,
    mart_daily_balance,
    run_checks,
    stage_invoices,
    top_alerts,
    upsert,
)
from ledgerlens.plans.build import Warehouse, build, load_raw, refresh_fact
from ledgerlens.plans.sinks import replace_table, write_fact
from ledgerlens.sources import versions
from ledgerlens.sources.fixtures import raw_invoices, raw_organizations
from ledgerlens.sources.schemas import FACT_PAYMENTS, MART_DAILY_BALANCE, STG_INVOICES, STG_ORGANIZATIONS
from ledgerlens.sources.tables import high_water_mark, read_partitioned, read_table

SF_SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def wh(spark, tmp_path_factory):
    w = Warehouse(str(tmp_path_factory.mktemp("plans")))
    replace_table(spark, raw_organizations(spark, SF_SMALL), w.raw_organizations)
    load_raw(spark, w, invoices=raw_invoices(spark, SF_SMALL))
    build(spark, w, run_tests=False)
    return w


def test_fact_combines_before_shuffle_and_prunes_scan(spark, wh):
    stg = read_table(spark, wh.stg_invoices, STG_INVOICES)
    p = plan(fact_daily_payment(stg, already_upper=True))
    assert "partial_sum" in p
    assert "hashpartitioning(ORGANIZATION_ID" in p
    assert "PushedFilters: [In(STATUS, [CREDITED,PAID,REFUNDED])]" in p
    read = [ln for ln in p.splitlines() if ln.startswith("ReadSchema")]
    assert len(read) == 1 and "INVOICE_ID" not in read[0] and "CREATED_AT" not in read[0]


def test_lookback_is_pushed_and_reads_newest_month_only(spark, wh):
    stg = read_table(spark, wh.stg_invoices, STG_INVOICES)
    target = read_partitioned(spark, wh.fact, FACT_PAYMENTS)
    p = plan(fact_daily_payment(stg, target=target, already_upper=True))
    assert "GreaterThanOrEqual(CREATED_DATE,ScalarSubquery" in p
    # max(DATE) of the target reads one month, found from the partition column.
    assert "PartitionFilters: [isnotnull(MONTH" in p
    newest_month = plan(target.agg(F.max("MONTH")))
    assert "ReadSchema: struct<>" in newest_month


def test_high_water_mark_equals_plain_max(spark, wh):
    stored = read_partitioned(spark, wh.fact, FACT_PAYMENTS)
    got = stored.select(high_water_mark(stored).alias("m")).first().m
    assert got == stored.agg(F.max("DATE")).first()[0]


def test_newest_day_comes_from_footers(spark, wh):
    from ledgerlens.sources.tables import footer_max, stored_max
    newest = max(k for k in versions.keys(spark, wh.fact) if k != versions.NULL)
    p = plan(footer_max(spark, versions.folder_of(spark, wh.fact, newest), "DATE"))
    assert "PushedAggregation: [MAX(DATE)]" in p
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")      # only that scan is another kind
    day = stored_max(spark, wh.fact)
    assert day == read_table(spark, wh.fact).agg(F.max("DATE")).first()[0]
    stg = read_partitioned(spark, wh.stg_invoices, STG_INVOICES)
    p = plan(fact_daily_payment(stg, target=day, already_upper=True))
    assert re.search(r"PartitionFilters: \[isnotnull\(CREATED_MONTH#\d+\), \(CREATED_MONTH#\d+ >= \d{4}-\d\d-01\)\]", p)
    assert "Subquery" not in p and "GreaterThanOrEqual(CREATED_DATE," in p
    by_subquery = fact_daily_payment(stg, target=read_partitioned(spark, wh.fact, FACT_PAYMENTS), already_upper=True)
    by_literal = fact_daily_payment(stg, target=day, already_upper=True)
    assert by_subquery.exceptAll(by_literal).count() == by_literal.exceptAll(by_subquery).count() == 0 < by_literal.count()


def test_newest_day_of_an_empty_or_undated_table(spark, tmp_path):
    from ledgerlens.sources.tables import stored_max
    w = Warehouse(str(tmp_path))
    none = spark.createDataFrame([], FACT_PAYMENTS)
    write_fact(none, w.fact)
    assert stored_max(spark, w.fact) is None
    assert refresh_fact(spark, w, stage_invoices(raw_invoices(spark, SF_SMALL))).count() > 0   # all of them are new
    write_fact(spark.sql("select cast(1 as decimal(38,0)) ORGANIZATION_ID, cast(null as date) DATE, cast(1 as decimal(38,8)) PAYMENT_AMOUNT_USD"), w.fact)
    assert stored_max(spark, w.fact) is None


def test_alert_reads_one_month_without_nested_loops(spark, wh):
    mart = read_partitioned(spark, wh.mart, MART_DAILY_BALANCE)
    p = plan(alerts(mart, min_abs=0.0))
    assert "PartitionFilters: [isnotnull(MONTH" in p and "= Subquery" in p
    assert "EqualTo(DATE,ScalarSubquery" in p
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct"):
        assert bad not in p
    assert "TakeOrderedAndProject" in plan(top_alerts(mart, 50, min_abs=0.0))


def node_ids(p: str, op: str, detail: str = "") -> list[int]:
    """Ids of the ``op`` nodes of a formatted plan (ids count up from the scan)
    whose detail section contains ``detail``."""
    sections = re.split(r"\n(?=\(\d+\) )", p)
    return [int(m.group(1)) for sec in sections
            if (m := re.match(r"\((\d+)\) " + op, sec)) and detail in sec]


def test_dimension_reduces_per_task_before_shuffle(spark, wh):
    so = read_table(spark, wh.stg_organizations, STG_ORGANIZATIONS)
    p = plan(dim_organizations(so))
    partial = node_ids(p, r"\w*Aggregate", "partial_max")
    assert partial and min(partial) < min(node_ids(p, "Exchange"))
    assert "Window" not in p


def test_upsert_anti_join_ships_keys_only(spark, wh):
    so = read_table(spark, wh.stg_organizations, STG_ORGANIZATIONS)
    upd = read_table(spark, wh.dim_organizations)
    p = plan(upsert(so, upd, ["ORGANIZATION_ID"], check_duplicates=False))
    assert "LeftAnti" in p
    assert "ReadSchema: struct<ORGANIZATION_ID:decimal(38,0)>" in p


def test_not_null_checks_share_one_scan(spark, wh):
    fact = read_table(spark, wh.fact, FACT_PAYMENTS)
    p = plan(run_checks({"fact_organizations_payment": fact}))
    scans = [ln for ln in p.splitlines() if ln.startswith("Location:") and "fact_organizations_payment" in ln]
    assert len(scans) == 2  # one pass for the 3 not-null checks, one for the key uniqueness


def folders(spark, t):
    return {k: versions.folder_of(spark, t, k) for k in versions.keys(spark, t)}


def _files(path):
    out = {}
    for d, _, fs in os.walk(path):
        for f in fs:
            if f.endswith(".parquet"):
                p = os.path.join(d, f)
                out[os.path.relpath(p, path)] = os.stat(p).st_mtime_ns
    return out


def test_merge_rewrites_only_touched_months(spark, tmp_path):
    stg = stage_invoices(raw_invoices(spark, SF_SMALL))
    wh = Warehouse(str(tmp_path))
    write_fact(fact_daily_payment(stg.where(F.col("CREATED_DATE") <= "1998-06-30")), wh.fact)
    before, files = folders(spark, wh.fact), _files(wh.fact.location)
    refresh_fact(spark, wh, stg)
    after = folders(spark, wh.fact)
    # Window = max(DATE) - 7 days: of the months that existed, only those
    # overlapping the window have new files; later months are new.
    assert all(_files(wh.fact.location)[p] == t for p, t in files.items())    # old files stay as they are
    assert len(before) > 40
    switched = {k for k in after if after[k] != before.get(k)}
    assert min(switched) == "1998-06-01" and "1998-05-01" in before
    recent = read_partitioned(spark, wh.fact, FACT_PAYMENTS).where("MONTH >= date'1998-06-01'").inputFiles()
    assert recent and not {re.search("version-[^/]*", f).group() for f in recent} & {p.split("/")[0] for p in files}


def test_hot_organization_with_a_third_of_all_invoices(spark):
    """One organization holds a third of the invoices; sums and the mart stay
    exact, and the fact still combines per task before the shuffle."""
    raw = raw_invoices(spark, SF_SMALL)
    k = F.substring("INVOICE_ID", 4, 32).cast("bigint")
    hot = raw.withColumn("ORGANIZATION_ID", F.when(k % 3 == 0, F.lit(D(7)).cast("decimal(38,0)"))
                         .otherwise(F.col("ORGANIZATION_ID")))
    stg = stage_invoices(hot)
    fact = fact_daily_payment(stg)
    assert "partial_sum" in plan(fact)
    got = {(int(r.ORGANIZATION_ID), r.DATE): r.PAYMENT_AMOUNT_USD
           for r in fact.where(F.col("DATE").isNotNull()).collect()}

    pdf = stg.select("ORGANIZATION_ID", "STATUS", "CREATED_DATE", "AMOUNT", "FX_RATE",
                     "PAYMENT_AMOUNT", "FX_RATE_PAYMENT").toPandas()
    pdf = pdf[pdf.STATUS.isin(["CREDITED", "REFUNDED", "PAID"]) & pdf.CREATED_DATE.notna()]

    def usd(r):
        if r.PAYMENT_AMOUNT is not None and r.FX_RATE_PAYMENT not in (None, 0):
            return r.PAYMENT_AMOUNT / r.FX_RATE_PAYMENT
        if r.AMOUNT is not None and r.FX_RATE not in (None, 0):
            return r.AMOUNT / r.FX_RATE
        return None

    pdf["USD"] = pdf.apply(usd, axis=1)
    pdf = pdf[pdf.USD.notna()]
    want = {(int(o), d): s for (o, d), s in
            pdf.groupby(["ORGANIZATION_ID", "CREATED_DATE"]).USD.agg(lambda x: sum(x)).items()}
    assert set(got) == set(want)
    assert all(abs(float(got[key]) - float(want[key])) < 1e-6 for key in want)
    assert sum(1 for (o, _) in got if o == 7) > len(got) / 10

    mart = mart_daily_balance(fact).where(F.col("ORGANIZATION_ID") == 7).orderBy("DATE").toPandas()
    days = mart[mart.DATE.notna()]
    assert days.PREV_DAILY_PAYMENT_AMOUNT.iloc[1:].tolist() == days.DAILY_PAYMENT_AMOUNT.iloc[:-1].tolist()
    assert pd.isna(days.PREV_DAILY_PAYMENT_AMOUNT.iloc[0])


def test_raw_month_filter_prunes_partitions(spark, tmp_path):
    from ledgerlens.sources.schemas import RAW_INVOICES_PARTITION
    w = Warehouse(str(tmp_path))
    load_raw(spark, w, invoices=raw_invoices(spark, SF_SMALL))
    base = versions.read(spark, w.raw_invoices)
    m = F.col(RAW_INVOICES_PARTITION)
    p = plan(base.where(versions.partition_filter(m, ["1996-03-01", versions.NULL])))
    assert re.search(r"PartitionFilters: \[\(\(CREATED_MONTH#\d+ = 1996-03-01\) OR isnull\(CREATED_MONTH", p)
    some = base.where(versions.partition_filter(m, ["1996-03-01", versions.NULL])).inputFiles()
    assert {re.search("CREATED_MONTH=([^/]*)", f).group(1) for f in some} == {"1996-03-01", "__HIVE_DEFAULT_PARTITION__"}
    got = base.where(versions.partition_filter(m, ["1996-03-01"])).count()
    assert got == base.where(F.col("CREATED_AT").startswith("1996-03")).count() > 0


def test_raw_load_keeps_files_per_month_few(spark, tmp_path):
    """Many input tasks still write about one file for each month."""
    w = Warehouse(str(tmp_path))
    load_raw(spark, w, invoices=raw_invoices(spark, SF_SMALL).repartition(16))
    months = versions.keys(spark, w.raw_invoices)
    assert len(_files(w.raw_invoices.location)) == len(months)


def test_daily_build_stages_only_changed_months(spark, tmp_path):
    from ledgerlens.plans.build import stage_layer
    w = Warehouse(str(tmp_path))
    raw = raw_invoices(spark, SF_SMALL)
    replace_table(spark, raw_organizations(spark, SF_SMALL), w.raw_organizations)
    load_raw(spark, w, invoices=raw)
    assert stage_layer(spark, w) is None
    before = folders(spark, w.stg_invoices)
    load_raw(spark, w, invoices=raw.where(F.col("CREATED_AT").startswith("1996-03")).withColumn("STATUS", F.lit("open")))
    assert stage_layer(spark, w) == ["1996-03-01"]
    after = folders(spark, w.stg_invoices)
    assert {k for k in after if after[k] != before[k]} == {"1996-03-01"} and after.keys() == before.keys()
    assert stage_layer(spark, w) == []
    stg = read_table(spark, w.stg_invoices, STG_INVOICES)
    assert stg.count() == raw.count() and stg.where("STATUS <> 'OPEN' and CREATED_DATE >= '1996-03-01' and CREATED_DATE < '1996-04-01'").count() == 0


def test_lookback_lists_only_recent_staged_months(spark, wh):
    stg = read_partitioned(spark, wh.stg_invoices, STG_INVOICES)
    target = read_partitioned(spark, wh.fact, FACT_PAYMENTS)
    p = plan(fact_daily_payment(stg, target=target, already_upper=True))
    assert re.search(r"PartitionFilters: \[isnotnull\(CREATED_MONTH#\d+\), .*CREATED_MONTH#\d+ >= ", p)


def test_seeds_read_months_since_the_kept_start(spark, tmp_path):
    """A daily restatement finds previous days from the kept seeds and the
    months since; the result equals the one from the whole history."""
    import datetime as dt
    from ledgerlens.plans.build import refresh_seeds, seeds_since
    w = Warehouse(str(tmp_path))
    stg = stage_invoices(raw_invoices(spark, SF_SMALL))
    write_fact(fact_daily_payment(stg), w.fact)
    fact = read_partitioned(spark, w.fact, FACT_PAYMENTS)

    def want(day):
        return {(int(r.ORGANIZATION_ID), r.DATE) for r in fact.where(F.col("DATE") < F.lit(day)).groupBy(
            "ORGANIZATION_ID").agg(F.max("DATE").alias("DATE")).collect()}

    for day in (dt.date(1996, 5, 10), dt.date(1996, 7, 3), dt.date(1995, 2, 2)):   # first, later, earlier start
        got = refresh_seeds(spark, w, fact, day)
        assert {(int(r.ORGANIZATION_ID), r.DATE) for r in got.collect()} == want(day)
    assert seeds_since(spark, w) == "1995-02-02"
    refresh_fact(spark, w, stg, full_refresh=True)                                  # rebuilt: seeds start over
    assert seeds_since(spark, w) is None
    fact = read_partitioned(spark, w.fact, FACT_PAYMENTS)
    got = refresh_seeds(spark, w, fact, dt.date(1996, 8, 1))
    assert {(int(r.ORGANIZATION_ID), r.DATE) for r in got.collect()} == want(dt.date(1996, 8, 1))


def test_scratch_folder_must_be_shared_off_local_mode(spark, monkeypatch):
    from ledgerlens import session

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        def __init__(self, folder):
            self.conf = {"spark.checkpoint.dir": folder}

    for folder in (None, "relative/folder"):
        with pytest.raises(RuntimeError, match="checkpoint.dir"):
            session.scratch_root(Session(folder))
    assert session.scratch_root(Session("hdfs://x/y/")) == "hdfs://x/y"
