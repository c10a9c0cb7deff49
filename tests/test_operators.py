"""Operators on hand-sized relations, including deliberately bad inputs."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators import (
    ContractError,
    DuplicateKeyError,
    alert_messages,
    alerts,
    alerts_macro,
    check_not_null,
    check_pct_guard,
    check_prev,
    check_unique,
    dim_organizations,
    enforce_contract,
    fact_daily_payment,
    freshness,
    latest_day,
    lookback,
    mart_daily_balance,
    merge_incremental,
    run_checks,
    stage_invoices,
    stage_organizations,
    top_alerts,
    upsert,
)
from ledgerlens.sources.schemas import FACT_PAYMENTS, RAW_INVOICES, RAW_ORGANIZATIONS, STG_INVOICES

d = dt.date


def fact_df(spark, rows):
    return spark.createDataFrame(
        [(D(o), day, None if a is None else D(str(a))) for o, day, a in rows], FACT_PAYMENTS)


def test_mart_skips_gap_days(spark):
    f = fact_df(spark, [(1, d(2024, 1, 1), 100), (1, d(2024, 1, 2), 150), (1, d(2024, 1, 5), 0),
                        (1, d(2024, 1, 6), 80), (1, d(2024, 1, 7), -40), (1, d(2024, 1, 8), -20)])
    got = [(r.DATE.day, float(r.DAILY_PAYMENT_AMOUNT),
            None if r.PREV_DAILY_PAYMENT_AMOUNT is None else float(r.PREV_DAILY_PAYMENT_AMOUNT), r.DOD_CHANGE_PCT)
           for r in mart_daily_balance(f).orderBy("DATE").collect()]
    assert got == [(1, 100, None, None), (2, 150, 100, 0.5), (5, 0, 150, -1.0), (6, 80, 0, None),
                   (7, -40, 80, -1.5), (8, -20, -40, 0.5)]


def test_mart_null_dates_sort_last(spark):
    f = fact_df(spark, [(1, None, 5), (1, d(2024, 1, 1), 10), (1, d(2024, 1, 2), 20)])
    m = {r.DATE: r.PREV_DAILY_PAYMENT_AMOUNT for r in mart_daily_balance(f).collect()}
    assert m[None] == D("20") and m[d(2024, 1, 1)] is None


def _raw_inv(spark, rows):
    full = []
    for r in rows:
        base = dict(INVOICE_ID=None, PARENT_INVOICE_ID=None, TRANSACTION_ID=None, ORGANIZATION_ID=D(1), TYPE="",
                    STATUS="paid", CURRENCY="usd", PAYMENT_CURRENCY="usd", PAYMENT_METHOD="wire", AMOUNT=100.0,
                    PAYMENT_AMOUNT=None, FX_RATE=1.0, FX_RATE_PAYMENT=None, CREATED_AT="2024-01-01 10:00:00")
        base.update(r)
        full.append(tuple(base[f.name] for f in RAW_INVOICES.fields))
    return spark.createDataFrame(full, RAW_INVOICES)


def test_staging_and_fact(spark):
    raw = _raw_inv(spark, [
        dict(INVOICE_ID="a", STATUS="Paid", AMOUNT=100.0, FX_RATE=1.25),
        dict(INVOICE_ID="b", STATUS="refunded", PAYMENT_AMOUNT=100.0, FX_RATE_PAYMENT=0.8),
        dict(INVOICE_ID="c", STATUS="open", AMOUNT=999.0),
        dict(INVOICE_ID="d", STATUS="credited", AMOUNT=10.0, FX_RATE=0.0),          # no usable rate
        dict(INVOICE_ID="e", STATUS="PAID", AMOUNT=10.0, CREATED_AT="2024-01-02T23:59:59"),
        dict(INVOICE_ID="f", STATUS="PAID", AMOUNT=1.0, CREATED_AT="garbage"),
    ])
    stg = stage_invoices(raw)
    assert stg.schema == STG_INVOICES
    assert stg.where("INVOICE_ID = 'a'").first().TYPE is None
    fact = {(r.DATE,): r.PAYMENT_AMOUNT_USD for r in fact_daily_payment(stg).collect()}
    assert fact == {(d(2024, 1, 1),): D("205.00000000"), (d(2024, 1, 2),): D("10.00000000"),
                    (None,): D("1.00000000")}


def test_dim_latest_nulls_last(spark):
    raw = spark.createDataFrame([
        (D(1), "2020-01-01", "x", "de", D(1), "2020-01-15"),
        (D(1), "2020-01-01", "x", "de", D(2), "2020-03-15"),
        (D(1), "2020-01-01", "x", "de", D(3), None),
        (D(2), "2020-01-01", "x", "", D(4), None),
    ], RAW_ORGANIZATIONS)
    dim = {r.ORGANIZATION_ID: r for r in dim_organizations(stage_organizations(raw)).collect()}
    assert dim[D(1)].COUNT_TOTAL_CONTRACTS_ACTIVE == D(2) and dim[D(1)].CREATED_DATE == d(2020, 3, 15)
    assert dim[D(2)].LEGAL_ENTITY_COUNTRY_CODE is None and dim[D(2)].FIRST_PAYMENT_DATE == d(2020, 1, 1)
    assert dim[D(1)].LAST_PAYMENT_DATE is None


def test_lookback_window(spark):
    target = fact_df(spark, [(1, d(2024, 1, 10), 1)])
    stg = spark.createDataFrame([(d(2024, 1, 3),), (d(2024, 1, 2),), (None,)], "CREATED_DATE date")
    assert [r[0] for r in lookback(stg, target).collect()] == [d(2024, 1, 3)]
    empty = target.limit(0)
    assert lookback(stg, empty).count() == 2


def _mart(spark, rows):
    f = fact_df(spark, rows)
    return mart_daily_balance(f)


def test_alerts_live_and_macro(spark):
    day1, day2 = d(2024, 1, 1), d(2024, 1, 2)
    m = _mart(spark, [(1, day1, 2000), (1, day2, 3000),    # +1000, 0.5 -> live only
                      (2, day2, 5000),                     # new org -> live only
                      (3, day1, 2000), (3, day2, 500),     # -1500, -0.75 -> both
                      (4, day1, 1000), (4, day2, 1400),    # +400 -> none
                      (5, day1, 100), (5, day2, 900)])     # +800, 8.0 -> macro with m=0
    live = [r.ORGANIZATION_ID for r in alerts(m, threshold=0.5, min_abs=1000).collect()]
    assert live == [D(2), D(3), D(1)]  # abs change desc, then id
    assert [r.ORGANIZATION_ID for r in alerts_macro(m, min_abs=1000).collect()] == [D(3)]
    assert [r.ORGANIZATION_ID for r in alerts_macro(m).collect()] == [D(3), D(5)]
    assert [r.ORGANIZATION_ID for r in alerts_macro(m, allow="3,5", deny="5").collect()] == [D(3)]
    assert [r.ORGANIZATION_ID for r in alerts_macro(m, alert_date="2024-01-01").collect()] == []
    assert top_alerts(m, 2, min_abs=1000).count() == 2
    assert latest_day(m).first().ALERT_DATE == "2024-01-02"


def test_alert_messages_text(spark):
    m = _mart(spark, [(7, d(2024, 1, 1), 1000), (7, d(2024, 1, 2), 2234.5625), (8, d(2024, 1, 2), 5000)])
    rows = {r.ORGANIZATION_ID: r for r in alert_messages(alerts(m, min_abs=0)).collect()}
    assert rows[D(7)].MESSAGE_LINE == "• org `7` | Δ=1,234.56 (123.5%) | today=2,234.56 prev=1,000.00"
    assert rows[D(8)].MESSAGE_LINE == "• org `8` | Δ=5,000.00 (n/a) | today=5,000.00 prev=0.00"
    assert rows[D(8)].MESSAGE_BLOCK == (
        ":rotating_light: *Balance Change Alert*\n• Org: `8`\n• Date: 2024-01-02\n"
        "• Today's Amount: 5000.00000000\n• Previous Day: None\n• DoD Change: *n/a* (Δ=5,000.00)")


def test_upsert_null_equals_blank(spark):
    base = spark.createDataFrame([("i1", None, 1.0), ("i2", "t2", 2.0), ("i3", "", 3.0)], "k1 string, k2 string, v double")
    upd = spark.createDataFrame([("i1", "", 10.0), ("i3", None, 30.0), ("i4", None, 40.0)], "k1 string, k2 string, v double")
    got = sorted((r.k1, r.v) for r in upsert(base, upd, ["k1", "k2"], null_as="").collect())
    assert got == [("i1", 10.0), ("i2", 2.0), ("i3", 30.0), ("i4", 40.0)]
    # Without the null rule a null key never matches.
    got_strict = sorted((r.k1, r.v) for r in upsert(base, upd.where("k1 = 'i1'"), ["k1", "k2"]).collect())
    assert got_strict == [("i1", 1.0), ("i1", 10.0), ("i2", 2.0), ("i3", 3.0)]


def test_upsert_duplicate_keys(spark):
    base = spark.createDataFrame([(1, "a", 1)], "k int, v string, seq int")
    upd = spark.createDataFrame([(1, "b", 2), (1, "c", 3)], "k int, v string, seq int")
    with pytest.raises(DuplicateKeyError):
        upsert(base, upd, ["k"])
    assert [r.v for r in upsert(base, upd, ["k"], order_by=["seq"]).collect()] == ["c"]


def test_merge_never_deletes_and_syncs_schema(spark):
    target = fact_df(spark, [(1, d(2024, 1, 1), 5), (2, d(2024, 1, 1), 7)])
    delta = fact_df(spark, [(1, d(2024, 1, 1), 6), (3, d(2024, 1, 2), 1)])
    got = sorted((int(r.ORGANIZATION_ID), float(r.PAYMENT_AMOUNT_USD)) for r in
                 merge_incremental(target, delta, ["ORGANIZATION_ID", "DATE"]).collect())
    assert got == [(1, 6.0), (2, 7.0), (3, 1.0)]
    wider = delta.withColumn("NOTE", F.lit("x"))
    synced = merge_incremental(target, wider.drop("PAYMENT_AMOUNT_USD"), ["ORGANIZATION_ID", "DATE"])
    assert synced.columns == ["ORGANIZATION_ID", "DATE", "NOTE"]
    assert merge_incremental(target, wider, ["ORGANIZATION_ID", "DATE"]).where("NOTE is null").count() == 1


def test_contract(spark):
    ok = spark.createDataFrame([], STG_INVOICES)
    assert enforce_contract(ok.select(*reversed(ok.columns)), STG_INVOICES).columns == ok.columns
    with pytest.raises(ContractError, match="AMOUNT"):
        enforce_contract(ok.withColumn("AMOUNT", F.col("AMOUNT").cast("double")), STG_INVOICES)
    with pytest.raises(ContractError, match="absent"):
        enforce_contract(ok.drop("CREATED_DATE"), STG_INVOICES)
    with pytest.raises(ContractError, match="EXTRA"):
        enforce_contract(ok.withColumn("EXTRA", F.lit(1)), STG_INVOICES)


def test_checks_catch_bad_inputs(spark):
    good = _mart(spark, [(1, d(2024, 1, 1), 100), (1, d(2024, 1, 2), 0), (1, d(2024, 1, 3), 50)])
    assert check_pct_guard(good).count() == 0 and check_prev(good).count() == 0
    bad_pct = good.withColumn("DOD_CHANGE_PCT", F.lit(1.0))
    assert check_pct_guard(bad_pct).count() == 2
    bad_prev = good.withColumn("PREV_DAILY_PAYMENT_AMOUNT", F.lit(D("1")).cast("decimal(38,8)"))
    assert check_prev(bad_prev).count() == 3
    # Null and 0 are equal for the reference check, not for the strict variant.
    zero_null = good.withColumn("PREV_DAILY_PAYMENT_AMOUNT", F.when(F.col("DATE") == d(2024, 1, 3), None)
                                .otherwise(F.col("PREV_DAILY_PAYMENT_AMOUNT")))
    assert check_prev(zero_null).count() == 0 and check_prev(zero_null, strict=True).count() == 1
    ids = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "id int")
    assert check_not_null(ids, "id").count() == 2
    assert [tuple(r) for r in check_unique(ids, ["id"]).collect()] == [(1, 2)]
    pairs = spark.createDataFrame([(1, None), (1, None), (1, 2)], "a int, b int")
    assert [tuple(r) for r in check_unique(pairs, ["a", "b"]).collect()] == [(1, None, 2)]


def test_run_checks_summary(spark):
    f = fact_df(spark, [(1, d(2024, 1, 1), 1), (1, d(2024, 1, 1), 2), (1, None, 3)])
    s = {r.CHECK_NAME: (r.FAILURES, r.STATUS) for r in
         run_checks({"fact_organizations_payment": f, "mart_daily_org_balance": mart_daily_balance(f)}).collect()}
    assert s["not_null_fact_organizations_payment_date"] == (1, "fail")
    assert s["unique_combination_fact_organizations_payment_organization_id_date"] == (1, "fail")
    assert s["not_null_fact_organizations_payment_organization_id"] == (0, "pass")
    assert len(s) == 9


def test_run_checks_stores_failures(spark, tmp_path):
    f = fact_df(spark, [(1, d(2024, 1, 1), 1), (1, d(2024, 1, 1), 2), (1, None, 3)])
    out = str(tmp_path / "audit")
    s = {r.CHECK_NAME: r.FAILURES for r in run_checks({"fact_organizations_payment": f}, store_failures=out).collect()}
    stored = {name: spark.read.parquet(f"{out}/{name}").count() for name in s}
    assert stored["not_null_fact_organizations_payment_date"] == 1
    assert stored["unique_combination_fact_organizations_payment_organization_id_date"] == 1
    assert stored["not_null_fact_organizations_payment_organization_id"] == 0


def test_freshness_levels(spark):
    ev = spark.createDataFrame([(dt.datetime(2024, 1, 30, 23, 57, 12),)], "ts timestamp_ntz")
    nows = [dt.datetime(2024, 1, 31, 12), dt.datetime(2024, 2, 2, 0, 30), dt.datetime(2024, 2, 10),
            dt.datetime(2024, 2, 1, 23, 57, 12)]
    got = [(r.AGE_HOURS, r.STATUS) for r in freshness(ev, "ts", nows).collect()]
    assert got == [(12, "pass"), (48, "warn"), (240, "error"), (48, "pass")]
    empty = spark.createDataFrame([], T.StructType([T.StructField("ts", T.TimestampNTZType())]))
    assert freshness(empty, "ts", nows[0]).first().STATUS == "error"


def test_alert_digest_caps_and_all_clear(spark):
    from ledgerlens.operators.alerts import alert_digest
    rows = [(i, d(2024, 1, 1), 100) for i in range(1, 61)] + [(i, d(2024, 1, 2), 100 + 10 * i) for i in range(1, 61)]
    m = _mart(spark, rows)
    r = alert_digest(m, threshold=0.5, min_abs=0, cap=50).first()
    lines = r.MESSAGE.split("\n")
    assert r.N_ALERTS == 56 and len(lines) == 51  # ids 5..60 rose >= 50 %; header + 50 lines
    assert lines[0] == "*Daily Balance alerts* for `2024-01-02`  (threshold=0.50, min_abs=0)"
    assert lines[1].startswith("• org `60` | Δ=600.00 (600.0%)")
    quiet = alert_digest(m, threshold=100.0, min_abs=1000).first()
    assert quiet.N_ALERTS == 0
    assert quiet.MESSAGE == ":white_check_mark: No Daily Balance alerts for 2024-01-02 (threshold=100.00, min_abs=1,000)."


def test_digest_without_an_alert_day_raises(spark):
    from ledgerlens.operators.alerts import alert_digest
    from ledgerlens.sources.schemas import MART_DAILY_BALANCE
    with pytest.raises(Exception, match="no alert day"):
        alert_digest(spark.createDataFrame([], MART_DAILY_BALANCE)).collect()


def test_freshness_of_text_timestamps_and_fractions(spark):
    from ledgerlens.operators import freshness
    df = spark.createDataFrame([("n/a",), ("2024-01-01T10:00:00",), (None,), ("",)], "CREATED_AT string")
    r = freshness(df, "CREATED_AT", dt.datetime(2024, 1, 3, 10, 0, 0, 1)).first()
    assert str(r.MAX_LOADED_AT) == "2024-01-01 10:00:00" and r.STATUS == "warn" and r.AGE_HOURS == 48
    assert freshness(df.where("CREATED_AT = 'n/a'"), "CREATED_AT", dt.datetime(2024, 1, 3)).first().STATUS == "error"
