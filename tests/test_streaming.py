"""Load-once landing ingestion through a file stream (availableNow)."""

import os

from ledgerlens.plans.build import Warehouse
from ledgerlens.sources.schemas import RAW_INVOICES
from ledgerlens.sources.tables import read_table
from ledgerlens.streaming import ingest_available

HEADER = ("INVOICE_ID,PARENT_INVOICE_ID,TRANSACTION_ID,ORGANIZATION_ID,TYPE,STATUS,CURRENCY,PAYMENT_CURRENCY,"
          "PAYMENT_METHOD,AMOUNT,PAYMENT_AMOUNT,FX_RATE,FX_RATE_PAYMENT,CREATED_AT\n")


def test_each_file_loaded_once(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    os.makedirs(land)
    wh = Warehouse(os.path.join(tmp_dir, "wh"))
    with open(os.path.join(land, "invoices_day1.csv"), "w") as f:
        f.write(HEADER + "i1,,,1,x,paid,usd,usd,wire,10,,1,,2024-01-01\ni2,,t2,1,x,paid,usd,usd,wire,20,,1,,2024-01-01\n")
    with open(os.path.join(land, "readme.txt"), "w") as f:
        f.write("not a landing file\n")
    ingest_available(spark, land, wh, kinds=("invoices",))
    with open(os.path.join(land, "invoices_day2.csv"), "w") as f:
        f.write(HEADER + "i1,,,1,x,paid,usd,usd,wire,11,,1,,2024-01-02\ni3,,,1,x,paid,usd,usd,wire,30,,1,,2024-01-02\n")
    ingest_available(spark, land, wh, kinds=("invoices",))
    # A third run finds nothing new and leaves the table as it is.
    ingest_available(spark, land, wh, kinds=("invoices",))
    got = sorted((r.INVOICE_ID, r.AMOUNT) for r in read_table(spark, wh.raw_invoices, RAW_INVOICES).collect())
    assert got == [("i1", 11.0), ("i2", 20.0), ("i3", 30.0)]


def test_backlog_with_one_key_in_two_files(spark, tmp_dir):
    """The newest file's row is loaded; a key repeated inside a file, or any
    duplicate when the rule is off, is refused."""
    import time

    import pytest
    from ledgerlens.streaming.landing import start_landing_ingest
    land = os.path.join(tmp_dir, "landing")
    os.makedirs(land)
    for name, amount in (("invoices_a.csv", 10), ("invoices_b.csv", 20)):
        p = os.path.join(land, name)
        with open(p, "w") as f:
            f.write(HEADER + f"i1,,,1,x,paid,usd,usd,wire,{amount},,1,,2024-01-01\ni{amount},,,1,x,paid,usd,usd,wire,1,,1,,2024-01-01\n")
        when = time.time() - (50 if amount == 20 else 0)       # b is the older file
        os.utime(p, (when, when))
    strict = Warehouse(os.path.join(tmp_dir, "strict"))
    with pytest.raises(Exception, match="not unique"):
        start_landing_ingest(spark, land, strict, newest_file_wins=False).awaitTermination()
    wh = Warehouse(os.path.join(tmp_dir, "wh"))
    ingest_available(spark, land, wh, kinds=("invoices",))
    got = sorted((r.INVOICE_ID, r.AMOUNT) for r in read_table(spark, wh.raw_invoices, RAW_INVOICES).collect())
    assert got == [("i1", 10.0), ("i10", 1.0), ("i20", 1.0)]
