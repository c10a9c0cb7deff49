"""RAW landing tables derived from the driver's test tables.

The reference ships no sample data, so invoices are derived from ``orders``
(one invoice per order) and organization snapshots from ``customer`` and
``nation``. The rules deliberately exercise blanks, mixed-case codes, zero
FX rates, null keys and unparsable timestamps. All expressions are narrow
(row-local), so the derivation scales with the input and never shuffles,
except the join with the 25-row ``nation`` table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.sources.schemas import RAW_INVOICES, RAW_ORGANIZATIONS


def read_test_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text_or_null(cond, value):
    return F.when(cond, value).otherwise(F.lit(None).cast("string"))


def raw_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW.INVOICES rows, one per order (k = ``o_orderkey``)."""
    o = read_test_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    ks = k.cast("string")
    date_t = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    date_s = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    cols = [
        F.concat(F.lit("INV"), ks).alias("INVOICE_ID"),
        _text_or_null(k % 10 == 0, F.concat(F.lit("INV"), (k - 1).cast("string"))).alias("PARENT_INVOICE_ID"),
        _text_or_null(k % 9 != 0, F.concat(F.lit("T"), ks)).alias("TRANSACTION_ID"),
        F.col("o_custkey").cast("decimal(38,0)").alias("ORGANIZATION_ID"),
        F.when(k % 13 == 0, F.lit("")).otherwise(F.lower("o_orderpriority")).alias("TYPE"),
        F.when(F.col("o_orderstatus") == "F", F.lit("paid"))
         .when(F.col("o_orderstatus") == "O", F.lit("Credited"))
         .when((F.col("o_orderstatus") == "P") & (k % 2 == 0), F.lit("REFUNDED"))
         .otherwise(F.lit("open")).alias("STATUS"),
        F.when(k % 3 == 0, F.lit("eur")).when(k % 3 == 1, F.lit("usd")).otherwise(F.lit("gbp")).alias("CURRENCY"),
        F.when(k % 5 == 0, F.lit("")).otherwise(F.lit("usd")).alias("PAYMENT_CURRENCY"),
        F.when(k % 4 == 0, F.lit("")).otherwise(F.lit("wire")).alias("PAYMENT_METHOD"),
        F.col("o_totalprice").cast("double").alias("AMOUNT"),
        F.when(k % 5 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice") * 2.0).alias("PAYMENT_AMOUNT"),
        F.when(k % 11 == 0, F.lit(0.0)).otherwise(F.lit(1.25)).alias("FX_RATE"),
        F.when(k % 7 == 0, F.lit(0.0)).when(k % 3 == 0, F.lit(0.5)).otherwise(F.lit(0.8)).alias("FX_RATE_PAYMENT"),
        F.when(k % 97 == 0, F.lit("n/a")).when(k % 2 == 0, date_t).otherwise(date_s).alias("CREATED_AT"),
    ]
    out = o.select(*cols)
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_INVOICES.fields])


def raw_organizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW.ORGANIZATIONS snapshots: one to three per customer (v <= c % 3)."""
    c = read_test_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read_test_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # Snapshot numbers are generated per row (no cross join): v = 0 .. c % 3.
    snaps = (c.join(n, c.c_nationkey == n.n_nationkey, "inner")
              .withColumn("v", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("c_custkey") % 3))))
    ck, v = F.col("c_custkey"), F.col("v")
    cols = [
        ck.cast("decimal(38,0)").alias("ORGANIZATION_ID"),
        F.lit("2020-01-01").alias("FIRST_PAYMENT_DATE"),
        F.when(ck % 17 == 0, F.lit("bad")).otherwise(F.lit("2021-06-30T00:00:00")).alias("LAST_PAYMENT_DATE"),
        F.when(ck % 19 == 0, F.lit("")).otherwise(F.lower(F.substring("n_name", 1, 2))).alias("LEGAL_ENTITY_COUNTRY_CODE"),
        ((ck % 50) + v).cast("decimal(38,0)").alias("COUNT_TOTAL_CONTRACTS_ACTIVE"),
        _text_or_null(v != 2, F.concat(F.lit("2020-0"), (F.lit(1) + (ck + v) % 9).cast("string"), F.lit("-15")))
        .alias("CREATED_DATE"),
    ]
    out = snaps.select(*cols)
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_ORGANIZATIONS.fields])
