"""Which months of a table may hold a key: a table of (key, month) pairs,
partitioned by a hash bucket of the key.

A lookup reads only the buckets of the keys asked for. The index may name a
month that no longer holds a key (the row moved, or a load was lost after its
keys were added); it never lacks a month that does. Loads append; after
:data:`LOADS` of them the index is built anew, which joins its small files and
drops what is out of date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.sources import versions
from ledgerlens.sources.versions import Table

BUCKET = T.StructField("BUCKET", T.IntegerType())
#: Keys of a bucket when the index is built, and the bounds of the number of buckets.
BUCKET_KEYS, LEAST, MOST = 1 << 20, 16, 1 << 14
LOADS = 64
_BUCKETS, _LOADS = "ledgerlens.buckets", "ledgerlens.loads"


def _key_names(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("K") and c[1:].isdigit()]


def _bucket(names: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*names), F.lit(buckets)).cast("int")


def _facts(spark: SparkSession, index: Table) -> tuple[int, int]:
    said = versions.properties(spark, index)
    return int(said[_BUCKETS]), int(said.get(_LOADS, "0"))


def build(spark: SparkSession, keys: DataFrame, index: Table, buckets: int | None = None) -> None:
    """Make the index of ``keys`` (K0, K1, …, MONTH); as many buckets as its
    size asks for, a power of two."""
    if buckets is None:
        buckets = LEAST
        n = keys.count()
        while buckets < MOST and buckets * BUCKET_KEYS < n:
            buckets *= 2
    rows = keys.withColumn(BUCKET.name, _bucket(_key_names(keys), buckets))
    versions.replace(spark, rows.hint("rebalance", F.col(BUCKET.name)).sortWithinPartitions(BUCKET.name, "K0"), index,
                     {_BUCKETS: str(buckets), _LOADS: "0"})


def is_scattered(spark: SparkSession, index: Table) -> bool:
    return _facts(spark, index)[1] >= LOADS


def lookup(spark: SparkSession, index: Table, keys: DataFrame) -> DataFrame:
    """The pairs (K0, …, MONTH) that the index has of ``keys`` (stored). The
    buckets asked for are collected (at most :data:`MOST` numbers) and become
    a literal partition filter."""
    buckets, _ = _facts(spark, index)
    names = _key_names(keys)
    asked = [r[0] for r in keys.select(_bucket(names, buckets)).distinct().collect()]
    rows = versions.read(spark, index)
    if len(asked) < buckets:
        rows = rows.where(F.col(BUCKET.name).isin(asked) if asked else F.lit(False))
    return rows.join(keys.select(*[F.col(c).alias(f"_{c}") for c in names]),
                     [F.col(c) == F.col(f"_{c}") for c in names], "left_semi").select(*names, "MONTH")


def add(spark: SparkSession, index: Table, keys: DataFrame, known: DataFrame) -> None:
    """Append the pairs of ``keys`` that are not ``known``, one file a bucket."""
    buckets, loads = _facts(spark, index)
    names = _key_names(keys)
    other = known.select(*[F.col(c).alias(f"_{c}") for c in [*names, "MONTH"]])
    same = [F.col(c) == F.col(f"_{c}") for c in names] + [F.col("MONTH").eqNullSafe(F.col("_MONTH"))]
    new = keys.join(other, same, "left_anti").withColumn(BUCKET.name, _bucket(names, buckets))
    columns = [f.name for f in versions.read(spark, index).schema.fields]
    new.repartition(BUCKET.name).select(*columns).write.mode("append").insertInto(index.name)
    versions.set_properties(spark, index, {_LOADS: str(loads + 1)})
