"""Scans of materialized layers: catalog tables or plain Parquet folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.sources import versions
from ledgerlens.sources.schemas import FACT_PARTITION
from ledgerlens.sources.versions import Table


def read_table(spark: SparkSession, table: Table | str, schema: T.StructType | None = None) -> DataFrame:
    """Scan a table of the warehouse, or (a path) a plain Parquet folder. A
    declared schema selects the columns, and may name the partition column
    too; without one the partition column is left out."""
    if isinstance(table, Table):
        df = versions.read(spark, table)
        if schema is None:
            return df.drop(table.partition.name) if table.partition else df
    else:
        df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(table)
    return df if schema is None else df.select(*[F.col(f.name) for f in schema.fields])


def read_partitioned(spark: SparkSession, table: Table, schema: T.StructType) -> DataFrame:
    """Scan keeping the partition column, so filters on it prune partitions."""
    return read_table(spark, table, T.StructType(schema.fields + [table.partition]))


def table_exists(spark: SparkSession, table: Table) -> bool:
    return versions.exists(spark, table)


def footer_max(spark: SparkSession, folder: str, column: str) -> DataFrame:
    """One row, ``max(column)`` of the Parquet files of ``folder``, answered from
    their footers: the aggregate is pushed into the scan, no page is read.

    Only Spark's newer file readers can do that, so the scan runs in a session
    of its own that uses them for Parquet; nothing else of the caller's
    changes. Those readers find a column's statistics by its place in the
    schema of the read, so that is the files' own (which one write made).
    """
    footers = spark.newSession()
    footers.conf.set("spark.sql.sources.useV1SourceList", "")
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return footers.read.parquet(folder).agg(F.max(column).alias(column))


def stored_max(spark: SparkSession, table: Table, column: str = "DATE"):
    """The greatest ``column`` of a table partitioned by its month, or None:
    the catalog names the newest month, that month's footers the value."""
    dated = [k for k in versions.keys(spark, table) if k != versions.NULL]
    if not dated:
        return None
    return footer_max(spark, versions.folder_of(spark, table, max(dated)), column).first()[0]


def high_water_mark(df: DataFrame, column: str = "DATE", wrap=None,
                    partition_col: str = FACT_PARTITION) -> Column:
    """Scalar ``max(column)`` of a relation, as a ``Column`` (scalar subquery).

    ``wrap`` is applied to the maximum inside the subquery (so a derived
    bound is still one scalar). When ``df`` carries the month partition
    column (``trunc(column, 'month')``), the newest month is found first from
    the partition column alone (a scan that reads no data columns, only file
    footers), and ``max(column)`` then reads that one month: the cost does
    not grow with the table's history. Evaluated once; nothing reaches the
    driver.
    """
    src = df
    if partition_col in df.columns:
        newest = df.agg(F.max(partition_col)).scalar()
        src = df.where(F.col(partition_col) == newest)
    mx = F.max(column)
    return src.agg(wrap(mx) if wrap is not None else mx).scalar()
