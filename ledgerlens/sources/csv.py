"""CSV landing files -> RAW DataFrames.

The landing format: header line skipped, fields optionally enclosed in
double quotes (a doubled quote escapes one), ``NULL`` or an empty field is
null, columns in DDL order. Bad numbers fail the read (FAILFAST) instead of
silently becoming null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions import blank_to_null

# Name patterns of the landing files (files or Spark output directories).
ORGANIZATIONS_GLOB = "*organizations*.{csv,csv.gz}"
INVOICES_GLOB = "*invoices*.{csv,csv.gz}"

CSV_READ_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "NULL",
    "mode": "FAILFAST",
}


def csv_reader(spark: SparkSession, schema: T.StructType, multi_line: bool = True):
    """A ``DataFrameReader`` configured for the landing format.

    ``multi_line=True`` admits newlines inside quoted fields but makes each
    file one task; pass ``False`` for large single files without embedded
    newlines so Spark can split them.
    """
    return (spark.read.schema(schema).options(**CSV_READ_OPTIONS)
            .option("multiLine", str(multi_line).lower()))


def blanks_to_null(df: DataFrame) -> DataFrame:
    """``''`` -> null on every string column (a quoted ``""`` reads as ``''``)."""
    return df.select(*[
        blank_to_null(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def read_raw_csv(spark: SparkSession, location: str, schema: T.StructType,
                 name_glob: str | None = None, multi_line: bool = True) -> DataFrame:
    """Read landing CSV into a RAW DataFrame with the declared ``schema``.

    ``location`` is a file or a directory; with ``name_glob`` only entries of
    that directory whose name matches are read (``*invoices*.{csv,csv.gz}``),
    every other file is ignored. Gzip is detected by the ``.gz`` extension.
    """
    path = location if name_glob is None else f"{location.rstrip('/')}/{name_glob}"
    return blanks_to_null(csv_reader(spark, schema, multi_line).csv(path))


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Write ``df`` in the landing format (nulls as ``NULL``, header line)."""
    w = (df.write.mode("overwrite").option("header", "true").option("quote", '"')
         .option("escape", '"').option("nullValue", "NULL"))
    if compression:
        w = w.option("compression", compression)
    w.csv(path)
