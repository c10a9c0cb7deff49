"""Catalog tables over Parquet: write complete files, then switch the catalog.

A :class:`Table` is an external table of Spark's catalog. Rows are always
written to a new folder ``<location>/version-<id>``, which no reader sees;
then the catalog is pointed at them:

* one changed partition: ``ALTER TABLE … PARTITION … SET LOCATION`` (or
  ``ADD`` / ``DROP PARTITION``), one statement;
* several, or the whole table: a second table ``<name>__next`` is created with
  the new and the kept partitions and takes the place by two renames. Between
  them the name is not there, so a reader gets an error, never a mixture;
  :func:`settle`, the first step of every writer, finishes a swap cut short.

The catalog alone says what a table consists of: a run that is lost leaves the old
rows, and its folders are read by nobody. :func:`remove_superseded` deletes folders
that no partition lies in. A table has one writer at a time; across sessions the
tables last as long as the session's catalog does (a metastore, on a cluster).
"""

from __future__ import annotations

import datetime as _dt
import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Key of an unpartitioned table's files, and of the null partition.
WHOLE, NULL = "", "null"
FOLDER = "version-"
#: Table property: rows that break a rule, as JSON {rule: {partition: rows}}; none is left out.
COUNTS = "ledgerlens.counts"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Table:
    """A table of the warehouse: its place in the catalog and in storage, its
    partition column, its descriptions, and the rules whose breaches are
    counted as rows are written."""
    database: str
    model: str
    location: str
    partition: T.StructField | None = None
    comment: str = ""
    comments: Mapping[str, str] = field(default_factory=dict, hash=False)
    rules: Mapping[str, str] = field(default_factory=dict, hash=False)  # name -> SQL test of a row that breaks it
    home: str = ""  # where the database is made, if it is not there

    @property
    def name(self) -> str:
        return self.beside("")

    def beside(self, suffix: str) -> str:
        return f"{quoted(self.database)}.{quoted(self.model + suffix)}"


@dataclass(frozen=True)
class Written:
    """Files that no reader sees yet."""
    folder: str
    keys: list[str]                       # partition values; [WHOLE] without a partition column
    counts: dict[str, dict[str, int]]     # rule -> partition value -> rows that break it
    schema: T.StructType


# --- what the catalog says ---------------------------------------------------------
def exists(spark: SparkSession, t: Table) -> bool:
    return spark.catalog.tableExists(t.name)


def properties(spark: SparkSession, t: Table) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {t.name}").collect()}


def counts(spark: SparkSession, t: Table) -> dict[str, dict[str, int]] | None:
    """Breaches of the table's rules as counted when its rows were written, or
    None for a table that was made without counting."""
    said = properties(spark, t).get(COUNTS)
    return None if said is None else json.loads(said)


def keys(spark: SparkSession, t: Table) -> list[str]:
    """The partition values of a table (months or buckets: bounded)."""
    if t.partition is None:
        return [WHOLE]
    specs = [r.partition.split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {t.name}").collect()]
    return [NULL if s in (NULL, "__HIVE_DEFAULT_PARTITION__") else s for s in specs]


def folder_of(spark: SparkSession, t: Table, key: str = WHOLE) -> str:
    """Where the catalog has the files of one partition (or of the table)."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {t.name} {_spec(t, key)}").collect()
    return [r.data_type for r in rows if r.col_name == "Location"][0]


def key_of(value) -> str:
    return NULL if value is None else str(value)


def _spec(t: Table, key: str) -> str:
    if t.partition is None:
        return ""
    return f"PARTITION ({quoted(t.partition.name)} = {'null' if key == NULL else text(key)})"


def partition_filter(column: Column, keys: Sequence[str], kind: T.DataType | None = None) -> Column:
    """Literal predicate on the partition column for the values ``keys``."""
    as_value = int if isinstance(kind, T.IntegerType) else _dt.date.fromisoformat
    values = sorted(as_value(k) for k in keys if k != NULL)
    out = column.isin(values) if values else F.lit(False)
    return out | column.isNull() if NULL in keys else out


def read(spark: SparkSession, t: Table) -> DataFrame:
    """Scan of a table, partition column last."""
    return spark.table(t.name)


# --- writing -------------------------------------------------------------------------
def write(df: DataFrame, t: Table) -> Written:
    """Write ``df`` to a new folder. Its partition values and the breaches of
    the table's rules are observed while the rows pass; only if a rule of a partitioned
    table is broken, the new files are read again to tell the partitions apart."""
    spark = df.sparkSession
    folder = f"{t.location.rstrip('/')}/{FOLDER}{_dt.datetime.now(_dt.UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    rules = {n: F.expr(test) for n, test in t.rules.items()}
    seen = Observation()
    wanted = [F.count_if(c).alias(n) for n, c in rules.items()] or [F.count(F.lit(1)).alias("rows")]
    if t.partition is not None:
        wanted.append(F.collect_set(F.coalesce(F.col(t.partition.name).cast("string"), F.lit(NULL))).alias("_keys"))
    w = df.observe(seen, *wanted).write.mode("errorifexists")
    (w if t.partition is None else w.partitionBy(t.partition.name)).parquet(folder)
    got = seen.get  # empty if the optimizer knew that there is no row
    found = sorted(got.get("_keys") or []) if t.partition is not None else [WHOLE]
    broken = [n for n in rules if got.get(n)]
    if t.partition is None or len(found) == 1:
        per_key = {n: {found[0]: got[n]} for n in broken}
    else:
        per_key = _per_partition(spark, folder, df.schema, t, {n: rules[n] for n in broken})
    return Written(folder, found, per_key, df.schema)


def _per_partition(spark: SparkSession, folder: str, schema: T.StructType, t: Table, broken: dict[str, Column]) -> dict:
    if not broken:
        return {}
    key = F.coalesce(F.col(t.partition.name).cast("string"), F.lit(NULL)).alias("k")
    rows = spark.read.schema(schema).parquet(folder).groupBy(key).agg(*[F.count_if(c).alias(n) for n, c in broken.items()])
    per_key: dict[str, dict[str, int]] = {n: {} for n in broken}
    for r in rows.collect():  # a row for each partition written
        for n in broken:
            if r[n]:
                per_key[n][r.k] = r[n]
    return per_key


# --- switching -------------------------------------------------------------------------
def _run(spark: SparkSession, statement: str) -> None:
    spark.sql(statement)


def settle(spark: SparkSession, t: Table) -> None:
    """Finish a swap that was cut short between its two renames."""
    if not exists(spark, t) and spark.catalog.tableExists(t.beside("__old")) and spark.catalog.tableExists(t.beside("__next")):
        _run(spark, f"ALTER TABLE {t.beside('__next')} RENAME TO {t.name}")
        _run(spark, f"DROP TABLE {t.beside('__old')}")


def drop(spark: SparkSession, t: Table) -> None:
    """Take a table out of the catalog; its files stay until they are removed."""
    _run(spark, f"DROP TABLE IF EXISTS {t.name}")


def set_properties(spark: SparkSession, t: Table, values: Mapping[str, str]) -> None:
    _run(spark, f"ALTER TABLE {t.name} SET TBLPROPERTIES ({_properties(values)})")


def _properties(values: Mapping[str, str]) -> str:
    return ", ".join(f"{text(k)} = {text(v)}" for k, v in values.items())


def _partition_folder(t: Table, folder: str, key: str) -> str:
    return f"{folder}/{t.partition.name}={'__HIVE_DEFAULT_PARTITION__' if key == NULL else key}"


def _swap(spark: SparkSession, t: Table, schema: T.StructType, parts: Mapping[str, str], values: Mapping[str, str]) -> None:
    """Make ``parts`` (partition value -> folder) the table's content."""
    _run(spark, f"CREATE DATABASE IF NOT EXISTS {quoted(t.database)}" + (f" LOCATION {text(t.home)}" if t.home else ""))
    settle(spark, t)
    for suffix in ("__next", "__old"):
        _run(spark, f"DROP TABLE IF EXISTS {t.beside(suffix)}")
    pname = t.partition.name if t.partition else None
    fields = [f for f in schema.fields if f.name != pname] + ([t.partition] if t.partition else [])
    cols = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}"
                     + (f" COMMENT {text(t.comments[f.name])}" if f.name in t.comments else "") for f in fields)
    place = parts[WHOLE] if t.partition is None else t.location
    _run(spark, f"CREATE TABLE {t.beside('__next')} ({cols}) USING parquet"
                + (f" PARTITIONED BY ({quoted(pname)})" if pname else "") + f" COMMENT {text(t.comment)}"
                + (f" TBLPROPERTIES ({_properties(values)})" if values else "") + f" LOCATION {text(place)}")
    if t.partition is not None and parts:
        specs = " ".join(f"{_spec(t, k)} LOCATION {text(folder)}" for k, folder in sorted(parts.items()))
        _run(spark, f"ALTER TABLE {t.beside('__next')} ADD {specs}")
    if exists(spark, t):
        _run(spark, f"ALTER TABLE {t.name} RENAME TO {t.beside('__old')}")
    _run(spark, f"ALTER TABLE {t.beside('__next')} RENAME TO {t.name}")
    _run(spark, f"DROP TABLE IF EXISTS {t.beside('__old')}")


def replace(spark: SparkSession, df: DataFrame, t: Table, values: Mapping[str, str] | None = None) -> None:
    """Write ``df`` and make it the whole table; ``df`` may read the table.
    ``values`` are further table properties."""
    w = write(df, t)
    parts = {k: w.folder if t.partition is None else _partition_folder(t, w.folder, k) for k in w.keys}
    _swap(spark, t, w.schema, parts, {COUNTS: json.dumps(w.counts), **(values or {})})


def replace_partitions(spark: SparkSession, df: DataFrame, t: Table, involved: Sequence[str]) -> None:
    """Write ``df``, the new rows of the partitions ``involved``, and switch
    these. An involved partition without rows is dropped, all others keep
    their files. A column that ``df`` adds or lacks is added or dropped for
    the whole table (old rows read null)."""
    w = write(df, t)
    new = {k: _partition_folder(t, w.folder, k) for k in w.keys}
    present, known = keys(spark, t), properties(spark, t)
    gone = (set(involved) & set(present)) - new.keys()
    before = json.loads(known.get(COUNTS, "{}"))
    after = {n: kept | w.counts.get(n, {}) for n in before.keys() | w.counts.keys()
             if (kept := {k: c for k, c in before.get(n, {}).items() if k not in set(involved) | new.keys()}) or n in w.counts}
    same_columns = {f.name: f.dataType for f in w.schema.fields} == {f.name: f.dataType for f in read(spark, t).schema.fields}
    if len(new) + len(gone) <= 1 and same_columns and after == before:
        for k in gone:
            _run(spark, f"ALTER TABLE {t.name} DROP IF EXISTS {_spec(t, k)}")
        for k, folder in new.items():
            if k in present:
                _run(spark, f"ALTER TABLE {t.name} {_spec(t, k)} SET LOCATION {text(folder)}")
            else:
                _run(spark, f"ALTER TABLE {t.name} ADD {_spec(t, k)} LOCATION {text(folder)}")
        return
    kept = {k: folder_of(spark, t, k) for k in present if k not in gone and k not in new}
    own = {k: v for k, v in known.items() if k.startswith("ledgerlens.")}
    _swap(spark, t, w.schema, kept | new, own | {COUNTS: json.dumps(after)})


# --- clearing up -------------------------------------------------------------------------
def superseded(spark: SparkSession, t: Table, keep_hours: float = 48) -> list[str]:
    """Version folders below the table's location that hold no partition of it
    and were begun more than ``keep_hours`` ago (a reader may still be at a
    younger one, or a writer)."""
    used = {m.group(1) for k in keys(spark, t) if (m := re.search(rf"/({FOLDER}[^/]+)", folder_of(spark, t, k)))}
    before = f"{FOLDER}{_dt.datetime.now(_dt.UTC) - _dt.timedelta(hours=keep_hours):%Y%m%dT%H%M%S%f}"
    root = spark._jvm.org.apache.hadoop.fs.Path(t.location)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(root)] if files.exists(root) else []
    return sorted(f"{t.location.rstrip('/')}/{n}" for n in names if n.startswith(FOLDER) and n not in used and n < before)


def remove_superseded(spark: SparkSession, t: Table, keep_hours: float = 48) -> list[str]:
    """Delete the folders of :func:`superseded`; returns them."""
    out = superseded(spark, t, keep_hours)
    for folder in out:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return out
