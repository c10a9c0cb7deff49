"""Table sinks over catalog tables (:mod:`ledgerlens.sources.versions`).

Every rewrite writes its rows once, clustered, into new files and then
switches the catalog to them. Nothing is overwritten in place: a run that is
lost at any point leaves the last rows as they were, and a rebuild
that stopped half way is never read.

* :func:`replace_table` — whole-table rebuild, from a plan that may read it;
* :func:`write_fact` — month-partitioned, (DATE, ORGANIZATION_ID)-clustered;
* :func:`merge_partitions` — merge of a delta into its months;
* :func:`upsert_months` — keyed upsert into a table stored by month.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.merge import assert_unique_keys, key_columns, merge_incremental, upsert
from ledgerlens.plans import key_index
from ledgerlens.session import new_scratch
from ledgerlens.sources import versions
from ledgerlens.sources.tables import read_table
from ledgerlens.sources.versions import Table

#: Table property of a RAW table: months written since it was last staged.
UNSTAGED, ALL = "ledgerlens.unstaged", "all"
#: Table property: all its rows came through loads that kept the key index. A rebuild by other means loses it.
INDEXED = {"ledgerlens.indexed": "true"}


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                mode: str = "overwrite") -> None:
    """Plain Parquet folder (exports, staged copies), outside the catalog."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def stage(spark: SparkSession, df: DataFrame, label: str, schema: T.StructType | None = None) -> DataFrame:
    """Materialize ``df`` under the shared scratch folder and scan it back.

    The returned plan starts at those files: lineage is cut, and a lost
    executor re-reads files instead of recomputing.
    """
    path = new_scratch(spark, label)
    write_table(df, path)
    return read_table(spark, path, schema or df.schema)


def stage_counted(spark: SparkSession, df: DataFrame, label: str, rules: Mapping[str, str]) -> tuple[DataFrame, dict[str, int]]:
    """:func:`stage`, and how many rows broke each rule, counted on the way."""
    seen = Observation()
    staged = stage(spark, df.observe(seen, *[F.count_if(F.expr(test)).alias(n) for n, test in rules.items()]), label) if rules \
        else stage(spark, df, label)
    got = seen.get if rules else {}
    return staged, {n: got.get(n) or 0 for n in rules}


def cluster(df: DataFrame, by: Sequence[str], partition: str | None = None) -> DataFrame:
    """Rows of a partition value together, sorted by ``by`` in each task.

    The ``rebalance`` hint lets Adaptive Query Execution cut a hot month into
    several tasks of the advisory size and join small ones, from the sizes it
    has measured: the plan runs once (range partitioning runs it a second
    time to sample it), and a month has as many files as its size asks for.
    """
    r = df.hint("rebalance", F.col(partition)) if partition else df.hint("rebalance")
    return r.sortWithinPartitions(*([partition] if partition else []), *[c for c in by if c != partition])


def replace_table(spark: SparkSession, df: DataFrame, table: Table, cluster_by: Sequence[str] = (),
                  values: Mapping[str, str] | None = None) -> None:
    """Rebuild ``table`` as ``df``, which may read the same table and holds
    its partition column; ``cluster_by`` is the order inside, ``values`` are table
    properties."""
    by = table.partition.name if table.partition else None
    versions.replace(spark, cluster(df, cluster_by, by) if by or cluster_by else df, table, values)


def with_month(df: DataFrame, date_col: str, month_col: str) -> DataFrame:
    """Add the partition column: first day of the month of ``date_col``."""
    return df.withColumn(month_col, F.trunc(F.col(date_col), "month"))


CLUSTER_BY = ("DATE", "ORGANIZATION_ID")


def write_fact(df: DataFrame, table: Table, cluster_by: Sequence[str] = CLUSTER_BY) -> None:
    """Rebuild a (ORGANIZATION_ID, DATE)-grain table (fact or mart), partitioned
    by month and clustered by ``cluster_by``."""
    replace_table(df.sparkSession, with_month(df, "DATE", table.partition.name), table, cluster_by)


def _months(df: DataFrame, month: str) -> list[str]:
    """Distinct months of ``df`` as keys: at most one per calendar month."""
    return [versions.key_of(r[0]) for r in df.select(month).distinct().collect()]


def stage_delta(spark: SparkSession, delta: DataFrame, table: Table) -> DataFrame:
    """A stored delta for :func:`merge_partitions`: shared columns in the
    types of the table, and the month."""
    types = {f.name: f.dataType for f in versions.read(spark, table).schema.fields}
    delta = delta.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in delta.columns])
    return stage(spark, with_month(delta, "DATE", table.partition.name), "delta")


def merge_partitions(spark: SparkSession, delta: DataFrame, table: Table, keys: Sequence[str],
                     cluster_by: Sequence[str] = CLUSTER_BY) -> None:
    """Merge ``delta`` into the month-partitioned ``table`` by ``keys``.

    Only the months holding a delta row are read (a literal predicate on the
    partition column) and written, once, clustered; the others keep their
    files, so the cost follows the delta, not the table. A merge never
    deletes: a target row whose key is absent from the delta survives. Keys
    match null-safely, and a delta row with a null DATE involves the null month.

    The table takes the delta's columns (schema sync): old rows get nulls for
    a new column and lose one that the delta no longer has.
    """
    m = table.partition.name
    if m not in delta.columns:
        delta = stage_delta(spark, delta, table)
    schema = T.StructType([f for f in delta.schema.fields if f.name != m])
    involved = _months(delta, m)
    if not involved:
        return
    old = versions.read(spark, table).where(versions.partition_filter(F.col(m), involved))
    merged = merge_incremental(old, delta.select(*schema.fieldNames()), keys, schema, null_safe=True)
    versions.replace_partitions(spark, cluster(with_month(merged, "DATE", m), cluster_by, m), table, involved)


def upsert_months(spark: SparkSession, updates: DataFrame, table: Table, index: Table, schema: T.StructType,
                  keys: Sequence[str], month: Column, null_as: str = "",
                  order_by: Sequence[str] | None = None) -> list[str]:
    """Upsert ``updates`` into a table partitioned by month (computed by
    ``month`` from each row), reading and writing only the months involved.

    A month is involved when it receives an update row or holds a row whose
    key is updated. Which months may hold an updated key is read from
    ``index`` (:mod:`ledgerlens.plans.key_index`), of which only the buckets
    of the updated keys are scanned; months that it names beside those that receive rows are verified by
    their key columns. So no file of another month is opened, and the cost of
    a load follows the load. The involved months, at most one value per
    calendar month, become a literal partition filter. They are merged and
    written once, clustered by the first key; a month left empty drops out.
    New keys enter the index before the table is switched, so the index never
    lacks one.

    Duplicate update keys raise, unless ``order_by`` picks the newest.
    Returns the months written.
    """
    versions.settle(spark, table)
    m = table.partition.name
    names = schema.fieldNames()
    upd = upsert(updates.select(*names).limit(0), updates.select(*names), keys, null_as=null_as, order_by=order_by,
                 check_duplicates=False) if order_by else updates.select(*names)
    upd = stage(spark, upd.withColumn(m, month), "upsert")
    assert_unique_keys(upd, keys, null_as)
    upd_keys = upd.select(*key_columns(upd, keys, null_as, "K"), F.col(m).alias("MONTH"))
    if not versions.exists(spark, table):
        versions.drop(spark, index)
        key_index.build(spark, upd_keys, index)
        replace_table(spark, upd, table, [keys[0]], {UNSTAGED: ALL, **INDEXED})
        return versions.keys(spark, table)
    base = versions.read(spark, table)
    covered = INDEXED.items() <= versions.properties(spark, table).items()
    if not covered or not versions.exists(spark, index) or key_index.is_scattered(spark, index):
        key_index.build(spark, base.select(*key_columns(base, keys, null_as, "K"), F.col(m).alias("MONTH")), index)
        versions.set_properties(spark, table, INDEXED)
    receiving = _months(upd, m)
    known = key_index.lookup(spark, index, upd_keys)
    named = sorted(set(_months(known, "MONTH")) - set(receiving))
    if named:
        named = _months(holders(base, m, named, keys, null_as, upd_keys), m)
    key_index.add(spark, index, upd_keys, known)
    involved = sorted({*receiving, *named})
    if not involved:
        return []
    versions.set_properties(spark, table, {UNSTAGED: _joined(versions.properties(spark, table).get(UNSTAGED, ""), involved)})
    old = base.where(versions.partition_filter(F.col(m), involved)).select(*names)
    merged = upsert(old, upd.select(*names), keys, null_as=null_as, check_duplicates=False).withColumn(m, month)
    versions.replace_partitions(spark, cluster(merged, [keys[0]], m), table, involved)
    return involved


def holders(base: DataFrame, m: str, named: Sequence[str], keys: Sequence[str], null_as: str, upd_keys: DataFrame) -> DataFrame:
    """The key columns' rows, of the months ``named`` alone, whose key is updated."""
    some = base.where(versions.partition_filter(F.col(m), named)).select(m, *key_columns(base, keys, null_as, "_bk"))
    return some.join(upd_keys, [F.col(f"_bk{i}") == F.col(f"K{i}") for i in range(len(keys))], "left_semi")


def _joined(said: str, months: Sequence[str]) -> str:
    """The months noted so far and ``months``; ALL beyond a property's length."""
    if said == ALL:
        return ALL
    out = ",".join(sorted({*filter(None, said.split(",")), *months}))
    return out if len(out) < 3000 else ALL
