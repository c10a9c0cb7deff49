"""Keyed upserts and the incremental merge, as DataFrame -> DataFrame.

Spark's built-in Parquet catalog has no ``MERGE``; an upsert is the base
rows whose key is not updated (left anti join) plus every update row.
Only keys travel in the anti join, so the shuffle (or, when Adaptive Query
Execution measures the update side below the broadcast limit at run time,
the broadcast) carries the narrow key columns, not whole rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.dims import latest_per_key
from ledgerlens.operators.quality import align_to, check_unique


class DuplicateKeyError(ValueError):
    """The update side holds a key more than once and no ordering was given."""


def key_columns(df: DataFrame, keys: Sequence[str], null_as: str | None, prefix: str) -> list[Column]:
    if null_as is None:
        return [F.col(k).alias(f"{prefix}{i}") for i, k in enumerate(keys)]
    return [F.coalesce(F.col(k), F.lit(null_as)).alias(f"{prefix}{i}") for i, k in enumerate(keys)]


def assert_unique_keys(updates: DataFrame, keys: Sequence[str], null_as: str | None = None,
                       sample: int = 10) -> None:
    """Raise :class:`DuplicateKeyError` naming a few duplicated keys.

    One aggregate over the update side; only up to ``sample`` keys return.
    """
    k = updates.select(*key_columns(updates, keys, null_as, "_k"))
    dups = check_unique(k, k.columns, ignore_nulls=False).limit(sample).collect()
    if dups:
        raise DuplicateKeyError(f"update keys {list(keys)} not unique, e.g. {[tuple(r)[:-1] for r in dups]}")


def upsert(base: DataFrame, updates: DataFrame, keys: Sequence[str], null_as: str | None = None,
           order_by: Sequence[str] | None = None, check_duplicates: bool = True,
           null_safe: bool = False) -> DataFrame:
    """Rows of ``base`` updated or inserted from ``updates`` by ``keys``.

    ``null_as=''`` makes a null key equal to ``''`` (and to another null);
    ``null_safe=True`` makes a null key equal to another null only (``<=>``,
    still an equi-join).
    Matched base rows are replaced wholesale; unmatched update rows are
    inserted. Duplicate update keys raise, unless ``order_by`` names columns
    whose greatest value (descending, nulls last) picks the surviving row.
    """
    keys = list(keys)
    if order_by:
        if null_as is None:
            updates = latest_per_key(updates, keys, order_by)
        else:
            norm = updates.select("*", *key_columns(updates, keys, null_as, "_uk"))
            uk = [f"_uk{i}" for i in range(len(keys))]
            updates = latest_per_key(norm, uk, order_by).drop(*uk)
    elif check_duplicates:
        assert_unique_keys(updates, keys, null_as)
    upd_keys = updates.select(*key_columns(updates, keys, null_as, "_uk"))
    b = base.select("*", *key_columns(base, keys, null_as, "_bk"))
    cond = [F.col(f"_bk{i}").eqNullSafe(F.col(f"_uk{i}")) if null_safe else F.col(f"_bk{i}") == F.col(f"_uk{i}")
            for i in range(len(keys))]
    kept = b.join(upd_keys, cond, "left_anti").select(*base.columns)
    return kept.unionByName(updates.select(*base.columns))


def merge_incremental(target: DataFrame, delta: DataFrame, keys: Sequence[str],
                      schema: T.StructType | None = None, null_safe: bool = False) -> DataFrame:
    """Merge semantics of an incremental model: delta rows replace target rows
    with the same key, other target rows stay (a merge never deletes).

    ``schema`` (default: the delta's) applies the 'sync' schema policy: old
    rows lose columns the delta no longer has and get nulls for new ones.
    """
    schema = schema or delta.schema
    old = align_to(target, schema)
    new = delta.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return upsert(old, new, keys, check_duplicates=False, null_safe=null_safe)

