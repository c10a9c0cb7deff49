"""Dimension: newest organization snapshot per id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep one row per ``keys``: the greatest by ``order``, each descending, nulls last.

    Columns not named in ``keys``/``order`` are appended to the ordering as
    tie-breakers, so the result is deterministic. Expressed as ``max`` of a
    struct, it is a partial + final aggregate (sort-based, as the struct
    buffer is not fixed-width): a key holding a
    third of all rows is reduced to one row per task before the shuffle, and
    no task ever sorts a whole group. (Struct ``max`` ranks null fields
    lowest, i.e. descending with nulls last.)
    """
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = F.struct(*[F.col(c) for c in order + rest])
    best = df.groupBy(*keys).agg(F.max(ranked).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in order + rest]).select(*df.columns)


def dim_organizations(stg_orgs: DataFrame) -> DataFrame:
    """One row per ORGANIZATION_ID: newest CREATED_DATE, nulls last."""
    return latest_per_key(stg_orgs, ["ORGANIZATION_ID"], [
        "CREATED_DATE", "COUNT_TOTAL_CONTRACTS_ACTIVE", "LAST_PAYMENT_DATE",
        "FIRST_PAYMENT_DATE", "LEGAL_ENTITY_COUNTRY_CODE"])
