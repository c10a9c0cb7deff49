"""Data-quality operators.

Each ``check_*`` returns the *violating rows* as a DataFrame (empty = pass),
the way a SQL data test does; :func:`run_checks` turns a set of checks into
one summary row each. Nothing is collected except the final counts.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions import lenient_timestamp

# --- fixed values that must match the reference -------------------------------
FRESHNESS_WARN_HOURS = 48
FRESHNESS_ERROR_HOURS = 168
# Column checks of the models: model, kind, columns.
COLUMN_CHECKS = (
    ("raw_organizations", "not_null", ("ORGANIZATION_ID",)),
    ("raw_invoices", "not_null", ("ORGANIZATION_ID",)),
    ("stg_organizations", "not_null", ("ORGANIZATION_ID",)),
    ("stg_organizations", "unique", ("ORGANIZATION_ID",)),
    ("dim_organizations", "not_null", ("ORGANIZATION_ID",)),
    ("dim_organizations", "unique", ("ORGANIZATION_ID",)),
    ("dim_organizations", "not_null", ("LEGAL_ENTITY_COUNTRY_CODE",)),
    ("fact_organizations_payment", "not_null", ("ORGANIZATION_ID",)),
    ("fact_organizations_payment", "not_null", ("DATE",)),
    ("fact_organizations_payment", "not_null", ("PAYMENT_AMOUNT_USD",)),
    ("fact_organizations_payment", "unique", ("ORGANIZATION_ID", "DATE")),
    ("mart_daily_org_balance", "not_null", ("ORGANIZATION_ID",)),
    ("mart_daily_org_balance", "not_null", ("DATE",)),
    ("mart_daily_org_balance", "not_null", ("DAILY_PAYMENT_AMOUNT",)),
)
# ------------------------------------------------------------------------------


class ContractError(ValueError):
    """Raised when a relation does not carry the declared columns and types."""


def contract_problems(df: DataFrame, contract: T.StructType) -> list[tuple[str, str, str]]:
    """(column, expected type, actual type) for every mismatch; '' = missing."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    expected = {f.name: f.dataType for f in contract.fields}
    out = []
    for name, dt in expected.items():
        got = actual.get(name)
        if got is None:
            out.append((name, dt.simpleString(), ""))
        elif got != dt:
            out.append((name, dt.simpleString(), got.simpleString()))
    for name, got in actual.items():
        if name not in expected:
            out.append((name, "", got.simpleString()))
    return out


def enforce_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Return ``df`` in contract column order, or raise :class:`ContractError`.

    Names and types are compared on the analyzed schema before anything is
    written; no data is read.
    """
    problems = contract_problems(df, contract)
    if problems:
        raise ContractError("contract violated: " + "; ".join(
            f"{n}: expected {e or '<absent>'}, got {a or '<absent>'}" for n, e, a in problems))
    return df.select(*[f.name for f in contract.fields])


def align_to(old: DataFrame, new_schema: T.StructType) -> DataFrame:
    """Old rows in the shape of ``new_schema``: missing columns become null,
    columns the new schema dropped are removed, shared ones are cast."""
    have = set(old.columns)
    return old.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in new_schema.fields
    ])


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def check_unique(df: DataFrame, columns: Sequence[str], ignore_nulls: bool | None = None) -> DataFrame:
    """Values (or combinations) occurring more than once, with ``N_RECORDS``.

    A single column ignores nulls (like a ``unique`` test); a combination
    keeps null groups (like ``unique_combination_of_columns``). A partial
    count per task precedes the shuffle, so a hot value costs one row per task.
    """
    columns = list(columns)
    if ignore_nulls is None:
        ignore_nulls = len(columns) == 1
    src = df
    if ignore_nulls:
        for c in columns:
            src = src.where(F.col(c).isNotNull())
    return (src.groupBy(*columns).agg(F.count(F.lit(1)).alias("N_RECORDS"))
               .where(F.col("N_RECORDS") > 1))


def check_pct_guard(mart: DataFrame) -> DataFrame:
    """Rows whose DOD_CHANGE_PCT is set although the previous amount is null or 0."""
    return mart.where(F.expr(PCT_GUARD_TEST))


def check_prev(mart: DataFrame, strict: bool = False) -> DataFrame:
    """Rows whose stored previous amount differs from a fresh ``lag``.

    Default compares ``coalesce(x, 0)`` on both sides (null equals 0); with
    ``strict=True`` null and 0 are different values.
    """
    w = Window.partitionBy("ORGANIZATION_ID").orderBy(F.col("DATE").asc_nulls_last())
    m = mart.select("ORGANIZATION_ID", "DATE", "DAILY_PAYMENT_AMOUNT", "PREV_DAILY_PAYMENT_AMOUNT",
                    F.lag("DAILY_PAYMENT_AMOUNT").over(w).alias("PREV_CALC"))
    stored, calc = F.col("PREV_DAILY_PAYMENT_AMOUNT"), F.col("PREV_CALC")
    if strict:
        return m.where(~stored.eqNullSafe(calc))
    return m.where(F.coalesce(stored, F.lit(0)) != F.coalesce(calc, F.lit(0)))


def freshness(df: DataFrame, ts_col: str, now: Sequence[_dt.datetime] | _dt.datetime,
              warn_hours: int = FRESHNESS_WARN_HOURS, error_hours: int = FRESHNESS_ERROR_HOURS) -> DataFrame:
    """Source freshness of ``max(ts_col)`` seen from each ``now``.

    One row per ``now``: MAX_LOADED_AT, SNAPSHOTTED_AT, AGE_HOURS (whole hours,
    truncated) and STATUS ``pass`` / ``warn`` / ``error``. An age exactly at a
    limit passes it. ``now`` is a parameter so the check is repeatable; the
    source is scanned once (one partial max per task). A text column is parsed
    leniently: values that are no timestamps do not count.
    """
    nows = [now] if isinstance(now, _dt.datetime) else list(now)
    text = isinstance(df.schema[ts_col].dataType, T.StringType)
    loaded = lenient_timestamp(ts_col) if text else F.col(ts_col).cast("timestamp_ntz")
    mx = df.agg(F.max(loaded).alias("MAX_LOADED_AT"))
    at = mx.select("MAX_LOADED_AT", F.explode(F.array(*[
        F.lit(n.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz") for n in nows])).alias("SNAPSHOTTED_AT"))
    mx_c, now_c = F.col("MAX_LOADED_AT"), F.col("SNAPSHOTTED_AT")
    status = (F.when(mx_c.isNull(), F.lit("error"))
               .when(mx_c < now_c - F.make_dt_interval(hours=F.lit(error_hours)), F.lit("error"))
               .when(mx_c < now_c - F.make_dt_interval(hours=F.lit(warn_hours)), F.lit("warn"))
               .otherwise(F.lit("pass")))
    return at.select("MAX_LOADED_AT", "SNAPSHOTTED_AT",
                     F.timestamp_diff("HOUR", mx_c, now_c).alias("AGE_HOURS"),
                     status.alias("STATUS"))


@dataclass
class Check:
    """A named check over one model; ``kind`` is not_null, unique or rows."""
    name: str
    model: str
    kind: str
    columns: tuple[str, ...] = ()
    rows: DataFrame | None = field(default=None, repr=False)


def reference_checks(tables: dict[str, DataFrame]) -> list[Check]:
    """The sixteen column, combination and singular checks of the reference,
    restricted to the models present in ``tables``."""
    out = []
    for model, kind, cols in COLUMN_CHECKS:
        if model in tables:
            out.append(Check(_check_name(model, kind, cols), model, kind, cols))
    if "mart_daily_org_balance" in tables:
        mart = tables["mart_daily_org_balance"]
        out.append(Check(PCT_GUARD, "mart_daily_org_balance", "rows",
                         rows=check_pct_guard(mart)))
        out.append(Check("mart_prev_matches_window", "mart_daily_org_balance", "rows",
                         rows=check_prev(mart)))
    return out


#: The singular check that tests single rows: a percentage although there is no previous amount.
PCT_GUARD = "mart_dod_null_when_prev_zero_or_null"
PCT_GUARD_TEST = ("(PREV_DAILY_PAYMENT_AMOUNT IS NULL OR PREV_DAILY_PAYMENT_AMOUNT = 0) AND DOD_CHANGE_PCT IS NOT NULL")


def _check_name(model: str, kind: str, cols: Sequence[str]) -> str:
    label = "unique_combination" if kind == "unique" and len(cols) > 1 else kind
    return f"{label}_{model}_{'_'.join(cols)}".lower()


def row_rules(model: str) -> dict[str, str]:
    """The checks of a model that look at one row at a time: name -> SQL test
    of a row that breaks it. They can be counted while the rows are written."""
    out = {_check_name(m, kind, cols): f"{cols[0]} IS NULL" for m, kind, cols in COLUMN_CHECKS if m == model and kind == "not_null"}
    return out | ({PCT_GUARD: PCT_GUARD_TEST} if model == "mart_daily_org_balance" else {})


def failing_rows(tables: dict[str, DataFrame], check: Check) -> DataFrame:
    """The rows that make ``check`` fail (empty when it passes)."""
    if check.kind == "not_null":
        return check_not_null(tables[check.model], check.columns[0])
    if check.kind == "unique":
        return check_unique(tables[check.model], check.columns)
    return check.rows


def run_checks(tables: dict[str, DataFrame], checks: list[Check] | None = None,
               store_failures: str | None = None, counted: Mapping[str, int] | None = None) -> DataFrame:
    """Summary with one row per check: CHECK_NAME, MODEL, FAILURES, STATUS.

    ``counted`` holds the failures of checks that were counted as the rows
    were written (:func:`row_rules`); these read nothing. The other
    not-null checks of a model share a single aggregate pass over it;
    each uniqueness or singular check is one more aggregate. By default
    failing rows are not stored (call :func:`failing_rows` to see them);
    ``store_failures`` names a folder that receives, per check, a Parquet
    table ``<folder>/<check name>`` of its failing rows (empty when it
    passes), written by the executors.
    """
    checks = reference_checks(tables) if checks is None else checks
    if store_failures:
        for c in checks:
            failing_rows(tables, c).write.mode("overwrite").parquet(f"{store_failures.rstrip('/')}/{c.name}")
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    counted = counted or {}
    known = [c for c in checks if c.name in counted]
    if known:
        rows = ", ".join(f"('{c.name}', {int(counted[c.name])}L, '{c.model}')" for c in known)
        parts.append(next(iter(tables.values())).sparkSession.sql(f"SELECT * FROM VALUES {rows} AS t(CHECK_NAME, FAILURES, MODEL)"))
    checks = [c for c in checks if c.name not in counted]
    for c in checks:
        if c.kind == "not_null":
            by_model.setdefault(c.model, []).append(c)
    for model, cs in by_model.items():
        agg = tables[model].agg(*[
            F.count(F.when(F.col(c.columns[0]).isNull(), F.lit(1))).alias(f"c{i}") for i, c in enumerate(cs)])
        stack = ", ".join(f"'{c.name}', c{i}" for i, c in enumerate(cs))
        parts.append(agg.selectExpr(f"stack({len(cs)}, {stack}) as (CHECK_NAME, FAILURES)")
                        .withColumn("MODEL", F.lit(model)))
    for c in checks:
        if c.kind == "not_null":
            continue
        rows = check_unique(tables[c.model], c.columns) if c.kind == "unique" else c.rows
        parts.append(rows.agg(F.count(F.lit(1)).alias("FAILURES"))
                         .select(F.lit(c.name).alias("CHECK_NAME"), "FAILURES", F.lit(c.model).alias("MODEL")))
    if not parts:
        raise ValueError("no checks to run")
    summary = parts[0]
    for p in parts[1:]:
        summary = summary.unionByName(p)
    return summary.select(
        "CHECK_NAME", "MODEL", F.col("FAILURES").cast("bigint").alias("FAILURES"),
        F.when(F.col("FAILURES") == 0, F.lit("pass")).otherwise(F.lit("fail")).alias("STATUS"))
