"""End-to-end runs: ingest landing files into RAW, build every layer, check, alert.

A warehouse is a database of the catalog; its external tables lie below one
root folder (see :mod:`ledgerlens.sources.versions`):

    raw_organizations  raw_invoices (by month of CREATED_AT)
    raw_invoices_keys (which months may hold an invoice, by hash bucket)
    stg_organizations  stg_invoices (by month of CREATED_DATE)
    dim_organizations
    fact_organizations_payment  mart_daily_org_balance
        (by month of DATE, clustered by DATE, ORGANIZATION_ID)
    seeds_daily_org_balance (one row per organization)
"""

from __future__ import annotations

import datetime as _dt
import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions import LOOKBACK_DAYS, LOOKBACK_FLOOR, lenient_timestamp
from ledgerlens.operators.alerts import alert_messages, alerts
from ledgerlens.operators.dims import dim_organizations
from ledgerlens.operators.facts import STAGED_MONTH, fact_daily_payment
from ledgerlens.operators.marts import last_days, mart_daily_balance, mart_daily_balance_since
from ledgerlens.operators.merge import upsert
from ledgerlens.operators.quality import row_rules, run_checks
from ledgerlens.operators.staging import stage_invoices, stage_organizations
from ledgerlens.plans import key_index
from ledgerlens.plans.docs import COLUMN_DOCS, TABLE_DOCS, persist_comments, register_views
from ledgerlens.plans.sinks import (
    ALL, UNSTAGED, cluster, merge_partitions, replace_table, stage, stage_delta, upsert_months, write_fact)
from ledgerlens.sources import versions
from ledgerlens.sources.csv import INVOICES_GLOB, ORGANIZATIONS_GLOB, read_raw_csv
from ledgerlens.sources.schemas import (
    FACT_KEY,
    FACT_PARTITION,
    FACT_PAYMENTS,
    MART_DAILY_BALANCE,
    MART_KEY,
    RAW_INVOICES,
    RAW_INVOICES_KEY,
    RAW_INVOICES_PARTITION,
    RAW_ORGANIZATIONS,
    RAW_ORGANIZATIONS_KEY,
    STG_INVOICES,
    STG_ORGANIZATIONS,
)
from ledgerlens.sources.tables import read_partitioned, read_table, stored_max, table_exists
from ledgerlens.sources.versions import Table

FACT_MONTH_FIELD = T.StructField(FACT_PARTITION, T.DateType())
RAW_MONTH_FIELD = T.StructField(RAW_INVOICES_PARTITION, T.DateType())
STAGED_MONTH_FIELD = T.StructField(STAGED_MONTH, T.DateType())
#: Table property of the seeds: the day before which they are the last days.
SINCE = "ledgerlens.since"


class ChecksFailed(RuntimeError):
    """Raised by a gated build; ``failures`` holds (check, rows) pairs."""

    def __init__(self, failures: list[tuple[str, int]]):
        super().__init__("checks failed: " + ", ".join(f"{name} ({n})" for name, n in failures))
        self.failures = failures


@dataclass(frozen=True)
class Warehouse:
    """The tables below ``root``. ``database`` names their database in the
    catalog; by default it follows from the root."""
    root: str
    database: str = ""

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def table(self, layer: str, model: str, partition: T.StructField | None = None) -> Table:
        database = self.database or "ledgerlens_" + hashlib.sha256(self.root.rstrip("/").encode()).hexdigest()[:16]
        return Table(database, model, self.path(f"{layer}/{model}"), partition, TABLE_DOCS.get(model, ""),
                     COLUMN_DOCS.get(model, {}), row_rules(model), self.root)

    @property
    def raw_organizations(self) -> Table:
        return self.table("raw", "raw_organizations")

    @property
    def raw_invoices(self) -> Table:
        return self.table("raw", "raw_invoices", RAW_MONTH_FIELD)

    @property
    def raw_invoices_keys(self) -> Table:
        return self.table("raw", "raw_invoices_keys", key_index.BUCKET)

    @property
    def stg_organizations(self) -> Table:
        return self.table("curated", "stg_organizations")

    @property
    def stg_invoices(self) -> Table:
        return self.table("curated", "stg_invoices", STAGED_MONTH_FIELD)

    @property
    def dim_organizations(self) -> Table:
        return self.table("curated", "dim_organizations")

    @property
    def fact(self) -> Table:
        return self.table("curated", "fact_organizations_payment", FACT_MONTH_FIELD)

    @property
    def mart(self) -> Table:
        return self.table("marts", "mart_daily_org_balance", FACT_MONTH_FIELD)

    @property
    def seeds(self) -> Table:
        return self.table("marts", "seeds_daily_org_balance")

    def models(self) -> list[Table]:
        """The tables a user reads, in the order in which they are built."""
        return [self.raw_organizations, self.raw_invoices, self.stg_organizations, self.stg_invoices,
                self.dim_organizations, self.fact, self.mart]


def settle(spark: SparkSession, wh: Warehouse) -> None:
    """Finish what a run that was lost left half switched."""
    for t in [*wh.models(), wh.raw_invoices_keys, wh.seeds]:
        versions.settle(spark, t)


def raw_invoice_month() -> Column:
    """Partition value of a RAW invoice: the month of its (leniently parsed)
    CREATED_AT; null when it does not parse."""
    return F.trunc(F.to_date(lenient_timestamp("CREATED_AT")), "month")


def load_raw(spark: SparkSession, wh: Warehouse, organizations: DataFrame | None = None,
             invoices: DataFrame | None = None, order_by: Sequence[str] | None = None) -> None:
    """Upsert landing rows into the RAW tables (insert-only on first load).

    Organizations match on ORGANIZATION_ID; invoices on (INVOICE_ID,
    TRANSACTION_ID) with null equal to ''. Duplicate update keys raise, unless
    ``order_by`` names columns whose greatest value picks the surviving row.
    RAW invoices are stored by the month of CREATED_AT, so a load writes only
    the months it involves; organizations, one snapshot row per organization
    and load, are replaced whole.
    """
    if organizations is not None:
        table, keys, names = wh.raw_organizations, RAW_ORGANIZATIONS_KEY, RAW_ORGANIZATIONS.fieldNames()
        versions.settle(spark, table)
        new = stage(spark, organizations.select(*names), "organizations")  # read by the key check and by the upsert
        base = read_table(spark, table, RAW_ORGANIZATIONS) if table_exists(spark, table) else new.limit(0)
        replace_table(spark, upsert(base, new, keys, order_by=order_by), table)
    if invoices is not None:
        upsert_months(spark, invoices, wh.raw_invoices, wh.raw_invoices_keys, RAW_INVOICES, RAW_INVOICES_KEY,
                      raw_invoice_month(), order_by=order_by)


def ingest_landing(spark: SparkSession, wh: Warehouse, landing_dir: str, multi_line: bool = True,
                   order_by: Sequence[str] | None = None) -> None:
    """Read every ``*organizations*`` / ``*invoices*`` CSV (or .csv.gz) of a
    landing folder and upsert it into RAW. ``multi_line=False`` lets Spark
    split large files that have no line ends inside fields."""
    load_raw(spark, wh,
             read_raw_csv(spark, landing_dir, RAW_ORGANIZATIONS, ORGANIZATIONS_GLOB, multi_line),
             read_raw_csv(spark, landing_dir, RAW_INVOICES, INVOICES_GLOB, multi_line), order_by)


def stage_layer(spark: SparkSession, wh: Warehouse, full: bool = False) -> list[str] | None:
    """Type RAW into the staged tables.

    Staged invoices are stored by month like RAW. RAW notes the months that
    loads have written since it was last staged, so only these are read and
    staged again; ``full``, or a first staging, stages all. Returns the months staged (None: all of them).
    """
    replace_table(spark, stage_organizations(read_table(spark, wh.raw_organizations, RAW_ORGANIZATIONS)), wh.stg_organizations)
    changed = versions.properties(spark, wh.raw_invoices).get(UNSTAGED, ALL)
    full = full or changed == ALL or not table_exists(spark, wh.stg_invoices)
    months = [m for m in changed.split(",") if m]
    rows = read_partitioned(spark, wh.raw_invoices, RAW_INVOICES)
    if not full:
        rows = rows.where(versions.partition_filter(F.col(RAW_INVOICES_PARTITION), months))
    staged = stage_invoices(rows.drop(RAW_INVOICES_PARTITION)).withColumn(STAGED_MONTH, F.trunc("CREATED_DATE", "month"))
    if full:
        replace_table(spark, staged, wh.stg_invoices, ["CREATED_DATE", "INVOICE_ID"])
    elif months:
        versions.replace_partitions(spark, cluster(staged, ["CREATED_DATE", "INVOICE_ID"], STAGED_MONTH), wh.stg_invoices, months)
    versions.set_properties(spark, wh.raw_invoices, {UNSTAGED: ""})
    return None if full else months


def build(spark: SparkSession, wh: Warehouse, full_refresh: bool = False, run_tests: bool = True,
          lookback_days: int = LOOKBACK_DAYS, store_failures: bool = False,
          on_failure: str = "report") -> DataFrame | None:
    """Build staging -> dimension / fact -> mart; return the check summary.

    The fact is incremental: when it exists and ``full_refresh`` is off, only
    invoices created from ``max(DATE) - lookback_days`` on are recomputed and
    merged into their month partitions. ``full_refresh=True`` rebuilds the
    fact from all invoices (dropping rows a merge would have kept) and the
    mart after it, and skips the checks, like a refresh run.

    The checks are evaluated before this returns; those that test single rows
    were counted as the layers were written. With ``on_failure='raise'``
    a failing check raises :class:`ChecksFailed`, so nothing that comes after
    the build is reached; ``'report'`` leaves the verdict to the caller.
    ``store_failures=True`` also writes each check's failing rows below the
    warehouse's ``audit/`` folder.
    """
    if on_failure not in ("raise", "report"):
        raise ValueError("on_failure must be 'raise' or 'report'")
    settle(spark, wh)
    stage_layer(spark, wh, full_refresh)
    replace_table(spark, dim_organizations(read_table(spark, wh.stg_organizations, STG_ORGANIZATIONS)), wh.dim_organizations)
    stg_inv = read_partitioned(spark, wh.stg_invoices, STG_INVOICES)
    delta = refresh_fact(spark, wh, stg_inv, full_refresh, lookback_days)
    refresh_mart(spark, wh, delta, lookback_days)
    for t in wh.models():
        persist_comments(spark, t)
    if full_refresh or not run_tests:
        return None
    summary = run_checks(tables(spark, wh), store_failures=wh.path("audit") if store_failures else None,
                         counted=counted_breaches(spark, wh))
    rows = summary.collect()  # one row per check
    failed = [(r.CHECK_NAME, r.FAILURES) for r in rows if r.STATUS != "pass"]
    if failed and on_failure == "raise":
        raise ChecksFailed(failed)
    return spark.createDataFrame(rows, summary.schema)


def refresh_downstream(spark: SparkSession, wh: Warehouse) -> None:
    """Rebuild the fact from the staged invoices and everything that reads it
    (the mart), leaving staging and the dimension as they are."""
    stg_inv = read_partitioned(spark, wh.stg_invoices, STG_INVOICES)
    refresh_fact(spark, wh, stg_inv, full_refresh=True)
    refresh_mart(spark, wh)


def daily_run(spark: SparkSession, wh: Warehouse, on_failure: str = "raise", **alert_args) -> DataFrame:
    """Build, check, then the alert messages of the newest day; a failing
    check ends the run before any alert (unless ``on_failure='report'``)."""
    build(spark, wh, on_failure=on_failure)
    mart = read_partitioned(spark, wh.mart, MART_DAILY_BALANCE)
    return alert_messages(alerts(mart, **{"alert_date": stored_max(spark, wh.mart), **alert_args}))


def refresh_fact(spark: SparkSession, wh: Warehouse, stg_inv: DataFrame, full_refresh: bool = False,
                 lookback_days: int = LOOKBACK_DAYS) -> DataFrame | None:
    """Rebuild the fact, or merge the lookback window into it.

    Returns the staged delta of a merge (``None`` after a rebuild).
    """
    if full_refresh or not table_exists(spark, wh.fact):
        versions.drop(spark, wh.seeds)
        write_fact(fact_daily_payment(stg_inv, already_upper=True), wh.fact)
        return None
    # The newest day comes from footers; as a literal it prunes the staged
    # months and row groups when the scan is planned. Without any, all is new.
    newest = stored_max(spark, wh.fact) or _dt.date.fromisoformat(LOOKBACK_FLOOR) + _dt.timedelta(days=lookback_days)
    delta = stage_delta(spark, fact_daily_payment(stg_inv, target=newest, days=lookback_days, already_upper=True), wh.fact)
    since = seeds_since(spark, wh)
    if since and delta.where(F.col("DATE") < F.lit(since).cast("date")).limit(1).count():
        versions.drop(spark, wh.seeds)  # an older day changes: they may no longer be the last days
    merge_partitions(spark, delta, wh.fact, FACT_KEY)
    return delta


def mart_start(newest: _dt.date | None, delta: DataFrame, lookback_days: int = LOOKBACK_DAYS) -> _dt.date | None:
    """First mart day to recompute after a fact merge (or None).

    The earlier of the first day the delta changed and the mart's own newest
    day minus the lookback: a run that stopped after merging the fact but
    before the mart is caught up by the next run.
    """
    first = delta.agg(F.min("DATE")).first()[0]
    since = newest - _dt.timedelta(days=lookback_days) if newest else None
    return min((d for d in (first, since) if d), default=None)


def refresh_mart(spark: SparkSession, wh: Warehouse, delta: DataFrame | None = None,
                 lookback_days: int = LOOKBACK_DAYS) -> None:
    """Rebuild the mart, or restate only its days from the first changed one.

    After a fact merge (``delta``), only mart rows dated on or after
    :func:`mart_start` (and null-dated rows) can change; they are recomputed
    from the fact plus one seed row per organization and merged into their
    month partitions. The result equals a full rebuild.
    """
    start = None
    if delta is not None and table_exists(spark, wh.mart):
        start = mart_start(stored_max(spark, wh.mart), delta, lookback_days)
    if start is None:
        fact = read_table(spark, wh.fact, FACT_PAYMENTS)
        write_fact(mart_daily_balance(fact), wh.mart)
        return
    fact = read_partitioned(spark, wh.fact, FACT_PAYMENTS)
    first = F.lit(start).cast("date")
    rows = mart_daily_balance_since(fact, first, refresh_seeds(spark, wh, fact, start))
    merge_partitions(spark, rows, wh.mart, MART_KEY)


def seeds_since(spark: SparkSession, wh: Warehouse) -> str | None:
    """The day before which the kept seeds are the last days, or None."""
    return versions.properties(spark, wh.seeds).get(SINCE) if table_exists(spark, wh.seeds) else None


def refresh_seeds(spark: SparkSession, wh: Warehouse, fact: DataFrame, start) -> DataFrame:
    """Each organization's last fact day before ``start``, kept as a small table.

    A run brings the kept rows forward: together with the fact days from the
    kept start to the new one they give the new last days, so a daily run
    reads the months in between, not the history. With an earlier start
    (late rows) or no kept table all older days are read; a fact that
    is rebuilt or changed before the kept start takes the table away.
    """
    first, since = F.lit(start).cast("date"), seeds_since(spark, wh)
    month = F.lit(start.replace(day=1)).cast("date")
    if since and since <= start.isoformat():
        between = fact.where((F.col(FACT_PARTITION) >= F.lit(since[:8] + "01").cast("date")) & (F.col(FACT_PARTITION) <= month)
                             & (F.col("DATE") >= F.lit(since).cast("date")))
        seeds = last_days(between, first, read_table(spark, wh.seeds))
    else:
        seeds = last_days(fact.where(F.col(FACT_PARTITION) <= month), first)
    replace_table(spark, seeds, wh.seeds, values={SINCE: start.isoformat()})
    return read_table(spark, wh.seeds)


def counted_breaches(spark: SparkSession, wh: Warehouse) -> dict[str, int]:
    """Rows that break a single-row check, by check, as counted when the
    tables were written."""
    out = {}
    for t in wh.models():
        said = versions.counts(spark, t)
        if said is not None:
            out |= {rule: sum(said.get(rule, {}).values()) for rule in t.rules}
    return out


def register(spark: SparkSession, wh: Warehouse, database: str | None = None) -> None:
    """Expose every built table as a view that follows it: a temporary one,
    or, with ``database``, one of that database, with the table's and columns'
    descriptions."""
    register_views(spark, [t for t in wh.models() if table_exists(spark, t)], database)


def tables(spark: SparkSession, wh: Warehouse) -> dict[str, DataFrame]:
    """Scans of every built table, by model name."""
    return {
        "raw_organizations": read_table(spark, wh.raw_organizations, RAW_ORGANIZATIONS),
        "raw_invoices": read_table(spark, wh.raw_invoices, RAW_INVOICES),
        "stg_organizations": read_table(spark, wh.stg_organizations, STG_ORGANIZATIONS),
        "stg_invoices": read_table(spark, wh.stg_invoices, STG_INVOICES),
        "dim_organizations": read_table(spark, wh.dim_organizations),
        "fact_organizations_payment": read_table(spark, wh.fact, FACT_PAYMENTS),
        "mart_daily_org_balance": read_table(spark, wh.mart, MART_DAILY_BALANCE),
    }
