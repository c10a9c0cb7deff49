"""Table and column descriptions, kept in the catalog, and views of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.sources import versions
from ledgerlens.sources.versions import Table, quoted, text

# --- fixed values: descriptions of the reference's models ----------------------
TABLE_DOCS = {
    "stg_organizations": "Staging: organizations from RAW, typed & cleaned.",
    "stg_invoices": "Staging: invoices from RAW, typed & cleaned.",
    "dim_organizations": "Organization dimension with key dates and metadata.",
    "fact_organizations_payment": (
        "Daily organization-level payments in USD (statuses: CREDITED, REFUNDED, PAID). "
        "USD is derived via COALESCE(PAYMENT_AMOUNT/FX_RATE_PAYMENT, AMOUNT/FX_RATE)."),
    "mart_daily_org_balance": "Daily payments per org in USD with DoD % change vs last available day.",
}
COLUMN_DOCS = {
    "mart_daily_org_balance": {
        "DAILY_PAYMENT_AMOUNT": "USD payment amount for the day",
        "PREV_DAILY_PAYMENT_AMOUNT": "USD amount from the previous available day for the org (may be null)",
        "DOD_CHANGE_PCT": "Percent change vs previous available day; null when no prior or prior equals zero",
    },
}
# ------------------------------------------------------------------------------


def described(spark: SparkSession, name: str) -> dict[str, str]:
    """The descriptions that the catalog has of a table or view, by column;
    that of the table itself under ''."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    out = {}
    for r in rows:
        if not r.col_name or r.col_name.startswith("#"):
            break  # the columns come first
        if r.comment:
            out[r.col_name] = r.comment
    for r in rows:
        if r.col_name == "Comment" and r.data_type:
            out[""] = r.data_type
    return out


def persist_comments(spark: SparkSession, t: Table) -> None:
    """Bring the catalog's descriptions of a table up to date. A table is
    created with them; this is for one that was made with others, or whose
    descriptions were changed by hand, and changes only those that differ."""
    has = described(spark, t.name)
    if has.get("", "") != t.comment:
        spark.sql(f"COMMENT ON TABLE {t.name} IS {text(t.comment)}")
    for f in versions.read(spark, t).schema.fields:
        if has.get(f.name, "") != t.comments.get(f.name, ""):
            spark.sql(f"ALTER TABLE {t.name} ALTER COLUMN {quoted(f.name)} COMMENT {text(t.comments.get(f.name, ''))}")


VIEW_PROPERTY = "ledgerlens.table"


def register_views(spark: SparkSession, tables: list[Table], database: str | None = None) -> None:
    """Register a view of each table.

    A view names its table, not files, so it shows what later runs build,
    columns that they add or drop included. Without ``database`` the views are temporary. In a
    database they have the table's descriptions and are marked as ours; a
    table or view of the same name that is not marked is left alone and raises.
    """
    for t in tables:
        if database is None:
            spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {quoted(t.model)} AS SELECT * FROM {t.name}")
            continue
        full = f"{quoted(database)}.{quoted(t.model)}"
        if spark.catalog.tableExists(full):
            props = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {full}").collect()}
            if props.get(VIEW_PROPERTY) != t.name:
                raise ValueError(f"{database}.{t.model} exists and is not a view of {t.name}; it is left as it is")
        spark.sql(f"CREATE OR REPLACE VIEW {full} WITH SCHEMA EVOLUTION COMMENT {text(t.comment)} "
                  f"TBLPROPERTIES ({text(VIEW_PROPERTY)} = {text(t.name)}) AS SELECT * FROM {t.name}")


def catalog_comments(spark: SparkSession, tables: list[Table]) -> DataFrame:
    """TABLE_NAME, COLUMN_NAME ('' for the table), COMMENT as the catalog has them, and N_VALUES: the
    rows of the table, or the non-null values of the column. One row for each
    description."""
    parts = None
    for t in tables:
        has = described(spark, t.name)
        if not has:
            continue
        one = F.count(F.lit(1))
        sums = versions.read(spark, t).agg(*[(F.count(quoted(c)) if c else one).alias(f"n{i}") for i, c in enumerate(has)])
        stack = ", ".join(f"{text(c)}, {text(d)}, n{i}" for i, (c, d) in enumerate(has.items()))
        rows = sums.selectExpr(f"{text(t.model)} AS TABLE_NAME",
                               f"stack({len(has)}, {stack}) AS (COLUMN_NAME, COMMENT, N_VALUES)")
        parts = rows if parts is None else parts.unionByName(rows)
    if parts is None:
        return spark.createDataFrame([], "TABLE_NAME string, COLUMN_NAME string, COMMENT string, N_VALUES long")
    return parts
