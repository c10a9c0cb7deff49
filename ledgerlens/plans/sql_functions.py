"""The templated alert query as a SQL table function of the catalog, for
users who work in SQL: ``SELECT * FROM alert_daily_balance(min_abs => 500)``."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ledgerlens.operators.alerts import DAILY_JOB_MIN_ABS, DEFAULT_THRESHOLD
from ledgerlens.plans.build import Warehouse
from ledgerlens.sources.schemas import MART_DAILY_BALANCE
from ledgerlens.sources.versions import quoted, text

ALERT_FUNCTION = "alert_daily_balance"


def create_alert_function(spark: SparkSession, wh: Warehouse, database: str | None = None) -> str:
    """Create (or replace) the function; returns the name to call it by.

    It belongs to the session, or, with ``database``, to that database, where
    it outlives the session and is called after ``USE <database>`` (Spark takes no
    qualified name for a table function).
    Its five parameters may be literals or parameter markers, by place or name:
    ``alert_date`` (text; null: the newest day of the mart), ``threshold``,
    ``min_abs`` (0: no test), ``allowlist``, ``denylist`` (comma-separated ids
    matched whole and untrimmed; '': off). The rows are those of
    :func:`ledgerlens.operators.alerts.alerts_macro`, which joins the lists and
    so suits lists of thousands of ids better. The function names the mart's table, so it
    follows every build, and reads the alert day's month alone.
    """
    mart = wh.mart
    month = quoted(mart.partition.name)
    kind, name = ("", f"{quoted(database)}.{ALERT_FUNCTION}") if database else ("TEMPORARY ", ALERT_FUNCTION)
    fields = MART_DAILY_BALANCE.fields
    newest = f"SELECT max(DATE) FROM {mart.name} WHERE {month} = (SELECT max({month}) FROM {mart.name})"
    day = f"coalesce(to_date(alert_date), ({newest}))"
    org = "cast(m.ORGANIZATION_ID AS string)"
    spark.sql(f"""
CREATE OR REPLACE {kind}FUNCTION {name}(
  alert_date STRING DEFAULT NULL COMMENT 'day to look at; null: the newest',
  threshold DOUBLE DEFAULT {DEFAULT_THRESHOLD}D COMMENT 'least change as a fraction, exclusive',
  min_abs DOUBLE DEFAULT {DAILY_JOB_MIN_ABS}D COMMENT 'least absolute change, exclusive; 0: any',
  allowlist STRING DEFAULT '' COMMENT 'ids to look at; empty: all',
  denylist STRING DEFAULT '' COMMENT 'ids to leave out')
RETURNS TABLE ({", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields)})
COMMENT {text("Organizations whose balance changed by more than the threshold on one day.")}
RETURN SELECT {", ".join(f"m.{quoted(f.name)}" for f in fields)} FROM {mart.name} m
  WHERE m.DATE = {day} AND m.{month} = trunc({day}, 'month')
    AND abs(coalesce(m.DOD_CHANGE_PCT, 0)) > threshold
    AND (min_abs = 0 OR abs(coalesce(m.DAILY_PAYMENT_AMOUNT - coalesce(m.PREV_DAILY_PAYMENT_AMOUNT, 0), 0)) > min_abs)
    AND (allowlist = '' OR find_in_set({org}, allowlist) > 0)
    AND (denylist = '' OR find_in_set({org}, denylist) = 0)
""")
    return ALERT_FUNCTION
