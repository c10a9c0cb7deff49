"""Alerts on day-over-day balance changes, and their message text."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import (
    abs_change,
    id_tokens,
    live_alert_rule,
    macro_alert_rule,
    money_text,
    percent_text,
    plain_text,
)
from ledgerlens.sources.tables import high_water_mark

MONTH_COL = "MONTH"  # partition column of stored (org, day) tables

# --- fixed values that must match the reference -------------------------------
DEFAULT_THRESHOLD = 0.5          # fraction: 0.5 = 50 %
SCRIPT_MIN_ABS = 1000.0          # min |change| of the standalone alert script
DAILY_JOB_MIN_ABS = 0.0          # min |change| of the scheduled daily job
MESSAGE_LINE_CAP = 50            # alert lines per posted message
BLOCK_HEADER = ":rotating_light: *Balance Change Alert*"
BLOCK_ORG, BLOCK_DATE = "• Org: `", "• Date: "
BLOCK_TODAY, BLOCK_PREVIOUS, BLOCK_CHANGE = "• Today's Amount: ", "• Previous Day: ", "• DoD Change: *"
BLOCK_DELTA, BLOCK_END = "* (Δ=", ")"
LINE_ORG, LINE_DELTA, LINE_PCT, LINE_TODAY, LINE_PREVIOUS = "• org `", "` | Δ=", " (", ") | today=", " prev="
DIGEST_HEADER = "*Daily Balance alerts* for `"
DIGEST_CLEAR = ":white_check_mark: No Daily Balance alerts for "
TABLE_HEADER = "ORGANIZATION_ID\tDATE\tDAILY_PAYMENT_AMOUNT\tPREV_DAILY_PAYMENT_AMOUNT\tPCT_CHANGE\tABS_CHANGE"
# ------------------------------------------------------------------------------


def latest_day(mart: DataFrame, date_col: str = "DATE") -> DataFrame:
    """One row: ``LATEST_DATE`` and its ``yyyy-MM-dd`` text ``ALERT_DATE``; of a
    stored mart, only the newest month is read."""
    newest = high_water_mark(mart, date_col, partition_col=MONTH_COL)
    return mart.sparkSession.range(1).select(newest.alias("LATEST_DATE")).select(
        "LATEST_DATE", F.date_format("LATEST_DATE", "yyyy-MM-dd").alias("ALERT_DATE"))


def on_date(mart: DataFrame, alert_date: str | _dt.date | None = None, date_col: str = "DATE") -> DataFrame:
    """Rows of one day: the given ``alert_date`` or the latest day of ``mart``.

    The latest day is a scalar subquery (evaluated once); a literal date is
    folded into the scan as a pushed filter / partition filter.
    """
    if alert_date is None:
        day: Column = high_water_mark(mart, date_col, partition_col=MONTH_COL)
    else:
        day = F.lit(str(alert_date)).cast("date")
    out = mart.where(F.col(date_col) == day)
    if MONTH_COL in mart.columns:
        # Stored month-partitioned: only the alert day's month is listed and
        # read. The newest month is found from the partition column alone;
        # the same (reused) subquery also bounds the latest-day subquery.
        month = (mart.agg(F.max(MONTH_COL)).scalar() if alert_date is None
                 else F.trunc(day, "month"))
        out = out.where(F.col(MONTH_COL) == month).drop(MONTH_COL)
    return out


def alerts(mart: DataFrame, alert_date: str | None = None, threshold: float = DEFAULT_THRESHOLD,
           min_abs: float = SCRIPT_MIN_ABS) -> DataFrame:
    """Live alert query: inclusive bounds, unknown pct fires, biggest change first.

    Columns: ORGANIZATION_ID, DATE, DAILY_PAYMENT_AMOUNT, PREV_DAILY_PAYMENT_AMOUNT,
    PCT_CHANGE, ABS_CHANGE; ordered by abs(ABS_CHANGE) desc, ORGANIZATION_ID.
    """
    day = on_date(mart, alert_date)
    out = day.select(
        "ORGANIZATION_ID", "DATE", "DAILY_PAYMENT_AMOUNT", "PREV_DAILY_PAYMENT_AMOUNT",
        F.col("DOD_CHANGE_PCT").alias("PCT_CHANGE"),
        abs_change("DAILY_PAYMENT_AMOUNT", "PREV_DAILY_PAYMENT_AMOUNT").alias("ABS_CHANGE"),
    )
    return (out.where(live_alert_rule("ABS_CHANGE", "PCT_CHANGE", threshold, min_abs))
               .orderBy(F.abs("ABS_CHANGE").desc(), F.col("ORGANIZATION_ID").asc()))


def top_alerts(mart: DataFrame, n: int = MESSAGE_LINE_CAP, **kw) -> DataFrame:
    """The first ``n`` alerts of :func:`alerts` (plans as a top-k, no full sort)."""
    return alerts(mart, **kw).limit(n)


def alerts_macro(mart: DataFrame, alert_date: str | None = None, threshold: float = DEFAULT_THRESHOLD,
                 min_abs: float = DAILY_JOB_MIN_ABS, allow: str | Iterable[str] | None = None,
                 deny: str | Iterable[str] | None = None) -> DataFrame:
    """Templated alert query: strict bounds, null pct counts as 0, id order.

    ``allow`` / ``deny`` are comma-separated id lists (whole-token match,
    tokens not trimmed); empty or ``None`` switches a list off.
    """
    day = on_date(mart, alert_date)
    rule = macro_alert_rule("DAILY_PAYMENT_AMOUNT", "PREV_DAILY_PAYMENT_AMOUNT", "DOD_CHANGE_PCT",
                            threshold, min_abs)
    return filter_ids(day.where(rule), "ORGANIZATION_ID", allow, deny).orderBy("ORGANIZATION_ID")


def filter_ids(df: DataFrame, column: str, allow: str | Iterable[str] | None = None,
               deny: str | Iterable[str] | None = None) -> DataFrame:
    """The rows of ``df`` whose id, as text, is a token of ``allow`` and none of
    ``deny``; an empty list is off, and a null id is in no list and passes none.

    A list is one literal that the executors split; the rows are
    semi- or anti-joined with it, so a list of many thousand ids costs a hash
    lookup a row. It is broadcast: it came from the driver to begin with.
    """
    for ids, how in ((id_tokens(allow), "left_semi"), (id_tokens(deny), "left_anti")):
        if ids is not None:
            tokens = df.sparkSession.range(1).select(F.explode(ids).alias("_id"))
            df = df.where(F.col(column).isNotNull()).join(F.broadcast(tokens), F.col(column).cast("string") == F.col("_id"), how)
    return df


def alert_messages(alert_rows: DataFrame) -> DataFrame:
    """Add the three message layouts as columns (text built JVM-side per row).

    * ``MESSAGE_LINE`` — one line per organization for the capped summary:
      ``• org `ID` | Δ=1,234.50 (12.3%) | today=2,000.00 prev=765.50``
    * ``MESSAGE_BLOCK`` — one multi-line message per alert (daily job); amounts
      are printed as stored, a missing previous day as ``None``.
    * ``MESSAGE_TABLE`` — one tab-separated console line (header:
      :data:`TABLE_HEADER`), amounts with two decimals.
    """
    pct, org = percent_text("PCT_CHANGE"), F.col("ORGANIZATION_ID").cast("string")
    day = F.date_format("DATE", "yyyy-MM-dd")
    prev = F.coalesce(F.col("PREV_DAILY_PAYMENT_AMOUNT"), F.lit(0))
    line = F.concat(
        F.lit(LINE_ORG), org, F.lit(LINE_DELTA), money_text("ABS_CHANGE"), F.lit(LINE_PCT), pct, F.lit(LINE_TODAY),
        money_text("DAILY_PAYMENT_AMOUNT"), F.lit(LINE_PREVIOUS), money_text(prev))
    block = F.concat_ws(
        "\n",
        F.lit(BLOCK_HEADER),
        F.concat(F.lit(BLOCK_ORG), org, F.lit("`")),
        F.concat(F.lit(BLOCK_DATE), day),
        F.concat(F.lit(BLOCK_TODAY), plain_text("DAILY_PAYMENT_AMOUNT")),
        F.concat(F.lit(BLOCK_PREVIOUS), plain_text("PREV_DAILY_PAYMENT_AMOUNT")),
        F.concat(F.lit(BLOCK_CHANGE), pct, F.lit(BLOCK_DELTA), money_text("ABS_CHANGE"), F.lit(BLOCK_END)))
    table = F.concat_ws(
        "\t", org, day, money_text("DAILY_PAYMENT_AMOUNT", grouped=False), money_text(prev, grouped=False), pct,
        money_text("ABS_CHANGE", grouped=False))
    return (alert_rows.withColumn("MESSAGE_LINE", line).withColumn("MESSAGE_BLOCK", block)
            .withColumn("MESSAGE_TABLE", table))


def alert_digest(mart: DataFrame, alert_date: str | None = None, threshold: float = DEFAULT_THRESHOLD,
                 min_abs: float = SCRIPT_MIN_ABS, cap: int = MESSAGE_LINE_CAP) -> DataFrame:
    """One row: the alert day, the number of alerts, and one message text —
    a header line plus at most ``cap`` alert lines, biggest change first (or
    an all-clear line when nothing fired).

    The day's alerts are counted in one aggregate; only the ``cap`` top lines
    (a top-k, bounded by ``cap``) are gathered into the text. A mart without
    any dated row has no alert day: reading the result then raises.
    """
    rows = alert_messages(alerts(mart, alert_date, threshold, min_abs))
    day = mart.sparkSession.range(1).select(
        (high_water_mark(mart, "DATE", partition_col=MONTH_COL) if alert_date is None
         else F.lit(str(alert_date)).cast("date")).alias("D"))
    ranked = rows.select(F.abs("ABS_CHANGE").alias("_a"), "ORGANIZATION_ID", "MESSAGE_LINE")
    top = ranked.orderBy(F.col("_a").desc(), F.col("ORGANIZATION_ID").asc()).limit(cap)
    lines = top.agg(F.sort_array(F.collect_list(F.struct(-F.col("_a"), F.col("ORGANIZATION_ID"),
                                                         F.col("MESSAGE_LINE")))).alias("L"))
    n = rows.agg(F.count(F.lit(1))).scalar()
    params = f"(threshold={threshold:.2f}, min_abs={min_abs:,.0f})"
    date_txt = F.date_format("D", "yyyy-MM-dd")
    header = F.concat(F.lit(DIGEST_HEADER), date_txt, F.lit(f"`  {params}"))
    clear = F.concat(F.lit(DIGEST_CLEAR), date_txt, F.lit(f" {params}."))
    body = F.array_join(F.transform("L", lambda s: s["MESSAGE_LINE"]), "\n")
    out = day.select("D", n.alias("N_ALERTS"), lines.scalar().alias("L"))
    none = F.raise_error(F.lit("no alert day: the mart holds no dated row"))
    return out.select(
        F.when(F.col("D").isNull(), none.cast("date")).otherwise(F.col("D")).alias("ALERT_DATE"), "N_ALERTS",
        F.when(F.col("N_ALERTS") == 0, clear).otherwise(F.concat_ws("\n", header, body)).alias("MESSAGE"))
