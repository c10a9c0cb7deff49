"""Scalar Column functions (JVM-side, codegen-friendly)."""

from ledgerlens.functions.scalars import (  # noqa: F401
    LOOKBACK_DAYS,
    LOOKBACK_FLOOR,
    SETTLED_STATUSES,
    abs_change,
    blank_to_null,
    clean_code,
    id_tokens,
    lenient_date,
    lenient_timestamp,
    live_alert_rule,
    macro_alert_rule,
    money_text,
    pct_change,
    percent_text,
    plain_text,
    to_usd,
)
