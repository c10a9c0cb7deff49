"""DataFrame -> DataFrame operators of every layer."""

from ledgerlens.operators.alerts import (  # noqa: F401
    alert_messages,
    alerts,
    alerts_macro,
    filter_ids,
    latest_day,
    on_date,
    top_alerts,
)
from ledgerlens.operators.dims import dim_organizations, latest_per_key  # noqa: F401
from ledgerlens.operators.facts import fact_daily_payment, lookback, lookback_start, settled, usd_rows  # noqa: F401
from ledgerlens.operators.marts import mart_daily_balance, mart_daily_balance_since, with_prev  # noqa: F401
from ledgerlens.operators.merge import DuplicateKeyError, merge_incremental, upsert  # noqa: F401
from ledgerlens.operators.quality import (  # noqa: F401
    ContractError,
    check_not_null,
    check_pct_guard,
    check_prev,
    check_unique,
    enforce_contract,
    failing_rows,
    freshness,
    run_checks,
)
from ledgerlens.operators.staging import stage_invoices, stage_organizations  # noqa: F401
