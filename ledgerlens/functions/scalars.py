"""Column-level building blocks.

Every function here returns a ``Column`` so the expression stays inside
Catalyst / whole-stage codegen; none of them touches Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- fixed values that must match the reference -------------------------------
# Statuses counted as settled money (compared after upper-casing).
SETTLED_STATUSES = ("CREDITED", "REFUNDED", "PAID")
# Floor used by the incremental lookback when the target is still empty.
LOOKBACK_FLOOR = "1900-01-01"
# Default number of days recomputed before the latest loaded day.
LOOKBACK_DAYS = 7
# ------------------------------------------------------------------------------


def blank_to_null(c: ColumnOrName) -> Column:
    """``nullif(c, '')`` — the empty string is treated as missing."""
    return F.nullif(_c(c), F.lit(""))


def clean_code(c: ColumnOrName) -> Column:
    """``upper(nullif(c, ''))``: code columns are upper-cased, blanks become null.

    No trimming happens, so ``' '`` stays a one-space value.
    """
    return F.upper(blank_to_null(c))


def lenient_timestamp(c: ColumnOrName) -> Column:
    """Parse text to ``timestamp_ntz``; unparsable text becomes null.

    The second branch (``'T'`` replaced by a space) is a fallback kept for
    inputs the first attempt refuses; Spark's cast already reads both forms.
    The NTZ type keeps the wall clock of ``...+02:00`` inputs, so a day
    boundary never moves with the session time zone.
    """
    c = _c(c)
    return F.coalesce(
        c.try_cast("timestamp_ntz"),
        F.replace(c, F.lit("T"), F.lit(" ")).try_cast("timestamp_ntz"),
    )


def lenient_date(c: ColumnOrName) -> Column:
    """``to_date(try_to_timestamp_ntz(c))``."""
    return F.to_date(_c(c).try_cast("timestamp_ntz"))


def to_usd(
    amount: ColumnOrName,
    rate: ColumnOrName,
    payment_amount: ColumnOrName,
    payment_rate: ColumnOrName,
    scale: int = 8,
) -> Column:
    """USD value of one invoice.

    The payment side (``payment_amount / payment_rate``) wins; when it is not
    computable (null amount, null or zero rate) the invoice side is used.
    ``nullif(rate, 0)`` turns a zero rate into null *before* the division, so
    the ANSI divide-by-zero error never fires. The exact decimal quotient is
    pinned to ``decimal(30, scale)`` so that the later sum has a stable type.
    """
    usd = F.coalesce(
        _c(payment_amount) / F.nullif(_c(payment_rate), F.lit(0)),
        _c(amount) / F.nullif(_c(rate), F.lit(0)),
    )
    return usd.cast(f"decimal(30,{scale})")


def abs_change(cur: ColumnOrName, prev: ColumnOrName) -> Column:
    """Signed change ``cur - coalesce(prev, 0)``."""
    return _c(cur) - F.coalesce(_c(prev), F.lit(0))


def pct_change(cur: ColumnOrName, prev: ColumnOrName) -> Column:
    """Guarded relative change as a fraction (0.5 = +50 %).

    Null when ``prev`` is null or zero, otherwise ``(cur - prev) / abs(prev)``
    computed in double (a decimal quotient of two wide decimals would be cut
    to six digits).
    """
    cur_d = _c(cur).cast("double")
    prev_d = _c(prev).cast("double")
    return F.when(_c(prev).isNull() | (_c(prev) == 0), F.lit(None).cast("double")).otherwise(
        (cur_d - prev_d) / F.abs(prev_d)
    )


def live_alert_rule(change: ColumnOrName, pct: ColumnOrName, threshold: float, min_abs: float) -> Column:
    """Rule of the daily alert job; both bounds are inclusive.

    Fires on a rise of at least ``min_abs`` whose pct is unknown or at least
    ``threshold``, or on a fall of at least ``min_abs`` whose pct is unknown or
    at most ``-threshold``.
    """
    change, pct = _c(change), _c(pct)
    t, m = F.lit(float(threshold)), F.lit(float(min_abs))
    up = (change >= m) & (pct.isNull() | (pct >= t))
    down = (change <= -m) & (pct.isNull() | (pct <= -t))
    return up | down


def macro_alert_rule(
    cur: ColumnOrName, prev: ColumnOrName, pct: ColumnOrName, threshold: float, min_abs: float
) -> Column:
    """Rule of the templated alert query; both tests are strict.

    ``abs(coalesce(pct, 0)) > threshold``; ``min_abs = 0`` switches the amount
    test off, otherwise ``abs(cur - coalesce(prev, 0)) > min_abs``.
    """
    rule = F.abs(F.coalesce(_c(pct), F.lit(0.0))) > F.lit(float(threshold))
    if float(min_abs) != 0.0:
        delta = F.abs(F.coalesce(abs_change(cur, prev), F.lit(0)))
        rule = rule & (delta > F.lit(float(min_abs)))
    return rule


def id_tokens(ids: str | Iterable[str] | None) -> Column | None:
    """A comma-separated id list (or an iterable of ids) as an array column of
    its tokens, which are not trimmed; None for an empty list, which means off.
    The list is one literal, however long it is."""
    if ids is None or ids == "":
        return None
    if isinstance(ids, str):
        return F.split(F.lit(ids), ",")
    tokens = [str(t) for t in ids]
    return F.split(F.lit("\x00".join(tokens)), "\x00") if tokens else None


def _signed(value: Column, rounded: Column, text: Column) -> Column:
    """``text`` of ``rounded``; a negative value that rounds to zero keeps its sign."""
    return F.when((rounded == 0) & (value < 0), F.concat(F.lit("-"), text)).otherwise(text)


def money_text(c: ColumnOrName, decimals: int = 2, grouped: bool = True) -> Column:
    """``f"{x:,.2f}"`` (or ``f"{x:.2f}"``) of a decimal: half-even on the exact
    value, so no digit of a large amount is lost."""
    rounded = F.bround(_c(c), decimals)
    text = F.format_number(rounded, decimals)
    return _signed(_c(c), rounded, text if grouped else F.replace(text, F.lit(",")))


def percent_text(pct: ColumnOrName, decimals: int = 1) -> Column:
    """``"n/a"`` for null, otherwise the fraction times 100 with a ``%`` sign.

    Rounded half to even on the decimal the fraction prints as (0.1225 is
    ``12.2%``); a fraction too large for that decimal is formatted as it is.
    """
    p = _c(pct)
    exact = p.cast("double").try_cast("decimal(30,12)") * F.lit(100)
    rounded = F.bround(exact, decimals)
    text = _signed(exact, rounded, F.replace(F.format_number(rounded, decimals), F.lit(",")))
    return F.when(p.isNull(), F.lit("n/a")).otherwise(
        F.concat(F.coalesce(text, F.format_string(f"%.{decimals}f", p.cast("double") * 100)), F.lit("%")))


def plain_text(c: ColumnOrName, none_text: str = "None") -> Column:
    """Text of a value as a Python ``str()`` would print it (``None`` for null)."""
    return F.coalesce(_c(c).cast("string"), F.lit(none_text))
