"""Rounding and ratios. Results are decimals, rounded half away from zero.

Each function takes and returns SQL text, for use in ``selectExpr`` or ``expr``.
"""

from __future__ import annotations

NUMERIC = "decimal(38,10)"


def round_half_up(value: str, places: int = 2) -> str:
    """Round through decimal, since a double such as 1.005 lies below its own text."""
    return f"round(cast({value} as {NUMERIC}), {places})"


def guarded_ratio(top: str, bottom: str) -> str:
    return f"({top}) / nullif({bottom}, 0)"


def exact_mean(total: str, count: str, places: int = 2, scale: int = 1) -> str:
    """``scale * total / count`` for non-negative whole numbers, rounded exactly.

    Whole-number arithmetic keeps ties exact at any row count; no division result is
    rounded twice. NULL when ``total`` is NULL or ``count`` is zero.
    """
    ticks = 10**places
    steps = f"({total} * {2 * scale * ticks} + {count}) div (2 * nullif({count}, 0))"
    return f"cast({steps} as decimal(18,0)) * {1 / ticks:.{places}f}BD"


def share_percent(part: str, whole: str, places: int = 2) -> str:
    return exact_mean(part, whole, places, scale=100)
