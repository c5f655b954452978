"""Sums of doubles that do not depend on the order in which they are added.

A double is cut into a whole number and two fractions of LIMB_BITS bits each, every one of them
a whole number that is summed exactly. Sums of parts merge in any order and at any number of
partitions to the same value; only then are they put together. What lies below the last
fraction (about 1e-12) is cut off, value by value. The fractions of 2 ** (63 - LIMB_BITS)
values (8e12) fit a long; the whole parts may add up to 9e18.

Each function takes and returns SQL text.
"""

from __future__ import annotations

from collections.abc import Sequence

LIMB_BITS = 20
LIMBS = 3
STEP = f"{1 << LIMB_BITS}D"


def limbs(value: str) -> list[str]:
    """Whole numbers that stand for a double: its floor, then its fraction in two steps."""
    fraction = f"cast(({value} - floor({value})) * {1 << 2 * LIMB_BITS}D as bigint)"
    return [f"floor({value})", f"shiftright({fraction}, {LIMB_BITS})", f"{fraction} & {(1 << LIMB_BITS) - 1}L"]


def limb_sums(value: str) -> list[str]:
    return [f"sum({limb})" for limb in limbs(value)]


def joined(sums: Sequence[str]) -> str:
    """The double that sums of limbs stand for."""
    whole, first, second = (f"cast({s} as double)" for s in sums)
    return f"({whole} + ({first} + {second} / {STEP}) / {STEP})"


def exact_sum(value: str) -> str:
    return joined(limb_sums(value))


def exact_mean_of(value: str) -> str:
    """NULL without values."""
    return f"{exact_sum(value)} / nullif(count({value}), 0)"
