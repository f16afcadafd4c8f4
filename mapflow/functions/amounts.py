"""Exact sums of two-decimal amounts that are stored as doubles.

Sums of doubles depend on the order of the rows, that is on the partitioning.
Casting every double to a decimal is exact but slow. Whole hundredths as long
values are exact and cheap; they are summed as decimals, which do not overflow.
The helpers return SQL text for use in mappings.
"""

from __future__ import annotations


def hundredths(amount: str) -> str:
    """A two-decimal amount as a whole number of hundredths; any other amount is an error."""
    nearest = f"floor(({amount}) * 100 + 0.5d)"
    return (
        f"if(abs(({amount}) * 100 - {nearest}) > 0.001d, "
        f"cast(raise_error(concat('not a whole number of hundredths: ', {amount})) as bigint), {nearest})"
    )


def exact_sum(whole: str, scale: int = 2) -> str:
    """Sum of whole units of ``10 ** -scale``, as a double amount."""
    return f"cast(sum(cast({whole} as decimal(18,0))) as double) / {10**scale}d"
