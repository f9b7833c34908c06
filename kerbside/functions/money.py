"""Money sums that do not depend on row order.

Adding doubles in another order changes the last bits, so amounts are summed as whole millionths: each is split in
a high and a low part, whose sums are 64-bit integers that hash aggregation updates in place and that do not
overflow below 10**18 rows.  Amounts that are not finite, or beyond 9 * 10**12, are added as doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = 10**6  # digits after the point that count: six
_LARGEST = 9.0e12  # whose millionths fit a long
_LOW = (1 << 32) - 1


def money_parts(amount: Column) -> dict[str, Column]:
    """Aggregates that add up: number of amounts, both parts of their millionths, and the amounts kept as doubles."""
    amount = amount.cast("double")
    small = F.abs(amount) < _LARGEST
    units = F.when(small, F.round(amount * UNITS).cast("long"))
    return {"n_values": F.count(amount), "high": F.sum(F.shiftright(units, 32)),
            "low": F.sum(units.bitwiseAND(F.lit(_LOW).cast("long"))), "other": F.sum(F.when(~small, amount))}


def merged_parts() -> dict[str, Column]:
    """The same of groups of rows that carry such parts."""
    return {name: F.sum(name) for name in ("n_values", "high", "low", "other")}


def _total(parts: dict[str, Column]) -> Column:
    """Sum of the non-null amounts, null for none: a decimal up to its last step."""
    whole = (parts["high"].cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(11,0)") + parts["low"].cast("decimal(20,0)"))
    exact = (whole * F.lit("0.000001").cast("decimal(6,6)")).cast("double")
    other = parts["other"]
    return F.when(other.isNull(), exact).otherwise(other + F.coalesce(exact, F.lit(0.0)))


def sum_of_parts(parts: dict[str, Column]) -> Column:
    """Sum; 0.0 for a group without any amount."""
    return F.coalesce(_total(parts), F.lit(0.0))


def avg_of_parts(parts: dict[str, Column]) -> Column:
    """Mean of the non-null amounts; null for a group without any."""
    return _total(parts) / F.nullif(parts["n_values"], F.lit(0))


def money_sum(amount: Column) -> Column:
    """Sum; 0.0 for a group without any amount."""
    return sum_of_parts(money_parts(amount))


def money_avg(amount: Column) -> Column:
    """Mean of the non-null amounts; null for a group without any."""
    return avg_of_parts(money_parts(amount))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, 0.0 where the denominator is not positive."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """part * 100 / whole, null where whole is zero or missing."""
    return part * F.lit(100.0) / F.nullif(whole, F.lit(0).cast("double"))
