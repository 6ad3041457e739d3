"""Money arithmetic and the ratios the reports share."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesmart.functions.dates import is_long_weekend
from salesmart.schema import MONEY

# Money before it is summed: the sum has ten digits more.
WIDE = "decimal(28,2)"
# Fixed value: price factor from Friday to Sunday.
WEEKEND_UPLIFT = Decimal("1.15")


def gross_amount(unit_price: Column, quantity: Column) -> Column:
    return F.round(unit_price * quantity, 2).cast(MONEY)


def discount_amount(gross: Column, discount_pct: Column) -> Column:
    """Percentage of the gross amount, half a cent rounding away from zero."""
    return F.round(gross * discount_pct * F.lit(Decimal("0.01")), 2).cast(MONEY)


def net_amount(gross: Column, discount: Column) -> Column:
    return F.round(gross - discount, 2).cast(MONEY)


def weekend_price(unit_price: Column, day: Column) -> Column:
    raised = F.round(unit_price * F.lit(WEEKEND_UPLIFT), 2).cast(MONEY)
    return F.when(is_long_weekend(day), raised).otherwise(unit_price)


def total(amount: Column | str) -> Column:
    """Sum of money in 38 digits: a sum of decimal(8,2) alone has 18 and would
    overflow at some 10^11 rows."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return F.sum(amount.cast(WIDE))


def mean(value: Column | str) -> Column:
    """Average that ignores NULLs, exact up to the final division."""
    return F.sum(value).cast("double") / F.count(value)


def mean_money(amount: Column | str) -> Column:
    """``mean`` of money, with the range of ``total``."""
    return total(amount).cast("double") / F.count(amount)


def quotient(numerator: Column, denominator: Column, places: int) -> Column:
    """``numerator / denominator`` rounded once, half away from zero.

    Both have at most two decimals.  Whole numbers are divided, as a decimal
    quotient of wide sums keeps too few places to be rounded again.
    """
    a = (numerator.cast(WIDE) * 100).cast("decimal(30,0)")
    b = (denominator.cast(WIDE) * 100).cast("decimal(30,0)")
    # An engine's "div" cuts off; half of the divisor added first rounds.
    steps = F.call_function("div", F.abs(a) * F.lit(2 * 10**places) + F.abs(b), F.abs(b) * F.lit(2))
    negative = (F.signum(a) * F.signum(b)) < 0
    signed = F.when(negative, -steps).otherwise(steps).cast("decimal(20,0)")
    return (signed * F.lit(Decimal(1).scaleb(-places))).cast(f"decimal(24,{places})")


def mean_rounded(value: Column | str, places: int) -> Column:
    """Average of money, rounded once and without leaving decimals."""
    return quotient(total(value), F.count(value), places)


def div0(numerator: Column, denominator: Column) -> Column:
    """Division that is 0 for a zero denominator and NULL if either side is."""
    zero = F.when(numerator.isNotNull(), F.lit(0))
    return F.when(denominator == 0, zero).otherwise(numerator / F.nullif(denominator, F.lit(0)))


def percent_of(part: Column, whole: Column, places: int = 1) -> Column:
    return F.round(F.lit(100) * part / whole, places)
