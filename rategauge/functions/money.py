"""Prices: parsing, exact means, deviations."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, IntegralType, NumericType

from rategauge.schemas import MONEY_DDL

#: Characters dropped from price text before the number is read (fixed values).
CURRENCY_MARKS = "$,"


def parse_price(price: Column, dtype: DataType) -> Column:
    """Price as decimal(10,2), NULL when absent, unreadable or out of range.

    Numeric columns are cast directly.  Text loses every ``$`` and ``,`` first;
    plain replacement is cheaper than a regular expression or ``translate``.
    ``try_cast`` keeps one bad cell from ending a job in ANSI mode; it gives NULL
    for blank text too.
    """
    if isinstance(dtype, NumericType):
        return price.try_cast(MONEY_DDL)
    number = price.cast("string")
    for mark in CURRENCY_MARKS:
        number = F.replace(number, F.lit(mark), F.lit(""))
    return number.try_cast(MONEY_DDL)


def has_positive_price(price: Column, dtype: DataType) -> Column:
    """True where :func:`parse_price` gives more than zero; false or NULL elsewhere.

    For numbers this is a range test on the column itself, which reaches the
    Parquet scan: half a cent is the least amount that rounds to a cent, and half
    a cent above the largest decimal(10,2) no longer fits.
    """
    if isinstance(dtype, IntegralType):
        return (price >= 1) & (price <= 99_999_999)
    if isinstance(dtype, (DoubleType, FloatType)):
        return (price >= 0.005) & (price < 99_999_999.995)
    return parse_price(price, dtype) > 0


def cents(amount: Column) -> Column:
    """Whole cents of a decimal(10,2) as bigint."""
    return (amount * 100).cast("bigint")


def from_cents(whole: Column) -> Column:
    """Decimal(10,2) from whole cents, NULL if it does not fit."""
    return (whole * F.lit("0.01").cast("decimal(3,2)")).try_cast(MONEY_DDL)


def exact_total(price_num: Column) -> Column:
    """Aggregate: sum of a decimal(10,2) column in whole cents, a bigint.

    Sums of bigints are exact and do not depend on how the data are split.  A sum
    beyond 9.2e18 cents ends the job, with ANSI mode on or off: it never wraps.
    """
    return exact_sum(cents(price_num))


def exact_sum(whole: Column) -> Column:
    """Aggregate: sum of a bigint column that ends the job where it does not fit."""
    total = F.try_sum(whole)
    lost = total.isNull() & (F.count(whole) > 0)
    failure = F.raise_error(F.lit("a group's prices add up to more than a bigint of cents"))
    return F.when(lost, failure.cast("bigint")).otherwise(total)


def mean_of(total: Column, count: Column) -> Column:
    """Mean as decimal(10,2) of ``count`` prices of ``total`` cents: half-up to 6 places, then to 2."""
    share = F.try_divide(total.cast("decimal(19,0)"), count.cast("decimal(19,0)"))
    return from_cents(F.round(F.round(share, 4), 0))


def exact_mean(price_num: Column) -> Column:
    """Aggregate: mean of a decimal(10,2) column as decimal(10,2).

    Spark turns ``avg`` over short decimals into double arithmetic, whose last
    bits depend on the order of partial sums.  Whole cents in a bigint cost the
    same and stay exact.
    """
    return mean_of(exact_total(price_num), F.count(price_num))


def amount_deviation(price_num: Column, average: Column) -> Column:
    """Price minus average, decimal(10,2); both have 2 places, so nothing is rounded."""
    return (price_num - average).try_cast(MONEY_DDL)


#: Averages (in cents) below which one rounding gives the same percentage as two.
ONE_ROUNDING_BELOW = 1_000_000_000


def percent_deviation(price_num: Column, average: Column) -> Column:
    """Deviation in percent of the average, decimal(10,2); NULL if it does not fit.

    Defined on decimals: the quotient is rounded half-up to 13 places, the
    percentage to 2.  Long decimals leave the machine word and are slow, so the
    common case divides whole cents instead.  A quotient of cents that is no
    tie lies at least 1/(20000 * average) away from one, which below the bound
    is more than the first rounding moves it; hence both ways agree.
    """
    base = cents(average)
    gap = cents(price_num) - base
    half = F.when(gap < 0, -base).otherwise(base)
    # integer division drops the fraction, so half a unit is added away from zero
    in_cents = from_cents(F.call_function("div", gap * 20_000 + half, base * 2))
    share = F.try_divide(price_num - average, average)
    in_decimals = F.round(share * 100, 2).try_cast(MONEY_DDL)
    return F.when((base > 0) & (base < ONE_ROUNDING_BELOW), in_cents).otherwise(in_decimals)
