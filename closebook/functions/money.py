"""Amount expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def divide(amount: Column, rate: Column) -> Column:
    """NULL for a zero or missing rate, so that ANSI mode does not stop the job."""
    return F.try_divide(amount, rate)


def half_even(amount: Column) -> Column:
    """Whole units, ties to the even neighbour, on the exact double."""
    return F.rint(amount)


def half_even_where(whole: Column, amount: Column) -> Column:
    """Round only rows with the flag."""
    return F.when(whole, half_even(amount)).otherwise(amount)


def half_even_for(currency: Column, currencies: Iterable[str], amount: Column) -> Column:
    """Round only rows in the given currencies."""
    return half_even_where(member(currency, currencies), amount)


def member(value: Column, values: Iterable[str]) -> Column:
    """List membership; a null value is not a member."""
    return F.coalesce(value.isin(*values), F.lit(False))


def zero_if_null(amount: Column) -> Column:
    return F.coalesce(amount, F.lit(0.0))


def null_if_nan(amount: Column) -> Column:
    return F.when(~F.isnan(amount), amount)


#: Bits of one limb of a fraction; two limbs hold all that a double of 1 or more has below the point.
LIMB = 26


def exact_limbs(amount: Column) -> list[Column]:
    """A double as three whole numbers: units, and its fraction in two limbs of ``LIMB`` bits.

    Nothing is lost of amounts of 1 or more; of smaller ones what is below 2^-52 is cut off,
    for every row alike. Amounts reach 2^63.
    """
    units = F.floor(amount)
    scaled = (amount - units.cast("double")) * F.lit(2.0**LIMB)
    first = F.floor(scaled)
    return [units, first, F.floor((scaled - first.cast("double")) * F.lit(2.0**LIMB))]


def from_limbs(units: Column, first: Column, second: Column) -> Column:
    """The double nearest to sums of limbs: each carries into the one above, then all are added once."""
    base = F.lit(2**LIMB)
    first = first + F.floor(second / base)
    units = units + F.floor(first / base)
    return units.cast("double") + (
        F.pmod(first, base).cast("double") + F.pmod(second, base).cast("double") * F.lit(2.0**-LIMB)
    ) * F.lit(2.0**-LIMB)


def exact_sum(amount: Column) -> Column:
    """Sum of doubles that does not depend on the order of the rows; null if all are null.

    Whole numbers are added, so partial sums on any partitioning give the same bits. A group
    holds up to 2^37 rows; beyond, ANSI mode stops the job instead of a wrong result.
    """
    return from_limbs(*[F.sum(limb) for limb in exact_limbs(amount)])


def row_total(*amounts: Column) -> Column:
    """Sum across columns, missing parts counting as zero."""
    total = F.lit(0.0)
    for amount in amounts:
        total = total + zero_if_null(amount)
    return total


def trailing_minus(text: Column) -> Column:
    """``123.45-`` -> -123.45."""
    return F.regexp_replace(text, "^(.*)-$", "-$1").cast("double")


def point_text(text: Column) -> Column:
    """Decimal comma to point; an empty field is NULL."""
    return F.nullif(F.translate(text, ",", "."), F.lit(""))


def decimal_comma(text: Column) -> Column:
    """``1234,5`` -> 1234.5; an empty field and NaN are NULL."""
    return null_if_nan(point_text(text).cast("double"))


def plain_text(amount: Column) -> Column:
    """The shortest text that gives the same number, without an exponent; NaN is NULL.

    Spark writes a double as digits, or as digits, E and a power of ten; the
    power moves the point.
    """
    text = amount.cast("string")
    sign = F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    mantissa = F.substring_index(F.ltrim(text, F.lit("-")), "E", 1)
    power = F.coalesce(F.regexp_extract(text, "E(-?[0-9]+)$", 1).try_cast("int"), F.lit(0))
    whole = F.substring_index(mantissa, ".", 1)
    part = F.when(F.contains(mantissa, F.lit(".")), F.substring_index(mantissa, ".", -1)).otherwise(F.lit(""))
    digits, point = F.concat(whole, part), F.length(whole) + power
    zeros = F.repeat(F.lit("0"), F.greatest(-point, F.lit(0)))
    filled = F.concat(zeros, F.rpad(digits, F.greatest(F.length(digits), point), "0"))
    point = F.greatest(point, F.lit(0))
    left = F.when(point == 0, F.lit("0")).otherwise(F.substr(filled, F.lit(1), point))
    moved = F.concat(left, F.lit("."), F.substr(filled, point + 1))
    plain = F.regexp_replace(F.when(F.contains(text, F.lit("E")), moved).otherwise(mantissa), r"(\.[0-9]*?)0+$", "$1")
    return F.when(text != "NaN", F.concat(sign, F.regexp_replace(plain, r"\.$", "")))


def to_decimal_comma(amount: Column) -> Column:
    """``plain_text`` with a comma as the mark."""
    return F.translate(plain_text(amount), ".", ",")
