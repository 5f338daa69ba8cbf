"""Scalar column functions (X1-X5, F4).  All are built-in Spark expressions, so they stay
inside whole-stage code generation; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results:
# a Dutch postcode is four digits, an optional blank and two capital letters; the first
# match in the text is the postcode, an address without one gives the empty string.
POSTCODE_PATTERN = r"(\d{4}\s?[A-Z]{2})"

# Amounts are added as decimals with ten decimals, so totals do not depend on partition order
# and no amount is rounded to cents before it is added.  A sum has room for 28 whole digits.
MONEY_TYPE = "decimal(28,10)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def percentage(part: Column | str, whole: Column | str, digits: int = 2) -> Column:
    """``round(100 * part / whole, digits)`` (X1, X2), half away from zero.

    A zero or null ``whole`` gives null rather than an error, also under ANSI mode, so a
    caller without calls has no rate (and fails any threshold on it).
    """
    hundred = F.lit(100).cast("bigint")  # int counts are widened before the product
    return F.round(F.try_divide(hundred * _col(part), _col(whole)), digits)


def exact_money(c: Column | str) -> Column:
    """An amount as a decimal, to ten decimals.

    NaN and infinities raise: they are no amounts, and leaving them out would change a total
    in silence.  So does an amount of 1e18 or more.
    """
    amount = _col(c).cast("double")
    odd = F.isnan(amount) | (F.abs(amount) >= F.lit(1e18))
    return F.when(odd, F.raise_error(F.concat(F.lit("not an amount: "), amount.cast("string")))).otherwise(
        _col(c).cast(MONEY_TYPE)
    )


def money_sum(c: Column | str) -> Column:
    """Exact sum of an amount; null when every input is null.  Round once, when it is shown."""
    return F.sum(exact_money(c))


def money_text(c: Column | str, digits: int = 2) -> Column:
    """Readable amount: thousands separators and ``digits`` decimals.

    Rounds half to even (0.125 -> ``0.12``); apply to exact decimals to avoid surprises.
    """
    return F.format_number(_col(c), digits)


def extract_pattern(c: Column | str, pattern: str, group: int = 1) -> Column:
    """First match of ``pattern`` in the text, capture ``group``.

    No match gives ``''``; a null text gives null.
    """
    return F.regexp_extract(_col(c), pattern, group)


def postcode(c: Column | str) -> Column:
    """The postcode inside an address (X4 with the fixed pattern)."""
    return extract_pattern(c, POSTCODE_PATTERN, 1)


def predicate(condition: Column | str) -> Column:
    """A row predicate given as a Column or as SQL text such as ``"sales_amount < 0"``."""
    return F.expr(condition) if isinstance(condition, str) else condition
