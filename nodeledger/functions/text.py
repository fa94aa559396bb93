"""Number and label formatting as column expressions.

Numbers are first rounded to a millionth, so that a text does not depend on the order in which a
sum or mean was added up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


NOISE_DECIMALS = 6


def _decimal(number: Column, pattern: str) -> Column:
    """Rounded by the exact binary value of the number, unlike ``format_string``."""
    return F.call_function("format_number", number, F.lit(pattern))


def format_quantity(value: Column) -> Column:
    """Commas and two decimals from 1 up, four decimals below, ``N/A`` for missing."""
    number = F.round(value.cast("double"), NOISE_DECIMALS)
    return (
        F.when(number.isNull() | F.isnan(number), F.lit("N/A"))
        .when(F.abs(number) >= 1, F.format_number(number, 2))
        .otherwise(_decimal(number, "0.0000"))
    )


def format_duration(seconds: Column) -> Column:
    """``Xh Ym Zs`` with the fraction of a second dropped, ``N/A`` for missing."""
    number = F.round(seconds.cast("double"), NOISE_DECIMALS)
    whole = F.floor(number)
    parts = F.format_string(
        "%dh %dm %ds", F.floor(whole / 3600), F.floor((whole % 3600) / 60), whole % 60
    )
    return F.when(number.isNull() | F.isnan(number), F.lit("N/A")).otherwise(parts)


def format_percent(ratio: Column) -> Column:
    """A ratio as a percentage with two decimals; ``nan%`` for missing."""
    return F.when(ratio.isNull(), F.lit("nan%")).otherwise(F.concat(format_hundredths(ratio * 100), F.lit("%")))


def format_hundredths(number: Column) -> Column:
    return _decimal(F.round(number, NOISE_DECIMALS), "0.00")


def format_count(n: Column) -> Column:
    return F.format_number(n, 0)
