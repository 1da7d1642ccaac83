"""Expression builders.  All are compositions of built-in Spark expressions, so
they stay inside whole-stage codegen; none is a UDF.

Rounding and averaging go through decimals so that a result never depends on
the order in which rows reach an aggregate, and so that half-way cases round
the same way in Spark and in an independent SQL engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

# Decimal scales used for exact sums (money has cents, ratios 4 dp).
MONEY_SCALE = 6
RATIO_SCALE = 8
_EXACT_PRECISION = 38
# Above this magnitude a double has no fractional digits worth rounding, and a
# decimal(38, s) cast could overflow; plain round() is exact there.
_DECIMAL_SAFE_ABS = 1e20


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: Column | str, digits: int) -> Column:
    """Round a double half-up at ``digits`` through ``decimal(38, digits + 4)``."""
    c = _col(c)
    via_decimal = F.round(c.cast(f"decimal({_EXACT_PRECISION},{digits + 4})"), digits).cast("double")
    return F.when(F.abs(c) < F.lit(_DECIMAL_SAFE_ABS), via_decimal).otherwise(F.round(c, digits))


def as_exact(c: Column | str, scale: int = MONEY_SCALE) -> Column:
    """A double as a decimal; null if it is not finite or out of the decimal's range."""
    return _col(c).try_cast(f"decimal({_EXACT_PRECISION},{scale})")


def exact_sum(c: Column | str, scale: int = MONEY_SCALE) -> Column:
    """Order-independent sum of a double column, as a decimal."""
    return F.sum(as_exact(c, scale))


def exact_avg(c: Column | str, scale: int = MONEY_SCALE) -> Column:
    """Order-independent mean: decimal sum / count of the values summed, as double."""
    return F.try_divide(exact_sum(c, scale).cast("double"), F.count(as_exact(c, scale)).cast("double"))


def rounded_mean(name: str, digits: int) -> Column:
    """Finish a mean from the ``_{name}_sum`` (decimal) and ``_{name}_n`` columns of
    an aggregate (see ``group_profile``), rounded half-up at ``digits``."""
    mean = F.try_divide(F.col(f"_{name}_sum").cast("double"), F.col(f"_{name}_n").cast("double"))
    return round_half_up(mean, digits)


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """numerator / denominator as double; null (not an error) when the denominator is 0."""
    return _col(numerator).cast("double") / F.nullif(_col(denominator), F.lit(0.0))


def coerce(c: str, source_type: DataType, target: str) -> Column:
    """Bring a source column to ``target`` type.

    Text from outside goes through ``try_cast`` so a malformed value becomes null
    (and drops out through the filters) instead of failing the job under ANSI mode.
    """
    col = F.col(c)
    if isinstance(source_type, StringType) and target != "string":
        return col.try_cast(target)
    return col.cast(target)
