"""Text-to-number rules that plain casts do not cover."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed pattern: unsigned decimal, at most one dot, ASCII digits.
PLAIN_DECIMAL = r"^(\d+\.?\d*|\.\d+)$"

# Fixed pattern: what a general-purpose float parser reads (sign, underscores, exponent).
_DIGITS = r"\d+(_\d+)*"
GENERAL_FLOAT = (
    rf"(?i)^[+-]?(({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})(e[+-]?{_DIGITS})?|nan|inf(inity)?)$"
)


def finite_or_null(value: Column) -> Column:
    """NaN becomes NULL: Spark orders NaN above every number, so thresholds would fire on it."""
    return F.when(~F.isnan(value), value)


def plain_decimal(text: Column) -> Column:
    """Unsigned decimal text as double; everything else NULL."""
    return F.when(text.rlike(PLAIN_DECIMAL), text.try_cast("double"))


def general_float(text: Column) -> Column:
    """Text as double by the wider float syntax; rejects suffixes such as ``12d``."""

    trimmed = F.trim(text)
    # The cast knows all of these words but a NaN with a sign.
    read = F.coalesce(F.replace(trimmed, F.lit("_"), F.lit("")).try_cast("double"), F.lit(float("nan")))
    return F.when(trimmed.rlike(GENERAL_FLOAT), read)
