"""Redaction, partial display, generalisation and noise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskloom.functions.digest import digest, hex_number
from maskloom.functions.words import FILLER

# The mask of a partly shown value and the width of the noise band.
PARTIAL_MASK = "****"
PARTIAL_KEEP = 4
BAND_RATIO = 0.15


def redact_text(value: Column) -> Column:
    """Filler words cut to the length of the value, at least one character. Loop-free."""
    length = F.greatest(F.length(value.cast("string")), F.lit(1))
    # length() of NULL is NULL but greatest() skips NULLs
    return F.when(value.isNotNull(), F.rpad(F.lit(""), length, F.lit(FILLER)))


def partial_keep_last4(value: Column) -> Column:
    """``****`` and the last four characters; values of up to four characters show nothing."""
    text = value.cast("string")
    return F.when(F.length(text) <= PARTIAL_KEEP, F.lit(PARTIAL_MASK)).otherwise(
        F.concat(F.lit(PARTIAL_MASK), F.right(text, F.lit(PARTIAL_KEEP)))
    )


def generalize_year(value: Column, dtype: T.DataType) -> Column:
    """January 1 of the same year, in the type of the column."""
    return F.make_date(F.year(value), F.lit(1), F.lit(1)).cast(dtype)


def numeric_band(
    value: Column, row_key: Column, column: str, dtype: T.DataType, ratio: float = BAND_RATIO, salt: str = ""
) -> Column:
    """Proportional noise in ``[-ratio, +ratio)``, fixed by the row key and the column name."""
    code = digest(F.concat(row_key.cast("string"), F.lit(":" + column)), "band:", salt)
    unit = hex_number(code, 1, 8) / F.lit(float(2**32))
    factor = F.lit(1.0) + F.lit(ratio) * (F.lit(2.0) * unit - F.lit(1.0))
    if isinstance(dtype, T.DecimalType):
        top = F.lit("9" * (dtype.precision - dtype.scale) + "." + "9" * dtype.scale).cast(dtype)
        wide = value.cast(T.DecimalType(min(38, dtype.precision + 2), dtype.scale)) * factor.cast("decimal(14,12)")
        # what would round to one digit too many, with room for a double's own error
        limit = (10.0 ** (dtype.precision - dtype.scale) - 0.5 * 10.0**-dtype.scale) * (1 - 1e-15)
        size = wide.cast("double")
        return F.when(size >= limit, top).when(size <= -limit, -top).otherwise(wide.cast(dtype))
    noisy = value.cast("double") * factor
    if isinstance(dtype, T.IntegralType):
        return _within(F.round(noisy), dtype)
    return noisy.cast(dtype)


def _within(noisy: Column, dtype: T.IntegralType) -> Column:
    """A rounded double as an integer type, at the type's limit where the noise goes beyond it."""
    bits = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32}.get(type(dtype), 64)
    # 2**63 - 1 is no double, so the limit itself is never cast from one
    return (
        F.when(noisy >= float(2 ** (bits - 1)), F.lit(2 ** (bits - 1) - 1).cast(dtype))
        .when(noisy < -float(2 ** (bits - 1)), F.lit(-(2 ** (bits - 1))).cast(dtype))
        .otherwise(noisy.cast(dtype))
    )
