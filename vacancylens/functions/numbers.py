"""Numeric column expressions."""

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_mean(*values: Column) -> Column:
    """Mean across columns of one row, skipping NULL and NaN; NULL if none is left."""
    present = [F.when(~F.isnan(v.cast("double")), v.cast("double")) for v in values]
    total = reduce(add, [F.coalesce(v, F.lit(0.0)) for v in present])
    count = reduce(add, [v.isNotNull().cast("int") for v in present])
    return total / F.nullif(count, F.lit(0))


def bin_start(value: Column, width: float) -> Column:
    """Left edge of the fixed-width bin a value falls into."""
    return F.floor(value / F.lit(width)) * F.lit(width)


#: Bins per power of two of :func:`magnitude_bin`; one bin spans about 0.27 %.
_BINS_PER_OCTAVE = 256
# Keeps the bins of every positive double above zero (the smallest is 2^-1074).
_BIN_OFFSET = 1100 * _BINS_PER_OCTAVE


def magnitude_bin(value: Column) -> Column:
    """An order-preserving bin number: ``a <= b`` implies ``bin(a) <= bin(b)``.

    Logarithmic, so the number of bins is bounded for any data without knowing
    the range of the values beforehand.
    """
    octaves = F.least(F.log2(F.abs(value)), F.lit(1025.0))  # infinity gets the top bin
    size = F.floor(octaves * _BINS_PER_OCTAVE).cast("int") + _BIN_OFFSET
    return F.when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0))
