"""Rounding of scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column, digits: int) -> Column:
    """Round by scaling: multiply, round to a whole number, divide.

    The built-in ``round`` works on the shortest decimal text of a double, so 1.005 becomes 1.01
    although the number stored is smaller. Scaling keeps to the stored number up to the error of
    one multiplication, which is how the scores were defined.
    """
    unit = float(10**digits)
    return F.round(value * F.lit(unit), 0) / F.lit(unit)


def exact_avg(value: Column) -> Column:
    """Average of scores and weights, summed in whole millionths: the same in any order of rows."""
    return F.sum(F.round(value * 1_000_000).cast("bigint")).cast("double") / F.count(value) / 1_000_000


#: What :func:`exact_avg` computes, as SQL with the value for ``{}``.
EXACT_AVG_SQL = "(cast(sum(cast(round({0} * 1000000) as bigint)) as double) / count({0}) / 1000000)"
