"""Price expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slab_price(
    weight: Column, upper: Column, amount: Column, step: Column, step_amount: Column, lower: Column | None = None
) -> Column:
    """Slab amount inside the slab, otherwise the amount plus a charge per step above its upper limit."""
    inside = weight <= upper if lower is None else (weight >= lower) & (weight <= upper)
    beyond = (F.ceil(weight.cast("double")) - upper) * F.try_divide(step_amount, step)
    return F.when(inside, amount).otherwise(amount + beyond)


def gain(percent: Column) -> Column:
    """The part of a percentage above zero; a missing one counts as zero."""
    return F.greatest(F.lit(0.0), percent)


def loss(percent: Column) -> Column:
    """The part of a percentage below zero; a missing one counts as zero."""
    return F.least(F.lit(0.0), percent)


#: Parts of one unit of money or weight that sums tell apart.
PARTS = 1_000_000


def exact_sum(amount: Column) -> Column:
    """Aggregate: the sum of amounts as whole millionths, and one division at the end.

    Sums of doubles depend on the order in which rows and partial sums meet, which is another one on every run; whole
    numbers add up to the same in any order. Totals are bounded by 9 * 10^12; beyond that Spark reports an overflow.
    """
    return F.sum(F.rint(amount * PARTS).cast("long")) / F.lit(float(PARTS))
