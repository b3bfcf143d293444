"""Shares, payments and the ranking index."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OBSERVATION_WEIGHT = 0.65
USAGE_WEIGHT = 0.35


def usage_share(usages: Column, total: Column, strict: bool = False) -> Column:
    """Part of the total; a zero total gives NULL, or an error in strict mode."""
    return usages / total if strict else F.try_divide(usages, total)


def pool_payment(pool: Column, share: Column) -> Column:
    return pool * share


def royalty(pool: Column, share: Column, amount: Column) -> Column:
    return pool * share + amount


def whole_units(usages: Column) -> Column:
    return F.ceil(usages).cast("long")


def artist_index(
    observations: Column,
    max_observations: Column,
    usages: Column,
    max_usages: Column,
    observation_weight: float = OBSERVATION_WEIGHT,
    usage_weight: float = USAGE_WEIGHT,
) -> Column:
    return (
        F.try_divide(observations, max_observations) * F.lit(observation_weight)
        + F.try_divide(usages, max_usages) * F.lit(usage_weight)
    )


def summable(value: Column, money_type: str = "double") -> Column:
    """The value in the type sums are done in.

    Doubles are fast but their sum depends on the order of the rows; a decimal
    such as ``decimal(28,6)`` gives the same digits on every run.
    """
    return value.cast(money_type)
