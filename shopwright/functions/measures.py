"""Reusable measures (K-39): the KPI dictionary's contracts as ``Column``
aggregates, so every KPI computes "AOV" or "freight %" the same way.

Means of money are ``sum / count`` in double (the sum is an exact decimal),
and ratios are ratios of sums, never means of ratios.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import pct, ratio, round_half_up


def money_sum(c: str) -> Column:
    return F.round(F.sum(c), 2).cast("double")


def mean(c: str | Column, scale: int = 2) -> Column:
    """ROUND(AVG(c), scale): exact sum over non-null count."""
    c = F.col(c) if isinstance(c, str) else c
    return ratio(F.sum(c), F.count(c), scale)


def count_if(cond: Column) -> Column:
    return F.count_if(cond).cast("long")


def month_rows(fim: DataFrame, cond: Column | None = None) -> Column:
    """Monthly rows of inventory that meet ``cond``: of monthly rows their
    number, of spans (D-17) the ``months`` that they stand for."""
    n = F.col("months") if "months" in fim.columns else F.lit(1)
    return F.coalesce(F.sum(n if cond is None else F.when(cond, n)), F.lit(0)).cast("long")


def rate(cond: Column, base: Column | None = None) -> Column:
    """Share in percent of rows meeting ``cond`` among rows meeting ``base``."""
    if base is None:
        return pct(F.count_if(cond), F.count(F.lit(1)))
    return pct(F.count_if(base & cond), F.count_if(base))


def delivered_merchandise() -> Column:
    return money_sum("merchandise_value").alias("merchandise_value")


def delivered_freight() -> Column:
    return money_sum("freight_value").alias("freight_value")


def delivered_gross() -> Column:
    return money_sum("gross_order_value").alias("gross_order_value")


def average_order_value() -> Column:
    return mean("gross_order_value").alias("average_order_value")


def items_per_order() -> Column:
    return mean("item_count").alias("average_items_per_order")


def freight_pct() -> Column:
    return pct(F.sum("freight_value"), F.sum("gross_order_value")).alias("freight_pct")


MEASURES = {
    "delivered_orders": lambda: F.count(F.lit(1)).alias("delivered_orders"),
    "merchandise_value": delivered_merchandise,
    "freight_value": delivered_freight,
    "gross_order_value": delivered_gross,
    "average_order_value": average_order_value,
    "average_items_per_order": items_per_order,
    "freight_pct": freight_pct,
}

__all__ = ["MEASURES", "count_if", "mean", "money_sum", "rate", "round_half_up"]
