"""Ordered computations cut into blocks: windows run within blocks, and what a block needs of the others is one row of totals.

A group's blocks are bounded by the width of its values, not by its rows, so the totals stay
small: a chromosome has some thousands, whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = "__block"
SPANS = {"earlier": (Window.unboundedPreceding, -1), "later": (1, Window.unboundedFollowing), "all": (Window.unboundedPreceding, Window.unboundedFollowing)}


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", exact: tuple[str, ...] = ()) -> DataFrame:
    """left with right's other columns; null keys meet each other, but for those of exact."""
    r = right.withColumnsRenamed({k: f"__r_{k}" for k in (*keys, *exact)})
    on = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys] + [F.col(k) == F.col(f"__r_{k}") for k in exact]
    return left.join(r, reduce(lambda a, b: a & b, on), how).drop(*(f"__r_{k}" for k in (*keys, *exact)))


def carry(df: DataFrame, by: list[str], **wanted: tuple[Column, Callable[[Column], Column], str]) -> DataFrame:
    """df (with a block number) with a column for each (own, over, span): over, of own's per-block value, in the earlier, later or all blocks of its group. Null without any."""
    per = df.groupBy(*by, BLOCK).agg(*(own.alias(f"__own{name}") for name, (own, _, _) in wanted.items()))
    order = Window.partitionBy(*by).orderBy(BLOCK)
    totals = (over(F.col(f"__own{name}")).over(order.rowsBetween(*SPANS[span])).alias(name) for name, (_, over, span) in wanted.items())
    return join_null_safe(df, per.select(*by, BLOCK, *totals), [*by, BLOCK])


def within(by: list[str]):
    return Window.partitionBy(*by, BLOCK)


def by_width(df: DataFrame, column: str, width: int) -> DataFrame:
    return df.withColumn(BLOCK, F.floor(F.col(column) / width))


def numbered(df: DataFrame, group: str, column: str, width: int, order: list[str], name: str) -> DataFrame:
    """df with a dense number from 0 in the order of group, then order, whose first column is column.

    Ranks are taken within blocks of a group and moved by the counts before them: no task
    holds all rows, only a row of counts for each block.
    """
    cut = by_width(df, column, width)
    sizes = cut.groupBy(group, BLOCK).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy(group, BLOCK).rowsBetween(Window.unboundedPreceding, -1))
    moved = cut.join(sizes.select(group, BLOCK, F.coalesce(before, F.lit(0)).alias("__before")), [group, BLOCK])
    return moved.withColumn(name, (F.row_number().over(within([group]).orderBy(*order)) - 1 + F.col("__before")).cast("long")).drop("__before", BLOCK)
