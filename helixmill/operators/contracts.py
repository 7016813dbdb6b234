"""Contracts: tables of violations that must be empty. What is malformed raises, it isn't dropped."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ContractError(ValueError):
    """Input breaks a contract; the message shows some of the rows."""


def assert_empty(df: DataFrame, message: str) -> None:
    """Raises with up to five distinct rows of df."""
    if rows := df.distinct().limit(5).collect():
        raise ContractError(f"{message}: {[r.asDict() for r in rows]}")


def require_columns(df: DataFrame, names: list[str], prefix: bool = False) -> DataFrame:
    if missing := [n for n in names if n not in df.columns]:
        raise ContractError(f"missing columns: {missing}")
    if prefix and df.columns[: len(names)] != names:
        raise ContractError(f"the header must begin with {names}")
    return df


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows of df that break a rule, with the names of all it breaks. A null condition is broken."""
    broken = F.filter(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())), lambda x: x.isNotNull())
    return df.withColumn("broken", F.array_join(F.array_sort(broken), ",")).where("broken <> ''")


def loop_geometry(width: int, lower: int, upper: int, size: Column) -> dict[str, Column]:
    c = F.col
    return {
        "cis": c("chrom1") == c("chrom2"), "width1": c("end1") - c("start1") == width, "width2": c("end2") - c("start2") == width,
        "grid": (c("start1") % width == 0) & (c("start2") % width == 0), "order": c("start1") < c("start2"),
        "distance": (c("start2") - c("start1")).between(lower, upper), "inside": (c("start1") >= 0) & (c("end2") <= size),
    }


def duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that are in one table only, with the side; empty if both hold the same rows as often."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def count_by(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row: how often each condition holds, and all rows as input."""
    return df.agg(F.count("*").alias("input"), *(F.count_if(c).alias(n) for n, c in conditions.items()))


def conserved(audit: DataFrame, whole: str, parts: list[str]) -> DataFrame:
    """Audit rows whose parts don't add up."""
    return audit.where(F.col(whole) != reduce(lambda x, y: x + y, (F.col(p) for p in parts)))


def one_to_one(left: DataFrame, right: DataFrame, key: list[str], how: str = "left") -> DataFrame:
    for df, name in ((left, "left"), (right, "right")):
        assert_empty(duplicates(df, key), f"{name} side repeats a key")
    return left.join(right, key, how)
