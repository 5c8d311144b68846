"""Deduplication by key: first wins, insert if absent, anti-membership."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window, functions as F

#: Columns that identify an entry.
ENTRY_KEY = ["command_name", "objective", "command", "question", "chain_of_thought"]


def first_wins(df: DataFrame, key: list[str], order: str) -> DataFrame:
    """The row of lowest order for each key; nulls are equal. Rows are shuffled once by the true key; rows that can't win are dropped within each partition before."""
    first = Window.partitionBy(*key).orderBy(order)
    return df.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")


def null_safe(a: DataFrame, b: DataFrame, key: list[str]):
    return reduce(and_, (a[c].eqNullSafe(b[c]) for c in key))


def unseen(df: DataFrame, seen: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key isn't among the seen ones."""
    s = seen.select(*(F.col(c).alias(f"__{c}") for c in key)).distinct()
    return df.join(s, reduce(and_, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in key)), "left_anti")


def insert_if_absent(base: DataFrame, new: DataFrame, key: list[str], order: str) -> DataFrame:
    """base and the first of each new key, with the column inserted."""
    fresh = first_wins(unseen(new, base, key), key, order).withColumn("inserted", F.lit(True))
    return base.withColumn("inserted", F.lit(False)).unionByName(fresh)
