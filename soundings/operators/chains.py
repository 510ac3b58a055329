"""Chains of rows by jump pointers: each row points to a later one of its track, and chains are followed by doubling.

No track sits in one task: a pointer is a row, pointers of twice the length are a join of the table with itself, and the rows of a chain are
found from the longest pointers down, each round a written table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .bucketed import DAY_US, nearest_known, with_bucket


def first_at_least_later(rows: DataFrame, interval: int, by: Sequence[str], time: str, place: str, bucket: int = DAY_US) -> DataFrame:
    """``by``, ``place`` and ``next``: the place of the first row whose time is ``interval`` or more after each row's; rows without any are left out."""
    asked = rows.select(*by, (F.col(time) + interval).alias("_t"), F.lit(0).alias("_kind"), F.col(place).alias("_i"))
    there = rows.select(*by, F.col(time).alias("_t"), F.lit(1).alias("_kind"), F.col(place).alias("_i"))
    both = with_bucket(asked.unionByName(there), "_t", bucket)
    found = nearest_known(both, by, ["_t", "_kind", "_i"], F.when(F.col("_kind") == 1, F.col("_i")), "next", forward=True)
    return found.where("_kind = 0 and next is not null").select(*by, F.col("_i").alias(place), "next")


def chain(pointers: DataFrame, starts: DataFrame, by: Sequence[str], place: str) -> DataFrame:
    """``by`` and ``place`` of all rows that are reached from ``starts`` (``by``, ``place``) by following ``next`` any number of times, the starts among them.

    The k-th table holds pointers of 2^k steps. A row of a chain is so many steps from its start as its number says in binary, so adding
    the steps of one table after the other, longest first, reaches each row once."""
    tables = [staged(pointers.select(*by, place, "next"), "pointers")]
    while True:
        last = tables[-1]
        ahead = last.select(*by, F.col(place).alias("next"), F.col("next").alias("_then"))
        longer = staged(last.join(ahead, [*by, "next"]).select(*by, place, F.col("_then").alias("next")), "pointers")
        if longer.isEmpty():
            break
        tables.append(longer)
    reached = starts.select(*by, place)
    for table in reversed(tables):
        reached = staged(reached.unionByName(reached.join(table, [*by, place]).select(*by, F.col("next").alias(place))), "reached")
    return reached
