"""Bounded samples of labelled rows for fitting classifiers, and the folds that the queries fix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: str, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % of


def per_class(rows: DataFrame, label: str, bound: int, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """About ``bound`` rows of every class (all of a smaller one), chosen by a hash of ``keys`` against each class's count.

    Counting reads only ``label``; nothing is sorted and no class meets in one task."""
    counts = {r[0]: r[1] for r in rows.where(F.col(label).isNotNull()).groupBy(label).count().collect()}
    if not counts:
        return rows.where(F.lit(False))
    share = F.lit(0.0)
    for value, n in sorted(counts.items()):
        share = F.when(F.col(label) == value, F.lit(min(1.0, bound / n))).otherwise(share)
    place = F.pmod(F.xxhash64(*keys, F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    return rows.where(F.col(label).isNotNull() & (place < share))
