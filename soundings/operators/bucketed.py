"""Order-dependent columns without one long sort for each track.

Rows are sorted in buckets of (key, time bucket); what crosses a bucket's border is carried by one row for each bucket,
a table smaller by the rows in a bucket. One long track so spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

DAY_US = 86_400_000_000


def with_bucket(df: DataFrame, time: str, width: int = DAY_US, name: str = "_b") -> DataFrame:
    return df.withColumn(name, F.floor(F.col(time) / width))


def nearest_known(df: DataFrame, by: Sequence[str], order: Sequence[str], value: Column, name: str, forward: bool = False, inclusive: bool = True) -> DataFrame:
    """``name``: the last non-NULL ``value`` at or before each row (``forward``: the first at or after). ``df`` has buckets."""
    w = Window.partitionBy(*by, "_b").orderBy(*order)
    edge = 0 if inclusive else (1 if forward else -1)
    frame = w.rowsBetween(edge, Window.unboundedFollowing) if forward else w.rowsBetween(Window.unboundedPreceding, edge)
    own = df.withColumn("__here", (F.first(value, True) if forward else F.last(value, True)).over(frame))
    place = F.when(value.isNotNull(), F.struct(*order))
    per = df.groupBy(*by, "_b").agg((F.min_by if forward else F.max_by)(value, place).alias("__v"))
    wb = Window.partitionBy(*by).orderBy("_b")
    if forward:
        carry = per.select(*by, "_b", F.first("__v", True).over(wb.rowsBetween(1, Window.unboundedFollowing)).alias("__carry"))
    else:
        carry = per.select(*by, "_b", F.last("__v", True).over(wb.rowsBetween(Window.unboundedPreceding, -1)).alias("__carry"))
    return own.join(carry, [*by, "_b"], "left").withColumn(name, F.coalesce("__here", "__carry")).drop("__here", "__carry")


def running_sum(df: DataFrame, by: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """``name``: the sum of ``value`` over all rows up to each row. ``df`` has buckets."""
    return running_sums(df, by, order, {name: value})


def running_sums(df: DataFrame, by: Sequence[str], order: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """A sum of each value over all rows up to each row, by its name; one pass for all. ``df`` has buckets."""
    w = Window.partitionBy(*by, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    carried = [f"__carry{i}" for i in range(len(values))]
    per = df.groupBy(*by, "_b").agg(*[F.sum(v).alias(c) for c, v in zip(carried, values.values(), strict=True)])
    wb = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    before = per.select(*by, "_b", *[F.sum(c).over(wb).alias(c) for c in carried])
    own = df.withColumns({f"__here{i}": F.sum(v).over(w) for i, v in enumerate(values.values())}).join(before, [*by, "_b"], "left")
    own = own.withColumns({name: F.coalesce(f"__here{i}", F.lit(0)) + F.coalesce(f"__carry{i}", F.lit(0)) for i, name in enumerate(values)})
    return own.drop(*carried, *[f"__here{i}" for i in range(len(values))])


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str, width: int = DAY_US) -> DataFrame:
    """``name``: the place of each row, from 0, in the order of its key; the first of ``order`` is a number that buckets are cut from."""
    own = running_sum(with_bucket(df, order[0], width), by, order, F.lit(1).cast("long"), name)
    return own.withColumn(name, F.col(name) - 1).drop("_b")


def in_blocks(df: DataFrame, place: str, reach: int, block: int = 4096) -> DataFrame:
    """Rows dealt by their place (from 0) to ``_block`` s of even size, those within ``reach`` of others' blocks to these too; ``_mine`` is TRUE in a row's own block."""
    near = F.sequence(F.floor(F.greatest(F.col(place) - reach, F.lit(0)) / block), F.floor((F.col(place) + reach) / block))
    return df.withColumn("_block", F.explode(near)).withColumn("_mine", F.col("_block") == F.floor(F.col(place) / block))


def in_frames(df: DataFrame, by: Sequence[str], order: str, reach: int, columns: dict[str, Callable[[WindowSpec], Column]], block: int = 4096, width: int = DAY_US) -> DataFrame:
    """Columns over frames of rows around each row in the order of its key, worked out block by block: a long series spreads over many tasks.

    ``columns`` make an expression from an ordered window without a frame; it may look ``reach`` rows either way. ``order`` is a number that
    buckets of ``width`` are cut from. ``_at``, the row's place in its series, is there for them and stays."""
    own = in_blocks(numbered(df, by, [order], "_at", width), "_at", reach, block)
    w = Window.partitionBy(*by, "_block").orderBy("_at")
    return own.withColumns({name: make(w) for name, make in columns.items()}).where("_mine").drop("_block", "_mine")


def by_runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], each: Callable[[pd.DataFrame], pd.DataFrame | None], schema: str, tasks: int | None = None) -> DataFrame:
    """``each`` applied to the rows of every key in ``order``; a task holds one Arrow batch and the key that goes on into the next. ``tasks``: a number that AQE leaves as it is, for work that is long beside its bytes.

    For many small groups: one exchange and one pass of Python over a partition, where a grouped map costs an Arrow stream for each group."""

    def one_by_one(rows: pd.DataFrame, first: np.ndarray) -> pd.DataFrame | None:
        parts = [each(rows.iloc[a:z]) for a, z in zip(first, np.append(first[1:], len(rows)), strict=True)]
        parts = [p for p in parts if p is not None and len(p)]
        return pd.concat(parts) if parts else None

    return by_batches(df, keys, order, one_by_one, schema, tasks)


def by_batches(df: DataFrame, keys: Sequence[str], order: Sequence[str], each: Callable[[pd.DataFrame, np.ndarray], pd.DataFrame | None], schema: str, tasks: int | None = None) -> DataFrame:
    """As ``by_runs``, but ``each`` takes the rows of many whole keys at once and where each key's begin, for work that goes over all keys as arrays: a frame for each of millions of keys costs a millisecond each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None

        def done(rows: pd.DataFrame, to: int) -> Iterator[pd.DataFrame]:
            if to:
                head = rows.iloc[:to].reset_index(drop=True)
                out = each(head, np.flatnonzero(_changes(head, keys)))
                if out is not None and len(out):
                    yield out

        for batch in batches:
            rest = batch if rest is None or not len(rest) else pd.concat([rest, batch], ignore_index=True)
            last = np.flatnonzero(_changes(rest, keys))
            if len(last) > 1:
                yield from done(rest, int(last[-1]))
                rest = rest.iloc[int(last[-1]) :]
        if rest is not None:
            yield from done(rest, len(rest))

    return df.repartition(*([tasks] if tasks else []), *keys).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)


def _changes(rows: pd.DataFrame, keys: Sequence[str]) -> np.ndarray:
    """Where a row's key differs from that of the row before; NULL equals NULL."""
    out = np.zeros(len(rows), bool)
    out[:1] = True
    for k in keys:
        v = rows[k]
        before = v.shift()
        out |= ((v != before) & ~(v.isna() & before.isna())).to_numpy()
    return out
