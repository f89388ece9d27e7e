"""Ordered outputs: global row numbers, running sums and top-N (O1, O2).

Every order here is total: the caller's keys followed by a key that is unique
per row, so results do not depend on partitioning and range boundaries can
split a hot value of the leading keys.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PID = "_kw_pid"
_MID = "_kw_mid"


def _tagged(df: DataFrame, order_by: Sequence[Column]) -> DataFrame:
    """Rows in order with their partition number and place within it,
    checkpointed so the tags survive a lost executor and cannot change between
    the jobs that use them. The range partitioning and sort are Spark's."""
    return (df.orderBy(*order_by)
            .withColumn(_PID, F.spark_partition_id())
            .withColumn(_MID, F.monotonically_increasing_id())
            .checkpoint(eager=True))


def _before(tagged: DataFrame, totals: dict[str, Column]) -> list[Column]:
    """Per row, the totals of all partitions before its own: one row per
    shuffle partition comes to the driver and goes back as a constant array
    indexed by partition number, so the rows are not shuffled again."""
    per = {r[_PID]: r for r in tagged.groupBy(_PID).agg(*[c.alias(n) for n, c in totals.items()]).collect()}
    out = []
    for n in totals:
        own = [(per[p][n] or 0) if p in per else 0 for p in range(max(per, default=0) + 1)]
        prior = [0, *itertools.accumulate(own[:-1])]
        out.append(F.get(F.array(*[F.lit(Decimal(v)).cast("decimal(28,0)") for v in prior]), F.col(_PID)).alias(n))
    return out


def global_row_number(df: DataFrame, order_by: Sequence[Column], name: str = "rank") -> DataFrame:
    """Number rows 1..n in a total order without a single-partition window:
    place within the partition plus the rows of all partitions before it."""
    tagged = _tagged(df, order_by)
    (before,) = _before(tagged, {"n": F.count(F.lit(1))})
    local = F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), 33)
    return tagged.select(*df.columns, (before.cast("long") + local + 1).alias(name))


def running_sums(df: DataFrame, order_by: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """``df`` with ``<column>_before``: the exact sum (decimal) of the column
    over all rows earlier in the total order. Sums within a partition are a
    window over that partition, sums of whole partitions before it an offset."""
    tagged = _tagged(df, order_by)
    before = _before(tagged, {c: F.sum(F.col(c).cast("decimal(28,0)")) for c in columns})
    earlier = Window.partitionBy(_PID).orderBy(_MID).rowsBetween(Window.unboundedPreceding, -1)
    inside = [F.coalesce(F.sum(F.col(c).cast("decimal(18,0)")).over(earlier), F.lit(0)) for c in columns]
    return tagged.select(*df.columns, *[(a + b).cast("decimal(28,0)").alias(f"{c}_before")
                                        for c, a, b in zip(columns, inside, before)])


def top_n(df: DataFrame, order_by: Sequence[Column], unique: Sequence[str], n: int, name: str = "rank") -> DataFrame:
    """O2: first ``n`` rows with their position, by the caller's keys and then
    the ``unique`` columns.

    ``orderBy().limit(n)`` plans as a distributed top-k: each task keeps its
    best ``n``, one task merges at most ``n`` x tasks rows. To number a large
    part of a table use ``global_row_number``, which gives the same positions
    in the same order."""
    keys = [*order_by, *[F.col(u).asc() for u in unique]]
    top = df.orderBy(*keys).limit(n)
    return top.withColumn(name, F.row_number().over(Window.orderBy(*keys)).cast("long"))
