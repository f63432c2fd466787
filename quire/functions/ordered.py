"""Ordered computations within a key of any size.

A key may hold a third of all rows, so no window runs over a whole key.  Rows
are put into cells of the order column; a window runs over each cell, and a
second one over the cells' summaries, of which there are a few thousandth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Values of the order column in one cell.
CELL = 4096


def cell(order: str) -> Column:
    """The cell of a value of the order column."""
    return F.coalesce(F.floor(F.col(order) / CELL), F.lit(-1)).cast("long")


def _cells(df: DataFrame, order: str) -> DataFrame:
    return df.withColumn("_cell", cell(order))


def with_previous(df: DataFrame, key: str, order: str, columns: dict[str, str]) -> DataFrame:
    """``df`` with the values of the row before: ``columns`` maps new names to columns.

    As lag() over the key; ``order`` has to be unique within the key and not null.
    """
    d = _cells(df, order)
    w = Window.partitionBy(key, "_cell").orderBy(order)
    row = F.struct(*[F.col(c).alias(n) for n, c in columns.items()])
    d = d.withColumn("_prev", F.lag(row).over(w)).withColumn("_first", F.row_number().over(w) == 1)
    ends = d.groupBy(key, "_cell").agg(F.max_by(row, order).alias("_end"))
    before = ends.select(key, "_cell", F.lag("_end").over(Window.partitionBy(key).orderBy("_cell")).alias("_before"))
    d = d.join(before, [key, "_cell"])
    prev = F.when(F.col("_first"), F.col("_before")).otherwise(F.col("_prev"))
    return d.withColumns({n: prev[n] for n in columns}).drop("_cell", "_prev", "_first", "_before")


def with_running_sum(df: DataFrame, key: str, order: str, value: str, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` up to and with each row; null orders come first.

    ``order`` has to be unique within the key.
    """
    d = _cells(df, order)
    w = Window.partitionBy(key, "_cell").orderBy(F.col(order).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    sums = d.groupBy(key, "_cell").agg(F.sum(value).alias("_s"))
    start = sums.select(key, "_cell", (F.sum("_s").over(Window.partitionBy(key).orderBy("_cell")) - F.col("_s")).alias("_start"))
    return d.withColumn(name, F.sum(value).over(w)).join(start, [key, "_cell"]).withColumn(name, F.col(name) + F.col("_start")).drop("_cell", "_start")
