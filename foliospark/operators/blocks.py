"""Running values over long sequences, block by block, so that no task sorts a whole one.

A sequence (the rows of equal `by` columns, in the order of a whole number) is cut into blocks of `size` numbers. Windows
run inside blocks; what a block needs of those before it comes from one row per block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SIZE = 100_000
_BLOCK = "__block"


def _cut(df: DataFrame, order: str, size: int) -> DataFrame:
    return df.withColumn(_BLOCK, F.floor(F.col(order) / size).cast("long"))


def _met(df: DataFrame, blocks: DataFrame, by: list[str]) -> DataFrame:
    """Rows with what their block carries."""
    names = {c: f"__{c}_of" for c in (*by, _BLOCK)}
    right = blocks.withColumnsRenamed(names)
    on = F.lit(True)
    for c, n in names.items():
        on = on & F.col(c).eqNullSafe(F.col(n))
    return df.join(right, on, "left").drop(*names.values(), _BLOCK)


def lagged(df: DataFrame, by: list[str], order: str, columns: dict[str, str], size: int = SIZE) -> DataFrame:
    """df with the values of columns in the row before, under the names given; null in the first row."""
    cut = _cut(df, order, size)
    values = F.struct(*[F.col(c).alias(n) for c, n in columns.items()])
    last = cut.groupBy(*by, _BLOCK).agg(F.max_by(values, order).alias("__last"))
    last = last.withColumn("__before", F.lag("__last").over(Window.partitionBy(*by).orderBy(_BLOCK))).drop("__last")
    own = Window.partitionBy(*by, _BLOCK).orderBy(order)
    cut = cut.withColumn("__own", F.lag(values).over(own)).withColumn("__first", F.row_number().over(own) == 1)
    out = _met(cut, last, by).withColumn("__prev", F.when(F.col("__first"), F.col("__before")).otherwise(F.col("__own")))
    return out.select("*", *[F.col(f"__prev.{n}").alias(n) for n in columns.values()]).drop("__own", "__first", "__before", "__prev")


def running_sum(df: DataFrame, by: list[str], order: str, value: Column, into: str, size: int = SIZE) -> DataFrame:
    """df with the sum of a value over all rows up to each."""
    cut = _cut(df, order, size).withColumn("__v", value)
    sums = cut.groupBy(*by, _BLOCK).agg(F.sum("__v").alias("__sum"))
    before = Window.partitionBy(*by).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("__before", F.coalesce(F.sum("__sum").over(before), F.lit(0))).drop("__sum")
    own = Window.partitionBy(*by, _BLOCK).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = _met(cut.withColumn("__own", F.sum("__v").over(own)), sums, by)
    return out.withColumn(into, F.col("__own") + F.col("__before")).drop("__v", "__own", "__before")


def filled(df: DataFrame, by: list[str], order: str, value: str, into: str, size: int = SIZE) -> DataFrame:
    """df with the last value up to each row that isn't null."""
    cut = _cut(df, order, size)
    last = cut.groupBy(*by, _BLOCK).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("__last"))
    before = Window.partitionBy(*by).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    last = last.withColumn("__before", F.last_value("__last", True).over(before)).drop("__last")
    own = Window.partitionBy(*by, _BLOCK).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = _met(cut.withColumn("__own", F.last_value(value, True).over(own)), last, by)
    return out.withColumn(into, F.coalesce("__own", "__before")).drop("__own", "__before")


def numbered(df: DataFrame, by: list[str], order: str, ties: list, into: str, size: int = SIZE) -> DataFrame:
    """df with numbers from 1 by order, and then by ties; rows of one order number stand in one block."""
    cut = _cut(df, order, size)
    counts = cut.groupBy(*by, _BLOCK).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*by).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    own = F.row_number().over(Window.partitionBy(*by, _BLOCK).orderBy(order, *ties))
    out = _met(cut.withColumn("__own", own), counts, by)
    return out.withColumn(into, (F.col("__own") + F.col("__before")).cast("int")).drop("__own", "__before")
