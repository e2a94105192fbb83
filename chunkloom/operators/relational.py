"""Join helpers beyond Spark's own."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, by: str, on: str, values: list[str]) -> DataFrame:
    """Each left row with the values of the last right row of its key at or before its time: one union, one window.

    Of right rows at one time the one with the greatest values counts; left rows without any get nulls.
    """
    filled = [F.lit(None).cast(right.schema[v].dataType).alias(f"r_{v}") for v in values]
    a = left.select("*", *filled, F.lit(1).alias("_side"))
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in left.schema if f.name not in (by, on)]
    b = right.select(by, on, *rest, *(F.col(v).alias(f"r_{v}") for v in values), F.lit(0).alias("_side"))
    order = Window.partitionBy(by).orderBy(on, "_side", *(f"r_{v}" for v in values)).rowsBetween(Window.unboundedPreceding, 0)
    seen = F.last(F.when(F.col("_side") == 0, F.struct(*(f"r_{v}" for v in values))), ignorenulls=True).over(order)
    out = a.unionByName(b).withColumn("_m", seen).where("_side = 1")
    return out.select(*left.columns, *(F.col(f"_m.r_{v}").alias(v) for v in values))


def range_join(points: DataFrame, ranges: DataFrame, at: str, start: str, end: str, width: float) -> DataFrame:
    """Points inside half-open ranges: both are dealt by bins of ``width``, so it is an equi-join with a filter."""
    p = points.withColumn("_bin", F.floor(F.col(at) / width))
    r = ranges.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))
    return p.join(r, "_bin").where((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))).drop("_bin")
