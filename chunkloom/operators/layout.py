"""Layout of blocks, captions, OCR tokens and rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.folds import fold

from ..functions.vectors import overlap, overlap_fraction


def figure_of(blocks: DataFrame, figures: DataFrame, page: list[str], least: float = 0.25) -> DataFrame:
    """Each block with the first figure of its page that covers more than ``least`` of it; both have x0..y1 and their id."""
    b = blocks.select(*page, F.col("id").alias("block"), *(F.col(c).alias(f"b_{c}") for c in ("x0", "y0", "x1", "y1")))
    f = figures.select(*page, F.col("id").alias("figure"), *(F.col(c).alias(f"f_{c}") for c in ("x0", "y0", "x1", "y1")))
    fraction = overlap_fraction(tuple(F.col(f"b_{c}") for c in ("x0", "y0", "x1", "y1")), tuple(F.col(f"f_{c}") for c in ("x0", "y0", "x1", "y1")))
    hit = b.join(f, page).withColumn("fraction", F.round(fraction, 6)).where(F.col("fraction") > least)
    first = F.row_number().over(Window.partitionBy(*page, "block").orderBy("figure"))
    return hit.withColumn("_r", first).where("_r = 1").select(*page, "block", "figure", "fraction")


def captions(blocks: DataFrame, figures: DataFrame, page: list[str], gap: float = 80.0, least: float = 0.25) -> DataFrame:
    """Blocks that begin less than ``gap`` below a figure and share more than ``least`` of their width with it."""
    b = blocks.select(*page, F.col("id").alias("block"), F.col("x0").alias("bx0"), F.col("x1").alias("bx1"), F.col("y0").alias("by0"))
    f = figures.select(*page, F.col("id").alias("figure"), F.col("x0").alias("fx0"), F.col("x1").alias("fx1"), F.col("y1").alias("fy1"))
    near = b.join(f, page).where((F.col("by0") >= F.col("fy1")) & (F.col("by0") - F.col("fy1") < gap))
    wide = near.where(overlap(F.col("bx0"), F.col("bx1"), F.col("fx0"), F.col("fx1")) > F.lit(least) * (F.col("bx1") - F.col("bx0")))
    return wide.groupBy(*page, "block").agg(F.min("figure").alias("figure"))


def ocr_lines(tokens: DataFrame, line: list[str], left: str, text: str, confidence: str) -> DataFrame:
    """Tokens of a line in order, joined, with their mean confidence."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(left).alias("l"), F.col(text).cast("string").alias("t"))))
    return tokens.groupBy(*line).agg(F.array_join(F.transform(ordered, lambda e: e["t"]), " ").alias("text"), F.round(F.avg(confidence), 6).alias("mean_conf"))


def row_clusters(items: DataFrame, by: str, top: str, tie: str, tolerance: float) -> DataFrame:
    """Items in order of ``top``; a new row begins where an item lies more than ``tolerance`` below the running median of its row."""
    def run(tops: np.ndarray) -> list:
        out, first, row = [], 0, 0
        for k, y in enumerate(tops.tolist()):
            # tops arrive in order, so the row's middle one is its median
            if not k or abs(y - tops[first + (k - first) // 2]) > tolerance:
                first, row = k, row + 1
            out.append(row)
        return out

    ordered = F.array_sort(F.collect_list(F.struct(F.col(top).cast("double").alias("top"), F.col(tie).alias("tie"))))
    folded = items.groupBy(by).agg(ordered.alias("o")).withColumn("g", fold(F.transform("o", lambda e: e["top"]), "array<int>", run, float))
    return folded.select(by, F.explode(F.arrays_zip("o", "g")).alias("z")).select(by, F.col("z.o.tie").alias(tie), F.col("z.g").alias("row"))


def column_text(blocks: DataFrame, column: list[str], y0: str, y1: str, tie: str, text: str, gap: float) -> DataFrame:
    """Blocks of a column from top to bottom; a paragraph breaks where the vertical gap exceeds ``gap``."""
    order = Window.partitionBy(*column).orderBy(y0, tie)
    gapped = blocks.withColumn("_lead", F.when(F.lag(y1).over(order).isNull(), "").when(F.col(y0) - F.lag(y1).over(order) > gap, "\n\n").otherwise("\n"))
    parts = F.array_sort(F.collect_list(F.struct(F.col(y0).alias("y"), F.col(tie).alias("t"), F.concat("_lead", text).alias("x"))))
    return gapped.groupBy(*column).agg(F.array_join(F.transform(parts, lambda e: e["x"]), "").alias("text"))


def allocate(df: DataFrame, by: str, order: str, weight: str, total: str, output: str) -> DataFrame:
    """A whole total shared out by weight, rounded, what rounding leaves going to the last row."""
    group, ordered = Window.partitionBy(by), Window.partitionBy(by).orderBy(order)
    share = F.round(F.col(total) * F.col(weight) / F.sum(weight).over(group)).cast("long")
    shared = df.withColumn("_s", share).withColumn("_last", F.lead(F.lit(1)).over(ordered).isNull())
    return shared.withColumn(output, F.when(F.col("_last"), F.col(total) - F.sum("_s").over(group) + F.col("_s")).otherwise(F.col("_s"))).drop("_s", "_last")
