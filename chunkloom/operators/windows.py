"""Sliding and tumbling windows over tokens, characters, rows and gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clock

#: Windows of a text's block.
BLOCK_WINDOWS = 32


def window_starts(total: Column, width: int, overlap: int) -> Column:
    """0-based starts; the last window is the first that reaches the end. An empty text has one window."""
    if not 0 <= overlap < width:
        raise ValueError("overlap must be less than the width")
    step = width - overlap
    last = F.greatest(F.lit(0), F.ceil((total - width) / F.lit(step)).cast("int"))
    return F.transform(F.sequence(F.lit(0), last), lambda k: k * step)


def token_windows(df: DataFrame, tokens: str, width: int, overlap: int, keep: list[str]) -> DataFrame:
    """One row per window: window_index, token_start, token_end (exclusive), token_count, text. No shuffle."""
    total = F.size(tokens)
    out = df.select(*keep, F.col(tokens).alias("_t"), total.alias("_n"), F.posexplode(window_starts(total, width, overlap)).alias("window_index", "token_start"))
    end = F.least(F.col("token_start") + width, F.col("_n"))
    text = F.array_join(F.slice("_t", F.col("token_start") + 1, F.lit(width)), " ")
    return out.select(*keep, "window_index", "token_start", end.alias("token_end"), (end - F.col("token_start")).alias("token_count"), text.alias("text"))


def char_windows(df: DataFrame, text: str, budget: int, overlap_tokens: int, keep: list[str]) -> DataFrame:
    """Windows of a long line by its whole characters per token: at least 200 wide, stepping on by the rest of the
    overlap, to the text's end.

    A text is cut into blocks of ``BLOCK_WINDOWS`` of ``BLOCK_WINDOWS`` of ``BLOCK_WINDOWS`` windows, and these on into
    windows, inside its row, so that no copy of the whole text goes with each window, and a window is looked for from
    its block's start.
    """
    counted = df.select(*keep, F.col(text).alias("_x"), F.length(text).alias("_n"), F.size(F.filter(F.split(text, r"\s+"), lambda t: t != "")).alias("_t"))
    each = F.greatest(F.lit(1), F.floor(F.col("_n") / F.greatest(F.col("_t"), F.lit(1)))).cast("long")
    # no wider than the text, which then is one window: a long word's width exceeds an int
    width = F.least(F.greatest(F.lit(200), each * budget), F.greatest(F.lit(200), F.col("_n"))).cast("int")
    sized = counted.select(*keep, "_x", "_n", width.alias("_w"), F.greatest(F.lit(1), width - each * overlap_tokens).cast("int").alias("_s"))
    last = F.greatest(F.lit(0), F.ceil((F.col("_n") - F.col("_w")) / F.col("_s")).cast("int"))
    placed = sized.select(*keep, "_x", "_n", "_w", "_s", last.alias("_l"))

    def cut(held: Column, left: Column, size: int) -> Column:
        """The windows of a text whose last one is number ``left``, by way of blocks of ``size`` windows."""
        reach = F.least((size - 1) * F.col("_s").cast("long") + F.col("_w"), F.greatest(F.col("_n"), F.lit(1)).cast("long")).cast("int")
        parts = F.transform(F.sequence(F.lit(0), F.floor(left / size).cast("int")), lambda g: F.substr(held, g * size * F.col("_s") + 1, reach))
        if size == 1:
            return parts
        return F.flatten(F.transform(parts, lambda b, g: cut(b, F.least(F.lit(size - 1), left - g * size), size // BLOCK_WINDOWS)))

    return placed.select(*keep, F.posexplode(cut(F.col("_x"), F.col("_l"), BLOCK_WINDOWS**3)).alias("window_index", "text"))


def tumbling(number: Column, size: int) -> Column:
    """0-based group of 1-based numbers."""
    return F.floor((number - 1) / size).cast("long")


def islands(df: DataFrame, by: list[str], start: str, end: str, factor: float, tie: str | None = None) -> DataFrame:
    """Gaps and islands: a new island after a gap of more than ``factor`` times the median gap of its group."""
    order = Window.partitionBy(*by).orderBy(start, tie or end)
    gapped = df.withColumn("gap", F.col(start) - F.lag(end).over(order))
    median = F.expr("percentile(gap, 0.5)").over(Window.partitionBy(*by))
    jump = F.when(F.col("gap") > median * factor, 1).otherwise(0)
    return gapped.withColumn("_jump", jump).withColumn("island", F.sum("_jump").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_jump")


def segment_windows(segments: DataFrame, by: str, ordinal: str, text: str, start: str, end: str, width: int) -> DataFrame:
    """Token windows over timed segments; a token's time is interpolated in its segment, a window spans its tokens' times."""
    toks = F.filter(F.split(F.col(text), r"\s+"), lambda t: t != "")
    timed = F.transform(toks, lambda t, i: F.struct(t.alias("t"), (F.col(start) + (F.col(end) - F.col(start)) * (i + 0.5) / F.size(toks)).alias("s")))
    whole = segments.groupBy(by).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(F.col(ordinal).alias("o"), timed.alias("x")))), lambda e: e["x"])).alias("all"))
    overlap = max(1, round(0.1 * width))
    n = F.size("all")
    out = whole.select(by, "all", F.posexplode(window_starts(n, width, overlap)).alias("window_index", "token_start"))
    part = F.slice("all", F.col("token_start") + 1, F.lit(width))
    return out.select(by, "window_index", F.size(part).alias("token_count"), clock(F.element_at(part, 1)["s"]).alias("range_start"), clock(F.element_at(part, -1)["s"]).alias("range_end"))
