"""Markdown lines to sections with heading paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LEVELS = 6


def markdown_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per line with its 1-based number, heading level (0: none) and heading; fenced code has no headings."""
    lines = docs.select(F.col(id_col).alias("doc"), F.posexplode(F.split(text_col, "\n")).alias("line_no", "line")).withColumn("line_no", F.col("line_no") + 1)
    running = Window.partitionBy("doc").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    fences = F.sum(F.when(F.col("line").rlike(r"^\s*(```|~~~)"), 1).otherwise(0)).over(running)
    marks = F.regexp_extract("line", r"^(#{1,6})\s+\S", 1)
    return lines.withColumn("level", F.when(fences % 2 == 0, F.length(marks)).otherwise(0)).withColumn("heading", F.when(F.col("level") > 0, F.trim(F.regexp_replace("line", r"^#+\s+|\s+#+\s*$", ""))))


def sections(lines: DataFrame) -> DataFrame:
    """Sections (doc, section, level, heading, heading_path, start_line, end_line, text); what precedes the first heading is section 0."""
    running = Window.partitionBy("doc").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    numbered = lines.withColumn("section", F.sum(F.when(F.col("level") > 0, 1).otherwise(0)).over(running))
    for k in range(1, LEVELS + 1):  # the last heading of level k that no shallower one has closed since
        opened = F.last(F.when(F.col("level") == k, F.struct("line_no", "heading")), ignorenulls=True).over(running)
        closed = F.last(F.when(F.col("level").between(1, k - 1), F.col("line_no")), ignorenulls=True).over(running) if k > 1 else F.lit(None).cast("int")
        numbered = numbered.withColumn(f"_o{k}", opened).withColumn(f"_c{k}", closed)
    path = F.array_compact(F.array(*(F.when((F.coalesce(F.col(f"_c{k}"), F.lit(0)) < F.col(f"_o{k}.line_no")), F.col(f"_o{k}.heading")) for k in range(1, LEVELS + 1))))
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    out = numbered.withColumn("_path", path).groupBy("doc", "section").agg(
        F.max("level").alias("level"), F.max("heading").alias("heading"), F.array_join(F.min_by("_path", "line_no"), " > ").alias("heading_path"),
        F.min("line_no").alias("start_line"), F.max("line_no").alias("end_line"), F.array_join(F.transform(ordered, lambda e: e["line"]), "\n").alias("text"),
    )
    return out


def gaps(spans: DataFrame, by: str, start: str, end: str) -> DataFrame:
    """Stretches between sections that none of them covers."""
    order = Window.partitionBy(by).orderBy(start, end)
    before = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return spans.withColumn("gap_start", F.coalesce(before, F.lit(0)) + 1).withColumn("gap_end", F.col(start) - 1).where("gap_start <= gap_end").select(by, "gap_start", "gap_end")
