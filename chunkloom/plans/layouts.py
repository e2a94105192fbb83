"""Queries on layout, over boxes made from the parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import layout
from . import query, table

BOXES = """SELECT p_partkey // 20 AS page, p_partkey AS id, CAST(p_partkey * 7 % 50 AS DOUBLE) AS x0, CAST(p_partkey * 13 % 300 AS DOUBLE) AS y0, CAST(p_partkey * 7 % 50 + 20 + p_size AS DOUBLE) AS x1, CAST(p_partkey * 13 % 300 + 10 + p_size AS DOUBLE) AS y1, p_partkey % 4 = 0 AS figure, p_name, p_size FROM part"""


def boxes(spark, d):
    k = F.col("p_partkey")
    x, y = k * 7 % 50, k * 13 % 300
    number = lambda c: c.cast("double")
    return table(spark, d, "part").select(
        F.floor(k / 20).alias("page"), k.alias("id"), number(x).alias("x0"), number(y).alias("y0"), number(x + 20 + F.col("p_size")).alias("x1"), number(y + 10 + F.col("p_size")).alias("y1"), (k % 4 == 0).alias("figure"), "p_name", "p_size",
    )


@query(
    f"""WITH b AS ({BOXES}) SELECT page, block, figure, fraction FROM (SELECT b.page, b.id AS block, f.id AS figure, round(greatest(0, least(b.x1, f.x1) - greatest(b.x0, f.x0)) * greatest(0, least(b.y1, f.y1) - greatest(b.y0, f.y0)) / ((b.x1 - b.x0) * (b.y1 - b.y0)), 6) AS fraction
FROM b JOIN b f ON b.page = f.page AND f.figure AND NOT b.figure) WHERE fraction > 0.25 QUALIFY row_number() OVER (PARTITION BY page, block ORDER BY figure) = 1"""
)
def overlap_fraction(spark, d):
    b = boxes(spark, d)
    return layout.figure_of(b.where("NOT figure"), b.where("figure"), ["page"])


@query(
    f"""WITH b AS ({BOXES}) SELECT b.page, b.id AS block, min(f.id) AS figure FROM b JOIN b f ON b.page = f.page AND f.figure AND NOT b.figure WHERE b.y0 - f.y1 >= 0 AND b.y0 - f.y1 < 80 AND greatest(0, least(b.x1, f.x1) - greatest(b.x0, f.x0)) > 0.25 * (b.x1 - b.x0) GROUP BY ALL"""
)
def caption_match(spark, d):
    b = boxes(spark, d)
    return layout.captions(b.where("NOT figure"), b.where("figure"), ["page"])


@query(f"WITH b AS ({BOXES}) SELECT page, id % 3 AS line, string_agg(p_name, ' ' ORDER BY id) AS text, round(avg(p_size), 6) AS mean_conf FROM b GROUP BY page, id % 3")
def ocr_lines(spark, d):
    b = boxes(spark, d).withColumn("line", F.col("id") % 3)
    return layout.ocr_lines(b, ["page", "line"], "id", "p_name", "p_size")


@query(
    f"""WITH RECURSIVE b AS (SELECT page, y0, id, row_number() OVER (PARTITION BY page ORDER BY y0, id) AS i FROM ({BOXES})),
f AS (SELECT page, id, i, [y0] AS tops, CAST(1 AS BIGINT) AS g FROM b WHERE i = 1 UNION ALL SELECT b.page, b.id, b.i, CASE WHEN abs(b.y0 - tops[len(tops) // 2 + 1]) <= 12 THEN list_append(tops, b.y0) ELSE [b.y0] END, CASE WHEN abs(b.y0 - tops[len(tops) // 2 + 1]) <= 12 THEN g ELSE g + 1 END FROM f JOIN b ON b.page = f.page AND b.i = f.i + 1)
SELECT page, id, g AS row FROM f"""
)
def row_clusters(spark, d):
    return layout.row_clusters(boxes(spark, d), "page", "y0", "id", 12.0)


@query(
    f"""SELECT page, col, string_agg(CASE WHEN p IS NULL THEN '' WHEN y0 - p > 50 THEN chr(10) || chr(10) ELSE chr(10) END || p_name, '' ORDER BY y0, id) AS text FROM (
SELECT *, id % 2 AS col, lag(y1) OVER (PARTITION BY page, id % 2 ORDER BY y0, id) AS p FROM ({BOXES})) GROUP BY page, col"""
)
def column_text(spark, d):
    b = boxes(spark, d).withColumn("col", F.col("id") % 2)
    return layout.column_text(b, ["page", "col"], "y0", "y1", "id", "p_name", 50.0)


@query(
    f"""SELECT page, id, CASE WHEN last THEN 1000 - sum(s) OVER (PARTITION BY page) + s ELSE s END::BIGINT AS ms FROM (SELECT page, id, CAST(round(1000.0 * p_size / sum(p_size) OVER (PARTITION BY page)) AS BIGINT) AS s, lead(1) OVER (PARTITION BY page ORDER BY id) IS NULL AS last FROM ({BOXES}))"""
)
def allocate_time(spark, d):
    return layout.allocate(boxes(spark, d).withColumn("total", F.lit(1000)), "page", "id", "p_size", "total", "ms").select("page", "id", "ms")
