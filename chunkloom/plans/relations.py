"""General relational queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import relational
from . import query, table



def _join(kind: str):
    def run(spark, d):
        c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
        o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
        return c.join(o, c.c_custkey == 2 * o.o_custkey, kind)  # so that either side has rows without a match

    return run


_LEFT, _RIGHT = "(SELECT c_custkey, c_mktsegment FROM customer)", "(SELECT o_orderkey, o_custkey FROM orders)"
for _name, _kind, _sql in (
    ("join_inner", "inner", f"SELECT * FROM {_LEFT} JOIN {_RIGHT} ON c_custkey = 2 * o_custkey"),
    ("join_left", "left", f"SELECT * FROM {_LEFT} LEFT JOIN {_RIGHT} ON c_custkey = 2 * o_custkey"),
    ("join_right", "right", f"SELECT * FROM {_LEFT} RIGHT JOIN {_RIGHT} ON c_custkey = 2 * o_custkey"),
    ("join_full", "full", f"SELECT * FROM {_LEFT} FULL JOIN {_RIGHT} ON c_custkey = 2 * o_custkey"),
    ("join_semi", "left_semi", f"SELECT * FROM {_LEFT} SEMI JOIN {_RIGHT} ON c_custkey = 2 * o_custkey"),
    ("join_anti", "left_anti", f"SELECT * FROM {_LEFT} ANTI JOIN {_RIGHT} ON c_custkey = 2 * o_custkey"),
):
    _f = _join(_kind)
    _f.__name__ = _name
    query(_sql)(_f)


@query("SELECT e.event_id, e.user_id, p.value AS last_value FROM (SELECT * FROM events WHERE event_type = 'click') e ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'purchase' GROUP BY ALL) p ON e.user_id = p.user_id AND e.ts >= p.ts")
def asof_join(spark, d):
    e = table(spark, d, "events")
    clicks = e.where("event_type = 'click'").select("event_id", "user_id", "ts")
    bought = e.where("event_type = 'purchase'").select("user_id", "ts", "value")
    return relational.asof_join(clicks, bought, "user_id", "ts", ["value"]).select("event_id", "user_id", F.col("value").alias("last_value"))


@query("SELECT o_orderkey, s_suppkey FROM (SELECT o_orderkey, o_totalprice FROM orders) JOIN (SELECT s_suppkey, s_suppkey * 3000.0 AS lo, s_suppkey * 3000.0 + 1500 AS hi FROM supplier) ON o_totalprice >= lo AND o_totalprice < hi")
def range_join(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    s = table(spark, d, "supplier").select("s_suppkey", (F.col("s_suppkey") * 3000.0).alias("lo"), (F.col("s_suppkey") * 3000.0 + 1500).alias("hi"))
    return relational.range_join(o, s, "o_totalprice", "lo", "hi", 2000.0).select("o_orderkey", "s_suppkey")


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty, round(avg(l_extendedprice), 4) AS price FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def rollup_pricing(spark, d):
    rows = table(spark, d, "lineitem").where("l_shipdate <= TIMESTAMP '1998-09-02'")
    return rows.rollup("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"), F.round(F.avg("l_extendedprice"), 4).alias("price"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def cube_orders(spark, d):
    return table(spark, d, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, rank() OVER w AS r, dense_rank() OVER w AS dr, ntile(4) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS q, lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderpriority)")
def window_ranks(spark, d):
    w, by_key = Window.partitionBy("o_custkey").orderBy("o_orderpriority"), Window.partitionBy("o_custkey").orderBy("o_orderkey")
    return table(spark, d, "orders").select("o_orderkey", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("dr"), F.ntile(4).over(by_key).alias("q"), F.lag("o_totalprice").over(by_key).alias("before"))


@query("SELECT c_nationkey::BIGINT AS k FROM customer INTERSECT ALL SELECT s_nationkey::BIGINT FROM supplier")
def set_intersect_all(spark, d):
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).intersectAll(table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")))


@query("SELECT c_nationkey::BIGINT AS k FROM customer EXCEPT ALL SELECT s_nationkey::BIGINT FROM supplier")
def set_except_all(spark, d):
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).exceptAll(table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")))


@query("SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name")
def nation_revenue(spark, d):
    t = lambda n: table(spark, d, n)
    joined = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))
