"""Candidate assembly and fusion of ranked lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Default weights of the four signals.
WEIGHTS = {"vec": 0.40, "bm25": 0.25, "graph": 0.20, "gear": 0.15}


def assemble(signals: dict[str, DataFrame], by: str = "query_id", key: str = "id") -> DataFrame:
    """One row per query and key with a column for each signal; union and one aggregate instead of outer joins."""
    parts = [df.select(by, key, *(F.col("score").cast("double").alias(s) if s == name else F.lit(None).cast("double").alias(s) for s in signals)) for name, df in signals.items()]
    return reduce(DataFrame.unionByName, parts).groupBy(by, key).agg(*(F.max(s).alias(s) for s in signals))


def minmax(value: Column, by: str) -> Column:
    """Min-max over the group, missing as 0; equal values all become 1."""
    v = F.coalesce(value, F.lit(0.0))
    over = Window.partitionBy(by)
    low, high = F.min(v).over(over), F.max(v).over(over)
    return F.when(high <= low + 1e-12, 1.0).otherwise((v - low) / (high - low))


def fuse(candidates: DataFrame, weights: dict[str, float] = WEIGHTS, by: str = "query_id") -> DataFrame:
    total = reduce(lambda a, b: a + b, (minmax(F.col(s), by) * w for s, w in weights.items()))
    return candidates.withColumn("final_score", F.round(total, 6))


def provenance(signals: list[str]) -> Column:
    return F.struct(*signals)


def hybrid(vec: DataFrame, lex: DataFrame, vec_weight: float = 0.7, lex_weight: float = 0.3) -> DataFrame:
    """Weighted sum of two lists by query and key, positive scores only."""
    both = assemble({"vec": vec, "lex": lex})
    score = F.coalesce("vec", F.lit(0.0)) * vec_weight + F.coalesce("lex", F.lit(0.0)) * lex_weight
    return both.withColumn("score", F.round(score, 7)).where("score > 0")


def rrf(lists: dict[str, tuple[DataFrame, float]], k: int, by: str = "query_id", key: str = "id") -> DataFrame:
    """Weighted reciprocal-rank fusion; ties rank by key."""
    parts = []
    for df, weight in lists.values():
        rank = F.row_number().over(Window.partitionBy(by).orderBy(F.col("score").desc(), key))
        parts.append(df.select(by, key, (F.lit(weight) / (F.lit(k) + rank)).alias("s")))
    return reduce(DataFrame.unionByName, parts).groupBy(by, key).agg(F.round(F.sum("s"), 6).alias("score"))


def rerank_blend(ranked: DataFrame, rerank: Column, share: float = 0.5) -> DataFrame:
    return ranked.withColumn("score", F.round(F.col("score") * (1 - share) + rerank * share, 7))
