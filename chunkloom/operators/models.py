"""Hooks for models: batched calls, pooling of model outputs, rerank scores, and a registry of parsers."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def apply_model(df: DataFrame, column: str, output: str, model: Callable[[list], list], returns: str, batch: int = 32, concurrency: int = 1) -> DataFrame:
    """A column of model outputs: ``model`` maps a list of ``batch`` inputs at most to as many outputs.

    Inputs are texts, lists of token ids or structs; up to ``concurrency`` calls of a task run at once. A model
    that returns another number of outputs fails the task.
    """

    def call(inputs: list) -> list:
        out = model(inputs)
        if len(out) != len(inputs):
            raise ValueError("the model returned another number of outputs")
        return list(out)

    @F.pandas_udf(returns)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with ThreadPoolExecutor(concurrency) as pool:
            for series in batches:
                values = series.to_dict("records") if isinstance(series, pd.DataFrame) else series.tolist()  # structs come as columns
                parts = pool.map(call, (values[k : k + batch] for k in range(0, len(values), batch)))
                yield pd.Series([x for part in parts for x in part], dtype=object)

    return df.withColumn(output, run(F.col(column)))


def mean_pooled(tokens: Column, mask: Column) -> Column:
    """Mean of the token vectors whose mask is 1, zero where none is; ``tokens`` is an array of vectors."""
    kept = F.transform(F.filter(F.arrays_zip(tokens.alias("v"), mask.alias("m")), lambda z: z["m"] == 1), lambda z: z["v"])
    zero = F.transform(F.get(tokens, F.lit(0)), lambda _: F.lit(0.0).cast("double"))
    total = F.aggregate(kept, zero, lambda a, v: F.zip_with(a, v, lambda x, y: x + y))
    return F.transform(total, lambda x: x / F.greatest(F.size(kept), F.lit(1)))


def pooled(outputs: dict[str, np.ndarray], mask: np.ndarray | None = None) -> np.ndarray:
    """One vector an input from a model's named outputs.

    Taken is the first output named for a pooled, sentence or cls vector, else the first matrix, else the first.
    Token vectors are averaged over the mask; other shapes are flattened.
    """
    named = [v for k, v in outputs.items() if any(part in k.lower() for part in ("pooled", "sentence", "cls"))]
    matrices = [v for v in outputs.values() if v.ndim == 2]
    chosen = [*named, *matrices, *outputs.values()][0]
    if chosen.ndim == 3:
        weights = np.ones(chosen.shape[:2]) if mask is None else np.asarray(mask, float)
        return (chosen * weights[:, :, None]).sum(1) / np.maximum(weights.sum(1, keepdims=True), 1e-9)
    return chosen.reshape(len(chosen), -1).astype(float)


def logit_score(logits: Column) -> Column:
    """A pair's score from a cross-encoder's logits: class 1 of two, the only one, else their mean."""
    mean = F.aggregate(logits, F.lit(0.0), lambda a, x: a + x) / F.size(logits)
    return F.when(F.size(logits) == 2, F.get(logits, F.lit(1))).when(F.size(logits) == 1, F.get(logits, F.lit(0))).otherwise(mean).cast("double")


def rerank(ranked: DataFrame, pairs: DataFrame, model: Callable[[list], list], k: int) -> DataFrame:
    """The best ``k`` of each query by a cross-encoder. ``pairs`` has query_id, id, query and text; the model maps
    (query, text) structs to logits."""
    from .retrieval import top_k

    both = ranked.join(pairs, ["query_id", "id"]).withColumn("pair", F.struct("query", "text"))
    scored = apply_model(both, "pair", "logits", model, "array<double>").withColumn("score", logit_score(F.col("logits")))
    return top_k(scored.select("query_id", "id", "score"), "query_id", "score", "id", k)


def clamped(requested: Column, default: int, most: int) -> Column:
    """A requested length within 1 and ``most``; the default where it is missing or no number."""
    return F.greatest(F.lit(1), F.least(F.coalesce(requested.try_cast("double").cast("int"), F.lit(default)), F.lit(most)))


def vector_in(response: str | None) -> list[float] | None:
    """The vector in a service's JSON answer: a vector, a list of them, or one under a usual or any name."""
    try:
        value = json.loads(response or "null")
    except ValueError:
        return None
    number = lambda x: isinstance(x, int | float) and not isinstance(x, bool)

    def first(x):
        if isinstance(x, list) and x:
            if isinstance(x[0], list):
                return x[0]
            if all(map(number, x)):
                return x
        return None

    if isinstance(value, dict):
        usual = ("embeddings", "data", "vectors", "vectors_list", "embedding", "vectors_array")
        found = [v for v in (first(value[k]) for k in usual if k in value) if v is not None]
        return [float(x) for x in (found or [v for v in map(first, value.values()) if v is not None] or [[]])[0]] or None
    found = first(value)
    return None if found is None else [float(x) for x in found]


def extracted_vector(response: Column) -> Column:
    @F.pandas_udf("array<double>")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([vector_in(x) for x in s], dtype=object)

    return run(response)


class Parsers:
    """A registry of parsers by name: functions from (path, content) rows to chunk rows of one schema."""

    def __init__(self):
        self.known: dict[str, Callable[[DataFrame], DataFrame]] = {}

    def register(self, name: str):
        def add(parse):
            self.known[name] = parse
            return parse

        return add

    def run(self, objects: DataFrame) -> tuple[DataFrame | None, DataFrame]:
        """Chunks of all objects whose parser is known, and (parser, parsed, skipped) counts."""
        out = None
        for name, parse in self.known.items():
            chunks = parse(objects.where(F.col("parser") == name))
            out = chunks if out is None else out.unionByName(chunks)
        known = F.col("parser").isin(*self.known) if self.known else F.lit(False)
        counts = objects.groupBy("parser").agg(F.count_if(F.coalesce(known, F.lit(False))).alias("parsed"), F.count_if(~F.coalesce(known, F.lit(False))).alias("skipped"))
        return out, counts
