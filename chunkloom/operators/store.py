"""What a document store does to rows: schema-driven projection, metadata filters, positional and key joins, pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .index import coerce_array, coerce_bool, coerce_double, coerce_long

# Base types of a store by Spark type.
BASES = {"string": "text", "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "float": "number", "double": "number", "timestamp": "date", "date": "date", "boolean": "bool"}


def schema_of(df: DataFrame) -> dict[str, tuple[str, bool]]:
    """(base type, is array) of each column."""
    out = {}
    for f in df.schema:
        array = isinstance(f.dataType, T.ArrayType)
        kind = (f.dataType.elementType if array else f.dataType).simpleString()
        out[f.name] = BASES.get(kind, "number" if kind.startswith("decimal") else kind), array
    return out


def table_schema(spark: SparkSession, name: str) -> dict[str, tuple[str, bool]]:
    return schema_of(spark.table(name))


def coerced(value: Column, kind: T.DataType, base: str, array: bool) -> Column:
    """A value as the store's type. Containers that go into plain columns become JSON."""
    one = {"int": coerce_long, "number": coerce_double, "bool": coerce_bool}.get(base, lambda v: v)
    plain = F.to_json(value) if isinstance(kind, T.StructType | T.MapType | T.ArrayType) else value.cast("string")
    if not array:
        return F.when(value.isNotNull(), one(plain))
    parts = value.cast("array<string>") if isinstance(kind, T.ArrayType) else coerce_array(plain)
    return F.when(value.isNotNull(), F.transform(F.filter(parts, lambda x: x.isNotNull()), one))


def projected(df: DataFrame, schema: dict[str, tuple[str, bool]]) -> DataFrame:
    """Columns that the schema has as its types; of the others containers become JSON. One generated select."""
    out = []
    for f in df.schema:
        if f.name in schema:
            out.append(coerced(F.col(f.name), f.dataType, *schema[f.name]).alias(f.name))
        elif isinstance(f.dataType, T.StructType | T.MapType | T.ArrayType):
            out.append(F.to_json(f.name).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def properties(df: DataFrame) -> DataFrame:
    """Without the embedding and columns of internal use, whose names begin with an underscore."""
    return df.select(*(c for c in df.columns if c != "embedding" and not c.startswith("_")))


def sized(objects: DataFrame, least: int, column: str = "length") -> DataFrame:
    """Objects of ``least`` bytes or more; null counts as empty."""
    return objects.where(F.coalesce(F.col(column), F.lit(0)) >= least)


def best_reading(readings: DataFrame, item: str, order: str, confidence: str, enough: float = 95.0, least: float = 0.0) -> DataFrame:
    """Of several readings of an item the first that is sure ``enough``, else the surest of ``least`` or more."""
    sure = F.when(F.col(confidence) >= enough, F.col(order))
    first = F.row_number().over(Window.partitionBy(item).orderBy(sure.isNull(), sure, F.col(confidence).desc(), order))
    return readings.where(F.col(confidence) >= least).withColumn("_r", first).where("_r = 1").drop("_r")


def allowed_email(email: Column, domains: list[str]) -> Column:
    """Whether an address ends in ``@`` and one of the domains."""
    return F.coalesce(reduce(lambda a, b: a | b, (F.lower(email).endswith(f"@{d.lower()}") for d in domains), F.lit(False)), F.lit(False))


def certain(hits: DataFrame, distance: str, least: float = 0.25) -> DataFrame:
    """Hits of a cosine distance whose certainty, 1 less half of it, reaches ``least``."""
    return hits.withColumn("certainty", 1 - F.col(distance) / 2).where(F.col("certainty") >= least)


def real_hits(hits: DataFrame, id_col: str = "id") -> DataFrame:
    """Without the padding of fixed-length answers, ids below 0."""
    return hits.where(F.col(id_col) >= 0)


def matching(chunks: DataFrame, tags: list[str] | None = None, since=None, until=None, **equal) -> DataFrame:
    """Chunks by metadata: columns equal to a value or one of a list, all of ``tags``, and timestamps from ``since``
    to before ``until``. Plain comparisons, so that they reach the scan."""
    for column, value in equal.items():
        chunks = chunks.where(F.col(column).isin(*value) if isinstance(value, list | tuple | set) else F.col(column) == F.lit(value))
    for tag in tags or ():
        chunks = chunks.where(F.array_contains("tags", tag))
    if since is not None:
        chunks = chunks.where(F.col("timestamp") >= F.lit(since))
    return chunks if until is None else chunks.where(F.col("timestamp") < F.lit(until))


def strong_edges(edges: DataFrame, least: float = 0.70, kinds: list[str] | None = None) -> DataFrame:
    strong = edges.where(F.col("weight") >= least)
    return strong.where(F.col("type").isin(*kinds)) if kinds is not None else strong


def attached(texts: DataFrame, embeddings: DataFrame, key: str) -> DataFrame:
    """Texts with their embeddings by key, never by position; texts without one stay."""
    return texts.join(embeddings, key, "left")


def with_sidecar(objects: DataFrame, manifests: DataFrame, suffix: str, key: str = "path") -> DataFrame:
    """Objects beside which a manifest of their name lies."""
    beside = manifests.select(F.expr(f"left({key}, length({key}) - {len(suffix)})").alias(key))
    return objects.join(beside, key, "left_semi")


def tally(outcomes: DataFrame, column: str, kinds: list[str], by: str | None = None) -> DataFrame:
    """How many rows had each outcome, as one column each."""
    return (outcomes.groupBy(by) if by else outcomes).agg(*(F.count_if(F.col(column) == k).alias(k) for k in kinds))


def running_total(runs: DataFrame, by: str, order: list[str], amount: str, output: str) -> DataFrame:
    """What a manifest's counter stands at after each run."""
    return runs.withColumn(output, F.sum(amount).over(Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))


def page(df: DataFrame, order: list[str], offset: int, limit: int) -> DataFrame:
    """Rows of one page in a total order."""
    return df.orderBy(*order).offset(offset).limit(limit)


def snippet(text: Column, most: int) -> Column:
    return F.substring(F.coalesce(text, F.lit("")), 1, most)


def first_distinct(df: DataFrame, order: list[str], columns: list[str], limit: int) -> DataFrame:
    """The distinct values of the first ``limit`` rows: repeats among these aren't made up for."""
    return df.orderBy(*order).limit(limit).select(*columns).distinct()


def rootish(heading: Column) -> Column:
    """Whether a heading stands for the whole document."""
    return F.lower(F.trim(F.coalesce(heading, F.lit("")))).isin("", "root")


def utc_stamp(moment: Column) -> Column:
    """ISO 8601 in UTC to microseconds, with Z; the session's time zone must be UTC."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def funnel(lists: dict[str, tuple[DataFrame, int]], texts: DataFrame, pooled: int, reranked: int, answered: int, rerank=None) -> DataFrame:
    """From ranked lists (query_id, id, score) to what a model is to read.

    The first n of each list are united by their best rank, the ``pooled`` best kept, equal texts dropped but the
    best, and of the ``reranked`` next the ``answered`` best by ``rerank``, a function of (query_id, id, score).
    """
    from .retrieval import top_k

    ranks = [top_k(df, "query_id", "score", "id", n).select("query_id", "id", (-F.col("rank")).cast("double").alias("score")) for df, n in lists.values()]
    pool = reduce(DataFrame.unionByName, ranks).groupBy("query_id", "id").agg(F.max("score").alias("score"))
    pool = top_k(pool, "query_id", "score", "id", pooled).drop("rank").join(texts, "id")
    same = F.row_number().over(Window.partitionBy("query_id", F.sha2("text", 256)).orderBy(F.desc("score"), "id"))
    fresh = pool.withColumn("_r", same).where("_r = 1").select("query_id", "id", "score")
    short = top_k(fresh, "query_id", "score", "id", reranked).drop("rank")
    return top_k(rerank(short) if rerank else short, "query_id", "score", "id", answered)
