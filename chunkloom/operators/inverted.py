"""An inverted index on disk, with block maxima: BM25 for the k best without reading the texts.

A segment holds the postings of some documents, cut into shards of documents and bucketed by a hash of the
term. A block is one term's postings in one shard, with the greatest frequency and the least length among
them, which bound its scores whatever the corpus' statistics are. Postings name a document by its place in the
shard; a row without a term, in a bucket of its own, holds the shard's ids and lengths. A query adds up its terms' bounds in each
shard, scores the most promising shards, and then those whose bound reaches the k-th score found. Appending
writes a further segment; statistics are summed over segments when a query is asked.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .retrieval import MOST_BROADCAST, small, top_k
from .stages import cut

#: Documents of a shard, buckets of terms, the bucket of the shards' documents, and documents for which a bucket has a file.
SHARD_DOCS, BUCKETS, DOCUMENTS, FILE_DOCS = 64, 64, -1, 250_000
#: Scores are rounded to six digits, so a bound that falls short by less may still be a tie.
SLACK = 2e-6
K1, B = 1.2, 0.75


def append(docs: DataFrame, folder: str, id_col: str, words: Callable[[Column], Column], text_col: str = "text") -> None:
    """Adds a segment: ``postings`` (by bucket) and ``lengths`` (documents and words), each by segment.

    Documents that an earlier segment holds must not come again. Null texts have no words but count as documents.
    """
    spark = docs.sparkSession
    total = docs.count()
    shards, pieces = max(1, -(-total // SHARD_DOCS)), 1 + total // FILE_DOCS
    number, kind = segments(spark, folder), docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.pmod(F.xxhash64(id_col), F.lit(shards)).alias("shard"), F.col(id_col).alias("id"), words(F.col(text_col)).alias("w"))
    blocks = rows.groupBy("shard").applyInArrow(_blocks, f"term string, shard long, most int, least int, at array<int>, tfs array<int>, ids array<{kind}>, lens array<int>, n long, words long")
    out = blocks.withColumns({"bucket": F.when(F.col("term").isNull(), F.lit(DOCUMENTS)).otherwise(_bucket("term")), "df": F.size("at")})
    piece = F.pmod(F.xxhash64(F.coalesce("term", F.col("shard").cast("string")), F.lit(1)), F.lit(pieces))
    # a segment counts once its lengths are there, which are written last
    out.repartition((BUCKETS + 1) * pieces, "bucket", piece).sortWithinPartitions("bucket", "term").write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/postings/segment={number}")
    if total:
        lengths = spark.read.parquet(f"{folder}/postings/segment={number}").where(F.col("bucket") == DOCUMENTS).agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    else:
        lengths = spark.range(1).select(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("words"))
    lengths.coalesce(1).write.mode("overwrite").parquet(f"{folder}/lengths/segment={number}")


def _blocks(table: pa.Table) -> pa.Table:
    """The blocks of a shard's documents (shard, id, w), and its row of documents. Rows that repeat an id and a length are one document."""
    shard, ids, lists = table.column("shard")[0].as_py(), table.column("id").combine_chunks(), table.column("w").combine_chunks()
    lens = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int32)
    coded = ids.dictionary_encode()
    name = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    pairs, first, place = np.unique(np.stack([name, lens], 1), axis=0, return_index=True, return_inverse=True)
    said = lists.flatten().dictionary_encode()
    key, tf = np.unique(said.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(pairs) + np.repeat(place.ravel(), lens), return_counts=True)
    term, at = np.divmod(key, len(pairs))
    starts = np.flatnonzero(np.diff(term, prepend=-1))
    ends, n = np.append(starts, len(term)).astype(np.int32), len(starts) + 1
    size = pairs[:, 1].astype(np.int32)
    most = np.maximum.reduceat(tf, starts) if len(starts) else tf
    least = np.minimum.reduceat(size[at], starts) if len(starts) else tf

    def lone(values: pa.Array) -> pa.Array:
        """A list for the last row, the row of documents; null for the others."""
        return pa.concat_arrays([pa.nulls(n - 1, pa.list_(values.type)), pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)])

    def each(values: np.ndarray, kind: pa.DataType) -> pa.Array:
        return pa.concat_arrays([pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind)), pa.nulls(1, pa.list_(kind))])

    last = lambda values, end, kind: pa.array([*values.tolist(), end], kind)
    return pa.table(
        {
            "term": pa.concat_arrays([said.dictionary.take(pa.array(term[starts])).cast(pa.string()), pa.nulls(1, pa.string())]),
            "shard": pa.array(np.full(n, shard, np.int64)),
            "most": last(most, None, pa.int32()),
            "least": last(least, None, pa.int32()),
            "at": each(at, pa.int32()),
            "tfs": each(tf, pa.int32()),
            "ids": lone(ids.take(pa.array(first))),
            "lens": lone(pa.array(size)),
            "n": last(np.zeros(n - 1, np.int64), len(lens), pa.int64()),
            "words": last(np.zeros(n - 1, np.int64), int(lens.sum()), pa.int64()),
        }
    )


def _bucket(term) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def segments(spark: SparkSession, folder: str) -> int:
    """How many segments are complete."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/lengths")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return 0
    return sum(1 for s in files.listStatus(path) if files.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")))


def _part(idf: Column, tf: Column, length: Column, mean: Column, k1: float, b: float) -> Column:
    return idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean))


def bm25_topk(spark: SparkSession, folder: str, queries: DataFrame, k: int, words: Callable[[Column], Column], k1: float = K1, b: float = B, tell: dict | None = None) -> DataFrame:
    """(query_id, id, score, rank), as BM25 over all texts gives it; ties by id. ``tell`` gets how many blocks were met and read."""
    asked = queries.select("query_id", F.explode(F.array_distinct(words(F.col("query")))).alias("term"))
    number = segments(spark, folder)
    empty = queries.select("query_id", F.lit(0).cast("long").alias("id"), F.lit(0.0).alias("score"), F.lit(1).alias("rank")).where("false")
    if not number:
        return empty
    asked = cut(asked.withColumn("bucket", _bucket("term")))
    buckets = [r.bucket for r in asked.select("bucket").distinct().collect()]  # BUCKETS at most
    lengths = {n: spark.read.parquet(f"{folder}/lengths/segment={n}").first() for n in range(number)}
    filled = [n for n, r in lengths.items() if r.n]  # an empty segment has no files of postings
    total = sum(r.n for r in lengths.values())
    if not total or not buckets:
        return empty
    mean = F.lit(sum(r.words for r in lengths.values()) / total)
    parts = [spark.read.parquet(f"{folder}/postings/segment={s}").withColumn("segment", F.lit(s)) for s in filled]
    index = parts[0]
    for p in parts[1:]:
        index = index.unionByName(p)
    documents = index.where(F.col("bucket") == DOCUMENTS).select("segment", "shard", "ids", "lens")
    terms = asked.select("bucket", "term").distinct()
    few = [r.term for r in terms.limit(MOST_BROADCAST + 1).collect()]
    # only asked terms' postings leave the files, whatever is joined with them
    postings = index.where(F.col("bucket").isin(buckets))
    postings = postings.where(F.col("term").isin(few)) if len(few) <= MOST_BROADCAST else postings.join(terms, ["bucket", "term"], "left_semi")
    heads = cut(postings.select("term", "segment", "shard", "most", "least", "df"))  # without the postings themselves
    df = heads.groupBy("term").agg(F.sum("df").alias("all"))
    weights = df.select("term", F.log(1 + (F.lit(total) - F.col("all") + 0.5) / (F.col("all") + 0.5)).alias("idf"))
    weighed = small(cut(asked.select("query_id", "term").join(weights, "term")))
    per_shard = heads.join(weighed, "term").groupBy("query_id", "segment", "shard").agg(F.sum(_part(F.col("idf"), F.col("most"), F.col("least"), mean, k1, b)).alias("bound"))
    per_shard = cut(per_shard)

    def scores(shards: DataFrame) -> DataFrame:
        """Scores of the documents that share a term with the query, in the given shards of each query."""
        where = ["segment", "shard"]
        read = postings.select("term", "segment", "shard", "at", "tfs").join(documents, where).join(shards.select("query_id", *where), where).join(weighed, ["query_id", "term"])
        each = read.select("query_id", "idf", "ids", "lens", F.explode(F.arrays_zip("at", "tfs")).alias("p"))
        each = each.select("query_id", F.get("ids", F.col("p.at")).alias("id"), _part(F.col("idf"), F.col("p.tfs"), F.get("lens", F.col("p.at")), mean, k1, b).alias("s"))
        return each.groupBy("query_id", "id").agg(F.round(F.sum("s"), 6).alias("score"))

    # the k shards with the greatest bounds; each holds a document at least
    promising = top_k(per_shard.withColumn("key", F.struct("segment", "shard")), "query_id", "bound", "key", max(1, k))
    first = cut(scores(promising))
    kth = top_k(first, "query_id", "score", "id", k).where(F.col("rank") == k).select("query_id", F.col("score").alias("reached"))
    rest = per_shard.join(promising.select("query_id", "segment", "shard"), ["query_id", "segment", "shard"], "left_anti").join(kth, "query_id", "left")
    open_ = cut(rest.where(F.col("reached").isNull() | (F.col("bound") >= F.col("reached") - SLACK)))
    if tell is not None:
        tell |= {"shards": per_shard.count(), "read": promising.count() + open_.count()}
    return top_k(first.unionByName(scores(open_)), "query_id", "score", "id", k)
