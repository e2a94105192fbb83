"""Shared helpers: table access, a per-process cache for loaded models, checkpointing."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

_LOADED: dict = {}


#: Keys that are treated apart at most, the commonest ones, and rows of one key that a task may get.
HOT_KEYS, HOT_ROWS = 1 << 16, 1_000
SAMPLED, SEEN = 64, 32
#: Rows of a batch that a Python worker gets; Spark's default of 10,000 whole texts is too much for small executors.
BATCH_ROWS = 1_000
#: Bytes of checkpointed rows, about, that one task reads.
PART_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Shipped:
    """A value of bounded size sent once to each executor, with what a worker builds from it."""

    def __init__(self, spark: SparkSession, value):
        self.key, self.sent = uuid.uuid4().hex, spark.sparkContext.broadcast(value)

    def built(self, build: Callable):
        return once(self.key, lambda: build(self.sent.value))


def fresh(name: str, columns: list[str]) -> str:
    """A column name that ``columns`` don't have, whatever their case."""
    while name.lower() in map(str.lower, columns):
        name += "_"
    return name


def once(key, build: Callable):
    """One object per Python worker and key; workers are reused, so models load once."""
    if key not in _LOADED:
        _LOADED[key] = build()
    return _LOADED[key]


def map_texts(df: DataFrame, id_col: str, text_col: str, row: Callable, schema: str) -> DataFrame:
    """Apply ``row(text) -> tuple`` to each text through Arrow batches.

    Only the id and the text travel to Python, so further columns and their names don't matter.
    The id keeps its type and comes back as given, null included. ``schema`` lists the row's columns.
    """
    columns_of = T.StructType.fromDDL(schema)
    full = T.StructType([df.schema[id_col], *columns_of])
    names, types = full.names, [to_arrow_type(f.dataType) for f in columns_of]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            rows = [row(t) for t in batch.column(1).to_pylist()]
            columns = list(zip(*rows, strict=True)) if rows else [() for _ in types]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)

    return df.select(id_col, text_col).mapInArrow(run, full)


def filter_texts(df: DataFrame, text_col: str, keep: Callable) -> DataFrame:
    """Rows whose text ``keep`` accepts, with all their columns and without a shuffle."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([keep(t) for t in batch.column(at).to_pylist()], pa.bool_()))

    return df.mapInArrow(run, df.schema)


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; one is made only in local mode where none is set, as in tests."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="chunkloom-checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


def _bytes(schema: T.StructType) -> Column:
    """About how many bytes a row takes."""
    total = F.lit(0).cast("long")
    for f in schema:
        name = "`" + f.name.replace("`", "``") + "`"
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total += F.coalesce(F.octet_length(name), F.lit(0))
        elif isinstance(f.dataType, T.ArrayType):
            total += 8 * F.coalesce(F.size(name), F.lit(0))
        total += 8
    return total


def cut(df: DataFrame, as_dealt: bool = False) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, so that a lost executor loses nothing.

    It comes in as many partitions as its bytes ask for, no fewer than the session's cores: few rows that a shuffle
    has dealt over many partitions would else take that many tasks, with files of their own, each time they are read. ``as_dealt`` leaves the partitions and the order of
    their rows as they are, for those who go by them.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    seen = Observation()
    out = df.observe(seen, F.sum(_bytes(df.schema)).alias("bytes")).checkpoint(eager=True)
    parts = max(spark.sparkContext.defaultParallelism, -(-(seen.get.get("bytes") or 0) // PART_BYTES))
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()  # shuffles that nothing refers to any more give up their files
    return out.coalesce(parts) if not as_dealt and 2 * parts <= out.rdd.getNumPartitions() else out  # coalesce forgets how rows are dealt


def _hot(counts: DataFrame, least: int) -> DataFrame | None:
    """The commonest of the keys that ``counts`` holds ``least`` times or more, HOT_KEYS at most; None if there are none."""
    rows = counts.where(F.col("count") >= least).orderBy(F.desc("count")).limit(HOT_KEYS).collect()
    return F.broadcast(counts.sparkSession.createDataFrame(rows, counts.schema)) if rows else None


def spread_join(many: DataFrame, few: DataFrame, key: str, how: str = "inner", most: int = HOT_ROWS) -> DataFrame:
    """``many.join(few, key, how)`` for inner and left joins where ``few`` has one row a key.

    Keys with more than ``most`` rows in ``many`` are dealt over as many tasks as that takes, and their row
    of ``few`` is repeated for each. ``many`` is read twice, so it should be checkpointed.
    """
    hot = _hot(many.groupBy(key).count(), most + 1)
    if hot is None:
        return many.join(few, key, how)
    copies = hot.select(key, F.ceil(F.col("count") / most).cast("int").alias("_copies"))
    rest = [c for c in many.columns if c != key]
    dealt = many.join(F.broadcast(copies), key, "left").withColumn("_copy", F.coalesce(F.pmod(F.xxhash64(*rest), F.col("_copies")), F.lit(0)).cast("int")).drop("_copies")
    repeated = few.join(F.broadcast(copies), key, "left").withColumn("_copy", F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1))).drop("_copies")
    return dealt.join(repeated, [key, "_copy"], how).drop("_copy")


def counted(rows: DataFrame, key: str, like: DataFrame) -> DataFrame:
    """``rows`` with df, the number of rows that have the same key.

    The window that counts sends a key's rows to one task. Keys too common for that are looked for in a hash
    sample of ``like`` (key and id) and counted by an aggregate first, so that the window may deal their rows
    over tasks; the result is the same either way.
    """
    sample = like.where(F.pmod(F.xxhash64(key, "id"), F.lit(SAMPLED)) == 0)
    hot = _hot(sample.groupBy(key).count(), SEEN)
    if hot is None:
        return rows.withColumn("df", F.expr(f"count(1) OVER (PARTITION BY {key})"))
    marked = rows.join(hot.select(key, F.lit(True).alias("_hot")), key, "left")
    totals = cut(marked.where("_hot").groupBy(key).agg(F.count(F.lit(1)).alias("_total")))  # HOT_KEYS rows at most
    dealt = rows.join(F.broadcast(totals), key, "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64("id"), F.ceil(F.col("_total") / HOT_ROWS)), F.lit(0)))
    return dealt.withColumn("df", F.coalesce("_total", F.expr(f"count(1) OVER (PARTITION BY {key}, _part)"))).drop("_total", "_part")


def held_out(doc_id) -> F.Column:
    """Fold 0 of 5 by crc32 of the id as text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
