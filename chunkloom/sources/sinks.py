"""Sinks: chunk files per document, index tables, batched upserts, manifests, snapshots, mirrors, results as JSON."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_chunks(chunks: DataFrame, path: str, by: str = "document_id", form: str = "parquet", mode: str = "overwrite") -> None:
    """One folder per value of ``by``; only the folders that the rows belong to are replaced.

    ``by`` should be a bucket or a source where there are many documents.
    """
    writer = chunks.write.mode(mode).partitionBy(by).option("partitionOverwriteMode", "dynamic")
    writer.format(form).save(path)


def chunks_of(spark: SparkSession, path: str, document_id: str, by: str = "document_id", form: str = "parquet") -> DataFrame:
    """One document's chunks; only its folder is listed and read."""
    return spark.read.format(form).load(path).where(F.col(by) == document_id)


def ensure_table(spark: SparkSession, name: str, schema: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet")


def upsert_batches(rows: DataFrame, put_many: Callable[[list[dict]], None], put_one: Callable[[dict], None], size: int = 128) -> DataFrame:
    """(sent, failed) of a store outside, a row for each task: batches of ``size``, row by row where a batch fails.

    Tasks may run again, so ``put_many`` and ``put_one`` must replace what has the same key.
    """

    def run(batches):
        sent = failed = 0
        for batch in batches:
            items = batch.to_pylist()
            for k in range(0, len(items), size):
                part = items[k : k + size]
                try:
                    put_many(part)
                    sent += len(part)
                except Exception:  # whatever the store's client raises
                    for item in part:
                        try:
                            put_one(item)
                            sent += 1
                        except Exception:
                            failed += 1
        yield pa.RecordBatch.from_arrays([pa.array([sent], pa.int64()), pa.array([failed], pa.int64())], names=["sent", "failed"])

    return rows.mapInArrow(run, "sent long, failed long")


def flat(df: DataFrame, keep: tuple[str, ...] = ("tags",)) -> DataFrame:
    """Nested columns as JSON text, other than ``keep``; nulls stay null."""
    nested = {c for c, t in df.dtypes if t.startswith(("struct", "array", "map")) and c not in keep}
    return df.select(*(F.to_json(c).alias(c) if c in nested else F.col(c) for c in df.columns))


def as_json(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))


def _moved(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file or folder, replacing a file or an older folder of that name.

    An older folder is moved aside first and removed last, so that a crash between loses neither. ``merge.publish``
    keeps a name readable throughout.
    """
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    old, new = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    system = new.getFileSystem(conf)
    aside = None
    if system.exists(new) and system.getFileStatus(new).isDirectory():
        aside = jvm.org.apache.hadoop.fs.Path(f"{target}.{uuid.uuid4().hex}.old")
        if not system.rename(new, aside):
            raise OSError(f"{target} can't be moved aside")
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri() if new.toUri().getScheme() else system.getUri(), conf).rename(system.makeQualified(old), system.makeQualified(new), overwrite)
    if aside is not None:
        system.delete(aside, True)


def write_manifest(spark: SparkSession, path: str, values: dict) -> None:
    """A small JSON file, written beside its place and renamed, so that readers see the old or the new one."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    draft = f"{path}.{uuid.uuid4().hex}.tmp"
    at = jvm.org.apache.hadoop.fs.Path(draft)
    out = at.getFileSystem(conf).create(at, True)
    out.write(bytearray(json.dumps(values, ensure_ascii=False, indent=1).encode()))
    out.close()
    _moved(spark, draft, path)


def publish(df: DataFrame, path: str, form: str = "parquet") -> None:
    """Writes beside ``path`` and renames when all is there."""
    draft = f"{path}.{uuid.uuid4().hex}.tmp"
    df.write.format(form).save(draft)
    _moved(df.sparkSession, draft, path)


def snapshot(spark: SparkSession, df: DataFrame, root: str, version: str) -> None:
    """A version of an index, or of source texts, and a pointer to it that is written last."""
    df.write.mode("overwrite").parquet(f"{root}/versions/{version}")
    write_manifest(spark, f"{root}/latest.json", {"version": version})


def restore(spark: SparkSession, root: str) -> DataFrame:
    latest = spark.read.option("multiLine", "true").json(f"{root}/latest.json").first()["version"]
    return spark.read.parquet(f"{root}/versions/{latest}")


def mirror(plan: DataFrame, source: str, target: str, delete: bool = False, path: str = "path") -> DataFrame:
    """Carries out a plan of upload, skip and delete: (path, action, done), a row for each.

    Files are copied by the tasks. Extra files of the target go only with ``delete``. A copy that fails isn't done.
    """

    def run(batches):
        from pyarrow import fs

        (old, old_root), (new, new_root) = fs.FileSystem.from_uri(source), fs.FileSystem.from_uri(target)
        for batch in batches:
            done = []
            for name, action in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    if action == "upload":
                        new.create_dir(f"{new_root}/{name}".rpartition("/")[0])
                        fs.copy_files(f"{old_root}/{name}", f"{new_root}/{name}", source_filesystem=old, destination_filesystem=new)
                    elif action == "delete" and delete:
                        new.delete_file(f"{new_root}/{name}")
                    done.append(action == "upload" or (action == "delete" and delete))
                except OSError:
                    done.append(False)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(done)], names=[path, "action", "done"])

    return plan.select(path, "action").mapInArrow(run, f"{path} string, action string, done boolean")
