"""A table of files that is merged into by copying only what changes.

Rows are bucketed by a hash of their key, and each bucket's rows are one folder of files. A merge writes new
folders for the buckets that its keys fall into and leaves the others as they are. What a version consists of
is a manifest, a small file that is renamed into its place when all else is written: that rename is the commit,
and it fails if another merge has taken the number. A merge that dies before leaves files that no manifest
names. Readers keep to the version they began with; folders of old versions stay until ``vacuum``.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.stages import cut


class Conflict(RuntimeError):
    """Another writer has committed the version."""


def _system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def commit(spark: SparkSession, root: str, version: int, values: dict) -> None:
    """Makes ``values`` the manifest of a version that nobody has committed."""
    draft, system = _system(spark, f"{root}/manifests/.{uuid.uuid4().hex}")
    place, _ = _system(spark, f"{root}/manifests/{version:012d}.json")
    out = system.create(draft, True)
    out.write(bytearray(json.dumps(values).encode()))
    out.close()
    if system.exists(place) or not system.rename(draft, place):
        system.delete(draft, False)
        raise Conflict(f"version {version} of {root} is taken")


def versions(spark: SparkSession, root: str) -> list[int]:
    at, system = _system(spark, f"{root}/manifests")
    if not system.exists(at):
        return []
    names = (s.getPath().getName() for s in system.listStatus(at))
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def manifest(spark: SparkSession, root: str, version: int | None = None) -> dict | None:
    """A version's manifest, the latest one's by default; None if there is none."""
    known = versions(spark, root)
    if not known or (version is not None and version not in known):
        return None
    at, system = _system(spark, f"{root}/manifests/{known[-1] if version is None else version:012d}.json")
    stream = system.open(at)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def create(rows: DataFrame, root: str, key: str, buckets: int = 64) -> None:
    """Version 0 with ``rows``, of those of one key the greatest; null keys are left out."""
    _write(rows.sparkSession, root, None, rows, None, key, buckets)


def merge(spark: SparkSession, root: str, changed: DataFrame, deleted: DataFrame | None = None) -> int:
    """The next version: rows of ``changed`` replace those of their keys or are added, keys of ``deleted`` go.

    A key that is in both stays as ``changed`` has it. Of several changed rows of a key the greatest counts. Deleted
    keys are written down as tombstones of the version. Returns the version's number; without any key nothing is written.
    """
    last = manifest(spark, root)
    if last is None:
        raise ValueError(f"no table at {root}")
    return _write(spark, root, last, changed, deleted, last["key"], last["buckets"])


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("_bucket")


def _write(spark: SparkSession, root: str, last: dict | None, changed: DataFrame, deleted: DataFrame | None, key: str, buckets: int) -> int:
    columns = changed.columns if last is None else [f["name"] for f in json.loads(last["schema"])["fields"]]
    others = [c for c in columns if c != key]
    one = changed.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*others)).alias("_row")).select(key, *(F.col(f"_row.{c}").alias(c) for c in others)).select(*columns)
    new = cut(one.withColumn("_bucket", _bucket(key, buckets)))
    gone = None
    if deleted is not None:
        gone = cut(deleted.where(F.col(key).isNotNull()).select(key).distinct().join(new.select(key), key, "left_anti").withColumn("_bucket", _bucket(key, buckets)))
    touched = {r._bucket for part in (new, gone) if part is not None for r in part.select("_bucket").distinct().collect()}  # no more than there are buckets
    if last is not None and not touched:
        return last["version"]
    version = 0 if last is None else last["version"] + 1
    folders = {} if last is None else dict(last["folders"])
    kept = None
    old = [folders[str(b)] for b in touched if str(b) in folders]
    if old:
        keys = new.select(key) if gone is None else new.select(key).unionByName(gone.select(key))
        schema = T.StructType.fromJson(json.loads(last["schema"]))
        kept = spark.read.schema(schema).parquet(*(f"{root}/{f}" for f in old)).join(keys, key, "left_anti").withColumn("_bucket", _bucket(key, buckets))
    rows = new if kept is None else kept.select(*columns, "_bucket").unionByName(new)
    folder = f"data/{version:012d}-{uuid.uuid4().hex}"
    # a bucket is one task's work; more buckets make smaller ones
    rows.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{root}/{folder}")
    at, system = _system(spark, f"{root}/{folder}")
    full = {s.getPath().getName().removeprefix("_bucket=") for s in system.listStatus(at) if s.getPath().getName().startswith("_bucket=")}
    for b in map(str, touched):
        folders.pop(b, None)
        if b in full:
            folders[b] = f"{folder}/_bucket={b}"
    stones = None
    if gone is not None:
        stones = f"tombstones/{version:012d}-{uuid.uuid4().hex}"
        gone.select(key).write.parquet(f"{root}/{stones}")
    values = {"version": version, "key": key, "buckets": buckets, "folders": folders, "tombstones": stones, "schema": changed.select(*columns).schema.json() if last is None else last["schema"]}
    commit(spark, root, version, values)
    return version


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A version's rows, the latest one's by default."""
    found = manifest(spark, root, version)
    if found is None:
        raise ValueError(f"no such version at {root}")
    schema = T.StructType.fromJson(json.loads(found["schema"]))
    if not found["folders"]:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{root}/{f}" for f in found["folders"].values()))


def deleted_since(spark: SparkSession, root: str, version: int) -> DataFrame | None:
    """Keys that later versions have deleted and no later one has brought back; None if none has deleted any."""
    found = [m for v in versions(spark, root) if v > version and (m := manifest(spark, root, v))["tombstones"]]
    if not found:
        return None
    keys = spark.read.parquet(*(f"{root}/{m['tombstones']}" for m in found)).distinct()
    return keys.join(read(spark, root).select(found[0]["key"]), found[0]["key"], "left_anti")


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Removes what only versions before the last ``keep`` name, and what no version names; returns how many folders went.

    Not to be run while a merge is under way or a reader keeps to an older version.
    """
    known = versions(spark, root)
    wanted = {f for v in known[-keep:] for f in manifest(spark, root, v)["folders"].values()}
    at, system = _system(spark, f"{root}/data")
    gone = 0
    for batch in system.listStatus(at) if system.exists(at) else ():
        for bucket in system.listStatus(batch.getPath()):
            name = bucket.getPath().getName()
            if name.startswith("_bucket=") and f"data/{batch.getPath().getName()}/{name}" not in wanted:
                system.delete(bucket.getPath(), True)
                gone += 1
    for v in known[:-keep]:
        system.delete(_system(spark, f"{root}/manifests/{v:012d}.json")[0], False)
    return gone


def publish(df: DataFrame, root: str, form: str = "parquet") -> int:
    """A folder that is replaced as a whole: a new one is written, and a manifest that names it is its commit.

    A crash at any point leaves the old folder or the new one in force.
    """
    spark = df.sparkSession
    known = versions(spark, root)
    version, folder = known[-1] + 1 if known else 0, f"data/{uuid.uuid4().hex}"
    df.write.format(form).save(f"{root}/{folder}")
    commit(spark, root, version, {"version": version, "folder": folder, "form": form})
    return version


def published(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    found = manifest(spark, root, version)
    if found is None:
        raise ValueError(f"nothing is published at {root}")
    return spark.read.format(found["form"]).load(f"{root}/{found['folder']}")
