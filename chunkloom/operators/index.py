"""Incremental index maintenance: delta upserts, manifests, fingerprints, listings, value coercion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Which parser reads an extension, and its MIME type.
FORMATS = {
    "txt": ("txt", "text/plain"), "md": ("md", "text/markdown"), "markdown": ("md", "text/markdown"), "mdown": ("md", "text/markdown"),
    "html": ("html", "text/html"), "htm": ("html", "text/html"), "csv": ("csv", "text/csv"), "tsv": ("csv", "text/tab-separated-values"),
    "jsonl": ("jsonl", "application/x-ndjson"), "ndjson": ("jsonl", "application/x-ndjson"), "json": ("jsonl", "application/json"),
    "pdf": ("pdf", "application/pdf"), "pptx": ("pptx", "application/vnd.openxmlformats-officedocument.presentationml.presentation"),
    "wav": ("wav", "audio/wav"), "png": ("images", "image/png"), "jpg": ("images", "image/jpeg"), "jpeg": ("images", "image/jpeg"), "webp": ("images", "image/webp"),
    "tif": ("images", "image/tiff"), "tiff": ("images", "image/tiff"), "bmp": ("images", "image/bmp"), "gif": ("images", "image/gif"),
}


def dispatch(extension: Column) -> tuple[Column, Column]:
    """Parser and MIME type, null for unknown extensions."""
    table = lambda k: F.create_map(*(x for e, v in FORMATS.items() for x in (F.lit(e), F.lit(v[k]))))
    return F.try_element_at(table(0), extension), F.try_element_at(table(1), extension)


def delta(chunks: DataFrame, index: DataFrame, keys: list[str]) -> DataFrame:
    """Chunks whose keys the index doesn't hold."""
    return chunks.join(index.select(*keys), keys, "left_anti")


def upsert(index: DataFrame, changed: DataFrame, key: str) -> DataFrame:
    """The index with changed rows replaced and new rows added."""
    return index.join(changed.select(key), key, "left_anti").unionByName(changed)


def fingerprint(hashes: Column) -> Column:
    """Digest of the distinct hashes in order, so independent of arrival."""
    return F.sha2(F.array_join(F.array_sort(F.collect_set(hashes)), ""), 256)


def manifest_status(manifests: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """completed, partial or in-progress, from expected and found counts and fingerprints."""
    joined = manifests.join(counts, key, "left")
    found = F.coalesce("found_chunks", F.lit(0))
    complete = (found == F.col("expected_chunks")) & F.col("expected_fingerprint").eqNullSafe(F.col("found_fingerprint"))
    return joined.withColumn("status", F.when(found == 0, "in-progress").when(F.col("expected_chunks").isNull() | complete, "completed").otherwise("partial"))


def to_do(objects: DataFrame, manifests: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """Objects that aren't completed with the same hash and as many chunks in the store as expected."""
    done = manifests.join(counts, key).where("status = 'completed' AND found_chunks = expected_chunks").select(key, "file_hash")
    return objects.join(done, [key, "file_hash"], "left_anti")


def sync_plan(local: DataFrame, remote: DataFrame, path: str = "path") -> DataFrame:
    """upload, skip or delete for each path of two listings with a digest column."""
    both = local.select(path, F.col("digest").alias("ld")).join(remote.select(path, F.col("digest").alias("rd")), path, "full_outer")
    return both.select(path, F.when(F.col("ld").isNull(), "delete").when(F.col("ld").eqNullSafe(F.col("rd")), "skip").otherwise("upload").alias("action"))


def coerce_long(value: Column) -> Column:
    """Truncated number, 0 where there is none."""
    return F.coalesce(value.try_cast("double").cast("long"), F.lit(0))


def coerce_double(value: Column) -> Column:
    return F.coalesce(value.try_cast("double"), F.lit(0.0))


def coerce_bool(value: Column) -> Column:
    return F.coalesce(F.lower(F.trim(value)).isin("1", "true", "yes"), F.lit(False))


def coerce_array(value: Column) -> Column:
    """JSON array, else parts between commas, else between hyphens, else one element."""
    parsed = F.from_json(value, "array<string>")
    return F.when(F.trim(value).startswith("["), parsed).when(value.contains(","), F.split(value, ",")).when(value.contains("-"), F.split(value, "-")).otherwise(F.array(value))
