"""Sources: raw files, CSV, JSON Lines, texts, HTML, manifests, chunk files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators.index import FORMATS, dispatch

IMAGES = "png jpg jpeg webp tif tiff bmp gif".split()
AUDIO = "wav mp3 m4a aac flac ogg opus wma aiff aif amr webm".split()
MANIFEST = ".manifest.json"


def raw_objects(spark: SparkSession, path: str, content: bool = False, digest: bool = False) -> DataFrame:
    """(path, modified, length[, content][, digest], ext, parser, mime) of all files but manifests and folders.

    Without ``content`` and ``digest`` (sha256) the files aren't opened, only listed.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    ext = text.extension(text.file_name(F.col("path")))
    parser, mime = dispatch(ext)
    kept = files.where(~F.col("path").endswith(MANIFEST)).select("path", F.col("modificationTime").alias("modified"), "length", *(["content"] if content else []), ext.alias("ext"), *([F.sha2("content", 256).alias("digest")] if digest else []))
    return kept.withColumn("parser", parser).withColumn("mime", mime)


def chunk_paths(spark: SparkSession, path: str, extensions: tuple[str, ...] = ("json", "jsonl")) -> DataFrame:
    """(path, length) of chunk files by extension, listed only."""
    return raw_objects(spark, path).where(F.col("ext").isin(*extensions)).select("path", "length")


def of_kind(objects: DataFrame, extensions: list[str]) -> DataFrame:
    return objects.where(F.col("ext").isin(extensions))


def decoded(content) -> F.Column:
    """UTF-8 with or without a byte-order mark, else Latin-1."""
    utf8 = F.regexp_replace(F.decode(content, "UTF-8"), "^\\uFEFF", "")
    return F.when(F.call_function("is_valid_utf8", content.cast("string")), utf8).otherwise(F.decode(content, "ISO-8859-1"))


def texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of text, Markdown and HTML files."""
    return raw_objects(spark, path, content=True).where(F.col("parser").isin("txt", "md", "html")).select("path", "parser", decoded(F.col("content")).alias("text"))


def csv_rows(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """All columns as strings; malformed lines are dropped."""
    return spark.read.csv(path, header=True, sep=separator, mode="DROPMALFORMED", multiLine=True, escape='"')


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, value): each line that is JSON, with nested values kept as a variant."""
    lines = spark.read.text(path).select(F.col("value").alias("line"))
    return lines.withColumn("value", F.try_parse_json("line")).where("value IS NOT NULL")


def manifests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{MANIFEST}").json(path)


def chunk_files(spark: SparkSession, path: str) -> DataFrame:
    """Chunks from files that hold an array, JSON Lines or objects one after another, as (path, json)."""
    import json

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = json.JSONDecoder()
        for batch in batches:
            paths, found = [], []
            for name, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = 0
                while at < len(body):
                    if body[at] in " \t\r\n,[]":
                        at += 1
                        continue
                    try:
                        value, at = decoder.raw_decode(body, at)
                    except ValueError:
                        at = body.find("{", at + 1) if "{" in body[at + 1 :] else len(body)
                        continue
                    paths.append(name)
                    found.append(json.dumps(value, ensure_ascii=False))
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(found, pa.string())], names=["path", "json"])

    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return files.where(~F.col("path").endswith(MANIFEST)).mapInArrow(run, "path string, json string")


def known_extensions() -> list[str]:
    return sorted(FORMATS)
