"""Deterministic identifiers."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: namespace of the name-based uuids, the URL namespace of RFC 4122.
NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def checksum(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def vector_id(document: Column, chunk: Column) -> Column:
    """First 64 bits of the sha256 of ``document:chunk`` as an unsigned number."""
    digest = F.sha2(F.concat_ws(":", document, chunk), 256)
    return F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)")


def uuid5(document: Column, chunk: Column, namespace: str = NAMESPACE) -> Column:
    """Name-based uuid (version 5) of ``document:chunk``."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(F.concat_ws(":", document, chunk), "UTF-8")))
    variant = F.substr(F.lit("89ab"), F.pmod(F.instr(F.lit("0123456789abcdef"), F.substring(h, 17, 1)) - 1, F.lit(4)) + 1, F.lit(1))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def document_id(file_hash: Column, key: Column, etag: Column, modified: Column) -> Column:
    """The manifest's hash, else from key and etag, key and modification time, the key's last part, or the key alone."""
    base = F.nullif(F.element_at(F.split(key, "/"), -1), F.lit(""))
    return F.coalesce(file_hash, F.sha2(F.concat(key, etag), 256), F.sha2(F.concat(key, modified), 256), base, F.sha2(key, 256))


def content_digests(content: Column) -> dict[str, Column]:
    """sha256, sha1 and md5 of bytes, as hex."""
    return {"sha256": F.sha2(content, 256), "sha1": F.sha1(content), "md5": F.md5(content)}


def blake2b(content: Column, size: int = 16) -> Column:
    """BLAKE2b of bytes with a digest of ``size`` bytes, as hex; there is no built-in."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else hashlib.blake2b(x, digest_size=size).hexdigest() for x in s], dtype=object)

    return run(content.cast("binary"))
