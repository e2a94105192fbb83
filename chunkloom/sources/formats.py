"""Parsers over raw bytes: slides, spreadsheets, PDF pages, images, sound, samples of files and remote pages.

One row of a listing gives one row for each slide, sheet row or page. Files that can't be read give none.
"""

from __future__ import annotations

import io
import re
import time
import wave
import zipfile
import zlib
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import text

# XML name spaces of the office formats.
DRAWING = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
SLIDES = "{http://schemas.openxmlformats.org/presentationml/2006/main}"
SHEETS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINKS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
ENCRYPTED = ("encryptedpackage", "encryptioninfo")


def parsed(files: DataFrame, schema: str, parse: Callable[[bytes], Iterator[tuple]]) -> DataFrame:
    """(path, ...) for each row that ``parse`` gives of a file's content."""
    full = T.StructType([T.StructField("path", T.StringType()), *T.StructType.fromDDL(schema)])
    arrow = to_arrow_schema(full)

    def run(batches):
        for batch in batches:
            for path, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    rows = [(path, *row) for row in parse(content)]
                except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, ValueError, EOFError, wave.Error, zlib.error):
                    rows = []
                columns = list(zip(*rows, strict=True)) or [()] * len(arrow)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return files.select("path", "content").mapInArrow(run, full)


def _linked(archive: zipfile.ZipFile, part: str) -> dict[str, str]:
    """Targets of a part's relations by id."""
    folder, _, name = part.rpartition("/")
    tree = ElementTree.fromstring(archive.read(f"{folder}/_rels/{name}.rels"))
    return {r.get("Id"): (r.get("Target").lstrip("/") if r.get("Target").startswith("/") else f"{folder}/{r.get('Target')}") for r in tree}


def _paragraphs(node) -> list[str]:
    return ["".join(t.text or "" for t in p.iter(f"{DRAWING}t")).strip() for p in node.iter(f"{DRAWING}p")]


def _slides(content: bytes):
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        links = _linked(archive, "ppt/presentation.xml")
        order = [s.get(f"{LINKS}id") for s in ElementTree.fromstring(archive.read("ppt/presentation.xml")).iter(f"{SLIDES}sldId")]
        for number, key in enumerate(order, 1):
            slide = ElementTree.fromstring(archive.read(links[key]))
            lines = [line for shape in slide.iter(f"{SLIDES}sp") for line in _paragraphs(shape) if line]
            tables = [[[" ".join(filter(None, _paragraphs(cell))) for cell in row.iter(f"{DRAWING}tc")] for row in table.iter(f"{DRAWING}tr")] for table in slide.iter(f"{DRAWING}tbl")]
            yield number, lines, tables, sum(1 for _ in slide.iter(f"{SLIDES}pic"))


def slides(files: DataFrame) -> DataFrame:
    """(path, slide_number, lines, tables, n_images) of presentations, in their order. Pictures are only counted."""
    return parsed(files, "slide_number int, lines array<string>, tables array<array<array<string>>>, n_images int", _slides)


def slide_lines(slides_: DataFrame) -> DataFrame:
    """(path, slide_number, lines, has_text): text lines, then valid tables as Markdown; lines that look like noise
    and repeated ones are dropped."""
    tables = F.transform(F.filter("tables", text.table_valid), text.table_markdown)
    lines = F.filter(F.concat("lines", tables), lambda x: text.ocr_line_valid(x))
    return slides_.select("path", "slide_number", _once(lines).alias("lines"), (F.size("lines") > 0).alias("has_text"))


def _once(lines: Column) -> Column:
    """Lines without those that repeat an earlier one but for case and outer blanks."""
    keys = F.transform(lines, lambda x: F.lower(F.trim(x)))
    return F.filter(lines, lambda x, i: F.array_position(keys, F.get(keys, i)) == i + 1)


def _sheet_rows(content: bytes):
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        links, names = _linked(archive, "xl/workbook.xml"), set(archive.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in s.iter(f"{SHEETS}t")) for s in ElementTree.fromstring(archive.read("xl/sharedStrings.xml")).iter(f"{SHEETS}si")]
        for sheet in ElementTree.fromstring(archive.read("xl/workbook.xml")).iter(f"{SHEETS}sheet"):
            for row in ElementTree.fromstring(archive.read(links[sheet.get(f"{LINKS}id")])).iter(f"{SHEETS}row"):
                cells: dict[int, str] = {}
                for k, cell in enumerate(row.iter(f"{SHEETS}c")):
                    letters = re.match("[A-Z]*", cell.get("r") or "")[0]
                    at = k if not letters else sum((ord(c) - 64) * 26**n for n, c in enumerate(reversed(letters))) - 1
                    value = cell.findtext(f"{SHEETS}v") or ""
                    kind = cell.get("t")
                    cells[at] = shared[int(value)] if kind == "s" else "".join(t.text or "" for t in cell.iter(f"{SHEETS}t")) if kind == "inlineStr" else value
                yield sheet.get("name"), int(row.get("r") or 0), [cells.get(k, "") for k in range(max(cells, default=-1) + 1)]


def encrypted(content: Column) -> Column:
    """Whether a spreadsheet's first 256 KiB name the parts of an encrypted package."""
    head = F.lower(F.decode(F.substring(content, 1, 262144), "ISO-8859-1"))
    return F.coalesce(*(F.when(head.contains(mark), F.lit(True)) for mark in ENCRYPTED), F.lit(False))


def sheet_rows(files: DataFrame, most_bytes: int = 1 << 30) -> DataFrame:
    """(path, sheet, row_no, cells) of spreadsheets that are neither encrypted nor larger than ``most_bytes``."""
    open_ = files.where(~encrypted(F.col("content")) & (F.length("content") <= most_bytes))
    return parsed(open_, "sheet string, row_no int, cells array<string>", _sheet_rows)


def sheet_file(base: Column, sheet: Column) -> Column:
    """File name of a sheet's CSV; other than letters, digits, blank, hyphen and underscore become underscores."""
    return F.concat(base, F.lit("_"), F.trim(F.regexp_replace(sheet, r"[^\p{L}\p{N} _-]", "_")), F.lit(".csv"))


_TEXT_OPERATOR = re.compile(rb"\((?:[^()\\]|\\.)*\)|<[0-9A-Fa-f\s]*>|\[|\]|TJ|Tj|T\*|Td|TD|Tm|BT|ET|'|\"|-?\d*\.?\d+", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"", b"f": b""}


def _literal(token: bytes) -> str:
    if token[:1] == b"<":
        digits = re.sub(rb"\s", b"", token[1:-1])
        data = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
        return data[2:].decode("utf-16-be", "replace") if data[:2] == b"\xfe\xff" else data.decode("latin-1")

    def plain(m):
        body = m[1]
        return bytes([int(body, 8) & 255]) if body[:1].isdigit() else _ESCAPES.get(body, body)

    return re.sub(rb"\\([0-7]{1,3}|.)", plain, token[1:-1], flags=re.S).decode("latin-1")


def _page_text(stream: bytes) -> str:
    out, inside = [], False
    for m in _TEXT_OPERATOR.finditer(stream):
        token = m[0]
        if token[:1] in b"(<":
            out.append(_literal(token))
        elif token in (b"[", b"]"):
            inside = token == b"["
        elif inside and token[:1] in b"-0123456789." and float(token) < -200:
            out.append(" ")  # a wide gap between the parts of a line
        elif token in (b"T*", b"Td", b"TD", b"Tm", b"'", b'"', b"ET"):
            out.append("\n")
    return re.sub(r"\n\s*", "\n", "".join(out)).strip()


def _pdf_pages(content: bytes):
    objects = {int(m[1]): m[2] for m in re.finditer(rb"(?<!\d)(\d+)\s+\d+\s+obj\b(.*?)\bendobj", content, re.S)}

    def stream(body: bytes) -> bytes:
        m = re.search(rb"stream\r?\n(.*?)\r?\n?endstream", body, re.S)
        if not m:
            return b""
        return zlib.decompressobj().decompress(m[1]) if b"FlateDecode" in body else m[1]

    number = 0
    for _, body in sorted(objects.items()):
        if not re.search(rb"/Type\s*/Page(?![a-z])", body):
            continue
        number += 1
        at = re.search(rb"/Contents\s*(\[[^\]]*\]|\d+\s+\d+\s+R)", body)
        parts = [stream(objects.get(int(r), b"")) for r in re.findall(rb"(\d+)\s+\d+\s+R", at[1])] if at else []
        yield number, _page_text(b"\n".join(parts))


def pdf_pages(files: DataFrame) -> DataFrame:
    """(path, page_number, text) of PDF files with plain or deflated content streams and simple fonts.

    Object streams, encryption and fonts with their own encodings need a PDF library, and scanned pages OCR; such
    pages come with an empty or garbled text, which the validity filters drop.
    """
    return parsed(files, "page_number int, text string", _pdf_pages)


def images(spark: SparkSession, path: str) -> DataFrame:
    """(path, width, height, channels, data) of images, decoded; of an animation the first frame."""
    read = spark.read.format("image").option("dropInvalid", "true").option("recursiveFileLookup", "true").load(path)
    return read.select(F.col("image.origin").alias("path"), "image.width", "image.height", F.col("image.nChannels").alias("channels"), "image.data")


def _sound(content: bytes):
    with wave.open(io.BytesIO(content)) as w:
        frames, width, channels, rate = w.readframes(w.getnframes()), w.getsampwidth(), w.getnchannels(), w.getframerate()
    if width == 3:
        raw = np.frombuffer(frames, np.uint8).reshape(-1, 3)
        values = (raw[:, 0].astype(np.int32) << 8 | raw[:, 1].astype(np.int32) << 16 | raw[:, 2].astype(np.int32) << 24) >> 8
    else:
        values = np.frombuffer(frames, {1: np.uint8, 2: "<i2", 4: "<i4"}[width]).astype(np.float64) - (128 if width == 1 else 0)
    mono = values.reshape(-1, channels).mean(1) / float(1 << (8 * width - 1))
    yield rate, len(mono) / rate, mono.astype(np.float32).tolist()


def sounds(files: DataFrame) -> DataFrame:
    """(path, rate, seconds, samples) of WAV files, mixed down to one channel of -1 to 1."""
    return parsed(files, "rate int, seconds double, samples array<float>", _sound)


def heads(files: DataFrame, size: int = 131_072) -> DataFrame:
    """(path, head): the first ``size`` bytes of each file, as text without a broken last line."""
    head = F.decode(F.substring("content", 1, size), "UTF-8")
    whole = F.length("content") <= size
    return files.select("path", F.when(whole, head).otherwise(F.regexp_replace(head, r"\n[^\n]*$", "")).alias("head"))


def header_and_sample(heads_: DataFrame, rows: int = 10) -> DataFrame:
    """(path, header, header_tokens, sample_tokens): the first line, and the mean tokens of the first rows after it."""
    lines = F.filter(F.split("head", r"\r?\n"), lambda x: F.trim(x) != "")
    counts = F.transform(F.slice(lines, F.lit(2), F.lit(rows)), lambda x: text.token_count(x))
    mean = F.when(F.size(counts) > 0, F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x) / F.size(counts)).otherwise(0.0)
    header = F.coalesce(F.get(lines, F.lit(0)), F.lit(""))
    return heads_.select("path", header.alias("header"), text.token_count(header).alias("header_tokens"), mean.alias("sample_tokens"))


def is_remote(body: Column) -> Column:
    """Whether a page's body is nothing but an address."""
    return F.trim(body).rlike(r"\Ahttps?://\S+\z")


def fetched(pages: DataFrame, body: str, fetch: Callable[[str], str], attempts: int = 3, wait: float = 1.0) -> DataFrame:
    """Pages with an address as body get what ``fetch`` returns, null if it keeps failing; waits double."""
    at = pages.columns.index(body)

    def load(address: str) -> str | None:
        for k in range(attempts):
            try:
                return fetch(address)
            except OSError:
                if k + 1 < attempts:
                    time.sleep(wait * 2**k)
        return None

    def run(batches):
        for batch in batches:
            columns = list(batch.columns)
            columns[at] = pa.array([load(b.strip()) for b in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    remote = F.coalesce(is_remote(F.col(body)), F.lit(False))
    return pages.where(~remote).unionByName(pages.where(remote).mapInArrow(run, pages.schema))
