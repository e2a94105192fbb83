"""Parsers over raw bytes, on files made here."""

import io
import struct
import wave
import zipfile
import zlib

import numpy as np
from pyspark.sql import functions as F

from chunkloom.sources import formats, readers

A = 'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:p="http://schemas.openxmlformats.org/presentationml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
RELS = '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{}</Relationships>'


def archive(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in parts.items():
            z.writestr(name, body)
    return out.getvalue()


def deck():
    shape = lambda *lines: "<p:sp><p:txBody>" + "".join(f"<a:p><a:r><a:t>{x}</a:t></a:r></a:p>" for x in lines) + "</p:txBody></p:sp>"
    cell = lambda x: f"<a:tc><a:txBody><a:p><a:r><a:t>{x}</a:t></a:r></a:p></a:txBody></a:tc>"
    table = "<p:graphicFrame><a:tbl>" + "".join(f"<a:tr>{cell(a)}{cell(b)}</a:tr>" for a, b in (("name", "kind"), ("one", "two"))) + "</a:tbl></p:graphicFrame>"
    return archive({
        "ppt/presentation.xml": f'<p:presentation {A}><p:sldIdLst><p:sldId id="1" r:id="r2"/><p:sldId id="2" r:id="r1"/></p:sldIdLst></p:presentation>',
        "ppt/_rels/presentation.xml.rels": RELS.format('<Relationship Id="r1" Target="slides/b.xml"/><Relationship Id="r2" Target="slides/a.xml"/>'),
        "ppt/slides/a.xml": f"<p:sld {A}>{shape('First title', 'first TITLE', '***', 'More words')}<p:pic/></p:sld>",
        "ppt/slides/b.xml": f"<p:sld {A}>{shape('Second title')}{table}</p:sld>",
    })


def book():
    s = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    return archive({
        "xl/workbook.xml": f'<workbook {s}><sheets><sheet name="A/b" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": RELS.format('<Relationship Id="r1" Target="worksheets/s.xml"/>'),
        "xl/sharedStrings.xml": f"<sst {s}><si><t>name</t></si><si><r><t>ri</t></r><r><t>ch</t></r></si></sst>",
        "xl/worksheets/s.xml": f'<worksheet {s}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row r="3"><c r="B3"><v>4.5</v></c><c r="AA3" t="inlineStr"><is><t>far</t></is></c></row></sheetData></worksheet>',
    })


def pdf():
    body = zlib.compress(b"BT /F1 12 Tf (Hello \\(PDF\\)) Tj 0 -14 Td [(wor) -10 (ld) -400 (again)] TJ ET")
    return b"%PDF-1.4\n1 0 obj << /Type /Page /Contents 2 0 R >> endobj\n2 0 obj << /Filter /FlateDecode >> stream\n" + body + b"\nendstream endobj\n3 0 obj << /Type /Pages >> endobj\n4 0 obj << /Type /Page /Contents [5 0 R] >> endobj\n5 0 obj << >> stream\nBT (Second) Tj ET\nendstream endobj\n"


def png(width, height):
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    rows = b"".join(b"\0" + b"\x10\x20\x30" * width for _ in range(height))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def sound():
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(2)
        w.setsampwidth(2)
        w.setframerate(8000)
        w.writeframes(np.array([[16384, 0], [-16384, -16384]], "<i2").tobytes())
    return out.getvalue()


def test_formats(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for name, content in {"d.pptx": deck(), "broken.pptx": b"PK??", "b.xlsx": book(), "e.xlsx": b"PK EncryptedPackage", "p.pdf": pdf(), "i.png": png(3, 2), "s.wav": sound(), "s.wav.manifest.json": b"{}", "n.wav": b"none"}.items():
        (raw / name).write_bytes(content)
    (raw / "c.csv").write_text("a,b c\n1,2 3\n4,5\n" + "x," * 100_000)
    objects = readers.raw_objects(spark, str(raw), content=True, digest=True)
    assert objects.count() == 9 and objects.where("length(digest) = 64").count() == 9
    of = lambda ext: objects.where(objects.ext == ext)
    slides = formats.slides(of("pptx"))
    assert [(r.slide_number, r.lines, r.n_images) for r in slides.orderBy("slide_number").collect()] == [(1, ["First title", "first TITLE", "***", "More words"], 1), (2, ["Second title"], 0)]
    lines = {r.slide_number: r.lines for r in formats.slide_lines(slides).collect()}
    # a Markdown table is mostly marks, so the noise filter that all lines pass drops a small one
    assert lines[1] == ["First title", "More words"] and lines[2][0] == "Second title"
    rows = [(r.sheet, r.row_no, r.cells) for r in formats.sheet_rows(of("xlsx")).orderBy("row_no").collect()]
    assert rows[0] == ("A/b", 1, ["name", "", "rich"]) and rows[1][1] == 3 and rows[1][2][1] == "4.5" and rows[1][2][26] == "far"
    assert [(r.page_number, r.text) for r in formats.pdf_pages(of("pdf")).orderBy("page_number").collect()] == [(1, "Hello (PDF)\nworld again"), (2, "Second")]
    (image,) = formats.images(spark, str(raw / "i.png")).collect()
    assert (image.width, image.height, image.channels) == (3, 2, 3) and bytes(image.data)[:3] == b"\x30\x20\x10"
    (wav,) = formats.sounds(of("wav")).collect()
    assert (wav.rate, wav.samples) == (8000, [0.25, -0.5]) and wav.seconds == 2 / 8000
    (head,) = formats.header_and_sample(formats.heads(of("csv"))).collect()
    assert (head.header, head.header_tokens, head.sample_tokens) == ("a,b c", 2, 1.5)
    assert {r.path.rpartition("/")[2] for r in readers.of_kind(objects, readers.AUDIO).collect()} == {"s.wav", "n.wav"}
    assert readers.of_kind(objects, readers.IMAGES).count() == 1 and readers.chunk_paths(spark, str(raw)).count() == 0


def test_remote_pages(spark):
    pages = spark.createDataFrame([(1, "<p>own</p>"), (2, " https://x.example/a "), (3, "https://x.example/gone"), (4, None)], "page_id long, html string")

    def fetch(address):
        if address.endswith("gone"):
            raise OSError
        return f"<p>{address[-1]}</p>"

    got = {r.page_id: r.html for r in formats.fetched(pages, "html", fetch, attempts=2, wait=0.0).collect()}
    assert got == {1: "<p>own</p>", 2: "<p>a</p>", 3: None, 4: None}
    assert formats.fetched(pages.where("page_id = 1"), "html", fetch).count() == 1
    assert pages.where(formats.is_remote(F.col("html"))).count() == 2
