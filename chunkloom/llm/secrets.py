"""Secret scans with a worklist of decoded layers.

A text is layer 0. Every layer is scanned for the three kinds and unwrapped: URL escapes, Unicode and
character escapes, base64 runs on one line or several, runs of hex digits, and compressed data inside
either. Of URL escapes what is valid UTF-8 is decoded, the rest stays. Escapes give three layers: URL escapes
decoded once, the others decoded once, and all decoded until none is left, in one pass over the layer, as each
character that a decoding gives is looked at together with those around it. A layer knows only the spans of
stretches that were changed; layers seen before are not queued again, so the list empties. Packed data is read
to its end: all members, and packed data in packed data to any depth. Findings of deeper layers are reported at
the span of the text they were unwrapped from.
"""

from __future__ import annotations

import base64
import binascii
import codecs
import hashlib
import re
import zlib
from bisect import bisect_right

from pyspark.sql import DataFrame

from .common import map_texts

# Fixed values of the contract.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20

URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}(?:\r?\n[\x20\t]*[A-Za-z0-9+/_-]{16,}){0,}\r?\n[\x20\t]*[A-Za-z0-9+/_-]+={0,2}")
HEX_BYTES = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-f]{2}){16,}(?![0-9A-Za-z])|(?<![0-9A-Za-z])(?:[0-9A-F]{2}){16,}(?![0-9A-Za-z])")
HEXES = "[0-9A-Fa-f]"
#: Where an escape may begin, an escape that ends here, and the beginning of one, which may need what follows.
TRIGGER = re.compile(r"[%&\\]")
ENDING = re.compile(rf"(?:%{HEXES}{{2}}|\\x{HEXES}{{2}}|\\u{HEXES}{{4}}|\\U{HEXES}{{8}}|\\u\{{{HEXES}{{1,6}}\}}|&#[0-9]{{1,7}};|&#[xX]{HEXES}{{1,6}};)\Z")
BEGUN = re.compile(rf"(?:%{HEXES}?|\\(?:x{HEXES}?|u{HEXES}{{0,3}}|u\{{{HEXES}{{0,6}}|U{HEXES}{{0,7}})?|&(?:#(?:[0-9]{{0,7}}|[xX]{HEXES}{{0,6}}))?)\Z")
LONGEST = 11
#: Parts of a run of base64 digits that a path or a name may have put before a blob, and the digits that show whether a blob begins.
JOINTS, LEAST_BLOB, SHOWN = re.compile("[/_-]"), 16, 64
#: Packed bytes fed to a decompressor at once.
CHUNK = 4096


class Whole:
    """Spans of a layer unwrapped from one blob: each character has the blob's."""

    def __init__(self, span: tuple[int, int]):
        self.span = span

    def locate(self, start: int, end: int) -> tuple[int, int]:
        return self.span


class Itself:
    """Spans of the text."""

    def locate(self, start: int, end: int) -> tuple[int, int]:
        return start, end


class Changed:
    """Spans of a layer that was decoded in place: stretches (place here, first place there, end there or -1 if copied)."""

    def __init__(self, under, stretches: list[tuple[int, int, int]]):
        self.under, self.stretches = under, stretches
        self.at = [s[0] for s in stretches]

    def _one(self, k: int) -> tuple[int, int]:
        at, first, end = self.stretches[bisect_right(self.at, k) - 1]
        return (first, end) if end >= 0 else (first + k - at, first + k - at + 1)

    def locate(self, start: int, end: int) -> tuple[int, int]:
        return self.under.locate(self._one(start)[0], self._one(end - 1)[1])


def scan(text: str) -> list[tuple[str, int, int]]:
    """Base findings of one layer as (kind, start, end)."""
    out = []
    if "=" in text or ":" in text:
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return out


def _escaped_again(error: UnicodeDecodeError) -> tuple[str, int]:
    return "".join(f"%{b:02X}" for b in error.object[error.start : error.end]), error.end


codecs.register_error("chunkloom-percent", _escaped_again)


def _percent(match: str) -> str:
    return bytes.fromhex(match.replace("%", "")).decode(errors="chunkloom-percent")


def _escape(match: str) -> str | None:
    try:
        if match.startswith("&#"):
            digits = match[2:-1]
            return chr(int(digits[1:], 16) if digits[0] in "xX" else int(digits))
        if match[:3] == "\\u{":
            return chr(int(match[3:-1], 16))
        if match[1] in "xU":
            return chr(int(match[2:], 16))
        units = bytes.fromhex(match.replace("\\u", ""))
        return units.decode("utf-16-be")
    except (ValueError, OverflowError):
        return None


def _readable(data: bytes) -> str | None:
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    odd = sum(not (c.isprintable() or c in "\t\r\n") for c in text)
    return text if text and odd <= len(text) // 20 else None


def _opened(data: bytes, at: int):
    """A decompressor for the member that begins at ``at``, or None."""
    head = data[at : at + 4]
    if head.startswith(b"\x1f\x8b"):
        return zlib.decompressobj(31)
    if head.startswith(b"\x78"):
        return zlib.decompressobj(15)
    if head.startswith(b"BZh"):
        import bz2

        return bz2.BZ2Decompressor()
    if head == b"\x28\xb5\x2f\xfd":
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj()
    return None


def _unpacked(data: bytes) -> bytes | None:
    """The contents of all members in a row; None if the data begins with none, or with a broken one."""
    parts, at = None, 0
    while at < len(data):
        if data[at + 1 : at + 4] == b"\x2a\x4d\x18" and data[at] >> 4 == 5:  # a zstd frame to be skipped
            at += 8 + int.from_bytes(data[at + 4 : at + 8], "little")
            parts = parts or []
            continue
        member, own = _opened(data, at), []
        if member is None:
            break
        try:
            while not member.eof and at < len(data):
                own.append(member.decompress(data[at : at + CHUNK]))
                at = min(at + CHUNK, len(data))
        except Exception as e:  # each library has its own error
            if isinstance(e, MemoryError):
                raise
            break
        at -= len(member.unused_data)
        parts = parts or []
        parts.append(b"".join(own))
    return None if parts is None else b"".join(parts)


def _blob(run: str) -> str | None:
    body = run.rstrip("=")
    if len(body) % 4 == 1:
        return None
    try:
        data = base64.b64decode(body.replace("-", "+").replace("_", "/") + "=" * (-len(body) % 4))
    except (binascii.Error, ValueError):
        return None
    return _contents(data)


def _hex_blob(run: str) -> str | None:
    return _contents(bytes.fromhex(run))


def _contents(data: bytes) -> str | None:
    """The text that the bytes are, packed any number of times."""
    seen = set()
    while (inner := _unpacked(data)) is not None:  # compressed data inside compressed data
        seen.add(hashlib.sha256(data).digest())
        data = inner
        if hashlib.sha256(data).digest() in seen:  # it holds itself
            break
    return _readable(data)


def _inner_blob(run: str) -> tuple[int, int, str] | None:
    """A blob in a run of base64 digits that has something else before or after it, as in a path."""
    end = len(run.rstrip("="))
    joints = [m.start() for m in JOINTS.finditer(run, 0, end)]
    failed = set()  # what is unreadable from one place is so from later ones that share its groups of four
    for at in (j + 1 for j in joints):
        if end - at < LEAST_BLOB or at % 4 in failed or not _begins(run[at : min(end, at + SHOWN)]):
            continue
        inner = _blob(run[at:])
        if inner is not None:
            return at, len(run), inner
        failed.add(at % 4)
    for a, b in zip([-1, *joints], [*joints, end], strict=True):
        if b - a > LEAST_BLOB and (a >= 0 or b < end) and _begins(run[a + 1 : min(b, a + 1 + SHOWN)]):
            inner = _blob(run[a + 1 : b])
            if inner is not None:
                return a + 1, b, inner
    return None


def _begins(digits: str) -> bool:
    """Whether the digits may be the beginning of readable or packed data."""
    digits = digits[: len(digits) // 4 * 4]
    data = base64.b64decode(digits.replace("-", "+").replace("_", "/"))
    if _opened(data, 0) is not None:
        return True
    text = codecs.getincrementaldecoder("utf-8")("strict")
    try:
        shown = text.decode(data)
    except UnicodeDecodeError:
        return False
    return all(c.isprintable() or c in "\t\r\n" for c in shown)


def _blobs(layer: str):
    """(start, end, contents) of the blobs of a layer."""
    for pattern, decode in ((BASE64, _blob), (HEX_BYTES, _hex_blob)):
        for m in pattern.finditer(layer):
            inner = decode(m[0])
            if inner is not None:
                yield *m.span(), inner
            elif pattern is BASE64 and (part := _inner_blob(m[0])):
                yield m.start() + part[0], m.start() + part[1], part[2]
    for m in WRAPPED.finditer(layer) if "\n" in layer else ():
        lines = m[0].split("\n")
        for n in (len(lines), len(lines) - 1):  # the last line may be a word that follows
            inner = _blob("".join(map(str.strip, lines[:n]))) if n > 1 else None
            if inner is not None:
                yield m.start(), m.start() + len("\n".join(lines[:n]).rstrip("\r")), inner
                break


def _once(layer: str, pattern, decode):
    """(start, end, parts) of the matches that ``decode`` changes; parts are (text, start, end)."""
    for m in pattern.finditer(layer):
        new = decode(m[0])
        if new is not None and new != m[0]:
            yield *m.span(), [(new, *m.span())]


def _decoded(escape: str) -> str | int | None:
    """A character, a byte over 127 of a URL escape, or nothing."""
    if escape[0] == "%":
        value = int(escape[1:], 16)
        return chr(value) if value < 128 else value
    digits = escape.strip("\\&#;{}xuUX")
    value = int(digits, 16 if escape[0] == "\\" or escape[2] in "xX" else 10)
    if value > 0x10FFFF or (0xD800 <= value < 0xE000 and (escape[:2] != "\\u" or escape[2] == "{")):
        return None
    return chr(value)


def _to_the_end(layer: str):
    """(start, end, parts) of stretches in which escapes are decoded until none is left.

    Characters are taken one by one while the last ones may become an escape. One that is complete is replaced by
    what it stands for, which may complete another: a chain of nested escapes takes as many steps as it has characters.
    """
    at = 0
    while (m := TRIGGER.search(layer, at)) is not None:
        start = at = m.start()
        out: list[tuple[str | int, int, int]] = []
        changed = False
        while at < len(layer):
            out.append((layer[at], at, at + 1))
            at += 1
            while out[-1][0] in _ENDS:
                tail = "".join(c if isinstance(c, str) else "\uffff" for c, _, _ in out[-LONGEST:])
                done = ENDING.search(tail)
                new = _decoded(done[0]) if done else None
                if new is None:
                    break
                first = out[-len(done[0])][1]
                del out[-len(done[0]) :]
                out.append((new, first, at))
                changed = True
                if isinstance(new, int):
                    break
            tail = "".join(c if isinstance(c, str) else "\uffff" for c, _, _ in out[-LONGEST:])
            half = isinstance(out[-1][0], int) or "\ud800" <= out[-1][0] <= "\udbff"  # of a character, whose other half may follow
            if not BEGUN.search(tail) and not (half and layer[at : at + 1] in ("%", "\\", "&")):
                break
        if changed:
            yield start, at, list(_characters(layer, out))


_ENDS = frozenset("0123456789abcdefABCDEF};")


def _characters(layer: str, out: list[tuple[str | int, int, int]]):
    """Bytes joined to characters, as far as they are UTF-8, and halves of characters to whole ones, else as they were written."""
    k = 0
    while k < len(out):
        c, first, end = out[k]
        n = k + 1
        if isinstance(c, int):
            while n < len(out) and isinstance(out[n][0], int):
                n += 1
            text = bytes(o[0] for o in out[k:n]).decode(errors="chunkloom-percent")
            yield text, first, out[n - 1][2]
        elif "\ud800" <= c <= "\udfff":
            pair = n < len(out) and isinstance(out[n][0], str) and c <= "\udbff" and "\udc00" <= out[n][0] <= "\udfff"
            n += bool(pair)
            end = out[n - 1][2]
            yield (c + out[n - 1][0]).encode("utf-16", "surrogatepass").decode("utf-16") if pair else layer[first:end], first, end
        else:
            yield c, first, end
        k = n


def _changed(layer: str, spans, changes) -> tuple[str, Changed] | None:
    """The layer with the changes, or None if there are none."""
    parts, stretches, at, size = [], [], 0, 0
    for start, end, new in changes:
        if start > at:
            stretches.append((size, at, -1))
            parts.append(layer[at:start])
            size += start - at
        for text, first, last in new:
            stretches.append((size, first, last))
            parts.append(text)
            size += len(text)
        at = end
    if not stretches:
        return None
    if at < len(layer):
        stretches.append((size, at, -1))
        parts.append(layer[at:])
    return "".join(parts), Changed(spans, stretches)


def _layers(text: str):
    """All layers with what locates their characters, the text first; a layer is held only while it is unwrapped."""
    work: list[tuple[str, Whole | Itself | Changed]] = [(text, Itself())]
    seen = set()
    while work:
        layer, spans = work.pop()
        yield layer, spans
        found = []
        if not isinstance(spans, Changed):
            url, escaped = "%" in layer and URL.search(layer), ("\\" in layer or "&#" in layer) and ESCAPE.search(layer)
            found += [_changed(layer, spans, _once(layer, URL, _percent))] if url else []
            found += [_changed(layer, spans, _once(layer, ESCAPE, _escape))] if escaped else []
            found += [_changed(layer, spans, _to_the_end(layer))] if url or escaped else []
        for start, end, inner in _blobs(layer):
            found.append((inner, Whole(spans.locate(start, end))))
        for new in found:
            if new is None or not new[0]:
                continue
            key = hashlib.blake2b(new[0].encode(errors="surrogatepass"), digest_size=16).digest(), new[1].locate(0, len(new[0]))
            if key not in seen:
                seen.add(key)
                work.append(new)


def layers(text: str) -> list[tuple[str, Whole | Itself | Changed]]:
    return list(_layers(text))


def find(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base findings and all findings of a text, each sorted by start, then kind as listed, then end."""
    order = lambda f: (f[1], KINDS.index(f[0]), f[2])
    base = scan(text)
    every = set(base)
    for layer, spans in _layers(text):
        if not isinstance(spans, Itself):
            every.update((kind, *spans.locate(a, b)) for kind, a, b in scan(layer))
    return sorted(base, key=order), sorted(every, key=order)


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of the base findings, their digest, and all spans.

    Spans are ``kind:start:end`` in code points, end exclusive, joined by commas. A null text counts as
    empty and has none; texts of any length are read whole; repeated rows each give their row, ids may be
    null, and an empty table gives none; further columns and their names don't matter. Findings with one
    start come in the order of the kinds. Packed data is unpacked in memory.
    """

    def row(text):
        base, every = find(text or "")
        joined = [",".join(f"{k}:{a}:{b}" for k, a, b in x) for x in (base, every)]
        kinds = [f[0] for f in base]
        digest = hashlib.sha256(joined[0].encode()).hexdigest()
        return (*(kinds.count(k) for k in KINDS), digest, joined[1], len(every) - len(base))

    return map_texts(docs, id_col, text_col, row, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_decoded long")
