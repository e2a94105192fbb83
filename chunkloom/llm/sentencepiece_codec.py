"""SentencePiece BPE encoding and decoding through a merge-type prefix table.

For each prefix of a unit the table holds the one token that ends the prefix's encoding. It is filled
left to right: an Aho-Corasick automaton lists the pieces that end at a position, longest first, and
the first one that is compatible with the token before it is kept. Two tokens are compatible when
merging the characters of their concatenation gives these two tokens. The ids are then read backwards.

No piece has a space mark after another character, nor certain punctuation after anything else, so a
text splits before them into units that are encoded on their own and remembered.
"""

from __future__ import annotations

import hashlib
import re
import string

import numpy as np
from pyspark.sql import DataFrame

from .common import map_texts, once

SPACE = "▁"
LETTER = r"[^\W\d_]"
CACHED_UNITS, CACHED_CHARS = 500_000, 48


class Codec:
    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = sp.get_piece_size()
        self.bos, self.eos, self.unk = sp.bos_id(), sp.eos_id(), sp.unk_id()
        special = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.scores = [sp.get_score(i) for i in range(n)]
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if sp.is_byte(i)}
        self.raw = [p.replace(SPACE, " ").encode() for p in self.pieces]
        for b, i in self.bytes.items():
            self.raw[i] = bytes([b])
        for i in range(n):
            if sp.is_control(i):
                self.raw[i] = b""
        self.raw[self.unk] = " ⁇ ".encode()
        self.is_byte = np.zeros(n, bool)
        self.is_byte[list(self.bytes.values())] = True
        crossing = [p for p in self.ids if SPACE in p.lstrip(SPACE)]
        if crossing:
            raise ValueError(f"pieces cross a space mark: {crossing[:3]}")
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.automaton.add_word(p, (len(p), i))
        self.automaton.make_automaton()
        self.unit = re.compile(self._unit_pattern())
        self.pairs: dict[int, bool] = {}
        self.units = _Units(self)

    def _unit_pattern(self) -> str:
        """A unit starts at space marks, or at punctuation after a letter if no piece has such a pair."""
        letter = re.compile(LETTER)
        joined = {b for p in self.ids for a, b in zip(p, p[1:], strict=False) if letter.match(a)}
        mark = "".join(map(re.escape, sorted(set(string.punctuation) - joined)))
        if not mark:
            return f"{SPACE}+[^{SPACE}\n]*|\n|[^{SPACE}\n]+"
        inner = f"(?:[^{SPACE}\n{mark}]+|(?<!{LETTER})[{mark}])"
        return f"{SPACE}*{inner}+|\n|{SPACE}+|[{mark}]{inner}*"

    def merged(self, text: str) -> list[str]:
        """Merge neighbours, best score first and leftmost among equals, until none can be merged."""
        parts = list(text)
        while True:
            best = None
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.scores[i] > best[0]):
                    best = (self.scores[i], k)
            if best is None:
                return parts
            k = best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def compatible(self, left: int, right: int) -> bool:
        a, b = self.pieces[left], self.pieces[right]
        return self.merged(a + b) == [a, b]

    def encode_unit(self, unit: str) -> list[int]:
        """Ids of one unit. -1 in the table marks a character outside the vocabulary."""
        n, pairs, count = len(unit), self.pairs, len(self.pieces)
        last, size = [-1] * (n + 1), [1] * (n + 1)
        for end, (length, token) in self.automaton.iter(unit):  # at each end the longest comes first
            end += 1
            if last[end] >= 0:
                continue
            start = end - length
            before = last[start]
            if start and before >= 0:
                key = before * count + token
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) > CACHED_UNITS:
                        pairs.clear()
                    fits = pairs[key] = self.compatible(before, token)
                if not fits:
                    continue
            last[end], size[end] = token, length
        out: list[int] = []
        while n:
            if last[n] >= 0:
                out.append(last[n])
            else:
                out.extend(self.bytes.get(b, self.unk) for b in reversed(unit[n - 1].encode()))
            n -= size[n]
        return out[::-1]

    def encode(self, text: str) -> np.ndarray:
        """Ids with begin and end ids, as little-endian unsigned 32-bit integers."""
        return np.frombuffer(self.encode_bytes(text), "<u4")

    def encode_bytes(self, text: str) -> bytes:
        first, end = np.array([self.bos, self.eos], "<u4").tobytes()[:4], np.array([self.eos], "<u4").tobytes()
        if not text:
            return first + end
        if len(self.units) > CACHED_UNITS:
            self.units.clear()
        return first + b"".join(map(self.units.__getitem__, self.unit.findall((SPACE + text).replace(" ", SPACE)))) + end

    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join(map(self.raw.__getitem__, ids.tolist()))
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = self._decode_broken(ids)
        visible = next((i for i in ids.tolist() if i not in (self.bos, self.eos)), None)
        if visible is not None and visible != self.unk and text.startswith(" ") and not self.is_byte[visible]:
            text = text[1:]
        return text

    def _decode_broken(self, ids: np.ndarray) -> str:
        """Byte pieces that don't form UTF-8 give one replacement character a byte."""
        out, run = [], b""
        for i in [*ids.tolist(), None]:
            if i is not None and self.is_byte[i]:
                run += self.raw[i]
                continue
            at = 0
            while at < len(run):
                for width in (1, 2, 3, 4):
                    try:
                        out.append(run[at : at + width].decode())
                        at += width
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    at += 1
            run = b""
            if i is not None:
                out.append(self.raw[i].decode())
        return "".join(out)


class _Units(dict):
    """Encoded units as bytes; long ones are encoded each time, so memory stays bounded."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec

    def __missing__(self, unit: str) -> bytes:
        ids = np.array(self.codec.encode_unit(unit), "<u4").tobytes()
        if len(unit) <= CACHED_CHARS:
            self[unit] = ids
        return ids


def codec(model_file: str) -> Codec:
    return once(("sentencepiece", model_file), lambda: Codec(model_file))


def encode_decode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per document: n_tokens, ids_sha256, decoded_sha256 and, with ``keep_ids``, ids and decoded.

    A null text counts as empty: begin and end id only. Texts of any length are encoded whole, in time
    linear in their length. Repeated rows each give their row; an empty table gives no rows.
    """
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" if keep_ids else ""

    def row(text):
        c = codec(model_file)
        raw = c.encode_bytes(text or "")
        decoded = c.decode(np.frombuffer(raw, "<u4"))
        out = (len(raw) // 4, hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
        return (*out, np.frombuffer(raw, "<i4").tolist(), decoded) if keep_ids else out

    return map_texts(docs, id_col, text_col, row, schema)
