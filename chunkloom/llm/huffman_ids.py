"""Token ids in files, coded by a canonical length-limited Huffman code.

The code's lengths come from the counts of all ids of the corpus, by package-merge; codes are numbered by
length and id, so the lengths are all that a reader needs. A file holds segments: some documents' ids one
after another, coded as one string of bits, with the bit at which each block of ids begins. Blocks are
decoded independently of each other, so a reader decodes a segment's blocks side by side, each by the same
table that has an entry for every string of as many bits as the longest code.

Files are written by Spark's committed writer into one folder: ``segments`` (in the documents' order, by
``part`` and ``seq``) and ``code`` (the code's lengths).
"""

from __future__ import annotations

import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from .common import Shipped, checkpoint_dir, cut, once

END = 0
#: Bits of the longest code, unless the ids need more; ids of a block; ids of a segment, but for one document that has more.
LIMIT, BLOCK, SEGMENT = 18, 256, 1 << 20
#: Pieces of text whose ids are remembered, in each of two generations, and the longest of them.
CACHED, CACHED_CHARS = 500_000, 40
#: What may end a word: after a letter it is encoded by itself, unless more of its kind follows.
STOPS = frozenset(".,;:!?")
#: Pieces that are encoded as one text.
JOINED = 4000
#: Longer texts are encoded in parts that end before a space.
PART_CHARS = 1 << 20


class Encoder:
    """The ids of the tokenizers library, with the ids of pieces of text remembered.

    A byte-level tokenizer that cuts texts by the usual pattern never joins what a single space parts, so the
    pieces between spaces, and between lines, can be encoded apart. Texts with runs of white space are encoded whole.
    """

    def __init__(self, tokenizer_file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks use the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.kind = "<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        self.apart = '"ByteLevel"' in str(self.tokenizer.pre_tokenizer) or "ByteLevel(" in str(self.tokenizer.pre_tokenizer)
        self.apart = self.apart and self.tokenizer.normalizer is None and "add_prefix_space=True" not in str(self.tokenizer.pre_tokenizer)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # the bytes of each id, as a byte-level vocabulary writes each byte as a character
        self.bytes = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), np.int64)
        for piece, k in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.bytes[k] = len(piece)
        self.numbers, self.ids = _Numbers(), []
        self.old: dict[str, bytes | None] = {}
        self.end, self.stops = self.packed([END]), {c: self.whole(c) for c in STOPS}

    def packed(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def whole(self, text: str) -> bytes:
        return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def learn(self) -> None:
        """Fills in the ids of the pieces that were numbered last; None for those that have other white space around them."""
        names, numbers, ids, old, new, stopped = self.numbers.new, self.numbers, self.ids, self.old, [], []
        for p in names:  # which grows by words without the stops after them
            at = len(ids)
            ids.append(known := old.get(p))
            if known is not None or not p:
                continue
            if p[-1] in STOPS and len(p) > 1 and p[-2].isalpha():
                stopped.append((at, numbers[p[:-1]], p[-1]))
            elif (core := p[1:] if p[0] == "\n" else p) and core == core.strip():
                new.append((at, p if p[0] == "\n" else " " + p))
        for k in range(0, len(new), JOINED):
            own = new[k : k + JOINED]
            for (at, _), encoded in zip(own, self.apart_of([p for _, p in own]), strict=True):
                ids[at] = encoded
        for at, word, stop in stopped:
            if ids[word] is not None:
                ids[at] = ids[word] + self.stops[stop]
        names.clear()

    def apart_of(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece: of their concatenation, which is cut where a piece's bytes end."""
        text = "".join(pieces)
        if not any(a in text for a in self.added):
            (encoded,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
            ids = np.array(encoded.ids, self.kind)
            ends, wanted = np.cumsum(self.bytes[ids]), np.cumsum([len(p.encode()) for p in pieces])
            at = np.minimum(np.searchsorted(ends, wanted), len(ids) - 1)
            if (ends[at] == wanted).all():
                raw, width = ids.tobytes(), ids.itemsize
                cuts = [0, *((at + 1) * width).tolist()]
                return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        return [self.packed(e.ids) for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def forget(self) -> None:
        if len(self.ids) > CACHED:
            self.old = {p: self.ids[n] for p, n in self.numbers.items() if len(p) <= CACHED_CHARS}
            self.numbers, self.ids = _Numbers(), []

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian integers, END last; null counts as empty."""
        out, work, number = [], [], self.numbers.__getitem__
        for text in texts:
            if not text or not self.apart or len(text) > PART_CHARS or ("\n\n" in text and ("\n\n\n" in text or "\n\n " in text or text.endswith("\n\n"))):
                out.append((self.parts(text) if text else b"") + self.end)
                continue
            first, *rest = text.replace("\n", " \n").split(" ")
            work.append((len(out), text, first, list(map(number, rest))))
            out.append(b"")
        self.learn()
        known = self.ids.__getitem__
        for at, text, first, rest in work:
            try:
                out[at] = (self.whole(first) if first else b"") + b"".join(map(known, rest)) + self.end
            except TypeError:  # a piece without ids of its own
                out[at] = self.whole(text) + self.end
        self.forget()
        return out

    def parts(self, text: str) -> bytes:
        """A long text in parts that begin with a space between two characters that aren't white space."""
        if not self.apart:
            return self.whole(text)
        out, at = [], 0
        while at < len(text):
            end = at + PART_CHARS
            while end < len(text) and not (text[end] == " " and not text[end - 1].isspace() and end + 1 < len(text) and not text[end + 1].isspace()):
                end += 1
            out.append(self.whole(text[at:end]))
            at = end
        return b"".join(out)


class _Numbers(dict):
    """Numbers of pieces in the order they are met; those that ``new`` holds have no ids yet."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self.new.append(piece)
        self[piece] = number = len(self)
        return number


def encoder(tokenizer_file: str) -> Encoder:
    return once(("tokenizers", tokenizer_file), lambda: Encoder(tokenizer_file))


def encode(docs: DataFrame, tokenizer_file: str, id_col: str, text_col: str) -> DataFrame:
    """(id, mark, ids): each document's ids as little-endian integers of 2 or 4 bytes, END last; marks tell equal rows apart."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("mark", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(encoder(tokenizer_file).encode(batch.column(2).to_pylist()), pa.binary())], names=schema.names)

    return docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("mark"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def width_of(tokenizer_file: str) -> str:
    return encoder(tokenizer_file).kind


def counts(encoded: DataFrame, kind: str) -> dict[int, int]:
    """How often each id occurs; a row for each id and task is shuffled, and one for each id collected."""

    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            own = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind))
            if len(own) > len(total):
                total, own = own, total
            total[: len(own)] += own
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], names=["token", "n"])

    rows = encoded.select("ids").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    return {r.token: r.n for r in rows}


def code_lengths(weights: np.ndarray, limit: int) -> np.ndarray:
    """Lengths of a code with the least total length of which none exceeds ``limit``, by package-merge.

    Each level's list has all symbols and the pairs of the list before, by weight. Of the last level 2n - 2
    entries are taken; pairs among them take as many pairs from the level before, and so on.
    """
    n = len(weights)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols need more than {limit} bits")
    order = np.argsort(weights, kind="stable")
    leaves, levels, pairs = weights[order].astype(np.float64), [], np.zeros(0)
    for _ in range(limit):
        merged = np.concatenate([leaves, pairs])
        by = np.argsort(merged, kind="stable")
        levels.append(by < n)  # whether an entry is a symbol
        merged = merged[by]
        pairs = merged[0 : len(merged) // 2 * 2 : 2] + merged[1::2][: len(merged) // 2]
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for symbols in reversed(levels):
        own = int(symbols[:take].sum())
        lengths[order[:own]] += 1
        take = 2 * (take - own)
    return lengths


class Code:
    """Canonical codes of ``lengths`` (0: no code), numbered by length and id, with the table that decodes them."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.bits = int(self.lengths.max(initial=1))
        used = np.flatnonzero(self.lengths)
        order = used[np.lexsort((used, self.lengths[used]))]
        spans = np.int64(1) << (self.bits - self.lengths[order])  # how many entries of the table begin with the code
        first = np.concatenate([[0], np.cumsum(spans)[:-1]]).astype(np.int64) if len(order) else np.zeros(0, np.int64)
        self.codes = np.zeros(len(self.lengths), np.uint64)
        self.codes[order] = (first >> (self.bits - self.lengths[order])).astype(np.uint64)
        size = 1 << self.bits
        self.table = np.ones(size, np.int64)  # the id and the length of its code, in 5 bits
        self.table[: int(spans.sum())] = np.repeat(order << 5 | self.lengths[order], spans)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The ids' bits, and the bits at which the blocks begin."""
        if not len(ids):
            return b"", np.zeros(0, np.int64)
        size = self.lengths[ids]
        end = np.cumsum(size)
        start = end - size
        word = start >> 5
        wide = self.codes[ids] << (64 - size - (start & 31)).astype(np.uint64)  # a code lies in a word of 32 bits and the next
        n = int(end[-1] + 31 >> 5) + 1
        # bits of different codes don't overlap, so sums are unions, and exact in double precision
        words = np.bincount(word, (wide >> np.uint64(32)).astype(np.float64), n) + np.bincount(word + 1, (wide & np.uint64(0xFFFFFFFF)).astype(np.float64), n)[:n]
        return words.astype(">u4").tobytes()[: int(end[-1] + 7 >> 3)], start[::BLOCK]

    def decode(self, payload: bytes, starts: np.ndarray, n: int) -> np.ndarray:
        """``n`` ids whose blocks begin at the bits ``starts``: one id of each block at a time."""
        raw = np.frombuffer(payload + bytes(4 * BLOCK), np.uint8).astype(np.uint32)  # the last block, which is shorter, may be read beyond its end
        ahead = ((raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]).astype(np.int64)  # the 32 bits from each byte on
        at = np.array(starts, np.int64)
        out = np.empty((min(BLOCK, n), len(at)), np.uint32)
        mask, shift = (1 << self.bits) - 1, 32 - self.bits
        for k in range(len(out)):
            entry = self.table[(ahead[at >> 3] >> (shift - (at & 7))) & mask]
            out[k] = entry >> 5
            at += entry & 31
        return np.ascontiguousarray(out.T).ravel()[:n]


def code_of(found: dict[int, int], limit: int = LIMIT) -> np.ndarray:
    """Lengths by id. The limit is raised where the ids need it; 25 bits are what the table's decoder can read at once."""
    tokens = np.array(sorted(found), np.int64)
    lengths = np.zeros(int(tokens.max(initial=0)) + 1, np.uint8)
    needed = max(1, (len(tokens) - 1).bit_length())
    if needed > 25:
        raise ValueError("more different ids than a table can decode")
    lengths[tokens] = code_lengths(np.array([found[t] for t in tokens.tolist()], np.int64), max(limit, needed))
    return lengths


def write(docs: DataFrame, tokenizer_file: str, folder: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> None:
    """Encode every text and write the ids in ascending order of the documents' ids.

    Null ids come first; rows that repeat an id follow each other. Tasks are bounded by id and row, so that no
    id, however often it repeats, has to fit one task. An empty table gives a folder without segments.
    """
    spark = docs.sparkSession
    encoded = cut(encode(docs, tokenizer_file, id_col, text_col))
    kind = width_of(tokenizer_file)
    lengths = code_of(counts(encoded, kind), limit)
    spark.createDataFrame([(bytearray(lengths.tobytes()), kind)], "lengths binary, kind string").coalesce(1).write.parquet(f"{folder}/code")
    sent = Shipped(spark, lengths)
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("seq", T.IntegerType()), T.StructField("first", T.LongType()), T.StructField("n", T.LongType()), T.StructField("docs", T.ArrayType(encoded.schema["id"].dataType)), T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("starts", T.ArrayType(T.LongType())), T.StructField("payload", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        code, seq, first = sent.built(Code), 0, 0
        names, parts, n, part = [], [], 0, None

        def segment():
            ids = np.frombuffer(b"".join(parts), kind)
            payload, starts = code.encode(ids)
            width = np.dtype(kind).itemsize
            row = {"part": part, "seq": seq, "first": first, "n": len(ids), "docs": names, "sizes": [len(p) // width for p in parts], "starts": starts.tolist(), "payload": payload}
            return pa.RecordBatch.from_pylist([row], arrow)

        for batch in batches:
            for part, name, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):  # noqa: B007
                if n and n + len(ids) // np.dtype(kind).itemsize > SEGMENT:
                    yield segment()
                    seq, first, names, parts, n = seq + 1, first + n, [], [], 0
                names.append(name)
                parts.append(ids)
                n += len(ids) // np.dtype(kind).itemsize
        if n:
            yield segment()

    dealt = encoded.repartitionByRange("id", "mark").sortWithinPartitions("id", "mark")
    dealt.select(F.spark_partition_id().alias("part"), "id", "ids").mapInArrow(run, schema).write.parquet(f"{folder}/segments")


def read(spark: SparkSession, folder: str, id_col: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """One row per document of the files: start, n_tokens, ids_crc32 and, with ``keep_ids``, ids.

    start counts the ids of all documents before, the end ids included. ids_crc32 is of the ids as little-endian
    unsigned integers of 32 bits.
    """
    code = spark.read.parquet(f"{folder}/code").first()
    segments = spark.read.parquet(f"{folder}/segments")
    base, before = {}, 0
    for r in sorted(segments.groupBy("part").agg(F.sum("n").alias("n")).collect()):  # a row for each file
        base[r.part], before = before, before + r.n
    sent = Shipped(spark, (base, np.frombuffer(bytes(code.lengths), np.uint8)))
    kind = segments.schema["docs"].dataType.elementType
    schema = T.StructType([T.StructField(id_col, kind), *T.StructType.fromDDL("start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if keep_ids else ""))])
    name_type = to_arrow_type(kind)

    def run(batches):
        base, code = sent.built(lambda v: (v[0], Code(v[1])))
        for batch in batches:
            for row in batch.to_pylist():
                ids = code.decode(row["payload"], row["starts"], row["n"]).astype("<u4", copy=False)
                ends = np.cumsum(row["sizes"])
                begins = ends - row["sizes"]
                columns = [pa.array(row["docs"], name_type), pa.array(base[row["part"]] + row["first"] + begins), pa.array(row["sizes"], pa.int64()), pa.array([zlib.crc32(ids[a:b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)], pa.int64())]
                if keep_ids:
                    columns.append(pa.array([ids[a:b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return segments.select("part", "first", "n", "docs", "sizes", "starts", "payload").mapInArrow(run, schema)


def write_and_read(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """``read`` of what ``write`` has written into a new folder of the shared checkpoint folder.

    A null text counts as empty and has the end id alone. Texts of any length are encoded whole. Repeated rows each
    give their row, ids may be null, an empty table gives no rows; further columns and their names don't matter.
    Of rows that repeat an id the order is arbitrary.
    """
    spark = docs.sparkSession
    folder = f"{checkpoint_dir(spark)}/token-ids-{uuid.uuid4().hex}"
    write(docs, tokenizer_file, folder, id_col, text_col)
    return read(spark, folder, id_col, keep_ids)
