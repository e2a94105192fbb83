"""Language identification by compression.

For each language a raw-content dictionary is filled from labelled texts, each giving an equal share of
pieces drawn from all over it. A text is compressed block by
block with each dictionary; the language whose dictionary leaves the fewest bytes wins, and the
prediction is rejected where the runner-up needs hardly more.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from itertools import zip_longest

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Shipped, held_out, map_texts

LEVEL, BLOCK = 6, 4096
DICTIONARY_BYTES, PIECE_BYTES = 32_768, 128
#: Labelled texts a language is learned from, as expected number of a hash sample.
SAMPLE_TEXTS = 60
NARROW = 0.01
#: Languages at most; each has a dictionary in every worker.
MOST_LANGUAGES = 2_000
UNKNOWN = "und"
_PLAIN = bytes(c if chr(c).isalpha() or c > 127 else 32 for c in range(256))


def plain(text: str) -> bytes:
    """Lower case, with runs of anything in ASCII but letters as one space."""
    return b" ".join(text.lower().encode().translate(_PLAIN).split())


def pieces(text: str, size: int, seed: int) -> list[bytes]:
    """Pieces of ``size`` bytes from all over a text in hash order, as many as fill a dictionary."""
    data = plain(text)
    own = {data[i : i + size] for i in range(0, len(data), size)}
    return heapq.nsmallest(-(-DICTIONARY_BYTES // size), own, key=lambda p: (xxhash.xxh3_64_intdigest(p, seed), p))


def filled(texts: list[list[bytes]]) -> bytes:
    """A dictionary that takes a piece of each text in turn, so texts have equal shares until theirs end."""
    out: dict[bytes, None] = {}
    room = DICTIONARY_BYTES
    for turn in zip_longest(*texts):
        for piece in turn:
            if piece and piece not in out and room > 0:
                out[piece] = None
                room -= len(piece) + 1
        if room <= 0:
            break
    return b" ".join(out)[:DICTIONARY_BYTES]


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_texts: int = SAMPLE_TEXTS) -> dict[str, bytes]:
    """A dictionary for each language from a hash sample of about ``sample_texts`` of its labelled rows.

    Each sampled text is read whole, and all of a language's have equal shares of its dictionary. Rows whose
    language or text is null don't count, and equal texts count once. Raises for more than ``MOST_LANGUAGES``
    languages. Further columns and their names don't matter.
    """
    rows = docs.select(id_col, text_col, lang_col).where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).count().limit(MOST_LANGUAGES + 1).collect()}
    if not counts:
        return {}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages; is {lang_col} a language?")
    share = F.coalesce(*(F.when(F.col(lang_col) == k, min(1.0, sample_texts / n)) for k, n in counts.items()))
    drawn = (F.xxhash64(F.col(id_col).cast("string")) % 1_000_003 + 1_000_003) % 1_000_003 < share * 1_000_003
    size = max(8, min(PIECE_BYTES, DICTIONARY_BYTES // (4 * sample_texts)))  # no text of the sample goes without a piece
    schema = T.StructType([T.StructField("lang", rows.schema[lang_col].dataType), T.StructField("order", T.LongType()), T.StructField("pieces", T.ArrayType(T.BinaryType()))])

    def run(batches):
        for batch in batches:
            own = [pieces(text, size, order % 2**64) for order, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.list_(pa.binary()))], names=schema.names)

    def taken(some: DataFrame) -> list:
        return some.select(F.col(lang_col).alias("lang"), F.xxhash64(text_col).alias("order"), F.col(text_col).alias("text")).mapInArrow(run, schema).collect()

    sample = taken(rows.where(drawn))
    for lang in set(counts) - {r[0] for r in sample}:  # rare languages that the draw missed
        sample += taken(rows.where(F.col(lang_col) == lang).orderBy(F.xxhash64(text_col)).limit(sample_texts))
    texts = defaultdict(dict)
    for lang, order, own in sorted(sample, key=lambda r: (r[0], r[1])):
        texts[lang][order] = [bytes(p) for p in own]
    out = {k: filled(list(v.values())) for k, v in sorted(texts.items())}
    return {k: v for k, v in out.items() if v}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard

        self.compressors = {}
        for lang, data in dictionaries.items():
            d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.compressors[lang] = zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether the margin is wide enough to accept it."""
        if not text or not self.compressors or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, False
        data = plain(text)
        blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)] or [b""]
        sizes = sorted((sum(len(c.compress(b)) for b in blocks), lang) for lang, c in self.compressors.items())
        best, lang = sizes[0]
        margin = (sizes[1][0] - best) / best if len(sizes) > 1 else 1.0
        return lang, 1 - math.exp(-margin * 20), margin >= NARROW


def classify(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: lang_pred, score (0 to 1, from the margin), accepted.

    ``und`` with score 0 where the text is null, empty or has no letter, or nothing was learned. Equal
    sizes go to the first language by name and are not accepted. Texts of any length are read whole;
    repeated rows each give their row, ids may be null, and an empty table gives no rows.
    """
    shipped = Shipped(docs.sparkSession, dictionaries)  # languages times DICTIONARY_BYTES

    def row(text):
        return shipped.built(Classifier).predict(text)

    return map_texts(docs, id_col, text_col, row, "lang_pred string, score double, accepted boolean")


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the rows outside the held-out fold, then predict all rows."""
    fold = held_out(F.col("doc_id"))
    found = classify(docs, learn(docs.where(~fold)))
    return found.select("doc_id", fold.alias("held_out"), "lang_pred", "score", "accepted")
