"""Toxicity from a weighted lexicon, matched by Aho-Corasick on folded text.

Folding lower-cases, undoes compatibility forms, accents and invisible characters, maps look-alike letters
of other scripts to Latin and digits inside words to the letters they stand for, and joins letters that are
written apart. Entries are words or word beginnings, weighted by the log-odds of their document
frequencies in labelled texts; common insults start from a prior weight. The weights of all matches but
those inside exception phrases are summed, divided by the logarithm of the length, and turned into a score
by a logistic curve.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Shipped, filter_texts, held_out, map_texts

# Common insults, phrases in which an entry is harmless, letters of other scripts by the Latin
# letter they look like, and digits and signs by the letter they stand for.
BASE_WORDS = "idiot moron stupid scum loser pathetic worthless disgusting trash clown imbecile dumbass bastard retard".split()
EXCEPTIONS = ("trash can", "trash bag", "trash bin", "clown fish", "class clown", "circus clown", "pond scum", "loser bracket", "worthless check", "disgusting smell")
LOOKALIKES = {
    "a": "аαɑ", "b": "вβ", "d": "ԁ", "e": "еε", "g": "гɡ", "h": "һ", "i": "іιⅰ", "j": "ј", "k": "кκ", "l": "ӏⅼ", "m": "мμ",
    "n": "пν", "o": "оοᴏօ", "p": "рρ", "r": "г", "s": "ѕ", "t": "тτ", "u": "υ", "v": "ѵ", "x": "хχ", "y": "у",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
#: Weight of the insults before any label is seen, and how many labelled texts it counts as.
BASE_WEIGHT, BASE_TEXTS = 3.0, 10
_LETTER = r"[^\W\d_]"
_FOLDED = re.compile(rf"[013457@$](?={_LETTER})|(?<={_LETTER})[013457]+(?![\w@$])|(?<={_LETTER})[013457@$]+(?={_LETTER})")
_LOOK = str.maketrans({other: latin for latin, others in LOOKALIKES.items() for other in others})
_SPACED = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))
_INVISIBLE = re.compile("[\u0300-\u036f\u00ad\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufe00-\ufe0f\ufeff]")
_APART = re.compile(rf"(?<!\w){_LETTER}(?:([ .*_-]){_LETTER})(?:\1{_LETTER})+(?!\w)")

#: Labelled texts a class is learned from, as expected number of a hash sample.
SAMPLE_TEXTS = 5_000
#: Bound on minus the logarithm of the chance that an entry's texts are toxic by accident.
LEAST_EVIDENCE = 16.0
PREFIXES = range(4, 8)


def fold(text: str) -> str:
    """Folded words, each between two spaces."""
    text = text.lower()
    if not text.isascii():
        text = _INVISIBLE.sub("", unicodedata.normalize("NFKD", text)).lower().translate(_LOOK)
    text = _FOLDED.sub(lambda m: "".join(DIGITS[c] for c in m[0]), text)
    text = _APART.sub(lambda m: m[0][::2], text)
    return " " + text.encode().translate(_SPACED).decode() + " "


def features(text: str) -> set[str]:
    """Words as ``word `` with the closing space, and word beginnings."""
    words = set(fold(text).split())
    return {f"{w} " for w in words} | {w[:n] for w in words for n in PREFIXES if len(w) > n}


class Lexicon:
    def __init__(self, entries: dict[str, float], slope: float, offset: float):
        import ahocorasick

        self.slope, self.offset = slope, offset
        self.entries, self.phrases = ahocorasick.Automaton(), ahocorasick.Automaton()
        for entry, weight in entries.items():
            self.entries.add_word(f" {entry}", (len(entry), weight))
        for phrase in EXCEPTIONS:
            self.phrases.add_word(f" {phrase} ", len(phrase) + 1)
        self.any = bool(entries)
        if self.any:
            self.entries.make_automaton()
        self.phrases.make_automaton()

    def strength(self, text: str | None) -> float:
        """Sum of weights over the logarithm of the number of words. Of entries with one start the longest counts."""
        if not text or not self.any:
            return 0.0
        folded = fold(text)
        best: dict[int, tuple[int, float]] = {}
        for end, (n, weight) in self.entries.iter(folded):
            start = end - n + 1
            if n > best.get(start, (0, 0.0))[0]:
                best[start] = n, weight
        if not best:
            return 0.0
        harmless = {at for end, n in self.phrases.iter(folded) for at in range(end - n, end)}
        total = sum(w for at, (_, w) in best.items() if at not in harmless)
        return total / math.log(math.e + folded.count(" "))

    def score(self, text: str | None) -> float:
        z = self.slope * self.strength(text) + self.offset
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _sample(docs: DataFrame, labels: DataFrame, n: int) -> DataFrame:
    """(text, toxic) of about ``n`` labelled documents a class, drawn by hash."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~held_out(F.col("doc_id")))
    counts = {r[0]: r[1] for r in known.groupBy((F.col("toxic") > 0).alias("t")).count().collect()}
    share = F.when(F.col("toxic") > 0, min(1.0, n / counts.get(True, 1))).otherwise(min(1.0, n / counts.get(False, 1)))
    drawn = known.where((F.xxhash64(F.lit(7), "doc_id") % 1_000_003 + 1_000_003) % 1_000_003 < share * 1_000_003)
    ids = F.broadcast(drawn.select("doc_id", (F.col("toxic") > 0).alias("toxic")))  # about 2n rows
    return docs.select("doc_id", "text").where("text IS NOT NULL").join(ids, "doc_id").select("text", "toxic")


def learn(docs: DataFrame, labels: DataFrame, sample_texts: int = SAMPLE_TEXTS) -> tuple[dict[str, float], float, float]:
    """Entries with weights, slope and offset, from labelled documents outside the held-out fold.

    About ``sample_texts`` documents a class are used. Labels that are null or have no document don't count; a
    document with several labels is toxic if one says so, rows that repeat an id count each. Without
    documents of both classes the common insults and a fixed curve remain. Further columns of both tables and
    their names don't matter.
    """
    sample = _sample(docs, labels, sample_texts)

    def count(batches):
        for batch in batches:
            seen, toxic = (Counter(), Counter()), batch.column(1).to_pylist()
            for text, t in zip(batch.column(0).to_pylist(), toxic, strict=True):
                seen[t].update(features(text))
            keys = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array([s[k] for k in keys], pa.int64()) for s in seen)], names=["entry", "n0", "n1"])

    totals = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    n0, n1 = totals.get(False, 0), totals.get(True, 0)
    base = {f"{w} ": BASE_WEIGHT for w in BASE_WORDS}
    entries = dict(base)
    if n0 and n1:
        counts = sample.mapInArrow(count, "entry string, n0 long, n1 long").groupBy("entry").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        weight = F.log((F.col("n1") + 0.5) / (n1 + 1)) - F.log((F.col("n0") + 0.5) / (n0 + 1))
        kept = ((F.col("n1") >= 4) & (weight >= math.log(5)) & (_evidence(F.col("n0"), F.col("n1"), n1 / (n0 + n1)) >= LEAST_EVIDENCE)) | F.col("entry").isin(*base)
        # few of the bounded sample's words pass; all that do are kept
        rows = [tuple(r) for r in counts.where(kept).select("entry", "n0", "n1", weight.alias("w")).collect()]
        entries = select_entries([r for r in rows if r[0] not in base])
        for entry, k0, k1, w in rows:
            if entry in base:
                entries[entry] = (BASE_TEXTS * BASE_WEIGHT + (k0 + k1) * w) / (BASE_TEXTS + k0 + k1)
        entries = base | entries
    shipped = Shipped(docs.sparkSession, entries)

    def strength(batches):
        for batch in batches:
            lexicon = shipped.built(lambda e: Lexicon(e, 1.0, 0.0))
            yield pa.RecordBatch.from_arrays([pa.array([lexicon.strength(t) for t in batch.column(0).to_pylist()], pa.float64()), batch.column(1)], names=["x", "toxic"])

    points = [tuple(r) for r in sample.mapInArrow(strength, "x double, toxic boolean").collect()] if n0 and n1 else []
    return (entries, *fit(points))


def _evidence(n0: Column, n1: Column, share: float) -> Column:
    """Bound on minus the logarithm of the chance that n1 of n0 + n1 texts are toxic when ``share`` are."""
    q = n1 / (n0 + n1)
    other = F.when(q < 1, (1 - q) * F.log((1 - q) / (1 - share))).otherwise(0)
    return F.when(q > share, (n0 + n1) * (q * F.log(q / share) + other)).otherwise(0.0)


def select_entries(rows: list[tuple[str, int, int, float]]) -> dict[str, float]:
    """Entries without those that others stand for.

    Word beginnings stand for many words, so one that a single word makes up gives way to the word; what a
    kept beginning covers is left out.
    """
    words = {e: n1 for e, _, n1, _ in rows if e.endswith(" ")}
    most: dict[str, int] = {}
    for word, n1 in words.items():
        for n in PREFIXES:
            most[word[:n]] = max(most.get(word[:n], 0), n1)
    out: dict[str, float] = {}
    for entry, _, n1, weight in sorted(rows, key=lambda r: (len(r[0]), r[0])):
        if any(entry[:n] in out for n in range(1, len(entry))):
            continue
        if entry.endswith(" ") or most.get(entry, 0) < 0.5 * n1:
            out[entry] = weight
    return out


def fit(points: list[tuple[float, bool]]) -> tuple[float, float]:
    """Slope and offset of a logistic curve by Newton steps, classes weighted alike, slightly shrunk."""
    y = np.array([t for _, t in points], float)
    if not points or y.min() == y.max():
        return 4.0, -4.0
    x = np.array([s for s, _ in points])
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    design, theta, shrink = np.stack([x, np.ones_like(x)], 1), np.zeros(2), np.diag([0.05, 0.001])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - shrink @ theta
        step = np.linalg.solve((design * (weight * p * (1 - p))[:, None]).T @ design + shrink + 1e-9 * np.eye(2), gradient)
        theta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def score_texts(docs: DataFrame, model: tuple[dict[str, float], float, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: score (0 to 1). Null and empty texts get the score of a text without a match.

    Texts of any length are read whole; repeated rows each give their row; an empty table gives no rows.
    """
    shipped = Shipped(docs.sparkSession, model)  # entries of a bounded sample

    def row(text):
        return (shipped.built(lambda m: Lexicon(*m)).score(text),)

    return map_texts(docs, id_col, text_col, row, "score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn outside the held-out fold, then score all documents."""
    scored = score_texts(docs, learn(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: tuple[dict[str, float], float, float], least: float = 0.5, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` whose score is below ``least``; null and empty texts stay."""
    shipped = Shipped(docs.sparkSession, model)
    return filter_texts(docs, text_col, lambda text: not text or shipped.built(lambda m: Lexicon(*m)).score(text) < least)
