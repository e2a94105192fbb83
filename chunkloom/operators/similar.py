"""Near-duplicate clusters of chunks by MinHash: signatures, bands and exact checks as expressions of columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stages import cut

#: Bands and rows of a signature: of pairs at a similarity of 0.8, 1 in 4,000 shares no band.
BANDS, ROWS = 16, 4
#: Sets in which frequent shingles are looked for, and how many of these are put behind the others.
LOOKED, FREQUENT = 20_000, 20_000
#: Words that are cut into shingles at once, unless one text has more.
PORTION = 400_000
#: Rows that are broadcast at most; more are joined by a shuffle.
MOST_BROADCAST = 1_000_000
_STEP = np.uint64(0xFF51AFD7ED558CCD)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _portions(batch: pa.RecordBatch):
    """Parts of a batch of (id, words) that hold about ``PORTION`` words."""
    ends, at = np.asarray(batch.column(1).offsets).astype(np.int64), 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + PORTION, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def _shingled(batches, width: int):
    """(ids, sizes, h) of batches of (id, hashes of words): distinct hashes of the runs of ``width`` words, of all words
    where there are fewer, of none where there are none; those of a row follow each other in ascending order."""
    for whole in batches:
        for batch in _portions(whole):
            count = np.diff(np.asarray(batch.column(1).offsets)).astype(np.int64)
            words = batch.column(1).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            runs = np.where(count > 0, np.maximum(count - width + 1, 1), 0)
            owner = np.repeat(np.arange(len(count)), runs)
            at = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs) + (np.cumsum(count) - count)[owner]
            size = np.minimum(count, width)[owner]
            h = size.astype(np.uint64)
            for k in range(width):
                longer = size > k
                h[longer] = _mix(h[longer] * _STEP + words[at[longer] + k])
            order = np.lexsort((h, owner))
            h, owner = h[order], owner[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
            yield batch.column(0), np.bincount(owner[new], minlength=len(count)), h[new]


def prints(texts: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """(id, n, h1, h2, low, keys) of (id, words): a set's size, 128 bits that tell it from others, what puts sets with the
    same least shingles beside each other, and the keys of its ``bands`` of ``rows`` least rehashings each."""
    factors = _mix(np.arange(1, 2 * bands * rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)

    def run(batches):
        for ids, sizes, h in _shingled(batches, width):
            full = np.flatnonzero(sizes)
            at = (np.cumsum(sizes) - sizes)[full]
            told = np.zeros((len(sizes), 3 + bands), np.uint64)
            if len(full):
                for k in range(2):
                    told[full, k] = np.add.reduceat(_mix(h + np.uint64(k + 1)), at)
                for k, bits in enumerate((40, 44, 44)):
                    least = _mix(h[at + np.minimum(k, sizes[full] - 1)]) >> np.uint64(bits)
                    told[full, 2] |= least << np.uint64((40, 20, 0)[k])
                for b in range(bands):
                    key = np.full(len(full), b + 1, np.uint64)
                    for k in range(b * rows, (b + 1) * rows):
                        key = _mix(key * _STEP + np.minimum.reduceat(h * factors[2 * k] + factors[2 * k + 1], at))
                    told[full, 3 + b] = key
            told = told.view(np.int64)
            keys = pa.ListArray.from_arrays(np.arange(0, bands * len(sizes) + 1, bands, dtype=np.int32), pa.array(told[:, 3:].ravel()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes.astype(np.int64)), *(pa.array(told[:, k]) for k in range(3)), keys], names=["id", "n", "h1", "h2", "low", "keys"])

    return texts.mapInArrow(run, f"id {texts.schema['id'].dataType.simpleString()}, n long, h1 long, h2 long, low long, keys array<long>")


def members(texts: DataFrame, width: int) -> DataFrame:
    """(id, s) of (id, words): the shingles of each text."""

    def run(batches):
        for ids, sizes, h in _shingled(batches, width):
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(ends, pa.array(h.view(np.int64)))], names=["id", "s"])

    return texts.mapInArrow(run, f"id {texts.schema['id'].dataType.simpleString()}, s array<long>")


def sketches(texts: DataFrame, width: int) -> DataFrame:
    """(id, n, bits) of (id, words): a set's size and its members as hashed bits, eight or more for each, a power of two."""

    def run(batches):
        for ids, sizes, h in _shingled(batches, width):
            bits = []
            for own in np.split(h, np.cumsum(sizes)[:-1]):
                out = np.zeros(1 << max(6, int(8 * max(1, len(own)) - 1).bit_length()), np.uint8)
                out[(own & np.uint64(len(out) - 1)).astype(np.int64)] = 1
                bits.append(np.packbits(out).tobytes())
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes.astype(np.int64)), pa.array(bits, pa.binary())], names=["id", "n", "bits"])

    return texts.mapInArrow(run, f"id {texts.schema['id'].dataType.simpleString()}, n long, bits binary")


def most_shared(na: int, a: bytes, nb: int, b: bytes) -> int:
    """Upper bound of the overlap of two sets by their sketches: a bit that one lacks is a member of the other alone."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] | x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] | y[len(y) // 2 :]
    return min(na - int(np.bitwise_count(x & ~y).sum()), nb - int(np.bitwise_count(y & ~x).sum()))


def _possible(met: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of (a, b, na, bitsa, nb, bitsb) that their sketches don't rule out."""

    def run(batches):
        for batch in batches:
            keep = [(o := most_shared(*pair)) >= least * (pair[0] + pair[2] - o) - 1e-9 for pair in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return met.select("a", "b", "na", "bitsa", "nb", "bitsb").mapInArrow(run, met.select("a", "b").schema)


def _few(df: DataFrame) -> DataFrame:
    """A broadcast hint only behind a count."""
    return F.broadcast(df) if df.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else df


def components(links: DataFrame) -> DataFrame:
    """(node, component) of links (a, b), a component being its least node, by alternating large-star and small-star steps."""
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        new = cut(small.where("u <> v").distinct())
        if new.count() == edges.count() and new.join(edges, ["u", "v"], "left_anti").isEmpty():
            break
        edges = new
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _frequent(texts: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, ascending, and counts of shingles that a task meets repeatedly in its part of ``texts``."""

    def run(batches):
        held = [h for _, _, h in _shingled(batches, width)]
        names, counted = np.unique(np.concatenate([*held, np.zeros(0, np.uint64)]), return_counts=True)
        often = counted > 1
        yield pa.RecordBatch.from_arrays([pa.array(names[often].view(np.int64)), pa.array(counted[often].astype(np.int64))], names=["h", "c"])

    counts = texts.mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).where("c > 2")
    known = sorted((r.h % (1 << 64), r.c) for r in counts.orderBy(F.desc("c"), "h").limit(FREQUENT).collect())
    return np.array([h for h, _ in known], np.uint64), np.array([c for _, c in known], np.int64)


def prefixes(texts: DataFrame, count: int, width: int, least: float) -> DataFrame:
    """(h, id, n, place) of (id, words), ``count`` of them: the shingles of which two sets at a similarity of ``least``
    share one, with their place in the set.

    They are the first n - ceil(least * n) + 1 of a set in one order of all shingles. Any order is exact; frequent
    shingles, as a part of the sets shows them, come last, so that few sets share one.
    """
    part = F.pmod(F.xxhash64("id"), F.lit(max(1, count // LOOKED))) == 0
    sent = texts.sparkSession.sparkContext.broadcast(_frequent(texts.where(part), width))

    def run(batches):
        names, counted = sent.value
        for ids, sizes, h in _shingled(batches, width):
            owner = np.repeat(np.arange(len(sizes)), sizes)
            often = np.zeros(len(h), np.int64)
            if len(names):
                at = np.minimum(np.searchsorted(names, h), len(names) - 1)
                often = np.where(names[at] == h, counted[at], 0)
            order = np.lexsort((h, often, owner))
            place = np.arange(len(h)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            took = sizes - np.ceil(least * sizes - 1e-6).astype(np.int64) + 1
            kept = place < took[owner]
            yield pa.RecordBatch.from_arrays([pa.array(h[order][kept].view(np.int64)), ids.take(pa.array(owner[kept])), pa.array(sizes[owner[kept]].astype(np.int32)), pa.array(place[kept].astype(np.int32))], names=["h", "id", "n", "place"])

    return texts.mapInArrow(run, f"h long, id {texts.schema['id'].dataType.simpleString()}, n int, place int")


def across(posts: DataFrame, joined: DataFrame, least: float) -> DataFrame:
    """(a, b): all pairs of sets in different components (node, component) that may be similar enough, by posts of their
    prefixes. The first shingle that two sets share leaves them no more than what follows it in both."""
    known = posts.join(_few(joined.withColumnRenamed("node", "id")), "id", "left")
    by = Window.partitionBy("h")
    of = F.coalesce("component", "id")
    open_ = known.withColumn("low", F.min(of).over(by)).withColumn("high", F.max(of).over(by)).where("low < high")
    open_ = cut(open_.select("h", "id", "n", "place", of.alias("c")))
    a, b = (open_.select("h", *(F.col(c).alias(c + x) for c in ("id", "n", "place", "c"))) for x in "ab")
    most = 1 + F.least(F.col("na") - F.col("placea") - 1, F.col("nb") - F.col("placeb") - 1)
    close = (F.least("na", "nb") >= least * F.greatest("na", "nb") - 1e-6) & (most >= least * (F.col("na") + F.col("nb") - most) - 1e-6)
    return a.join(b, "h").where((F.col("ida") < F.col("idb")) & (F.col("ca") != F.col("cb")) & close).select(F.col("ida").alias("a"), F.col("idb").alias("b")).distinct()


def near_duplicates(chunks: DataFrame, id_col: str, words: Column, least: float = 0.8, width: int = 5, neighbours: int = 8) -> DataFrame:
    """(id, n_shingles, cluster): the least id that is reached by links, of chunks whose shingles are similar enough.

    Chunks with equal shingles are one set, so copies aren't compared. Sets that share a band are put in the order of
    their smallest shingles, which brings similar ones together, and each is checked against the band's first and
    the next, then, where that didn't join them, against the other ``neighbours`` that follow it: the pairs are linear
    in the rows of a band. Sets that are not in one component then are compared where they share a rare shingle of
    their prefixes, so no link between components is missed. Links are checked exactly. No shingles are written but
    those of prefixes and of sets that are checked: each step cuts the texts anew, which costs time and saves disk.
    Chunks without words have no links; null ids have a null cluster and link nothing; an empty table gives no rows.
    """
    texts = chunks.select(F.col(id_col).alias("id"), F.transform(F.coalesce(words, F.array().cast("array<string>")), lambda w: F.xxhash64(w)).alias("w"))
    rows = cut(prints(texts, width, BANDS, ROWS))
    named = rows.where("id IS NOT NULL AND n > 0").withColumn("set", F.struct("n", "h1", "h2"))
    sets = cut(named.groupBy("set").agg(F.min("id").alias("id"), F.first("low").alias("low"), F.first("keys").alias("keys")))
    own = sets.select("id", F.col("set.n").alias("n"), "low", F.explode("keys").alias("key"))
    by = "PARTITION BY key ORDER BY low, id"
    lead = ", ".join(f"lead(struct(id, n), {k}) OVER ({by})" for k in range(1, neighbours + 1))
    paired = own.selectExpr("id AS a", "n", f"array(first(struct(id, n)) OVER ({by}), {lead}) AS bs").select("a", "n", F.posexplode("bs").alias("k", "b"))
    fits = F.least("n", "b.n") >= least * F.greatest("n", "b.n") - 1e-6
    paired = paired.where(F.col("b").isNotNull() & (F.col("a") != F.col("b.id")) & fits)
    pairs = cut(paired.groupBy(F.least("a", "b.id").alias("a"), F.greatest("a", "b.id").alias("b")).agg(F.min("k").alias("k")))
    both = F.size(F.array_intersect("sa", "sb"))

    def met(pairs, of):
        """Pairs with both sides' columns of ``of`` texts."""
        asked = _few(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct())
        held = of(texts.join(asked, "id", "left_semi"), width)
        a, b = (held.select(F.col("id").alias(x), *(F.col(c).alias(c + x) for c in held.columns[1:])) for x in "ab")
        return a.join(_few(pairs), "a").join(b, "b")

    def linked(pairs):
        return cut(met(cut(pairs.select("a", "b")), members).where(both >= least * (F.size("sa") + F.size("sb") - both) - 1e-9).select("a", "b").distinct())

    links = linked(pairs.where("k < 2"))
    joined = components(links)
    for x in "ab":
        pairs = pairs.join(joined.toDF(x, "c" + x), x, "left").withColumn("c" + x, F.coalesce("c" + x, x))
    links = links.unionByName(linked(pairs.where("k >= 2 AND ca <> cb")))
    ids = sets.select("id").distinct()
    posts = prefixes(texts.join(_few(ids), "id", "left_semi"), sets.count(), width, least)
    # few of these are similar, so whole sets go with those alone that sketches leave
    links = links.unionByName(linked(_possible(met(cut(across(posts, components(links), least)), sketches), least)))
    # ids of several texts are one node
    again = named.join(sets.select("set", F.col("id").alias("rep")), "set").where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    joined = components(links.unionByName(again))
    found = rows.select("id", F.col("n").alias("n_shingles")).join(joined.withColumnRenamed("node", "id"), "id", "left")
    return found.select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component", "id").alias("cluster"))
