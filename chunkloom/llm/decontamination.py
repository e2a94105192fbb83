"""Benchmark decontamination with DataFrame operations alone.

A window of a document is compared with a benchmark item of as many words. A window can reach the
similarity only if enough of its shingles are shingles of items of its size, so windows are cut at every
start where that many lie close together. Each window and item gets a 64-bit SimHash of its shingles. The
fingerprints are cut into blocks. Two within the radius differ in one block by no more than the radius shared
out over the blocks, so items are indexed by size under all values that near to each of theirs, and windows
look up their own; what the index returns is checked by Hamming distance and then by exact similarity of the
shingles weighted by how often they occur: the sum of the lesser counts over the sum of the greater.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, fresh

#: Of windows that are only just similar enough, 0.4 % are further than the radius; of unrelated ones the index
#: of six blocks returns a fifth.
WIDTH, SIMILARITY, RADIUS, BLOCKS = 5, 0.8, 17, 6
#: Shingles of the benchmark that are broadcast at most; more are joined by a shuffle.
MOST_BROADCAST = 500_000


def words_of(text: Column) -> Column:
    """Runs of letters and digits, lower-cased."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(words: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` words, repeated ones included; none if there are fewer."""
    starts = F.when(F.size(words) >= width, F.sequence(F.lit(1), F.size(words) - width + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*(F.get(words, i - 1 + k) for k in range(width))))


#: Counters of four bits in one long, and the most hashes that they can count.
LANE, LANES, MOST_COUNTED = 15, 4, (1 << 15) - 1


def simhash(hashes: Column) -> Column:
    """64 bits, each the majority of that bit over the hashes; four are counted in one pass."""
    spread = F.array(*(F.lit(sum(1 << LANE * k for k in range(LANES) if bits >> k & 1)).cast("long") for bits in range(1 << LANES)))
    zero = F.lit(0).cast("long")

    def four(first):
        counts = F.aggregate(hashes, zero, lambda acc, h: acc + F.get(spread, F.shiftrightunsigned(h, first).bitwiseAND(15).cast("int")))
        count = lambda k: F.shiftrightunsigned(counts, LANE * k).bitwiseAND(MOST_COUNTED)
        return counts, count

    parts = []
    for first in range(0, 64, LANES):
        _, count = four(first)
        parts += [(first + k, count(k)) for k in range(LANES)]
    few = [F.when(2 * c > F.size(hashes), F.lit(1 << b if b < 63 else -(1 << 63)).cast("long")).otherwise(zero) for b, c in parts]

    def bit(b):
        balance = F.aggregate(hashes, F.lit(0), lambda acc, h: acc + (F.call_function("getbit", h, b) * 2 - 1).cast("int"))
        return F.when(balance > 0, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(zero)

    together = lambda bits: F.aggregate(bits, zero, lambda acc, x: acc.bitwiseOR(x))
    return F.when(F.size(hashes) <= MOST_COUNTED, together(F.array(*few))).otherwise(together(F.transform(F.sequence(F.lit(0), F.lit(63)), bit)))


def _edges(n: int) -> list[tuple[int, int]]:
    edges = [64 * k // n for k in range(n + 1)]
    return list(zip(edges, edges[1:], strict=False))


def blocks(print_: Column, n: int) -> Column:
    """(block, bits) of a fingerprint cut into ``n`` blocks."""
    return F.array(*(F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(print_, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("bits")) for k, (a, b) in enumerate(_edges(n))))


def near_blocks(print_: Column, radius: int, n: int) -> Column:
    """(block, bits) of all values within a block's share of the radius."""

    def around(k, a, b):
        masks = [sum(1 << at for at in chosen) for size in range(radius // n + 1) for chosen in combinations(range(b - a), size)]
        own = F.shiftrightunsigned(print_, a).bitwiseAND(F.lit((1 << (b - a)) - 1))
        return F.transform(F.array(*(F.lit(m).cast("long") for m in masks)), lambda m: F.struct(F.lit(k).alias("block"), own.bitwiseXOR(m).alias("bits")))

    return F.concat(*(around(k, a, b) for k, (a, b) in enumerate(_edges(n))))


def starts_of(hits: Column, count: Column, need: Column, low: Column, high: Column) -> Column:
    """Starts from ``low`` to ``high`` of the runs of ``count`` places that hold ``need`` of the sorted ``hits``."""

    def run(i):
        # starts up to the hit before belong to that hit's own run, as ends only grow
        first = F.greatest(low, F.get(hits, i + need - 1) - count + 1, F.coalesce(F.get(hits, i - 1) + 1, F.lit(0)))
        last = F.least(high, F.get(hits, i))
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))

    return F.when(F.size(hits) >= need, F.flatten(F.transform(F.sequence(F.lit(0), F.size(hits) - need), run))).otherwise(F.array().cast("array<int>"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH, least: float = SIMILARITY, radius: int = RADIUS, n_blocks: int = BLOCKS) -> DataFrame:
    """One row per document and item that it holds: start_word of the best window, similarity.

    Items of fewer words than ``width`` are one shingle of all their words. Null, empty and wordless texts
    match nothing. Rows that repeat an id are windows of one document; equal items each match. Of windows
    that are equally similar the first counts. Texts of any length are read whole. Null ids of documents or
    items come back as null, empty tables give no rows, and further columns and their names don't matter.
    """
    items = benchmark.select(F.col(item_col).alias("item"), words_of(F.col(item_text_col)).alias("w")).where(F.size("w") > 0)
    items = items.withColumn("width", F.least(F.size("w"), F.lit(width)))
    widths = sorted(r[0] for r in items.select("width").distinct().collect())  # at most ``width`` values
    cases = F.coalesce(*(F.when(F.col("width") == k, shingles(F.col("w"), k)) for k in widths)) if widths else F.array().cast("array<bigint>")
    items = cut(items.select("item", F.size("w").alias("words"), "width", cases.alias("shingles")).withColumn("print", simhash(F.col("shingles"))))
    known = items.select("item", "words", "width", F.explode("shingles").alias("shingle"))
    anchors = known.select("shingle", "width", "words").distinct()  # items of one size share their windows
    if anchors.count() <= MOST_BROADCAST:
        anchors = F.broadcast(anchors)
    # two hashes name a text and its id, as ids may repeat or be null
    row = ["k1", "k2"]
    source = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc"), F.col(text_col).alias("_text"))
    source = source.select(F.xxhash64("doc", "_text").alias("k1"), F.xxhash64(F.lit(1), "doc", "_text").alias("k2"), "doc", "_text")
    split = source.select(*row, "doc", words_of(F.col("_text")).alias("w"))
    hits = None
    for k in widths:
        found = split.select(*row, "doc", F.size("w").alias("length"), F.posexplode(shingles(F.col("w"), k)).alias("at", "shingle")).join(anchors.where(F.col("width") == k), "shingle").select(*row, "doc", "width", "words", "length", "at")
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        hits = source.select(*row, "doc", *(F.lit(0).alias(c) for c in ("width", "words", "length", "at"))).where("false")
    # The similarity's denominator is at least the item's shingles; for whole windows it is twice these less the shared ones.
    places = hits.groupBy(*row, "doc", "width", "words").agg(F.sort_array(F.collect_set("at")).alias("hits"), F.min("length").alias("length")).withColumn("count", F.col("words") - F.col("width") + 1)
    need = lambda share: F.greatest(F.lit(1), F.ceil(F.col("count") * share - 1e-6).cast("int"))
    whole = F.col("length") - F.col("words")
    both = F.concat(starts_of(F.col("hits"), F.col("count"), need(2 * least / (1 + least)), F.lit(0), whole), starts_of(F.col("hits"), F.col("count"), need(least), F.greatest(F.lit(0), whole + 1), F.col("length")))
    starts = cut(places.select(*row, "doc", "width", "words", "length", F.explode(both).alias("start")))
    there = source.join(starts.select(*row).distinct(), row, "left_semi").dropDuplicates(row)
    there = cut(there.select(*row, words_of(F.col("_text")).alias("w")))
    starts = _of_distinct_content(starts, there, row, widths)
    cut_out = starts.join(there, row).select(*row, "doc", "words", "width", "start", F.slice("w", F.col("start") + 1, F.col("words")).alias("v"))
    by_width = F.coalesce(*(F.when(F.col("width") == k, shingles(F.col("v"), k)) for k in widths)) if widths else F.array().cast("array<bigint>")
    windows = cut(cut_out.select(*row, "doc", "words", "width", "start", by_width.alias("shingles")).where(F.size("shingles") > 0).withColumn("print", simhash(F.col("shingles"))))
    index = items.select("item", "words", "width", F.col("print").alias("item_print"), F.explode(near_blocks(F.col("print"), radius, n_blocks)).alias("b")).select("item", "words", "width", "item_print", "b.block", "b.bits")
    window = [*row, "words", "width", "start"]
    probes = windows.select(*window, "print", F.explode(blocks(F.col("print"), n_blocks)).alias("b")).select(*window, "print", "b.block", "b.bits")
    near = probes.join(index, ["words", "width", "block", "bits"]).where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius).select(*window, "item").distinct()
    judged = _similar(near, windows, items, window).where(F.col("similarity") >= least)
    best = judged.groupBy("doc", "item").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "start")).alias("best"))
    return best.select(F.col("doc").alias(id_col), F.col("item").alias(item_col), F.col("best.start").alias("start_word"), (-F.col("best.s")).alias("similarity"))


def _of_distinct_content(starts: DataFrame, there: DataFrame, row: list[str], widths: list[int]) -> DataFrame:
    """Of a text's windows of one size that hold the same shingles as often, the first.

    A window's shingles are told by the sums of two hashes of each, as differences of running sums along the text,
    so that a text that repeats itself costs no more than its length.
    """
    sums = None
    for k in widths:
        asked = starts.where(F.col("width") == k).select(*row).distinct()
        each = there.join(asked, row, "left_semi").select(*row, F.lit(k).alias("width"), F.posexplode(shingles(F.col("w"), k)).alias("at", "shingle"))
        sums = each if sums is None else sums.unionByName(each)
    if sums is None:
        return starts.drop("length")
    along = Window.partitionBy(*row, "width").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    one, two = (F.shiftrightunsigned(h, 24).cast("decimal(20,0)") for h in (F.col("shingle"), F.xxhash64("shingle")))
    sums = cut(sums.withColumn("one", one).withColumn("two", two).select(*row, "width", "at", (F.sum("one").over(along)).alias("s1"), (F.sum("two").over(along)).alias("s2"), "one", "two"))
    last = F.least(F.col("start") + F.col("words") - F.col("width"), F.col("length") - F.col("width"))
    placed = starts.withColumn("last", last).where("start <= last")
    low = sums.select(*row, "width", F.col("at").alias("start"), (F.col("s1") - F.col("one")).alias("a1"), (F.col("s2") - F.col("two")).alias("a2"))
    high = sums.select(*row, "width", F.col("at").alias("last"), F.col("s1").alias("b1"), F.col("s2").alias("b2"))
    told = placed.join(low, [*row, "width", "start"]).join(high, [*row, "width", "last"])
    content = [F.col("b1") - F.col("a1"), F.col("b2") - F.col("a2"), F.col("last") - F.col("start")]
    return told.groupBy(*row, "doc", "width", "words", *(c.alias(f"c{k}") for k, c in enumerate(content))).agg(F.min("start").alias("start")).drop("c0", "c1", "c2")


def _similar(near: DataFrame, windows: DataFrame, items: DataFrame, window: list[str]) -> DataFrame:
    """(doc, item, start, similarity) of the pairs ``near``, from how often each shingle is in either."""
    pairs = near.join(windows.drop("print"), window).select(*window, "doc", "item", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    ours = pairs.groupBy(*window, "doc", "item", "n", "shingle").agg(F.count(F.lit(1)).alias("own"))
    theirs = items.select("item", F.size("shingles").alias("m"), F.explode("shingles").alias("shingle")).groupBy("item", "m", "shingle").agg(F.count(F.lit(1)).alias("their"))
    met = ours.join(theirs.withColumnRenamed("item", "_item"), F.col("item").eqNullSafe(F.col("_item")) & (ours["shingle"] == theirs["shingle"]))
    shared = met.groupBy(*window, "doc", "item", "n", "m").agg(F.sum(F.least("own", "their")).alias("shared"))
    return shared.select("doc", "item", "start", (F.col("shared") / (F.col("n") + F.col("m") - F.col("shared"))).alias("similarity"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; rows with a null id stay."""
    held = fresh("hit", docs.columns)
    hit = contaminated(docs, benchmark, id_col, **options).select(F.col(id_col).alias(held)).distinct()
    return docs.join(hit, F.col(id_col) == F.col(held), "left_anti")
