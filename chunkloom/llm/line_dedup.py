"""Line deduplication: equal lines by hash, lines within a few edits by a segment-partition join.

Lines are compared without outer white space. Equal lines of any length but 0 are repeats; lines within
the threshold are if both have ``LEAST_PER_EDIT`` characters for each edit. A line is cut into
threshold-plus-one segments of its length; a line within the threshold that is no shorter holds one of
them at a place that the length difference bounds. Each line is indexed under its segments and probes the
substrings at those places for each length it can match. The lines of one key are compared with the least
one, and those that this doesn't join with one another. Candidates are verified by banded bit-parallel
edit distance. Lines joined by links form a component, of which the first occurrence stays: that in the
document with the least id, and there the earliest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, spread_join
from .components import components

EDITS, MIN_CHARS = 2, 1
#: Characters an edit may stand against: two lines within the threshold agree in four fifths at least. In
#: shorter lines ("page 12", "x = 1") two edits are another line.
LEAST_PER_EDIT = 5
BATCH_CHARS, REMEMBERED = 1 << 20, 200_000
#: Ids of lines to verify that are broadcast at most; more are joined by a shuffle.
MOST_BROADCAST = 1_000_000
#: Lines of a key that a task compares with one another; keys of more are cut into blocks.
BLOCK_LINES = 5_000
_STEP = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_STEP, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, 4096), base, np.uint64)
        steps[0] = 1
        known = _powers[base] = np.multiply.accumulate(steps)
    return known


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def line_hash(line: str) -> tuple[int, int]:
    d = xxhash.xxh3_128_intdigest(line.encode())
    return (d & (1 << 64) - 1) - (1 << 63), (d >> 64) - (1 << 63)


def eligible(text: str, min_chars: int):
    """(line number, stripped line) of the lines that take part."""
    for k, line in enumerate(text.split("\n")):
        line = line.strip()
        if len(line) >= min_chars:
            yield k, line


def near_floor(edits: int, min_chars: int) -> int:
    """Characters from which a line takes part in the join by edits."""
    return max(min_chars, LEAST_PER_EDIT * edits)


def places(length: int, target: int, edits: int) -> list[tuple[int, int, int]]:
    """(segment, start, size): where a string of ``length`` may hold the segments of one of ``target`` characters."""
    out, parts, gap = [], edits + 1, length - target
    size, longer = divmod(target, parts)
    start = 0
    for k in range(parts):
        n = size + (k >= parts - longer)
        low = max(0, start - k, start + gap - (parts - 1 - k))
        high = min(length - n, start + k, start + gap + (parts - 1 - k))
        out += [(k, at, n) for at in range(low, high + 1)]
        start += n
    return out


def _substring_keys(codes: np.ndarray, owner, target, segment, start, size) -> np.ndarray:
    """Keys of substrings of the concatenated lines, with target length and segment mixed in."""
    powers, back = _power(_STEP, len(codes)), _power(_BACK, len(codes))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers[: len(codes)], dtype=np.uint64)])
    value = (sums[start + size] - sums[start]) * back[start]
    return _mixed(_mixed(value) + target.astype(np.uint64) * np.uint64(0xFF51AFD7ED558CCD) + segment.astype(np.uint64) * np.uint64(0xC4CEB9FE1A85EC53))


_templates: dict[tuple[int, int, int], np.ndarray] = {}


def template(length: int, edits: int, min_chars: int) -> np.ndarray:
    """(target, segment, start, size, own) of all keys of a line of ``length`` characters."""
    known = _templates.get((length, edits, min_chars))
    if known is None:
        if len(_templates) > 20_000:
            _templates.clear()
        own = set(own_places(length, edits))
        rows = [(target, k, at, n, target == length and (k, at, n) in own) for target in range(max(min_chars, length - edits), length + 1) for k, at, n in places(length, target, edits)]
        known = _templates[length, edits, min_chars] = np.array(rows, np.int64)
    return known


def segment_rows(lines: list[str], hashes: list[int], edits: int, min_chars: int) -> pa.RecordBatch:
    """(key, line, own) of all lines: own segments, and probed substrings other than these."""
    codes = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32)
    lengths = np.array(list(map(len, lines)), np.int64)
    offsets = np.cumsum(lengths) - lengths
    kinds, kind = np.unique(lengths, return_inverse=True)
    known = [template(int(n), edits, min_chars) for n in kinds]
    sizes = np.array(list(map(len, known)))
    first = np.cumsum(sizes) - sizes
    per_line = sizes[kind]
    owner = np.repeat(np.arange(len(lines)), per_line)
    at = np.arange(int(per_line.sum())) + np.repeat(first[kind] - (np.cumsum(per_line) - per_line), per_line)
    target, segment, start, size, own = np.concatenate(known)[at].T
    keys = _substring_keys(codes, owner, target, segment, offsets[owner] + start, size)
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.array(hashes, np.int64)[owner]), pa.array(own.astype(bool))], names=["key", "line", "own"])


def own_places(length: int, edits: int) -> list[tuple[int, int, int]]:
    """The line's own segments."""
    out, start, parts = [], 0, edits + 1
    size, longer = divmod(length, parts)
    for k in range(parts):
        n = size + (k >= parts - longer)
        out.append((k, start, n))
        start += n
    return out


def within(a: str, b: str, most: int) -> bool:
    """Whether the edit distance is ``most`` at most, by bit-parallel steps along a band."""
    if abs(len(a) - len(b)) > most:
        return False
    n = min(len(a), len(b))
    low, high = 0, n
    while low < high:  # common prefix
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    a, b = a[low:], b[low:]
    n = min(len(a), len(b))
    low, high = 0, n
    while low < high:  # common suffix
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[len(a) - mid :] == b[len(b) - mid :] else (low, mid - 1)
    a, b = a[: len(a) - low], b[: len(b) - low]
    if len(a) < len(b):
        a, b = b, a
    if len(b) <= most:
        return _plain(a, b) <= most
    where: dict[str, int] = {}
    for k, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << (k + most)  # row r of the band at step j is character j + r - most
    width = 2 * most + 1
    full, top = (1 << width) - 1, 1 << (width - 1)
    # Band rows are diagonals; the distance is followed down the lowest one, then along the last row.
    vp, vn = (full << most) & full, 0
    distance = most
    for j, c in enumerate(b):
        x = where.get(c, 0) >> j & full
        d0 = (((x & vp) + vp) ^ vp | x | vn) & full
        hp = (vn | ~(d0 | vp)) & full
        hn = d0 & vp
        if j < len(a) - most:
            distance += not d0 & top
            if distance > most + len(b) - len(a) + 2 * most:
                return False
        else:
            bit = 1 << (width - 2 - (j - (len(a) - most)))
            distance += bool(hp & bit) - bool(hn & bit)
        shifted = d0 >> 1
        vp = (hn | ~(shifted | hp)) & full
        vn = shifted & hp
    return distance <= most


def _plain(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return row[-1]


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(id, line_no, h1, h2): each eligible line's first occurrence in its document."""

    def run(batches):
        for batch in batches:
            ids, numbers, h1, h2 = [], [], [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for line, k in {line: k for k, line in reversed(list(eligible(text or "", min_chars)))}.items():
                    a, b = line_hash(line)
                    ids.append(i)
                    numbers.append(k)
                    h1.append(a)
                    h2.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(numbers, pa.int32()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64())], names=["id", "line_no", "h1", "h2"])

    return docs.mapInArrow(run, "id long, line_no int, h1 long, h2 long")


def _distinct(batches, min_chars: int):
    """Batches of eligible lines (h1, line); a line seen lately by this task is left out."""
    seen: set[int] = set()
    for batch in batches:
        hashes, lines, chars = [], [], 0
        for text in batch.column(1).to_pylist():
            for _, line in eligible(text or "", min_chars):
                h = line_hash(line)[0]
                if h in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(h)
                hashes.append(h)
                lines.append(line)
                chars += len(line)
                if chars >= BATCH_CHARS:
                    yield hashes, lines
                    hashes, lines, chars = [], [], 0
        if lines:
            yield hashes, lines


def _segments(docs: DataFrame, edits: int, min_chars: int) -> DataFrame:
    def run(batches):
        for hashes, lines in _distinct(batches, min_chars):
            yield segment_rows(lines, hashes, edits, min_chars)

    return docs.mapInArrow(run, "key long, line long, own boolean")


def _meetings(batches):
    """From rows sorted by key, own first, then line: (key, lead, line, own) for each line that meets an indexed one."""
    key = lead = last = None
    for batch in batches:
        keys, lines = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        own = batch.column(2).to_numpy(zero_copy_only=False)
        if not len(keys):
            continue
        same = np.concatenate([[keys[0] == key], keys[1:] == keys[:-1]])
        alone = ~same & ~np.concatenate([same[1:], [False]])
        alone[-1] = False
        out: list[list] = [[], [], [], []]
        for r in np.flatnonzero(~alone).tolist():
            if not same[r]:
                key, lead, last = keys[r], lines[r] if own[r] else None, lines[r]
            elif lead is not None and lines[r] != lead and lines[r] != last:
                last = lines[r]
                for column, value in zip(out, (key, lead, last, own[r]), strict=True):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.bool_()), strict=True)], names=["key", "lead", "line", "own"])


def _texts_of(docs: DataFrame, wanted: DataFrame, min_chars: int) -> DataFrame:
    """(line, text, h2, chars, pairs) of the wanted lines."""

    def run(batches):
        for hashes, lines in _distinct(batches, min_chars):
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(lines, pa.string())], names=["line", "text"])

    def signed(batches):
        for batch in batches:
            marks = [(line_hash(t)[1], *parities(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([m[k] for m in marks], pa.int64()) for k in (0, 1, 2))], names=["line", "text", "h2", "chars", "pairs"])

    side = F.broadcast(wanted) if wanted.count() <= MOST_BROADCAST else wanted
    found = docs.mapInArrow(run, "line long, text string").join(side, "line", "left_semi").dropDuplicates(["line"])
    return found.mapInArrow(signed, "line long, text string, h2 long, chars long, pairs long")


def parities(line: str) -> tuple[int, int]:
    """Parities of the counts of characters and of character pairs, in 64 classes each.

    An edit changes at most two character counts and four pair counts.
    """
    codes = np.frombuffer(line.encode("utf-32-le"), np.uint32).astype(np.uint64)
    out = []
    for values in (codes, codes[:-1] * np.uint64(0x110000) + codes[1:]):
        classes = _mixed(values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(58)
        out.append(int(np.bitwise_xor.reduce(np.uint64(1) << classes, initial=np.uint64(0)).astype(np.int64)))
    return out[0], out[1]


def _alike(a: str, b: str, edits: int) -> Column:
    """What lines within the threshold satisfy, by lengths and parities named ``length_a`` and so on."""
    return F.expr(f"abs(length_{a} - length_{b}) <= {edits} AND bit_count(chars_{a} ^ chars_{b}) <= {2 * edits} AND bit_count(pairs_{a} ^ pairs_{b}) <= {4 * edits}")


def _signs(texts: DataFrame, name: str, *more: str) -> DataFrame:
    return texts.select(F.col("line").alias(name), F.length("text").alias(f"length_{name}"), F.col("chars").alias(f"chars_{name}"), F.col("pairs").alias(f"pairs_{name}"), *(F.col(m).alias(f"{m}_{name}") for m in more))


def _verified(pairs: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    """The pairs (a, b) within the threshold. Lines that lead many pairs are dealt over tasks."""
    near = spread_join(pairs.select("a", "b"), _signs(texts, "a", "text"), "a")
    near = spread_join(near, _signs(texts, "b", "text"), "b").where(_alike("a", "b", edits))

    def run(batches):
        for batch in batches:
            keep = [within(x, y, edits) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return near.select("a", "b", F.col("text_a"), F.col("text_b")).mapInArrow(run, "a long, b long")


def _apart(members: DataFrame, joined: DataFrame) -> DataFrame:
    """Members (key, line, own, component, m) of the keys whose m lines are in several components."""
    placed = cut(members.join(joined.withColumnRenamed("node", "line"), "line", "left").withColumn("component", F.coalesce("component", "line")))
    keys = placed.groupBy("key").agg(F.min("component").alias("c1"), F.max("component").alias("c2"), F.count("line").alias("m")).where("c1 <> c2 AND m > 2").select("key", "m")
    return cut(spread_join(placed, keys, "key"))


def _pairs_of(members: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    """Pairs (a, b) of an indexed line and another one of the same key, of different components, that may be near.

    The lines of a key are compared by their parities inside the join. A key of many lines is cut into blocks of
    about ``BLOCK_LINES``, and each pair of blocks is a task's work, so no task compares more than a block's square.
    """
    open_ = members.join(_signs(texts, "x").withColumnRenamed("x", "line"), "line").withColumn("parts", F.ceil(F.col("m") / BLOCK_LINES).cast("int"))
    part, every = F.pmod(F.xxhash64("line"), F.col("parts")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    signs = ("length", "chars", "pairs")
    left = open_.where("own").select("key", F.col("line").alias("x"), F.col("component").alias("cx"), *(f"{c}_x" for c in signs), part.alias("i"), every.alias("j"))
    right = open_.select("key", F.col("line").alias("y"), F.col("component").alias("cy"), F.col("own").alias("yo"), *(F.col(f"{c}_x").alias(f"{c}_y") for c in signs), part.alias("j"), every.alias("i"))
    meet = F.expr("cx <> cy AND (NOT yo OR x < y)") & _alike("x", "y", edits)
    l, r = left.alias("l"), right.alias("r")
    same = (F.col("l.key") == F.col("r.key")) & (F.col("l.i") == F.col("r.i")) & (F.col("l.j") == F.col("r.j"))
    return l.join(r, same & meet).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_lines(docs: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """(h1, h2, component) of the distinct lines that lie within ``edits`` of another one."""
    min_chars = near_floor(edits, min_chars)
    rows = _segments(docs, edits, min_chars)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = cut(rows.repartition(parts, "key").sortWithinPartitions("key", F.col("own").desc(), "line").mapInArrow(_meetings, "key long, lead long, line long, own boolean"))
    wanted = cut(met.select(F.col("line")).unionByName(met.select(F.col("lead").alias("line"))).distinct())
    texts = cut(_texts_of(docs, wanted, min_chars))
    tried = cut(met.select(F.least("lead", "line").alias("a"), F.greatest("lead", "line").alias("b")).distinct())
    links = cut(_verified(tried, texts, edits))
    joined = components(links)
    members = met.select("key", "line", "own").unionByName(met.select("key", F.col("lead").alias("line"), F.lit(True).alias("own"))).groupBy("key", "line").agg(F.max("own").alias("own"))
    more = _verified(cut(_pairs_of(_apart(members, joined), texts, edits).join(tried, ["a", "b"], "left_anti")), texts, edits)
    more = cut(more)
    joined = joined if more.isEmpty() else components(links.unionByName(more))
    return joined.join(texts.select(F.col("line").alias("node"), "h2"), "node").select(F.col("node").alias("h1"), "h2", F.col("component").alias("c"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per row of ``docs``: id, text without its repeated lines, n_lines, n_dropped.

    A null text stays null with no lines; empty texts stay. Lines shorter than ``min_chars`` always stay,
    and blank ones; those shorter than ``near_floor`` go only if they are equal to an earlier one.
    Within a document the first of equal lines stays. Rows that repeat an id count as one document, so they
    don't take lines from each other; rows with a null id come last in order.
    """
    out, key, at = _rewritten(docs, id_col, text_col, edits, min_chars)
    return out.select(F.col(f"c{key}").alias(id_col), F.col(f"c{at}").alias(text_col), "n_lines", "n_dropped")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with all its columns and its repeated lines dropped; documents that lose every line go."""
    out, _, at = _rewritten(docs, id_col, text_col, edits, min_chars)
    kept = out.where((F.col("n_dropped") == 0) | F.coalesce(F.col(f"c{at}").rlike(r"\S"), F.lit(True)))
    return kept.drop("n_lines", "n_dropped").toDF(*docs.columns)


def _rewritten(docs: DataFrame, id_col: str, text_col: str, edits: int, min_chars: int):
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    dense = source.select(F.coalesce("id", F.lit(2**63 - 1)).alias("id"), "text")
    lines = cut(_lines(dense, min_chars))
    near = near_lines(dense, edits, min_chars)
    firsts = lines.groupBy("h1", "h2").agg(F.countDistinct("id").alias("docs"), F.min("id").alias("doc"), F.min_by("line_no", F.struct("id", "line_no")).alias("line_no"))
    placed = firsts.join(near, ["h1", "h2"], "left").where("docs > 1 OR c IS NOT NULL").withColumn("group", F.when(F.col("c").isNotNull(), F.struct(F.col("c").alias("x"), F.lit(None).cast("long").alias("y"))).otherwise(F.struct(F.col("h1").alias("x"), F.col("h2").alias("y"))))
    best = placed.groupBy("group").agg(F.min(F.struct("doc", "line_no", "h1", "h2")).alias("best"))
    rules = cut(placed.select("h1", "h2", "group").join(best, "group").select("h1", "h2", F.col("best.doc").alias("keep_doc"), ((F.col("best.h1") == F.col("h1")) & (F.col("best.h2") == F.col("h2"))).alias("is_best")))
    dropped = lines.join(rules, ["h1", "h2"]).where(~(F.col("is_best") & (F.col("id") == F.col("keep_doc"))))
    gone = cut(dropped.groupBy("id").agg(F.collect_set("line_no").alias("gone")))
    if (gone.agg(F.sum(F.size("gone"))).first()[0] or 0) <= MOST_BROADCAST:
        gone = F.broadcast(gone)

    renamed = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    key, at, width = docs.columns.index(id_col), docs.columns.index(text_col), len(docs.columns)
    schema = T.StructType([*renamed.schema, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def run(batches):
        for batch in batches:
            texts, totals, dropped = [], [], []
            for text, drop in zip(batch.column(at).to_pylist(), batch.column(width).to_pylist(), strict=True):
                if text is None:
                    texts.append(None)
                    totals.append(0)
                    dropped.append(0)
                    continue
                all_lines, out, seen = text.split("\n"), [], set()
                removed = set(drop or ())
                for k, line in enumerate(all_lines):
                    bare = line.strip()
                    if len(bare) >= min_chars:
                        if bare in seen or k in removed:
                            seen.add(bare)
                            continue
                        seen.add(bare)
                    out.append(line)
                texts.append("\n".join(out))
                totals.append(len(all_lines))
                dropped.append(len(all_lines) - len(out))
            columns = [pa.array(texts, pa.string()) if k == at else batch.column(k) for k in range(width)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(totals, pa.int64()), pa.array(dropped, pa.int64())], names=schema.names)

    keyed = renamed.withColumn("k", F.coalesce(F.col(f"c{key}").cast("long"), F.lit(2**63 - 1))).join(gone.withColumnRenamed("id", "k"), "k", "left")
    out = keyed.select(*renamed.columns, "gone").mapInArrow(run, schema)
    return out, key, at
