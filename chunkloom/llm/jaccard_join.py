"""Jaccard self-join of documents on word shingles through a token-group matrix.

1. Documents with equal shingle sets become one class; only its least id goes on.
2. A pair with Jaccard similarity of at least t shares, among the shingles with the lowest hashes, more
   than chance leaves: with the first (1-t)n + k of n each, at least min(k) of them. Shingles that occur in
   one class alone can't be shared, so classes with fewer others than that drop out. The whole sets of the
   rest are counted in the same way: what a class shares with any other bounds what it shares with one, and
   it need only be looked up under its rarest shingles, one of which each partner has as well.
3. Classes are partitioned into groups of similar ones: each is linked to the class that leads most of its
   rare shingles, if the exact similarity allows; the leader of a shingle is the class with the least share of
   shingles of its own, so the original before its edited copies. Leaders are elected anew among what is
   still apart as long as that joins much. The components of these links in bounded parts, and classes that
   stay single by their most common rare shingle, are the groups. The matrix holds each group's shingle
   union as a row of hashed bits.
4. A class meets the groups of other components that share a rare shingle with it, the smaller component's
   classes the larger one's groups. The bits it has and the group lacks bound the overlap from above; only
   groups whose bound reaches t are opened. An opened group and the classes that opened it are compared as
   blocks, so rows grow with the number of classes and groups that meet, not with pairs of classes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import counted, cut, spread_join
from .components import components

WIDTH, PERCENT = 5, 80
#: Classes of a group at most, and shingles of a group or a block at most unless one class has more.
GROUP_SIZE, GROUP_TOKENS, BLOCK_TOKENS = 64, 100_000, 100_000
#: Ids of classes that are broadcast at most; more are joined by a shuffle.
MOST_BROADCAST = 1_000_000
#: Bits of the matrix for each shingle of a set.
BITS = 8
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_powers = np.ones(1, np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 64), _BASE, np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word between white space, A-Z lower-cased."""
    data = np.frombuffer(text.encode().lower(), np.uint8)
    inside = ~_WHITE[data]
    if not inside.any():
        return np.zeros(0, np.uint64)
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    length = ends - starts
    first = np.cumsum(length) - length
    place = np.arange(int(length.sum())) - np.repeat(first, length)
    powers = _power(int(length.max()))
    values = (data[inside].astype(np.uint64) + np.uint64(1)) * powers[place]
    return _mix(np.add.reduceat(values, first) + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingle_hashes(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; with fewer words all of them are one shingle."""
    words = word_hashes(text or "")
    n = min(width, len(words))
    if not n:
        return words
    count = len(words) - n + 1
    h = np.full(count, n, np.uint64)
    for k in range(n):
        h = _mix(h * np.uint64(0xFF51AFD7ED558CCD) + words[k : k + count])
    return np.unique(h)


def _slack(n, percent):
    """Shingles of n that a partner may lack."""
    return n - -(-n * percent // 100)


def _extra(n):
    """How many shared shingles beyond the least prefix are asked for."""
    return np.maximum(1, -(-n * 6 // 100))


def _least_shared(n, percent):
    """Shared shingles among the prefixes that every partner of a set of n is sure to have."""
    return _extra(-(-n * percent // 100))


def _bits(hashes: np.ndarray) -> bytes:
    """The set as hashed bits, ``BITS`` or more for each member, a power of two in all."""
    size = 1 << max(6, int(BITS * max(1, len(hashes)) - 1).bit_length())
    out = np.zeros(size, np.uint8)
    out[(hashes & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(out).tobytes()


def _folded(bits: np.ndarray, size: int) -> np.ndarray:
    while len(bits) > size:
        half = len(bits) // 2
        bits = bits[:half] | bits[half:]
    return bits


def overlap_bound(n: int, own: bytes, other: bytes) -> int:
    """Upper bound of the overlap of a set of n with the set that ``other`` stands for."""
    a, b = np.frombuffer(own, np.uint8), np.frombuffer(other, np.uint8)
    size = min(len(a), len(b))
    return n - int(np.bitwise_count(_folded(a, size) & ~_folded(b, size)).sum())


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if not len(a) or not len(b):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _prints(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(id, n, f1, f2, prefix): size, 128-bit fingerprint and lowest hashes of each document's set."""

    def run(batches):
        for batch in batches:
            sets = [shingle_hashes(t, width) for t in batch.column(1).to_pylist()]
            f = [[int(_mix(s + np.uint64(salt)).sum(dtype=np.uint64).astype(np.int64)) for s in sets] for salt in (1, 2)]
            prefix = [s[: int(_slack(len(s), percent) + _extra(len(s)))].view(np.int64) for s in sets]
            columns = (pa.array([len(s) for s in sets], pa.int64()), *(pa.array(x, pa.int64()) for x in f), pa.array(prefix, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", "n", "f1", "f2", "prefix"])

    return docs.mapInArrow(run, "id long, n long, f1 long, f2 long, prefix array<long>")


def _tag(n, f1, mask: int):
    """Size and, where ids have several sets, half a fingerprint in one number: with the id it names a set."""
    return F.shiftleft(n, 32) + f1.bitwiseAND(F.lit(mask))


def _size(tag):
    return F.shiftright(tag, 32)


def _sets(docs: DataFrame, width: int, mask: int) -> DataFrame:
    """(id, tag, tokens) of (id, text), texts without words left out."""

    def run(batches):
        for batch in batches:
            rows = []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = shingle_hashes(t, width)
                if len(s):
                    f1 = int(_mix(s + np.uint64(1)).sum(dtype=np.uint64)) if mask else 0
                    rows.append((i, (len(s) << 32) + (f1 & mask), s.view(np.int64)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.list_(pa.int64())), strict=True)], names=["id", "tag", "tokens"])

    return docs.mapInArrow(run, "id long, tag long, tokens array<long>")


def _with_bits(classes: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            bits = [_bits(s) for s in _values(batch.column(batch.schema.names.index("tokens")))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bits, pa.binary())], names=[*batch.schema.names, "bits"])

    return classes.mapInArrow(run, T.StructType([*classes.schema, T.StructField("bits", T.BinaryType())]))


def _values(column) -> list[np.ndarray]:
    """A list column of longs as unsigned arrays, without going through Python numbers."""
    flat, ends = column.values.to_numpy(), column.offsets.to_numpy()
    return [flat[a:b].view(np.uint64) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _linked_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of ids of which a set of each is linked. Some b may come very often."""
    a = sets.select(F.col("id").alias("a"), F.col("tokens").alias("ta"))
    b = sets.select(F.col("id").alias("b"), F.col("tokens").alias("tb"))
    near = F.expr(f"size(ta) * 100L >= size(tb) * {percent}L AND size(tb) * 100L >= size(ta) * {percent}L")
    both = spread_join(pairs.select("a", "b"), b, "b").join(a, "a").where(near)

    def run(batches):
        for batch in batches:
            keep = [linked(x, y, percent) for x, y in zip(_values(batch.column(2)), _values(batch.column(3)), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long").distinct()


def _led(entries: DataFrame, order) -> DataFrame:
    """(a, b): for each a, the class b of another component that leads most of its rare shingles in the given order."""
    head = entries.groupBy("token").agg(F.min_by(F.struct("id", "component"), order).alias("lead"))
    met = spread_join(entries.select("token", "id", "component"), head, "token").where("component <> lead.component")
    best = met.groupBy("id", "lead.id").agg(F.count(F.lit(1)).alias("k")).toDF("a", "b", "k")
    return best.groupBy("a").agg(F.max_by("b", F.struct("k", -F.col("b"))).alias("b"))


def _open(looked_up: DataFrame, state: DataFrame) -> DataFrame:
    """Entries of the shingles that still occur in several components."""
    entries = looked_up.join(state, "id", "left").withColumn("component", F.coalesce("component", "id"))
    apart = entries.groupBy("token").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).where("c1 <> c2").select("token")
    return spread_join(entries, apart, "token")


def _unions(members: DataFrame) -> DataFrame:
    """(group, row): the matrix row of each group, the union of its bits. Groups are of bounded size."""

    def run(key, batch):
        bits = [np.frombuffer(b, np.uint8) for b in batch.column("bits").to_pylist()]
        size = min(map(len, bits))
        out = np.zeros(size, np.uint8)
        for b in bits:
            out |= _folded(b, size)
        return pa.table({"group": pa.array([key[0].as_py()], pa.int64()), "row": pa.array([out.tobytes()], pa.binary())})

    return members.select("group", "bits").groupBy("group").applyInArrow(run, "group long, row binary")


def _opened(met: DataFrame, percent: int) -> DataFrame:
    """Rows (a, tag, group) of (a, tag, group, bits, row) whose bound reaches the threshold."""

    def run(batches):
        for batch in batches:
            tags, bits, rows = batch.column(1).to_numpy(), batch.column(3).to_pylist(), batch.column(4).to_pylist()
            keep = [100 * overlap_bound(t >> 32, x, y) >= percent * (t >> 32) for t, x, y in zip(tags.tolist(), bits, rows, strict=True)]
            yield batch.select(["a", "tag", "group"]).filter(pa.array(keep, pa.bool_()))

    return met.select("a", "tag", "group", "bits", "row").mapInArrow(run, "a long, tag long, group long")


def _compared(percent: int):
    """Links (a, b) of a block of probing classes with a group's members, one for each component met."""

    def run(key, probes, members):
        out_a, out_b = [], []
        if probes.num_rows and members.num_rows:
            held = _values(members.column("tokens").combine_chunks())
            tokens = np.concatenate(held)
            owner = np.repeat(np.arange(len(held)), list(map(len, held)))
            order = np.argsort(tokens, kind="stable")
            tokens, owner, sizes = tokens[order], owner[order], np.array(list(map(len, held)))
            ids, components_ = members.column("id").to_numpy(), members.column("component").to_numpy()
            for a, c, own in zip(*(probes.column(f"probe_{c}").to_pylist() for c in ("id", "component")), _values(probes.column("probe_tokens").combine_chunks()), strict=True):
                low, high = np.searchsorted(tokens, own, "left"), np.searchsorted(tokens, own, "right")
                count = high - low
                at = np.arange(int(count.sum())) + np.repeat(low - (np.cumsum(count) - count), count)
                shared = np.bincount(owner[at], minlength=len(held))
                ok = (100 * shared >= percent * (sizes + len(own) - shared)) & (components_ != c)
                for k in np.flatnonzero(ok)[np.unique(components_[ok], return_index=True)[1]].tolist():
                    out_a.append(a)
                    out_b.append(int(ids[k]))
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    return run


def _groups(open_: DataFrame, sets: DataFrame) -> DataFrame:
    """(id, tag, tokens, bits, component, cell, size, group) of the classes with open entries.

    A cell is a component, or single classes with one most common rare shingle; groups are its parts.
    """
    classes = open_.groupBy("id", "tag").agg(F.min("component").alias("component"), F.max(F.struct("df", "token")).alias("common"))
    sizes = classes.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    classes = spread_join(classes, sizes, "component").withColumn("single", F.col("size") == 1)
    classes = classes.withColumn("cell", F.when(F.col("single"), F.xxhash64("common.token")).otherwise(F.col("component")))
    cells = classes.groupBy("single", "cell").agg(F.count(F.lit(1)).alias("count"), F.sum(_size(F.col("tag"))).alias("total")).select(F.struct("single", "cell").alias("at"), F.ceil(F.greatest(F.col("count") / GROUP_SIZE, F.col("total") / GROUP_TOKENS)).alias("parts"))
    placed = spread_join(classes.withColumn("at", F.struct("single", "cell")), cells, "at")
    group = F.xxhash64("single", "cell", F.pmod(F.xxhash64("id", "tag"), F.col("parts")))
    return placed.select("id", "tag", "component", "cell", "size", group.alias("group")).join(sets, ["id", "tag"]).transform(_with_bits)


def _ties(prints: DataFrame, reps: DataFrame, repeated: DataFrame) -> DataFrame:
    """Links (a, b) of ids that come repeatedly with the least ids of their sets."""
    named = prints.where("n > 0").join(repeated, "id", "left_semi").select("id", F.struct("f1", "f2", "n").alias("set"))
    own = named.join(reps.select(F.struct("f1", "f2", "n").alias("set"), "rep"), "set")
    return cut(own.select(F.col("id").alias("a"), F.col("rep").alias("b")).distinct())


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per document: n_shingles and component_id, the least id reachable by links.

    Texts that are null, empty or white space have no shingle and link with nothing. Rows that repeat an
    id are one node of the links, whatever their texts, and each is returned. Rows with a null id take no
    part and come back with a null component. An empty table gives no rows; further columns and their names
    don't matter; of equal choices the least id leads. Texts of any length are read whole. Every link
    between different sets is either found or lies inside a component that is already joined.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    every = cut(_prints(source, width, percent))
    prints = cut(every.drop("prefix"))
    repeated = cut(prints.where("id IS NOT NULL").groupBy("id").count().where("count > 1").select("id"))
    mask = 0 if repeated.isEmpty() else 0xFFFFFFFF
    named = every.where("id IS NOT NULL AND n > 0")
    classes = named.groupBy("f1", "f2", "n").agg(F.min("id").alias("id"), F.min_by("prefix", "id").alias("prefix"))
    tokens = classes.select(F.explode("prefix").alias("token"), "id", _tag(F.col("n"), F.col("f1"), mask).alias("tag"))
    sampled = named.select(F.explode("prefix").alias("token"), "id")
    sure = F.greatest(F.lit(1), F.ceil(F.ceil(_size(F.col("tag")) * percent / 100) * 6 / 100))
    left = counted(tokens, "token", sampled).where("df > 1").groupBy("id", "tag").agg(F.count(F.lit(1)).alias("others")).where(F.col("others") >= sure)
    survivors = cut(left.select("id").distinct())
    del tokens, classes, left, sampled, named, every

    wanted = F.broadcast(survivors) if survivors.count() <= MOST_BROADCAST else survivors
    sets = _sets(source.where("id IS NOT NULL").join(wanted, "id", "left_semi"), width, mask)
    sets = cut(sets.dropDuplicates(["id", "tag"]) if mask else sets)
    tokens = sets.select(F.explode("tokens").alias("token"), "id", "tag")
    enough = F.ceil(_size(F.col("tag")) * percent / 100).cast("int")
    shared = counted(tokens, "token", tokens).where("df > 1")
    left = shared.groupBy("id", "tag").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("others")).where(F.size("others") >= enough)
    rare = left.select("id", "tag", (1 - F.size("others") / _size(F.col("tag"))).alias("own_share"), F.explode(F.slice("others", F.lit(1), F.size("others") - enough + 1)).alias("o"))
    looked_up = cut(rare.select("id", "tag", "own_share", F.col("o.df").alias("df"), F.col("o.token").alias("token")))
    sets = sets.join(looked_up.select("id").distinct(), "id", "left_semi")
    del tokens, shared, left, rare

    reps = prints.where("n > 0 AND id IS NOT NULL").groupBy("f1", "f2", "n").agg(F.min("id").alias("rep"))
    links = _ties(prints, reps, repeated) if mask else None
    state = looked_up.select("id", F.col("id").alias("component")).distinct() if links is None else components(links).withColumnRenamed("node", "id")
    turn = 0
    while True:
        open_ = cut(_open(looked_up, state))
        if open_.isEmpty():
            break
        if turn == 0:
            led = _led(open_, F.struct("own_share", "id")).unionByName(_led(open_, F.xxhash64("id"))).distinct()
        else:
            led = _led(open_, F.struct(F.xxhash64("component", F.lit(turn)), F.xxhash64("id", F.lit(turn))))
        found = cut(_linked_pairs(cut(led), sets, percent))
        apart, new = open_.select("id").distinct().count(), found.count()
        if new:
            links = found if links is None else links.unionByName(found)
            state = components(links).withColumnRenamed("node", "id")
            open_ = None
        turn += 1
        if 10 * new < apart:
            break

    open_ = cut(_open(looked_up, state)) if open_ is None else open_
    if not open_.isEmpty():
        members = cut(_groups(open_, sets))
        at = open_.select("token", "id", "tag").join(members.select("id", "tag", "component", "cell", "size", "group"), ["id", "tag"])
        cells = at.select("token", "cell", "size").distinct()
        small, large = cells.toDF("token", "x", "sx"), cells.toDF("token", "y", "sy")
        facing = small.join(large, "token").where("sx < sy OR (sx = sy AND (x < y OR (x = y AND sx = 1)))").select("token", "x", "sx", "y", "sy")
        probing = at.select("token", F.col("cell").alias("x"), F.col("size").alias("sx"), F.col("id").alias("a"), "tag")
        held = at.select("token", F.col("cell").alias("y"), F.col("size").alias("sy"), "group").distinct()
        met = facing.join(held, ["token", "y", "sy"]).join(probing, ["token", "x", "sx"]).select("a", "tag", "group").distinct()
        met = cut(met.join(members.select(F.col("id").alias("a"), "tag", "bits"), ["a", "tag"]))
        opened = cut(_opened(spread_join(met, _unions(members), "group"), percent))
        slices = opened.groupBy("group").agg(F.ceil(F.sum(_size(F.col("tag"))) / BLOCK_TOKENS).alias("slices"))
        dealt = spread_join(opened, slices, "group").withColumn("slice", F.pmod(F.xxhash64("a", "tag"), F.col("slices")).cast("long"))
        probes = dealt.select(F.col("a").alias("id"), "tag", "group", "slice").join(members.select("id", "tag", "component", "tokens"), ["id", "tag"])
        blocks = members.select("id", "component", "tokens", "group").join(slices, "group").withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices").cast("long") - 1)))
        left = probes.select(*(F.col(c).alias(f"probe_{c}") for c in ("group", "slice", "id", "component", "tokens")))
        right = blocks.select("group", "slice", "id", "component", "tokens")
        found = cut(left.groupBy("probe_group", "probe_slice").cogroup(right.groupBy("group", "slice")).applyInArrow(_compared(percent), "a long, b long"))
        if not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            state = components(links).withColumnRenamed("node", "id")

    placed = reps.join(state.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    keyed = placed.select(F.struct("f1", "f2", "n").alias("set"), "component")
    every = prints.where("id IS NOT NULL").withColumn("set", F.struct("f1", "f2", "n"))
    out = spread_join(every, keyed, "set", "left")
    out = out.select("id", "n", F.coalesce("component", "id").alias("component")).unionByName(prints.where("id IS NULL").select("id", "n", F.col("id").alias("component")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
