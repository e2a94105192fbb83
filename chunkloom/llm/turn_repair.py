"""Conversation structure repair by a dynamic program over retained turns.

Turns are kept, get another role, or are deleted, and turns are inserted, at the least cost, so that roles
alternate. The program runs from a conversation's end. A retained turn with its role costs its own edit and
the cheapest way on: for each role the least of (deletions before the next retained turn with that role +
what follows it), which is a running minimum because deletions are differences of a prefix sum; the two
roles determine how many turns are inserted between. Equal costs go to the least audit: the later of two
next turns has more D's first, and of one turn's roles the letters decide.

Rows are sorted over all tasks by conversation and turn, so a conversation may stretch over several tasks.
Each end of a task's rows that belongs to such a conversation gives the costs from each role to each, the
driver chains these (two per task), and then the roles, so that every task repairs its own rows.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import Shipped, cut, spread_join

# Fixed values of the contract: costs of edits, white space, ends of sentences.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
BLANK, STOPS, CUTS = r"[\x20\x09-\x0D]", ".!?", "[.!?]"
#: States: the role of the retained turn before, or none; and what a turn is.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
ROLE = {USER: "user", ASSISTANT: "assistant"}
SOUND, IS_BLANK, IS_DUPLICATE, IS_TRUNCATED = range(4)
#: Turns to insert between roles, by the role before and the role after, and before the end.
BETWEEN = {START: {SYSTEM: 0, USER: 0, ASSISTANT: 1}, SYSTEM: {USER: 0, ASSISTANT: 1}, USER: {ASSISTANT: 0, USER: 1}, ASSISTANT: {USER: 0, ASSISTANT: 1}}
AT_END = (0, 2, 1, 0)
FAR = 1 << 60
#: Characters of repaired text that travel in one row of a conversation that stretches over tasks.
PIECE_CHARS = 1 << 20


def damaged(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, n): the damaged turns, nulls as one space, equal ones as one row with a count.

    A dropped turn leaves a row without text and with n 0, so that its conversation isn't lost.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(said(conv), F.lit(":"), said(turn)).cast("binary")) % 20
    rows = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), said(role).alias("role"), said(text).alias("text"), fate.alias("fate"))
    gone = F.col("fate") == 0
    new_text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", CUTS, "")).otherwise(F.col("text"))
    whole = lambda c: F.when(~gone, c)
    rows = rows.select("conv", whole(F.col("turn")).alias("turn"), whole(F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))).alias("role"), whole(new_text).alias("text"), F.when(gone, 0).when(F.col("fate") == 3, 2).otherwise(1).alias("n"))
    return rows.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n"))


def fault(text: Column, again: Column) -> Column:
    last = F.regexp_extract(text, rf"([^\x20\x09-\x0D]){BLANK}*\z", 1)
    return F.when(last == "", IS_BLANK).when(again, IS_DUPLICATE).when(~last.rlike(CUTS), IS_TRUNCATED).otherwise(SOUND)


def ordered(turns: DataFrame) -> DataFrame:
    """The damaged turns with their faults, sorted over all tasks; those of one turn number by role and text.

    Tasks are bounded by the first characters of a text at most, which are all that travels to the driver when
    the bounds are drawn.
    """
    print_ = F.struct(F.xxhash64("conv", "role", "text").alias("h1"), F.xxhash64(F.lit(1), "conv", "role", "text").alias("h2"))
    rows = cut(turns.withColumn("print", print_))
    first = rows.where("n > 0").groupBy("print").agg(F.min(F.struct("turn")).alias("first"))
    marked = spread_join(rows, first, "print", "left").withColumn("fault", fault(F.col("text"), ~F.col("first.turn").eqNullSafe(F.col("turn"))))
    dealt = marked.drop("print", "first").repartitionByRange("conv", "turn", "role", F.substring("text", 1, 200))
    return cut(dealt.sortWithinPartitions("conv", "turn", "role", "text").withColumn("part", F.spark_partition_id()), as_dealt=True)


class Run:
    """Turns of one conversation in one task, in order; each with its role's state, its fault and its count."""

    def __init__(self, rows: list[dict]):
        self.rows = rows
        self.sums = [0]  # what deleting the first rows costs
        for r in rows:
            self.sums.append(self.sums[-1] + DELETE * r["n"])

    def solve(self, end: list[int]) -> list[int]:
        """The least cost from each state to the conversation's end, if from this run's end it costs ``end``."""
        rows, sums = self.rows, self.sums
        n, total = len(rows), sums[-1]
        best: dict[int, tuple[int, int, str]] = {}  # by role: deletions and cost from the next turn that is retained with it, the turn, its letter
        self.next: dict[tuple[int, int], tuple[int, int]] = {}

        def way(state: int) -> tuple[int, tuple[int, int] | None]:
            cost, where, lead = total + end[state], n, ""
            to = None
            for role, inserts in BETWEEN[state].items():
                if role in best:
                    value, at, letter = best[role]
                    key = value + INSERT * inserts, -at, "I" * inserts + letter
                    if key < (cost, -where, lead):
                        (cost, _, lead), where, to = key, at, (at, role)
            return cost, to

        for at in range(n - 1, -1, -1):
            row = rows[at]
            if row["fault"] in (IS_BLANK, IS_DUPLICATE) or not row["n"]:
                continue
            own, extra = STATES.get(row["role"][:1]), DELETE * (row["n"] - 1) + (TRUNCATED if row["fault"] == IS_TRUNCATED else 0)
            ways = [(role, 0 if role == own else REROLE, "K" if role == own else "R") for role in (SYSTEM, USER, ASSISTANT) if role == own or role != SYSTEM]
            found = []
            for role, edit, letter in ways:
                on, to = way(role)
                self.next[at, role] = to
                found.append((role, sums[at] + edit + extra + on - sums[at + 1], letter))
            for role, value, letter in found:
                if role not in best or value < best[role][0]:  # of equal ones the later turn has more deletions first
                    best[role] = value, at, letter
        starts = [way(state) for state in range(4)]
        self.first = [to for _, to in starts]
        return [min(cost, FAR) for cost, _ in starts]

    def retained(self, state: int):
        """(turn, role) of the turns that are retained from ``state`` on, and the last role."""
        to, out = self.first[state], []
        while to is not None:
            out.append(to)
            state, to = to[1], self.next[to]
        return out, state

    def repaired(self, state: int, last: bool) -> tuple[str, list[tuple[str, str]], int]:
        """The audit, the repaired turns and the last role, if ``state`` came before; ``last`` if the conversation ends here."""
        chosen, end = self.retained(state)
        audit, turns, at = [], [], 0

        def insert(before: int, n: int) -> int:
            for _ in range(n):
                before = ASSISTANT if before == USER else USER
                audit.append("I")
                turns.append((ROLE[before], ""))
            return before

        def delete(n: int):
            audit.append("D" * n)

        for k, role in chosen:
            row = self.rows[k]
            delete((self.sums[k] - self.sums[at]) // DELETE)
            insert(state, BETWEEN[state][role])
            kept = STATES.get(row["role"][:1]) == role
            audit.append("K" if kept else "R")
            turns.append((row["role"] if kept else ROLE[role], row["text"]))
            delete(row["n"] - 1)
            state, at = role, k + 1
        delete((self.sums[-1] - self.sums[at]) // DELETE)
        if last:
            insert(state, AT_END[state])
        return "".join(audit), turns, end

    def counts(self) -> dict[str, int]:
        """Faults, adjacent roles that don't fit within the run, and what the gaps need."""
        out = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
        rows = [r for r in self.rows if r["n"]]
        before = None
        for r in rows:
            kind, n, initial = r["fault"], r["n"], r["role"][:1]
            out["blank"] += n if kind == IS_BLANK else 0
            out["duplicate"] += 0 if kind == IS_BLANK else n if kind == IS_DUPLICATE else n - 1
            out["truncated"] += kind == IS_TRUNCATED
            if before is not None:
                out["illegal"] += illegal(before["role"][:1], initial)
            out["illegal"] += n - 1  # equal rows side by side
            if r["turn"] is not None and (before is None or before["turn"] != r["turn"]):
                out["turns"] += 1
            before = r
        known = [r["turn"] for r in rows if r["turn"] is not None]
        out |= {"low": known[0] if known else None, "high": known[-1] if known else None}
        return out | {"first_role": rows[0]["role"][:1] if rows else None, "last_role": rows[-1]["role"][:1] if rows else None}


def illegal(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


def _runs(batches, names: list[str]):
    """(part, conv, Run) for each conversation of a task, one at a time."""

    def rows():
        for batch in batches:
            yield from (dict(zip(names, values, strict=True)) for values in zip(*(c.to_pylist() for c in batch.columns), strict=True))

    for (part, conv), own in groupby(rows(), key=lambda r: (r["part"], r["conv"])):
        yield part, conv, Run(list(own))


EDGES = "part int, first boolean, last boolean, matrix array<array<long>>"


def _edges(turns: DataFrame) -> list:
    """Of each task its first and its last conversation with the costs from each state to each: two rows a task."""
    conv = turns.schema["conv"]
    schema = T.StructType([*T.StructType.fromDDL(EDGES), T.StructField("conv", conv.dataType)])
    names = ["part", "conv", "n", "role", "fault"]

    def run(batches):
        kept, n = [], 0
        for part, conv, r in _runs(batches, names):
            n += 1
            kept = [kept[0], (part, conv, r)] if kept else [(part, conv, r)]
        out = []
        for k, (part, conv, r) in enumerate(kept):
            matrix = [r.solve([0 if t == e else FAR for t in range(4)]) for e in range(4)]
            out.append({"part": part, "first": k == 0, "last": k == len(kept) - 1, "matrix": [[matrix[e][t] for e in range(4)] for t in range(4)], "conv": conv})
        yield pa.RecordBatch.from_pylist(out, to_arrow_schema(schema))

    rows = turns.select(*names).mapInArrow(run, schema).collect()
    return sorted(rows, key=lambda r: (r.part, not r.first))


def _chains(edges: list) -> list[list]:
    """The edges of conversations that stretch over several tasks, each conversation's in order."""
    out: list[list] = []
    for e in edges:
        if out and e.first and out[-1][-1].last and out[-1][-1].conv == e.conv:
            out[-1].append(e)
        else:
            out.append([e])
    return [c for c in out if len(c) > 1]


def _ends(chains: list[list]) -> dict[tuple[int, bool], list[int]]:
    """For each edge of a chain, by its part and whether it is the part's first, the costs from its end to the conversation's."""
    out = {}
    for chain in chains:
        end = [INSERT * k for k in AT_END]
        for e in reversed(chain):
            out[e.part, e.first] = end
            end = [min(FAR, min(e.matrix[t][x] + end[x] for x in range(4))) for t in range(4)]
    return out


def _roles(turns: DataFrame, chains: list[list], ends: dict) -> dict[tuple[int, bool], int]:
    """For each edge of a chain the role that is retained last before it."""
    sent, names = Shipped(turns.sparkSession, ends), ["part", "conv", "n", "role", "fault"]
    schema = "part int, first boolean, to array<int>"

    def run(batches):
        known, n, out, last = sent.built(lambda e: e), 0, [], None

        def edge(part, first, r):
            if (part, first) in known:
                r.solve(known[part, first])
                out.append({"part": part, "first": first, "to": [r.retained(t)[1] for t in range(4)]})

        for part, _, r in _runs(batches, names):
            if n == 0:
                edge(part, True, r)
            else:
                last = part, r
            n += 1
        if last is not None:
            edge(last[0], False, last[1])
        yield pa.RecordBatch.from_pylist(out, pa.schema([("part", pa.int32()), ("first", pa.bool_()), ("to", pa.list_(pa.int32()))]))

    to = {(r.part, r.first): r.to for r in turns.select(*names).mapInArrow(run, schema).collect()}
    out = {}
    for chain in chains:
        state = START
        for e in chain:
            out[e.part, e.first] = state
            state = to[e.part, e.first][state]
    return out


COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
PIECE = "part int, piece int, counts array<long>, low long, high long, first_role string, last_role string, letters string, body string"


def _line(turns: list[tuple[str, str]]) -> str:
    return "\n".join(f"{role}:{text}" for role, text in turns)


def cost_of(audit: str, truncated: int) -> int:
    return audit.count("R") * REROLE + audit.count("D") * DELETE + audit.count("I") * INSERT + truncated * TRUNCATED


def _result(counts: dict, cost: int, audit: str, digest: str) -> dict:
    gaps = counts["high"] - counts["low"] + 1 - counts["turns"] if counts["high"] is not None else 0
    return {"gaps": gaps, **{k: counts[k] for k in COUNTS if k != "turns"}, "cost": cost, "audit": audit, "repaired_sha256": digest}


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", damage: bool = True) -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    With ``damage`` the rows are damaged first, as the registered query asks. Null roles and texts count as one
    space, null turns come first, and a null conversation is one of its own. Turns with one number are ordered by
    role and text; rows that are equal in all columns are duplicates of the first. An empty table gives no rows;
    further columns and their names don't matter. Texts are whole. A conversation of any length is repaired by as
    many tasks as hold its rows; only its digest, which has no parts, is worked out by one task that reads its
    repaired turns in order without keeping them.
    """
    key = rows.schema[conv_col]
    turns = damaged(rows, conv_col, turn_col, role_col, text_col) if damage else whole(rows, conv_col, turn_col, role_col, text_col)
    turns = ordered(turns)
    chains = _chains(_edges(turns))
    ends = _ends(chains)
    sent = Shipped(turns.sparkSession, (ends, _roles(turns, chains, ends) if chains else {}, {(c[-1].part, c[-1].first) for c in chains}))
    names = ["part", "conv", "n", "role", "fault", "turn", "text"]
    done = T.StructType([T.StructField("conv", key.dataType), *T.StructType.fromDDL(RESULT), *T.StructType.fromDDL(PIECE)])
    arrow = to_arrow_schema(done)

    def run(batches):
        ends, roles, lasts = sent.built(lambda v: v)

        def rows_of(part, first, conv, r):
            """``first`` tells a task's first conversation from its last; it is None for those between."""
            end = ends.get((part, first))
            if end is None:
                cost = r.solve([INSERT * k for k in AT_END])[START]
                audit, repaired, _ = r.repaired(START, True)
                yield {"conv": conv} | _result(r.counts(), cost, audit, hashlib.sha256(_line(repaired).encode()).hexdigest())
                return
            r.solve(end)
            audit, repaired, _ = r.repaired(roles[part, first], (part, first) in lasts)
            counts, pieces, size = r.counts(), [[]], 0
            for t in repaired:
                if size > PIECE_CHARS:
                    pieces.append([])
                    size = 0
                pieces[-1].append(t)
                size += len(t[1])
            undeleted = sum(r.rows[k]["fault"] == IS_TRUNCATED for k, _ in r.retained(roles[part, first])[0])
            for k, own in enumerate(pieces):
                yield {"conv": conv, "part": part, "piece": k, "body": _line(own) if own else None} | ({"counts": [*(counts[c] for c in COUNTS), cost_of(audit, undeleted)], "letters": audit, **{c: counts[c] for c in ("low", "high", "first_role", "last_role")}} if k == 0 else {})

        def all_rows():
            first, held = True, None
            for part, conv, r in _runs(batches, names):
                if held is not None:
                    yield from rows_of(held[0], None, *held[1:])
                if first:
                    yield from rows_of(part, True, conv, r)
                else:
                    held = part, conv, r
                first = False
            if held is not None:
                yield from rows_of(held[0], False, *held[1:])

        out = []
        for row in all_rows():
            out.append(row)
            if len(out) == 200:
                yield pa.RecordBatch.from_pylist(out, arrow)
                out = []
        yield pa.RecordBatch.from_pylist(out, arrow)

    made = turns.select(*names).mapInArrow(run, done)
    fields = [f.name for f in T.StructType.fromDDL(RESULT)]
    if not chains:
        return made.select(F.col("conv").alias(conv_col), *fields)
    made = cut(made)
    joined = _joined(made.where("part IS NOT NULL").drop(*fields), key.dataType)
    return made.where("part IS NULL").select("conv", *fields).unionByName(joined).withColumnRenamed("conv", conv_col)


def whole(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The rows as they are, in the form of ``damaged``."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), said(role).alias("role"), said(text).alias("text"))
    return rows.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))


def _joined(pieces: DataFrame, kind: T.DataType) -> DataFrame:
    """The results of conversations that stretch over tasks, from the tasks' pieces in order."""
    schema = T.StructType([T.StructField("conv", kind), *T.StructType.fromDDL(RESULT)])
    arrow, names = to_arrow_schema(schema), pieces.columns

    def run(batches):
        def rows():
            for batch in batches:
                yield from (dict(zip(names, values, strict=True)) for values in zip(*(c.to_pylist() for c in batch.columns), strict=True))

        for conv, own in groupby(rows(), key=lambda r: r["conv"]):
            counts, digest, audit, cost, before, begun = dict.fromkeys(COUNTS, 0) | {"low": None, "high": None}, hashlib.sha256(), [], 0, None, False
            for r in own:
                if r["counts"] is not None:
                    for c, v in zip(COUNTS, r["counts"], strict=False):
                        counts[c] += v
                    cost += r["counts"][-1]
                    audit.append(r["letters"])
                    if before is not None and r["first_role"] is not None:
                        counts["illegal"] += illegal(before, r["first_role"])
                    before = r["last_role"] if r["last_role"] is not None else before
                    if r["low"] is not None:
                        counts["turns"] -= counts["high"] == r["low"]
                        counts["low"], counts["high"] = (r["low"] if counts["low"] is None else counts["low"]), r["high"]
                if r["body"] is not None:
                    digest.update((("\n" if begun else "") + r["body"]).encode())
                    begun = True
            yield pa.RecordBatch.from_pylist([{"conv": conv} | _result(counts, cost, "".join(audit), digest.hexdigest())], arrow)

    return pieces.repartition("conv").sortWithinPartitions("conv", "part", "piece").mapInArrow(run, schema)
