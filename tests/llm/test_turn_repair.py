"""Repairs against a plain search over all edits."""

import hashlib
import random
import re
import zlib

import pytest

from chunkloom.llm import turn_repair

GRAMMAR = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
BLANKS = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [] if fate == 0 else [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def cheapest(rows, kinds):
    """Best (cost, audit, turns) for each state after each row, by relaxing every edit; inserts anywhere."""

    def inserted(at):
        for _ in range(2):  # states reached by inserts
            for state, (cost, audit, turns) in list(at.items()):
                for role in ("user", "assistant"):
                    to = GRAMMAR[state].get(role[0])
                    if to:
                        relax(at, to, (cost + 5, audit + "I", [*turns, (role, "")]))
        return at

    def relax(at, state, new):
        if state not in at or new[:2] < at[state][:2]:
            at[state] = new

    at = inserted({"": (0, "", [])})
    for (_, role, text), kind in zip(rows, kinds):
        new = {}
        for state, (cost, audit, turns) in at.items():
            relax(new, state, (cost + 2, audit + "D", turns))
            if kind in ("blank", "duplicate"):
                continue
            extra = 5 * (kind == "truncated")
            if role[:1] in GRAMMAR[state]:
                relax(new, role[0], (cost + extra, audit + "K", [*turns, (role, text)]))
            for other in ("user", "assistant"):
                if other[0] in GRAMMAR[state]:
                    relax(new, other[0], (cost + 1 + extra, audit + "R", [*turns, (other, text)]))
        at = inserted(new)
    return min(at[s][:2] + (at[s][2],) for s in ("", "a") if s in at)


def plain(rows):
    out = []
    for conv in sorted({r[0] for r in rows}, key=lambda c: (c is not None, c or 0)):
        own = damaged([r for r in rows if r[0] == conv])
        seen, kinds = set(), []
        for _, role, text in own:
            body = text.strip(BLANKS)
            kinds.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        wrong = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, repaired = cheapest(own, kinds)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out.append((conv, gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), wrong, cost, audit, digest))
    return sorted(out, key=str)


def got(df):
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "p") for r in rows], "conv_id long, turn long, role string, text string, n int, part int, print string")


def random_rows(seed, convs, most, roles=("user", "assistant", "system", "tool", "", None)):
    rnd = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "and then", "Done. \n", " \t", "", None, "é…", "last one.  ", "x\x1c"]
    rows = []
    for conv in range(convs):
        for turn in range(rnd.randint(1, most)):
            rows.append((None if conv == 5 else conv, rnd.choice([turn, turn, turn, turn + 3, None]), rnd.choice(roles[:2] if rnd.random() < 0.7 else roles), rnd.choice(texts) if rnd.random() < 0.5 else f"Text {rnd.random()}."))
    return rows


def test_small_conversations(spark):
    rows = random_rows(1, 300, 9)
    assert got(turn_repair.repair(frame(spark, rows))) == plain(rows)


def test_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    assert got(turn_repair.repair(table)) == plain([(r.conv_id, r.turn, r.role, r.text) for r in table.collect()])


@pytest.mark.parametrize("seed", [2, 3])
def test_long_conversations_over_tasks(spark, seed, monkeypatch):
    monkeypatch.setattr(turn_repair, "PIECE_CHARS", 40)
    rnd = random.Random(seed)
    rows = random_rows(seed, 4, 5)
    rows += [(100 + k % 2, k // 2, rnd.choice(["user", "assistant", "assistant", "system"]), rnd.choice(["Yes.", "hm", "", f"Number {k}.", f"open {k}"])) for k in range(1500)]
    rows += [(200, None, "user", f"Word {k}.") for k in range(300)]  # no numbers at all
    rows += [(201, 7, "user", "Same.")] * 400
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that tasks are not joined
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert got(turn_repair.repair(frame(spark, rows))) == plain(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_none_left_and_none_at_all(spark):
    assert got(turn_repair.repair(frame(spark, []))) == []
    gone = [(c, 0, "user", "Hello.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert gone and got(turn_repair.repair(frame(spark, gone))) == plain(gone)
    assert {r[1:] for r in plain(gone)} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
