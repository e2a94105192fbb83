import itertools
import random

import pytest

from chunkloom.llm.line_dedup import EDITS, MIN_CHARS, _plain, dedup_lines, own_places, places, within


def brute(rows, edits, min_chars):
    """Texts after dropping, for rows of (id, text), by comparing all pairs of lines."""
    lines = {}
    for i, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            if len(line.strip()) >= min_chars:
                lines.setdefault(line.strip(), (i, k))
                lines[line.strip()] = min(lines[line.strip()], (i, k))
    parent = {x: x for x in lines}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(lines, 2):
        if _plain(a, b) <= edits:
            parent[find(a)] = find(b)
    best = {}
    for x, at in lines.items():
        best[find(x)] = min(best.get(find(x), (at, x)), (at, x))
    out = {}
    for i, text in rows:
        kept, seen = [], set()
        for line in (text or "").split("\n"):
            bare = line.strip()
            if len(bare) >= min_chars:
                (doc, _), first = best[find(bare)]
                if bare in seen or (doc, first) != (i, bare):
                    seen.add(bare)
                    continue
                seen.add(bare)
            kept.append(line)
        out[i] = None if text is None else "\n".join(kept)
    return out


def corpus(seed, n=30):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcd efg") for _ in range(rnd.randint(20, 60))).strip() for _ in range(25)]

    def changed(line):
        chars = list(line)
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randrange(len(chars))
            chars[at : at + rnd.randint(0, 1)] = rnd.choice(["", "x", "é"])
        return "".join(chars)

    rows = [(i, "\n".join(changed(rnd.choice(base)) for _ in range(rnd.randint(0, 6)))) for i in range(n)]
    return [*rows, (n, None), (n + 1, ""), (n + 2, "y" * 5000 + "\n" + base[0]), (n + 3, "y" * 4999 + "z\n  " + base[0] + " ")]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, line_no string")
    got = {r.doc_id: r.text for r in dedup_lines(docs).collect()}
    assert got == brute(rows, EDITS, MIN_CHARS)


def test_empty_table_and_null_id(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert dedup_lines(empty).count() == 0
    line = "a line that is long enough to take part here"
    docs = spark.createDataFrame([(None, line), (3, line), (3, line)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.text) for r in dedup_lines(docs).collect()) == [(0, ""), (3, line), (3, line)]


def test_band_distance():
    rnd = random.Random(5)
    for _ in range(3000):
        a = "".join(rnd.choice("ab") for _ in range(rnd.randint(0, 12)))
        b = "".join(rnd.choice("abc") if rnd.random() < 0.2 else c for c in a)[rnd.randint(0, 1) :]
        for most in (1, 2, 3):
            assert within(a, b, most) == (_plain(a, b) <= most)


def test_own_places_are_probed():
    for n in range(3, 40):
        assert set(own_places(n, 2)) <= set(places(n, n, 2))


def test_each_key_of_three_lines_is_opened(spark):
    """z is within two edits of y only, and they share one segment with a third line; a sketch of three may say two."""
    rnd, docs = random.Random(7), ([], [], [])
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(15))
    for _ in range(4000):
        head, middle, tail = word(), word(), word()
        docs[0].append(word() + middle + word())
        docs[1].append(head + middle + tail)
        docs[2].append(head[:7] + "#" + head[8:] + middle + tail[:7] + "#" + tail[8:])
    frame = spark.createDataFrame([(k, "\n".join(d)) for k, d in enumerate(docs)], "doc_id long, text string")
    assert {r.doc_id: r.n_dropped for r in dedup_lines(frame).collect()} == {0: 0, 1: 0, 2: 4000}


def test_short_lines(spark):
    rows = [(1, "}\n\nAll rights reserved.\nx = 1\n ten chars!"), (2, "All rights reserved\n}\n\nx = 2\nx = 1\n ten chars?\n9 chars 1"), (3, "9 chars 2\n}\n}\n\n9 chars 1")]
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "\nx = 2\n9 chars 1", 3: "9 chars 2\n"}
