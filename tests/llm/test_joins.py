"""Operators across documents against comparing all pairs."""

import random
import re

import numpy as np

from pyspark.sql import functions as F

from chunkloom.llm import decontamination, embedding_dedup, jaccard_join, surrogates


def shingle_set(text, width=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def components_of(ids, linked):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_jaccard_groups(spark):
    rnd = random.Random(11)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = [rnd.choice(vocabulary) for _ in range(30)]
    rows = []
    for base in range(6):
        words = [rnd.choice(vocabulary) for _ in range(rnd.choice([8, 40, 150]))]
        for _ in range(7):
            copy = list(words)
            for _ in range(rnd.randint(0, max(1, len(words) // 25))):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            rows.append(" ".join(copy).upper() if rnd.random() < 0.3 else " ".join(copy))
    rows += [" ".join([*passage, *(rnd.choice(vocabulary) for _ in range(rnd.randint(3, 60)))]) for _ in range(15)]
    rows += [None, "", " \n ", "one two", "ONE\ttwo", "one two", "É x", "é x", "w1 " * 4000]
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(rows)], "doc_id long, text string, token int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_groups(docs).collect()}
    sets = [shingle_set(t) for t in rows]
    want = components_of(range(len(rows)), lambda a, b: sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    assert got == {k: (len(sets[k]), want[k]) for k in range(len(rows))}


def test_shingle_hashes_tell_sets_apart():
    texts = ["a b c d e", "a b c d e f", "ab c d e f", "a bc d e f", "a b c d", "a b c", "A b c", "a\x0bb c"]
    keys = [tuple(jaccard_join.shingle_hashes(t)) for t in texts]
    assert len(set(keys[:6])) == 6 and keys[5] == keys[6] == keys[7]


def test_near_vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(12, 64))
    rows = [(k, (base[k % 12] + rng.normal(scale=0.12, size=64)).astype(np.float32).tolist(), k % 12 % 3) for k in range(120)]
    rows += [(200, rows[0][1], 0), (201, rows[0][1], None), (202, [0.0] * 64, 0), (203, None, 0), (204, [float("nan")] * 64, 0), (205, [None] * 64, 0), (206, rows[0][1][:10], 0), (207, [2 * x for x in rows[0][1]], 0), (208, rows[0][1], 1)]
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    sound = {k: (np.array(v) / np.linalg.norm(v), label) for k, v, label in rows if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}

    def linked(a, b):
        return a in sound and b in sound and sound[a][1] == sound[b][1] and len(sound[a][0]) == len(sound[b][0]) and sound[a][0] @ sound[b][0] >= 0.98

    ids = [k for k, _, _ in rows]
    want = components_of(ids, linked)
    links = {a: sum(linked(a, b) for b in ids if b != a) for a in ids}
    found = sum(r.n_links for r in got.values())
    assert len(got) == len(ids) and 0.9 * sum(links.values()) <= found <= sum(links.values())
    assert all(got[k].n_links <= links[k] and got[k].kept == (got[k].component_id == k) for k in ids)
    assert sum(got[k].component_id != want[k] for k in ids) <= 0.05 * len(ids)


def counted(text, width):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return w, [tuple(w[i : i + width]) for i in range(len(w) - width + 1)]


def test_decontamination(spark):
    rnd = random.Random(2)
    vocabulary = [f"w{k}" for k in range(300)]
    items = [" ".join(rnd.choice(vocabulary) for _ in range(n)) for n in (3, 20, 60, 60, 90)]
    rows = []
    for k in range(40):
        words = [rnd.choice(vocabulary) for _ in range(80)]
        if k % 2:
            inside = items[k % len(items)].split()
            if k % 3 == 0 and len(inside) > 50:
                inside[rnd.randrange(len(inside))] = "changed"
            words[30:30] = [w.upper() + "," for w in inside]
        rows.append(" ".join(words))
    rows += [None, "", items[1], items[1][:20]]
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(rows)], "doc_id long, text string, item string")
    bench = spark.createDataFrame(list(enumerate(items)) + [(90, None), (91, "")], "item_id long, text string")
    want = set()
    for d, text in enumerate(rows):
        for i, item in enumerate(items):
            words, grams = counted(item, min(5, len(item.split())))
            own, _ = counted(text, 1)
            for start in range(len(own)):
                window = own[start : start + len(words)]
                theirs = [tuple(window[k : k + len(grams[0])]) for k in range(len(window) - len(grams[0]) + 1)]
                shared = sum(min(theirs.count(g), grams.count(g)) for g in set(grams))
                if theirs and shared / (len(theirs) + len(grams) - shared) >= 0.8:
                    want.add((d, i))
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, bench).collect()}
    assert got == want
    left = {r.doc_id for r in decontamination.decontaminate(docs, bench).collect()}
    assert left == set(range(len(rows))) - {d for d, _ in want}
    assert decontamination.contaminated(docs, bench.limit(0)).count() == 0


def test_decontamination_between_diagonals(spark):
    rows, items = [], []
    for n in (58, 60, 62, 64, 66):
        item = [f"i{n}w{k}" for k in range(n)]
        inside = ["first", *item[1 : n // 2], "two", "more", *item[n // 2 : -1], "last"]
        items.append((n, " ".join(item)))
        rows.append((n, " ".join([*(f"a{k}" for k in range(30)), *inside, *(f"b{k}" for k in range(30))])))
        rows.append((n + 100, " ".join([f"c{k}" for k in range(30)] + item[: n - 8])))  # the document ends within the item
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for d, text in rows:
        own, _ = counted(text, 1)
        for i, item in items:
            _, grams = counted(item, 5)
            for start in range(len(own)):
                theirs = counted(" ".join(own[start : start + i]), 5)[1]
                shared = sum(min(theirs.count(g), grams.count(g)) for g in set(grams))
                if theirs and shared / (len(theirs) + len(grams) - shared) >= max(0.8, want.get((d, i), (0, 0))[1] + 1e-12):
                    want[d, i] = (start, shared / (len(theirs) + len(grams) - shared))
    got = {(r.doc_id, r.item_id): (r.start_word, r.similarity) for r in decontamination.contaminated(docs, bench).collect()}
    assert len(want) == 10 and got == want


def test_surrogates(spark):
    rows = [
        (1, "Mail ann.b7@mail.example.com or call +1 (743) 555-3824, again 743-555-3824."),
        (2, "ANN.B7@mail.example.com from 10.20.30.40, card 4785 3805 9239 1141 and 4785380592391141"),
        (3, "Mrs. Anna Berg met Mr. Berg; Г-жа Иванова too"),
        (4, "nothing here 12 a@b"),
        (5, None),
        (6, ""),
        (2, "ANN.B7@mail.example.com from 10.20.30.40, card 4785 3805 9239 1141 and 4785380592391141"),
        (7, "x" * 30000 + " 123-45-6789"),
    ]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, new string")
    out = surrogates.pseudonymize(docs, "secret").collect()
    got = {r.doc_id: r.text for r in out}
    assert len(out) == len(rows)
    assert got[4] == rows[3][1] and got[5] is None and got[6] == ""
    for old in ("ann.b7@", "743) 555-3824", "743-555-3824", "10.20.30.40", "4785 3805", "4785380592391141", "Anna Berg", "Иванова", "123-45-6789"):
        assert not any(old.lower() in (t or "").lower() for t in got.values()), old
    phone = re.findall(r"\((\d{3})\) (\d{3})-(\d{4}).*?(\d{3})-(\d{3})-(\d{4})\.$", got[1])[0]
    assert phone[:3] == phone[3:] and got[1].startswith("Mail ") and "+1 (" in got[1]
    mails = [re.search(r"[a-z.0-9]+@[a-z.]+\.com", got[k].lower())[0] for k in (1, 2)]
    assert mails[0] == mails[1]
    cards = re.search(r"card (\d{4} \d{4} \d{4} \d{4}) and (\d{16})$", got[2])
    assert cards[1].replace(" ", "") == cards[2]
    assert re.fullmatch(r"Mrs\. [A-Z]\w+ [A-Z]\w+ met Mr\. [A-Z]\w+; Г-жа [А-Я][а-я]+ too", got[3])
    assert {r.text for r in surrogates.pseudonymize(docs, "other").collect()} != {r.text for r in out}


def test_surrogates_stay_distinct(spark):
    rows = [(k, f"call 100-555-{k:04d} now") for k in range(300)]
    out = surrogates.pseudonymize(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()
    assert len({r.text for r in out}) == 300


def test_title_after_an_underscore(spark):
    rows = [(1, "said _Mr. Smith_ to __Frau Weber__"), (2, "xMr. Jones stays")]
    got = {r.doc_id: (r.text, r.n_entities) for r in surrogates.pseudonymize(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    assert got[1][1] == 2 and "Smith" not in got[1][0] and "Weber" not in got[1][0] and got[2] == (rows[1][1], 0)


def test_decontamination_of_repetitive_texts(spark):
    """A text that repeats a word, or an item, has few different windows, however long it is."""
    import time

    item = [f"i{k}" for k in range(400)]
    rows = [(1, "same " * 20_000), (2, " ".join(item * 40)), (3, "some words " + " ".join(item[7:]) + " same same"), (3, "another text of this id"), (4, "same " * 330)]
    bench = spark.createDataFrame([(0, "same " * 400), (1, " ".join(item))], "item_id long, text string")
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, shingle string, k1 int")
    begun = time.monotonic()
    got = sorted((r.doc_id, r.item_id, r.start_word) for r in decontamination.contaminated(docs, bench).collect())
    assert got == [(1, 0, 0), (2, 1, 0), (3, 1, 2), (4, 0, 0)]
    assert time.monotonic() - begun < 120


def test_simhash_of_few_and_many(spark):
    rnd = random.Random(8)
    rows = [[rnd.getrandbits(64) - 2**63 for _ in range(n)] for n in (1, 2, 7, 300)] + [[5, 5, -1], [], [3] * 40_000 + [-4] * 39_999]
    got = [r.s for r in spark.createDataFrame([(k, h) for k, h in enumerate(rows)], "k int, h array<long>").orderBy("k").select(decontamination.simhash(F.col("h")).alias("s")).collect()]
    want = [sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) for hashes in rows]
    assert [g % 2**64 for g in got] == want
