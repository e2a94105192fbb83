"""Coded ids against the tokenizers library, an exact round trip, and plain Huffman lengths."""

import heapq
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chunkloom.llm import huffman_ids
from chunkloom.llm.queries import byte_tokenizer_file

FILE = byte_tokenizer_file()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(FILE)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(max_size=30) | st.text(" \n\tab.1'é<|  \r\x1c", max_size=30) | st.just("a <|endoftext|> b"), max_size=5))
def test_ids_are_the_librarys(library, texts):
    e = huffman_ids.encoder(FILE)
    assert [np.frombuffer(x, e.kind).tolist() for x in e.encode(texts)] == [[*library.encode(t, add_special_tokens=False).ids, 0] for t in texts]


def test_long_texts_in_parts(library, monkeypatch):
    monkeypatch.setattr(huffman_ids, "PART_CHARS", 50)
    rnd, e = random.Random(1), huffman_ids.encoder(FILE)
    texts = ["".join(rnd.choice(["a", "bc ", "  ", "\n", ".", "é", "xyz"]) for _ in range(400)) for _ in range(30)] + [" " * 300, "x" * 300]
    assert [np.frombuffer(x, e.kind).tolist()[:-1] for x in e.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def plain_total(weights):
    """Total length of an unlimited Huffman code."""
    heap, total = list(weights), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        total += a + b
        heapq.heappush(heap, a + b)
    return total


def best_limited(weights, limit):
    """Least total over all sorted length lists that fit, by trying all."""
    ws = sorted(weights, reverse=True)

    def least(k, left, low):
        if k == len(ws):
            return 0 if left >= 0 else float("inf")
        return min((ws[k] * size + least(k + 1, left - 2 ** (limit - size), size) for size in range(low, limit + 1) if left >= 2 ** (limit - size)), default=float("inf"))

    return least(0, 2**limit, 1)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 10**6) | st.integers(1, 5), min_size=2, max_size=60))
def test_lengths_are_huffmans(weights):
    w = np.array(weights)
    lengths = huffman_ids.code_lengths(w, 62)
    assert (w * lengths).sum() == plain_total(weights) and sum(2.0 ** -int(k) for k in lengths) == 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([1, 1, 2, 3, 5, 8, 13, 21, 34, 900]), min_size=2, max_size=8), st.integers(3, 5))
def test_lengths_within_a_limit(weights, limit):
    lengths = huffman_ids.code_lengths(np.array(weights), limit)
    assert lengths.max() <= limit and (lengths * np.array(weights)).sum() == best_limited(weights, limit)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 3000), st.integers(1, 2000), st.integers(11, 25))
def test_codes_round_trip(seed, n, vocabulary, limit):
    rng = np.random.default_rng(seed)
    ids = np.minimum(rng.geometric(0.01, n), vocabulary).astype(np.int64)
    found = dict(zip(*(v.tolist() for v in np.unique(ids, return_counts=True))))
    code = huffman_ids.Code(huffman_ids.code_of(found, limit))
    payload, starts = code.encode(ids)
    assert len(starts) == -(-n // huffman_ids.BLOCK)
    assert (code.decode(payload, starts, n) == ids).all()
    k = len(starts) - 1  # a block by itself
    assert (code.decode(payload, starts[k:], n - k * huffman_ids.BLOCK) == ids[k * huffman_ids.BLOCK :]).all()


def want(library, rows):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def test_files(spark, library, monkeypatch):
    monkeypatch.setattr(huffman_ids, "SEGMENT", 500)
    rnd = random.Random(2)
    rows = [(k, " ".join(rnd.choice(["alpha", "beta", "Ωmega", "x" * rnd.randint(1, 9), "7"]) for _ in range(rnd.randint(0, 90)))) for k in range(200)]
    rows += [(500, None), (501, ""), (502, "word " * 3000), (-4, "First.\n\nSecond  one.")]
    rnd.shuffle(rows)
    docs = spark.createDataFrame([(i, t, 1, 2, b"x") for i, t in rows], "doc_id long, text string, start int, id int, ids binary")
    got = huffman_ids.write_and_read(docs, FILE, keep_ids=True).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32, r.ids) for r in got) == want(library, rows)


def test_repeated_ids_nulls_and_none(spark, library):
    rows = [(7, "Same text.")] * 300 + [(None, "null id"), (8, "after")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = huffman_ids.write_and_read(docs, FILE).collect()
    assert sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == [(s, i, n, c) for i, s, n, c, _ in want(library, rows)]
    assert huffman_ids.write_and_read(docs.limit(0), FILE).collect() == []
