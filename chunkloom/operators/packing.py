"""Greedy packing under a token budget, as folds inside one row's arrays.

Boundaries depend on what came before, so they are worked out from the token counts alone; texts are sliced
afterwards. Each document is one row, so documents are independent and nothing is sorted across them.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.folds import fold, rows_of
from ..functions.text import squeezed, token_count


def _pieces(counts: np.ndarray, most: int) -> np.ndarray:
    """Counts over ``most`` cut into pieces of ``most``, the last one shorter."""
    return np.array([min(most, c - k) for c in counts.tolist() for k in range(0, c, most)], np.int64)


def pack(counts: Column, budget: int, overlap_tokens: int = 0, overlap_items: int = 0, least: int = 0, piece: int = 0) -> Column:
    """Array of (first, last, tokens), 1-based and inclusive.

    With ``piece``, larger items are first cut into pieces of so many tokens, which are items of their own.

    An item more joins while the sum stays within the budget; the first always joins. The next chunk goes
    back over the items that cover ``overlap_tokens``, or over ``overlap_items`` items, but starts after
    the previous start. Packing ends with the chunk that holds the last item. A chunk of fewer than ``least``
    tokens is added to the one before, whose tokens may then exceed the budget.
    """

    def run(c: np.ndarray) -> list:
        c = _pieces(c, piece) if piece else c
        sums, n = np.concatenate([[0], np.cumsum(c)]), len(c)
        at, out = 0, []
        while at < n:
            end = max(at + 1, int(np.searchsorted(sums, sums[at] + budget, "right")) - 1)
            tokens = int(sums[end] - sums[at])
            if out and tokens < least:
                out[-1][1], out[-1][2] = end, out[-1][2] + tokens
            else:
                out.append([at + 1, end, tokens])
            if end >= n:
                break
            back = int(np.searchsorted(sums, sums[end] - overlap_tokens, "right")) - 1 if overlap_tokens else end - overlap_items
            at = max(at + 1, back)
        return out

    return rows_of(counts, {"first": "int", "last": "int", "tokens": "bigint"}, run)


def long_line_chunks(df: DataFrame, text_col: str, keep: list[str], budget: int, overlap: int, least_chars: int = 200, most: int = 1000) -> DataFrame:
    """``keep``, chunk_no, start_line, end_line, piece, token_count, text: lines packed under a budget, longer ones cut.

    Lines join while their tokens fit; the next chunk begins with the lines that cover ``overlap`` tokens, or after the
    chunk where that would be all of it. A line over the budget is cut into windows of its mean characters per token
    times the budget, ``least_chars`` at least and ``most`` windows at most, which step on by the rest of the overlap; they
    are chunks of this line alone, with piece from 1. Packing ends with the chunk that holds the last line. Lines count
    from 0, ends are exclusive, texts are canonical. Null texts have no chunks, an empty one has one without tokens.
    """

    def run(numbers: np.ndarray) -> list:
        counts, chars = numbers[0::2], numbers[1::2].tolist()
        sums, n, at, out = np.concatenate([[0], np.cumsum(counts)]), len(counts), 0, []
        while at < n:
            tokens = int(counts[at])
            if tokens > budget:
                each = max(1, chars[at] // tokens)
                width = max(least_chars, each * budget)
                step = max(1, width - each * overlap)
                windows = min(most, 1 + max(0, -(-(chars[at] - width) // step)))
                out += [[at, at + 1, k + 1, k * step, min(chars[at], k * step + width)] for k in range(windows)]
                at += 1
                continue
            end = max(at + 1, int(np.searchsorted(sums, sums[at] + budget, "right")) - 1)
            out.append([at, end, 0, 0, 0])
            if end == n:
                break
            back = int(np.searchsorted(sums, sums[end] - overlap, "right")) - 1 if overlap > 0 else end
            at = back if back > at else end
        return out

    lines = F.split(text_col, "\n")
    counted = F.flatten(F.transform(lines, lambda x: F.array(token_count(x), F.length(x).cast("long"))))
    fields = {"start_line": "int", "end_line": "int", "piece": "int", "a": "int", "b": "int"}
    packed = df.where(F.col(text_col).isNotNull()).select(*keep, lines.alias("_lines"), F.posexplode(rows_of(counted, fields, run)).alias("chunk_no", "_c"))
    whole = F.array_join(F.slice("_lines", F.col("_c.start_line") + 1, F.col("_c.end_line") - F.col("_c.start_line")), "\n")
    window = F.substr(F.get("_lines", F.col("_c.start_line")), F.col("_c.a") + 1, F.col("_c.b") - F.col("_c.a"))
    out = packed.select(*keep, "chunk_no", "_c.start_line", "_c.end_line", "_c.piece", squeezed(F.when(F.col("_c.piece") > 0, window).otherwise(whole)).alias("text"))
    return out.select(*keep, "chunk_no", "start_line", "end_line", "piece", token_count(F.col("text")).alias("token_count"), "text")


def _groups(joins):
    """Group numbers from 1; ``joins(sum, count)`` says whether an item joins the group before."""

    def run(c: np.ndarray) -> list:
        out, total, group = [], 0, 0
        for x in c.tolist():
            if group and joins(total, x):
                total += x
            else:
                total, group = x, group + 1
            out.append(group)
        return out

    return run


def groups_of_rows(counts: Column, header: int, budget: int) -> Column:
    """Group number of each row: rows join while header and rows stay within the budget; a row over it is alone."""
    return fold(counts, "array<int>", _groups(lambda total, c: total + c + header <= budget))


def header_tokens(header: Column, budget: int) -> Column:
    """A header that fills the budget by itself is left out of all chunks."""
    return F.when(header >= budget, F.lit(0)).otherwise(header).cast("long")


def row_chunks(counts: Column, header: Column, budget: int, share: float = 0.1) -> Column:
    """Array of (first, last, token_start, token_end, with_header, tokens) for the rows of one batch.

    Rows join while header and rows stay within the budget. A row over the budget ends the group before it
    and is cut into token windows that overlap by ``share``; each window has the header if both fit. Token
    bounds are null for groups of rows. The header counts as ``header_tokens`` says.
    """
    overlap = int(budget * share)

    def run(c: np.ndarray) -> list:
        head, out, first, total = int(c[0]), [], None, 0
        for k, x in enumerate(c[1:].tolist(), 1):
            if x > budget:
                if first is not None:
                    out.append([first, k - 1, None, None, int(head > 0), total + head])
                first, at = None, 0
                while True:
                    end = min(x, at + budget)
                    fits = head > 0 and head + end - at <= budget
                    out.append([k, k, at, end, int(fits), end - at + (head if fits else 0)])
                    if end >= x:
                        break
                    at += budget - overlap
            elif first is not None and total + x + head <= budget:
                total += x
            else:
                if first is not None:
                    out.append([first, k - 1, None, None, int(head > 0), total + head])
                first, total = k, x
        if first is not None:
            out.append([first, len(c) - 1, None, None, int(head > 0), total + head])
        return out

    fields = {"first": "int", "last": "int", "token_start": "int", "token_end": "int", "with_header": "boolean", "tokens": "bigint"}
    return rows_of(F.concat(F.array(header_tokens(header, budget)), counts.cast("array<bigint>")), fields, run)


def merged_sections(counts: Column, threshold: int, most: int) -> Column:
    """Group number of each section: a group below the threshold takes the next section unless that exceeds ``most``."""
    return fold(counts, "array<int>", _groups(lambda total, c: total < threshold and total + c <= most))


def word_lengths(text: Column) -> Column:
    """Characters of each word of a canonical text, negative for the last word of a sentence."""
    return F.transform(F.split(text, " "), lambda w: F.when(F.right(w, F.lit(1)).isin(".", "!", "?"), -F.length(w)).otherwise(F.length(w)))


def sentence_chunks(df: DataFrame, text_col: str, keep: list[str], budget: int, overlap: int, least: int) -> DataFrame:
    """``keep``, chunk_no, sentence_first, sentence_end, start_char, end_char, token_count, truncated, text.

    Words count as tokens. Sentences of a canonical text are packed as ``pack`` does; one over the budget is cut into
    pieces of the budget, which are packed and overlap like sentences, and a chunk that ends inside a sentence is
    truncated. A chunk of fewer than ``least`` tokens is appended to the one before, with the sentences that both
    hold, so that token_count is the sum and may exceed the budget. Sentences count from 0 and ends are exclusive,
    as are the characters' places in the canonical text. Null and empty texts have no chunks.
    """

    def run(lengths: np.ndarray) -> list:
        size = np.abs(lengths)
        starts = np.concatenate([[0], np.cumsum(size + 1)])
        items, first, sentence = [], 0, 0  # (first word, end word, sentence, whether the sentence goes on)
        for end in [*(np.flatnonzero(lengths[:-1] < 0) + 1).tolist(), len(lengths)]:
            items += [(k, min(k + budget, end), sentence, k + budget < end) for k in range(first, end, budget)]
            first, sentence = end, sentence + 1
        counts, out, at = [b - a for a, b, _, _ in items], [], 0
        while at < len(items):
            end, tokens = at + 1, counts[at]
            while end < len(items) and tokens + counts[end] <= budget:
                tokens += counts[end]
                end += 1
            a, b = int(starts[items[at][0]]), int(starts[items[end - 1][1]]) - 1
            cut = any(i[3] for i in items[at:end])
            if out and tokens < least:
                last = out[-1]
                last[1], last[2], last[3] = items[end - 1][2] + 1, last[2] + tokens, int(last[3] or cut)
                last += [a, b]
            else:
                out.append([items[at][2], items[end - 1][2] + 1, tokens, int(cut), a, b])
            if end == len(items):
                break
            at = max(at + 1, end - overlap)
        return out

    known = df.where(F.coalesce(F.col(text_col), F.lit("")) != "")
    chunks = known.withColumn("_chunks", fold(word_lengths(F.col(text_col)), "array<array<bigint>>", run))

    def told(c):
        """A chunk's fields; its texts are cut out inside the row, so that no copy of the whole text goes with each chunk."""
        part = lambda k: F.substr(F.col(text_col), (F.get(c, k) + 1).cast("int"), (F.get(c, k + 1) - F.get(c, k)).cast("int"))
        joined = F.array_join(F.transform(F.sequence(F.lit(4), F.size(c) - 2, F.lit(2)), part), " ")
        fields = {"sentence_first": F.get(c, F.lit(0)), "sentence_end": F.get(c, F.lit(1)), "start_char": F.get(c, F.lit(4)), "end_char": F.element_at(c, -1), "token_count": F.get(c, F.lit(2)), "truncated": F.get(c, F.lit(3)) > 0, "text": joined}
        return F.struct(*(v.alias(n) for n, v in fields.items()))

    return chunks.select(*keep, F.posexplode(F.transform("_chunks", told)).alias("chunk_no", "_c")).select(*keep, "chunk_no", "_c.*")


def rows_per_chunk(header: Column, sample: Column, target: int, least: int = 1, most: int = 100) -> Column:
    return F.least(F.lit(most), F.greatest(F.lit(least), F.floor(F.greatest(F.lit(1), target - header) / F.greatest(sample, F.lit(1))).cast("int")))
