"""Token counts by greedy longest-match word pieces, in one pass of a trie with failure links.

A node's failure link says where matching goes on when no edge fits, and its popped count how many
pieces are complete by then. Both are worked out once for the vocabulary, so counting a word takes one
step a character and builds no piece.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame

from .common import map_texts, once

CACHED_WORDS, CACHED_CHARS = 500_000, 48


class LongestMatch:
    """``initial`` pieces start a word, ``following`` ones continue it."""

    def __init__(self, initial, following):
        self.edges: list[dict[str, int]] = [{}, {}]
        complete = [False, False]
        for root, pieces in ((0, initial), (1, following)):
            for piece in pieces:
                node = root
                for c in piece:
                    nxt = self.edges[node].get(c)
                    if nxt is None:
                        nxt = self.edges[node][c] = len(self.edges)
                        self.edges.append({})
                        complete.append(False)
                    node = nxt
                complete[node] = complete[node] or bool(piece)
        self.fail: list[int] = [-1] * len(self.edges)
        self.popped = [0] * len(self.edges)
        queue = deque([0, 1])
        while queue:
            node = queue.popleft()
            for c, child in self.edges[node].items():
                if complete[child]:
                    self.fail[child], self.popped[child] = 1, 1
                else:
                    z, popped = self.fail[node], self.popped[node]
                    while z >= 0 and c not in self.edges[z]:
                        popped += self.popped[z]
                        z = self.fail[z]
                    if z >= 0:
                        self.fail[child], self.popped[child] = self.edges[z][c], popped
                queue.append(child)
        self.words = _Words(self)

    def count(self, word: str) -> int:
        """Pieces of a non-empty word; 0 if the word can't be covered."""
        edges, fail, popped = self.edges, self.fail, self.popped
        node = tokens = 0
        for c in word:
            while c not in edges[node]:
                if fail[node] < 0:
                    return 0
                tokens += popped[node]
                node = fail[node]
            node = edges[node][c]
        while node > 1:
            if fail[node] < 0:
                return 0
            tokens += popped[node]
            node = fail[node]
        return tokens if node == 1 else 0


class _Words(dict):
    def __init__(self, automaton: LongestMatch):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        n = self.automaton.count(word)
        if len(word) <= CACHED_CHARS:
            self[word] = n
        return n


def vocabulary(model_file: str) -> tuple[set[str], set[str]]:
    """Word-initial and following pieces of a SentencePiece vocabulary, the former without their space mark."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    own = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
    pieces = [sp.id_to_piece(i) for i in own]
    return {p[1:] for p in pieces if p[:1] == "▁" and p[1:].strip("▁")}, {p for p in pieces if p[:1] != "▁"}


def token_counts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: n_words (between white space), n_tokens, n_unknown.

    A word without a cover counts as one unknown token. Null and empty texts give zeros; texts of any
    length are counted whole; repeated rows each give their row; an empty table gives no rows.
    """

    def row(text):
        words = once(("longest-match", model_file), lambda: LongestMatch(*vocabulary(model_file))).words
        if len(words) > CACHED_WORDS:
            words.clear()
        counts = list(map(words.__getitem__, (text or "").split()))
        unknown = counts.count(0)
        return len(counts), sum(counts) + unknown, unknown

    return map_texts(docs, id_col, text_col, row, "n_words long, n_tokens long, n_unknown long")
