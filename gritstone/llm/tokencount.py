"""Token counts by a linear longest-match automaton.

Words are cut into the longest vocabulary pieces from the left (greedy word pieces), and only their number is wanted. The vocabulary's
trie has a failure link at each node, to the node that holds what is left once the longest pieces are taken off its front, and how many
pieces that takes off, so a word's count comes from one pass over its characters without building a piece (LinMaxMatch). A word that can't
be cut is one unknown token.

Words are runs of letters and digits, and each other character that isn't white space is a word. Pieces at a word's start and within it
come from the sentencepiece vocabulary, with and without its mark of a word's start; the file's path is a parameter.

Null and empty texts have 0 tokens. Repeated rows get equal results. An empty table gives an empty result. Columns other than doc_id
and text are ignored.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gritstone.session import ship

_WORD = regex.compile(r"[\p{L}\p{N}\p{M}]+|[^\s\p{L}\p{N}\p{M}]")
_NO = -1


class Automaton:
    """``starts``: pieces at a word's start; ``insides``: pieces within a word."""

    def __init__(self, starts: Iterable[str], insides: Iterable[str]):
        self.next: list[dict[str, int]] = [{}, {}]  # node 0: a word's start, node 1: within a word
        piece = [False, False]
        for root, pieces in ((0, starts), (1, insides)):
            for p in pieces:
                node = root
                for c in p:
                    to = self.next[node].get(c)
                    if to is None:
                        to = self.next[node][c] = len(self.next)
                        self.next.append({})
                        piece.append(False)
                    node = to
                if p:
                    piece[node] = True
        self.fail = [_NO] * len(self.next)
        self.popped = [0] * len(self.next)
        todo = deque([0, 1])
        while todo:
            u = todo.popleft()
            for c, v in self.next[u].items():
                if piece[v]:
                    self.fail[v], self.popped[v] = 1, 1
                else:
                    z, n = self.fail[u], self.popped[u]
                    while z != _NO and c not in self.next[z]:
                        n += self.popped[z]
                        z = self.fail[z]
                    if z != _NO:
                        self.fail[v], self.popped[v] = self.next[z][c], n
                todo.append(v)

    def count(self, word: str) -> int:
        """Pieces of the word, or 0 if it can't be cut."""
        next_, fail, popped = self.next, self.fail, self.popped
        node = n = 0
        for c in word:
            while (to := next_[node].get(c)) is None:
                n += popped[node]
                node = fail[node]
                if node == _NO:
                    return 0
            node = to
        while node != 1:  # what is left goes once no character follows
            n += popped[node]
            node = fail[node]
            if node == _NO:
                return 0
        return n


def sentencepiece_vocabulary(path: str) -> tuple[list[str], list[str]]:
    """Pieces at a word's start and within a word."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return [p[1:] for p in pieces if p[:1] == "▁" and len(p) > 1], [p for p in pieces if "▁" not in p]


class _Counts(dict):
    """Tokens, unknown words and words of each stretch without white space, as one number."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, chunk: str) -> complex:
        n = unknown = words = 0
        for w in _WORD.findall(chunk):
            k = self.automaton.count(w)
            words += 1
            n += k or 1
            unknown += not k
        out = self[chunk] = n | unknown << 32 | words << 64
        return out


_KNOWN: dict[str, _Counts] = {}
#: Stretches that a Python worker remembers.
_MOST = 1_000_000


def token_counts(df: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_words, n_tokens and n_unknown (words that can't be cut, a token each) of each whole text."""
    ship(df.sparkSession)
    rows = df.select("doc_id", "text")
    names = ["doc_id", "n_words", "n_tokens", "n_unknown"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path := vocabulary) is None:
            import public_tokenizers

            path = public_tokenizers.path("piece_bpe_32k.model")
        if path not in _KNOWN:
            _KNOWN[path] = _Counts(Automaton(*sentencepiece_vocabulary(path)))
        known, low = _KNOWN[path], (1 << 32) - 1
        for batch in batches:
            sums = []
            for text in batch.column(1):
                if len(known) > _MOST:
                    known.clear()
                sums.append(sum(map(known.__getitem__, (text.as_py() or "").split())))
            parts = (np.array([s >> k & low for s in sums], np.int64) for k in (64, 0, 32))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, parts)], names=names)

    return rows.mapInArrow(count, rows.select("doc_id", *(F.lit(0).cast("long").alias(n) for n in names[1:])).schema)
