"""Token counts by greedy longest match, with an automaton that reads each byte once.

The vocabulary is a trie. Where no longer match goes on, a failure link leads to the node for what is
left after the tokens that are certain by then, and how many tokens that pops is known for each node
in advance; so a word's count is a sum along its bytes, and no piece is ever built.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .bpe import _byte_of_char
from .runtime import small_batches
from .words import BLANK_SEPARATED, EXACT, distinct_spans, pieces, text_bytes, word_hashes, word_spans

#: So few spans are quicker to read one by one than side by side.
FEW = 48


class LongestMatch:
    """Greedy longest match over a vocabulary that holds every single byte."""

    def __init__(self, vocabulary: list[bytes]):
        children: list[dict[int, int]] = [{}]
        token = [False]
        for piece in vocabulary:
            at = 0
            for c in piece:
                if c not in children[at]:
                    children[at][c] = len(children)
                    children.append({})
                    token.append(False)
                at = children[at][c]
            token[at] = at > 0
        if any(c not in children[0] or not token[children[0][c]] for c in range(256)):
            raise ValueError("the vocabulary must hold every single byte")
        fail, popped = [-1] * len(children), [0] * len(children)
        queue = [0]
        for parent in queue:
            for c, node in children[parent].items():
                queue.append(node)
                if token[node]:
                    fail[node], popped[node] = 0, 1
                    continue
                z, n = fail[parent], popped[parent]
                while c not in children[z]:
                    n += popped[z]
                    z = fail[z]
                fail[node], popped[node] = children[z][c], n
        edges = sorted((node << 8 | c, child) for node, d in enumerate(children) for c, child in d.items())
        self.keys = np.array([k for k, _ in edges], np.int64)
        self.child = np.array([v for _, v in edges], np.int32)
        self.fail, self.popped = np.array(fail, np.int32), np.array(popped, np.int64)
        self.steps = dict(edges), fail, popped

    def counts(self, body: np.ndarray, start: np.ndarray, end: np.ndarray, before: bytes = b"") -> np.ndarray:
        """Tokens of each span of the bytes, read with `before` in front.

        Spans advance side by side, a byte each in one step; the last few long ones are read one after another.
        """
        n = len(start)
        state, out = np.zeros(n, np.int64), np.zeros(n, np.int64)
        order = np.argsort(start - end, kind="stable")  # the longest first, so that those still read are a prefix
        start, size = start[order], (end - start)[order]

        def advance(c: np.ndarray) -> None:
            rows = np.arange(len(c))
            while len(rows):
                key = state[rows] << 8 | c[rows]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                good = self.keys[at] == key
                state[rows[good]] = self.child[at[good]]
                rows = rows[~good]
                out[rows] += self.popped[state[rows]]
                state[rows] = self.fail[state[rows]]

        for b in before:
            advance(np.full(n, b, np.int64))
        for k in range(int(size[0]) if n else 0):
            reading = int(np.searchsorted(-size, -k, "left"))
            if reading <= FEW:
                for i in range(reading):
                    state[i], out[i] = self._read(body[start[i] + k : start[i] + size[i]].tobytes(), int(state[i]), int(out[i]))
                break
            advance(body[start[:reading] + k].astype(np.int64))
        rows = np.flatnonzero(state)
        while len(rows):
            out[rows] += self.popped[state[rows]]
            state[rows] = self.fail[state[rows]]
            rows = rows[state[rows] > 0]
        back = np.empty(n, np.int64)
        back[order] = out
        return back

    def _read(self, rest: bytes, state: int, count: int) -> tuple[int, int]:
        """State and count after the bytes of one span."""
        child, fail, popped = self.steps
        for c in rest:
            while (goal := child.get(state << 8 | c)) is None:
                count += popped[state]
                state = fail[state]
            state = goal
        return state, count


@lru_cache(maxsize=2)
def load(path: str) -> LongestMatch:
    """The vocabulary of a byte-level tokenizer file: pieces with a space in front open words."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    byte_of = _byte_of_char()
    return LongestMatch([bytes(byte_of[c] for c in piece) for piece in vocab])


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Rows (keep..., n_words, n_tokens, most): tokens of each whole text by greedy longest match, word by word.

    Words end at ASCII white space, and each is read with a space in front. most is the number of
    tokens of the text's most divided word, 0 without words. A null or empty text has no words.
    Rows are kept as they are, repeated ones too; an empty table gives none. A kept column named like
    one of the results gives way to it. Equal words of a part of a partition are read once. No shuffle.
    """
    small_batches(docs.sparkSession)
    keep = tuple(c for c in keep if c.lower() not in ("n_words", "n_tokens", "most"))
    schema = T.StructType([*(docs.schema[c] for c in keep), *(T.StructField(n, T.LongType()) for n in ("n_words", "n_tokens", "most"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = load(path)
        for batch in batches:
            texts = batch.column(len(keep))
            for i, j in pieces(texts, 4 << 20):
                body, at = text_bytes(texts.slice(i, j - i))
                start, end, word_at = word_spans(body, at, BLANK_SEPARATED)
                first, of = distinct_spans(body, start, end, word_hashes(body, start, end, EXACT))
                each = match.counts(body, start[first], end[first], b" ")[of]
                total = np.concatenate([[0], np.cumsum(each)])
                most = np.zeros(j - i, np.int64)
                full = np.flatnonzero(np.diff(word_at))
                if len(full):
                    most[full] = np.maximum.reduceat(each, word_at[full])
                columns = [np.diff(word_at), total[word_at[1:]] - total[word_at[:-1]], most]
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(i, j - i) for k in range(len(keep))), *(pa.array(c, pa.int64()) for c in columns)], schema.names)

    return docs.select(*keep, text_col).mapInArrow(run, schema)
