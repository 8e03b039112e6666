"""Token counts by greedy longest match, in time linear in the text.

A trie of the vocabulary has failure links; each link knows how many tokens it pops, so
lengths come from one pass over the characters and no piece is ever built. The vocabulary is
that of a tokenizer file (a parameter); its end-of-word mark is one more character. Words are
runs without white space, lower-cased, as UTF-8 bytes in the file's byte alphabet. A word
with a character the vocabulary lacks counts as one unknown token.

Null and empty texts count 0. Ties cannot occur. Repeated rows are counted each; extra
columns are not read.
"""

from __future__ import annotations

import json
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

OUT = "doc_id long, n_words long, n_tokens long"
MARK = "</w>"
CACHE = 500_000
_loaded: dict = {}


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself, else the next from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Automaton:
    def __init__(self, tokens):
        """tokens: iterables of hashable characters."""
        self.children: list[dict] = [{}]
        final = [False]
        for token in tokens:
            at = 0
            for c in token:
                if c not in self.children[at]:
                    self.children[at][c] = len(self.children)
                    self.children.append({})
                    final.append(False)
                at = self.children[at][c]
            final[at] = True
        self.link = [-1] * len(final)
        self.pops = [0] * len(final)
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for c, node in self.children[parent].items():
                queue.append(node)
                if final[node]:
                    self.link[node], self.pops[node] = 0, 1
                    continue
                to, popped = self.link[parent], self.pops[parent]
                while to >= 0 and c not in self.children[to]:
                    popped += self.pops[to]
                    to = self.link[to]
                if to >= 0:
                    self.link[node], self.pops[node] = self.children[to][c], popped

    def count(self, word) -> int:
        """Tokens of the word; 1 (unknown) if greedy matching cannot cover it."""
        at = popped = 0
        for c in word:
            while c not in self.children[at]:
                if self.link[at] < 0:
                    return 1
                popped += self.pops[at]
                at = self.link[at]
            at = self.children[at][c]
        while at:
            if self.link[at] < 0:
                return 1
            popped += self.pops[at]
            at = self.link[at]
        return popped


class Counter:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        self.alphabet = byte_alphabet()
        self.automaton = Automaton(
            [*t[: -len(MARK)], MARK] if t.endswith(MARK) else list(t) for t in vocabulary
        )
        self.known: dict[str, int] = {}

    def word(self, word: str) -> int:
        found = self.known.get(word)
        if found is None:
            if len(self.known) > CACHE:
                self.known.clear()
            letters = [self.alphabet[b] for b in word.encode("utf-8", "replace")]
            found = self.known[word] = self.automaton.count([*letters, MARK])
        return found

    def text(self, text: str) -> tuple[int, int]:
        words = text.lower().split()
        return len(words), sum(map(self.word, words))


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_words, n_tokens of every row."""
    def count(batches):
        if path not in _loaded:
            _loaded[path] = Counter(path)
        counter = _loaded[path]
        for batch in batches:
            pairs = np.array([counter.text(x.as_py() or "") for x in batch["text"]], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["doc_id", "n_words", "n_tokens"]
            )

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(count, OUT)
