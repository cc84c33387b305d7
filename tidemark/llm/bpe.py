"""Encoding by a public byte-level BPE vocabulary: speculate, verify, and merge exactly only what fails.

A word's greedy longest matches are proposed as its tokens. They are the word's encoding if every adjacent pair is
compatible, that is if encoding the two tokens' joined bytes gives those two tokens. Compatibility is checked for all
adjacent pairs of a batch at once: merges are undone step by step along the seam of each pair, latest merge first, and a
pair fails as soon as a merge across the seam would have come earlier than the merge just undone. Words with an
incompatible pair go through exact merging.

The files of the vocabulary are a parameter; ids are its ranks. Defined cases: null and empty texts give an empty list;
strings of special tokens in a text are ordinary text; texts of any length are encoded whole.
"""

from __future__ import annotations

import ast
import base64
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

TOKENIZERS = "/opt/tokenizers"
NONE = np.iinfo(np.int64).max
#: Words whose ids a task remembers; beyond it the memory starts anew.
REMEMBERED = 500_000
#: Signs of text that are cut into words at once.
AT_ONCE = 1_000_000


class Vocabulary:
    """Tokens, and for each the merge that makes it: `left`, `right` (itself if it is a byte)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.words = regex.compile(pattern)
        self.longest = max(map(len, ranks))
        size = max(ranks.values()) + 1
        self.left, self.right = np.arange(size), np.arange(size)
        pairs = {}
        for token, rank in ranks.items():
            if len(token) > 1:
                parts = self.merge(token, rank)
                if len(parts) == 2:
                    self.left[rank], self.right[rank] = parts
                    pairs[parts[0] * size + parts[1]] = rank
        keys = np.array(sorted(pairs), np.int64)
        self.size, self.pair_keys = size, keys
        self.pair_ranks = np.array([pairs[k] for k in keys.tolist()], np.int64)
        self.known: dict[str, tuple] = {}

    def merge(self, word: bytes, below: int | None = None) -> list[int]:
        """Exact merging: always the leftmost pair of least rank (under `below`)."""
        ranks = self.ranks
        parts = [word[i : i + 1] for i in range(len(word))]
        limit = NONE if below is None else below
        while len(parts) > 1:
            scores = [ranks.get(a + b, NONE) for a, b in zip(parts, parts[1:])]
            best = min(scores)
            if best >= limit:
                break
            out, i = [], 0
            while i < len(parts):
                if i < len(scores) and scores[i] == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return [ranks[p] for p in parts]

    def merge_long(self, word: bytes) -> list[int]:
        """The same by a heap over a linked list, for words of thousands of bytes."""
        import heapq

        n, ranks = len(word), self.ranks
        parts = [word[i : i + 1] for i in range(n)]
        prev, nxt = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(ranks[parts[i] + parts[i + 1]], i, parts[i], parts[i + 1]) for i in range(n - 1) if parts[i] + parts[i + 1] in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = nxt[i] if parts[i] is not None else n
            if j >= n or parts[i] != a or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, None
            nxt[i] = nxt[j]
            if nxt[j] < n:
                prev[nxt[j]] = i
            for x in (prev[i], i):
                if x >= 0 and nxt[x] < n and parts[x] + parts[nxt[x]] in ranks:
                    heapq.heappush(heap, (ranks[parts[x] + parts[nxt[x]]], x, parts[x], parts[nxt[x]]))
        return [ranks[p] for p in parts if p is not None]

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest matches."""
        got, at, n, ranks = [], 0, len(word), self.ranks
        while at < n:
            end = min(n, at + self.longest)
            while word[at:end] not in ranks:
                end -= 1
            got.append(ranks[word[at:end]])
            at = end
        return got

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of a and b, NONE if there is none."""
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NONE)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each pair of tokens stays as it is when its joined bytes are encoded."""
        a, b = a.astype(np.int64), b.astype(np.int64)
        fine = np.ones(len(a), bool)
        todo = np.arange(len(a))
        # a merge across the seam wins over the merge last undone if its rank is lower, or, on the right side, equal
        undone = np.full(len(a), NONE)
        while todo.size:
            x, y = a[todo], b[todo]
            across = self.rank_of(x, y)
            bad = across < undone[todo]
            fine[todo[bad]] = False
            todo, x, y = todo[~bad], x[~bad], y[~bad]
            x_whole, y_whole = self.right[x] == x, self.left[y] == y
            todo, x, y, x_whole, y_whole = (v[~(x_whole & y_whole)] for v in (todo, x, y, x_whole, y_whole))
            on_left = (~x_whole & (x > y)) | y_whole
            undone[todo] = np.where(on_left, x, y + 1)
            a[todo] = np.where(on_left, self.right[x], x)
            b[todo] = np.where(on_left, y, self.left[y])
        return fine

    def encode_words(self, words: list[str]) -> list[tuple]:
        """The ids of each word."""
        raw = [w.encode() for w in words]
        long = {i for i, w in enumerate(raw) if len(w) > 2000}
        tried = [[] if i in long else self.propose(w) for i, w in enumerate(raw)]
        sizes = np.fromiter(map(len, tried), np.int64, len(tried))
        flat = np.fromiter(chain.from_iterable(tried), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(tried)), sizes)
        seams = np.flatnonzero(owner[1:] == owner[:-1]) if len(owner) > 1 else np.zeros(0, np.int64)
        pairs, back = np.unique(flat[seams] * self.size + flat[seams + 1], return_inverse=True)
        fine = self.compatible(pairs // self.size, pairs % self.size)[back]
        failed = set(owner[seams[~fine]].tolist())
        return [tuple(self.merge_long(w) if i in long else self.merge(w) if i in failed else t) for i, (w, t) in enumerate(zip(raw, tried))]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and offsets of the texts; so many at a time that their words take bounded memory."""
        parts, sizes, group, letters = [], [], [], 0
        for i, t in enumerate(texts):
            group.append(t)
            letters += len(t or "")
            if letters > AT_ONCE or i == len(texts) - 1:
                for ids in self._encode(group):
                    parts.append(ids)
                    sizes.append(len(ids))
                group, letters = [], 0
        offsets = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(sizes, out=offsets[1:])
        return np.concatenate(parts) if parts else np.zeros(0, np.int32), offsets

    def _encode(self, texts: list[str | None]) -> list[np.ndarray]:
        find = self.words.findall
        split = [find(t) if t else [] for t in texts]
        new = list({w for ws in split for w in ws} - self.known.keys())
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {}, list({w for ws in split for w in ws})
        self.known.update(zip(new, self.encode_words(new)))
        known = self.known
        return [np.fromiter(chain.from_iterable(map(known.__getitem__, ws)), np.int32) for ws in split]


_LOADED: dict[tuple, Vocabulary] = {}


def load(name: str, folder: str = TOKENIZERS) -> Vocabulary:
    """The vocabulary of a `.tiktoken` file; the pattern of its words is in the folder's module. Kept by process."""
    key = (name, folder)
    if key not in _LOADED:
        lines = Path(folder, f"{name}.tiktoken").read_bytes().splitlines()
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line)}
        tree = ast.parse(Path(folder, "__init__.py").read_text())
        pattern = next(ast.literal_eval(n.value) for n in tree.body if isinstance(n, ast.Assign) and n.targets[0].id == "PATTERN")
        _LOADED[key] = Vocabulary(ranks, pattern)
    return _LOADED[key]


def token_ids(text: Column, name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> Column:
    """array<int> of a string column."""

    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = load(name, folder)
        for batch in batches:
            ids, offsets = vocabulary.encode(batch.tolist())
            yield pd.Series(np.split(ids, offsets[1:-1]) if len(batch) else [], dtype=object)

    return run(text)


def token_count(text: Column, name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> Column:
    """The number of tokens of a string column."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = load(name, folder)
        for batch in batches:
            yield pd.Series(np.diff(vocabulary.encode(batch.tolist())[1]))

    return run(text)
