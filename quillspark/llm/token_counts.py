"""Token counts by a linear longest-match automaton.

A word (a space, then a run of other characters) is cut greedily: at each
place the longest vocabulary piece that fits.  The automaton is the
vocabulary's byte trie; a node that cannot go on follows its failure link - the
node reached once the greedy pieces of what it spells are popped - and adds
their number, computed beforehand.  So every byte is read once and no piece is
ever built.  Every single byte counts as a piece, so each word has a count.

Scale: one scan without a shuffle; the vocabulary (a file of fixed size) is
read by each worker once.  A worker remembers counts of words seen before, up
to a fixed number.

Defined results: null and empty texts have no words and no tokens; repeated
rows are counted one by one; very long texts and words take time in proportion;
an empty table gives no rows; columns other than id and text are not read.
"""

from __future__ import annotations

import base64
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common as C

CACHE = 500_000


class Automaton:
    """``pieces``: byte strings; single bytes are added."""

    def __init__(self, pieces):
        goto: dict[int, int] = {}  # node * 256 + byte -> node
        whole = [False]
        for piece in [*(bytes([i]) for i in range(256)), *pieces]:
            node = 0
            for c in piece:
                key = node << 8 | c
                nxt = goto.get(key)
                if nxt is None:
                    nxt = goto[key] = len(whole)
                    whole.append(False)
                node = nxt
            whole[node] = True
        kids: list[list[tuple[int, int]]] = [[] for _ in whole]
        for key, node in goto.items():
            kids[key >> 8].append((key & 255, node))
        fail, pops = [0] * len(whole), [0] * len(whole)
        queue = deque([0])
        while queue:  # by depth: a link always leads to a shallower node
            at = queue.popleft()
            for c, node in kids[at]:
                queue.append(node)
                if whole[node]:
                    pops[node] = 1  # the node's string is one piece, nothing is left
                    continue
                n, z = pops[at], fail[at]
                while (z << 8 | c) not in goto:
                    n += pops[z]
                    z = fail[z]
                pops[node], fail[node] = n, goto[z << 8 | c]
        self.goto, self.fail, self.pops = goto, fail, pops

    def count(self, word: bytes) -> int:
        """Number of greedy longest-match pieces of ``word``."""
        goto, fail, pops = self.goto, self.fail, self.pops
        node = n = 0
        for c in word:
            nxt = goto.get(node << 8 | c)
            while nxt is None:
                n += pops[node]
                node = fail[node]
                nxt = goto.get(node << 8 | c)
            node = nxt
        while node:
            n += pops[node]
            node = fail[node]
        return n


class Counts(dict):
    """Counts of words, filled on demand; a word is preceded by a space."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(b" " + word)
        if len(self) >= CACHE:
            self.clear()
        self[word] = n
        return n


def read_ranks(path: str) -> list[bytes]:
    """Pieces of a ranks file (base64 piece and rank on each line)."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


_KEPT: dict[str, Counts] = {}


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_words, n_tokens) of every row of ``docs(doc_id, text)``."""

    def rows(batches):
        if path not in _KEPT:
            _KEPT[path] = Counts(Automaton(read_ranks(path)))
        get = _KEPT[path].__getitem__
        for b, col in C.batches_of(batches, "text"):
            data, off = C.raw_bytes(col)
            raw, off = data.tobytes(), off.tolist()
            words = [raw[s:e].split() for s, e in zip(off[:-1], off[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.array([len(w) for w in words], np.int64)),
                 pa.array(np.array([sum(map(get, w)) for w in words], np.int64))], ["doc_id", "n_words", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, n_words long, n_tokens long")
