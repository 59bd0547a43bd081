"""Substring dedup on word windows with a count-min prefilter.

A window is ``WINDOW`` consecutive words of one document.  First pass: every
chunk of documents counts its windows in a sketch; the merged sketches
overestimate each window's count, so a window estimated once occurs once.
Second pass: only the windows estimated repeated are grouped exactly, by 128
bits of hash, for the smallest document id each starts in.  A window is removed
when it also starts in a smaller document, or earlier in its own; the words it
covers go.

Scale: see ``chunks``.  Three looks at the texts, one exchange of them; what is
grouped exactly has been merged per chunk first, so a window in a third of all
documents costs one entry per chunk.

Defined results: null and empty texts have no words; a very long text makes its
chunk larger; an empty table gives no rows; texts shorter than a window lose
nothing; repeated rows with the same id count as one document, the
later row starting later; a null id counts as larger than all others; other
columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common as C
from .chunks import QUESTION, Chunk, Corpus, Sketch, questions, repeated_counters

WINDOW = 20
#: About one window for so many bytes of text.
BYTES_PER_KEY = 6


def _windows(col: pa.LargeStringArray, size: int):
    """(hash, second hash, row, start) of every window of the texts."""
    parts = [[], [], [], []]
    for i, j in C.slices(col):
        w = C.Words(col.slice(i, j - i), C.SPACE_WORD, False)
        at, doc = w.windows(size)
        for part, x in zip(parts, (C.window_hash(w.hashes(0), at, size, 0), C.window_hash(w.hashes(1), at, size, 1),
                                   doc + i, at - w.first[:-1][doc])):
            part.append(x)
    kinds = (C.U64, C.U64, np.int64, np.int64)
    return [np.concatenate(p) if p else np.zeros(0, k) for p, k in zip(parts, kinds)]


class _Candidates:
    """Windows of a chunk that the sketch estimates repeated, grouped exactly."""

    def __init__(self, chunk: Chunk, size: int, block_bits: int):
        text, self.ids = chunk.own()
        h1, h2, row, start = _windows(text, size)
        sketch = Sketch(h1, block_bits)
        maybe = np.flatnonzero(sketch.among(chunk.bits(1, sketch.sizes), h1))
        order = np.lexsort((maybe, h2[maybe], h1[maybe]))  # rows are by id, windows by start
        at = maybe[order]
        self.h1, self.h2, self.row, self.start = h1[at], h2[at], row[at], start[at]
        self.b = C.bounds(np.column_stack([self.h1, self.h2]))
        self.block = (self.h1[self.b] >> C.U64(64 - block_bits)).astype(np.int64) if block_bits else np.zeros(len(self.b), np.int64)
        self.first = self.ids[self.row[self.b]]
        self.n_rows = len(text)

    @property
    def sizes(self):
        blocks, n = np.unique(self.block, return_counts=True)
        return dict(zip(blocks.tolist(), n.tolist()))

    def blobs(self):
        out, begin = [], 0
        for block, n in sorted(self.sizes.items()):
            b = self.b[begin:begin + n]
            out.append((block, b"".join([self.h1[b].tobytes(), self.h2[b].tobytes(),
                                         self.first[begin:begin + n].astype(np.int64).tobytes()])))
            begin += n
        return out

    def removed(self, smaller: np.ndarray):
        """(row, start) of the windows to remove; smaller: a bit for each
        distinct window, that some other chunk has it in a smaller document."""
        gone = np.ones(len(self.h1), bool)
        gone[self.b] = smaller  # all but the first of a group repeat it
        return self.row[gone], self.start[gone]


def _smallest(messages: list) -> list[bytes]:
    """For each distinct window sent to a block: is a smaller document elsewhere?"""
    n = [len(m) // 24 for m in messages]
    h1 = np.concatenate([np.frombuffer(m, C.U64, k) for m, k in zip(messages, n)])
    h2 = np.concatenate([np.frombuffer(m, C.U64, k, 8 * k) for m, k in zip(messages, n)])
    doc = np.concatenate([np.frombuffer(m, np.int64, k, 16 * k) for m, k in zip(messages, n)])
    order = np.lexsort((doc, h2, h1))
    b = C.bounds(np.column_stack([h1[order], h2[order]]))
    least = np.empty(len(doc), np.int64)
    least[order] = np.repeat(doc[order][b], np.diff(np.append(b, len(order))))
    return [np.packbits(x, bitorder="little").tobytes() for x in np.split(least < doc, np.cumsum(n)[:-1])]


def _kept_words(text: str, gone: np.ndarray) -> list[bytes]:
    return [w for w, g in zip(text.encode().split(), gone) if not g]


def _judged(corpus: Corpus, size: int, finish, schema: str) -> DataFrame:
    bits = corpus.block_bits

    def count(chunk: Chunk) -> pa.Table:
        return questions(chunk.number, Sketch(_windows(chunk.own()[0], size)[0], bits).blobs())

    def group(chunk: Chunk) -> pa.Table:
        return questions(chunk.number, _Candidates(chunk, size, bits).blobs())

    def judge(chunk: Chunk) -> pa.Table:
        c = _Candidates(chunk, size, bits)
        row, start = c.removed(chunk.bits(2, c.sizes))
        order = np.argsort(row, kind="stable")
        row, start = row[order], start[order]
        own = np.cumsum(~chunk.copy) - 1  # row among the texts that are not copies
        out = []
        for i, text in enumerate(chunk.text.to_pylist()):
            n = len(text.encode().split())
            if chunk.copy[i]:
                gone = np.full(n, n >= size)
            else:
                a, b = np.searchsorted(row, (own[i], own[i] + 1))
                gone = C.covered(n, start[a:b], size)
            out.append(finish(text, n, gone))
        return pa.table([chunk.doc_id, *map(pa.array, zip(*out))] if out else [chunk.doc_id] * 4,
                        names=[p.split()[0] for p in schema.split(", ")])

    corpus.answer(corpus.ask(count, QUESTION), 1, repeated_counters)
    corpus.answer(corpus.ask(group, QUESTION), 2, _smallest)
    return corpus.ask(judge, schema)


def report(docs: DataFrame, size: int = WINDOW, **kw) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: n_words, n_removed,
    kept_sha256 (of the kept words joined by one space)."""

    def finish(text, n, gone):
        if not gone.any():
            kept = b" ".join(text.encode().split())
        else:
            kept = b" ".join(_kept_words(text, gone))
        return n, int(gone.sum()), hashlib.sha256(kept).hexdigest()

    return _judged(Corpus(docs, BYTES_PER_KEY, **kw), size, finish,
                   "doc_id long, n_words long, n_removed long, kept_sha256 string")


def dedup(docs: DataFrame, size: int = WINDOW, **kw) -> DataFrame:
    """(doc_id, text) with the removed words cut out, kept words joined by one
    space (texts that lose nothing stay as they are)."""

    def finish(text, n, gone):
        return (text if not gone.any() else b" ".join(_kept_words(text, gone)).decode()),

    return _judged(Corpus(docs, BYTES_PER_KEY, **kw), size, finish, "doc_id long, text string")
