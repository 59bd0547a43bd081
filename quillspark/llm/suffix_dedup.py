"""Substring dedup on bytes by a deep-shallow sorted suffix array.

A byte goes when some ``LENGTH``-byte string over it also starts in a document
with a smaller id.  Whole corpora cannot have every suffix sorted at
``LENGTH`` bytes each, so two sketches (see ``chunks``) first leave only
suffixes that can have a twin:

1. every string of ``LENGTH`` bytes holds ``LENGTH - GRAM + 1`` grams; the one
   whose first eight bytes have the smallest hash is its anchor, and twins share
   their anchor.  Only anchors are hashed whole, to the key they are sent by.
   Anchors that two documents do not share are dropped, with their strings;
2. of the remaining strings, those whose own hash counts one are dropped.

The rest - runs of string starts under one anchor, merged per chunk - is sent
by anchor to the blocks.  A block lays its runs end to end, sorts the suffixes
at their string starts, and reads the smallest document off each group of equal
``LENGTH``-byte prefixes.  The sort is deep-shallow: multikey quicksort, eight
bytes a symbol, to ``SHALLOW`` bytes; groups that still agree there (long common
prefixes) are ordered by blind tries, which branch on one byte each and compare
each suffix with one leaf only.

Scale: see ``chunks``; texts are exchanged once.  Trimmed to repeated strings,
the runs of one passage are the same in all its documents, so a passage in a
third of all documents sends one run per anchor and chunk.  Hashes only drop
what cannot match; equality is decided on the bytes.

Exact copies of a text are settled by SHA-256, equal runs by a hash confirmed on
the bytes in their chunk and by a dictionary in their block, before the sort; the
quicksort's levels are sorted eight bytes a symbol by ``lexsort``.

Defined results: a null text is empty; a very long text makes its chunk larger;
an empty table gives no rows; texts shorter than ``LENGTH`` lose nothing; rows with equal ids never remove from each other; a null id counts as
larger than all others; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common as C
from .chunks import QUESTION, Chunk, Corpus, Sketch, questions, repeated_counters

LENGTH = 50
GRAM = 24
SHALLOW = 24
#: Bits by which the blocks that sort suffixes are finer than those of the sketches.
FINER = 4
#: About one anchor for so many bytes of text.
BYTES_PER_KEY = 14


#: Places hashed at once; their arrays stay in the cache.
STRETCH = 1 << 16
_SPREAD = C.U64(0x9E3779B97F4A7C15)
_HIGH = C.U64(0xFFFFFFFF00000000)


def _hash_at(eight: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each place on, eight bytes a step (the last
    two steps overlap); ``eight``: see ``common._eights``."""
    out = np.empty(len(at), C.U64)
    for a in range(0, len(at), STRETCH):
        p, h = at[a:a + STRETCH], C.U64(size)
        for k in [*range(0, size - 8, 8), max(size - 8, 0)]:
            x = eight[p + k]
            if size < 8:
                x &= C._LOW_BYTES[size]
            h = (x ^ h) * _SPREAD
            h ^= h >> C.U64(32)
        out[a:a + STRETCH] = C.mix(h)
    return out


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours (len(v) - width + 1 of them)."""
    span = 1
    while span * 2 <= width:
        v = np.minimum(v[:-span], v[span:])
        span *= 2
    return np.minimum(v[:len(v) - (width - span)], v[width - span:]) if width > span else v


class _Strings:
    """The strings of a chunk's own texts as runs of starts under one anchor:
    first start, number, anchor hash and row of each run."""

    def __init__(self, text: pa.LargeStringArray, length: int, gram: int):
        self.data, self.off = C.raw_bytes(text)
        self.length = length
        self.eight = C._eights(self.data)
        begin, anchor = self._anchors(length - gram + 1, min(gram, 8))
        row = np.searchsorted(self.off, begin, side="right") - 1
        # starts whose string ends in its text; runs that a stretch cut are one again
        end = np.minimum(np.append(begin[1:], max(len(self.data) - length + 1, 0)), self.off[row + 1] - length + 1)
        whole = end > begin
        begin, end, anchor, row = begin[whole], end[whole], anchor[whole], row[whole]
        b = C.bounds(anchor)
        self.start, self.row = begin[b], row[b]
        self.n = end[np.append(b[1:], len(end)) - 1] - self.start if len(b) else np.zeros(0, np.int64)
        self.key = _hash_at(self.eight, anchor[b], gram)

    def _anchors(self, span: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the anchor changes or a text begins, and the anchor from there:
        of the ``span`` places from a start on, the leftmost whose first ``size``
        bytes have the smallest hash."""
        n = len(self.data) - self.length + 1
        begins, anchors = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        place = np.arange(STRETCH + span, dtype=C.U64)
        for lo in range(0, n, STRETCH):
            hi = min(lo + STRETCH, n)
            v = self.eight[lo:hi + span - 1] * _SPREAD
            if size < 8:
                v = (self.eight[lo:hi + span - 1] & C._LOW_BYTES[size]) * _SPREAD
            v &= _HIGH  # 32 bits of hash, then the place: the leftmost smallest
            v |= place[:len(v)]
            at = _sliding_min(v, span).astype(np.uint32)
            new = np.empty(hi - lo, bool)
            new[0] = True
            np.not_equal(at[1:], at[:-1], out=new[1:])
            texts = self.off[np.searchsorted(self.off, lo):np.searchsorted(self.off, hi)]
            new[texts - lo] = True
            b = np.flatnonzero(new)
            begins.append(b + lo)
            anchors.append(at[b].astype(np.int64) + lo)
        return np.concatenate(begins), np.concatenate(anchors)

    def only(self, keep: np.ndarray) -> None:
        self.start, self.n, self.key, self.row = (x[keep] for x in (self.start, self.n, self.key, self.row))

    def starts(self) -> tuple[np.ndarray, np.ndarray]:
        """Every string's start and run."""
        run = np.repeat(np.arange(len(self.n)), self.n)
        return np.repeat(self.start - (np.cumsum(self.n) - self.n), self.n) + np.arange(len(run)), run


class _Runs:
    """Stages of a chunk: anchors, strings under repeated anchors, runs of
    repeated strings under one anchor, distinct runs."""

    def __init__(self, chunk: Chunk, bits: int, length: int, gram: int, stage: int):
        text, self.ids = chunk.own()
        self.s = s = _Strings(text, length, gram)
        self.sketch = Sketch(s.key, bits, self.ids[s.row])
        if stage == 1:
            return
        s.only(self.sketch.marked(chunk.bits(1, self.sketch.sizes)))
        start, run = s.starts()
        h = _hash_at(s.eight, start, length)
        self.sketch = Sketch(h, bits, self.ids[s.row[run]])
        if stage == 2:
            return
        again = self.sketch.marked(chunk.bits(2, self.sketch.sizes))
        start, run, h = start[again], run[again], h[again]
        b = np.flatnonzero(np.concatenate((np.ones(min(len(start), 1), bool),
                                           (run[1:] != run[:-1]) | (start[1:] != start[:-1] + 1))))
        self.begin, self.n = start[b], np.diff(np.append(b, len(start)))
        self.row = s.row[run[b]]
        # distinct runs, by block; rows are by id, so the first of equal runs is of the smallest document
        lead = self._first_equal(C.mix(h[b] ^ C.mix(h[b + self.n - 1])))
        of = np.flatnonzero(lead == np.arange(len(lead)))
        # whole strings take more room than sketch addresses: finer blocks
        block = (s.key[run[b[of]]] >> C.U64(64 - bits - FINER)).astype(np.int64)
        order = np.argsort(block, kind="stable")
        of, self.block = of[order], block[order]
        self.first, self.strings, self.least = self.begin[of], self.n[of], self.ids[self.row[of]]
        place = np.empty(len(lead), np.int64)
        place[of] = np.arange(len(of))
        self.run = place[lead]

    def _first_equal(self, finger: np.ndarray) -> np.ndarray:
        """The first run with the bytes of each run; runs that share a hash and
        not the bytes stay by themselves."""
        order = np.argsort(finger, kind="stable")
        b = C.bounds(finger[order])
        lead = np.empty(len(order), np.int64)
        lead[order] = np.repeat(order[b], np.diff(np.append(b, len(order))))
        later = np.flatnonzero(lead != np.arange(len(lead)))
        p, q, n = self.begin[later], self.begin[lead[later]], self.n[later]
        same, size = n == self.n[lead[later]], n + self.s.length - 1
        for k in range(0, int(size.max(initial=0)), 8):
            at = np.maximum(np.minimum(k, size - 8), 0)
            differ = self.s.eight[p + at] ^ self.s.eight[q + at]
            same &= (differ & C._LOW_BYTES[np.minimum(size, 8)]) == 0
        lead[later[~same]] = later[~same]
        return lead

    @property
    def sizes(self) -> dict[int, int]:
        """Strings sent to each block."""
        b = C.bounds(self.block)
        return dict(zip(self.block[b].tolist(), np.add.reduceat(self.strings, b).tolist())) if len(b) else {}

    def blobs(self) -> list[tuple[int, bytes]]:
        """(block, number of runs, document and length of each, their bytes)."""
        size = self.strings + self.s.length - 1
        end = np.cumsum(size)
        docs, sizes = self.least.astype("<i8").tobytes(), size.astype("<u4").tobytes()
        content = self.s.data[np.repeat(self.first - (end - size), size) + np.arange(end[-1] if len(end) else 0)].tobytes()
        out, b, at = [], C.bounds(self.block), 0
        for a, z in zip(b.tolist(), np.append(b[1:], len(self.block)).tolist()):
            to = int(end[z - 1])
            out.append((int(self.block[a]), b"".join([(z - a).to_bytes(4, "little"), docs[8 * a:8 * z], sizes[4 * a:4 * z], content[at:to]])))
            at = to
        return out


def _blind_trie_groups(tails: list[bytes]) -> list[list[int]]:
    """Indexes of equal strings together, groups in the order of the strings.

    The trie branches on the byte at one depth per node.  A string walks down by
    its bytes without looking at what is skipped, is compared with the leaf it
    reaches, and, when it differs, opens a branch where it first does.
    """
    first = (tails[0], [0])
    root: tuple = first  # a leaf: (string, members); a node: (depth, children)
    for i in range(1, len(tails)):
        s = tails[i]
        node = root
        while node[0].__class__ is int:
            kids = node[1]
            node = kids.get(s[node[0]]) or next(iter(kids.values()))
        leaf = node[0]
        if leaf == s:
            node[1].append(i)
            continue
        depth = 0
        while leaf[depth] == s[depth]:
            depth += 1
        parent, at = None, root
        while at[0].__class__ is int and at[0] < depth:
            parent, at = at, at[1][s[at[0]]]
        if at[0].__class__ is int and at[0] == depth:
            at[1][s[depth]] = (s, [i])
            continue
        node = (depth, {leaf[depth]: at, s[depth]: (s, [i])})
        if parent is None:
            root = node
        else:
            parent[1][s[parent[0]]] = node
    out: list[list[int]] = []
    stack = [root]
    while stack:
        node = stack.pop()
        if node[0].__class__ is int:
            stack.extend(node[1][c] for c in sorted(node[1], reverse=True))
        else:
            out.append(node[1])
    return out


def sort_suffixes(text: np.ndarray, starts: np.ndarray, length: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``text`` at ``starts`` in the order of their first ``length``
    bytes, and the beginnings of the groups that agree on all of them."""
    shallow -= shallow % 8
    words = np.lib.stride_tricks.sliding_window_view(np.append(text, np.zeros(8, np.uint8)), 8)
    order = np.arange(len(starts))
    group = np.zeros(len(starts), np.int64)  # first position of each suffix's group
    open_ = order.copy()  # positions in groups of two or more
    for depth in range(0, shallow, 8):  # multikey quicksort: one symbol a level, tied groups go on
        if not len(open_):
            break
        symbol = np.ascontiguousarray(words[starts[order[open_]] + depth]).view(">u8").ravel().astype(C.U64)
        by = np.lexsort((symbol, group[open_])) if depth else np.argsort(symbol)
        order[open_], symbol = order[open_][by], symbol[by]
        at = group[open_]
        b = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (symbol[1:] != symbol[:-1]))))
        sizes = np.diff(np.append(b, len(open_)))
        group[open_] = np.repeat(open_[b], sizes)
        open_ = open_[np.repeat(sizes > 1, sizes)]
    edge = np.zeros(len(starts), bool)
    edge[group] = True
    b = C.bounds(group[open_])
    raw = text.tobytes()
    for a, z in zip(open_[b].tolist(), open_[np.append(b[1:], len(open_)) - 1].tolist() if len(b) else []):
        own = order[a:z + 1].tolist()
        at = starts[order[a:z + 1]].tolist()
        groups = _blind_trie_groups([raw[p + shallow:p + length] for p in at])
        if len(groups) > 1:
            order[a:z + 1] = [own[i] for g in groups for i in g]
            edge[a + np.cumsum([len(g) for g in groups[:-1]])] = True
    return order, np.flatnonzero(edge)


def _smallest(length: int):
    def answer(messages: list) -> list[bytes]:
        """Of each string sent to a block: does it start in a smaller document?"""
        docs, sizes, texts, runs = [], [], [], []
        for raw in messages:
            n = int(np.frombuffer(raw, "<u4", 1)[0])
            docs.append(np.frombuffer(raw, "<i8", n, 4))
            sizes.append(np.frombuffer(raw, "<u4", n, 4 + 8 * n).astype(np.int64))
            texts.append(np.frombuffer(raw, np.uint8, -1, 4 + 12 * n))
            runs.append(n)
        doc, size, text = np.concatenate(docs), np.concatenate(sizes), np.concatenate(texts)
        begin = np.cumsum(size) - size
        # equal runs are laid out once
        raw = text.tobytes()
        seen: dict[bytes, int] = {}
        same = np.array([seen.setdefault(raw[p:p + n], len(seen)) for p, n in zip(begin.tolist(), size.tolist())], np.int64)
        first = np.zeros(len(seen), np.int64)
        first[same[::-1]] = np.arange(len(same))[::-1]
        least_of_run = np.full(len(seen), np.iinfo(np.int64).max)
        np.minimum.at(least_of_run, same, doc)
        n_str = size[first] - length + 1
        to = np.cumsum(n_str) - n_str
        owner = np.repeat(np.arange(len(first)), n_str)
        starts = begin[first][owner] + np.arange(len(owner)) - to[owner]
        order, edges = sort_suffixes(text, starts, length)
        d = least_of_run[owner[order]]
        least = np.empty(len(order), np.int64)
        if len(order):
            least[order] = np.repeat(np.minimum.reduceat(d, edges), np.diff(np.append(edges, len(order))))
        # back to every run as sent
        n_all = size - length + 1
        back = np.cumsum(n_all) - n_all
        sent = np.repeat(np.arange(len(size)), n_all)
        smaller = least[to[same[sent]] + np.arange(len(sent)) - back[sent]] < doc[sent]
        ends = np.cumsum(n_all)[np.cumsum(runs) - 1]
        return [np.packbits(x, bitorder="little").tobytes() for x in np.split(smaller, ends[:-1])]

    return answer


def _judged(corpus: Corpus, length: int, gram: int, finish, schema: str) -> DataFrame:
    bits = corpus.block_bits

    def anchors(chunk: Chunk) -> pa.Table:
        return questions(chunk.number, _Runs(chunk, bits, length, gram, 1).sketch.blobs())

    def strings(chunk: Chunk) -> pa.Table:
        return questions(chunk.number, _Runs(chunk, bits, length, gram, 2).sketch.blobs())

    def suffixes(chunk: Chunk) -> pa.Table:
        return questions(chunk.number, _Runs(chunk, bits, length, gram, 3).blobs())

    def judge(chunk: Chunk) -> pa.Table:
        r = _Runs(chunk, bits, length, gram, 3)
        bits_ = chunk.bits(3, r.sizes)
        where = np.cumsum(r.strings) - r.strings  # where each distinct run's bits begin
        of = np.repeat(np.arange(len(r.run)), r.n)
        k = np.arange(len(of)) - np.repeat(np.cumsum(r.n) - r.n, r.n)
        if len(of):
            gone = bits_[(where[r.run])[of] + k] | (r.ids[r.row] > r.least[r.run])[of]
        else:
            gone = np.zeros(0, bool)
        lost = C.covered(len(r.s.data), (r.begin[of] + k)[gone], length)
        own = np.cumsum(~chunk.copy) - 1
        data, off = C.raw_bytes(chunk.text)
        out = []
        for i in range(len(chunk.text)):
            raw = data[off[i]:off[i + 1]]
            if chunk.copy[i]:
                mask = np.full(len(raw), len(raw) >= length)
            else:
                mask = lost[r.s.off[own[i]]:r.s.off[own[i] + 1]]
            out.append(finish(raw, mask))
        names = [p.split()[0] for p in schema.split(", ")]
        return pa.table([chunk.doc_id, *map(pa.array, zip(*out))] if out else [chunk.doc_id] * len(names), names=names)

    corpus.answer(corpus.ask(anchors, QUESTION), 1, repeated_counters)
    corpus.answer(corpus.ask(strings, QUESTION), 2, repeated_counters)
    corpus.answer(corpus.ask(suffixes, QUESTION), 3, _smallest(length))
    return corpus.ask(judge, schema)


def report(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, **kw) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: n_bytes, n_removed, n_spans
    (maximal removed runs), kept_sha256 (of the kept bytes)."""

    def finish(raw, mask):
        spans = int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum())
        return len(raw), int(mask.sum()), spans, hashlib.sha256(raw[~mask].tobytes()).hexdigest()

    return _judged(Corpus(docs, BYTES_PER_KEY, **kw), length, gram, finish,
                   "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, **kw) -> DataFrame:
    """(doc_id, text) with the removed bytes cut out; a character that lost some
    of its bytes goes as a whole."""

    def finish(raw, mask):
        return raw[~mask].tobytes().decode("utf-8", "ignore"),

    return _judged(Corpus(docs, BYTES_PER_KEY, **kw), length, gram, finish, "doc_id long, text string")
