"""Encoding columns of texts with a tokenizer file.

Both kinds of tokenizer used here cut a text before any merge is made, and
always at a space (or line end) between two other characters: such pieces can
be encoded alone.  So the pieces of a slice of texts are told apart by hash (and
compared byte by byte with the piece that stands for them), each different piece
is looked up or encoded once, and the texts' ids are gathered from the pieces'
ids.  A text with other white space arrangements, or one that holds an added
token of the file, is encoded whole.  The ids are those of the tokenizers library
in either case (tests compare whole encodings).
"""

from __future__ import annotations

import hashlib
import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import common as C

#: Pieces remembered by a worker (about 60 bytes each, in flat arrays); longer
#: pieces than ``CACHE_PIECE`` bytes are not.
CACHE = 800_000
CACHE_PIECE = 64
#: Pieces encoded as one text.
JOINED = 64

_LINE_WORD = np.ones(256, bool)
_LINE_WORD[[0x20, 0x0A]] = False
# UTF-8 bytes of white space characters.
_SPACE_1 = np.zeros(256, bool)
_SPACE_1[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20]] = True
_SPACE_C2 = np.zeros(256, bool)
_SPACE_C2[[0x85, 0xA0]] = True
_SPACE_E280 = np.zeros(256, bool)
_SPACE_E280[[*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF]] = True


def _wide_space(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Are three bytes a white space character?"""
    return ((a == 0xE2) & (((b == 0x80) & _SPACE_E280[c]) | ((b == 0x81) & (c == 0x9F)))
            | (a == 0xE1) & (b == 0x9A) & (c == 0x80) | (a == 0xE3) & (b == 0x80) & (c == 0x80))


class Encoder:
    """``leading_space``: a piece keeps the space before it (byte-level BPE);
    otherwise white space is dropped by the tokenizer (word BPE).  ``literal``: the
    characters of a special token in a text are ordinary text; otherwise they are
    that token, as the library has it.  ``file``: a path, or the file's content."""

    def __init__(self, file: str | bytes, leading_space: bool, literal: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_buffer(file) if isinstance(file, bytes) else Tokenizer.from_file(file)
        self.tok.encode_special_tokens = literal
        self.added = [t for t in self.tok.get_added_tokens_decoder().values() if not (literal and t.special)]
        # a byte that is rare in texts and in each added token; a token without one is looked for in all texts
        self.signs = [next((c for c in t.content.encode() if not (chr(c).isalnum() or c in b" \n" or c >= 0x80)), None) for t in self.added]
        self.kind = np.dtype("<u2") if self.tok.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.leading = leading_space
        #: Ids of what stands between joined pieces (byte-level: a line end).
        self.mark = np.frombuffer(self._encode(["\n" if leading_space else "\x01"])[0], self.kind)
        self._forget()

    def _encode(self, texts: list[str]) -> list[bytes]:
        code = "H" if self.kind.itemsize == 2 else "I"
        return [array(code, e.ids).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the pieces: a pool, and each piece's place and number there.

        Many pieces are encoded as one text: between two of them stands a mark
        that is one id and that nothing else gives.  Pieces that hold white space
        (but a space in front) or the mark are encoded alone."""
        between = "\n" if self.leading else " \x01 "
        mark = between if self.leading else "\x01"
        plain, alone = [], []
        for i, s in enumerate(pieces):
            t = s[1:] if self.leading and s[0] == " " else s
            (plain if mark not in s and t.split() == [t] else alone).append(i)
        if len(self.mark) != 1:
            plain, alone = [], list(range(len(pieces)))
        begin, size = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        pool, at = [], 0
        groups = [plain[a:a + JOINED] for a in range(0, len(plain), JOINED)]
        for own, raw in zip(groups, self._encode([between.join([pieces[i] for i in own]) + between for own in groups])):
            ids = np.frombuffer(raw, self.kind)
            end = np.flatnonzero(ids == self.mark[0])
            if len(end) != len(own):
                alone += own
                continue
            first = np.concatenate(([0], end[:-1] + 1))
            begin[own], size[own] = first + at, end - first
            pool.append(ids)
            at += len(ids)
        for i, raw in zip(alone, self._encode([pieces[i] for i in alone])):
            ids = np.frombuffer(raw, self.kind)
            begin[i], size[i] = at, len(ids)
            pool.append(ids)
            at += len(ids)
        return np.concatenate(pool) if pool else np.zeros(0, self.kind), begin, size

    def _forget(self) -> None:
        none = np.zeros(0, np.int64)
        #: Hashes of the remembered pieces, ascending; place and length of each one's bytes and ids.
        self.keys, self.known = np.zeros(0, C.U64), [none, none, none, none]
        self.raw, self.ids = np.zeros(0, np.uint8), np.zeros(0, self.kind)

    def _pieces(self, data: np.ndarray, at: np.ndarray, n: np.ndarray, keys: np.ndarray | None):
        """``_learn`` of different pieces, given as spans; keys: their hashes, by
        which they are remembered (None: not)."""
        begin, size = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        hit = np.zeros(len(at), bool)
        if keys is not None and len(self.keys):
            k = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            taken = self.keys[k] == keys
            raw_at, raw_n, ids_at, ids_n = (x[k] for x in self.known)
            hit = taken.copy()
            hit[taken] = C.equal_bytes(data, at[taken], n[taken], self.raw, raw_at[taken], raw_n[taken])
            begin[hit], size[hit] = ids_at[hit], ids_n[hit]
        else:
            taken = hit
        new = np.flatnonzero(~hit)
        raw = data.tobytes()
        ids, b, z = self._learn([raw[s:e].decode() for s, e in zip(at[new].tolist(), (at[new] + n[new]).tolist())])
        pool = np.concatenate((self.ids, ids))
        begin[new], size[new] = b + len(self.ids), z
        if keys is not None:
            if len(self.keys) + len(new) > CACHE:
                self._forget()
            else:
                b = b + len(self.ids)
            keep = (n[new] <= CACHE_PIECE) & ~taken[new]
            own = new[keep]
            own = own[order] if len(order := np.argsort(keys[own])) else own
            own_n = n[own]
            own_at = np.cumsum(own_n) - own_n
            bytes_ = data[np.repeat(at[own] - own_at, own_n) + np.arange(int(own_n.sum()))]
            place = np.searchsorted(self.keys, keys[own])
            of = np.searchsorted(new, own)
            self.keys = np.insert(self.keys, place, keys[own])
            self.known = [np.insert(x, place, y) for x, y in zip(self.known, (own_at + len(self.raw), own_n, b[of], z[of]))]
            self.raw, self.ids = np.concatenate((self.raw, bytes_)), np.concatenate((self.ids, ids))
        return pool, begin, size

    def _odd(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Texts that must be encoded whole."""
        n = len(off) - 1
        if not self.leading or not len(data):
            return np.zeros(n, bool)
        # a space or line end beside other white space
        p = np.flatnonzero(~_LINE_WORD[data])
        x = np.concatenate((np.zeros(3, np.uint8), data, np.zeros(3, np.uint8)))
        a3, a2, a1, b1, b2, b3 = (x[p + 3 + d] for d in (-3, -2, -1, 1, 2, 3))
        beside = (_SPACE_1[a1] | ((a2 == 0xC2) & _SPACE_C2[a1]) | _wide_space(a3, a2, a1)
                  | _SPACE_1[b1] | ((b1 == 0xC2) & _SPACE_C2[b2]) | _wide_space(b1, b2, b3))
        at = p[beside]
        odd = np.zeros(n, bool)
        odd[np.searchsorted(off, at, side="right") - 1] = True
        full = np.flatnonzero(np.diff(off) > 0)
        odd[full] |= ~_LINE_WORD[data[off[full]]] | ~_LINE_WORD[data[off[full + 1] - 1]]
        return odd

    def _with_added(self, col: pa.LargeStringArray, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Texts that hold an added token."""
        out = np.zeros(len(col), bool)
        suspects: dict = {}
        for t, sign in zip(self.added, self.signs):
            if sign not in suspects:
                suspects[sign] = (np.arange(len(col)) if sign is None else
                                  np.unique(np.searchsorted(off, np.flatnonzero(data == sign), side="right") - 1))
            some = suspects[sign]
            if len(some):
                hit = pc.match_substring(col.take(pa.array(some)), t.content, ignore_case=t.normalized)
                out[some] |= hit.to_numpy(zero_copy_only=False)
        return out

    def encode(self, col: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and their offsets."""
        data, off = C.raw_bytes(col)
        odd = self._odd(data, off)
        odd |= self._with_added(col, data, off)
        if odd.any():
            plain = np.flatnonzero(~odd)
            ids, at = self._regular(col.take(pa.array(plain)))
            parts: list = [None] * len(col)
            for k, i in enumerate(plain.tolist()):
                parts[i] = ids[at[k]:at[k + 1]]
            whole = np.flatnonzero(odd).tolist()
            for i, x in zip(whole, self._encode(col.take(pa.array(whole)).to_pylist())):
                parts[i] = np.frombuffer(x, self.kind)
            sizes = [len(x) for x in parts]
            return np.concatenate(parts), np.concatenate(([0], np.cumsum(sizes)))
        return self._regular(col)

    def _regular(self, col: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        w = C.Words(col, _LINE_WORD if self.leading else C.SPACE_WORD, False)
        if not len(w.starts):
            return np.zeros(0, self.kind), np.zeros(len(col) + 1, np.int64)
        before = np.where(w.starts > w.off[:-1][w.doc], w.data[w.starts - 1], 0) if self.leading else np.zeros(len(w.starts), np.uint8)
        starts = w.starts - (before == 0x20)  # a piece has the space before it
        lengths = w.ends - starts
        seed, h = 0, C.byte_hash(w.data, starts, w.ends)
        while True:
            item, first = C.codes_of(h)
            other = first[item]
            if C.equal_bytes(w.data, starts, lengths, w.data, starts[other], lengths[other]).all():
                break
            seed += 1  # two pieces with one hash: tell them apart by another
            h = C.mix(h + C.byte_hash(w.data, starts, w.ends, seed))
        pool, begin, sizes = self._pieces(w.data, starts[first], lengths[first], None if seed else h[first])
        line_end = before == 0x0A
        per_word = np.ones(len(item), np.int64)
        if line_end.any():
            begin, sizes = np.append(begin, len(pool)), np.append(sizes, len(self.mark))
            pool = np.concatenate((pool, self.mark))
            per_word += line_end
            at = np.cumsum(per_word) - per_word
            item = np.repeat(item, per_word)
            item[at[line_end]] = len(begin) - 1
        n = sizes[item]
        end = np.cumsum(n)
        ids = pool[np.repeat(begin[item] - (end - n), n) + np.arange(int(end[-1]))]
        items_end = np.concatenate(([0], np.cumsum(per_word)))[w.first]
        return ids, np.concatenate(([0], end))[items_end]

    def encode_documents(self, col: pa.LargeStringArray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` with ``end_id`` after each text."""
        ids, off = self.encode(col)
        return np.insert(ids, off[1:], self.kind.type(end_id)), off + np.arange(len(off))


def binaries(ids: np.ndarray, off: np.ndarray) -> pa.Array:
    """Arrow binary column of the slices of ``ids``."""
    at = (off * ids.dtype.itemsize).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(off) - 1, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(ids))]
                                 ).cast(pa.binary())


_KEPT: dict[tuple[str, bool, bool], Encoder] = {}


def sent(spark, path: str):
    """The file's content for the tasks (some MB; read by the driver, so workers
    need no such path), with the name under which workers keep its encoder."""
    with open(path, "rb") as f:
        raw = f.read()
    return hashlib.sha256(raw).hexdigest(), spark.sparkContext.broadcast(raw)


def encoder(name: str, content, leading_space: bool, literal: bool) -> Encoder:
    """The worker's encoder for a ``sent`` file (kept between tasks)."""
    key = (name, leading_space, literal)
    if key not in _KEPT:
        _KEPT[key] = Encoder(bytes(content.value), leading_space, literal)
    return _KEPT[key]
