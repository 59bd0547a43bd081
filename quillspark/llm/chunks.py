"""Chunks of documents that ask questions about keys of the whole corpus.

Documents are dealt by id into chunks of about ``CHUNK_BYTES`` of text.  A chunk
sends packed lists of keys (window or anchor hashes) to the blocks of the key
space; each block compares what all chunks sent and mails one bit per key back.
Every step is a grouped DataFrame operation on evenly dealt keys: texts are
exchanged once (the steps share that exchange), a key's occurrences inside a
chunk are merged before they leave it, and no task holds more than one chunk or
one block, however often a key or a text repeats.

Exact copies of a text are found first by hash and marked, so that only the
copy with the smallest id sends keys.

The sketch of a chunk is a count-min row of ``2**(block bits + LOW)`` counters
that saturate at two, stored as the sorted addresses of its non-zero counters.
Blocks add the rows up.  Its width follows the amount of data, so the rate of
overestimates stays the same at every size; an overestimate costs a look, never
a result.

Ids: a null id counts as larger than every other.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

CHUNK_BYTES = 4 << 20
#: Keys sent to one block, about.
BLOCK_KEYS = 2_000_000
#: Address bits inside a block.
LOW = 27
NULL_ID = (1 << 63) - 1
MAIL = "chunk int, kind int, slot int, id long, h long, data binary"


class Corpus:
    """``docs(doc_id, text)`` in chunks, and the mail for them so far."""

    def __init__(self, docs: DataFrame, bytes_per_key: float, chunk_bytes: int = CHUNK_BYTES,
                 block_keys: int = BLOCK_KEYS):
        keyed = docs.select("doc_id", F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"),
                            F.coalesce("text", F.lit("")).alias("text"))
        meta = C.saved(keyed.select("id", F.sha2("text", 256).alias("sha"), F.xxhash64("text").alias("h"),
                                    F.octet_length("text").cast("long").alias("n")), "chunk-meta")
        total = meta.agg(F.sum("n")).first()[0] or 0
        self.n_chunks = max(1, math.ceil(total / chunk_bytes))
        self.block_bits = max(0, math.ceil(math.log2(max(1, total / bytes_per_key / block_keys))))
        chunk = F.pmod(F.xxhash64("id"), F.lit(self.n_chunks)).cast("int").alias("chunk")
        self.texts = keyed.select(chunk, "doc_id", "id", F.xxhash64("text").alias("h"), "text")
        many = meta.groupBy("sha").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1")
        self.mail = meta.where("n > 0").join(many, "sha").where("id > first").select(
            chunk, F.lit(0).alias("kind"), F.lit(0).alias("slot"), "id", "h", F.lit(None).cast("binary").alias("data"))

    def ask(self, fn: Callable[[Chunk], pa.Table], schema: str) -> DataFrame:
        """``fn`` on every chunk, with the mail so far."""

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            return fn(Chunk(left, right))

        return (self.texts.groupBy("chunk").cogroup(self.mail.groupBy("chunk"))
                .applyInArrow(run, schema))

    def answer(self, questions: DataFrame, kind: int, fn: Callable[[list[bytes]], list[bytes]]) -> None:
        """``fn`` on all that was sent to a block; what it returns, message by
        message, goes back as mail of that kind.  questions: (block, chunk, data)."""

        def run(table: pa.Table) -> pa.Table:
            back = fn([x.as_buffer() for c in table.column("data").chunks for x in c])
            n = table.num_rows
            return pa.table({"chunk": table.column("chunk"), "kind": pa.array(np.full(n, kind, np.int32)),
                             "slot": table.column("block"), "id": pa.nulls(n, pa.int64()), "h": pa.nulls(n, pa.int64()),
                             "data": pa.array(back, pa.binary())})

        self.mail = self.mail.union(questions.groupBy("block").applyInArrow(run, MAIL))


QUESTION = "block int, chunk int, data binary"


class Chunk:
    """Rows of a chunk by (id, text hash), which of them repeat an earlier
    document's text, and the mail by kind and slot."""

    def __init__(self, left: pa.Table, right: pa.Table):
        left = left.take(pc.sort_indices(left, sort_keys=[("id", "ascending"), ("h", "ascending")]))
        self.number = left.column("chunk")[0].as_py() if left.num_rows else 0
        self.doc_id = left.column("doc_id").combine_chunks()
        self.ids = left.column("id").to_numpy()
        h = left.column("h").to_numpy()
        copies, self.mail = set(), {}
        for kind, slot, i, x, data in zip(*(right.column(c) for c in ("kind", "slot", "id", "h", "data"))):
            if kind.as_py() == 0:
                copies.add((i.as_py(), x.as_py()))
            else:
                self.mail.setdefault(kind.as_py(), {})[slot.as_py()] = data.as_buffer()
        self.copy = np.array([k in copies for k in zip(self.ids.tolist(), h.tolist())], bool)
        self.text = C.texts_of(left.column("text"))

    def own(self) -> tuple[pa.LargeStringArray, np.ndarray]:
        """Texts that are not copies, and their ids."""
        keep = np.flatnonzero(~self.copy)
        return self.text.take(pa.array(keep)), self.ids[keep]

    def bits(self, kind: int, sizes: dict[int, int]) -> np.ndarray:
        """Mailed bits of a kind, block after block; sizes: keys sent to each."""
        mail = self.mail.get(kind, {})
        parts = [np.unpackbits(np.frombuffer(mail[b], np.uint8), count=n, bitorder="little") for b, n in sorted(sizes.items())]
        return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


def questions(chunk: int, blobs: list[tuple[int, bytes]]) -> pa.Table:
    return pa.table({"block": pa.array([b for b, _ in blobs], pa.int32()),
                     "chunk": pa.array([chunk] * len(blobs), pa.int32()),
                     "data": pa.array([x for _, x in blobs], pa.binary())})


class Sketch:
    """Non-zero counters of a chunk: sorted addresses, and which are two or more."""

    def __init__(self, keys: np.ndarray, block_bits: int, owner: np.ndarray | None = None):
        """``owner``: only counts of different owners add up (non-decreasing)."""
        self.shift = C.U64(64 - block_bits - LOW)
        address = keys >> self.shift
        if owner is None:
            address = np.sort(address)
            b = C.bounds(address)
            self.twice = np.diff(np.append(b, len(address))) > 1
        else:
            places = max(len(keys) - 1, 1).bit_length()
            if block_bits + LOW + places <= 64:  # address and place in one number
                packed = address << C.U64(places)
                packed |= np.arange(len(keys), dtype=C.U64)
                packed.sort()
                address = packed >> C.U64(places)
                packed &= C.U64((1 << places) - 1)
                self.order = packed.view(np.int64)
            else:
                self.order = np.argsort(address, kind="stable")
                address = address[self.order]
            b = C.bounds(address)
            self.n = np.diff(np.append(b, len(address)))
            self.twice = owner[self.order[b]] != owner[self.order[b + self.n - 1]]
        self.at = address[b]
        self.block = (self.at >> C.U64(LOW)).astype(np.int64)

    @property
    def sizes(self) -> dict[int, int]:
        blocks, n = np.unique(self.block, return_counts=True)
        return dict(zip(blocks.tolist(), n.tolist()))

    def blobs(self) -> list[tuple[int, bytes]]:
        """(block, packed counters): number, counters per 2**16 addresses, low
        16 bits of each address, a bit for each that is two or more."""
        out, begin = [], 0
        for block, n in sorted(self.sizes.items()):
            low = (self.at[begin:begin + n] & C.U64((1 << LOW) - 1)).astype(np.uint32)
            high = np.bincount(low >> 16, minlength=1 << (LOW - 16)).astype("<u4")
            out.append((block, b"".join([np.uint32(n).tobytes(), high.tobytes(), low.astype("<u2").tobytes(),
                                         np.packbits(self.twice[begin:begin + n], bitorder="little").tobytes()])))
            begin += n
        return out

    def marked(self, repeated: np.ndarray) -> np.ndarray:
        """Which of the keys given with owners have a marked counter; repeated: a
        bit for each counter."""
        out = np.empty(len(self.order), bool)
        out[self.order] = np.repeat(repeated, self.n)
        return out

    def among(self, repeated: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Which keys' counters are marked; repeated: a bit for each counter."""
        marked = self.at[repeated]
        if not len(marked):
            return np.zeros(len(keys), bool)
        address = keys >> self.shift
        return marked[np.minimum(np.searchsorted(marked, address), len(marked) - 1)] == address


def repeated_counters(messages: list) -> list[bytes]:
    """Add the chunks' counters of one block up; a bit for each counter sent:
    two or more in all."""
    lows, twice = [], []
    for raw in messages:
        n = int(np.frombuffer(raw, "<u4", 1)[0])
        high = np.frombuffer(raw, "<u4", 1 << (LOW - 16), 4)
        at = 4 + high.nbytes
        low = np.frombuffer(raw, "<u2", n, at).astype(np.uint32)
        lows.append(low | (np.repeat(np.arange(len(high), dtype=np.uint32), high) << np.uint32(16)))
        twice.append(np.unpackbits(np.frombuffer(raw, np.uint8, -1, at + 2 * n), count=n, bitorder="little").astype(bool))
    every = np.sort(np.concatenate([*lows, *(x[t] for x, t in zip(lows, twice))]))
    many = every[1:][every[1:] == every[:-1]]
    many = many[C.bounds(many)]
    out = []
    for low in lows:
        hit = many[np.minimum(np.searchsorted(many, low), len(many) - 1)] == low if len(many) else np.zeros(len(low), bool)
        out.append(np.packbits(hit, bitorder="little").tobytes())
    return out
