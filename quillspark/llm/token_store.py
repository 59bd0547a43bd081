"""Token ids in binary files with Elias-Fano document boundaries.

A shard file holds the ids of consecutive documents as one array and the
documents' ends as an Elias-Fano code: of each end the low bits are packed
side by side and the high bits set one bit in a unary vector; the place of
every ``STEP``-th set bit is kept, so ``offset(i)`` - a select - scans a few
bytes.  That is about 2 + log2(ids / documents) bits a document instead of 64.

File: magic, eight little-endian 64-bit numbers (documents, ids, bytes an id,
low bits, bytes of the low part, bytes of the high part, select samples,
partition), document ids (64 bit), null flags (one byte each), low bits, high
bits, samples (32 bit), ids.

Scale: one range exchange by (doc_id, hash of the text) - the second key keeps
a repeated id from filling one task - then each task sorts and writes its
shards of ``SHARD_IDS`` ids (a long document makes a longer shard).  Files
appear under their final name only when complete, and a task run again writes
the same bytes, so executors may be lost.  The shards' offsets are a table, joined
to what is read from the files; the driver sees neither.

Defined results: null text counts as empty and has the end id only; a very long
text makes its shard longer; null ids sort first; rows with equal ids follow the
hash of their text; other columns, of whatever name, are not read; an empty table
gives no files and no rows.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from . import common as C
from .tokens import encoder, sent

MAGIC = b"QSTOKEF1"
STEP = 256
SHARD_IDS = 4_000_000
#: Text bytes for one range partition.
PART_BYTES = 24 << 20
END_ID = 2
#: Text bytes encoded at once.
ENCODE_BYTES = 2 << 20


class EliasFano:
    """Non-decreasing numbers in near-minimal space, with select."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // n).bit_length() - 1) if n else 0
        low = ((values[:, None] >> np.arange(bits)) & 1).astype(np.uint8) if bits else np.zeros((n, 0), np.uint8)
        ones = (values >> bits) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        high[ones] = 1
        return cls(n, bits, np.packbits(low.ravel(), bitorder="little"), np.packbits(high, bitorder="little"),
                   ones[::STEP].astype(np.uint32))

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        low = np.unpackbits(self.low, bitorder="little", count=self.n * self.low_bits).reshape(self.n, self.low_bits)
        return ((ones - np.arange(self.n)) << self.low_bits) + (low.astype(np.int64) << np.arange(self.low_bits)).sum(1)

    def select(self, i: np.ndarray) -> np.ndarray:
        """Values ``i``: each set bit is looked for from the nearest sample on (all
        together, a byte a step), then the low bits are added."""
        i = np.asarray(i, np.int64)
        at = self.samples[i // STEP].astype(np.int64)
        need, byte = i % STEP, at >> 3
        bits = self.high[byte] >> (at & 7).astype(np.uint8) << (at & 7).astype(np.uint8)
        open_ = np.arange(len(i))
        while len(open_):
            have = np.bitwise_count(bits[open_])
            open_ = open_[have <= need[open_]]
            need[open_] -= np.bitwise_count(bits[open_])
            byte[open_] += 1
            bits[open_] = self.high[byte[open_]]
        place = np.cumsum(np.unpackbits(bits[:, None], axis=1, bitorder="little"), axis=1, dtype=np.int64)
        one = (byte << 3) + (place <= need[:, None]).sum(axis=1)
        # the low bits lie in nine bytes at most
        start = i * self.low_bits
        padded = np.concatenate((self.low, np.zeros(9, np.uint8)))
        eight = np.ndarray((len(self.low) + 2,), "<u8", padded, 0, (1,))
        shift = (start & 7).astype(np.uint64)
        low = eight[start >> 3] >> shift
        if self.low_bits > 57:
            low |= np.where(shift > 0, padded[(start >> 3) + 8].astype(np.uint64) << (np.uint64(64) - np.maximum(shift, np.uint64(1))), np.uint64(0))
        low &= np.uint64((1 << self.low_bits) - 1)
        return ((one - i) << self.low_bits) | low.astype(np.int64)

    def __getitem__(self, i: int) -> int:
        return int(self.select(np.array([i]))[0])


class Shard:
    """One file's content: document ids, ends and token ids."""

    def __init__(self, docs: np.ndarray, null: np.ndarray, ends: EliasFano, ids: np.ndarray, part: int = 0):
        self.docs, self.null, self.ends, self.ids, self.part = docs, null, ends, ids, part

    def dumps(self) -> bytes:
        e = self.ends
        head = struct.pack("<8Q", e.n, len(self.ids), self.ids.dtype.itemsize, e.low_bits, len(e.low), len(e.high),
                           len(e.samples), self.part)
        return b"".join([MAGIC, head, self.docs.astype("<i8").tobytes(), self.null.astype(np.uint8).tobytes(),
                         e.low.tobytes(), e.high.tobytes(), e.samples.astype("<u4").tobytes(), self.ids.tobytes()])

    @classmethod
    def loads(cls, raw: bytes) -> Shard:
        if raw[:8] != MAGIC:
            raise ValueError("not a token shard")
        n, m, width, bits, n_low, n_high, n_samples, part = struct.unpack_from("<8Q", raw, 8)
        at = 8 + 64

        def take(kind, count):
            nonlocal at
            out = np.frombuffer(raw, kind, count, at)
            at += out.nbytes
            return out

        docs, null = take("<i8", n), take(np.uint8, n)
        low, high, samples = take(np.uint8, n_low), take(np.uint8, n_high), take("<u4", n_samples)
        return cls(docs, null, EliasFano(n, bits, low, high, samples), take("<u2" if width == 2 else "<u4", m), part)

    def document(self, i: int) -> np.ndarray:
        """Ids of document i of the shard."""
        return self.ids[self.ends[i - 1] if i else 0:self.ends[i]]


def _system(folder: str):
    """File system of a folder (as pyarrow has them: local, hdfs, s3, gs, abfs) and its path there."""
    from pyarrow import fs

    for spark_name in ("s3a://", "s3n://"):
        folder = folder.replace(spark_name, "s3://", 1) if folder.startswith(spark_name) else folder
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _put(folder: str, name: str, raw: bytes) -> None:
    system, path = _system(folder)
    draft = f"{path}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as f:
        f.write(raw)
    system.move(draft, f"{path}/{name}")


def write(docs: DataFrame, folder: str, path: str, end_id: int = END_ID, leading_space: bool = False,
          shard_ids: int = SHARD_IDS, literal: bool = True) -> None:
    """Write the shards of ``docs(doc_id, text)`` in ascending doc_id order.  ``literal``:
    special tokens written out in a text are ordinary text (the query: not)."""
    system, where = _system(folder)
    system.create_dir(where)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, int(size // PART_BYTES) + 1)
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    dealt = keyed.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    name, content = sent(docs.sparkSession, path)

    def shards(batches):
        enc = encoder(name, content, leading_space, literal)
        part = TaskContext.get().partitionId()
        ids, ends, docs_, null, k, held = [], [], [], [], 0, 0

        def flush():
            nonlocal ids, ends, docs_, null, k, held
            ef = EliasFano.of(np.concatenate(ends))
            raw = Shard(np.concatenate(docs_), np.concatenate(null), ef, np.concatenate(ids), part).dumps()
            _put(folder, f"part-{part:012d}-{k:012d}-{held}.tok", raw)
            out = pa.RecordBatch.from_pydict({"n_docs": [ef.n], "n_ids": [held]})
            ids, ends, docs_, null, k, held = [], [], [], [], k + 1, 0
            return out

        for b, col in C.batches_of(batches, "text", ENCODE_BYTES):
            x, off = enc.encode_documents(col, end_id)
            ids.append(x)
            ends.append(held + off[1:])
            docs_.append(b.column(0).fill_null(0).to_numpy(zero_copy_only=False))
            null.append(b.column(0).is_null().to_numpy(zero_copy_only=False))
            held += len(x)
            if held >= shard_ids:
                yield flush()
        if ids:
            yield flush()

    done = dealt.mapInArrow(shards, "n_docs long, n_ids long")
    done.agg(F.count(F.lit(1))).collect()


#: Shards under one sum of the offsets.
SHARD_GROUP = 4096


def shard_starts(names: DataFrame) -> DataFrame:
    """(part, k, base) of every shard from ``names(path)``: ids of all shards before
    it, by the numbers in the names.  Two levels of prefix sums: within groups of
    partitions, and over the groups' sums."""
    at = r"part-(\d+)-(\d+)-(\d+)\.tok$"
    shards = names.select(*[F.regexp_extract("path", at, i + 1).cast("long").alias(c) for i, c in enumerate(("part", "k", "ids"))])
    shards = shards.withColumn("g", F.floor(F.col("part") / SHARD_GROUP))
    groups = shards.groupBy("g").agg(F.sum("ids").alias("t"))
    before = Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)  # a row for 100 GB of text
    groups = groups.select("g", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("s"))
    inside = Window.partitionBy("g").orderBy("part", "k").rowsBetween(Window.unboundedPreceding, -1)
    return (shards.withColumn("o", F.coalesce(F.sum("ids").over(inside), F.lit(0))).join(groups, "g")
            .select("part", "k", (F.col("s") + F.col("o")).alias("base")))


def read(spark, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files: each
    document's start and end are selected from its shard's Elias-Fano code."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(folder)

    def rows(batches):
        for b in batches:
            for path, raw in zip(b.column(0).to_pylist(), b.column(1)):
                shard = Shard.loads(raw.as_buffer())
                part, k = path.rsplit("/", 1)[1].split("-")[1:3]
                end = shard.ends.select(np.arange(shard.ends.n))
                begin = np.concatenate(([0], end[:-1])).astype(np.int64)
                n = len(end)
                for i in range(0, n, 10_000):
                    s, e = begin[i:i + 10_000], end[i:i + 10_000]
                    crc = [zlib.crc32(shard.ids[x:y].astype("<u4")) for x, y in zip(s.tolist(), e.tolist())]
                    ids = pa.array(shard.docs[i:i + 10_000], mask=shard.null[i:i + 10_000].astype(bool))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(s), int(part))), pa.array(np.full(len(s), int(k))), ids, pa.array(s), pa.array(e - s),
                         pa.array(crc, pa.int64())], ["part", "k", "doc_id", "local", "n_tokens", "ids_crc32"])

    found = files.select("path", "content").mapInArrow(
        rows, "part long, k long, doc_id long, local long, n_tokens long, ids_crc32 long")
    return (found.join(shard_starts(files.select("path")), ["part", "k"])
            .select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"))


def round_trip(docs: DataFrame, path: str, **kw) -> DataFrame:
    """Write to the shared folder, then describe every document from the files."""
    folder = shared_dir(docs.sparkSession, "token-store")
    write(docs, folder, path, **kw)
    return read(docs.sparkSession, folder)
