"""Packing by concatenate-and-cut.

First pass: every text is tokenized once; a task writes each document's ids
with its start *within the task's partition*.  The partition totals' prefix
sums give each partition its global offset.  Second pass: a document's global
start is offset + local start, so the fixed windows of ``length`` tokens it
falls into - and the records at their boundaries, where a document is cut -
follow by arithmetic, row by row.

Scale: no shuffle of texts or ids at all.  The driver sees one total per
partition (16 bytes each), whatever the number of documents.  A task that is
run again writes its own partition again; the table of ids is written before
the offsets are read, so a lost executor cannot change them.

A task holds the longest document of its partition whole, with its ids.

Defined results: null text counts as empty and has the end id only; a very long
text is cut into as many pieces as sequences it reaches; repeated rows are packed
one by one, in the order of their partition, and so are rows with equal ids (no
order is defined between documents); other columns, of whatever name, are not
read; an empty table gives no pieces; the last sequence is short by the padding,
which is 0 at a power of two.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .tokens import binaries, encoder, sent

LENGTH = 1024
END_ID = 0
#: Text bytes encoded at once.
ENCODE_BYTES = 2 << 20
#: Ids cut at once.
CUT_IDS = 1 << 19

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, continues boolean")


def tokenized(docs: DataFrame, path: str, end_id: int = END_ID, leading_space: bool = True, literal: bool = True) -> DataFrame:
    """Written table (part, local_start, doc_id, ids) of ``docs(doc_id, text)``;
    ids: little-endian 16- or 32-bit numbers with ``end_id`` last.  ``literal``:
    special tokens written out in a text are ordinary text (the queries: not)."""

    name, content = sent(docs.sparkSession, path)

    def rows(batches):
        enc = encoder(name, content, leading_space, literal)
        part, at = TaskContext.get().partitionId(), 0
        for b, col in C.batches_of(batches, "text", ENCODE_BYTES):
            ids, off = enc.encode_documents(col, end_id)
            n = len(col)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), pa.array(at + off[:-1]), b.column(0), pa.array(np.diff(off)),
                 pa.array(np.full(n, enc.kind.itemsize, np.int32)), binaries(ids, off)],
                ["part", "local_start", "doc_id", "n", "width", "ids"])
            at += len(ids)

    table = docs.select("doc_id", "text").mapInArrow(
        rows, "part int, local_start long, doc_id long, n long, width int, ids binary")
    return C.saved(table, "token-ids")


def partition_offsets(table: DataFrame) -> dict[int, int]:
    """Global offset of each partition: prefix sums of the partition totals."""
    totals = sorted((r["part"], r["t"]) for r in table.groupBy("part").agg(F.sum("n").alias("t")).collect())
    out, at = {}, 0
    for part, t in totals:
        out[part] = at
        at += t
    return out


def _stretches(n: np.ndarray):
    """Row ranges of about ``CUT_IDS`` ids (one row at least)."""
    end, i = np.cumsum(n), 0
    while i < len(n):
        j = max(i + 1, int(np.searchsorted(end, (end[i - 1] if i else 0) + CUT_IDS, side="right")))
        yield i, j
        i = j


def _cut(b: pa.RecordBatch, offsets: dict[int, int], length: int, with_ids: bool) -> pa.RecordBatch:
    """Pieces of some tokenized documents."""
    n = b.column("n").to_numpy()
    begin = np.array([offsets[p] for p in b.column("part").to_pylist()], np.int64) + b.column("local_start").to_numpy()
    first, last = begin // length, (begin + n - 1) // length
    per = last - first + 1
    row = np.repeat(np.arange(len(n)), per)
    seq = first[row] + np.arange(len(row)) - (np.cumsum(per) - per)[row]
    at = np.maximum(seq * length, begin[row])
    end = np.minimum((seq + 1) * length, (begin + n)[row])
    kind = ["<u2" if w == 2 else "<u4" for w in b.column("width").to_pylist()]
    pool = np.concatenate([np.frombuffer(x.as_buffer(), k).astype("<u4") for x, k in zip(b.column("ids"), kind)])
    own = np.cumsum(n) - n
    size = end - at
    lo = own[row] + at - begin[row]
    crc = [zlib.crc32(pool[s:e]) for s, e in zip(lo.tolist(), (lo + size).tolist())]
    take = pa.array(row)
    arrays = [b.column("doc_id").take(take), pa.array(at - begin[row]), pa.array(size), pa.array(crc, pa.int64()),
              b.column("n").take(take), pa.array(seq), pa.array(at - seq * length), pa.array(end < (begin + n)[row])]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "continues"]
    if with_ids:  # the pieces of consecutive documents are the pool, cut
        arrays.append(pa.ListArray.from_arrays(pa.array(np.append(lo, len(pool)).astype(np.int32)), pa.array(pool.view("<i4"))))
        names.append("ids")
    return pa.RecordBatch.from_arrays(arrays, names)


def pieces(table: DataFrame, length: int = LENGTH, ids: bool = False) -> DataFrame:
    """Pieces of every document of a tokenized table; with ``ids`` also the ids
    themselves (array<int>).  ``continues``: the document goes on in the next
    sequence (the boundary records)."""
    offsets = partition_offsets(table)

    def cut(batches):
        for whole in batches:
            for i, j in _stretches(whole.column("n").to_numpy()):
                yield _cut(whole.slice(i, j - i), offsets, length, ids)

    return table.mapInArrow(cut, PIECES + (", ids array<int>" if ids else ""))


def padding(used: int, length: int = LENGTH) -> int:
    """Pad ids after a sequence with ``used`` ids: up to ``length``, none at a power of two."""
    return 0 if used & (used - 1) == 0 else length - used


def pack(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID, ids: bool = False, literal: bool = True) -> DataFrame:
    return pieces(tokenized(docs, path, end_id, literal=literal), length, ids)
