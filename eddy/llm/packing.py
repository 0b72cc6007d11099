"""Operator 10: token ids packed into rows of one length.

Texts are tokenised with a public byte-level vocabulary (its file's path is a
parameter; the driver reads it once and sends its bytes to the tasks).  A
document longer than a row is split into parts without loss: full rows, and a
rest.  The rests of a block of documents are packed best-fit-decreasing: the
longest first, each into the fullest row that still has room; the row is
found in a segment tree over free capacities.

Each task packs its own documents, in blocks of at most ``block`` tokens, so
nothing is shuffled and memory is bounded; the price is one row per block
that may stay partly empty.  How documents share rows depends on how the
input is split; every document's ids and order don't.

A packed row has ``row_len`` ids (little-endian, 2 bytes each for vocabularies
below 65,536, else 4; the tail is filled with ``pad``), cumulative segment
lengths from 0, positions that start again from 0 in each segment, and for
each segment the document, its part number and number of parts.

Defined cases: null and empty texts have no tokens and no segment; a null id
stays null; repeated rows are packed each; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import each_text, for_texts

#: The vocabulary used by the query.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
ROW = 2048
BLOCK = 4_000_000

# Fixed value: the split pattern that goes with the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def encoding(data: bytes):
    """The tokeniser of a vocabulary file's bytes."""
    import tiktoken

    ranks = {base64.b64decode(k): int(v) for k, v in (line.split() for line in data.splitlines() if line)}
    return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Capacities:
    """A segment tree over free capacities 0 .. most; a node counts the open
    bins below it."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, free: int, b: int) -> None:
        self.bins[free].append(b)
        self._add(free, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The open bin with the least free capacity of at least ``need``,
        removed; (bin, free)."""
        count, i = self.count, self.leaves + need
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if count[2 * i] else 2 * i + 1
        free = i - self.leaves
        self._add(free, -1)
        return self.bins[free].pop(), free

    def _add(self, free: int, by: int) -> None:
        i = self.leaves + free
        while i:
            self.count[i] += by
            i >>= 1


def best_fit_decreasing(lengths: list[int], row_len: int) -> list[list[int]]:
    """Bins of item numbers; every length is 1 .. ``row_len``."""
    free, bins = Capacities(row_len), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = free.take(lengths[i])
        if found is None:
            found = len(bins), row_len
            bins.append([])
        b, room = found
        bins[b].append(i)
        if room > lengths[i]:
            free.put(room - lengths[i], b)
    return bins


def _rows(segments: list[tuple], row_len: int, kind: str, pad: int):
    """Packed rows of (doc_id, part, parts, ids) segments."""
    steps = np.arange(row_len, dtype=kind)
    for items in best_fit_decreasing([len(s[3]) for s in segments], row_len):
        ids, pos = np.full(row_len, pad, kind), np.zeros(row_len, kind)
        ends = [0]
        for i in items:
            at, end = ends[-1], ends[-1] + len(segments[i][3])
            ids[at:end], pos[at:end] = segments[i][3], steps[:end - at]
            ends.append(end)
        yield ids.tobytes(), pos.tobytes(), ends, [segments[i][:3] for i in items]


SEGMENT = pa.struct([("doc_id", pa.int64()), ("part", pa.int32()), ("parts", pa.int32())])


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, row_len: int = ROW, block: int = BLOCK,
         pad: int = 0) -> DataFrame:
    """``(task, row, n_tokens, n_segments, input_ids, position_ids,
    cu_seqlens, segments)``; (task, row) is unique."""
    spark = for_texts(docs.sparkSession)
    with open(vocabulary, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())

    def run(batches):
        enc = encoding(shared.value)
        kind = "<u2" if enc.n_vocab < 1 << 16 else "<u4"
        task, n = TaskContext.get().partitionId(), 0

        def flush(segments):
            nonlocal n
            got = list(_rows(segments, row_len, kind, pad))
            for i in range(0, len(got), 4096):
                part = got[i:i + 4096]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([task] * len(part), pa.int32()), pa.array(range(n, n + len(part)), pa.int64()),
                     pa.array([r[2][-1] for r in part], pa.int32()), pa.array([len(r[3]) for r in part], pa.int32()),
                     pa.array([r[0] for r in part], pa.binary()), pa.array([r[1] for r in part], pa.binary()),
                     pa.array([r[2] for r in part], pa.list_(pa.int32())),
                     pa.array([[dict(zip(("doc_id", "part", "parts"), s)) for s in r[3]] for r in part],
                              pa.list_(SEGMENT))],
                    names=["task", "row", "n_tokens", "n_segments", "input_ids", "position_ids", "cu_seqlens",
                           "segments"])
                n += len(part)

        held, tokens = [], 0
        for b in batches:
            ids_of = b.column(0).to_pylist()
            for doc_id, text in zip(ids_of, each_text(b.column(1))):
                ids = np.array(enc.encode_ordinary(text or ""), kind)
                parts = -(-len(ids) // row_len)
                for p in range(parts):
                    held.append((doc_id, p, parts, ids[p * row_len:(p + 1) * row_len]))
                tokens += len(ids)
                if tokens >= block:
                    yield from flush(held)
                    held, tokens = [], 0
        yield from flush(held)

    return docs.select("doc_id", "text").mapInArrow(
        run, "task int, row bigint, n_tokens int, n_segments int, input_ids binary, position_ids binary, "
             "cu_seqlens array<int>, segments array<struct<doc_id: bigint, part: int, parts: int>>")


def matrix(rows: list[bytes], row_len: int = ROW, kind: str = "<u2") -> np.ndarray:
    """The id matrix of some packed rows."""
    return np.frombuffer(b"".join(rows), kind).reshape(-1, row_len)
