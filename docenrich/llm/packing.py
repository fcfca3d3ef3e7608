"""Packing documents into training sequences: best-fit decreasing.

Every task packs what it reads, so nothing is shuffled. Documents longer than a
window are first cut into full windows; what remains of them, and all others,
go by descending length to the tightest open window, found in a segment tree
over the remaining capacities. Windows that stay open go back into the next
round of the task, and the last of them are cut freely: into full windows, and
into sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docenrich.cluster import ship_package
from docenrich.llm.common import clean_text, released
from docenrich.llm.tokens import encoder

WINDOW = 2048
#: A window with at most this much padding is closed.
SLACK = 16
END_ID = 1
#: Tokens that a task holds at once; the tail of the round before comes on top.
ROUND_TOKENS = 4_000_000
_TEXTS = 1024


class CapacityTree:
    """Open windows by remaining capacity, with the tightest fit in logarithmic time."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.filled = bytearray(2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, capacity: int, window: int) -> None:
        self.windows[capacity].append(window)
        node = capacity + self.leaves
        while node and not self.filled[node]:
            self.filled[node] = 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The window with the least capacity of at least ``need``, taken out."""
        node = need + self.leaves
        while not self.filled[node]:
            # up to the first node with a filled right neighbour, then down its left side
            while node > 1 and (node & 1 or not self.filled[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node <<= 1
                if not self.filled[node]:
                    node += 1
        capacity = node - self.leaves
        window = self.windows[capacity].pop()
        if not self.windows[capacity]:
            self.filled[node] = 0
            node >>= 1
            while node and not (self.filled[2 * node] or self.filled[2 * node + 1]):
                self.filled[node] = 0
                node >>= 1
        return capacity, window


def best_fit_decreasing(lengths: np.ndarray, window: int) -> list[list[int]]:
    """Windows as lists of item numbers; every length is at least 1 and at most ``window``."""
    tree, packed = CapacityTree(window), []
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        found = tree.take(length)
        if found is None:
            found = window, len(packed)
            packed.append([])
        capacity, at = found
        packed[at].append(item)
        if capacity > length:
            tree.add(capacity - length, at)
    return packed


#: A piece: number of its document in the task, start in it, ids.
Piece = tuple[int, int, bytes]


def _recut(pieces: list[Piece], window: int) -> Iterator[list[Piece]]:
    """Full windows from the pieces in order, then sequences of a power of two."""
    left = sum(len(p[2]) for p in pieces) // 4
    queue, at = pieces[::-1], 0
    while left:
        want = window if left >= window else 1 << (left.bit_length() - 1)
        left -= want
        sequence = []
        while want:
            doc, start, ids = queue[-1]
            took = ids[4 * at : 4 * (at + want)]
            sequence.append((doc, start + at, took))
            want -= len(took) // 4
            at += len(took) // 4
            if 4 * at == len(ids):
                queue.pop()
                at = 0
        yield sequence


def pack_round(pieces: list[Piece], window: int, slack: int, last: bool) -> tuple[list[list[Piece]], list[Piece]]:
    """Sequences, and the pieces that are left for the next round."""
    done, items = [], []
    for doc, start, ids in pieces:
        full = len(ids) // (4 * window)
        for k in range(full):
            done.append([(doc, start + k * window, ids[4 * k * window : 4 * (k + 1) * window])])
        if len(ids) > 4 * full * window:
            items.append((doc, start + full * window, ids[4 * full * window :]))
    lengths = np.array([len(p[2]) // 4 for p in items], dtype=np.int64)
    open_, tail = best_fit_decreasing(lengths, window) if items else [], []
    for numbers in open_:
        padding = window - int(lengths[numbers].sum())
        if padding <= slack:
            done.append([items[i] for i in numbers])
        else:
            tail.extend(items[i] for i in numbers)
    if last:
        done.extend(_recut(tail, window))
        tail = []
    return done, tail


_FIELDS = [
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
]
_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    slack: int = SLACK,
    end_id: int | None = END_ID,
    by_word: bool = True,
    with_ids: bool = True,
    round_tokens: int = ROUND_TOKENS,
) -> DataFrame:
    """Pieces of documents, each with its place in a sequence of at most ``window`` tokens.

    Returns ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset`` and, ``with_ids``, the ``ids``. A document is its text's ids (null:
    none), then ``end_id``. A document without any id has no piece. A row is a
    document of its own, also where ids repeat or are null; other columns are
    not looked at. A sequence is to be padded to ``window`` unless its length
    is a power of two. ``by_word``: see :class:`docenrich.llm.tokens.Encoder`.
    """
    ship_package(docs.sparkSession)
    with open(tokenizer_file, encoding="utf-8") as file:
        definition = file.read()
    end = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()
    schema = pa.schema(_FIELDS + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

    def rows(sequences: list[list[Piece]], ids: list, totals: list, first: int) -> pa.RecordBatch:
        flat = [(n, p) for n, s in enumerate(sequences, first) for p in s]
        lengths = np.array([len(p[2]) // 4 for _, p in flat], dtype=np.int64)
        number = np.array([n for n, _ in flat], dtype=np.int64)
        before = np.cumsum(lengths) - lengths
        fresh = np.r_[True, number[1:] != number[:-1]]
        offset = before - np.maximum.accumulate(np.where(fresh, before, 0))
        columns = [
            pa.array([ids[p[0]] for _, p in flat], pa.int64()),
            pa.array([p[1] for _, p in flat], pa.int64()),
            pa.array(lengths),
            pa.array([zlib.crc32(p[2]) for _, p in flat], pa.int64()),
            pa.array([totals[p[0]] for _, p in flat], pa.int64()),
            pa.array(number),
            pa.array(offset),
        ]
        if with_ids:
            values = np.frombuffer(b"".join(p[2] for _, p in flat), dtype="<i4")
            columns.append(pa.ListArray.from_arrays(np.r_[0, np.cumsum(lengths)].astype(np.int32), values))
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(definition, by_word)
        number = TaskContext.get().partitionId() << 36
        ids: list = []
        totals: list[int] = []
        pieces: list[Piece] = []
        held = 0

        def settle(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal ids, totals, pieces, held, number
            done, tail = pack_round(pieces, window, slack, last)
            for at in range(0, len(done), 2048):
                yield rows(done[at : at + 2048], ids, totals, number + at)
            number += len(done)
            # the documents of the tail are numbered anew, so that the others can go
            old = sorted({p[0] for p in tail})
            new = {doc: n for n, doc in enumerate(old)}
            pieces = [(new[doc], start, data) for doc, start, data in tail]
            ids, totals = [ids[doc] for doc in old], [totals[doc] for doc in old]
            held = 0

        for batch in batches:
            for at in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(at, _TEXTS)
                encoded = encoding.encode(part.column("text"))
                for doc_id, data in zip(part.column("doc_id").to_pylist(), encoded):
                    data += end
                    if data:
                        pieces.append((len(ids), 0, data))
                        ids.append(doc_id)
                        totals.append(len(data) // 4)
                        held += len(data) // 4
                if held >= round_tokens:
                    yield from settle(last=False)
        yield from settle(last=True)
        encoding.forget()

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), clean_text(text_col).alias("text"))
    return texts.mapInArrow(released(task), _DDL + (", ids array<int>" if with_ids else ""))
