"""Operator 6: harmonic packing of token sequences.

With capacity C, an item whose length lies in (C/(k+1), C/k] belongs to class k, and a bin of class k takes k items of it,
whatever they are. Each worker fills the bins of its own rows and shares none. An item is a whole document; one of C tokens
or more first gives whole bins of C, and what is left of it is the item.

k items of class k leave less than C/(k+1) tokens of a bin empty. Since documents may be cut, a document at hand is cut
up to fill these rooms: the filler, which is the next document where the one before is used up. So a bin is full to the
last token, all documents but the fillers stay whole, and nothing is padded. When a worker's rows end, what is left in
unfilled bins goes one after another into shared bins, cut where a bin ends; the last is cut at powers of two, where a
sequence needs no padding.

Memory: a class holds less than one bin of items, and there is one filler, of less than C tokens; classes are at most C,
whatever the input. A document is held whole while it is cut.

Defined results: a null text counts as empty (its document is the end id alone); a null doc id stays null; repeated rows
are packed each for itself; an empty table gives no rows; other columns, whatever their names, are not read.
``sequence_id`` is unique over all workers: (partition << 36) + number in the partition. Which pieces share a sequence,
and which documents are cut, depends on how the input is split into partitions.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, trim
from .tokens import default_path, encoder

CAPACITY = 2048


class HarmonicPacker:
    """Packs documents of one worker. A piece is (doc, start, ids); finished sequences, lists of pieces, come out of add() and
    finish()."""

    def __init__(self, capacity: int = CAPACITY):
        if capacity < 1 or capacity & (capacity - 1):
            raise ValueError("capacity is a power of two")
        self.capacity = capacity
        self.open: dict[int, list] = {}
        self.filler: tuple | None = None
        #: The bin that waits for the next filler, and its empty tokens.
        self.waiting: tuple[list, int] | None = None

    def _fill(self, held: list, room: int):
        """The bin as a sequence, if the filler fills it."""
        while room and self.filler:
            doc, at, ids = self.filler
            held.append((doc, at, ids[:room]))
            self.filler = (doc, at + room, ids[room:]) if len(ids) > room else None
            room -= len(held[-1][2])
        if room:
            self.waiting = held, room
        else:
            yield held

    def add(self, doc, ids: np.ndarray):
        """Bins that this document completes."""
        at = 0
        while len(ids) - at >= self.capacity:
            yield [(doc, at, ids[at : at + self.capacity])]
            at += self.capacity
        if at == len(ids):
            return
        item = doc, at, ids[at:].copy() if at else ids  # a long document is not held for its rest
        if self.waiting:
            self.filler, (held, room), self.waiting = item, self.waiting, None
            yield from self._fill(held, room)
            return
        k = self.capacity // len(item[2])  # the class: the length lies in (capacity/(k+1), capacity/k]
        held = self.open.setdefault(k, [])
        held.append(item)
        if len(held) == k:
            yield from self._fill(held, self.capacity - sum(len(p[2]) for p in self.open.pop(k)))

    def finish(self):
        """What is left: in order of class into shared bins, cut where they end; the rest cut at powers of two."""
        line = deque([*(self.waiting[0] if self.waiting else ()), *([self.filler] if self.filler else ()), *(p for k in sorted(self.open) for p in self.open[k])])
        self.open, self.filler, self.waiting = {}, None, None
        left = sum(len(p[2]) for p in line)
        while left:
            room = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
            left -= room
            out = []
            while room:
                doc, at, ids = line.popleft()
                if len(ids) > room:
                    line.appendleft((doc, at + room, ids[room:]))
                    ids = ids[:room]
                out.append((doc, at, ids))
                room -= len(ids)
            yield out


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = 1, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked, ids. No shuffle."""
    path = tokenizer or default_path()

    def pack(batches):
        enc, packer, number = encoder(path), HarmonicPacker(capacity), TaskContext.get().partitionId() << 36
        rows: list[list] = [[] for _ in range(8)]

        def lay(sequence):
            nonlocal number
            at = 0
            for (doc, total), start, ids in sequence:
                for col, x in zip(rows, (doc, start, len(ids), zlib.crc32(ids), total, number, at, ids if with_ids else None)):
                    col.append(x)
                at += len(ids)
            number += 1

        def out():
            cols = [pa.array(c, pa.int64()) for c in rows[:7]]
            if with_ids:
                ends = np.concatenate([[0], np.cumsum(rows[2])]).astype(np.int32)
                cols.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows[7]).astype(np.int64))))
            batch = pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids)
            for c in rows:
                c.clear()
            return batch

        for batch in (whole.slice(i, 1024) for whole in batches for i in range(0, whole.num_rows, 1024)):
            got, sizes = enc.encode_column(batch.column(1))
            at = 0
            for doc, n in zip(batch.column(0).to_pylist(), sizes.tolist()):
                ids = np.empty(n + 1, "<u4")
                ids[:n] = got[at : at + n]
                ids[n] = end_id
                at += n
                for sequence in packer.add((doc, n + 1), ids):
                    lay(sequence)
            if rows[0]:
                yield out()
        for sequence in packer.finish():
            lay(sequence)
        if rows[0]:
            yield out()
        trim()

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return own.mapInArrow(pack, SCHEMA + ", ids array<long>" * with_ids)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), with_ids=False)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's last stage: pieces with their token ids, of every row of docs (see the module for odd rows)."""
    return pack_documents(docs)
