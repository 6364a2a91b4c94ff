"""Packing of tokenized documents into sequences under several limits at once."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from eventlake.llm.ids import encoder

#: Examples held until half of them are packed; the more there are, the better they fit.
POOL = 4096

RESULT = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, loss_tokens bigint"
)


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold: tokens, pieces, and tokens that bear loss."""

    tokens: int = 2048
    segments: int = 128
    loss_tokens: int = 2048


@dataclass
class Example:
    """Ids not yet placed: those of one document from ``start`` on. Loss is borne from
    ``loss_start`` on, counted in the document."""

    doc_id: int | None
    total: int
    loss_start: int
    start: int
    ids: np.ndarray

    def loss(self, length: int) -> int:
        return max(0, self.start + length - max(self.start, self.loss_start))

    def longest(self, limits: Limits) -> int:
        """The most of it that fits into an empty sequence."""
        free = max(0, self.loss_start - self.start)
        return min(len(self.ids), limits.tokens, free + limits.loss_tokens)

    def cut(self, length: int) -> tuple[Example, Example]:
        head = Example(self.doc_id, self.total, self.loss_start, self.start, self.ids[:length])
        tail = Example(
            self.doc_id, self.total, self.loss_start, self.start + length, self.ids[length:]
        )
        return head, tail


class Packer:
    """Vector bin packing of a stream of examples, in bounded memory.

    A sequence is filled by one example after another: of those that fit, the one whose
    needs have the largest dot product with what the sequence has left, all measured in
    parts of the limits. Where none fits, one is cut to fill the rest. The last
    sequences are cut at powers of two, which need no padding.
    """

    def __init__(self, limits: Limits, first_id: int):
        self.limits = limits
        self.next_id = first_id
        self.pool: list[Example] = []

    def add(self, example: Example) -> Iterator[tuple]:
        """Take an example; give the pieces that are placed by now."""
        while len(example.ids) > (most := example.longest(self.limits)):
            head, example = example.cut(most)
            if most == self.limits.tokens:
                yield from self._close([head])
            else:
                self.pool.append(head)
        if most == self.limits.tokens:
            yield from self._close([example])
        elif len(example.ids):
            self.pool.append(example)
        if len(self.pool) >= POOL:
            yield from self._pack(POOL // 2)

    def finish(self) -> Iterator[tuple]:
        yield from self._pack(0)

    def _pack(self, leave: int) -> Iterator[tuple]:
        limits = self.limits
        scale = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
        waiting = self.pool
        needs = np.array([[len(e.ids), 1, e.loss(len(e.ids))] for e in waiting], float)
        needs = needs.reshape(-1, 3) / scale
        live = np.ones(len(waiting), bool)
        unplaced = sum(len(e.ids) for e in waiting)
        count = len(waiting)
        while count > leave:
            tokens = limits.tokens
            if unplaced < tokens:
                tokens = 1 << (unplaced.bit_length() - 1)
            room = np.array([tokens, limits.segments, limits.loss_tokens], float)
            chosen: list[Example] = []
            while room[0] > 0 and room[1] > 0 and count:
                left = room / scale
                fits = live & (needs <= left + 1e-12).all(1)
                if fits.any():
                    i = int(np.where(fits, needs @ left, -1.0).argmax())
                    piece, live[i] = waiting[i], False
                    count -= 1
                else:
                    i = int(np.where(live, needs[:, 0], -1.0).argmax())
                    whole = waiting[i]
                    free = max(0, whole.loss_start - whole.start)
                    length = int(min(room[0], free + room[2], len(whole.ids)))
                    if length < 1:
                        break
                    piece, waiting[i] = whole.cut(length)
                    rest = waiting[i]
                    needs[i] = np.array([len(rest.ids), 1, rest.loss(len(rest.ids))]) / scale
                    if not len(rest.ids):
                        live[i] = False
                        count -= 1
                room -= [len(piece.ids), 1, piece.loss(len(piece.ids))]
                unplaced -= len(piece.ids)
                chosen.append(piece)
            yield from self._close(chosen)
        self.pool = [example for example, kept in zip(waiting, live) if kept]

    def _close(self, pieces: list[Example]) -> Iterator[tuple]:
        offset = 0
        for piece in pieces:
            length = len(piece.ids)
            crc = zlib.crc32(piece.ids.astype("<u4").tobytes())
            yield (
                piece.doc_id, piece.start, length, crc, piece.total, self.next_id, offset,
                piece.loss(length),
            )
            offset += length
        self.next_id += 1


def pack(
    docs: DataFrame,
    path: str,
    limits: Limits = Limits(),
    end_id: int = 1,
    prompt_col: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """A row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, loss_tokens).

    A document is the ids of its text and then ``end_id``; a null text is empty, so each
    row gives at least one piece, and repeated rows are packed like any other. Texts may be
    of any length, and so may runs of white space in them. With
    ``prompt_col``, that column's ids come first and bear no loss. Every task packs the
    rows it reads: no row is shuffled, and a lost task is simply packed again.
    ``sequence_id`` is unique over all tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        no_ids, end = np.zeros(0, np.uint32), np.array([end_id], np.uint32)
        packer = Packer(limits, TaskContext.get().partitionId() << 33)
        names = [field.split()[0] for field in RESULT.split(", ")]
        types = [pa.int64()] * len(names)

        def as_batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows) if rows else [[] for _ in names]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            rows: list[tuple] = []
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                before = encode(row[2]) if len(row) > 2 else no_ids
                ids = np.concatenate([before, encode(row[1]), end]).astype(np.uint32)
                rows.extend(packer.add(Example(row[0], len(ids), len(before), 0, ids)))
            yield as_batch(rows)
        yield as_batch(list(packer.finish()))

    columns = [f"CAST(`{id_col}` AS BIGINT) AS doc_id", f"`{text_col}` AS text"]
    if prompt_col:
        columns.append(f"`{prompt_col}` AS prompt")
    return docs.selectExpr(*columns).mapInArrow(run, RESULT)
