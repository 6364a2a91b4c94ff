"""Token ids of a corpus as files: one concatenated array of ids, and Elias-Fano coded
boundaries of its documents.

A file holds, one after another,

* a head: magic, bytes of an id, documents, documents without an id of their own, smallest id;
* the documents' ends in the array, as an Elias-Fano sequence;
* the documents' ids less the smallest, as another (those of documents without an id: 0);
* the array, of 16-bit ids where the vocabulary allows, else of 32-bit ones;

and a line feed, with which Spark's writer ends it. An Elias-Fano sequence of n numbers
up to u takes about 2 + log2(u / n) bits a number: the low bits of each, packed, and the
high bits as gaps in unary, in a bit array with the place of every 256th one beside it.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.llm.ids import encoder, library

#: Fixed values of the format.
MAGIC = b"EFIDS001"
HEAD = struct.Struct("<8sBQQq")
SEQUENCE = struct.Struct("<QBQ")
#: Ones between two of which the place is kept.
STEP = 256
#: Numbers whose low bits are packed at once; a multiple of 8, so parts end on whole bytes.
AT_ONCE = 1 << 16


@dataclass(frozen=True)
class EliasFano:
    """A sequence of numbers that never falls, in little space and with any of them at hand."""

    n: int
    low_bits: int
    low: np.ndarray
    high: np.ndarray
    places: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n, most = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (most // max(n, 1)).bit_length() - 1)
        each = np.arange(low_bits, dtype=np.uint64)
        low = [
            np.packbits(
                (values[i : i + AT_ONCE, None] >> each & np.uint64(1)).astype(np.uint8).ravel(),
                bitorder="little",
            )
            for i in range(0, n, AT_ONCE)
        ]
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros((most >> low_bits) + n + 1, np.uint8)
        bits[ones] = 1
        return cls(
            n,
            low_bits,
            np.concatenate([np.zeros(0, np.uint8), *low]),
            np.packbits(bits, bitorder="little"),
            ones[::STEP].astype("<u4"),
        )

    def to_bytes(self) -> bytes:
        head = SEQUENCE.pack(self.n, self.low_bits, len(self.high))
        return b"".join([head, self.low.tobytes(), self.high.tobytes(), self.places.tobytes()])

    @classmethod
    def read(cls, buffer: memoryview, at: int) -> tuple[EliasFano, int]:
        """The sequence that begins at ``at``, and where it ends; nothing is copied."""
        n, low_bits, n_high = SEQUENCE.unpack_from(buffer, at)
        at += SEQUENCE.size
        parts = []
        for size, kind in ((-(-n * low_bits // 8), "u1"), (n_high, "u1"), (-(-n // STEP), "<u4")):
            parts.append(np.frombuffer(buffer, kind, size, at))
            at += parts[-1].nbytes
        return cls(n, low_bits, *parts), at

    def select(self, i: int) -> int:
        """The place of the ``i``-th one of the high bits: from the kept place before it,
        by whole bytes, then within one."""
        left, start = i % STEP, int(self.places[i // STEP])
        byte = start // 8
        left += int(np.bitwise_count(self.high[byte] & np.uint8((1 << start % 8) - 1)))
        while True:
            sums = np.cumsum(np.bitwise_count(self.high[byte : byte + STEP]), dtype=np.int64)
            if sums[-1] > left:
                break
            left -= int(sums[-1])
            byte += STEP
        here = int(np.searchsorted(sums, left, "right"))
        left -= int(sums[here - 1]) if here else 0
        ones = np.flatnonzero(np.unpackbits(self.high[byte + here], bitorder="little"))
        return 8 * (byte + here) + int(ones[left])

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        return (self.select(i) - i) << self.low_bits | int(self._low(i, i + 1)[0])

    def up_to(self, value: int) -> int:
        """How many of the numbers are ``value`` at most, by halving."""
        low, high = 0, self.n
        while low < high:
            middle = (low + high) // 2
            low, high = (middle + 1, high) if self[middle] <= value else (low, middle)
        return low

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))
        high = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        low = [self._low(i, min(i + AT_ONCE, self.n)) for i in range(0, self.n, AT_ONCE)]
        return high | np.concatenate([np.zeros(0, np.uint64), *low])

    def _low(self, i: int, j: int) -> np.ndarray:
        start, end = i * self.low_bits, j * self.low_bits
        bits = np.unpackbits(self.low[start // 8 : -(-end // 8)], bitorder="little")
        bits = bits[start % 8 : start % 8 + end - start].reshape(j - i, self.low_bits)
        each = np.arange(self.low_bits, dtype=np.uint64)
        return (bits.astype(np.uint64) << each).sum(1, dtype=np.uint64)


@dataclass(frozen=True)
class TokenFile:
    """One file of the format."""

    n_null: int
    smallest: int
    ends: EliasFano
    doc_ids: EliasFano
    ids: np.ndarray

    @staticmethod
    def to_bytes(doc_ids: list[int | None], ids: list[np.ndarray], width: int) -> bytes:
        """The file of documents in ascending order of their ids, those without one first."""
        known = np.array([d for d in doc_ids if d is not None], np.int64)
        smallest = int(known[0]) if len(known) else 0
        above = known.view(np.uint64) - np.array([smallest], np.int64).view(np.uint64)
        n_null = len(doc_ids) - len(known)
        above = np.concatenate([np.zeros(n_null, np.uint64), above])
        return b"".join(
            [
                HEAD.pack(MAGIC, width, len(doc_ids), n_null, smallest),
                EliasFano.of(np.cumsum([len(i) for i in ids], dtype=np.int64)).to_bytes(),
                EliasFano.of(above).to_bytes(),
                *(i.astype(f"<u{width}").tobytes() for i in ids),
            ]
        )

    @classmethod
    def read(cls, content: bytes) -> TokenFile:
        buffer = memoryview(content)
        magic, width, n_docs, n_null, smallest = HEAD.unpack_from(buffer)
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        ends, at = EliasFano.read(buffer, HEAD.size)
        doc_ids, at = EliasFano.read(buffer, at)
        n_ids = ends[n_docs - 1] if n_docs else 0
        return cls(n_null, smallest, ends, doc_ids, np.frombuffer(buffer, f"<u{width}", n_ids, at))

    def __len__(self) -> int:
        return self.ends.n

    def start(self, i: int) -> int:
        """Ids in this file before those of its ``i``-th document."""
        return self.ends[i - 1] if i else 0

    def doc_id(self, i: int) -> int | None:
        return None if i < self.n_null else self.smallest + self.doc_ids[i]

    def tokens(self, i: int) -> np.ndarray:
        return self.ids[self.start(i) : self.ends[i]]

    def doc_at(self, place: int) -> int:
        """The number of the document that holds the id at ``place`` of the array."""
        return self.ends.up_to(place)

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(id, start, tokens) of every document."""
        above = self.doc_ids.all()
        known = (above + np.array([self.smallest], np.int64).view(np.uint64)).view(np.int64)
        start = 0
        for i, (doc_id, end) in enumerate(zip(known.tolist(), self.ends.all().tolist())):
            yield None if i < self.n_null else doc_id, start, self.ids[start:end]
            start = end


def write(
    docs: DataFrame,
    folder: str,
    path: str,
    end_id: int = 2,
    file_ids: int = 8 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Write the ids of every text, each followed by ``end_id``, to a new ``folder`` in
    ascending order of the documents' ids.

    Texts are dealt out by ranges of (id, hash of the text) and sorted within; a task
    encodes its rows as they come and writes a file once it holds ``file_ids`` ids or a
    document reaches beyond. Rows without an id come first. Documents of one id follow in the order of
    their texts' hashes, and rows that repeat both are kept as often as they occur; a null text is
    empty, so its document is ``end_id`` alone. Each file lies in a folder whose name tells
    its task, the ids that task wrote before it, its documents and its ids.
    """
    width = 2 if max(library(path).get_vocab_size(), end_id + 1) <= 1 << 16 else 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        task = TaskContext.get().partitionId()
        end = np.array([end_id], np.uint32)
        kept: list[np.ndarray] = []
        doc_ids: list[int | None] = []
        before = held = 0

        def file() -> pa.RecordBatch:
            span = f"t{task:08d}-{before}-{len(doc_ids)}-{held}"
            content = TokenFile.to_bytes(doc_ids, kept, width)
            return pa.RecordBatch.from_arrays(
                [pa.array([span]), pa.array([content], pa.binary())], names=["span", "content"]
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.concatenate([encode(text.as_py()), end]).astype(f"<u{width}")
                doc_ids.append(doc_id)
                kept.append(ids)
                held += len(ids)
                if held >= file_ids:
                    yield file()
                    before += held
                    kept, doc_ids, held = [], [], 0
        if doc_ids:
            yield file()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    order = ["id", F.xxhash64("text")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    files = placed.mapInArrow(run, "span string, content binary")
    raw = files.select("span", F.col("content").cast("string").alias("value"))
    raw.write.partitionBy("span").text(folder)


def files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, task, before, n_docs, n_ids, start, content) of every file, start being the ids in
    all files before it. Contents are read only where they are asked for.

    The sums over tasks are a row for each task of the writer, as many as its shuffle had
    partitions at most, and so are broadcast.
    """
    found = spark.read.format("binaryFile").load(folder)
    if "span" not in found.columns:
        found = found.withColumn("span", F.lit(None).cast("string"))
    part = F.split(F.substr(F.col("span").cast("string"), F.lit(2)), "-")
    names = ["task", "before", "n_docs", "n_ids"]
    found = found.select(
        "path", *[part[i].cast("long").alias(name) for i, name in enumerate(names)], "content"
    )
    by_task = found.groupBy("task").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("task")) - F.col("n")
    tasks = by_task.select("task", before.alias("task_start"))
    joined = found.join(F.broadcast(tasks), "task")
    return joined.withColumn("start", F.col("task_start") + F.col("before")).drop("task_start")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in a folder that :func:`write`
    filled: start is the ids of all documents before it, and ids are its own as unsigned 32-bit
    little-endian numbers. An empty folder gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = ["doc_id", "start", "n_tokens", "ids"]

        def as_batch(rows: list[tuple]) -> pa.RecordBatch:
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            for first, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows: list[tuple] = []
                held = 0
                for doc_id, start, ids in TokenFile.read(content.as_buffer()).documents():
                    rows.append((doc_id, first + start, len(ids), ids.astype("<u4").tobytes()))
                    held += len(ids)
                    if held > 1 << 20 or len(rows) >= 10_000:
                        yield as_batch(rows)
                        rows, held = [], 0
                if rows:
                    yield as_batch(rows)

    return files(spark, folder).select("start", "content").mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids binary"
    )
