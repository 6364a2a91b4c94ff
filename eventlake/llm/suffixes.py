"""Byte strings that repeat anywhere in a corpus, found by sorting sampled suffixes.

Only the first ``length`` bytes of a suffix matter here: a byte is removed if a string of
that many bytes covers it and also starts earlier. The suffixes to compare are sampled in
a way that two equal strings are always sampled at the same place, as a difference cover
does by position; here the sample follows the content, so that one sampled suffix stands
for all strings around it:

1. Every string of ``length`` bytes picks the least hash among its ``gram``-byte
   substrings: its anchor. Equal strings pick equal anchors at equal places. Strings next
   to each other share anchors, so there are far fewer anchors than strings.
2. Anchors are grouped by their gram, and within it by the whole text their strings cover.
   An anchor of a gram that occurs once is done; one whose text stands earlier is covered.
3. What is left of an anchor's strings is cut into cells of neighbouring starts. A cell is
   named by the bytes that all its strings hold, the sampled suffix; cells are grouped by
   name, and those with a name of their own are done.
4. The strings of the other cells are grouped by their bytes: all but the first are covered.

Names and bytes are grouped by pairs of 64-bit hashes, not sorted. Each step looks at a small part of what the step before did. No step needs a group together:
equal rows of one batch are merged before they are shuffled, all but the first being
covered whatever else there is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from eventlake.llm.common import Places, free_name, settle, with_units

LENGTH = 100
GRAM = 40
CELL = 8
#: Bytes of a text looked at together, and the bits that number them.
BLOCK_BITS = 24
BLOCK = 1 << 22

_random = np.random.default_rng(11)
_BYTE = _random.integers(0, 2**64, 256, np.uint64, endpoint=False)
_FACTOR = _random.integers(0, 2**63, 40, np.uint64) * np.uint64(2) + np.uint64(1)


def gram_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` bytes that start at each place, by doubling."""
    current, done, result, width, level = _BYTE[raw], 0, None, 1, 0
    while True:
        if size & width:
            if result is None:
                result = current
            else:
                n = len(raw) - done - width + 1
                result = _joined(result[:n], current[done : done + n], 20 + level)
            done += width
        if done == size:
            return result
        n = len(current) - width
        current = _joined(current[:n], current[width:], level)
        width, level = 2 * width, level + 1


def _joined(left: np.ndarray, right: np.ndarray, level: int) -> np.ndarray:
    mixed = left * _FACTOR[level]
    mixed ^= mixed >> np.uint64(29)
    mixed += right
    return mixed


def anchors_of(raw: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """(anchor, first, last, hash) per anchor: the strings that start at first to last pick
    the gram at anchor. Ties go to the leftmost gram. A text shorter than ``length`` has
    none."""
    parts = []
    window = length - gram + 1
    for begin in range(0, max(len(raw) - length + 1, 0), BLOCK):
        part = raw[begin : begin + BLOCK + length - 1]
        hashes = gram_hashes(part, gram)
        low = np.uint64((1 << BLOCK_BITS) - 1)
        keys = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        least = (_sliding_minimum(keys, window) & low).astype(np.int64)
        starts = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        ends = np.concatenate((starts[1:], [len(least)])) - 1
        chosen = least[starts]
        table = np.column_stack([chosen, starts, ends]) + begin
        parts.append((table, hashes[chosen].view(np.int64)))
    if not parts:
        return np.empty((0, 4), np.int64)
    return np.vstack([np.column_stack([table, hashes]) for table, hashes in parts])


def _sliding_minimum(values: np.ndarray, window: int) -> np.ndarray:
    """Minimum of every ``window`` values in a row, from minima before and after the
    borders of blocks as long as the window."""
    n = len(values)
    padded = np.full(-(-n // window) * window, np.uint64(2**64 - 1))
    padded[:n] = values
    blocks = padded.reshape(-1, window)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - window + 1], before[window - 1 : n])


def _text_bytes(texts: pa.Array) -> Iterator[np.ndarray]:
    for text in texts:
        yield np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid else np.empty(0, np.uint8)


def repeated_spans(
    texts: DataFrame, length: int = LENGTH, gram: int = GRAM, cell: int = CELL
) -> DataFrame:
    """(unit, spans): for every unit with repeated bytes, spans of them as start * 2**32 +
    end, in bytes; they may overlap. ``texts`` is (unit, text); units are in order of age.
    """
    if length - gram > 255:
        raise ValueError("the strings of an anchor are numbered in a byte")
    places = Places.of(texts, "unit")
    anchors = _anchors(texts, places, length, gram)
    cells = _cells(texts, anchors.filter("NOT covered"), places, length, gram, cell)
    strings = _strings(texts, cells.filter("NOT covered"), places, length)
    spans = [
        found.filter("covered").select("unit", _span(length))
        for found in (anchors, cells, strings)
    ]
    every = spans[0].unionByName(spans[1]).unionByName(spans[2])
    return settle(every.groupBy("unit").agg(F.collect_list("span").alias("spans")), "spans")


def _spots(first: np.ndarray, last: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The strings that start at ``first`` to ``last``, and their anchor, as one number."""
    return (first << 16) | ((last - first) << 8) | (at - first)


def _unpacked(spots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    first = spots >> 16
    return first, first + ((spots >> 8) & 255), first + (spots & 255)


def _first() -> Column:
    return F.shiftright("spot", 16)


def _span(length: int) -> Column:
    """All bytes of a spot's strings."""
    last = _first() + F.shiftright("spot", 8).bitwiseAND(F.lit(255))
    return (F.shiftleft(_first(), 32) + last + length).alias("span")


def _compared(rows: DataFrame, places: Places, name: str) -> DataFrame:
    """``rows`` (key, whole, spot, unit, covered) of keys that meet another text, with
    ``covered`` set where the whole text stands earlier; others that share their key
    with no other text are left out unless covered.

    Rows covered from the start are never compared, so they are dealt by their place.
    """
    apart = F.when(F.col("covered"), F.xxhash64("unit", "spot")).otherwise(F.col("key"))
    dealt = rows.withColumn("key", apart).repartition("key")
    dealt = dealt.withColumn("place", places.at(F.col("unit"), _first()))
    same = Window.partitionBy("key", "covered", "whole")
    near = Window.partitionBy("key", "covered")
    compared = dealt.withColumns({"earliest": F.min("place").over(same)}).withColumns(
        {"least": F.min("whole").over(near), "most": F.max("whole").over(near)}
    )
    covered = F.col("covered") | (F.col("place") > F.col("earliest"))
    kept = compared.withColumn("covered", covered).filter("covered OR least <> most")
    return settle(kept.select("unit", "spot", "covered"), name)


#: What is compared: the hash that rows meet by, the hash of all the bytes, and the spot.
COLUMNS = ["key", "whole", "spot"]
SCHEMA = "key bigint, whole bigint, spot bigint, unit bigint, covered boolean"


def _stands_earlier(table: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """Whether a row equal to each row in key and whole has an earlier place."""
    key, whole, spot = table.T
    order = np.lexsort((spot, unit, whole, key))
    equal = (table[order[1:], :2] == table[order[:-1], :2]).all(axis=1)
    group = np.where(np.concatenate(([False], equal)), 0, np.arange(len(order)))
    first = order[np.maximum.accumulate(group)]
    covered = np.zeros(len(order), bool)
    covered[order] = (unit[order] != unit[first]) | (spot[order] != spot[first])
    return covered


def _table(rows: list[np.ndarray], units: list[np.ndarray]) -> pa.RecordBatch:
    """A batch with the unit and, in covered, whether an equal row of the batch has an
    earlier place."""
    table = np.vstack(rows) if rows else np.empty((0, len(COLUMNS)), np.int64)
    unit = np.concatenate(units) if units else np.empty(0, np.int64)
    covered = _stands_earlier(table, unit) if len(table) else np.zeros(0, bool)
    columns = [pa.array(column) for column in table.T]
    return pa.RecordBatch.from_arrays(
        [*columns, pa.array(unit), pa.array(covered)], names=[*COLUMNS, "unit", "covered"]
    )


def _per_text(
    table_of: Callable[[np.ndarray, np.ndarray | None], np.ndarray],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Apply ``table_of`` to each text, and its list of numbers if it has one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = batch.column("unit").to_numpy(zero_copy_only=False)
            lists = batch.column("chosen") if "chosen" in batch.schema.names else None
            rows, owners = [], []
            for i, raw in enumerate(_text_bytes(batch.column("text"))):
                chosen = None if lists is None else lists[i].values.to_numpy()
                table = table_of(raw, chosen)
                rows.append(table)
                owners.append(np.full(len(table), units[i]))
            yield _table(rows, owners)

    return run


def _digests(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seeds) -> np.ndarray:
    """Hashes of spans of a text, each with a seed of its own."""
    view = memoryview(raw)
    digest = xxhash.xxh3_64_intdigest
    spans = zip(starts.tolist(), ends.tolist(), seeds.tolist())
    hashes = (digest(view[a:b], seed) for a, b, seed in spans)
    return np.fromiter(hashes, np.uint64, len(starts)).view(np.int64)


def _anchors(texts: DataFrame, places: Places, length: int, gram: int) -> DataFrame:
    """Step 2: rows meet by the anchor's gram; whole is the text its strings cover."""

    def table_of(raw: np.ndarray, _: object) -> np.ndarray:
        at, first, last, hashes = anchors_of(raw, length, gram).T
        seeds = ((at - first) << 8) | (last - first)
        whole = _digests(raw, first, last + length, seeds)
        return np.column_stack([hashes, whole, _spots(first, last, at)])

    rows = texts.select("unit", "text").mapInArrow(_per_text(table_of), SCHEMA)
    return _compared(rows, places, "anchors")


def _chosen(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """(unit, text, chosen): the texts that have rows, with the spots of these."""
    lists = rows.groupBy("unit").agg(F.collect_list("spot").alias("chosen"))
    return texts.select("unit", "text").join(lists, "unit")


def _cells(
    texts: DataFrame, anchors: DataFrame, places: Places, length: int, gram: int, cell: int
) -> DataFrame:
    """Step 3: rows meet by the cell's name; whole is the text its strings cover. Cells
    are cut by the distance from the anchor, so equal strings are in equal cells."""

    def table_of(raw: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        first, last, at = _unpacked(np.unique(chosen))
        parts = []
        for number in range((length - gram) // cell + 1):
            near, far = at - number * cell, at - (number + 1) * cell + 1
            begin, end = np.maximum(first, far), np.minimum(last, near)
            held = begin <= end
            f, n, b, e = (x[held] for x in (far, near, begin, end))
            # Every string of a whole cell holds the bytes from its last start to the end
            # of its first string, whichever of them the anchor has.
            key = _digests(raw, n, f + length, np.full(len(n), number))
            whole = _digests(raw, b, e + length, ((n - b) << 8) | (n - e))
            parts.append(np.column_stack([key, whole, _spots(b, e, b)]))
        return np.vstack(parts)

    rows = _chosen(texts, anchors).mapInArrow(_per_text(table_of), SCHEMA)
    return _compared(rows, places, "cells")


def _strings(texts: DataFrame, cells: DataFrame, places: Places, length: int) -> DataFrame:
    """Step 4: a row for each string of the cells; key and whole are two hashes of its
    bytes."""

    def table_of(raw: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        first, last, _ = _unpacked(chosen)
        sizes = last - first + 1
        at = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        at = np.unique(at)
        key = _digests(raw, at, at + length, np.zeros(len(at), np.int64))
        whole = _digests(raw, at, at + length, np.ones(len(at), np.int64))
        return np.column_stack([key, whole, _spots(at, at, at)])

    rows = _chosen(texts, cells).mapInArrow(_per_text(table_of), SCHEMA)
    return _compared(rows, places, "strings")


def merged_spans(spans: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs that packed spans cover."""
    spans = np.sort(spans)
    starts, ends = spans >> 32, np.minimum(spans & (2**32 - 1), size)
    reach = np.maximum.accumulate(ends) if len(ends) else ends
    new = np.concatenate(([True], starts[1:] > reach[:-1])) if len(starts) else np.empty(0, bool)
    last = np.concatenate((new[1:], [True])) if len(starts) else new
    return starts[new], reach[last]


def without_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with the columns n_bytes, n_removed, n_spans, kept_sha256 and kept_text.

    Removed is each byte covered by a ``length``-byte string that also starts earlier: in
    a document of smaller id, or earlier in the same one. Matches never cross documents,
    and strings are judged on the input. Runs are maximal. kept_text leaves out what is
    no longer whole characters. A null text is empty; empty and short texts keep all; rows
    that repeat id and text are one document and lose the same bytes.
    """
    unit = free_name(docs, "unit")
    numbered = with_units(docs, unit, id_col, text_col)
    texts = numbered.select(F.col(unit).alias("unit"), F.col(text_col).alias("text"))
    spans = repeated_spans(texts.filter(F.octet_length("text") >= length), length)
    key, packed = free_name(numbered, "unit_of_spans"), free_name(numbered, "spans")
    spans = spans.select(F.col("unit").alias(key), F.col("spans").alias(packed))
    joined = numbered.join(spans, F.col(unit) == F.col(key), "left").drop(key, unit)
    added = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
    kept_columns = [c for c in docs.columns if c not in added]
    joined = joined.select(*kept_columns, packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            lists = batch.column(packed)
            for i, raw in enumerate(_text_bytes(batch.column(text_col))):
                own = lists[i].values.to_numpy() if lists[i].is_valid else np.empty(0, np.int64)
                starts, ends = merged_spans(own, len(raw))
                borders = np.column_stack([starts, ends]).ravel().tolist()
                view = memoryview(raw)
                edges = [0, *borders, len(raw)]
                kept = b"".join(view[a:b] for a, b in zip(edges[::2], edges[1::2]))
                rows.append(
                    (
                        len(raw),
                        len(raw) - len(kept),
                        len(starts),
                        hashlib.sha256(kept).hexdigest(),
                        kept.decode("utf-8", "ignore"),
                    )
                )
            columns = zip(*rows) if rows else [[] for _ in added]
            types = [*[pa.int64()] * 3, pa.string(), pa.string()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept_columns] + arrays, names=kept_columns + added
            )

    schema = joined.select(*kept_columns).schema
    for name in added:
        schema = schema.add(name, LongType() if name.startswith("n_") else StringType())
    return joined.mapInArrow(run, schema)
