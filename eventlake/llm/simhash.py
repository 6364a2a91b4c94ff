"""SimHash fingerprints and the groups of documents they link."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from eventlake.llm.common import free_name, settle
from eventlake.llm.components import connected_components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
SEED = 42
#: Shingles whose bits are counted at once.
BLOCK = 1 << 16
#: Rows before a row that the first pass compares it with.
REACH = 16


def fingerprint_of(text: str | None, size: int = 4) -> int:
    """The 64 majority bits of the XXH64 values of ``text``'s word shingles.

    A-Z are lower-cased, shingles of ``size`` words count as often as they occur, a
    shorter text is one shingle, and a text without words (or null) has fingerprint 0.
    """
    words = WORD.findall((text or "").encode("utf-8", "replace").translate(LOWER))
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(len(words) - size, 0)
    spans = zip(starts[: last + 1].tolist(), ends[min(size, len(words)) - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[i:j], SEED) for i, j in spans), np.uint64, last + 1)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), BLOCK):
        part = hashes[i : i + BLOCK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


@F.pandas_udf(LongType())
def fingerprint(texts: pd.Series) -> pd.Series:
    """:func:`fingerprint_of` as a signed number."""
    prints = np.fromiter(map(fingerprint_of, texts), np.uint64, len(texts))
    return pd.Series(prints.view(np.int64))


def hex_fingerprint(column: Column) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def near_duplicates(
    docs: DataFrame,
    distance: int = 4,
    blocks: int = 6,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``.

    Fingerprints link at ``distance`` or fewer differing bits; component_id is the
    smallest id reachable over links, null only where no id of the component is set.
    Null and empty texts have fingerprint 0 and link like any other. Other columns of
    ``docs`` are not read. Documents of one fingerprint are one node of the graph, so
    copies, however many, are merged before anything is joined.
    """
    prints = settle(
        docs.select(
            F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col)).alias("fingerprint")
        ),
        "fingerprints",
    )
    nodes = settle(
        prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "nodes"
    )
    roots = linked_fingerprints(nodes.select("fingerprint"), distance, blocks)
    rooted = nodes.join(roots, "fingerprint")
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    members = rooted.select("fingerprint", "root").join(smallest, "root").drop("root")
    found = prints.join(members, "fingerprint")
    return found.select("doc_id", hex_fingerprint(F.col("fingerprint")).alias("fingerprint"), "component_id")


def one_of_each(
    docs: DataFrame,
    distance: int = 4,
    blocks: int = 6,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with one row of each group that :func:`near_duplicates` links: the row of
    the smallest id.

    Rows without an id come last; rows that share an id are ordered by a hash of all their
    columns, so the same row stays on every run. A row is found again by its id and 128
    bits of all its columns: only rows that are equal throughout stand for each other.
    """
    # A hash passes over nulls, so where they are is hashed too.
    nulls = F.concat(*(F.isnull(c).cast("int").cast("string") for c in docs.columns))
    whole = [*(F.col(c) for c in docs.columns), nulls]
    hashes = [F.xxhash64(*whole), F.xxhash64(F.lit(1), *whole)]
    key = F.struct(
        F.isnull(id_col).alias("no_id"),
        F.col(id_col).alias("id"),
        hashes[0].alias("h1"),
        hashes[1].alias("h2"),
    )
    prints = settle(
        docs.select(key.alias("row"), fingerprint(F.col(text_col)).alias("fingerprint")),
        "fingerprints",
    )
    nodes = settle(prints.groupBy("fingerprint").agg(F.min("row").alias("row")), "nodes")
    roots = linked_fingerprints(nodes.select("fingerprint"), distance, blocks)
    rooted = nodes.join(roots, "fingerprint")
    chosen = settle(
        rooted.groupBy("root").agg(F.min("row").alias("row")).select("row"), "chosen-rows"
    )
    names = [free_name(docs, name) for name in ("chosen_id", "chosen_h1", "chosen_h2")]
    keys = chosen.select("row.id", "row.h1", "row.h2").toDF(*names)
    own = [F.col(id_col).eqNullSafe(F.col(names[0]))]
    own += [h == F.col(name) for h, name in zip(hashes, names[1:])]
    left = docs.join(keys, own).drop(*names)
    # Only rows equal throughout share a key: the texts need to meet only if there are any.
    if prints.join(chosen, "row").count() == chosen.count():
        return left
    return left.distinct()


def linked_fingerprints(nodes: DataFrame, distance: int = 4, blocks: int = 6) -> DataFrame:
    """(fingerprint, root) of every distinct ``fingerprint``: root is the same for two
    fingerprints if links lead from one to the other.

    The 64 bits are cut into ``blocks`` blocks. Two fingerprints within ``distance``
    agree on at least ``blocks - distance`` of them, so each choice of that many blocks
    is a key; more blocks make longer keys and more of them. Large groups would give
    all their pairs when joined on these keys. So rows next to each other in the order
    of a key are linked first, and the join then looks only for links between different
    components: what is left over, but none of it missed.
    """
    bands = _bands(nodes, distance, blocks)
    first = connected_components(_neighbours(bands, distance))
    known = first.select(F.col("node").alias("fingerprint"), "root")
    labelled = settle(
        nodes.join(known, "fingerprint", "left").select(
            "fingerprint", F.coalesce("root", "fingerprint").alias("root")
        ),
        "labelled",
    )
    rows = _bands(labelled, distance, blocks)
    left = rows.select("key", F.col("fingerprint").alias("fa"), F.col("root").alias("a"))
    right = rows.select("key", F.col("fingerprint").alias("fb"), F.col("root").alias("b"))
    close = F.bit_count(F.col("fa").bitwiseXOR(F.col("fb"))) <= distance
    across = left.join(
        right, (left["key"] == right["key"]) & (F.col("a") < F.col("b")) & close
    ).select("a", "b")
    second = connected_components(across).select(
        F.col("node").alias("root"), F.col("root").alias("top")
    )
    return labelled.join(second, "root", "left").select(
        "fingerprint", F.coalesce("top", "root").alias("root")
    )


def _bands(nodes: DataFrame, distance: int, blocks: int) -> DataFrame:
    """``nodes`` once per choice of blocks, with the bits of these as ``key``."""
    if blocks <= distance:
        raise ValueError("more blocks than differing bits are needed")
    edges = [64 * i // blocks for i in range(blocks + 1)]
    widths = [b - a for a, b in zip(edges, edges[1:])]
    parts = [
        F.shiftrightunsigned("fingerprint", start).bitwiseAND(F.lit((1 << width) - 1))
        for start, width in zip(edges, widths)
    ]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - distance)):
        key = F.lit(number).cast("bigint")
        for i in chosen:
            key = F.shiftleft(key, widths[i]).bitwiseOR(parts[i])
        keys.append(key)
    return nodes.select("*", F.explode(F.array(*keys)).alias("key"))


def _neighbours(bands: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) of rows of one key that lie close together when sorted: one for each
    row at most, so there are no more links than rows."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = prints = np.empty(0, np.int64)
        for batch in batches:
            held = len(keys)
            keys = np.concatenate((keys, batch.column("key").to_numpy()))
            prints = np.concatenate((prints, batch.column("fingerprint").to_numpy()))
            near = np.zeros(len(keys), np.int64)
            for step in range(REACH, 0, -1):
                apart = np.bitwise_count((prints[step:] ^ prints[:-step]).view(np.uint64))
                match = (keys[step:] == keys[:-step]) & (apart <= distance)
                near[step:][match] = step
            rows = held + np.flatnonzero(near[held:])
            yield pa.RecordBatch.from_arrays(
                [pa.array(prints[rows]), pa.array(prints[rows - near[rows]])], names=["a", "b"]
            )
            keys, prints = keys[-REACH:], prints[-REACH:]

    ranged = bands.repartitionByRange("key", "fingerprint")
    ordered = ranged.sortWithinPartitions("key", "fingerprint").select("key", "fingerprint")
    return ordered.mapInArrow(link, "a bigint, b bigint").distinct()
