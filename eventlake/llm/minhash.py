"""MinHash fingerprints of documents, and the near-duplicates they find."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import settle, with_units
from eventlake.llm.components import connected_components

PERMUTATIONS = 128
#: Words in a shingle.
SIZE = 5
#: Bits of a minimum that a fingerprint keeps, in hexadecimal digits of four.
DIGITS = 4
#: Shingles hashed at once.
BLOCK = 2048
EMPTY = np.uint64(2**64 - 1)

_random = np.random.default_rng(20)
#: Multiply-and-add hashes of 64 bits, of which the upper half counts.
FACTORS = _random.integers(1, 2**63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _random.integers(0, 2**63, PERMUTATIONS, np.uint64)


def shingle_hashes(text: str | None, size: int = SIZE) -> np.ndarray:
    """64-bit hashes of the word shingles of a text, lower-cased; repeats are included.
    Fewer words than ``size`` are one shingle, and a text without words has none."""
    words = (text or "").lower().encode("utf-8", "replace").split()
    if not words:
        return np.empty(0, np.uint64)
    hash_of = xxhash.xxh3_64_intdigest
    one = np.fromiter(map(hash_of, words), np.uint64, len(words))
    last = max(len(words) - size, 0) + 1
    total = np.full(last, len(words[:size]), np.uint64)
    for i in range(min(size, len(words))):
        total = (total ^ one[i : i + last]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return total


def signature(hashes: np.ndarray) -> np.ndarray:
    """The minimum of each hash function over a set of shingles, as 32 bits; no shingle
    gives the largest value."""
    least = np.full(PERMUTATIONS, EMPTY)
    for i in range(0, len(hashes), BLOCK):
        values = hashes[i : i + BLOCK, None] * FACTORS + OFFSETS
        np.minimum(least, values.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def fingerprint(minima: np.ndarray) -> str:
    """The lower bits of every minimum, in hexadecimal."""
    return (minima & np.uint32(0xFFFF)).astype(">u2").tobytes().hex()


def likeness(one: str, other: str) -> float:
    """Share of equal minima of two fingerprints: an estimate of the Jaccard similarity
    of their shingles, with a standard error of at most 0.045."""
    a = np.frombuffer(bytes.fromhex(one), ">u2")
    b = np.frombuffer(bytes.fromhex(other), ">u2")
    return float((a == b).mean())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, signature array<bigint>) of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [signature(shingle_hashes(t)).astype(np.int64) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "signature": rows})

    rows = docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS doc_id", f"`{text_col}` AS text")
    return rows.mapInPandas(run, "doc_id bigint, signature array<bigint>")


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as many first characters of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def edit_checks(
    docs: DataFrame, cell_rows: int = 64, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Fingerprints of every row's text, and how like they are to those of its edited text
    and of the next document, in descending order of ids (after the last: the first).

    Returns (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next). Null texts are empty; two texts without words are alike (1.0). Rows
    without an id come last; rows of one id follow each other in the order of their
    texts. The only document follows itself.

    The ids are cut into cells of about ``cell_rows`` rows or more, sixteen for each
    shuffle partition at most: the driver keeps a bound of each. A cell is read in order by one
    task, with the first row of the next cell at its end, so one shuffle brings each text
    to its neighbour, and a task holds two texts at a time.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    count, low, high = rows.agg(F.count(F.lit(1)), F.min("doc_id"), F.max("doc_id")).first()
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = max(1, min(-(-count // cell_rows), 16 * partitions))
    steps = [i / cells for i in range(1, cells)]
    bounds = rows.filter("doc_id IS NOT NULL").agg(
        F.percentile_approx("doc_id", steps or [0.5], 100 * cells).alias("b")
    ).first()["b"] if cells > 1 else []
    bounds = np.array(sorted(set(bounds or ())), np.int64)

    @F.pandas_udf("int")
    def cell_of(ids: pd.Series) -> pd.Series:
        """Cells count up as ids go down; rows without an id are in the last."""
        place = len(bounds) - np.searchsorted(bounds, ids.fillna(0).astype("int64"), "left")
        return pd.Series(np.where(ids.isna(), len(bounds), place)).astype("int32")

    placed = rows.withColumn("cell", cell_of("doc_id"))
    sizes = placed.select("doc_id", "cell").groupBy("cell").agg(F.max("doc_id").alias("first"))
    firsts = {r["cell"]: r["first"] for r in sizes.collect()}
    filled = sorted(firsts)
    # The first row of a filled cell is also read at the end of the filled cell before.
    heads = [(firsts[c], filled[i - 1]) for i, c in enumerate(filled)]
    head_of = {first: cell for first, cell in heads}

    @F.pandas_udf("int")
    def also_in(ids: pd.Series) -> pd.Series:
        own = [head_of.get(None if pd.isna(i) else int(i)) for i in ids]
        return pd.Series(own, dtype="Int32")

    own = placed.select("cell", F.lit(False).alias("ahead"), "doc_id", "text")
    ahead = placed.withColumn("cell", also_in("doc_id")).filter("cell IS NOT NULL")
    ahead = ahead.select("cell", F.lit(True).alias("ahead"), "doc_id", "text")
    order = [F.col("cell"), F.col("ahead"), F.desc_nulls_last("doc_id"), F.col("text")]
    dealt = own.unionByName(ahead).repartition("cell").sortWithinPartitions(*order)
    return dealt.mapInArrow(_compare, RESULT)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of cell, those ahead at the end of their cell."""
    names = [field.split()[0] for field in RESULT.split(", ")]
    types = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
    held = None
    for batch in batches:
        found = []
        for cell, ahead, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            if held is not None and held[0] == cell:
                own_print = fingerprint(signature(shingle_hashes(text)))
                found.append(_compared(held, text, own_print))
            elif not ahead:
                own_print = fingerprint(signature(shingle_hashes(text)))
            # Of several rows ahead only the first follows the cell's last row.
            held = None if ahead else (cell, doc_id, text, own_print)
        columns = zip(*found) if found else [[] for _ in names]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=names
        )


def _compared(held: tuple, following: str, following_print: str) -> tuple:
    _, doc_id, text, own_print = held
    changed = edited(text, following)
    changed_print = fingerprint(signature(shingle_hashes(changed)))
    return (
        doc_id,
        len(text),
        hashlib.sha256(changed.encode("utf-8")).hexdigest(),
        own_print,
        changed_print,
        likeness(own_print, changed_print),
        likeness(own_print, following_print),
    )


def near_duplicates(
    docs: DataFrame,
    similarity: float = 0.8,
    bands: int = 32,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, class_id) of every row: classes are joined by pairs of texts whose
    shingle sets have a Jaccard similarity of ``similarity`` or more, and class_id is the
    smallest id in the class.

    Signatures are cut into ``bands`` bands of equal rows; texts that agree on a band are
    candidates (at 32 bands a pair at 0.8 is missed once in ten million), and the exact
    similarity decides. Equal texts are one node. In each band's bucket all are compared
    with the smallest member first; then pairs of the bucket are compared only where
    they are not yet in one class, so a large group of copies never gives all its pairs.
    Null and empty texts form one class.
    """
    rows = with_units(docs.select(F.col(id_col), F.col(text_col)), "unit", id_col, text_col)
    texts = rows.select(
        F.col(id_col).cast("long").alias("doc_id"),
        "unit",
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    nodes = settle(
        texts.groupBy(F.sha2("text", 256).alias("digest")).agg(F.min("unit").alias("node")), "nodes"
    )
    members = settle(
        texts.select("doc_id", "unit", F.sha2("text", 256).alias("digest")).join(nodes, "digest"),
        "members",
    )
    one_each = settle(
        texts.join(nodes.select(F.col("node").alias("unit")), "unit", "left_semi")
        .dropDuplicates(["unit"])
        .select("unit", "text"),
        "texts",
    )
    signed = fingerprints(one_each, "unit")
    width = PERMUTATIONS // bands
    keys = [
        F.xxhash64(F.lit(i), F.slice("signature", i * width + 1, width)) for i in range(bands)
    ]
    buckets = settle(signed.select(F.col("doc_id").alias("node"), F.explode(F.array(*keys)).alias("key")), "buckets")
    smallest = buckets.groupBy("key").agg(F.min("node").alias("b"))
    first = buckets.join(smallest, "key").select(F.col("node").alias("a"), "b")
    roots = connected_components(_verified(first, one_each, similarity))
    roots = roots.select(F.col("node").alias("known"), "root")
    rooted = settle(
        buckets.join(roots, F.col("node") == F.col("known"), "left").select(
            "key", "node", F.coalesce("root", "node").alias("root")
        ),
        "rooted",
    )
    other = rooted.select(
        F.col("key").alias("other_key"), F.col("node").alias("b"), F.col("root").alias("other_root")
    )
    across = rooted.join(
        other, (F.col("key") == F.col("other_key")) & (F.col("root") < F.col("other_root"))
    ).select(F.col("node").alias("a"), "b")
    found = _verified(first.unionByName(across), one_each, similarity)
    tops = connected_components(found).select(F.col("node").alias("known"), "root")
    classed = members.join(tops, F.col("node") == F.col("known"), "left").select(
        "doc_id", F.coalesce("root", "node").alias("root")
    )
    smallest_ids = classed.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return classed.join(smallest_ids, "root").select("doc_id", "class_id")


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough."""
    pairs = pairs.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()
    left = texts.select(F.col("unit").alias("a"), F.col("text").alias("one"))
    right = texts.select(F.col("unit").alias("b"), F.col("text").alias("other"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            similar = [jaccard(x, y) >= similarity for x, y in zip(batch["one"], batch["other"])]
            yield batch.loc[similar, ["a", "b"]]

    return pairs.join(left, "a").join(right, "b").mapInPandas(compare, "a bigint, b bigint")


def jaccard(one: str | None, other: str | None) -> float:
    """Exact similarity of the shingle sets of two texts; 1.0 if neither has any."""
    a, b = np.unique(shingle_hashes(one)), np.unique(shingle_hashes(other))
    common = len(np.intersect1d(a, b, assume_unique=True))
    either = len(a) + len(b) - common
    return common / either if either else 1.0
