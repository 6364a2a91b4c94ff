"""A trie of the turns that conversations share, built as a burst trie.

Conversations of equal turns are merged first. The others lie in containers: a head, which is
a path of turns, and the sequences that go on from there. A container with too many turns bursts: its head
goes on as far as all its sequences agree, and they part by their next turn into containers below.
What no longer bursts is sorted, container by container, and swept into nodes in one go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import settle

#: Conversation ids whose decimals are joined at once: two to the power of this.
CHUNK_BITS = 12
#: Containers that may burst in one round; their keys are broadcast.
MOST_BURSTS = 1_000_000
#: Fixed value: SHA-256 of nothing.
NOTHING = hashlib.sha256(b"").hexdigest()

NODE = [
    "conv_id",
    "depth",
    "parent_conv_id",
    "n_convs",
    "n_children",
    "n_leaves",
    "saved_tokens",
    "ends_sha256",
]
KEY, PARENT = ["k1", "k2"], ["p1", "p2"]


def rebuilt(
    conversations: DataFrame, family: int = 5, most_shared: int = 9, id_col: str = "conv_id"
) -> DataFrame:
    """(conv_id, turns, sizes) of every conversation, its head taken from its family's first.

    Conversation c begins with the first h turns of conversation c - c % family, or as many as
    there are, and goes on with its own after the first h; h is crc32(decimal c) %
    most_shared. ``turns`` holds two 64-bit hashes for each turn (role, text), one after the other,
    and ``sizes`` the UTF-8 bytes of each text.

    Turns are in the order of ``turn``, null first, those of one number in the order of
    their hashes; a row that repeats is a turn that repeats. A null role or text is empty.
    Rows without a conversation id belong to no conversation and are left out. A conversation is one
    row: its hashes, not its texts, must fit into a task.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turn = F.struct(
        "turn",
        F.xxhash64(role, text).alias("h1"),
        F.xxhash64(F.lit(1), role, text).alias("h2"),
        F.octet_length(text).cast("long").alias("size"),
    )
    known = conversations.filter(F.col(id_col).isNotNull())
    rows = known.select(F.col(id_col).cast("long").alias("conv_id"), turn.alias("turn"))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("own"))
    own = settle(grouped, "conversations")
    firsts = own.filter(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("first"), F.slice("own", 1, most_shared - 1).alias("head")
    )
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most_shared
    joined = own.withColumns(
        {"shared": shared.cast("int"), "first": F.col("conv_id") - F.col("conv_id") % family}
    ).join(firsts, "first", "left")
    tail = F.slice("own", F.col("shared") + 1, F.size("own"))
    head = F.slice("head", F.lit(1), F.col("shared"))
    turns = F.when(F.isnull("head"), tail).otherwise(F.concat(head, tail))
    return joined.select("conv_id", turns.alias("all")).select(
        "conv_id",
        F.flatten(F.transform("all", lambda t: F.array(t.h1, t.h2))).alias("turns"),
        F.transform("all", lambda t: t.size).alias("sizes"),
    )


def prefix_nodes(conversations: DataFrame, container_turns: int = 20_000) -> DataFrame:
    """A row per node of the trie of ``conversations`` (conv_id, turns, sizes), as
    :func:`rebuilt` gives them: conv_id, its smallest member; depth; parent_conv_id, null for the
    root; n_convs; n_children; n_leaves, childless nodes below it, itself included; saved_tokens, over
    its subtree the bytes of each node's last turn times its members but one;
    ends_sha256, of the ids of conversations that end in it, ascending, in decimal and joined
    by commas.

    Containers of over ``container_turns`` turns burst, or of over a millionth of all turns where
    that is more. No conversations give no nodes; conversations without turns end in the root.
    """
    rows = _distinct(settle(conversations, "rebuilt"))
    total = rows.agg(F.sum(_weight())).first()[0] or 0
    limit = max(container_turns, total // MOST_BURSTS)
    done, rounds = [], []
    while True:
        weights = rows.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"), F.sum(_weight()).alias("w"))
        large = weights.filter((F.col("n") > 1) & (F.col("w") > limit)).select(KEY)
        large = settle(large, "large-containers")
        if large.isEmpty():
            break
        done.append(rows.join(F.broadcast(large), KEY, "left_anti"))
        heads, rows = _burst(rows.join(F.broadcast(large), KEY))
        rounds.append(heads)
    swept = settle(_swept(reduce(DataFrame.unionByName, [*done, rows])), "swept-nodes")
    if not rounds:
        return swept.select(NODE)
    return _with_heads(swept, rounds)


def _weight() -> Column:
    return F.size("sizes") + 1


def _pair(*parts: Column | str) -> list[Column]:
    """128 bits that stand for ``parts``."""
    return [F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)]


def _distinct(conversations: DataFrame) -> DataFrame:
    """Each sequence of turns once, in the root's container: its smallest conv_id, the
    number ``n`` of its conversations, and the digest of their ids.

    Ids are joined in chunks of bounded size; the digest runs over a sequence's chunks as
    they come, so that its memory does not grow with the copies.
    """
    s1, s2 = _pair("turns")
    ids = conversations.select(
        "conv_id", s1.alias("s1"), s2.alias("s2"), F.shiftright("conv_id", CHUNK_BITS).alias("chunk")
    )
    decimals = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))
    chunks = ids.groupBy("s1", "s2", "chunk").agg(
        F.array_join(decimals, ",").alias("decimals"),
        F.count(F.lit(1)).alias("n"),
        F.min("conv_id").alias("conv_id"),
    )
    order = ["s1", "s2", "chunk"]
    sorted_chunks = chunks.repartition("s1", "s2").sortWithinPartitions(*order)
    groups = sorted_chunks.mapInArrow(_digests, "member bigint, n bigint, ends string")
    root = {name: F.lit(0).cast("long") for name in KEY} | {
        name: F.lit(None).cast("long") for name in PARENT
    }
    joined = conversations.join(groups, F.col("conv_id") == F.col("member")).drop("member")
    return settle(joined.withColumns({"depth": F.lit(0), **root}), "sequences")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(smallest id, ids, digest) of each run of chunks."""
    key, digest, member, n = None, None, None, 0

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string()]
        arrays = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=["member", "n", "ends"])

    for batch in batches:
        rows = []
        for s1, s2, _, decimals, size, conv_id in zip(*(c.to_pylist() for c in batch.columns)):
            if (s1, s2) != key:
                if key is not None:
                    rows.append((member, n, digest.hexdigest()))
                key, digest, member, n = (s1, s2), hashlib.sha256(), conv_id, 0
            digest.update(("," * (n > 0) + decimals).encode())
            n += size
        if rows:
            yield as_batch(rows)
    if key is not None:
        yield as_batch([(member, n, digest.hexdigest())])


def _burst(inside: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The heads of containers that burst, and their sequences in the containers below.

    A head is a chain of nodes: those at ``depth`` to ``bottom`` have the same members.
    ``bottom`` is how far the first and the last of the sequences in their order agree, and so
    all between them. At most one of them, for they are distinct, ends there.
    """
    spans = inside.groupBy(KEY).agg(
        *[F.first(c).alias(c) for c in (*PARENT, "depth")],
        F.min("conv_id").alias("conv_id"),
        F.sum("n").alias("n_convs"),
        F.min(F.struct("turns", "sizes")).alias("low"),
        F.max("turns").alias("high"),
    )
    agree = F.zip_with("low.turns", "high", lambda a, b: a.eqNullSafe(b))
    bottom = F.floor((F.array_position(agree, False) - 1) / 2).cast("int")
    spans = spans.withColumn("bottom", bottom)
    # The root is without text.
    own = F.slice(
        F.concat(F.array(F.lit(0).cast("long")), "low.sizes"),
        F.col("depth") + 1,
        F.col("bottom") - F.col("depth") + 1,
    )
    heads = settle(spans.withColumn("own_sizes", own).drop("low", "high"), "heads")
    parted = inside.join(F.broadcast(heads.select(*KEY, "bottom")), KEY)
    ending = parted.filter(F.size("sizes") == F.col("bottom")).select(*KEY, "ends")
    following = [F.get("turns", 2 * F.col("bottom") + i) for i in (0, 1)]
    k1, k2 = _pair(*KEY, *following)
    below = parted.filter(F.size("sizes") > F.col("bottom")).select(
        "conv_id",
        "n",
        "ends",
        "turns",
        "sizes",
        (F.col("bottom") + 1).alias("depth"),
        F.col("k1").alias("p1"),
        F.col("k2").alias("p2"),
        k1.alias("k1"),
        k2.alias("k2"),
    )
    return settle(heads.join(ending, KEY, "left"), "heads"), settle(below, "containers")


class _Node:
    """A node whose subtree is being swept; ``waiting`` are its children's rows, which lack its id."""

    __slots__ = ("conv_id", "n", "children", "leaves", "saved", "ends", "size", "waiting")

    def __init__(self, size: int):
        self.conv_id, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends, self.size, self.waiting = NOTHING, size, []


class _Sweep:
    """Nodes of sorted sequences. The nodes on the path of the last one are open; a sequence
    closes those it does not share, the deepest first, and opens its own."""

    def __init__(self):
        self.open: list[_Node] = []
        self.top: tuple = ()
        self.rows: list[tuple] = []
        self.last = np.zeros(0, np.int64)

    def add(self, top: tuple, conv_id: int, n: int, ends: str, turns: np.ndarray, sizes) -> None:
        if top != self.top:
            self.finish()
            self.top, shared = top, top[0] - 1
        else:
            both = min(len(turns), len(self.last))
            apart = np.flatnonzero(turns[:both] != self.last[:both])
            shared = (int(apart[0]) if len(apart) else both) // 2
        self._close(shared)
        for depth in range(max(shared + 1, top[0]), len(turns) // 2 + 1):
            self.open.append(_Node(sizes[depth - 1] if depth else 0))
        leaf = self.open[-1]
        leaf.conv_id, leaf.n, leaf.ends = conv_id, n, ends
        self.last = turns

    def finish(self) -> None:
        if self.top:
            self._close(self.top[0] - 1)

    def _close(self, depth: int) -> None:
        """Close the nodes below ``depth``."""
        first = self.top[0]
        while len(self.open) > max(0, depth + 1 - first):
            node = self.open.pop()
            node.saved += (node.n - 1) * node.size
            node.leaves = node.leaves or 1
            at = first + len(self.open)
            figures = (node.n, node.children, node.leaves, node.saved, node.ends)
            for conv_id, below in node.waiting:
                self.rows.append((conv_id, at + 1, node.conv_id, *below, *[None] * 4))
            if not self.open:
                self.rows.append((node.conv_id, at, None, *figures, *self.top[1:]))
                return
            above = self.open[-1]
            above.conv_id = node.conv_id if above.conv_id is None else min(above.conv_id, node.conv_id)
            above.n += node.n
            above.children += 1
            above.leaves += node.leaves
            above.saved += node.saved
            above.waiting.append((node.conv_id, figures))


def _swept(rows: DataFrame) -> DataFrame:
    """Nodes of all containers. The top of each has the keys of its container and of the
    head above it in place of a parent."""
    names = [*NODE, *KEY, *PARENT]
    kinds = {name: pa.string() if name == "ends_sha256" else pa.int64() for name in names}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep = _Sweep()

        def as_batch() -> pa.RecordBatch:
            columns = zip(*sweep.rows) if sweep.rows else [[] for _ in names]
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds.values())]
            sweep.rows = []
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            turns, sizes = batch.column("turns"), batch.column("sizes")
            ends = [np.asarray(c.offsets) - c.offsets[0].as_py() for c in (turns, sizes)]
            flat = [c.flatten().to_numpy(zero_copy_only=False) for c in (turns, sizes)]
            plain = [batch.column(c).to_pylist() for c in ("depth", *KEY, *PARENT)]
            tops = list(zip(*plain))
            own = zip(*(batch.column(c).to_pylist() for c in ("conv_id", "n", "ends")))
            for i, (conv_id, n, digest) in enumerate(own):
                a, b = (f[e[i] : e[i + 1]] for f, e in zip(flat, ends))
                sweep.add(tops[i], conv_id, n, digest, a.copy(), b.tolist())
                if len(sweep.rows) >= 20_000:
                    yield as_batch()
        sweep.finish()
        yield as_batch()

    order = [*KEY, "turns"]
    placed = rows.repartition(*KEY).sortWithinPartitions(*order)
    schema = ", ".join(f"{n} {'string' if n == 'ends_sha256' else 'bigint'}" for n in names)
    return placed.mapInArrow(run, schema)


def _with_heads(swept: DataFrame, rounds: list[DataFrame]) -> DataFrame:
    """The nodes of containers and of the heads above them.

    What lies below a head is summed from the containers and heads that hang from it, the last
    round first; along its chain only the saved bytes differ.
    """
    tops = swept.filter(F.col("k1").isNotNull())
    sums = ["n_leaves", "saved_tokens"]
    hanging = tops.select(*PARENT, *sums)
    chains = []
    for heads in reversed(rounds):
        below = hanging.groupBy(PARENT).agg(
            F.count(F.lit(1)).alias("n_children"), *[F.sum(c).alias(c) for c in sums]
        )
        below = below.withColumnsRenamed(dict(zip(PARENT, KEY)))
        chains.append(settle(heads.join(below, KEY), "chains"))
        own = F.aggregate("own_sizes", F.lit(0).cast("long"), lambda a, b: a + b)
        whole = F.col("saved_tokens") + (F.col("n_convs") - 1) * own
        hanging = hanging.unionByName(
            chains[-1].select(*PARENT, "n_leaves", whole.alias("saved_tokens"))
        )
    chain = reduce(DataFrame.unionByName, chains)
    above = chain.select(
        *[F.col(k).alias(p) for k, p in zip(KEY, PARENT)], F.col("conv_id").alias("above")
    )
    inner = swept.filter(F.isnull("k1")).select(NODE)
    tops = tops.join(above, PARENT, "left").withColumn("parent_conv_id", F.col("above"))
    steps = chain.join(above, PARENT, "left").select(
        "*", F.posexplode("own_sizes").alias("step", "own_size")
    )
    deeper = Window.partitionBy(KEY).orderBy(F.col("step").desc())
    last = F.col("depth") + F.col("step") == F.col("bottom")
    steps = steps.select(
        "conv_id",
        (F.col("depth") + F.col("step")).cast("long").alias("depth"),
        F.when(F.col("step") > 0, F.col("conv_id")).otherwise(F.col("above")).alias("parent_conv_id"),
        "n_convs",
        F.when(last, F.col("n_children")).otherwise(1).cast("long").alias("n_children"),
        "n_leaves",
        (
            F.col("saved_tokens")
            + F.sum((F.col("n_convs") - 1) * F.col("own_size")).over(deeper)
        ).alias("saved_tokens"),
        F.when(last, F.coalesce("ends", F.lit(NOTHING))).otherwise(NOTHING).alias("ends_sha256"),
    )
    return inner.unionByName(tops.select(NODE)).unionByName(steps)


#: h of a conversation is a crc32, taken bit by bit from its decimal digits.
ORACLE_SQL = """
WITH own AS (
    SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
                         ORDER BY turn NULLS FIRST) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), shared AS (
    SELECT conv_id, turns, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, flatten(list_transform(
            string_split(conv_id::VARCHAR, ''),
            lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda a, x: CASE WHEN x >= 0 THEN xor(a, x)
                          WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT)
                          ELSE a >> 1 END)) % 9 AS h
    FROM own
), rebuilt AS (
    SELECT s.conv_id, list_concat(coalesce(p.turns[1:s.h], []), s.turns[s.h + 1:]) AS turns
    FROM shared s LEFT JOIN own p ON p.conv_id = s.conv_id - s.conv_id % 5
), members AS (
    SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt
), nodes AS (
    SELECT turns[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
                    FILTER (len(turns) = depth), '') AS ends
    FROM members GROUP BY ALL
), families AS (
    SELECT path[1:depth - 1] AS path, depth - 1 AS depth, count(*) AS n_children
    FROM nodes WHERE depth > 0 GROUP BY ALL
), known AS (
    SELECT n.*, coalesce(f.n_children, 0) AS n_children,
           CASE WHEN n.depth = 0 THEN 0
                ELSE (n_convs - 1) * octet_length(encode(n.path[n.depth].t)) END AS saved
    FROM nodes n LEFT JOIN families f ON f.depth = n.depth AND f.path = n.path
), above AS (
    SELECT path[1:up] AS path, up AS depth, count(*) FILTER (n_children = 0) AS n_leaves,
           sum(saved)::BIGINT AS saved_tokens
    FROM (SELECT path, n_children, saved, unnest(range(0, depth + 1)) AS up FROM known)
    GROUP BY ALL
)
SELECT k.conv_id, k.depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, a.n_leaves,
       a.saved_tokens, sha256(k.ends) AS ends_sha256
FROM known k JOIN above a ON a.depth = k.depth AND a.path = k.path
LEFT JOIN nodes p ON p.depth = k.depth - 1 AND p.path = k.path[1:k.depth - 1]
"""
