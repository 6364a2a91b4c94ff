"""The trie of conversations against plain Python and SQL."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from eventlake.llm import queries, trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def rebuilt(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    shared = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return {c: [*own.get(c - c % 5, [])[: shared[c]], *own[c][shared[c] :]] for c in own}


def expected(rows):
    members = defaultdict(list)
    whole = rebuilt(rows)
    for conv_id, turns in sorted(whole.items()):
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv_id)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    found = {}
    for path in sorted(members, key=len, reverse=True):
        own = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        below = [found[c] for c in children[path]]
        ends = ",".join(str(c) for c in members[path] if len(whole[c]) == len(path))
        found[path] = (
            members[path][0],
            len(path),
            members[path[:-1]][0] if path else None,
            len(members[path]),
            len(below),
            sum(b[5] for b in below) or 1,
            sum(b[6] for b in below) + own,
            hashlib.sha256(ends.encode()).hexdigest(),
        )
    return sorted(found.values(), key=str)


def random_rows(seed, conversations=120, turns=9, kinds=2):
    """Few kinds of turns, so that many paths are shared, and whole conversations too."""
    draw = random.Random(seed)
    rows = []
    for _ in range(conversations):
        conv_id = draw.randrange(-50, 8000)
        kept = [(draw.choice("ua"), "é" * draw.randrange(kinds)) for _ in range(draw.randrange(turns))]
        rows += [(conv_id, i, *turn) for i, turn in enumerate(kept)]
    seen = {}
    return [r for r in rows if seen.setdefault(r[:2], r) is r]


def result(spark, rows, container_turns):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    nodes = trie.prefix_nodes(trie.rebuilt(frame), container_turns)
    return sorted(map(tuple, nodes.select(trie.NODE).collect()), key=str)


@pytest.mark.parametrize("container_turns", [1, 40, 10_000])
def test_random_conversations(spark, container_turns):
    rows = random_rows(container_turns)
    assert result(spark, rows, container_turns) == expected(rows)


def test_long_shared_heads_take_one_burst_each(spark, monkeypatch):
    """Near copies that agree for 300 turns, prefixes of one another, and exact copies."""
    rows = [(5 * c, t, "u", f"t{t}" if t < 300 else f"{c} {t}") for c in range(12) for t in range(303)]
    rows += [(1000 + 5 * c, t, "u", f"t{t}") for c in range(4) for t in range(297 + c)]
    rows += [(50_000 + 5 * c, t, "u", "same") for c in range(3000) for t in range(2)]
    bursts = []
    burst = trie._burst
    monkeypatch.setattr(trie, "_burst", lambda inside: bursts.append(1) or burst(inside))
    assert result(spark, rows, 700) == expected(rows)
    assert 2 < len(bursts) < 8


def test_odd_rows(spark):
    rows = [
        (0, None, "u", "first"),
        (0, 0, None, None),
        (0, 0, "", ""),
        (1, 3, "u", "late"),
        (1, 3, "u", "late"),
        (7, 0, "a", None),
        (None, 0, "u", "nobody's"),
        (-7, 1, "u", "x"),
        (2**62, 0, "u", "far"),
        (10, 0, "ab", "c"),
        (15, 0, "a", "bc"),
    ]
    assert result(spark, rows, 10_000) == expected(rows)
    assert result(spark, rows, 1) == expected(rows)


def test_no_conversations_have_no_nodes(spark):
    assert result(spark, [], 10) == []
    assert result(spark, [(None, 1, "u", "x")], 10) == []


def test_other_columns_do_not_clash(spark):
    rows = random_rows(5, 30)
    frame = spark.createDataFrame(rows, SCHEMA).withColumns(
        {name: F.lit("x") for name in ("own", "turns", "sizes", "n", "depth", "k1", "first", "h1")}
    )
    nodes = trie.prefix_nodes(trie.rebuilt(frame)).select(trie.NODE).collect()
    assert sorted(map(tuple, nodes), key=str) == expected(rows)


def test_the_query_equals_its_sql_and_plain_python(spark):
    folder = "/root/testdata/sf0.01"
    found = sorted(map(tuple, queries.op13_trie(spark, folder).select(trie.NODE).collect()), key=str)
    base = duckdb.connect()
    base.sql(f"CREATE VIEW conversations AS FROM '{folder}/conversations.parquet'")
    assert found == sorted(base.sql(trie.ORACLE_SQL).fetchall(), key=str)
    rows = spark.read.parquet(f"{folder}/conversations.parquet").collect()
    assert found == expected([(r.conv_id, r.turn, r.role, r.text) for r in rows])
