"""Operators that compare texts with each other, against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventlake.llm import lines, minhash, quality, rules, simhash, suffixes, toxicity
from eventlake.llm.common import Places, with_units
from eventlake.llm.components import connected_components
from eventlake.llm.labelled import held_out, labelled_sample

SF = "/root/testdata/sf0.001"


def groups_of(nodes, linked):
    """Smallest member of each node's component."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    nodes = list(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", range(3))
def test_connected_components(spark, seed):
    r = random.Random(seed)
    edges = [(r.randint(0, 60), r.randint(0, 60)) for _ in range(45)]
    edges += [(100 + i, 101 + i) for i in range(40)] + [(200, 200 + i) for i in range(30)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    found = {r["node"]: r["root"] for r in connected_components(frame).collect()}
    pairs = {frozenset(e) for e in edges}
    roots = groups_of({n for e in edges for n in e}, lambda a, b: frozenset((a, b)) in pairs)
    assert found == {n: root for n, root in roots.items() if n != root}


def test_components_without_edges(spark):
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


@pytest.mark.parametrize("blocks", [5, 6, 7])
def test_linked_fingerprints(spark, blocks):
    r = random.Random(blocks)
    centres = [r.getrandbits(64) for _ in range(12)]
    prints = set(centres)
    for centre in centres:
        for _ in range(25):
            print_ = centre
            for _ in range(r.randint(1, 6)):
                print_ ^= 1 << r.randrange(64)
            prints.add(print_)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    nodes = spark.createDataFrame([(p,) for p in signed], "fingerprint bigint")
    found = simhash.linked_fingerprints(nodes, 4, blocks).collect()
    roots = groups_of(signed, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 4)
    assert {f["fingerprint"]: f["root"] for f in found}.keys() == roots.keys()
    groups = Counter(frozenset(k for k, v in roots.items() if v == root) for root in roots.values())
    own = {}
    for f in found:
        own.setdefault(f["root"], set()).add(f["fingerprint"])
    assert set(map(frozenset, own.values())) == set(groups)


def near_copies(r, n):
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(1, 7))) for _ in range(120)]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(1, 90))) for _ in range(n)]
    for _ in range(n):
        copy = r.choice(texts).split(" ")
        for _ in range(r.randint(0, 2)):
            copy[r.randrange(len(copy))] = r.choice(words)
        texts.append(" ".join(copy))
    return [*texts, "", None, " \n", "", "ONE", "one"]


def test_simhash_near_duplicates(spark):
    r = random.Random(1)
    texts = near_copies(r, 40)
    ids = r.sample(range(1000), len(texts))
    rows = [*zip(ids, texts), (None, "one"), (ids[0], texts[0])]
    docs = spark.createDataFrame(
        [(*row, 1) for row in rows], "doc_id bigint, text string, fingerprint int"
    )
    found = simhash.near_duplicates(docs).collect()
    prints = {t: simhash.fingerprint_of(t) for _, t in rows}
    roots = groups_of(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 4)
    smallest = {}
    for doc_id, text in rows:
        if doc_id is not None:
            root = roots[prints[text]]
            smallest[root] = min(smallest.get(root, doc_id), doc_id)
    want = [(i, f"{prints[t]:016x}", smallest[roots[prints[t]]]) for i, t in rows]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, want))


def test_simhash_without_ids_or_rows(spark):
    docs = spark.createDataFrame([(None, "x y"), (None, "x y")], "doc_id bigint, text string")
    assert [r["component_id"] for r in simhash.near_duplicates(docs).collect()] == [None, None]
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_minhash_near_duplicates(spark):
    r = random.Random(2)
    texts = near_copies(r, 40)
    rows = [*enumerate(texts), (None, texts[0]), (3, texts[3]), (3, "two texts")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = minhash.near_duplicates(docs).collect()
    distinct = sorted({t or "" for _, t in rows})
    roots = groups_of(distinct, lambda a, b: minhash.jaccard(a, b) >= 0.8)
    smallest = {}
    for doc_id, text in rows:
        if doc_id is not None:
            root = roots[text or ""]
            smallest[root] = min(smallest.get(root, doc_id), doc_id)
    want = [(i, smallest[roots[t or ""]]) for i, t in rows]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, want))


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        following = [i]
        for j, y in enumerate(b, 1):
            following.append(min(row[j] + 1, following[-1] + 1, row[j - 1] + (x != y)))
        row = following
    return row[-1]


def changed(r, text, letters="abé", most=4):
    out = list(text)
    for _ in range(r.randint(0, most)):
        kind, i = r.random(), r.randint(0, len(out))
        if kind < 0.4:
            out.insert(i, r.choice(letters))
        elif out and kind < 0.7:
            out.pop(min(i, len(out) - 1))
        elif out:
            out[min(i, len(out) - 1)] = r.choice(letters)
    return "".join(out)


@pytest.mark.parametrize("most", [0, 1, 2, 3])
def test_edits_within(spark, most):
    r = random.Random(most)
    pairs = []
    for _ in range(250):
        a = "".join(r.choice("abé😀") for _ in range(r.randint(0, 9)))
        pairs.append(tuple(sorted((a, changed(r, a)), key=len)))
    frame = spark.createDataFrame(pairs, "a string, b string")
    near = lines.edits_within(F.col("a"), F.col("b"), most)
    found = frame.select(near.alias("near"), "a", "b").collect()
    assert [x["near"] for x in found] == [edits(x["a"], x["b"]) <= most for x in found]


def line_corpus(r, n):
    base = ["".join(r.choice("abcdefg ") for _ in range(r.randint(4, 14))) for _ in range(25)]
    rows = []
    for i in r.sample(range(500), n):
        own = [changed(r, r.choice(base), "abcdefg", 3) for _ in range(r.randint(0, 5))]
        rows.append((i, "\n".join(own)))
    return rows


def plain_lines(rows, most, least):
    seen, found = [], {}
    for doc_id, text in sorted(rows):
        parts = text.split("\n")
        gone = []
        for n, line in enumerate(parts):
            if len(line) >= least:
                if any(abs(len(x) - len(line)) <= most and edits(line, x) <= most for x in seen):
                    gone.append(n)
                seen.append(line)
        kept = "\n".join(line for n, line in enumerate(parts) if n not in gone)
        found[doc_id] = (len(parts), len(gone), kept)
    return found


@pytest.mark.parametrize("most", [1, 2])
def test_repeated_lines(spark, most):
    rows = line_corpus(random.Random(most), 70)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = lines.without_repeated_lines(docs, most, 6).collect()
    own = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in found}
    assert own == plain_lines(rows, most, 6)


def test_line_links_are_counted(spark):
    rows = [(1, "abcdefghij\nabcdefghij"), (2, "abcdefghix"), (3, "abcdefghxx\nshort")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in lines.without_repeated_lines(docs, 1, 6).collect()}
    assert [found[i]["n_links"] for i in (1, 2, 3)] == [2, 2, 1]
    assert [found[i]["text"] for i in (1, 2, 3)] == ["abcdefghij", "", "short"]


def test_short_lines_go_where_they_repeat(spark):
    rows = [(1, "Home\n\n  \n}\nHome"), (2, "Home\nHone\n\n  \n}"), (3, "\tHome\nHome \nnew\nHone")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in lines.without_repeated_lines(docs, short_repeats=True).collect()}
    wanted = ["Home\n\n  \n}", "Hone\n\n  ", "\tHome\nHome \nnew"]
    assert [found[i]["text"] for i in (1, 2, 3)] == wanted
    assert [(found[i]["n_removed"], found[i]["n_links"]) for i in (1, 2, 3)] == [(1, 0), (2, 0), (1, 0)]


def test_queries_take_short_repeats_out(spark):
    from eventlake.llm import queries

    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    seen, removed = set(), 0
    for r in sorted(docs, key=lambda r: r["doc_id"]):
        for line in (r["text"] or "").split("\n"):
            if len(line) < 20 and line.strip(" \t\x0b\x0c\r"):
                removed += line in seen
                seen.add(line)
    default = lines.without_repeated_lines(spark.read.parquet(f"{SF}/documents.parquet"))
    more = queries.op3_lines(spark, SF).agg(F.sum("n_removed")).first()[0]
    assert removed > 0 and more == default.agg(F.sum("n_removed")).first()[0] + removed


def test_lines_of_odd_tables(spark):
    line = "a line that is long enough to go"
    rows = [(1, None, 1, "a"), (2, "", 2, "b"), (3, line, 3, "c"), (3, line, 4, "d")]
    rows += [(3, "other\n" + line, 5, "e"), (None, line, 6, "f")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, unit int, links string")
    found = {r["unit"]: r for r in lines.without_repeated_lines(docs).collect()}
    assert [found[i]["text"] for i in (1, 2, 6)] == [None, "", ""]
    assert found[3]["text"] == found[4]["text"]
    assert sum(line in found[i]["text"] for i in (3, 5)) == 1
    assert found[1]["n_lines"] == 0 and found[4]["links"] == "d"
    assert lines.without_repeated_lines(docs.limit(0)).collect() == []


def test_lines_run_no_python_on_executors(spark, capsys):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lines.without_repeated_lines(docs).explain()
    rules.judged(docs).explain()
    assert "Python" not in (plan := capsys.readouterr().out) and "Arrow" not in plan


def test_probes_run_in_compiled_code(spark):
    text = F.col("text")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    distinct = docs.select(F.col("doc_id").alias("first"), text.alias("line"), F.length(text).alias("chars"))
    plan = lines._probes(distinct, 2, 20)._jdf.queryExecution().executedPlan().toString()
    assert "*(1) Generate" in plan and "transform(" not in plan


def plain_spans(rows, length=100):
    first, found = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        covered = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            string = raw[p : p + length]
            if string in first:
                covered[p : p + length] = b"\1" * length
            first.add(string)
        kept = bytes(x for x, c in zip(raw, covered) if not c)
        runs = sum(1 for p, c in enumerate(covered) if c and (p == 0 or not covered[p - 1]))
        found[doc_id] = (len(raw), sum(covered), runs, hashlib.sha256(kept).hexdigest())
    return found


def passages(r, n):
    words = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 7))) for _ in range(50)]
    shared = [" ".join(r.choice(words) for _ in range(r.randint(10, 80))) for _ in range(12)]
    rows = [(0, ""), (1, None), (2, "a" * 700), (3, "ab" * 300), (4, "x" * 99), (5, "x" * 100)]
    for i in range(6, n):
        parts = []
        for _ in range(r.randint(1, 5)):
            kind = r.random()
            if kind < 0.5:
                passage = r.choice(shared)
                at = r.randint(0, len(passage))
                parts.append(passage[at : at + r.randint(20, 400)])
            elif kind < 0.6:
                parts.append("a" * r.randint(1, 300))
            elif kind < 0.7:
                parts.append(r.choice(rows)[1] or "")
            else:
                parts.append(" ".join(r.choice(words) for _ in range(r.randint(1, 60))))
        rows.append((i, r.choice([" ", ""]).join(parts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_bytes(spark, seed):
    rows = passages(random.Random(seed), 100)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    found = suffixes.without_repeats(docs).collect()
    own = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found}
    assert own == plain_spans(rows)


def test_anchors_of_blocks(monkeypatch):
    """A text read in blocks gives the strings of its blocks the same anchors."""
    import numpy as np

    raw = np.frombuffer(random.Random(4).randbytes(3000) + b"a" * 500, np.uint8)
    whole = suffixes.anchors_of(raw)
    monkeypatch.setattr(suffixes, "BLOCK", 700)
    parts = suffixes.anchors_of(raw)

    def by_start(table):
        return {s: (a, h) for a, f, z, h in table.tolist() for s in range(f, z + 1)}

    assert by_start(whole) == by_start(parts)
    assert len(by_start(whole)) == len(raw) - 99


def test_bytes_of_odd_tables(spark):
    text = "é" * 80 + "b"
    rows = [(7, text, "x"), (7, text, "y"), (8, text, "z"), (None, text, "n"), (9, None, "o")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    found = {r["spans"]: r for r in suffixes.without_repeats(docs).collect()}
    one = plain_spans([(7, text), (8, text)])
    for name, i in (("x", 7), ("y", 7), ("z", 8), ("n", 8)):
        assert (found[name]["n_removed"], found[name]["kept_sha256"]) == (one[i][1], one[i][3])
    assert (found["o"]["n_bytes"], found["o"]["n_spans"]) == (0, 0)
    assert suffixes.without_repeats(docs.limit(0)).collect() == []


def test_units_follow_ids(spark):
    rows = [(5, "a"), (2, "b"), (2, "c"), (None, "d"), (2, "b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = with_units(docs, "unit").collect()
    units = {(r["doc_id"], r["text"]): r["unit"] for r in found}
    assert len(found) == 5 and len(set(units.values())) == 4
    assert max(units[2, "b"], units[2, "c"]) < units[5, "a"] < units[None, "d"]


def test_places_are_wide_enough(spark):
    wide = spark.createDataFrame([(-(2**62), "x" * 99), (2**62, "y")], "unit bigint, text string")
    places = Places.of(wide, "unit")
    assert places.kind == "decimal(38,0)"
    got = wide.select(places.at(F.col("unit"), F.lit(3)).alias("p")).orderBy("p").collect()
    assert [int(r["p"]) for r in got] == [3, 2**63 * 100 + 3]


def plain_counts(text):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text or "") if w]
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {
        i + d
        for i, window in enumerate(zip(words, words[1:], words[2:]))
        if windows[window] > 1
        for d in range(3)
    }
    full = [x for x in (text or "").split("\n") if x.strip("\x20\x09\x0a\x0b\x0c\x0d")]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return (len(words), sum(map(len, words)), symbols, len(full) - len(set(full)), len(covered))


def test_rules_count_whole_texts(spark):
    texts = [None, "", " \n\t", "a b", "a a a", "x#y | <z>\n\nx#y | <z>\n x", "é ü\x0bü é\x85b"]
    texts += ["a b c a b c d", "w " * 60, " ".join(f"word{i}" for i in range(80))]
    rows = [(i, t, None if i % 2 else "en", "s") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    found = {r["doc_id"]: r for r in rules.judged(docs).collect()}
    for i, text in enumerate(texts):
        counts = plain_counts(text)
        assert tuple(found[i])[1:6] == counts
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        assert found[i]["base_failed"] == failed
        assert not (failed and found[i]["kept"])
    assert found[9]["kept"]
    assert rules.judged(docs.limit(0)).collect() == []


def test_rules_follow_their_group(spark):
    """A share of symbols that is usual in one source is too much in another."""
    def text(symbols, i):
        return " ".join(f"w{i}x{j}" + "#" * (j < symbols) for j in range(60))

    rows = [(i, text(40, i), "en", "code") for i in range(120)]
    rows += [(1000 + i, text(0, i), "en", "prose") for i in range(120)]
    rows += [(2000, text(40, 1), "en", "prose"), (2001, text(40, 1), "en", "rare")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in rules.judged(docs).collect()}
    assert all(kept[i] for i in range(120)) and all(kept[1000 + i] for i in range(120))
    assert not kept[2000] and kept[2001]


@pytest.mark.parametrize(
    "fit, label, folds, fold, least",
    [(quality.fit, "quality", 5, 0, 0.95), (toxicity.fit, "toxic", 3, 1, 0.9)],
)
def test_held_out_accuracy(spark, fit, label, folds, fold, least):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = fit(docs, labels)
    scored = docs.join(labels, "doc_id").filter(held_out(F.col("doc_id"), folds, fold))
    rows = scored.select(F.col(label).alias("y"), model.column(F.col("text")).alias("s")).collect()
    assert all(0 <= r["s"] <= 1 for r in rows)
    positive = sorted(r["s"] for r in rows if r["y"] == 1)
    negative = sorted(r["s"] for r in rows if r["y"] == 0)
    above = sum((p > n) + 0.5 * (p == n) for p in positive for n in negative)
    assert above / (len(positive) * len(negative)) > least


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_classifiers_without_classes(spark, module, label):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)], "doc_id bigint, text string")
    scores = []
    for value in (None, 0, 1):
        labels = spark.createDataFrame(
            [(i, value) for i in range(40)], f"doc_id bigint, {label} int"
        )
        model = module.fit(docs, labels)
        found = docs.select(model.column(F.col("text")).alias("s")).distinct().collect()
        scores.append([round(r["s"], 6) for r in found])
    assert scores == [[0.5], [0.0], [1.0]]


def test_odd_texts_are_scored(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    odd = spark.createDataFrame([(None,), ("",), (" ",), ("x" * 100_000,)], "text string")
    for module in (quality, toxicity):
        scored = odd.select(module.fit(docs, labels).column(F.col("text")).alias("s")).collect()
        assert all(0 <= r["s"] <= 1 for r in scored) and len(scored) == 4
        assert scored[0] == scored[1]


def test_sample_is_bounded_and_outside_the_fold(spark):
    rows = [(i, i % 2) for i in range(300)] + [(4, 1), (6, None), (None, 1), (8, 7)]
    labels = spark.createDataFrame(rows, "doc_id bigint, quality int")
    sample = labelled_sample(labels, "quality", 5, 0, 1000)
    found = {r["sample_id"]: r["label"] for r in sample.collect()}
    import zlib

    assert set(found) == {i for i in range(300) if zlib.crc32(str(i).encode()) % 5 != 0}
    assert found.get(4, 1) == 1
    assert labelled_sample(labels, "quality", 5, 0, 10).count() == 10
