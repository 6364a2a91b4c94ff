"""Learned and weighed results against plain computations of the same definitions."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from eventlake.llm import html, lines, packing, quality, queries, toxicity

SF = "/root/testdata/sf0.01"


def plain_main(blocks):
    """The paths' ratios, smoothed, fused and cut, by definition and one by one."""
    def plain(b):
        return max(len(b.text) - b.linked, 0)

    def marks(b):
        return sum(c in ".,;:!?…。，；：！？" for c in b.text)

    paths = defaultdict(list)
    for b in blocks:
        paths[b.path].append(b)
    ratios = {
        p: (sum(map(plain, own)) / len(own), sum(map(marks, own)) / len(own)) for p, own in paths.items()
    }
    every = max(sum(map(plain, blocks)), 1)

    def weight_of(path):
        weight = 4.0 if any(label.split(".")[0] in ("article", "main") for label in path) else 1.0
        for i, label in enumerate(path):
            tag, _, names = label.partition(".")
            doubt = html._doubt(names)
            strong = doubt == 2 or tag in ("nav", "header", "footer", "aside", "form", "dialog", "menu")
            inside = sum(plain(b) for b in blocks if b.path[: i + 1] == path[: i + 1])
            weight *= 0.02 ** (1 - inside / every) if strong else 0.5 if doubt else 1.0
        return weight

    weight = {p: weight_of(p) for p in paths}
    fused = []
    for i, b in enumerate(blocks):
        near = [(j, math.exp(-0.5 * (j - i) ** 2)) for j in range(i - 2, i + 3) if 0 <= j < len(blocks)]
        total = sum(w for _, w in near)
        text, mark = (sum(w * ratios[blocks[j].path][k] for j, w in near) / total for k in (0, 1))
        fused.append(text * (1 + mark) * weight[b.path])
    if not blocks:
        return ""
    mean = sum(fused) / len(fused)
    cut = 0.5 * math.sqrt(sum((f - mean) ** 2 for f in fused) / len(fused))
    chosen = set()
    for p, own in paths.items():
        values = [f for f, b in zip(fused, blocks) if b.path == p]
        text = sum(map(plain, own))
        if sum(values) / len(values) >= cut - 1e-9 and 2 * text >= sum(len(b.text) for b in own):
            chosen.add(p)
    held = Counter()
    for p in chosen:
        held[p[:-1]] += sum(map(plain, paths[p])) * weight[p]
    if not chosen:
        return ""
    home = max(held, key=lambda p: (held[p], p))
    inner = bool(home) and home[-1].split(".")[0] not in ("html", "body")
    at_home = weight_of(home) - 1e-12
    return " ".join(
        b.text
        for b in blocks
        if b.path in chosen or (inner and b.path[: len(home)] == home and weight[b.path] >= at_home)
    )


def test_main_text_of_all_pages_is_that_of_plain_loops(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    found = {r.page_id: r.text for r in queries.op8_html(spark, SF).collect()}
    cut = 0
    for page in pages:
        blocks = html.blocks_of(page.html)
        assert found[page.page_id] == plain_main(blocks)
        cut += found[page.page_id] != " ".join(b.text for b in blocks)
    assert cut > len(pages) / 2


def labelled(spark, label, folds, fold):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = {}
    for r in spark.read.parquet(f"{SF}/labels.parquet").collect():
        if zlib.crc32(str(r.doc_id).encode()) % folds != fold and r[label] is not None and r.doc_id in texts:
            rows[r.doc_id] = max(rows.get(r.doc_id, 0), r[label])
    return texts, rows


def pooled(x, y):
    """Pool adjacent violators: the rising means of y along x, ties of x first put together."""
    blocks = []
    for value in sorted(set(x)):
        own = [b for a, b in zip(x, y) if a == value]
        blocks.append([sum(own) / len(own), len(own), value, value])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            n = a[1] + b[1]
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / n, n, a[2], b[3]])
    return blocks


def test_quality_scores_are_those_of_plain_normal_equations(spark):
    texts, labels = labelled(spark, "quality", 5, 0)
    table = {d: np.array(quality.statistics_of(texts[d])) for d in texts}
    calibrates = {
        d: int.from_bytes(xxhash.xxh64_digest(int(d).to_bytes(8, "little", signed=True), 42), "big") % 4 == 0
        for d in labels
    }
    every = np.array([table[d] for d in labels])
    spread = every.std(axis=0)
    features = quality.Features.draw(every.mean(axis=0), np.where(spread > 1e-9, spread, 1.0), 256, 4.0, 7)
    train = [d for d in labels if not calibrates[d]]
    x = features(np.array([table[d] for d in train]))
    y = np.array([labels[d] for d in train], float)
    weights = np.linalg.solve(x.T @ x + 1e-3 * len(train) * np.eye(257), x.T @ y)
    held = [d for d in labels if calibrates[d]]
    fits = (features(np.array([table[d] for d in held])) @ weights).tolist()
    blocks = pooled(fits, [labels[d] for d in held])
    edges = [e for b in blocks for e in ((b[2], b[0]), (b[3], b[0]))]
    scores = {
        d: float(np.interp(features(table[d][None]) @ weights, *map(list, zip(*edges)))[0]) for d in texts
    }
    found = {r.doc_id: r for r in queries.op9_quality(spark, SF).collect()}
    assert found.keys() == texts.keys()
    apart = [abs(found[d].score - scores[d]) for d in texts]
    assert max(apart) < 1e-4
    for d, row in found.items():
        assert row.held_out == (zlib.crc32(str(d).encode()) % 5 == 0)
        assert row.predicted == int(row.score >= 0.3)


def plain_grams(text):
    words = (text or "").lower().split()
    if not words:
        return set()
    raw = (" " + " ".join(words) + " ").encode()
    found = set()
    for n in (3, 4, 5, 6):
        for i in range(len(raw) - n + 1):
            state = raw[i]
            for b in raw[i + 1 : i + n]:
                state = (state * 0x01000193 + b) % 2**32
            found.add(((state * 0x9E3779B1 + n) % 2**32) >> 12)
    return found


def test_toxicity_weights_are_a_minimum_over_plain_ratios(spark):
    texts, labels = labelled(spark, "toxic", 3, 1)
    short = {d: t for d, t in texts.items() if len(t or "") < 3000}
    labels = {d: y for d, y in labels.items() if d in short}
    docs = spark.createDataFrame(list(short.items()), "doc_id bigint, text string")
    rows = spark.createDataFrame(list(labels.items()), "doc_id bigint, toxic int")
    model = toxicity.fit(docs, rows)
    grams = {d: plain_grams(short[d]) for d in labels}
    toxic, total = sum(labels.values()), len(labels)
    clean = total - toxic
    counts, in_toxic = Counter(), Counter()
    for d, own in grams.items():
        counts.update(own)
        if labels[d]:
            in_toxic.update(own)
    evidence = {}
    for g, n in counts.items():
        share = n / total
        apart = in_toxic[g] / toxic - (n - in_toxic[g]) / clean
        error = math.sqrt(share * (1 - share) * (1 / toxic + 1 / clean) + 1e-12)
        if abs(apart) / error >= 4.0:
            evidence[g] = abs(apart) / error
    chosen = sorted(sorted(evidence, key=lambda g: (-evidence[g], g))[:8192])
    assert set(np.flatnonzero(model.weights)) <= set(chosen) and len(chosen) > 50
    ratio = np.array(
        [math.log((in_toxic[g] + 1) / (toxic + 2) / ((counts[g] - in_toxic[g] + 1) / (clean + 2))) for g in chosen]
    )
    ids = sorted(labels)
    x = np.array([[g in grams[d] for g in chosen] for d in ids]) * ratio
    y = np.array([labels[d] for d in ids])
    beta = model.weights[chosen] / ratio

    def loss(b, c):
        s = x @ b + c
        return np.mean(np.logaddexp(0, s) - y * s) + 1e-3 / 2 * b @ b

    p = 1 / (1 + np.exp(-(x @ beta + model.intercept)))
    gradient = x.T @ (p - y) / len(y) + 1e-3 * beta
    # Convex, and curved by the penalty at least: this bounds how far the minimum lies below.
    assert loss(beta, model.intercept) < 0.1 * math.log(2)
    assert gradient @ gradient / (2 * 1e-3) < 1e-3 and abs(np.mean(p - y)) < 1e-3
    for d in ids[:50]:
        s = model.intercept + sum(model.weights[g] for g in grams[d])
        assert model.score(short[d]) == pytest.approx(1 / (1 + math.exp(-s)), abs=1e-5)


def test_white_space_of_any_length_is_packed(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [" " * 3_000_000, "\n" * 1_000_000 + "x", "a" + "\t" * 200_000, None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    pieces = packing.pack(docs, path).collect()
    library = Tokenizer.from_file(path)
    for i, text in enumerate(texts):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        own = sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start)
        assert sum(p.length for p in own) == own[0].doc_tokens == len(ids)
        for p in own:
            part = np.array(ids[p.start : p.start + p.length], "<u4")
            assert p.ids_crc32 == zlib.crc32(part.tobytes())


def test_many_lines_of_one_text_take_linear_time(spark):
    import time

    text = "\n".join(f"this is line {i % 60_000} of one long text" for i in range(100_000))
    docs = spark.createDataFrame([(1, text), (2, "short")], "doc_id bigint, text string")
    started = time.perf_counter()
    left = lines.without_repeated_lines(docs, max_edits=0, short_repeats=True).filter("doc_id = 1").first()
    assert left.n_lines == 100_000 and left.n_removed == 40_000
    assert len(left.text.split("\n")) == 60_000
    assert time.perf_counter() - started < 60


@pytest.mark.parametrize("name", ["op2_toxicity", "op9_quality"])
def test_queries_of_empty_tables(spark, tmp_path, name):
    for table in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).collect() == []
    spark.read.parquet(f"{SF}/documents.parquet").limit(3).write.mode("overwrite").parquet(
        f"{tmp_path}/documents.parquet"
    )
    assert [r.score for r in queries.QUERIES[name](spark, str(tmp_path)).collect()] == [0.5] * 3


def test_many_rows_without_an_id_are_numbered_in_parts(spark):
    from eventlake.llm.common import with_units

    rows = [(None, f"text {i % 3000}") for i in range(4000)] + [(i, f"t{i}") for i in range(50)] + [(7, "more")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = with_units(docs, "unit")
    assert found.count() == len(rows)
    units = {(r.doc_id, r.text): r.unit for r in found.collect()}
    assert len(set(units.values())) == len(units) == 3051
    assert max(u for (d, _), u in units.items() if d is not None) < min(units[None, f"text {i}"] for i in range(3000))
    by_hash = {r.text: r.h for r in docs.selectExpr("text", "xxhash64(text) AS h").collect()}
    own = sorted((u, by_hash[t]) for (d, t), u in units.items() if d is None)
    assert [h for _, h in own] == sorted(h for _, h in own)


def test_the_pipeline_of_empty_tables(spark, tmp_path):
    import corpus_pipeline

    for table in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
