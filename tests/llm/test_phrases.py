"""Mined phrases against plain counting and SQL."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventlake.llm import phrases, queries

SCHEMA = "doc_id bigint, text string, lang string"


def all_phrases(rows):
    """Counts by language and phrase, of up to four words."""
    counts = defaultdict(Counter)
    for _, text, lang in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            counts[lang or "und"][""] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts[lang or "und"][" ".join(words[i : i + k])] += 1
    return counts


def expected(rows, least=30, top=2000):
    found = []
    for lang, f in all_phrases(rows).items():
        n = f.pop("")
        longer = {p: p.split(" ") for p in f if f[p] >= least and " " in p}
        ranked = []
        for phrase, words in longer.items():
            a, k = f[phrase], len(words)
            spans = {
                " ".join(o[i : i + k]): 1
                for other, o in longer.items()
                if len(o) > k and 100 * f[other] >= 80 * a
                for i in range(len(o) - k + 1)
            }
            if phrase in spans:
                continue
            cuts = []
            for cut in range(1, k):
                l, r = f[" ".join(words[:cut])], f[" ".join(words[cut:])]
                cuts.append((2_000_000 * a // (l + r), cut, l, r))
            score, _, l, r = min(cuts)
            ranked.append((-score, -a, phrase.encode(), phrase, l, r))
        for rank, (score, a, _, phrase, l, r) in enumerate(sorted(ranked)[:top], 1):
            found.append((lang, rank, phrase, -a, l, r, n, -score))
    return sorted(found)


def result(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(map(tuple, phrases.collocations(frame, **options).collect()))


def random_rows(seed, n=400, words=12):
    draw = random.Random(seed)
    lexicon = ["the", "of", "New", "new", "york", "é", "ÉTÉ", "x-y", "in", "zu", "a", "b"][:words]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "! "]
    return [
        (i, "".join(draw.choice(lexicon) + draw.choice(gaps) for _ in range(draw.randrange(40))),
         draw.choice(["en", "en", "de", None]))
        for i in range(n)
    ]


@pytest.mark.parametrize("least", [2, 5, 30])
def test_random_texts(spark, least):
    assert result(spark, random_rows(least), least=least) == expected(random_rows(least), least)


def test_what_the_sample_misses_is_found_by_further_passes(spark, monkeypatch):
    """A sample that proposes nothing leaves everything to the border: a pass for each length."""
    passes = []
    bordered = phrases.bordered
    monkeypatch.setattr(phrases, "bordered", lambda *a: passes.append(1) or bordered(*a))
    nothing = [F.lit(0).alias("hash"), F.lit(False).alias("long"), F.lit(0).alias("f")]
    monkeypatch.setattr(phrases, "sampled", lambda texts: texts.select(*nothing))
    rows = random_rows(7)
    assert result(spark, rows, least=5) == expected(rows, 5)
    assert len(passes) == 4


def test_a_full_filter_only_counts_more(spark, monkeypatch):
    full = np.full(1 << phrases.FILTER_BITS - 3, 255, np.uint8)
    monkeypatch.setattr(phrases, "proposals", lambda hashes: full)
    rows = random_rows(8)
    assert result(spark, rows, least=5) == expected(rows, 5)


def test_ranks_are_cut(spark):
    rows = random_rows(9)
    assert result(spark, rows, least=2, top=7) == expected(rows, 2, 7)


@pytest.mark.parametrize("window", [1, 7, 64, 1 << 20])
def test_windows_see_each_phrase_once(monkeypatch, window):
    monkeypatch.setattr(phrases, "WINDOW", window)
    rows = random_rows(3, 40) + [(99, "Long" * 200 + " a b c d e", "en"), (100, " a b\tc d. e f ", "de")]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([r[2] or "und" for r in rows]), pa.array([r[1] for r in rows])], names=["lang", "text"]
    )
    counts = defaultdict(Counter)
    for lang, words in phrases.windows(batch):
        counts[lang][""] += int(words.new(1).sum())
        for k in range(1, 5):
            found, n = words.counted(k, words.new(k))
            for phrase, f in zip(found.to_pylist(), n.tolist()):
                counts[lang][phrase] += f
    assert counts == all_phrases(rows)


def test_odd_rows(spark):
    rows = [(None, None, None), (1, "", "en"), (None, "a b " * 40, "en"), (2, "a b " * 40, "en"),
            (2, "a b " * 40, "en"), (3, " \t\n.,", "x"), (4, "Q" * 200_000 + " z", "und"),
            (5, "one two three\r" * 31, None), (6, "one two three\x0b" * 29, "fr")]
    assert result(spark, rows) == expected(rows)
    frame = spark.createDataFrame(rows, SCHEMA).withColumns(
        {name: F.lit("x") for name in ("phrase", "n", "hash", "k", "f", "rank")}
    )
    assert sorted(map(tuple, phrases.collocations(frame).collect())) == expected(rows)


def test_no_rows_give_no_phrases(spark):
    assert result(spark, []) == []
    assert result(spark, [(1, "alone", "en")]) == []


def test_scores_pass_64_bits(spark):
    f = 10**13
    known = spark.createDataFrame(
        [("en", "a b", 2, f, 0), ("en", "a", 1, 3 * f, 0), ("en", "b", 1, f, 0)],
        "lang string, phrase string, k bigint, f bigint, x int",
    )
    longer = known.filter("k = 2").select(
        "lang", "phrase", "k", F.col("f").alias("a"), F.split("phrase", " ").alias("words")
    )
    row = phrases._scored(longer, known.select("lang", "phrase", "f")).first()
    assert (row.l, row.r, row.score) == (3 * f, f, 500_000)


def test_the_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.01"
    found = sorted(map(tuple, queries.op11_phrases(spark, folder).collect()))
    base = duckdb.connect()
    base.sql(f"CREATE VIEW documents AS FROM '{folder}/documents.parquet'")
    assert found == sorted(base.sql(phrases.ORACLE_SQL).fetchall())
    assert len(found) > 200
