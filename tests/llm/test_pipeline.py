"""The pipeline, each stage against plain Python on its own input."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from eventlake.llm import simhash

SF = "/root/testdata/sf0.001"
ODD = [(9001, None, None, None, None), (9002, "", "en", "s", 0), (None, "no id", "en", "s", 5)]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output rows, written and read like the driver does."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame(ODD, docs.schema))
    found = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{i}")
        after = spark.read.parquet(f"{folder}/{i}")
        found[name] = (docs.collect(), after.collect(), after.columns)
        docs = after
    return found


def test_all_but_the_last_return_documents(stages):
    for before, after, columns in list(stages.values())[:-1]:
        assert columns == corpus_pipeline.COLUMNS
        assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before}
        assert all(r["n_chars"] == len(r["text"]) for r in after if r["text"] and r["n_chars"])


def test_the_classifier_only_takes_documents_out(stages):
    before, after, _ = stages["quality classifier"]
    assert set(map(repr, after)) <= set(map(repr, before)) and 0 < len(after) <= len(before)


def test_repeated_lines_go_and_documents_stay(stages):
    before, after, _ = stages["line dedup"]
    assert len(before) == len(after)
    long_lines = [x for r in after for x in (r["text"] or "").split("\n") if len(x) >= 20]
    assert len(long_lines) == len(set(long_lines))


def test_one_document_of_each_group_stays(stages):
    before, after, _ = stages["simhash near-dedup"]
    prints = {r["doc_id"]: simhash.fingerprint_of(r["text"]) for r in before}
    roots = {i: i for i in prints}
    for i in sorted(prints, key=lambda x: (x is None, x)):
        for j in prints:
            if roots[i] != roots[j] and (prints[i] ^ prints[j]).bit_count() <= 4:
                low, high = sorted((roots[i], roots[j]), key=lambda x: (x is None, x or 0))
                roots = {k: low if v == high else v for k, v in roots.items()}
    assert sorted(map(repr, set(roots.values()))) == sorted(repr(r["doc_id"]) for r in after)


def test_ids_do_not_decide_what_near_dedup_keeps(spark):
    """Rows without an id, and of a shared one, stay or go by their own group."""
    def text(seed, last="end"):
        return " ".join(f"w{seed}x{j}" for j in range(300)) + " " + last

    rows = [(None, text(1), None, "s", 1), (None, text(2), "s", None, 1), (None, text(3), "en", "s", 1)]
    rows += [(7, text(4), "en", "s", 1), (7, text(5), "en", "s", 1)]
    rows += [(3, text(6), "en", "s", 1), (9, text(6), "en", "s", 1), (9, text(7), "en", "s", 1)]
    rows += [(None, text(7, "fin"), "en", "s", 1), (None, text(6), "en", "s", 1)]
    rows += [(11, text(8), "en", "s", 1)] * 3 + [(12, text(9), "en", "a", 1), (12, text(9), "en", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    left = corpus_pipeline.simhash_dedup(spark, docs.repartition(3), SF).collect()
    wanted = [rows[i][:2] for i in (0, 1, 2, 3, 4, 5, 7, 10, 13)]
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in left))) == sorted(map(repr, wanted))


def test_no_string_of_100_bytes_stays_twice_unless_joined(stages):
    before, after, _ = stages["suffix-array dedup"]
    seen = set()
    kept = {}
    for r in sorted(before, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)):
        raw = (r["text"] or "").encode()
        covered = bytearray(len(raw))
        for p in range(len(raw) - 99):
            string = raw[p : p + 100]
            if string in seen:
                covered[p : p + 100] = b"\1" * 100
            seen.add(string)
        own = bytes(b for b, c in zip(raw, covered) if not c)
        kept[r["doc_id"]] = own.decode("utf-8", "ignore")
    assert {r["doc_id"]: r["text"] for r in after} == kept


def test_every_token_is_packed_once(stages):
    before, after, _ = stages["packing"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = {}
    for p in after:
        pieces.setdefault(p["doc_id"], []).append(p)
    assert len(pieces) == len(before)
    for r in before:
        ids = [*library.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        at = 0
        for p in sorted(pieces[r["doc_id"]], key=lambda p: p["start"]):
            own = np.array(ids[at : at + p["length"]], "<u4")
            assert (p["start"], p["ids_crc32"]) == (at, zlib.crc32(own.tobytes()))
            at += p["length"]
        assert at == len(ids) == pieces[r["doc_id"]][0]["doc_tokens"]


def test_run_packs_every_document_the_stages_keep(spark, stages):
    docs = {r["doc_id"] for r in stages["packing"][0]} - {i for i, *_ in ODD}
    assert docs <= {r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect()}
