"""Token files against the tokenizer's own library, and the select structures against lists."""

import zlib
from itertools import accumulate

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventlake.llm import queries, tokenfile
from eventlake.llm.ids import encoder
from eventlake.session import scratch_dir

SF_DIR = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(0, 2**63), max_size=700), st.integers(0, 62))
def test_any_number_of_a_sequence_is_at_hand(numbers, shift):
    values = sorted(n >> shift for n in numbers)
    coded = tokenfile.EliasFano.of(np.array(values, np.uint64))
    read, end = tokenfile.EliasFano.read(memoryview(coded.to_bytes()), 0)
    assert end == len(coded.to_bytes())
    assert read.all().tolist() == values
    assert [read[i] for i in range(len(values))] == values
    for value in values[:5]:
        assert read.up_to(value) == sum(v <= value for v in values)


def test_a_long_sequence_takes_little_space_and_far_gaps_are_crossed():
    values = np.cumsum(np.random.default_rng(0).integers(0, 2600, 100_000))
    values[50_000:] += 10**9
    coded = tokenfile.EliasFano.of(values)
    assert all(coded[i] == values[i] for i in range(0, 100_000, 997))
    steady = tokenfile.EliasFano.of(values[:50_000])
    assert 8 * len(steady.to_bytes()) < 50_000 * (2 + np.log2(values[49_999] / 50_000) + 0.2)


@pytest.mark.parametrize(
    "text",
    [
        "",
        " " * 3_000_000,
        "\n" * 1_000_000 + "a",
        "x" + "\t " * 100_000 + "<|endoftext|>y",
        "a" + " " * 70_000 + "b" + "　" * 70_000,
        "a" * 1_000_000,
        "It's  <|endoftext|>\n",
    ],
    ids=range(7),
)
def test_ids_of_odd_texts_are_the_librarys(library, text):
    assert encoder(PATH)(text).tolist() == library.encode(text, add_special_tokens=False).ids


def expected(library, rows):
    """Rows in ascending order of ids, those without one first."""
    found, start = [], 0
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        found.append((doc_id, start, len(ids), crc))
        start += len(ids)
    return found


def test_the_query_equals_the_library(spark, library):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    found = sorted(map(tuple, queries.op12_tokenfile(spark, SF_DIR).collect()))
    assert found == expected(library, sorted(map(tuple, rows)))


def test_files_of_odd_rows(spark, library):
    rows = [(3, "b"), (None, "x y"), (3, "a"), (-5, None), (7, ""), (3, "b"), (2**62, "long " * 500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("span", F.lit("s"))
    folder = scratch_dir(spark, "token-files")
    tokenfile.write(docs.repartition(3), folder, PATH, file_ids=8)
    read = sorted(tokenfile.documents(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in read] == [None, -5, 3, 3, 3, 7, 2**62]
    assert [r.start for r in read] == [0, *accumulate(r.n_tokens for r in read)][:-1]
    by_text = {}
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        by_text.setdefault(doc_id, []).append(ids)
    for r in read:
        assert np.frombuffer(r.ids, "<u4").tolist() in by_text[r.doc_id]
    threes = sorted(np.frombuffer(r.ids, "<u4").tolist() for r in read if r.doc_id == 3)
    assert threes == sorted(by_text[3])
    files = tokenfile.files(spark, folder).orderBy("start").collect()
    assert len(files) == 2
    for row in files:
        file = tokenfile.TokenFile.read(row.content)
        assert (len(file), len(file.ids)) == (row.n_docs, row.n_ids)
        inside = [r for r in read if row.start <= r.start < row.start + row.n_ids]
        for i, r in enumerate(inside):
            assert (file.doc_id(i), file.start(i) + row.start) == (r.doc_id, r.start)
            assert file.tokens(i).astype("<u4").tobytes() == bytes(r.ids)
            assert {file.doc_at(p) for p in (file.start(i), file.ends[i] - 1)} == {i}


def test_no_rows_give_no_rows(spark):
    folder = scratch_dir(spark, "token-files")
    tokenfile.write(spark.createDataFrame([], "doc_id bigint, text string"), folder, PATH)
    assert tokenfile.documents(spark, folder).collect() == []
    with pytest.raises(ValueError):
        tokenfile.TokenFile.read(b"something else" * 10)
