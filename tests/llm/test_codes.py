"""Directly addressable codes: exact round trips, random access, and the tokenizer file's own library."""

import random
import zlib

import numpy as np
import pytest
from awkward_rows import awkward
from hypothesis import given, settings, strategies as st

from terraquilt.llm import direct_codes, packing, queries
from terraquilt.llm.direct_codes import DirectCodes
from terraquilt.session import fresh_path


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(queries.tokenizer_path())
    found.encode_special_tokens = True
    return found


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=2000), st.randoms())
def test_codes_give_back_any_id(ids, rng):
    codes = DirectCodes.from_bytes(DirectCodes.encode(np.array(ids, "<u4")).to_bytes())
    assert len(codes) == len(ids)
    assert codes.slice(0, len(ids)).tolist() == ids
    places = [rng.randrange(len(ids)) for _ in range(20)] if ids else []
    assert codes.at(np.array(places, np.int64)).tolist() == [ids[p] for p in places]
    a, b = sorted(rng.randrange(len(ids) + 1) for _ in range(2))
    assert codes.slice(a, b).tolist() == ids[a:b]
    for level in codes.levels:
        bits = np.unpackbits(level.words.view(np.uint8), bitorder="little")
        at = np.arange(len(level.chunks) + 1)
        assert (level.rank(at) == np.concatenate([[0], np.cumsum(bits)])[at]).all()


def test_single_ids_read_no_more_than_a_directory_entry_needs():
    ids = np.random.default_rng(1).integers(0, 50_000, 100_000).astype("<u4")
    data = DirectCodes.encode(ids).to_bytes()
    assert len(data) < 2.3 * len(ids)
    codes = DirectCodes.from_bytes(data)
    for level in codes.levels:  # what lies outside the chunk, its word and the eight before it may be anything
        words = np.zeros_like(level.words)
        keep = np.arange(40 * 8, 43 * 8)
        words[keep[keep < len(words)]] = level.words[keep[keep < len(words)]]
        masked = direct_codes.Level(level.chunks, words, level.directory)
        at = np.arange(40 * 512, min(43 * 512, len(level.chunks)))
        assert (masked.rank(at) == level.rank(at)).all()
    with pytest.raises(ValueError):
        DirectCodes.from_bytes(b"none of these")
    with pytest.raises(IndexError):
        codes.at(np.array([100_000]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*"ab é漢1'!.\n\t　\xa0\x1c\x85", "  ", "'s", "<|endoftext|>", " the"]), max_size=30).map("".join))
def test_whole_text_ids_are_the_librarys(text):
    from tokenizers import Tokenizer

    global _OURS, _WHOLE
    if "_OURS" not in globals():
        _OURS, _WHOLE = packing.UnitTokenizer(queries.tokenizer_path()), Tokenizer.from_file(queries.tokenizer_path())
        _WHOLE.encode_special_tokens = True
    assert _OURS.encode(text) == _WHOLE.encode(text, add_special_tokens=False).ids


def expected(rows, library):
    out, start = [], 0
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_whole_query_matches_the_library(spark, library, monkeypatch):
    sf_dir = "/root/testdata/sf0.001"
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    want = expected(rows, library)
    for size in (1, 5000, direct_codes.SEGMENT):
        monkeypatch.setattr(direct_codes, "SEGMENT", size)
        got = sorted(tuple(r) for r in queries.QUERIES["op13_direct_token_codes"](spark, sf_dir).collect())
        assert got == want


def test_any_token_of_the_files_by_its_place(spark, library, monkeypatch):
    monkeypatch.setattr(direct_codes, "SEGMENT", 700)
    rng = random.Random(3)
    rows = [(i * 3, " ".join(rng.choice(["the", "ééé", "zq", "漢字", "x1"]) for _ in range(rng.randrange(90)))) for i in range(80)]
    path = fresh_path(spark, "codes")
    direct_codes.write_tokens(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), path, queries.tokenizer_path())
    ids = [x for _, t in rows for x in library.encode(t, add_special_tokens=False).ids + [2]]
    places = [rng.randrange(len(ids)) for _ in range(300)] + [5] * 100 + [0, len(ids) - 1]
    asked = spark.createDataFrame([(p, 1) for p in [*places, -1, len(ids), None]], "place long, codes int")
    got = sorted(tuple(r) for r in direct_codes.tokens_at(spark, path, asked).collect())
    assert got == sorted((p, ids[p]) for p in places)
    whole = {r.doc_id: r.ids for r in direct_codes.read_documents(spark, path, ids=True).collect()}
    assert b"".join(whole[k] for k in sorted(whole)) == np.array(ids, "<u4").tobytes()


def test_awkward_rows_and_a_hot_key(spark, library):
    def written(docs):
        path = fresh_path(spark, "codes")
        direct_codes.write_tokens(docs, path, queries.tokenizer_path())
        return sorted((tuple(r) for r in direct_codes.read_documents(spark, path).collect()), key=lambda r: r[1])

    rows = [(r.doc_id, r.text) for r in awkward(spark).collect()]
    got = written(awkward(spark))
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert got == expected(order, library)  # the only repeated key has equal texts
    assert written(awkward(spark).limit(0)) == []
    hot = [(7, "same words here")] * 300 + [(7, f"other {i}") for i in range(200)] + [(i, "x") for i in range(600) if i != 7]
    got = written(spark.createDataFrame(hot, "doc_id long, text string").repartition(6))
    assert [r[0] for r in got] == sorted(k for k, _ in hot)
    assert [r[1] for r in got] == [sum(r[2] for r in got[:i]) for i in range(len(got))]
    assert sorted(r[3] for r in got) == sorted(r[3] for r in expected(hot, library))
