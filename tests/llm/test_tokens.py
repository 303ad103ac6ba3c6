"""Packing, BPE and token files against the tokenizers library."""

import gc
import weakref
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dimflow.llm import bpe, packing, token_files
from dimflow.llm.queries import BYTE_BPE, WORD_BPE
from dimflow.llm.storage import new_folder
from dimflow.llm.tokens import Encoder

BYTE, WORD = Tokenizer.from_file(BYTE_BPE), Tokenizer.from_file(WORD_BPE)
ENCODERS = {BYTE_BPE: (Encoder(BYTE_BPE), BYTE), WORD_BPE: (Encoder(WORD_BPE), WORD)}
OWN = bpe.WordBpe(WORD_BPE)


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def split(flat, counts):
    ends = np.cumsum(counts)
    return [flat[e - n : e].tolist() for e, n in zip(ends, counts, strict=True)]


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abT é.,'s\n\t \x1f\xa0½日"), max_size=30), max_size=6))
def test_batches_encode_as_the_library_does(path, texts):
    encoder, tokenizer = ENCODERS[path]
    flat, counts = encoder.encode(pa.array([*texts, None], pa.string()))
    assert split(flat, counts) == [ids(tokenizer, t) for t in [*texts, None]]


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_an_encoder_goes_with_its_last_user(path):
    """A worker that runs many tasks does not hold the encoders of those that ended."""
    gc.collect()
    gc.disable()
    try:
        encoder = Encoder(path)
        encoder.encode(pa.array(["a word", "日本", None], pa.string()))
        held = weakref.ref(encoder), weakref.ref(encoder.pieces)
        del encoder
        assert [x() for x in held] == [None, None]
    finally:
        gc.enable()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=5))
def test_own_bpe_equals_the_library(texts):
    flat, counts = OWN.encode(pa.array(texts, pa.string()))
    want = [ids(WORD, t) for t in texts]
    assert split(flat, counts) == want
    decoded = bpe.Decoder(OWN.names).decode(flat, counts)
    assert [d.decode() for d in decoded] == [WORD.decode(w, skip_special_tokens=False) for w in want]


def test_stale_entries_are_skipped():
    text = "aaaaaaaaaaaaabababababab thththththth"
    assert split(*OWN.encode(pa.array([text])))[0] == ids(WORD, text)


def test_encode_and_decode(make_docs, odd_texts):
    docs = make_docs(odd_texts).withColumn("ids", F.lit("clash")).withColumn("key", F.lit(1))
    found = bpe.encode_and_decode(docs, WORD_BPE).collect()
    assert len(found) == len(odd_texts)
    for row in found:
        want = ids(WORD, odd_texts[row["key"]])
        assert np.frombuffer(row["ids"], "<u4").tolist() == want and row["n_tokens"] == len(want)
        assert row["decoded"] == WORD.decode(want, skip_special_tokens=False)


def test_packing_places_every_id_once(make_docs, odd_texts):
    docs = make_docs(odd_texts).withColumn("start", F.lit("clash"))
    rows = packing.pack(docs, BYTE_BPE, length=64, end_id=0).collect()
    own = {}
    sequences = {}
    for row in rows:
        own.setdefault(row["key"], []).append(row)
        sequences.setdefault(row["sequence_id"], []).append(row)
    assert set(own) == set(range(len(odd_texts)))
    for key, pieces in own.items():
        pieces.sort(key=lambda r: r["start"])
        whole = [i for p in pieces for i in np.frombuffer(p["ids"], "<u4").tolist()]
        assert whole == [*ids(BYTE, odd_texts[key]), 0]
        assert all(p["doc_tokens"] == len(whole) for p in pieces)
        assert [p["start"] for p in pieces] == np.cumsum([0] + [p["length"] for p in pieces])[:-1].tolist()
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r["offset"])
        sizes = [p["length"] for p in pieces]
        assert sum(sizes) <= 64 and min(sizes) > 0
        assert [p["offset"] for p in pieces] == np.cumsum([0, *sizes])[:-1].tolist()


def test_pieces_keep_the_order_of_documents(spark):
    docs = spark.range(200).select("id", F.lit("some words. and more.").alias("t")).coalesce(1)
    rows = packing.pack(docs, BYTE_BPE, length=32, key="id", text="t").collect()
    at = sorted(rows, key=lambda r: (r["sequence_id"], r["offset"]))
    assert [(r["key"], r["start"]) for r in at] == sorted((r["key"], r["start"]) for r in rows)


def brute_cuts(places, penalties, length):
    """Least cost of window ends by trying every window."""
    best = {0: 0}
    for j in range(1, len(places)):
        options = []
        for i in range(j):
            n = places[j] - places[i]
            if i in best and n <= length:
                options.append(best[i] + packing.padding(n, length))
        best[j] = min(options) + penalties[j] + packing.WINDOW
    return best[len(places) - 1]


def test_only_powers_of_two_are_free():
    assert [n for n in range(1, 17) if packing.padding(n, 16) == 0] == [1, 2, 4, 8, 16]
    assert packing.padding(9, 16) == 7 and packing.padding(12, 12) == 0


def test_blocks_and_parts_do_not_matter_to_the_pieces(monkeypatch):
    """Documents longer than a block, and many in one, come out whole and in order."""
    monkeypatch.setattr(packing, "BLOCK", 64)
    rng = np.random.default_rng(3)
    sizes = np.concatenate([rng.integers(1, 9, 60), [500], rng.integers(1, 40, 20), [1, 1, 64, 128]])
    ids = rng.integers(0, 50, int(sizes.sum())).astype(np.uint32)
    packer = packing.Packer(16, np.arange(50) < 5, 7)
    out, at, part = [], 0, 5
    for a in range(0, len(sizes), part):
        some = sizes[a : a + part]
        out += packer.add(pa.array(range(a, a + len(some)), pa.int64()), ids[at : at + some.sum()], some)
        at += int(some.sum())
    out += packer.finish()
    rows = pa.Table.from_batches(out).to_pylist()
    assert b"".join(r["ids"] for r in rows) == ids.astype("<u4").tobytes()
    assert all(r["doc_tokens"] == sizes[r["key"]] and len(r["ids"]) == 4 * r["length"] for r in rows)
    starts, ends = {}, {}
    for r in rows:
        assert r["start"] == starts.get(r["key"], 0) and r["offset"] == ends.get(r["sequence_id"], 0)
        starts[r["key"]] = r["start"] + r["length"]
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert [starts[k] for k in range(len(sizes))] == sizes.tolist()
    assert sorted(ends) == list(range(7, 7 + len(ends))) and max(ends.values()) <= 16


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 16), st.integers(0, 20)), min_size=1, max_size=40))
def test_cuts_are_the_best(steps):
    places = np.cumsum([0] + [s for s, _ in steps])
    penalties = np.array([0] + [p for _, p in steps])
    cuts = packing.best_cuts(places, penalties, 16)
    cost, begin = 0, 0
    for j in cuts:
        n = int(places[j] - places[begin])
        assert n <= 16
        cost += packing.padding(n, 16) + int(penalties[j]) + packing.WINDOW
        begin = j
    assert cost == brute_cuts(places.tolist(), penalties.tolist(), 16)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1)))
def test_variable_length_code_round_trip(values):
    control, data = token_files.encode_block(np.array(values, np.uint32))
    assert token_files.decode_block(control, data, len(values)).tolist() == values
    assert len(control) == -(-len(values) // 4)


def test_token_files(spark, make_docs, odd_texts):
    docs = make_docs(odd_texts).withColumn("n", F.lit("clash"))
    folder = new_folder(spark)
    token_files.write_token_files(docs, folder, WORD_BPE, end_id=2)
    start = 0
    rows = sorted(token_files.read_token_files(spark, folder).collect())
    assert len(rows) == len(odd_texts)
    for row in rows:
        want = np.array([*ids(WORD, odd_texts[row["key"]]), 2], "<u4").tobytes()
        assert (row["start"], row["n_tokens"]) == (start, len(want) // 4)
        assert zlib.crc32(row["ids"]) == zlib.crc32(want)
        start += row["n_tokens"]


def test_ties_and_null_keys_in_token_files(spark, make_docs):
    docs = make_docs(["a b", "c", "c", None], doc_id=[5, 5, 5, None])
    folder = new_folder(spark)
    token_files.write_token_files(docs, folder, WORD_BPE)
    rows = token_files.read_token_files(spark, folder).collect()
    at = sorted((r["start"], r["key"], r["n_tokens"]) for r in rows)
    assert at[0] == (0, None, 1) and [k for _, k, _ in at] == [None, 5, 5, 5]
    # the equal rows follow each other, before or after the other as the hash of ids says
    assert [n for _, _, n in at] in ([1, 3, 2, 2], [1, 2, 2, 3])
    folder = new_folder(spark)
    token_files.write_token_files(docs.repartition(1), folder, WORD_BPE)
    again = token_files.read_token_files(spark, folder).collect()
    assert sorted((r["start"], r["key"], r["n_tokens"]) for r in again) == at


def test_empty_tables(spark, make_docs):
    docs = make_docs([])
    assert packing.pack(docs, BYTE_BPE).count() == 0
    assert bpe.encode_and_decode(docs, WORD_BPE).count() == 0
    folder = new_folder(spark)
    token_files.write_token_files(docs, folder, WORD_BPE)
    assert token_files.read_token_files(spark, folder).count() == 0
