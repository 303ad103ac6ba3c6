"""Token counts against the libraries, with and without stored counts."""

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dimflow.llm import token_counts
from dimflow.llm.queries import BYTE_BPE, QUERIES, WORD_BPE
from dimflow.llm.storage import Stored, new_folder

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def library_counts(path, texts):
    texts = [t or "" for t in texts]
    if path.endswith(".model"):
        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return [len(ids) for ids in pieces.encode(texts, num_threads=1)]
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE, PIECES])
@pytest.mark.parametrize("most", [0, token_counts.BROADCAST_DIGESTS])
def test_counts_equal_the_library(spark, held, make_docs, odd_texts, monkeypatch, path, most):
    monkeypatch.setattr(token_counts, "BROADCAST_DIGESTS", most)
    texts = [*odd_texts, "</s> <unk>", "<|startoftext|> a", "<s>b"]
    docs = make_docs(texts).withColumn("digest", F.lit("clash")).withColumn("n_tokens", F.lit(-1))
    rows = token_counts.count_tokens(docs, path, held.folder(), held, limit=20).collect()
    got = {r["key"]: r for r in rows}
    want = library_counts(path, texts)
    assert len(rows) == len(texts)
    assert [got[i]["n_tokens"] for i in range(len(texts))] == want
    assert [got[i]["over_limit"] for i in range(len(texts))] == [n > 20 for n in want]
    assert [got[i]["n_bytes"] for i in range(len(texts))] == [len((t or "").encode()) for t in texts]


def test_only_distinct_misses_are_encoded(spark, make_docs, monkeypatch):
    cache, encoded = new_folder(spark), []
    encode = token_counts.encode_misses

    def watched(texts, tokenizer):
        rows = sorted(r["text"] for r in texts.collect())
        encoded.append(rows)
        return encode(texts, tokenizer)

    monkeypatch.setattr(token_counts, "encode_misses", watched)

    def run(texts, path=BYTE_BPE):
        with Stored(spark) as held:
            found = token_counts.count_tokens(make_docs(texts), path, cache, held)
            return {r["key"]: (r["n_tokens"], r["cached"]) for r in found.collect()}

    first = run(["one two", "one two", None, "", "three"])
    assert encoded[-1] == ["", "one two", "three"]
    assert first == {0: (2, False), 1: (2, False), 2: (0, False), 3: (0, False), 4: (1, False)}
    second = run(["three", "four four", "one two", "four four"])
    assert encoded[-1] == ["four four"]
    assert second == {0: (1, True), 1: (2, False), 2: (2, True), 3: (2, False)}
    assert run([]) == {} and encoded[-1] == []
    run(["three"], WORD_BPE)  # another tokenizer has counts of its own
    assert encoded[-1] == ["three"]
    stored = spark.read.parquet(cache)
    assert stored.count() == 5
    assert stored.select("tokenizer").distinct().count() == 2
    assert stored.groupBy("tokenizer", "digest").count().filter("count > 1").isEmpty()


def test_counts_appended_twice_count_once(spark, held, make_docs):
    cache = held.folder()
    docs = make_docs(["one two", "three"])
    for _ in range(2):
        token_counts.count_tokens(docs, BYTE_BPE, cache, held).collect()
    spark.read.parquet(cache).write.mode("append").partitionBy("tokenizer").parquet(cache + "x")
    spark.read.parquet(cache + "x").write.mode("append").partitionBy("tokenizer").parquet(cache)
    rows = token_counts.count_tokens(docs, BYTE_BPE, cache, held).collect()
    assert sorted((r["key"], r["n_tokens"], r["cached"]) for r in rows) == [(0, 2, True), (1, 1, True)]


def test_null_and_repeated_keys(spark, held, make_docs):
    docs = make_docs(["a b", "a b", "c"]).withColumn("doc_id", F.lit(None).cast("bigint"))
    rows = token_counts.count_tokens(docs, BYTE_BPE, held.folder(), held).collect()
    assert sorted((r["key"] is None, r["n_tokens"]) for r in rows) == [(True, 1), (True, 2), (True, 2)]


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op13_token_counts"](spark, folder).collect()
    want = dict(zip(docs, library_counts(BYTE_BPE, list(docs.values())), strict=True))
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == want
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in rows)
