"""The pipeline on planted documents."""

import random

import corpus_pipeline as pipeline
from dimflow.llm.queries import BYTE_BPE
from tokenizers import Tokenizer

WORDS = [a + b for a in ("ka", "lo", "mi", "ner", "tu", "sha") for b in ("ren", "dal", "vis", "po", "gat")]


JUNK = ["#$%&*^@|~q", "абвгдежзик", "0123456789ABCDEF"]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)) + "."


def planted():
    rng = random.Random(11)
    clean = [prose(rng, 120) for _ in range(40)]
    passage = prose(rng, 70)
    texts = [*clean, *clean[:5]]  # copies
    texts += [c.replace(c.split()[60], "changed", 1) for c in clean[5:8]]  # near copies
    texts += [f"{prose(rng, 80)}\n{passage}\n{prose(rng, 80)}" for _ in range(4)]
    texts += [None, "", "too short", "123 456 " * 60, "same word again " * 60]
    texts += [" ".join("".join(rng.choice(letters) for _ in range(6)) for _ in range(70)) for letters in JUNK]
    return texts, passage


def test_stages_in_order(spark, make_docs):
    names = [name for name, _ in pipeline.STAGES]
    assert names == [
        "quality rules", "language id", "simhash near-dedup", "suffix-array dedup", "packing",
    ]
    texts, passage = planted()
    first_junk = len(texts) - len(JUNK)
    docs = make_docs(texts, lang=["en"] * first_junk + [None] * len(JUNK))
    kept = []
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append({r["doc_id"]: r for r in docs.collect()})
        assert docs.count() == len(kept[-1])
    assert {*kept[0]} == {*range(52), *range(first_junk, len(texts))}
    assert {*kept[1]} == {*range(52)}
    assert {*range(40)} <= {*kept[2]} and not {*range(40, 45)} & {*kept[2]}
    assert {*kept[3]} == {*kept[2]}
    with_passage = [i for i in kept[3] if 48 <= i < 52]
    assert with_passage and all(passage not in kept[3][i]["text"] for i in with_passage)
    assert all(kept[3][i]["text"] == texts[i] for i in range(8, 40))
    assert all(r["n_chars"] == len(r["text"]) for r in kept[3].values())
    pieces = pipeline.STAGES[-1][1](spark, docs, "").collect()
    encoder = Tokenizer.from_file(BYTE_BPE)
    for i, row in kept[3].items():
        ids = len(encoder.encode(row["text"], add_special_tokens=False).ids) + 1
        assert sum(p["length"] for p in pieces if p["doc_id"] == i) == ids


def test_empty_and_odd_tables(spark, make_docs, odd_texts):
    """Of nulls, empties, junk and repeated rows the two prose texts are left, each once."""
    rng = random.Random(12)
    first, second = prose(rng, 120), prose(rng, 4000)
    texts = [*odd_texts, first, first, second]
    ids = [None, 1, 1] + [2] * (len(odd_texts) - 3) + [None, None, 7]
    for rows, want in (([], []), (texts, [(None, first), (7, second)])):
        docs = make_docs(rows, **({"doc_id": ids} if rows else {}))
        for _, stage in pipeline.STAGES[:-1]:
            docs = stage(spark, docs, "")
        left = [(r["doc_id"], r["text"]) for r in docs.collect()]
        assert sorted(left, key=str) == sorted(want, key=str)
        pieces = pipeline.STAGES[-1][1](spark, docs, "").collect()
        assert sum(p["length"] for p in pieces) == sum(len(encoder_ids(t)) + 1 for _, t in want)


def encoder_ids(text):
    return Tokenizer.from_file(BYTE_BPE).encode(text or "", add_special_tokens=False).ids
