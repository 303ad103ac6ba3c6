import random

import pytest
from pyspark.sql import types as T

from dimflow.llm.storage import Stored

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def held(spark):
    with Stored(spark) as stored:
        yield stored


@pytest.fixture
def make_docs(spark):
    def make(texts, **columns):
        rows = []
        for i, text in enumerate(texts):
            own = {k: v[i] for k, v in columns.items()}
            row = {"doc_id": i, "text": text, "lang": "en", "source": "h", "n_chars": len(text or "")}
            rows.append(tuple({**row, **own}.values()))
        return spark.createDataFrame(rows, DOCUMENTS).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empties, white space, repeated rows, long texts and rare letters."""
    rng = random.Random(7)
    letters = [*"abcdeAB é.,\n  '12", "ß", "\t", "日本", "🙂", "\x1f", "\xa0", "Σ", "İ", "́", "<|endoftext|>"]
    mixed = ["".join(rng.choice(letters) for _ in range(rng.randrange(120))) for _ in range(60)]
    long = " ".join(rng.choice(["the", "of", "and", "thing", "over."]) for _ in range(30_000))
    return [None, "", " ", "\n\n", "a", "a", *mixed, *mixed[:5], long, "  lead", "trail  ", "x" * 5000]
