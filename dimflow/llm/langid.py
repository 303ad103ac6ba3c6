"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to three bytes.  A byte costs
``-log2(count / (total + distinct))`` in its longest context; a byte not seen
there costs the escape ``-log2(distinct / (total + distinct))`` and is looked up
in the context that is one byte shorter, down to a uniform choice of 256.  The
statistics are frozen after training, so the cost of a byte depends on the four
bytes that end with it alone, and the code length of a text is a sum of table
lookups, done for all bytes of a batch at once.

How well a text fits its language is told by its bits per byte against those that
texts of the language took which the trees had not seen: part of the sample is scored
by trees of the other part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.llm.tokens import slices

ORDER = 3
SAMPLE_DOCUMENTS = 1000  # labelled texts per language that the trees are fitted on
SAMPLE_BYTES = 32768  # longer texts are taken only where there are too few others
SAMPLE_TOTAL = 32 << 20  # bytes per language after which no further text is taken
CALIBRATED = 5  # one in so many texts of the sample is scored by trees of the others
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
HASH_RANGE = 1 << 40
STEP = 1 << 20  # bytes that are scored at a time


class Lookup:
    """Row of each known 32-bit key in a table, or -1: open addressing."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(len(keys) * 4 - 1).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint32)
        self.rows = np.full(1 << self.bits, -1, np.int32)
        left = np.arange(len(keys))
        slot = self._slot(keys)
        while len(left):
            free = self.rows[slot[left]] < 0
            taken, first = np.unique(slot[left[free]], return_index=True)
            placed = left[free][first]
            self.rows[taken], self.keys[taken] = placed, keys[placed]
            left = np.setdiff1d(left, placed, assume_unique=True)
            slot[left] = (slot[left] + 1) & (len(self.rows) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint32(2654435769)) >> np.uint32(32 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        rows = self.rows[slot]
        left = np.flatnonzero((self.keys[slot] != keys) & (rows >= 0))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & (len(self.rows) - 1)
            rows[left] = self.rows[slot]
            wrong = (self.keys[slot] != keys[left]) & (rows[left] >= 0)
            left, slot = left[wrong], slot[wrong]
        return rows


def low_bytes(windows: np.ndarray, n: int) -> np.ndarray:
    return windows & np.uint32((1 << 8 * n) - 1)


@dataclass
class Level:
    """Windows of ``order + 1`` bytes with their cost, contexts with their escape."""

    windows: Lookup
    cost: np.ndarray  # per window and language, in bits
    contexts: Lookup
    escape: np.ndarray


class Model:
    """Frozen context trees of several languages."""

    def __init__(self, languages: list[str], counts: dict[int, tuple]):
        """``counts``: for each order, window, language and times as arrays."""
        self.languages = languages
        self.rates = np.full(len(languages), 8.0)  # expected bits per byte
        self.levels: list[Level] = []
        for order in range(ORDER + 1):
            window, language, times = counts[order]
            keys, row = np.unique(window.astype(np.uint32), return_inverse=True)
            seen = np.zeros((len(keys), len(languages)))
            np.add.at(seen, (row, language), times)
            parents, parent = np.unique(keys >> np.uint32(8), return_inverse=True)
            total = np.zeros((len(parents), len(languages)))
            distinct = np.zeros_like(total)
            np.add.at(total, parent, seen)
            np.add.at(distinct, parent, seen > 0)
            known = total > 0
            size = np.where(known, total + distinct, 1)
            escape = np.where(known, -np.log2(np.where(known, distinct, 1) / size), 0)
            below = self.cost(keys, order - 1)
            own = -np.log2(np.where(seen > 0, seen, 1) / size[parent])
            cost = np.where(seen > 0, own, escape[parent] + below)
            self.levels.append(Level(Lookup(keys), cost, Lookup(parents), escape))

    def cost(self, windows: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Bits of the last byte of each window after the bytes before it."""
        if order < 0:
            return np.full((len(windows), len(self.languages)), 8.0)
        level = self.levels[order]
        windows = low_bytes(windows, order + 1)
        row = level.windows(windows)
        out = level.cost[row]
        missing = np.flatnonzero(row < 0)
        if len(missing):
            windows = windows[missing]
            parent = level.contexts(windows >> np.uint32(8))
            escape = np.where(parent[:, None] >= 0, level.escape[parent], 0)
            out[missing] = escape + self.cost(windows, order - 1)
        return out

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text in each language."""
        out = np.zeros((len(texts), len(self.languages)))
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        filled = np.flatnonzero(sizes)
        if not len(filled):
            return out
        windows = text_windows([texts[i] for i in filled])
        starts = np.cumsum(sizes[filled]) - sizes[filled]
        ends = starts + sizes[filled]
        for a in range(0, len(windows), STEP):
            z = min(a + STEP, len(windows))
            first, last = np.searchsorted(ends, [a, z - 1], side="right")
            within = slice(first, last + 1)
            begin = np.maximum(starts[within] - a, 0)
            out[filled[within]] += np.add.reduceat(self.cost(windows[a:z]), begin, axis=0)
        return out


def text_windows(texts: list[bytes]) -> np.ndarray:
    """For each byte of all texts, it and the three bytes before it as a number;
    spaces stand before the start of a text."""
    pad = b" " * ORDER
    whole = np.frombuffer(pad + pad.join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    places = np.arange(sizes.sum()) + np.repeat(np.arange(1, len(texts) + 1) * ORDER, sizes)
    last = whole.astype(np.uint32)
    value = last.copy()
    for k in range(1, ORDER + 1):
        value[k:] |= last[:-k] << np.uint32(8 * k)
    return value[places]


def share_of(n: int) -> int:
    """The place of a hash up to which ample texts of ``n`` are taken."""
    return int(min(1.0, 4 * SAMPLE_DOCUMENTS / max(n, 1)) * HASH_RANGE)


def sample_per_language(labelled: DataFrame) -> DataFrame:
    """The first ``SAMPLE_DOCUMENTS`` distinct texts of each language by hash, or all
    where there are fewer; texts over ``SAMPLE_BYTES`` come after the others, and none
    is taken after ``SAMPLE_TOTAL`` bytes.

    The hashes alone are made distinct and counted; the driver gets two counts per
    language.  Texts far from the front by their hash are then dropped before any
    shuffle, as are copies within a task.
    """
    hashed = labelled.withColumns(
        {
            "hash": F.xxhash64("text"),
            "size": F.octet_length("text").cast("bigint"),
            "long": F.octet_length("text") > SAMPLE_BYTES,
        }
    ).withColumn("at", F.pmod("hash", F.lit(HASH_RANGE)))
    sizes = (
        hashed.select("lang", "hash", "long")
        .distinct()
        .groupBy("lang")
        .agg(F.count_if(~F.col("long")).alias("n_short"), F.count_if("long").alias("n_long"))
    )

    shares = {
        r["lang"]: [share_of(r["n_short"]), share_of(r["n_long"]) if r["n_short"] < SAMPLE_DOCUMENTS else -1]
        for r in sizes.collect()
    }
    entries = [x for lang, pair in shares.items() for x in (F.lit(lang), F.array(*map(F.lit, pair)))]
    of_lang = F.create_map(*entries).cast("map<string,array<bigint>>")
    front = F.get(F.try_element_at(of_lang, F.col("lang")), F.col("long").cast("int"))
    near = hashed.filter(F.col("at") <= front)
    near = near.select("text", "lang", "hash", "long", "at", "size")

    def drop_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in batches:
            keys = zip(batch.column("lang").to_pylist(), batch.column("hash").to_pylist(), strict=True)
            new = [i for i, k in enumerate(keys) if not (k in seen or seen.add(k))]
            yield batch.take(pa.array(new, pa.int64()))

    distinct = near.mapInArrow(drop_copies, near.schema).dropDuplicates(["lang", "hash"])
    first = Window.partitionBy("lang").orderBy("long", "at", "hash")
    ranked = distinct.withColumn("rank", F.row_number().over(first)).filter(
        F.col("rank") <= SAMPLE_DOCUMENTS
    )
    before = F.sum("size").over(first.rowsBetween(Window.unboundedPreceding, -1))
    return ranked.withColumn("before", F.coalesce(before, F.lit(0))).filter(
        F.col("before") <= SAMPLE_TOTAL
    )


def train(labelled: DataFrame, text: str, lang: str) -> Model:
    """Context trees of the languages in column ``lang``.

    Rows without language or text are left out.  The driver receives one row per
    context window and language of the sample, which the limits of that bound for
    each language; there must be few enough languages for their trees to fit a task.
    """
    chosen = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter(
        F.col("lang").isNotNull() & (F.octet_length("text") > 0)
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            groups = list(zip(batch.column("lang").to_pylist(), batch.column("held").to_pylist(), strict=True))
            for group in sorted(set(groups)):
                windows = text_windows([t for t, x in zip(texts, groups, strict=True) if x == group])
                values, times = np.unique(windows, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([group[0]] * len(values), pa.string()),
                        pa.array([group[1]] * len(values), pa.bool_()),
                        pa.array(values.astype(np.int64)),
                        pa.array(times.astype(np.int64)),
                    ],
                    names=["lang", "held", "win", "n"],
                )

    found = (
        sample_per_language(chosen)
        .select("text", "lang", (F.col("rank") % CALIBRATED == 0).alias("held"))
        .mapInArrow(count, "lang string, held boolean, win bigint, n bigint")
        .groupBy("lang", "held", "win")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    names, language = np.unique(
        np.array(found.column("lang").to_pylist(), dtype=object), return_inverse=True
    )
    window = np.asarray(found.column("win")).astype(np.uint32)
    times = np.asarray(found.column("n"))
    held = np.asarray(found.column("held")).astype(bool)
    model = fitted(list(names), window, language, times)
    if held.any() and not held.all():
        seen = fitted(list(names), window[~held], language[~held], times[~held])
    else:
        seen, held = model, np.ones(len(window), bool)
    for i in range(len(names)):
        mine = held & (language == i)
        scorer = seen
        if not mine.any():  # too few texts to keep one back
            mine, scorer = language == i, model
        bits = scorer.cost(window[mine])[:, i]
        model.rates[i] = (bits * times[mine]).sum() / times[mine].sum()
    return model


def fitted(names: list[str], window: np.ndarray, language: np.ndarray, times: np.ndarray) -> Model:
    return Model(names, {k: (low_bytes(window, k + 1), language, times) for k in range(ORDER + 1)})


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Language of each whole text and a score from 0 to 1: the share of the language
    in the posterior of all, taken as equally likely, times the bits per byte that its
    texts are expected to take over those that this text takes, at most 1.  Text of
    another language or script, or of no language, takes many more bits.

    A null text, one without a letter, and any text where nothing was learned,
    get ``und`` and 0.  Among languages of equal code length the first by name
    wins.  Each row gives a row; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                names, scores = classify(model, part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=["key", "lang_pred", "score"],
                )

    chosen = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = T.StructType(
        [
            chosen.schema["key"],
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    return chosen.mapInArrow(run, schema)


def classify(model: Model, texts: list[str | None]) -> tuple[list[str], list[float]]:
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    spoken = [i for i, t in enumerate(texts) if t and LETTER.search(t)]
    if model.languages and spoken:
        raw = [texts[i].encode() for i in spoken]
        bits = model.bits(raw)
        best = bits.argmin(axis=1)
        least = bits.min(axis=1)
        share = 1 / np.exp2(np.minimum(least[:, None] - bits, 0)).sum(axis=1)
        rate = np.maximum(least / np.fromiter(map(len, raw), float, len(raw)), 1e-9)
        score = share * np.minimum(model.rates[best] / rate, 1)
        for i, b, s in zip(spoken, best.tolist(), score.tolist(), strict=True):
            names[i], scores[i] = model.languages[b], s
    return names, scores


def held_out(key: str) -> Column:
    """Whether a document is kept from training: a fifth, by its number as text."""
    digits = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.crc32(digits.cast("binary")) % 5 == 0
