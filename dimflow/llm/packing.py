"""Order-preserving packing of documents into sequences of bounded length.

The documents of one input partition, in their order, are one stream of ids.
Windows of at most ``length`` ids are cut from it at document ends, sentence ends,
or, truncating a sentence, where a window that began at such an end is full.  A
dynamic programme over these places finds the cuts with the least sum of padding
and penalties:

    cost(j) = penalty(j) + min over i of cost(i) + padding(j - i)

Padding is ``length - (j - i)``, so the least ``cost(i) + i`` of a sliding range
is wanted, which a monotone queue yields in constant time; a window whose length
is a power of two is not padded, and the ``i`` at each such distance are looked at
one by one.

Nothing is shuffled: a partition packs itself, and only its last sequence can be
short.  The stream is solved in blocks; the last window of a block is opened
again with the next one, so memory does not grow with the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.tokens import Encoder, slices

SCHEMA = (
    "key bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, ids binary"
)
FIELDS = pa.schema(
    [(name, pa.int64()) for name in "key start length doc_tokens sequence_id offset".split()]
    + [("ids", pa.binary())]
)
BLOCK = 1 << 18  # ids that are solved together
DOCUMENT_CUT, SENTENCE_CUT, TRUNCATION = 0, 2, 12  # penalties, in ids of padding
WINDOW = 32  # of every window, so that padding is not saved by many short ones


def padding(n: int, length: int) -> int:
    return 0 if n & (n - 1) == 0 else length - n


def unpadded(places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of indexes (end, begin) of the windows shorter than ``length`` that need
    no padding, by end."""
    index = np.full(int(places[-1]) + 1, -1, np.int32)
    index[places] = np.arange(len(places))
    ends, begins = [], []
    for n in range(1, length):
        if padding(n, length) == 0:
            first = np.searchsorted(places, n)
            found = index[places[first:] - n]
            hit = np.flatnonzero(found >= 0)
            ends.append(hit + first)
            begins.append(found[hit])
    end, begin = np.concatenate(ends), np.concatenate(begins)
    order = np.argsort(end, kind="stable")
    return end[order], begin[order]


def best_cuts(places: np.ndarray, penalties: np.ndarray, length: int) -> list[int]:
    """Indexes into ``places`` of the best window ends.  ``places`` rise from 0
    in steps of at most ``length``; the last is always a cut."""
    ends, begins = unpadded(places, length)
    first = np.searchsorted(ends, np.arange(len(places) + 1)).tolist()
    begins = begins.tolist()
    at, penalty = places.tolist(), (penalties + WINDOW).tolist()
    n = len(at)
    cost, back, key = [0] * n, [0] * n, [0] * n
    queue, head = [0], 0  # indexes with rising cost + place, from ``head`` on
    for j in range(1, n):
        here = at[j]
        low = here - length
        while at[queue[head]] < low:
            head += 1
        i = queue[head]
        best = key[i] + length - here
        for k in begins[first[j] : first[j + 1]]:
            if cost[k] < best:
                best, i = cost[k], k
        best += penalty[j]
        cost[j], back[j] = best, i
        mine = key[j] = best + here
        while len(queue) > head and key[queue[-1]] >= mine:
            queue.pop()
        queue.append(j)
    cuts, j = [], len(at) - 1
    while j:
        cuts.append(j)
        j = back[j]
    return cuts[::-1]


def places_of(ends: np.ndarray, is_sentence: np.ndarray, length: int):
    """Places where a block may be cut, with their penalties.

    ``ends`` are the document ends, ``is_sentence`` says of each id whether a
    sentence ends after it.  A sentence may be truncated ``length`` ids after
    any of these, and every ``length`` ids where it is longer than that.
    """
    total = len(is_sentence)
    kind = np.full(total + 1, -1, np.int64)
    kind[np.flatnonzero(is_sentence) + 1] = SENTENCE_CUT
    kind[ends] = DOCUMENT_CUT
    kind[0] = 0
    kind[total] = max(kind[total], 0)
    places = np.flatnonzero(kind >= 0)
    full = [places + length]
    wide = np.flatnonzero(np.diff(places) > length)
    full += [np.arange(places[w] + length, places[w + 1], length) for w in wide]
    extra = np.concatenate(full)
    extra = extra[extra < total]
    kind[extra[kind[extra] < 0]] = TRUNCATION
    places = np.flatnonzero(kind >= 0)
    return places, kind[places]


class Packer:
    """Packs one stream of documents; holds at most a block and what is added at once.

    Places are those of the stream: ``begin`` is the first id that is not packed yet.
    """

    def __init__(self, length: int, sentence_end: np.ndarray, first_sequence: int):
        self.length, self.sentence_end, self.sequence = length, sentence_end, first_sequence
        self.begin = 0
        self.ids = np.zeros(0, np.uint32)
        # the documents that are not packed whole
        self.keys, self.starts, self.sizes = pa.array([], pa.int64()), np.zeros(0, int), np.zeros(0, int)

    def add(self, keys: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Documents with their ids, one after the other."""
        end = self.begin + len(self.ids)
        self.keys = pa.concat_arrays([self.keys, keys])
        self.starts = np.concatenate([self.starts, end + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, ids])
        while len(self.ids) >= BLOCK:
            yield self.cut(BLOCK)

    def finish(self) -> Iterator[pa.RecordBatch]:
        if len(self.ids):
            yield self.cut(len(self.ids))

    def cut(self, n: int) -> pa.RecordBatch:
        """Pieces of the windows of the next ``n`` ids; the last window is left to be
        cut again, unless the stream ends with it."""
        ends = self.starts + self.sizes - self.begin
        places, penalties = places_of(ends[ends <= n], self.sentence_end[self.ids[:n]], self.length)
        cuts = places[best_cuts(places, penalties, self.length)]
        if n == BLOCK:  # the next block may go on with the last window
            cuts = cuts[:-1]
        done = int(cuts[-1])
        bounds = np.unique(np.concatenate([[0], cuts, ends[ends < done]]))
        first, last = bounds[:-1], bounds[1:]
        doc = np.searchsorted(ends, first, side="right")
        window = np.searchsorted(cuts, first, side="right")
        begins = np.concatenate([[0], cuts])
        raw = pa.py_buffer(self.ids[:done].astype("<u4"))
        offsets = pa.py_buffer((4 * bounds).astype(np.int32))
        out = pa.RecordBatch.from_arrays(
            [
                self.keys.take(pa.array(doc)),
                pa.array(self.begin + first - self.starts[doc]),
                pa.array(last - first),
                pa.array(self.sizes[doc]),
                pa.array(self.sequence + window),
                pa.array(first - begins[window]),
                pa.Array.from_buffers(pa.binary(), len(first), [None, offsets, raw]),
            ],
            schema=FIELDS,
        )
        gone = int(np.searchsorted(ends, done, side="right"))
        self.keys = self.keys.slice(gone)
        self.starts, self.sizes = self.starts[gone:], self.sizes[gone:]
        self.ids = self.ids[done:]
        self.begin += done
        self.sequence += len(cuts)
        return out


def sentence_ends(encoder: Encoder) -> np.ndarray:
    """For each id, whether its text ends a sentence or a line."""
    ends = np.zeros(max(encoder.size, 1 << 16), bool)
    for text, at in encoder.tokenizer.get_vocab().items():
        plain = text.removesuffix("</w>")
        ends[at] = plain.endswith((".", "!", "?", "Ċ"))
    return ends


def pack(
    docs: DataFrame, tokenizer: str, length: int = 1024, end_id: int = 0,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Pieces of the packed documents: one row per piece with its ids.

    ``tokenizer`` is a vocabulary file that every executor has.  The ids of a
    document are those of its whole text and then ``end_id``; a null or empty
    text gives ``end_id`` alone.  Documents keep the order of the rows of their
    partition; repeated rows and null keys are documents of their own.  Other
    columns are ignored.  An empty table gives no pieces.  ``sequence_id`` is
    unique over all partitions: the partition in the high bits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        packer = Packer(length, sentence_ends(encoder), TaskContext.get().partitionId() << 36)
        for batch in batches:
            for part in slices(batch, "text"):
                flat, counts = encoder.encode(part.column("text"))
                ids = np.insert(flat.astype(np.uint32), np.cumsum(counts), end_id)
                yield from packer.add(part.column("key"), ids, counts + 1)
        yield from packer.finish()

    chosen = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, SCHEMA)

