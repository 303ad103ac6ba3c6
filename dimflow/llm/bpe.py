"""BPE encoding and decoding by a vocabulary file.

A piece of text becomes a doubly linked list of symbols.  A priority queue holds
(rank of the merge, place of the left symbol, right symbol's place, both ids) for
each adjacent pair that can merge.  The lowest rank, leftmost first, is taken;
an entry whose symbols have changed meanwhile is stale and skipped.  A merge
relinks the list and queues the two new pairs.  Decoding puts the strings of the
vocabulary together.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dimflow.llm.tokens import (
    WORD_PIECES,
    Pieces,
    byte_letters,
    gather,
    slices,
)


class WordBpe:
    """Encoder and decoder of a BPE vocabulary that drops white space, lowers
    letters and marks word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            form = json.load(file)
        self._tokenizer = Tokenizer.from_file(path)  # cuts rare texts into pieces
        model = form["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.merges = {}
        for rank, (left, right) in enumerate(model["merges"]):
            pair = (self.ids[left], self.ids[right])
            self.merges[pair] = (rank, self.ids[left + right])
        self.specials = {t["content"]: t["id"] for t in form["added_tokens"]}
        names = {i: s for s, i in self.ids.items()} | {i: s for s, i in self.specials.items()}
        self.names = [names.get(i, "").encode() for i in range(max(names) + 1)]
        self.letters = byte_letters()
        self._special = re.compile("|".join(map(re.escape, self.specials)) or r"\b\B")
        self.pieces = Pieces(
            WORD_PIECES, True, list(self.specials), np.dtype("<u4"), self._piece, self._whole
        )

    def merge(self, symbols: list[int]) -> list[int]:
        """Ids of a piece from the ids of its single symbols."""
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        merges = self.merges
        queue = []
        for i in range(n - 1):
            if found := merges.get((symbols[i], symbols[i + 1])):
                queue.append((found[0], i, i + 1, symbols[i], symbols[i + 1], found[1]))
        heapify(queue)
        while queue:
            _, i, j, left, right, joined = heappop(queue)
            if symbols[i] != left or symbols[j] != right or after[i] != j:
                continue  # stale: one of the two has been merged since
            symbols[i], symbols[j] = joined, -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if found := merges.get((joined, symbols[k])):
                    heappush(queue, (found[0], i, k, joined, symbols[k], found[1]))
            h = before[i]
            if h >= 0 and (found := merges.get((symbols[h], joined))):
                heappush(queue, (found[0], h, i, symbols[h], joined, found[1]))
        return [s for s in symbols if s >= 0]

    def _piece(self, piece: str) -> bytes:
        return self._merged([self.letters[b] for b in piece.encode()])

    def _merged(self, letters: list[str]) -> bytes:
        letters[-1] += self.suffix
        return np.array(self.merge([self.ids[x] for x in letters]), "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        """Ids of any text without special symbols; the library cuts it."""
        normal = self._tokenizer.normalizer.normalize_str(text)
        pieces = self._tokenizer.pre_tokenizer.pre_tokenize_str(normal)
        return b"".join(self._merged([*piece]) for piece, _ in pieces)

    def _whole(self, text: str) -> bytes:
        """Ids of any text: special symbols first, then what lies between them."""
        out, at = [], 0
        for hit in self._special.finditer(text):
            out.append(self._plain(text[at : hit.start()]))
            out.append(np.array([self.specials[hit.group()]], "<u4").tobytes())
            at = hit.end()
        return b"".join([*out, self._plain(text[at:])])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return gather(texts, self.pieces, True)


class Decoder:
    """Vocabulary strings of ids, joined by single spaces."""

    def __init__(self, names: list[bytes]):
        self.sizes = np.array([len(x) + 1 for x in names], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.pool = np.frombuffer(b"".join(x + b" " for x in names), np.uint8)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """Decoded UTF-8 text of each run of ``counts`` ids."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        kind = np.int32 if total < 1 << 31 else np.int64
        places = np.repeat((self.ends[ids] - ends).astype(kind), sizes)
        places += np.arange(total, dtype=kind)
        joined = self.pool[places].tobytes()
        cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [joined[a : max(a, b - 1)] for a, b in zip(cuts, cuts[1:], strict=False)]


def encode_and_decode(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Ids of each whole text and the text they decode to.

    ``ids`` are little-endian unsigned 32-bit integers.  A null or empty text has
    no ids and decodes to nothing.  Strings of special symbols in a text become
    their ids.  Every row gives a row, in no promised order; other columns are
    ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(tokenizer)
        decoder = Decoder(bpe.names)
        for batch in batches:
            for part in slices(batch, "text"):
                flat, counts = bpe.encode(part.column("text"))
                raw, ends = flat.tobytes(), np.cumsum(counts)
                each = [
                    raw[4 * a : 4 * b]
                    for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True)
                ]
                decoded = decoder.decode(flat, counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key"),
                        pa.array(counts),
                        pa.array(each, pa.binary()),
                        pa.array([x.decode() for x in decoded], pa.string()),
                    ],
                    names=["key", "n_tokens", "ids", "decoded"],
                )

    chosen = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, "key bigint, n_tokens bigint, ids binary, decoded string")
