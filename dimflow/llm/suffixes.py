"""Repeated strings by difference-cover sampling.

A string of ``span`` bytes is repeated where it starts at two places.  With a
perfect difference set ``D`` modulo ``v``, any two places have one shift below
``v`` that takes both onto places of the sample ``{p : p mod v in D}``.  So if
the strings at two places are equal, so are the ``span - v + 1`` bytes at the
sample places that follow them, and only places before a sample place whose
bytes recur need to be looked at.

1. *Sample.*  Every sample place is named by its next ``span - v + 1`` bytes,
   taken as letters of eight bytes.  The names are sorted over the cluster and
   those that occur once are discarded.
2. *Recurse on names.*  What is left is named anew by the longer string from
   ``v - 1`` bytes before the place to ``span`` after it.  Where that recurs, every
   string in it is repeated, and only its first holder has to go on.
3. *Merge the rest.*  All other places before a kept sample place are named by
   their prefix of ``span`` bytes; the names are sorted, and neighbours with equal
   prefixes are repeated strings.  Such places follow each other, so their names are
   made from hashes of 8, 16, 32 ... bytes that overlapping strings share.

Step 1 only discards, so 32 bits beside the target are name enough there.  In steps 2
and 3 a name is 80 bits beside the target, of two hashes of different form, and strings
of one name are taken as equal: among 10**13 places that are two different strings with a
chance of 3 * 10**-5, as there are 2**23 targets then and a name is made in five steps at most.
Texts are cut into shards of some megabytes.  For each step a shard sends each of its names once, in one packed
block per target, and gets back one bit per name.  So a name that a third of all
documents hold costs one entry per shard.  Shards are stored bucketed by number,
so the answers come to them and the text is not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.llm.storage import Stored

#: Perfect difference sets by modulus.
COVERS = {
    1: [0],
    3: [0, 1],
    7: [0, 1, 3],
    13: [0, 1, 3, 9],
    21: [0, 1, 4, 14, 16],
    31: [0, 1, 3, 8, 12, 18],
    57: [0, 1, 3, 13, 32, 36, 43, 52],
    73: [0, 1, 3, 7, 15, 31, 36, 54, 63],
    91: [0, 1, 3, 9, 27, 49, 56, 61, 77, 81],
    133: [0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109],
}
SHARD_BYTES = 4 << 20
TARGET_BYTES = 16 << 20  # of names that one task sorts
LETTER = 8
SLICE = 1 << 14  # places hashed at once, so that they stay in the processor's cache
LOW = np.uint64(0xFFFF)
FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # of the two hashes; any odd numbers


def modulus(span: int) -> int:
    """The widest cover that leaves a third of the span to the names."""
    return max(v for v in COVERS if 3 * v <= 2 * span + 1)


class Shard:
    """Several texts as one byte array, and the names of places in it."""

    def __init__(self, sizes: list[int], packed: bytes, span: int):
        self.span, self.v = span, modulus(span)
        self.sizes = np.array(sizes, np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        total = int(self.ends[-1]) if len(sizes) else 0
        raw = zstandard.decompress(packed, max_output_size=total) if total else b""
        self.bytes = np.frombuffer(raw, np.uint8)
        padded = np.frombuffer(raw + b"\0" * LETTER, np.uint8)
        self.letters = np.ndarray((total + 1,), "<u8", padded, strides=(1,))

    def bounds(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of the text around each place."""
        text = np.searchsorted(self.ends, places, side="right")
        return self.starts[text], self.ends[text]

    def sample(self) -> np.ndarray:
        cover = np.array(COVERS[self.v])
        width = self.span - self.v + 1
        found = []
        for start, size in zip(self.starts.tolist(), self.sizes.tolist(), strict=True):
            if size >= self.span:
                places = (np.arange(0, size, self.v)[:, None] + cover).reshape(-1)
                found.append(places[places + width <= size] + start)
        return np.concatenate(found) if found else np.empty(0, np.int64)

    def names(
        self, places: np.ndarray, sizes: np.ndarray | int, factor: int, mix=None
    ) -> np.ndarray:
        """Hash of the ``sizes`` bytes at each place."""
        mix = mix or _mix
        sizes = np.broadcast_to(np.asarray(sizes, np.int64), places.shape)
        found = np.empty(len(places), np.uint64)
        for a in range(0, len(places), SLICE):
            some = slice(a, a + SLICE)
            found[some] = self._names(places[some], sizes[some], np.uint64(factor), mix)
        return found

    def _names(self, places: np.ndarray, sizes: np.ndarray, k: np.uint64, mix) -> np.ndarray:
        mixed = k + sizes.astype(np.uint64)
        least, most = int(sizes.min()), int(sizes.max())
        last = places + np.maximum(sizes - LETTER, 0)
        for step in range(0, max(most - LETTER, 0), LETTER):
            if step < least - LETTER:
                mixed = mix(mixed ^ self.letters[places + step], k)
            else:
                more = np.flatnonzero(step < sizes - LETTER)
                mixed[more] = mix(mixed[more] ^ self.letters[places[more] + step], k)
        tail = self.letters[last]
        if least < LETTER:
            short = sizes < LETTER
            low = (np.uint64(1) << (8 * np.where(short, sizes, 0)).astype(np.uint64)) - np.uint64(1)
            tail = np.where(short, tail & low, tail)
        return mix(mix(mixed ^ tail, k), k)

    def strong_names(self, places: np.ndarray, sizes: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        """Both halves of the 128-bit hash of the ``sizes`` bytes at each place."""
        return self.names(places, sizes, FACTORS[0]), self.names(places, sizes, FACTORS[1], _turn)

    def near_names(self, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Like ``strong_names``, of strings of one size at rising places that mostly
        follow each other.  Hashes of 8, 16, 32 ... bytes are made from those of half
        the bytes, at all places at once; two that overlap make up the string."""
        if size < LETTER:
            return self.strong_names(places, size)
        halves = np.empty((2, len(places)), np.uint64)
        for a in range(0, len(places), SLICE):
            some = places[a : a + SLICE]
            new = np.flatnonzero(np.diff(some, prepend=-size - 1) > size)
            ends = np.append(new[1:], len(some))
            count = some[ends - 1] - some[new] + size - LETTER + 1
            shift = some[new] - (np.cumsum(count) - count)
            letters = self.letters[np.arange(int(count.sum())) + np.repeat(shift, count)]
            at = some - np.repeat(shift, ends - new)
            for half, factor, mix in zip(halves, FACTORS, (_mix, _turn), strict=True):
                half[a : a + SLICE] = _doubled(letters, at, size, np.uint64(factor), mix)
        return halves[0], halves[1]

    def wide(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of the longer strings around rising sample places.  Near
        the ends of a text several places have the same one; it counts once."""
        low, high = self.bounds(places)
        start = np.maximum(places - (self.v - 1), low)
        size = np.minimum(places + self.span, high) - start
        new = np.ones(len(places), bool)
        new[1:] = (start[1:] != start[:-1]) | (size[1:] != size[:-1])
        new &= size >= self.span
        return start[new], size[new]


def _mix(value: np.ndarray, factor: np.uint64) -> np.ndarray:
    value = value * factor
    return value ^ (value >> np.uint64(32))


def _turn(value: np.ndarray, factor: np.uint64) -> np.ndarray:
    value = value ^ (value >> np.uint64(29))
    return value * factor + np.uint64(FACTORS[0])


def _doubled(letters: np.ndarray, at: np.ndarray, size: int, k: np.uint64, mix) -> np.ndarray:
    """Hash of ``size`` bytes at places of a run of letters."""
    mixed = mix(mix(letters ^ k, k), k)
    m = LETTER
    while 2 * m <= size:
        mixed = mix(mix(mixed[:-m], k) ^ mixed[m:], k)
        m *= 2
    return mix(mix(mix(mixed[at], k) ^ mixed[at + (size - m)], k), k)


class Names:
    """Distinct names of a shard in the order they are sent in: by target, then by
    the first bits of the name.  ``row`` leads from a place to its name; ``more`` has
    16 further bits.  A name that others of the same first bits part is sent again."""

    def __init__(self, names: np.ndarray, targets: np.ndarray, more: np.ndarray | None = None):
        order = _order(names, targets)
        names, targets = names[order], targets[order]
        new = np.ones(len(order), bool)
        new[1:] = (names[1:] != names[:-1]) | (targets[1:] != targets[:-1])
        if more is not None:
            more = more[order]
            new[1:] |= more[1:] != more[:-1]
        self.row = np.empty(len(order), np.int64)
        self.row[order] = np.cumsum(new) - 1
        self.first = order[new]  # the place that holds a name first
        self.names, self.targets = names[new], targets[new]
        self.more = None if more is None else more[new]
        self.many = np.diff(np.append(np.flatnonzero(new), len(order))) > 1

    def blocks(self, number: int, short: bool, bits: int) -> pa.RecordBatch:
        """One row per target.  Names that only discard are cut to 32 bits; the
        target has the bits before them."""
        cuts = np.flatnonzero(np.diff(self.targets)) + 1
        starts = [0, *cuts.tolist()] if len(self.targets) else []
        ends = [*cuts.tolist(), len(self.targets)] if starts else []
        keys = []
        for a, b in zip(starts, ends, strict=True):
            if short:
                rest = self.names[a:b] << np.uint64(bits)
                keys.append(rest.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :4].tobytes())
            else:
                halves = np.stack([self.more[a:b], self.names[a:b]], axis=1)
                raw = halves.astype(">u8").view(np.uint8).reshape(-1, 16)
                keys.append(raw[:, 6:].tobytes())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([int(self.targets[a]) for a in starts], pa.int64()),
                pa.array([number] * len(starts), pa.int64()),
                pa.array([b - a for a, b in zip(starts, ends, strict=True)], pa.int64()),
                pa.array(keys, pa.binary()),
                pa.array(
                    [np.packbits(self.many[a:b]).tobytes() for a, b in zip(starts, ends, strict=True)],
                    pa.binary(),
                ),
            ],
            names=["target", "shard", "n", "names", "many"],
        )


def _order(names: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Order by target, first bits of the name and place: one sort of whole numbers
    that hold all three."""
    low = len(names).bit_length()
    high = int(targets.max(initial=0)).bit_length()
    key = names >> np.uint64(high + low) << np.uint64(low)
    if high:
        key |= targets.astype(np.uint64) << np.uint64(64 - high)
    key |= np.arange(len(names), dtype=np.uint64)
    key.sort()
    return (key & np.uint64((1 << low) - 1)).astype(np.int64)


BLOCK_SCHEMA = "target bigint, shard bigint, n bigint, names binary, many binary"


def recurring(blocks: pa.Table) -> pa.Table:
    """For the blocks of one target: which names occur in several blocks or more
    than once in one, and of which of them a block is the first holder."""
    blocks = blocks.sort_by("shard")
    counts = blocks.column("n").to_numpy()
    raw = b"".join(blocks.column("names").to_pylist())
    total = int(counts.sum())
    width = len(raw) // total
    halves = -(-width // 8)  # names of 32 or of 80 bits
    wide = np.zeros((total, 8 * halves), np.uint8)
    wide[:, 8 * halves - width :] = np.frombuffer(raw, np.uint8).reshape(total, width)
    names = wide.view(">u8").reshape(total, halves).astype(np.uint64)
    many = np.concatenate(
        [
            np.unpackbits(np.frombuffer(m, np.uint8), count=n)
            for m, n in zip(blocks.column("many").to_pylist(), counts.tolist(), strict=True)
        ]
    ).astype(bool)
    order = np.argsort(names[:, -1], kind="stable")
    names = names[order]
    new = np.ones(total, bool)
    new[1:] = (names[1:] != names[:-1]).any(axis=1)
    run = np.cumsum(new) - 1
    again = np.bincount(run) > 1
    again |= np.bincount(run, weights=many[order]) > 0
    repeated, first = np.empty(total, bool), np.empty(total, bool)
    repeated[order] = again[run]
    first[order] = new
    ends = np.cumsum(counts)
    bits = [
        [np.packbits(x[a:b]).tobytes() for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
        for x in (repeated, first)
    ]
    return pa.table(
        {
            "shard": blocks.column("shard"),
            "target": blocks.column("target"),
            "n": blocks.column("n"),
            "repeated": pa.array(bits[0], pa.binary()),
            "first": pa.array(bits[1], pa.binary()),
        }
    )


ANSWER_SCHEMA = "shard bigint, target bigint, n bigint, repeated binary, first binary"


def answered(answers: list[dict] | None, what: str) -> np.ndarray:
    """Bits of all names of a shard, in the order the names were sent in."""
    bits = [
        np.unpackbits(np.frombuffer(a[what], np.uint8), count=a["n"])
        for a in sorted(answers or [], key=lambda a: a["target"])
    ]
    return np.concatenate(bits).astype(bool) if bits else np.empty(0, bool)


class Steps:
    """The places that each step looks at, from a shard and the answers so far."""

    def __init__(self, shard: Shard, bits: int):
        self.shard, self.bits = shard, bits

    def targets(self, hashed: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(hashed), np.int64)
        return (hashed >> np.uint64(64 - self.bits)).astype(np.int64)

    def sampled(self) -> Names:
        self.places = self.shard.sample()
        width = self.shard.span - self.shard.v + 1
        names = self.shard.names(self.places, width, FACTORS[0])
        return Names(names, self.targets(names))

    def longer(self, answers) -> Names:
        names = self.sampled()
        kept = self.places[answered(answers, "repeated")[names.row]]
        self.starts, sizes = self.shard.wide(kept)
        self.last = self.starts + sizes - self.shard.span
        a, b = self.shard.strong_names(self.starts, sizes)
        return Names(b, self.targets(a), a & LOW)

    def rest(self, answers, longer_answers) -> Names:
        """``self.known``: starts known to be repeated; ``self.open``: places to send."""
        names = self.longer(answers)
        shard = self.shard
        repeated = answered(longer_answers, "repeated")[names.row]
        first = answered(longer_answers, "first")[names.row]
        holder = np.zeros(len(names.row), bool)
        holder[names.first] = True
        self.known = self._between(self.starts, self.last, repeated)
        told = self._between(self.starts, self.last, repeated & ~(first & holder))
        every = np.ones(len(self.starts), bool)
        self.open = np.flatnonzero(self._between(self.starts, self.last, every) & ~told)
        a, b = shard.near_names(self.open, shard.span)
        return Names(b, self.targets(a), a & LOW)

    def covered(self, answers, longer_answers, rest_answers) -> np.ndarray:
        """Whether each byte belongs to a repeated string."""
        names = self.rest(answers, longer_answers)
        starts = self.known
        starts[self.open[answered(rest_answers, "repeated")[names.row]]] = True
        at = np.flatnonzero(starts)
        return self._between(at, at + self.shard.span - 1, np.ones(len(at), bool))

    def _between(self, first: np.ndarray, last: np.ndarray, use: np.ndarray) -> np.ndarray:
        """Whether each byte lies in a stretch; neither their starts nor ends fall."""
        first, last = first[use], last[use]
        if not len(first):
            return np.zeros(len(self.shard.bytes), bool)
        apart = np.flatnonzero(first[1:] > last[:-1] + 1)
        edges = np.empty(2 * len(apart) + 2, np.int64)
        edges[::2] = first[np.append(0, apart + 1)]
        edges[1::2] = last[np.append(apart, len(last) - 1)] + 1
        lengths = np.diff(edges, prepend=0, append=len(self.shard.bytes))
        return np.repeat(np.arange(len(lengths)) % 2 == 1, lengths)


def make_shards(docs: DataFrame, text: str) -> DataFrame:
    """Runs of rows with their other columns and their texts as one block."""
    columns = [c for c in docs.columns if c != text]
    chosen = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns] or [F.lit(None)]).alias("row"),
        F.col(f"`{text}`").cast("binary").alias("text"),
    )
    schema = T.StructType(
        [
            T.StructField("shard", T.LongType()),
            T.StructField("rows", T.ArrayType(chosen.schema["row"].dataType)),
            T.StructField("sizes", T.ArrayType(T.LongType())),
            T.StructField("body", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0))
            group = np.cumsum(sizes, dtype=np.int64) // SHARD_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b > a:
                    body = b"".join(t or b"" for t in batch.column("text")[a:b].to_pylist())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([number], pa.int64()),
                            _one_list(batch.column("row").slice(a, b - a)),
                            pa.array([sizes[a:b].tolist()], pa.list_(pa.int64())),
                            pa.array([press.compress(body)], pa.binary()),
                        ],
                        names=["shard", "rows", "sizes", "body"],
                    )
                    number += 1

    return chosen.mapInArrow(run, schema)


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.concat_arrays([values]))


def remove_repeats(docs: DataFrame, held: Stored, span: int = 200, text: str = "text") -> DataFrame:
    """Remove every byte of ``text`` covered by a string of ``span`` bytes that
    also starts anywhere else, in the same text or in another.

    One row per document: ``row`` (a struct of its other columns), ``n_bytes``,
    ``n_removed``, ``spans`` (the maximal removed runs as ``start`` and ``end``)
    and ``kept`` (the remaining bytes).  Texts are UTF-8 bytes, a null one is
    empty.  Strings are judged on the input; they may overlap, and none crosses
    texts.  Rows that repeat a text are copies of each other.  Texts under
    ``span`` bytes keep all.  An empty table gives no rows.  A text is read by one
    task, whatever its length, which takes some 20 bytes for each of its bytes.
    """
    shards = make_shards(docs, text)
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    bits = max(4, (total // TARGET_BYTES).bit_length())  # a name of 8 bytes per 8 bytes at most
    buckets = min(100_000, 1 + total // (2 * TARGET_BYTES))
    bucketed = held.keep_bucketed(shards, buckets, "shard")

    def sent(table: DataFrame, names_of, short: bool) -> DataFrame:
        columns = [c for c in table.columns if c not in ("rows",)]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1).to_pylist()[0]
                    steps = Steps(Shard(row["sizes"], row["body"], span), bits)
                    yield names_of(steps, row).blocks(row["shard"], short, bits)

        blocks = table.select(*columns).mapInArrow(run, BLOCK_SCHEMA)
        return blocks.groupBy("target").applyInArrow(recurring, ANSWER_SCHEMA)

    def with_answers(table: DataFrame, answers: DataFrame, column: str) -> DataFrame:
        each = F.struct("target", "n", "repeated", "first")
        per_shard = held.keep(answers.groupBy("shard").agg(F.collect_list(each).alias(column)))
        return table.join(per_shard, "shard", "left")

    one = with_answers(bucketed, sent(bucketed, lambda s, r: s.sampled(), True), "one")
    two = with_answers(one, sent(one, lambda s, r: s.longer(r["one"]), False), "two")
    three = with_answers(two, sent(two, lambda s, r: s.rest(r["one"], r["two"]), False), "three")

    schema = T.StructType(
        [
            T.StructField("row", shards.schema["rows"].dataType.elementType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField(
                "spans",
                T.ArrayType(
                    T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
                ),
            ),
            T.StructField("kept", T.BinaryType()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one_row = batch.slice(i, 1)
                row = one_row.drop_columns(["rows"]).to_pylist()[0]
                shard = Shard(row["sizes"], row["body"], span)
                covered = Steps(shard, bits).covered(row["one"], row["two"], row["three"])
                yield cut_texts(shard, covered, one_row.column("rows").flatten())

    return three.select("rows", "shard", "sizes", "body", "one", "two", "three").mapInArrow(cut, schema)


def cut_texts(shard: Shard, covered: np.ndarray, rows: pa.Array) -> pa.RecordBatch:
    removed, spans, kept = [], [], []
    for start, end in zip(shard.starts.tolist(), shard.ends.tolist(), strict=True):
        mine = covered[start:end]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]]).astype(np.int8)))
        spans.append([{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()])
        removed.append(int(mine.sum()))
        kept.append(shard.bytes[start:end][~mine].tobytes())
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [
            rows,
            pa.array(shard.sizes),
            pa.array(removed, pa.int64()),
            pa.array(spans, span_type),
            pa.array(kept, pa.binary()),
        ],
        names=["row", "n_bytes", "n_removed", "spans", "kept"],
    )
