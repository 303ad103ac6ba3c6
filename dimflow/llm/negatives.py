"""Hard negatives of anchors: the best rows of another label in a window of scores
below each positive of the anchor.

The windows of an anchor's positives overlap.  Their upper limits cut the scores
into disjoint slots, so a row falls into one slot of an anchor at most.  Tasks keep
the best ``negatives`` rows of every slot, and only these are shuffled and merged.
A window begins at the top of a slot; read from there downwards, the kept rows of
its slots in order are a descending list whose first ``negatives`` rows are the best
below the upper limit, and the lower limit cuts that list.

Every anchor is scored against every row, in blocks.  Anchors are taken in rounds
whose bytes are bounded, and a round's anchors are sent to the tasks once; rows are
never copied or shuffled.  Two scans of the rows make a round: one finds the
positives, one the slots.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimflow.llm.storage import Stored

ROUND_BYTES = 1 << 26  # of the anchors that are sent to the tasks at a time, with what is kept for them
ENTRY_BYTES = 32  # of a kept row
ROWS, ANCHORS = 1024, 1024  # of a block of scores
FIRST_ROWS = 64  # of the first block, while nothing is known of the best
PENDING = 1 << 20  # rows that wait to be merged into the best
MOST = 1 << 62  # scores beyond this count as it
MOST_COMPONENT = 2.0**400
NOTHING = np.iinfo(np.int64).min

ROWS_SCHEMA = "key bigint, label string, anchor boolean, packed binary"
FOUND_SCHEMA = "anchor bigint, slot int, key bigint, score bigint, row bigint"
RESULT_SCHEMA = (
    "anchor bigint, positive bigint, rank int, negative bigint, positive_score bigint, negative_score bigint"
)


def prepare(
    vectors: DataFrame, is_anchor: Column, key: str, label: Column, vector: str, scale: float
) -> DataFrame:
    """The rows that take part, with the floors of their scaled components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            flat = np.asarray(column.flatten().cast(pa.float64()).fill_null(np.nan))
            sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            broken = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            part = broken[ends] == broken[ends - sizes]
            part &= np.asarray(column.is_valid()) & np.asarray(batch.column("key").is_valid())
            part &= np.asarray(batch.column("label").is_valid())
            with np.errstate(over="ignore", invalid="ignore"):
                whole = np.floor(np.clip(scale * flat, -MOST_COMPONENT, MOST_COMPONENT)).tobytes()
            used = np.flatnonzero(part)
            packed = [
                whole[8 * a : 8 * b]
                for a, b in zip((ends - sizes)[used].tolist(), ends[used].tolist(), strict=True)
            ]
            chosen = batch.select(["key", "label", "anchor"]).take(pa.array(used))
            yield pa.RecordBatch.from_arrays(
                [*chosen.columns, pa.array(packed, pa.binary())], names=["key", "label", "anchor", "packed"]
            )

    chosen = vectors.select(
        F.col(key).cast("bigint").alias("key"),
        label.cast("string").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    return chosen.mapInArrow(run, ROWS_SCHEMA)


class Block:
    """Rows of one vector length, as arrays."""

    def __init__(self, row, key, label, matrix):
        self.row, self.key, self.label, self.matrix = row, key, label, matrix
        self.norm = np.sqrt(np.square(matrix).sum(axis=1))

    def __len__(self) -> int:
        return len(self.key)

    def take(self, places) -> Block:
        part = object.__new__(Block)
        part.row, part.key, part.label = self.row[places], self.key[places], self.label[places]
        part.matrix, part.norm = self.matrix[places], self.norm[places]
        return part

    def halves(self) -> Iterator[Block]:
        """The rows whose products are exact in doubles, and the others."""
        large = self.norm >= 2.0**26
        for part in (~large, large):
            if part.any():
                yield self if part.all() else self.take(part)


def blocks_of(batch: pa.RecordBatch, labels: pa.Array) -> dict[int, Block]:
    """Blocks by vector length; labels become their place in ``labels``."""
    sizes = np.asarray(pc.binary_length(batch.column("packed")))
    label = np.asarray(pc.index_in(batch.column("label"), labels).fill_null(-1))
    row, key = (np.asarray(batch.column(c)).astype(np.int64) for c in ("row", "key"))
    out = {}
    for size in np.unique(sizes).tolist():
        places = np.flatnonzero(sizes == size)
        packed = batch.column("packed").take(pa.array(places)).to_pylist()
        matrix = np.frombuffer(b"".join(packed), np.float64).reshape(len(places), -1)
        out[size] = Block(row[places], key[places], label[places], matrix)
    return out


def scores(rows: Block, anchors: Block) -> np.ndarray:
    """Exact inner products of whole numbers.  No sum of products is larger than the
    product of the norms, so that says which arithmetic is exact."""
    most = rows.norm.max(initial=0) * anchors.norm.max(initial=0)
    if most < 2.0**24:
        return rows.matrix.astype(np.float32) @ anchors.matrix.astype(np.float32).T
    if most < 2.0**52:
        return rows.matrix @ anchors.matrix.T
    whole = [np.array([[int(x) for x in v] for v in b.matrix], object).reshape(b.matrix.shape) for b in (rows, anchors)]
    return np.clip(whole[0] @ whole[1].T, -MOST, MOST).astype(np.int64)


class Best:
    """The best ``most`` rows of each cell: higher scores first, then smaller keys.
    ``low`` is the least score of each cell that counts."""

    def __init__(self, low: np.ndarray, most: int):
        self.most, self.score = most, low.astype(np.int64)
        self.key = np.full(len(low), np.iinfo(np.int64).max)
        self.kept = tuple(np.zeros(0, np.int64) for _ in range(4))
        self.waiting: list[tuple] = []
        self.n = 0

    def least(self, key: int) -> np.ndarray:
        """The scores from which a row of ``key`` or more can enter each cell."""
        return self.score + (key > self.key)

    def add(self, cell, score, key, row) -> None:
        if len(cell):
            self.waiting.append((cell, score, key, row))
            self.n += len(cell)
            if self.n > PENDING or len(self.kept[0]) < self.n:
                self.merge()

    def merge(self) -> None:
        cell, score, key, row = (np.concatenate(x) for x in zip(self.kept, *self.waiting, strict=True))
        order = np.lexsort((row, key, -score, cell))
        cell, score, key, row = cell[order], score[order], key[order], row[order]
        first = np.searchsorted(cell, cell)
        place = np.arange(len(cell)) - first
        last = place == self.most - 1
        self.score[cell[last]], self.key[cell[last]] = score[last], key[last]
        keep = place < self.most
        self.kept = (cell[keep], score[keep], key[keep], row[keep])
        self.waiting, self.n = [], 0


class Anchors:
    """The anchors of a round; ``upper`` has the slots' upper limits of each, falling,
    and ``low`` the least score that any window of an anchor takes."""

    def __init__(self, table: pa.Table):
        batch = table.combine_chunks().to_batches()[0]
        self.labels = pc.unique(batch.column("label"))
        self.by_size = blocks_of(batch, self.labels)

    def find(self, batches: Iterator[pa.RecordBatch], limits: dict, same: bool, most: int):
        """The best rows of the same or of another label, of each anchor and slot."""
        cells = {}
        for size, block in self.by_size.items():
            upper, low = limits[size]
            floor = np.maximum(np.append(upper[:, 1:], np.full((len(block), 1), NOTHING), axis=1) + 1, low[:, None])
            cells[size] = Best(floor.reshape(-1), most)
        step = FIRST_ROWS
        for batch in batches:
            for size, rows in blocks_of(batch, self.labels).items():
                if size not in self.by_size:
                    continue
                at = 0
                while at < len(rows):
                    some = rows.take(slice(at, at + step))
                    at, step = at + step, min(2 * step, ROWS)
                    for part in some.halves():
                        self._meet(part, size, limits[size][0], cells[size], same)
        for size, best in cells.items():
            best.merge()
            cell, score, key, row = best.kept
            anchor, slot = np.divmod(cell, limits[size][0].shape[1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(self.by_size[size].row[anchor]), pa.array(slot.astype(np.int32)),
                    pa.array(key), pa.array(score), pa.array(row),
                ],
                names=["anchor", "slot", "key", "score", "row"],
            )

    def _meet(self, rows: Block, size: int, upper: np.ndarray, best: Best, same: bool) -> None:
        whole, slots, lowest = self.by_size[size], upper.shape[1], int(rows.key.min())
        for a in range(0, len(whole), ANCHORS):
            for half in self._halves(whole, a):
                mine = whole.take(half)
                least = best.least(lowest).reshape(-1, slots)[half]
                found = scores(rows, mine)
                hit = found >= least.min(axis=1).astype(found.dtype)
                hit &= found <= upper[half, 0].astype(found.dtype)
                hit &= (rows.label[:, None] == mine.label) == same
                r, c = np.nonzero(hit)
                score = found[r, c].astype(np.int64)
                slot = (upper[half][c] >= score[:, None]).sum(axis=1) - 1
                used = (score >= least[c, slot]) & (rows.row[r] != mine.row[c])
                r, c = r[used], c[used]
                best.add(half[c] * slots + slot[used], score[used], rows.key[r], rows.row[r])

    @staticmethod
    def _halves(whole: Block, start: int) -> Iterator[np.ndarray]:
        places = np.arange(start, min(start + ANCHORS, len(whole)))
        large = whole.norm[places] >= 2.0**26
        for part in (places[~large], places[large]):
            if len(part):
                yield part


def limits_of(block: Block, by_anchor: dict[int, list[tuple[int, int]]], slots: int):
    """Upper limits of the slots of each anchor and the least score of its windows."""
    upper = np.full((len(block), slots), NOTHING)
    low = np.full(len(block), MOST + 1)
    for i, row in enumerate(block.row.tolist()):
        windows = by_anchor.get(row, [])
        for j, top in enumerate(sorted({top for _, top in windows}, reverse=True)):
            upper[i, j] = top
        low[i] = min((least for least, _ in windows), default=MOST + 1)
    return upper, low


def best_of(found: DataFrame, most: int) -> DataFrame:
    """The best rows of each anchor and slot over all tasks."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "key", "row")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)


def mine_round(
    rows: DataFrame, anchors: pa.Table, held: Stored, positives: int, negatives: int, low: int, high: int
) -> DataFrame:
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(Anchors(anchors))

    def task(limits, same: bool, most: int) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return sent.value.find(batches, limits.value, same, most)

        return run

    def scan(limits: dict, same: bool, most: int) -> DataFrame:
        limited = spark.sparkContext.broadcast(limits)
        found = rows.select("row", "key", "label", "packed").mapInArrow(task(limited, same, most), FOUND_SCHEMA)
        kept = held.keep(best_of(found, most))
        limited.destroy()
        return kept

    whole = {
        size: (np.full((len(b), 1), MOST), np.full(len(b), -MOST)) for size, b in sent.value.by_size.items()
    }
    best = scan(whole, True, positives).select("anchor", "key", "score").toArrow().to_pylist()
    windows, by_anchor = [], {}
    for pair in best:  # at most ``positives`` for each anchor of the round
        least, top = -(-low * pair["score"] // 100), high * pair["score"] // 100
        if least <= top:
            by_anchor.setdefault(pair["anchor"], []).append((least, top))
            windows.append((pair["anchor"], pair["key"], pair["score"], least, top))
    slots = {size: limits_of(b, by_anchor, positives) for size, b in sent.value.by_size.items()}
    entries = scan(slots, False, negatives)
    sent.destroy()
    # a slot's rows in descending order, and after them those of the slots below it
    entry = F.struct("slot", (-F.col("score")).alias("less"), "key", "row", "score")
    lists = entries.groupBy("anchor").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    asked = spark.createDataFrame(
        windows, "anchor bigint, positive bigint, positive_score bigint, least bigint, top bigint"
    )
    below = F.slice(F.filter("entries", lambda e: e["score"] <= F.col("top")), 1, negatives)
    inside = F.filter(below, lambda e: e["score"] >= F.col("least"))
    asked = asked.withColumnsRenamed({"anchor": "row"})
    keys = spark.createDataFrame(anchors.select(["row", "key"])).withColumnsRenamed({"key": "anchor"})
    answered = asked.join(keys, "row").join(lists.withColumnRenamed("anchor", "row"), "row")
    return answered.select("anchor", "positive", "positive_score", F.posexplode(inside)).select(
        "anchor", "positive", (F.col("pos") + 1).alias("rank"), F.col("col.key").alias("negative"),
        "positive_score", F.col("col.score").alias("negative_score"),
    )


def mine(
    vectors: DataFrame, held: Stored, is_anchor: Column, label: Column, scale: float = 256,
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """``anchor``, ``positive``, ``rank``, ``negative``, ``positive_score`` and
    ``negative_score`` (keys and whole scores) of the rows chosen.

    A component counts as the floor of ``scale`` times it, the score of two rows is
    their inner product.  The positives of an anchor are the ``positives`` best other
    rows of its label; for each, the ``negatives`` best rows of other labels whose
    score is ``low`` to ``high`` per cent of the positive's are returned.  Higher
    scores come first, equal ones by smaller key.

    A row with a null key, label or vector, or with a null or non-finite component,
    takes no part.  Rows that repeat a key are rows of their own, also as anchors.
    Vectors of different length have no score.  A window without rows, and a positive
    with a score below zero (its window is empty), return nothing.  Scaled components
    are held to 2**400 and scores to 2**62, either way.  Other columns are ignored,
    and vectors of any length work as long as a row fits in memory.  An empty table
    gives no rows.
    """
    prepared = prepare(vectors, is_anchor, key, label, vector, scale)
    rows = held.keep(prepared.withColumn("row", F.monotonically_increasing_id()))
    anchors = rows.filter("anchor")
    kept = ENTRY_BYTES * (positives * negatives + positives)
    size = anchors.agg(F.sum(F.octet_length("packed") + F.lit(kept)).alias("bytes")).first()["bytes"] or 0
    rounds = -(-size // ROUND_BYTES)
    folder = held.folder()
    for number in range(rounds):
        mine_of = anchors.filter(F.pmod(F.xxhash64("row"), F.lit(rounds)) == number)
        sent = mine_of.select("row", "key", "label", "packed").toArrow()
        if sent.num_rows:
            found = mine_round(rows, sent, held, positives, negatives, low, high)
            found.write.parquet(f"{folder}/round={number}")
    if not rounds:
        return vectors.sparkSession.createDataFrame([], RESULT_SCHEMA)
    return vectors.sparkSession.read.schema(RESULT_SCHEMA).parquet(f"{folder}/round=*")
