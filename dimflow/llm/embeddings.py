"""Embedding near-duplicates by navigable small-world graphs, one per shard.

Distinct vectors are dealt over shards and each shard builds a graph.  Every
vector is searched in every shard.  A beam is widened until its end lies below
the threshold, and until an audit passes: for some queries of each block the
shard is scanned, and the beam must have found nearly all of their links.
Cosines of what the beams hold are verified in double precision.

Copies of one vector are one node with a count.  Of the links that a task finds
for a block, the counts and a spanning forest go on: pairs are verified and folded
in runs of bounded size.  Queries travel in blocks; a task streams the blocks of its
shard past one graph.

A search by beam may miss a link that the search from its other end finds.  So the
few links of a query whose beam sufficed go on as pairs, too, and one that was found
from one end only is credited to the other.  A query that was answered by a scan has
missed nothing; of its links those go on that lead to a place with few neighbours in
its own shard, as only such a place is searched by beam elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.llm.components import components
from dimflow.llm.hnsw import Graph
from dimflow.llm.storage import Stored

SHARDS = 8  # at least, where each gets LEAST_VECTORS
LEAST_VECTORS = 1024
SHARD_BYTES = 48 << 20  # of vectors in a graph, up to the evenness of the deal
SLICES = 4  # tasks per shard
BLOCK = 512  # queries that are searched together
BEAM = 32
AUDITED = 16  # queries of a block that are checked by a scan
RECALL = 0.99
NEAR = 1e-4  # single precision may be off by this
RUN = 1 << 22  # cosines that are held together
RUN_BYTES = 1 << 25  # of each side of the pairs that are verified together


def pack_vectors(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Key and double components of each usable vector, as bytes; null for others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            flat = np.asarray(column.flatten().cast(pa.float64()).fill_null(np.nan)) + 0.0
            sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            packed = []
            for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
                one = flat[a:b]
                largest = np.abs(one).max(initial=0.0)
                packed.append(one.tobytes() if 0 < largest < np.inf else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(packed, pa.binary())], names=["key", "packed"]
            )

    chosen = vectors.select(
        F.col(key).cast("bigint").alias("key"), F.col(vector).cast("array<double>").alias("vector")
    )
    return chosen.mapInArrow(run, "key bigint, packed binary")


def unit(packed: list[bytes]) -> np.ndarray:
    rows = np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no square overflows
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def build_shard(nodes: pa.Table, threshold: float) -> pa.Table:
    """The graph of one shard, as one row; ``sparse`` are the places whose links within
    the shard end within a beam."""
    nodes = nodes.sort_by("node")
    vectors = unit(nodes.column("packed").to_pylist())
    graph = Graph.build(vectors)
    _, near = graph.search(vectors.astype(np.float32), BEAM)
    sparse = near[:, -1] < threshold - NEAR
    return pa.table(
        {
            "size": nodes.column("size").slice(0, 1),
            "shard": nodes.column("shard").slice(0, 1),
            "nodes": pa.array([nodes.column("node").to_pylist()], pa.list_(pa.int64())),
            "counts": pa.array([nodes.column("copies").to_pylist()], pa.list_(pa.int64())),
            "vectors": pa.array([vectors.tobytes()], pa.binary()),
            "graph": pa.array([graph.to_bytes()], pa.binary()),
            "sparse": pa.array([np.packbits(sparse).tobytes()], pa.binary()),
        }
    )


class ShardIndex:
    """A shard's graph with its vectors in double precision."""

    def __init__(self, row: dict):
        self.nodes = np.array(row["nodes"], np.int64)
        self.counts = np.array(row["counts"], np.int64)
        self.vectors = np.frombuffer(row["vectors"], np.float64).reshape(len(self.nodes), -1)
        self.graph = Graph.from_bytes(row["graph"], self.vectors)
        bits = np.frombuffer(row.get("sparse") or b"", np.uint8)
        self.sparse = np.unpackbits(bits, count=len(self.nodes)).astype(bool) if len(bits) else None

    def links(self, queries: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, place in the shard) with a cosine of ``threshold`` or more."""
        runs = [(np.empty(0, int), np.empty(0, int), True), *self.runs(queries, threshold)]
        return np.concatenate([r[0] for r in runs]), np.concatenate([r[1] for r in runs])

    def runs(
        self, queries: np.ndarray, threshold: float, scanned: list | None = None
    ) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """The same pairs in runs, each of which takes bounded memory, and whether they
        were found by a scan; ``scanned`` gets the queries that were answered so."""
        step = max(1, RUN_BYTES // self.vectors[:1].nbytes)
        for rows, places, by_scan in self.candidates(queries, threshold, scanned):
            for a in range(0, len(rows), step):
                row, place = rows[a : a + step], places[a : a + step]
                exact = np.einsum("ij,ij->i", queries[row], self.vectors[place])
                yield row[exact >= threshold], place[exact >= threshold], by_scan

    def candidates(
        self, queries: np.ndarray, threshold: float, scanned: list | None = None
    ) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        beam, left = BEAM, np.arange(len(queries))
        single = queries.astype(np.float32)
        audited = left[:: max(1, len(left) // AUDITED)]
        while len(left):
            if 2 * beam >= len(self.nodes):  # as cheap as the beam, and whole
                if scanned is not None:
                    scanned.extend(left.tolist())
                for part in parts(left, len(self.nodes)):
                    rows, places = self.scan(queries[part], threshold)
                    yield part[rows], places, True
                break
            again = []
            checked = np.isin(left, audited)
            if self._missed(queries, single, left[checked], beam, threshold):
                beam *= 2
                continue
            for part in parts(left, beam):
                ids, near = self.graph.search(single[part], beam)
                ends_above = (near[:, -1] >= threshold - NEAR) & (ids[:, -1] >= 0)
                hits, at = np.nonzero(
                    (near >= threshold - NEAR) & (ids >= 0) & ~ends_above[:, None]
                )
                yield part[hits], ids[hits, at], False
                again.append(part[ends_above])
            left, beam = np.concatenate(again), 2 * beam

    def scan(self, queries: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        return np.nonzero(queries @ self.vectors.T >= threshold)

    def _missed(
        self, queries: np.ndarray, single: np.ndarray, checked: np.ndarray, beam: int, threshold: float
    ) -> bool:
        """Whether the beams have too few of the links that end within them."""
        total = held = 0
        for part in parts(checked, max(beam, len(self.nodes))):
            ids, _ = self.graph.search(single[part], beam)
            rows, places = self.scan(queries[part], threshold)
            for i, size in enumerate(np.bincount(rows, minlength=len(part)).tolist()):
                if size < beam:  # the others are widened in any case
                    total += size
                    held += int(np.isin(places[rows == i], ids[i]).sum())
        return held < RECALL * total


def parts(left: np.ndarray, width: int) -> list[np.ndarray]:
    """``left`` in parts that take ``RUN`` values at a ``width`` for each, or one."""
    step = max(1, RUN // width)
    return [left[a : a + step] for a in range(0, len(left), step)]


class Fold:
    """Counts and a spanning forest of the links of a block, run by run."""

    def __init__(self, ids: np.ndarray, nodes: np.ndarray, counts: np.ndarray):
        self.ids, self.nodes, self.counts = ids, nodes, counts
        self.found = np.zeros(len(ids), np.int64)
        self.first = np.full(len(nodes), -1)  # the query that a place was first linked to
        self.met = np.zeros((len(ids), len(ids)), bool)  # queries with a place in common
        self.parent: dict[int, int] = {}
        self.left: list[int] = []
        self.right: list[int] = []

    def add(self, rows: np.ndarray, places: np.ndarray) -> None:
        other = self.nodes[places] != self.ids[rows]
        rows, places = rows[other], places[other]
        weights = self.counts[places]
        self.found += np.bincount(rows, weights, minlength=len(self.ids)).astype(np.int64)
        fresh = self.first[places] < 0
        self.first[places[fresh][::-1]] = rows[fresh][::-1]
        first = self.first[places]
        begins = fresh & (first == rows)
        self._join(self.ids[rows[begins]], self.nodes[places[begins]])
        news = np.flatnonzero(~begins & ~self.met[rows, first])  # the rest joins what is joined
        _, one = np.unique(rows[news] * len(self.ids) + first[news], return_index=True)
        news = news[one]
        self.met[rows[news], first[news]] = True
        self._join(self.ids[rows[news]], self.nodes[places[news]])

    def _root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    def _join(self, left: np.ndarray, right: np.ndarray) -> None:
        for x, y in zip(left.tolist(), right.tolist(), strict=True):
            rx, ry = self._root(x), self._root(y)
            if rx != ry:
                self.parent[rx] = ry
                self.left.append(x)
                self.right.append(y)


LINKS = "kind int, a bigint, b bigint, n bigint"
#: Of a row of links: the links that the search of ``a`` found, an edge of the forest,
#: that ``a`` was answered by a scan in shard ``b``, a link found from ``a``.
COUNT, EDGE, SCANNED, PAIR = range(4)


def links_found(*parts: tuple) -> pa.RecordBatch:
    """One batch of rows of several kinds: (kind, a, b, n), where b or n may be None."""
    sizes = [len(a) for _, a, _, _ in parts]
    kinds = np.repeat(np.array([p[0] for p in parts], np.int32), sizes)

    def column(i: int) -> pa.Array:
        return pa.concat_arrays(
            [
                pa.nulls(size, pa.int64()) if p[i] is None else pa.array(np.asarray(p[i], np.int64))
                for p, size in zip(parts, sizes, strict=True)
            ]
        )

    return pa.RecordBatch.from_arrays(
        [pa.array(kinds), column(1), column(2), column(3)], names=["kind", "a", "b", "n"]
    )


def shard_of(node: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(node), F.lit(shards)).cast("int")


def missed_links(found: DataFrame, nodes: DataFrame, shards: int) -> DataFrame:
    """``node`` and ``n``: the vectors of links that were found from their other end
    alone.  A node that was answered by a scan in the shard of the other has missed
    none there."""
    pairs = found.filter((F.col("kind") == PAIR) & (F.col("a") != F.col("b")))
    once = (
        pairs.groupBy(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
        .agg(F.min("a").alias("finder"), F.max("a").alias("other"))
        .filter("finder = other")
        .withColumn("node", F.col("low") + F.col("high") - F.col("finder"))
    )
    scanned = found.filter(F.col("kind") == SCANNED).select(
        F.col("a").alias("node"), F.col("b").cast("int").alias("shard")
    )
    missed = once.withColumn("shard", shard_of(F.col("finder"), shards)).join(
        scanned, ["node", "shard"], "left_anti"
    )
    copies = nodes.select(F.col("node").alias("finder"), F.col("copies").alias("n"))
    return missed.join(copies, "finder").select("node", "n")


def near_duplicates(
    vectors: DataFrame, held: Stored, threshold: float = 0.95,
    key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """One row per vector: ``key``, ``n_links`` (other vectors at ``threshold`` or
    more), ``component`` (lowest key reachable over links, its own included).

    A vector that is null, empty or zero or has a null or non-finite component
    links with nothing, and vectors of different length do not link.  Repeated
    rows and keys are vectors of their own; a component without any key is null.
    An empty table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    packed = held.keep(pack_vectors(vectors, key, vector))
    usable = packed.filter("packed IS NOT NULL")
    grouped = usable.groupBy("packed").agg(F.count("*").alias("copies"), F.min("key").alias("low"))
    nodes = held.keep(grouped.withColumn("node", F.monotonically_increasing_id()))
    size = nodes.agg(F.count("*").alias("n"), F.sum(F.octet_length("packed")).alias("bytes")).first()
    shards = max(1, min(SHARDS, size["n"] // LEAST_VECTORS), -(-(size["bytes"] or 0) // SHARD_BYTES))
    dealt = nodes.select(
        F.octet_length("packed").alias("size"),
        shard_of(F.col("node"), shards).alias("shard"),
        "node",
        "copies",
        "packed",
    )
    graphs = held.keep(
        dealt.groupBy("size", "shard").applyInArrow(
            lambda nodes: build_shard(nodes, threshold),
            "size int, shard int, nodes array<bigint>, counts array<bigint>, vectors binary, "
            "graph binary, sparse binary",
        )
    )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.sort_by("size")
            size = batch.column("size").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), len(size)]
            for a, z in zip(cuts, cuts[1:], strict=False):
                for start in range(a, z, BLOCK):
                    part = batch.slice(start, min(BLOCK, z - start))
                    ids = np.asarray(part.column("node")).astype(np.int64)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "size": pa.array([int(size[start])], pa.int32()),
                            "ids": pa.array([ids.tobytes()], pa.binary()),
                            "body": pa.array([b"".join(part.column("packed").to_pylist())], pa.binary()),
                        }
                    )

    queries = dealt.select("size", "node", "packed").mapInArrow(blocks, "size int, ids binary, body binary")
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    slices = F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1)))
    nothing = F.lit(None)
    asked = queries.withColumn("shard", every).select(
        "size",
        "shard",
        F.pmod(F.xxhash64("ids"), F.lit(SLICES)).cast("int").alias("slice"),
        F.lit(1).alias("kind"),
        "ids",
        "body",
        nothing.cast("array<bigint>").alias("nodes"),
        nothing.cast("array<bigint>").alias("counts"),
        nothing.cast("binary").alias("graph"),
        nothing.cast("binary").alias("sparse"),
    )
    served = graphs.withColumn("slice", slices).select(
        "size", "shard", "slice", F.lit(0).alias("kind"), nothing.cast("binary").alias("ids"),
        F.col("vectors").alias("body"), "nodes", "counts", "graph", "sparse",
    )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["kind"] == 0:  # sorted before the queries of its shard
                    index = ShardIndex({**row, "vectors": row["body"]})
                    place = (row["size"], row["shard"], row["slice"])
                    continue
                if index is None or place != (row["size"], row["shard"], row["slice"]):
                    continue  # the shard has no vector of this length
                ids = np.frombuffer(row["ids"], np.int64)
                width = row["size"]
                raw = row["body"]
                asked = unit([raw[a : a + width] for a in range(0, len(raw), width)])
                fold, scanned, pairs = Fold(ids, index.nodes, index.counts), [], []
                for rows, places, by_scan in index.runs(asked, threshold, scanned):
                    fold.add(rows, places)
                    if by_scan:
                        rows, places = rows[index.sparse[places]], places[index.sparse[places]]
                    pairs.append((ids[rows], index.nodes[places]))
                some = np.flatnonzero(fold.found)
                one, other = (np.concatenate([p[k] for p in pairs] or [ids[:0]]) for k in (0, 1))
                yield links_found(
                    (COUNT, ids[some], None, fold.found[some]),
                    (EDGE, fold.left, fold.right, None),
                    (SCANNED, ids[scanned], np.full(len(scanned), row["shard"]), None),
                    (PAIR, one, other, None),
                )

    units = served.unionByName(asked).repartition(
        shards * SLICES, "size", "shard", "slice"
    ).sortWithinPartitions("size", "shard", "slice", "kind")
    found = held.keep(units.mapInArrow(answer, LINKS))
    by_search = found.filter(F.col("kind") == COUNT).select(F.col("a").alias("node"), "n")
    credited = missed_links(found, nodes, shards)
    links = by_search.unionByName(credited).groupBy("node").agg(F.sum("n").alias("n"))
    edges = found.filter(F.col("kind") == EDGE)
    roots = components(edges.select("a", "b"), held)
    joined = (
        nodes.join(links, "node", "left")
        .join(roots, "node", "left")
        .select("packed", "low", "copies", "n", F.coalesce("root", "node").alias("root"))
    )
    lowest = joined.groupBy("root").agg(F.min("low").alias("component"))
    of_vector = joined.join(lowest, "root").select(
        "packed", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component"
    )
    return packed.join(of_vector, "packed", "left").select(
        "key",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("packed").isNull(), F.col("key")).otherwise(F.col("component")).alias("component"),
    )
