"""Published tables: Parquet folders plus a small list of the valid ones.

A batch writes new folders and then adds one line to the list.  Readers follow
the newest line, so they see all of a batch or none of it.  Tables of the
insert-if-absent kind grow by a folder of new rows.  Tables whose contract names
a slice, such as a month or a range of keys, have a folder per slice, and a batch
writes those it touches anew; the others stay.  Other tables are replaced.

The line also holds the last batch of each stream that was loaded, so a stream
batch and the note that it is done become visible together.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dimflow.contracts import CONTRACTS, TableContract
from dimflow.session import empty_table, shuffle_long

LINE = "seq bigint, batch string, folders string, counts string, slices string, streams string"
STAGE_LINE = (
    "seq bigint, batch string, number int, stage string, folders string, counts string, slices string, "
    "streams string, added string"
)
NO_SLICE = "none"  # of a row whose slice is null


def slice_of(contract: TableContract) -> Column:
    """Slice of a row, as text."""
    return F.coalesce(F.expr(contract.slice).cast("string"), F.lit(NO_SLICE))


class Published:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._list = f"{self.root}/published"
        self._stages = f"{self.root}/stages"
        self.seq, newest = self._newest()
        self.folders: dict[str, list[str]] = newest.get("folders", {})
        self.counts: dict[str, int] = newest.get("counts", {})
        #: folder and number of rows by table and slice
        self.slices: dict[str, dict[str, list]] = newest.get("slices", {})
        self.streams: dict[str, int] = newest.get("streams", {})
        self.added: dict[str, str] = {}
        self._noted = 0  # stages of the batch that is being written

    def _newest(self) -> tuple[int, dict]:
        try:
            lines = self.spark.read.schema(LINE).json(self._list)
            newest = lines.orderBy(F.desc("seq")).first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            newest = None
        if newest is None:
            return 0, {}
        parts = ("folders", "counts", "slices", "streams")
        return newest["seq"], {k: json.loads(newest[k]) for k in parts if newest[k]}

    def read(self, name: str) -> DataFrame:
        """The table as this object sees it, including what it has written."""
        return self._read(name, self.folders.get(name))

    def read_side(self, name: str) -> DataFrame:
        """The table as a side of a join that is shuffled where its rows are too many
        to be broadcast, however small its files are."""
        return shuffle_long(self.read(name), self.counts.get(name, 0))

    def _read(self, name: str, folders: list[str] | None) -> DataFrame:
        schema = CONTRACTS[name].schema
        if not folders:
            return empty_table(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def _folder(self, name: str, batch: str) -> str:
        """A folder that the table does not hold yet: a batch may write twice to a table.
        What a failed run has left in it is overwritten."""
        folder = f"{self.root}/tables/{name}/v{self.seq + 1:06d}-{batch}"
        held = self.folders.get(name, [])
        while any(f == folder or f.startswith(f"{folder}/") for f in held):
            folder += "+"
        return folder

    def _write(self, contract: TableContract, df: DataFrame, batch: str) -> tuple[str, int]:
        folder = self._folder(contract.name, batch)
        counted = Observation()
        layout = list(contract.layout)
        (
            df.select(*contract.schema.fieldNames())
            .repartitionByRange(*layout)
            .sortWithinPartitions(*layout)
            .observe(counted, F.count(F.lit(1)).alias("n"))
            .write.mode("overwrite")
            .parquet(folder)
        )
        return folder, counted.get["n"]

    def replace(self, name: str, df: DataFrame, batch: str) -> int:
        contract = CONTRACTS[name]
        if contract.slice:
            held, self.slices[name] = self.folders.get(name, []), {}
            n = self._write_slices(contract, df, batch)
            self.folders[name] = [f for f in self.folders[name] if f not in held]
            self.counts[name] = n
            return n
        folder, n = self._write(contract, df, batch)
        self.folders[name], self.counts[name] = [folder], n
        return n

    def append(self, name: str, df: DataFrame, batch: str) -> int:
        """Add a folder of new rows; an empty batch adds nothing."""
        folder, n = self._write(CONTRACTS[name], df, batch)
        if n:
            self.folders[name] = [*self.folders.get(name, []), folder]
            self.counts[name] = self.counts.get(name, 0) + n
            self.added[name] = folder
        return n

    def touched(self, name: str, rows: DataFrame) -> list[str]:
        """Slices of the table that the rows belong to.  Call it on stored rows."""
        found = rows.select(slice_of(CONTRACTS[name]).alias("slice")).distinct().collect()
        return sorted(r["slice"] for r in found)

    def read_slices(self, name: str, slices: list[str]) -> DataFrame:
        """The rows of some slices; no other folder is read."""
        self._slice_old_table(name)
        held = self.slices.get(name, {})
        parts = [held[s] for s in slices if s in held]
        return shuffle_long(self._read(name, [p[0] for p in parts]), sum(p[1] for p in parts))

    def replace_slices(self, name: str, slices: list[str], df: DataFrame, batch: str) -> int:
        """Write the given slices anew; ``df`` has all their rows and no others."""
        self._slice_old_table(name)
        held = self.slices.setdefault(name, {})
        n = self._write_slices(CONTRACTS[name], df, batch, [s for s in slices if s in held])
        self.counts.setdefault(name, 0)
        return n

    def _write_slices(
        self, contract: TableContract, df: DataFrame, batch: str, gone: list[str] | None = None
    ) -> int:
        """Write rows by slice, then take out the slices that are ``gone``."""
        name, layout = contract.name, list(contract.layout)
        folder = self._folder(name, f"{batch}-slices")
        columns = contract.schema.fieldNames()
        (
            df.select(*columns, slice_of(contract).alias("_slice"))
            .repartitionByRange("_slice", *layout)
            .sortWithinPartitions("_slice", *layout)
            .write.mode("overwrite")
            .partitionBy("_slice")
            .parquet(folder)
        )
        shape = contract.schema.add("_slice", "string")
        counted = self.spark.read.schema(shape).parquet(folder).groupBy("_slice").count().collect()
        fresh = {r["_slice"]: [f"{folder}/_slice={r['_slice']}", r["count"]] for r in counted}
        held = dict(self.slices.get(name, {}))
        lost = [held.pop(s) for s in gone or ()]
        self.slices[name] = {**held, **fresh}
        old = {part[0] for part in lost}
        kept = [f for f in self.folders.get(name, []) if f not in old]
        self.folders[name] = kept + [part[0] for part in fresh.values()]
        n = sum(part[1] for part in fresh.values())
        self.counts[name] = self.counts.get(name, 0) + n - sum(part[1] for part in lost)
        return n

    def _slice_old_table(self, name: str) -> None:
        """Slice a table that was written whole, once."""
        if self.folders.get(name) and name not in self.slices:
            self.replace(name, self.read(name), "sliced")

    def read_added(self, name: str) -> DataFrame | None:
        """The rows that this object has appended to the table, if any."""
        if name not in self.added:
            return None
        return self.spark.read.schema(CONTRACTS[name].schema).parquet(self.added[name])

    def compact(self, name: str, batch: str) -> int:
        """Rewrite a table that has grown by many small folders as one, or as one
        folder per slice."""
        return self.replace(name, self.read(name), batch)

    def note(self, batch: str, stage: str) -> None:
        """Remember that a stage of a batch is done, with all that it has written; what
        readers see does not change."""
        self._noted += 1
        parts = (self.folders, self.counts, self.slices, self.streams, self.added)
        line = (self.seq, batch, self._noted, stage, *map(json.dumps, parts))
        self.spark.createDataFrame([line], STAGE_LINE).coalesce(1).write.mode("append").json(self._stages)

    def resume(self, batch: str) -> set[str]:
        """Go on from the last stage noted of a batch that was not published; returns
        the stages that are done.  Notes from before another batch was published do
        not count, as its folders are not in them."""
        try:
            notes = self.spark.read.schema(STAGE_LINE).json(self._stages)
            found = notes.filter((F.col("batch") == batch) & (F.col("seq") == self.seq)).collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            found = []
        if not found:
            return set()
        last = max(found, key=lambda r: r["number"])
        self._noted = last["number"]
        parts = (json.loads(last[p]) for p in ("folders", "counts", "slices", "streams", "added"))
        self.folders, self.counts, self.slices, self.streams, self.added = parts
        return {r["stage"] for r in found}

    def publish(self, batch: str, stream: str | None = None, number: int = 0) -> None:
        """Make everything written so far visible, in one line, and with it that a
        batch of a stream is done."""
        self.seq += 1
        if stream is not None:
            self.streams[stream] = number
        state = (self.folders, self.counts, self.slices, self.streams)
        line = (self.seq, batch, *map(json.dumps, state))
        self.spark.createDataFrame([line], LINE).coalesce(1).write.mode("append").json(self._list)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every table, in one plan."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    total = counts[0]
    for part in counts[1:]:
        total = total.unionByName(part)
    return total
