"""Landed documents to clean tables, one Parquet folder each."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.operators import shred
from dimflow.session import run_together, shuffle_long
from dimflow.sources import documents as docs

# Which landed sources each clean table is made from.
TABLE_SOURCES = {
    "investment_manager": {"managers"},
    "manager_personnel": {"managers"},
    "manager_shareholder": {"managers"},
    "manager_aum_record": {"manager_aum"},
    "custodian_bank": {"banks"},
    "sales_company": {"sales"},
    "mutual_fund": {"fund_index", "snapshot", "products"},
    "fund_class": {"fund_index", "snapshot", "products"},
    "nav_record": {"snapshot"},
    "aum_record": {"snapshot"},
    "fund_performance": {"snapshot"},
    "fund_ranking": {"snapshot"},
    "benchmark": {"snapshot"},
    "benchmark_data_point": {"snapshot"},
    "fund_benchmark": {"snapshot"},
    "portfolio_snapshot": {"portfolio"},
    "asset_category": {"portfolio"},
    "security": {"portfolio"},
    "portfolio_allocation": {"portfolio"},
    "portfolio_holding": {"portfolio"},
    "fund_quarterly_return": {"quarterly"},
    "fund_sales_company": {"sales_companies"},
}

# Which sources a scheduled run lands anew.
SCOPES = {
    "daily": {"snapshot"},
    "monthly": {"manager_aum", "products", "portfolio", "quarterly"},
    "master": {"managers", "banks", "sales", "fund_index", "sales_companies"},
}
SCOPES["full"] = set().union(*SCOPES.values())


def tables_of(scope: str) -> list[str]:
    """Clean tables that a run of this scope has to make again."""
    return [name for name, sources in TABLE_SOURCES.items() if sources & SCOPES[scope]]


class Clean:
    """Writer and reader of the clean tables of one run."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.counts: dict[str, int] = {}
        self.rejects: dict[str, int] = {}
        self._schemas: dict[str, T.StructType] = {}  # of the tables that this object has written

    def save(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table, count it on the way and return it as read back."""
        seen = Observation()
        bad = F.col("reject_reason").isNotNull() if "reject_reason" in df.columns else F.lit(False)
        counted = df.observe(
            seen, F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("rejects")
        )
        counted.write.mode("overwrite").parquet(f"{self.root}/{name}")
        self.counts[name] = seen.get["rows"] - seen.get["rejects"]
        self.rejects[name] = seen.get["rejects"]
        self._schemas[name] = df.schema
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name in self._schemas:
            reader = reader.schema(self._schemas[name])
        return reader.parquet(f"{self.root}/{name}")


class Documents:
    """Parsed documents of a landing folder, restricted to a subset of funds
    when ``subset`` gives their number.  ``landed`` names the folder of the tables
    that hold the documents, where these have been stored as such; a master without a
    table there is read from its file."""

    def __init__(
        self,
        spark: SparkSession,
        raw: str,
        clean: Clean,
        subset: int | None,
        rating_field: str,
        landed: str | None = None,
    ):
        self.spark = spark
        self.raw = raw.rstrip("/")
        self.landed = landed and landed.rstrip("/")
        self.rating_field = rating_field
        index = shred.real_funds(self._master("fund_index", shred.FUND_INDEX))
        index = docs.first_entities(index, ["pos"], subset) if subset else index
        # Stored, so that it is parsed once and its rows are known.
        stored = clean.save("parsed_fund_index", index)
        self.n_funds = clean.counts["parsed_fund_index"]
        self.fund_index = shuffle_long(stored, self.n_funds)
        self.valid = self.fund_index.select(F.col("Id").alias("fund_id"))
        self._subset = subset

    def _master(self, name: str, shape: str) -> DataFrame:
        found = self.landed and docs.landed_table(self.spark, f"{self.landed}/{name}")
        if not found:
            found = docs.read_documents(self.spark, f"{self.raw}/{name}.json")
        return docs.parse_arrays(found, shape)

    def _folder(self, name: str) -> DataFrame:
        if self.landed:
            return docs.read_landed(self.spark, f"{self.landed}/{name}")
        return docs.read_documents(self.spark, f"{self.raw}/{name}")

    def _of_subset(self, found: DataFrame) -> DataFrame:
        if not self._subset:
            return found
        keyed = found.withColumn("fund_id", F.col("file_key").try_cast("int"))
        return keyed.join(self.valid, "fund_id", "left_semi").drop("fund_id")

    def managers(self) -> DataFrame:
        return self._master("managers", shred.MANAGERS)

    def banks(self) -> DataFrame:
        return self._master("banks", shred.BANKS)

    def sales(self) -> DataFrame:
        return self._master("sales", shred.SALES_COMPANIES)

    def manager_aum(self) -> DataFrame:
        return docs.parse_arrays(self._folder("manager_aum"), shred.MANAGER_AUM)

    def products(self) -> DataFrame:
        return docs.parse_arrays(self._folder("products"), shred.PRODUCTS)

    def snapshots(self) -> DataFrame:
        found = self._of_subset(self._folder("snapshot"))
        return docs.parse_objects(found, shred.snapshot_shape(self.rating_field))

    def portfolios(self) -> DataFrame:
        found = self._of_subset(self._folder("portfolio"))
        return docs.parse_arrays(found, shred.PORTFOLIO)

    def quarterly(self) -> DataFrame:
        return docs.parse_arrays(self._folder("quarterly"), shred.QUARTERLY)

    def fund_sales(self) -> DataFrame:
        return docs.parse_arrays(self._folder("sales_companies"), shred.FUND_SALES)


def snapshot_jobs(snapshots: DataFrame, rating_field: str) -> dict:
    """Builders of the tables that come from fund snapshots alone."""
    mentions = shred.fund_benchmarks(snapshots)
    return {
        "nav_record": lambda: shred.nav(snapshots),
        "aum_record": lambda: shred.aum(snapshots),
        "fund_performance": lambda: shred.performance(snapshots),
        "fund_ranking": lambda: shred.ranking(snapshots, rating_field),
        "benchmark": lambda: shred.benchmarks(mentions),
        "benchmark_data_point": lambda: shred.benchmark_points(mentions),
        "fund_benchmark": lambda: shred.benchmark_links(mentions),
    }


def portfolio_jobs(clean: Clean, portfolios: DataFrame, valid: DataFrame) -> dict:
    """Builders of the tables that come from portfolios."""
    nested = clean.save("parsed_portfolio", shred.portfolio_snapshots(portfolios, valid))
    lines = clean.save("portfolio_line", shred.portfolio_lines(nested))
    return {
        "portfolio_snapshot": lambda: nested.drop("Assets"),
        "asset_category": lambda: shred.categories(lines),
        "security": lambda: shred.securities(lines),
        "portfolio_allocation": lambda: shred.allocations(lines),
        "portfolio_holding": lambda: shred.holdings(lines),
    }


def transform_documents(
    documents: DataFrame, source: str, clean: Clean, valid: DataFrame, rating_field: str | None = None
) -> list[str]:
    """Make the clean tables of the given documents of one folder, for the funds in
    ``valid``; returns their names.  The masters, and what needs the fund index, are
    left to :func:`transform`."""
    if source == "snapshot":
        parsed = docs.parse_objects(documents, shred.snapshot_shape(rating_field))
        jobs = snapshot_jobs(clean.save("parsed_snapshot", parsed), rating_field)
    elif source == "portfolio":
        jobs = portfolio_jobs(clean, docs.parse_arrays(documents, shred.PORTFOLIO), valid)
    elif source == "quarterly":
        found = docs.parse_arrays(documents, shred.QUARTERLY)
        jobs = {"fund_quarterly_return": lambda: shred.quarterly_returns(found, valid)}
    elif source == "manager_aum":
        found = docs.parse_arrays(documents, shred.MANAGER_AUM)
        jobs = {"manager_aum_record": lambda: shred.manager_aum(found)}
    elif source == "sales_companies":
        found = docs.parse_arrays(documents, shred.FUND_SALES)
        jobs = {"fund_sales_company": lambda: shred.fund_sales(found, valid)}
    else:
        raise ValueError(f"no tables are made from {source} alone")
    run_together([partial(_save, clean, name, job) for name, job in jobs.items()])
    return list(jobs)


def transform(
    spark: SparkSession,
    raw: str,
    clean: Clean,
    scope: str = "full",
    subset: int | None = None,
    *,
    rating_field: str,
    landed: str | None = None,
) -> list[str]:
    """Make the clean tables of a scope; returns their names.

    With ``landed``, the many small documents come from the tables in that folder,
    one per source, that :mod:`dimflow.streaming.landing` keeps, and no folder of
    files is listed.

    The folders of many small documents are parsed once into Parquet
    (``parsed_…``); every table that is made from them reads only its own
    nested columns of that.
    """
    found = Documents(spark, raw, clean, subset, rating_field, landed)
    names = tables_of(scope)
    wanted = set(names)

    def save_all(jobs: dict) -> None:
        run_together([partial(_save, clean, n, job) for n, job in jobs.items() if n in wanted])

    def from_masters() -> None:
        save_all(
            {
                "investment_manager": lambda: shred.managers(found.managers()),
                "manager_personnel": lambda: shred.personnel(found.managers()),
                "manager_shareholder": lambda: shred.shareholders(found.managers()),
                "manager_aum_record": lambda: shred.manager_aum(found.manager_aum()),
                "custodian_bank": lambda: shred.banks(found.banks()),
                "sales_company": lambda: shred.sales_companies(found.sales()),
                "fund_quarterly_return": lambda: shred.quarterly_returns(
                    found.quarterly(), found.valid
                ),
                "fund_sales_company": lambda: shred.fund_sales(found.fund_sales(), found.valid),
            }
        )

    def from_snapshots() -> None:
        if not wanted & _made_from("snapshot", "fund_index", "products"):
            return
        snapshots = clean.save("parsed_snapshot", found.snapshots())
        save_all(
            {
                "mutual_fund": lambda: shred.funds(
                    found.fund_index,
                    snapshots,
                    shuffle_long(shred.class_map(found.products()), found.n_funds),
                ),
                **snapshot_jobs(snapshots, rating_field),
            }
        )
        save_all({"fund_class": lambda: shred.fund_classes(clean.read("mutual_fund"))})

    def from_portfolios() -> None:
        if not wanted & _made_from("portfolio"):
            return
        save_all(portfolio_jobs(clean, found.portfolios(), found.valid))

    run_together([from_snapshots, from_portfolios, from_masters])
    return names


def _save(clean: Clean, name: str, build) -> None:
    clean.save(name, build())


def _made_from(*sources: str) -> set[str]:
    return {name for name, made_from in TABLE_SOURCES.items() if made_from & set(sources)}


def line_report(clean: Clean) -> DataFrame:
    """Portfolio lines that became neither an allocation nor a holding, by reason."""
    return shred.dropped_lines(clean.read("portfolio_line"))


FOLDERS = ("manager_aum", "products", "snapshot", "portfolio", "quarterly", "sales_companies")
MASTERS = ("managers", "banks", "sales", "fund_index")


def landing_report(spark: SparkSession, raw: str) -> DataFrame:
    """Number of landed documents per folder or master file and status; a master
    file that has not landed is ``missing``."""
    raw = raw.rstrip("/")
    parts = [
        docs.landing_status(docs.read_documents(spark, f"{raw}/{name}"), F.lit(name))
        for name in FOLDERS
    ]
    for name in MASTERS:
        found = docs.landing_status(docs.read_documents(spark, f"{raw}/{name}.json"), F.lit(name))
        absent = spark.range(1).select(
            F.lit(name).alias("source"), F.lit("missing").alias("status"), F.lit(1).alias("n_documents")
        )
        parts.append(found.unionByName(absent.join(found.select("source"), "source", "left_anti")))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


# The master whose ids name the documents of a folder.
NAMED_BY = {
    "manager_aum": "managers",
    "products": "managers",
    "snapshot": "fund_index",
    "portfolio": "fund_index",
}


def pending_documents(
    spark: SparkSession, raw: str, folder: str, force: bool = False
) -> DataFrame:
    """Ids whose document has not landed in ``folder`` yet."""
    raw = raw.rstrip("/")
    master = docs.read_documents(spark, f"{raw}/{NAMED_BY[folder]}.json")
    ids = docs.parse_arrays(master, "Id int").select(F.col("Id").alias("id")).distinct()
    landed = docs.read_documents(spark, f"{raw}/{folder}").select(
        F.col("file_key").try_cast("int").alias("id")
    )
    return docs.pending(ids, landed, ["id"], force)


def pending_quarters(
    spark: SparkSession,
    raw: str,
    force: bool = False,
    years: tuple[int, ...] = docs.QUARTERLY_YEARS,
) -> DataFrame:
    """Fund and year pairs whose quarterly document has not landed yet."""
    raw = raw.rstrip("/")
    index = docs.read_documents(spark, f"{raw}/fund_index.json")
    ids = docs.parse_arrays(index, "Id int").select(F.col("Id").alias("fund_id"))
    entity, period = docs.composite_key(F.col("file_key"))
    landed = docs.read_documents(spark, f"{raw}/quarterly").select(
        entity.alias("fund_id"), period.alias("year")
    )
    wanted = docs.expected_keys(ids, list(years), "year")
    return docs.pending(wanted, landed, ["fund_id", "year"], force)
