"""Landing folders, subsets and pending work."""

from __future__ import annotations

from datetime import datetime
from uuid import uuid4

from pyspark.sql import functions as F

from dimflow.session import shared_folder
from dimflow.sources import attempts
from dimflow.sources import documents as docs
from dimflow.sources.published import Published
from dimflow.streaming.loading import load_batch, load_stream
from workload.tables import cents, day, query

YEARS = list(range(1995, 2002))


@query(
    """
    SELECT REGEXP_EXTRACT(url, '//[^/]+/([a-z]+)/', 1) AS source,
           CASE WHEN url LIKE '%?%' THEN 'empty' WHEN url LIKE '%#%' THEN 'null'
                WHEN url LIKE 'https:%' THEN 'failed' WHEN url LIKE '%.net%' THEN 'unreadable'
                ELSE 'data' END AS status,
           CAST(COUNT(*) AS BIGINT) AS n_documents
    FROM pages GROUP BY 1, 2
    """
)
def landing_status(t):
    """Pages as landed documents: arrays, nulls, error notes, raw markup, objects."""
    url = F.col("url")
    body = (
        F.when(url.contains("?"), F.lit("[]"))
        .when(url.contains("#"), F.lit("null"))
        .when(url.startswith("https:"), F.to_json(F.struct(F.col("url").alias("_error"))))
        .when(url.contains(".net"), F.col("html"))
        .otherwise(F.to_json(F.struct("page_id", "html")))
    )
    landed = t.pages.select("url", body.alias("body"))
    return docs.landing_status(landed, F.regexp_extract("url", "//[^/]+/([a-z]+)/", 1))


@query(
    f"""
    SELECT c_custkey, CAST(year AS INTEGER) AS year
    FROM customer, (SELECT UNNEST({YEARS}) AS year)
    ANTI JOIN (SELECT o_custkey, YEAR(o_orderdate) AS y FROM orders)
      ON o_custkey = c_custkey AND y = year
    """
)
def pending_ids(t):
    """Customer and year pairs without an order."""
    wanted = docs.expected_keys(t.customer.select("c_custkey"), YEARS, "year")
    landed = t.orders.select(
        F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year")
    )
    return docs.pending(wanted, landed.distinct(), ["c_custkey", "year"])


@query(
    """
    SELECT o_custkey, o_orderkey FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT 20)
    """
)
def load_subset(t):
    """A trial run takes the first entities and all that belongs to them."""
    first = docs.first_entities(t.customer, ["c_custkey"], 20)
    entities = first.select(F.col("c_custkey").alias("o_custkey"))
    return docs.of_entities(t.orders.select("o_custkey", "o_orderkey"), "o_custkey", entities)


@query(
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
    WHERE o_orderdate BETWEEN DATE '1996-03-01' AND DATE '1997-02-28'
    """
)
def date_range_scan(t):
    found = docs.in_range(t.orders, "o_orderdate", "1996-03-01", "1997-02-28")
    return found.select("o_orderkey", day("o_orderdate").alias("o_orderdate"))


WAVES = ("o_orderdate < '1998-01-01'", "o_orderdate >= '1997-01-01'")
MONTHS_SQL = """
    SELECT o_custkey, CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS month,
           SUM(CAST(ROUND(o_totalprice, 2) AS DECIMAL(18, 2))) AS aum, COUNT(*) AS n
    FROM orders WHERE {wave} GROUP BY 1, 2
"""


@query(
    f"""
    WITH first AS ({MONTHS_SQL.format(wave=WAVES[0])}), second AS ({MONTHS_SQL.format(wave=WAVES[1])})
    SELECT CAST(o_custkey AS INTEGER) AS manager_id, month AS record_date,
           CAST(aum * 100 AS BIGINT) AS cents, CAST(n AS BIGINT) AS n_orders, 1 AS loaded_by
    FROM first
    UNION ALL
    SELECT CAST(o_custkey AS INTEGER), month, CAST(aum * 100 AS BIGINT), CAST(n AS BIGINT), 2
    FROM second ANTI JOIN first USING (o_custkey, month)
    """
)
def stream_load(t):
    """Documents land in two waves, and the stream is read after each; then the second
    batch is handed over once more.  The waves share a year, in which the first stands."""
    base = f"{shared_folder(t.spark)}/{uuid4().hex}"
    options = {
        "stream": "amounts", "source": "manager_aum", "work": f"{base}/work", "root": f"{base}/root",
    }
    for n, wave in enumerate(WAVES):
        months = (
            t.orders.filter(wave)
            .groupBy("o_custkey", F.trunc("o_orderdate", "month").alias("month"))
            .agg(F.sum(cents("o_totalprice")).alias("aum"), F.count("*").alias("n"))
        )
        row = F.struct(
            F.date_format("month", "yyyy-MM-dd'T'HH:mm:ss").alias("Date"),
            F.col("aum").alias("Aum"),
            F.col("n").alias("TotalUnit"),
        )
        key = F.col("o_custkey").cast("string")
        documents = months.groupBy("o_custkey").agg(F.to_json(F.sort_array(F.collect_list(row))).alias("body"))
        documents = documents.select(
            F.concat(key, F.lit(".json")).alias("file_name"), key.alias("file_key"), "body"
        )
        documents.write.mode("append").parquet(f"{base}/landed")
        stream = docs.landed_stream(t.spark, f"{base}/landed")
        load_stream(stream, f"{base}/progress", batch_ts=datetime(2024, 2, n + 1), **options)
    again = load_batch(documents, 1, batch_ts=datetime(2024, 2, 3), **options)
    assert not again
    found = Published(t.spark, f"{base}/root").read("manager_aum_record")
    return found.select(
        "manager_id",
        "record_date",
        (F.col("aum_value") * 100).cast("bigint").alias("cents"),
        F.col("total_units").cast("bigint").alias("n_orders"),
        F.dayofmonth("scraped_at").alias("loaded_by"),
    )


@query(
    """
    WITH told AS (
        SELECT c_custkey, CASE c_nationkey % 4 WHEN 0 THEN 'empty' WHEN 1 THEN 'failed' ELSE 'fetched' END
                 AS outcome, c_nationkey % 5 AS part FROM customer),
    first AS (
        SELECT c_custkey, CASE WHEN part = 4 THEN 'missing' ELSE outcome END AS outcome
        FROM told WHERE part >= 2),
    second AS (
        SELECT told.c_custkey, CASE WHEN first.outcome IN ('fetched', 'empty') THEN 'skipped'
                 WHEN told.outcome = 'failed' AND first.outcome = 'failed' THEN 'fetched'
                 ELSE told.outcome END AS outcome
        FROM told LEFT JOIN first USING (c_custkey)),
    newest AS (
        SELECT c_custkey, CASE WHEN second.outcome = 'skipped' THEN first.outcome
                 ELSE second.outcome END AS outcome
        FROM second LEFT JOIN first USING (c_custkey))
    SELECT run, outcome, CAST(COUNT(*) AS BIGINT) AS n_keys FROM (
        SELECT 'first' AS run, outcome FROM first UNION ALL SELECT 'second', outcome FROM second
        UNION ALL SELECT 'newest', outcome FROM newest) GROUP BY 1, 2
    """
)
def landing_attempts(t):
    """Two runs over the customers, the first over some of them.  The second takes what
    is new, missing or failed, and what failed before is answered then."""
    log = f"{shared_folder(t.spark)}/{uuid4().hex}"
    nation = F.col("c_nationkey")
    keys = t.customer.select(
        F.lit("customers").alias("source"), F.col("c_custkey").cast("string").alias("file_key"), nation
    )
    body = (
        F.when(nation % 4 == 0, F.lit("[]"))
        .when(nation % 4 == 1, F.lit('{"_error": "timeout"}'))
        .otherwise(F.lit('[{"Id": 1}]'))
    )
    first = keys.filter(nation % 5 >= 2)
    landed = first.filter(nation % 5 != 4).withColumn("body", body)
    attempts.record_run(first, landed, log, "first", datetime(2024, 2, 1))
    failed_before = (nation % 4 == 1) & (nation % 5).isin(2, 3)
    landed = keys.withColumn("body", F.when(failed_before, F.lit('[{"Id": 1}]')).otherwise(body))
    for _ in range(2):  # a run that is recorded again adds nothing
        attempts.record_run(keys, landed, log, "second", datetime(2024, 2, 2), retry=True)
    made = attempts.read_attempts(t.spark, log)
    newest = attempts.newest_states(made).groupBy("outcome").agg(F.count("*").alias("n_keys"))
    counts = attempts.attempt_counts(made).select("run", "outcome", "n_keys")
    return counts.unionByName(newest.select(F.lit("newest").alias("run"), "outcome", "n_keys"))
