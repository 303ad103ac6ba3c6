"""Reports over the relational tables and the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.functions.checks import ratio

TRADING_DAYS = 252
WIDE = "decimal(38,0)"


def class_totals(members: DataFrame, series: DataFrame) -> DataFrame:
    """Value and units per class group and date, over the funds of the group.

    ``members``: fund_id, class_group_id.  ``series``: fund_id, record_date,
    aum_value, total_units.
    """
    grouped = members.filter(F.col("class_group_id").isNotNull())
    return (
        grouped.select("fund_id", "class_group_id")
        .join(series, "fund_id")
        .groupBy("class_group_id", "record_date")
        .agg(
            F.sum(F.col("aum_value").cast(WIDE)).alias("class_total_aum"),
            F.sum("total_units").alias("class_total_unit"),
            F.count("*").alias("n_classes"),
        )
    )


def unit_integrity(aum: DataFrame, nav: DataFrame) -> DataFrame:
    """Stated units against value divided by the price on the published date."""
    prices = nav.select("fund_id", F.col("record_date").alias("published_date"), "nav_value")
    derived = ratio(F.col("aum_value"), F.col("nav_value"))
    return (
        aum.join(prices, ["fund_id", "published_date"], "left")
        .withColumn("derived_units", derived)
        .withColumn("units_gap", F.abs(F.col("total_units") - F.col("derived_units")))
        .select(
            "fund_id", "record_date", "published_date", "total_units", "derived_units", "units_gap"
        )
    )


def category_volatility(
    facts: DataFrame, dim_category: DataFrame, dim_date: DataFrame, year: int
) -> DataFrame:
    """Yearly volatility and return per category; one-row groups, whose
    deviation is null, come first as null sorts high.

    Date keys of a year are one range, which prunes the stored facts.  The days
    of one year are at most 366 rows and are broadcast.
    """
    days = dim_date.filter(F.col("year") == year).select("date_id")
    in_year = F.col("date_id").between(year * 10000, year * 10000 + 9999)
    return (
        facts.filter(in_year)
        .join(F.broadcast(days), "date_id")
        .join(dim_category.select("category_id", "label"), "category_id")
        .groupBy("label")
        .agg(
            F.count_distinct("fund_id").alias("n_fund"),
            (F.stddev_samp("daily_return") * F.sqrt(F.lit(TRADING_DAYS))).alias("ann_volatility"),
            (F.avg("daily_return") * TRADING_DAYS).alias("ann_return"),
        )
        .orderBy(F.desc_nulls_first("ann_volatility"))
    )


def monthly_moments(facts: DataFrame, dim_category: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Mergeable state of the daily returns: count, mean and sum of squared deviations
    per label, month and bucket of funds, and a bitmap of the funds of the bucket.  One
    aggregate, combined before the shuffle; rows are as many as labels, months and
    buckets of 32,768 funds."""
    days = dim_date.select("date_id")
    labelled = facts.join(days, "date_id", "left_semi").join(
        dim_category.select("category_id", "label"), "category_id"
    )
    value = F.col("daily_return").cast("double")
    fund = F.col("fund_id").cast("bigint")
    n = F.count(value)
    return labelled.groupBy(
        "label",
        F.floor(F.col("date_id") / 100).cast("int").alias("month"),
        F.bitmap_bucket_number(fund).alias("bucket"),
    ).agg(
        n.alias("n"),
        F.avg(value).alias("mean"),
        (F.var_pop(value) * n).alias("m2"),
        F.bitmap_construct_agg(F.bitmap_bit_position(fund)).alias("funds"),
    )


def volatility_of_moments(moments: DataFrame, year: int) -> DataFrame:
    """As :func:`category_volatility`, from the states of any number of batches; no
    daily row is read again."""
    mine = moments.filter(F.col("month").between(year * 100 + 1, year * 100 + 12))
    mean = F.col("mean")
    buckets = mine.groupBy("label", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("funds")).alias("n_fund"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * mean).alias("total"),
        F.sum(F.coalesce("m2", F.lit(0.0)) + F.col("n") * F.coalesce(mean * mean, F.lit(0.0))).alias("squares"),
    )
    sums = buckets.groupBy("label").agg(
        *[F.sum(c).alias(c) for c in ("n_fund", "n", "total", "squares")]
    )
    n = F.col("n")
    average = F.col("total") / F.nullif(n, F.lit(0).cast("bigint"))
    spread = F.greatest(F.col("squares") - n * average * average, F.lit(0.0))
    deviation = F.sqrt(spread / F.nullif(n - 1, F.lit(0).cast("bigint")))
    return sums.select(
        "label",
        "n_fund",
        F.when(n > 1, deviation * F.sqrt(F.lit(TRADING_DAYS))).alias("ann_volatility"),
        (average * TRADING_DAYS).alias("ann_return"),
    ).orderBy(F.desc_nulls_first("ann_volatility"))


def totals_by_currency(amounts: DataFrame, currency: str, amount: str, by: list[str]) -> DataFrame:
    """Money adds up within one currency only, so the currency is a group key."""
    return amounts.groupBy(*by, currency).agg(
        F.sum(amount).alias("total"), F.count("*").alias("n_rows")
    )


def holders_of(
    code: str,
    securities: DataFrame,
    holdings: DataFrame,
    snapshots: DataFrame,
    funds: DataFrame,
) -> DataFrame:
    """Funds and dates that hold one instrument, or the instruments of one code.

    Their numbers are looked up first and become constants of the filter, which
    therefore reaches the files of the holdings; these are laid out by number.
    """
    wanted = [r["security_id"] for r in securities.filter(F.col("code") == code).collect()]
    return (
        holdings.filter(F.col("security_id").isin(wanted))
        .join(snapshots.select("snapshot_id", "fund_id", "date_based"), "snapshot_id")
        .join(funds.select("fund_id", "name"), "fund_id")
        .select("name", "date_based", "value_pct")
    )
