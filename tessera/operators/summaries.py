"""Group summaries, point lookups and top-k reports.

All aggregates are single-pass hash aggregates with a partial (map-side)
step, so a hot group key costs one row per map partition before the shuffle.
Top-k reports sort on a total order (value, then key) and end in ``limit``,
which Spark plans as ``TakeOrderedAndProject``: each partition keeps its own
k best rows and only those reach the final merge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.numeric import cube


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows, as a one-row DataFrame (column ``n``)."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def global_min_max(df: DataFrame, low_col: str, high_col: str) -> DataFrame:
    """Smallest ``low_col`` and largest ``high_col`` in one pass."""
    return df.agg(F.min(low_col).alias("min_value"), F.max(high_col).alias("max_value"))


def first_rows(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order (an unordered head is not
    deterministic across runs)."""
    return df.orderBy(*order_by).limit(n)


def yearly_extremes(
    df: DataFrame,
    date_col: str,
    low_col: str,
    high_col: str,
    names: tuple[str, str] = ("min_temperature", "max_temperature"),
) -> DataFrame:
    """Per year: min of ``low_col`` and max of ``high_col``, newest year first."""
    return (
        df.groupBy(F.year(date_col).alias("year"))
        .agg(F.min(low_col).alias(names[0]), F.max(high_col).alias(names[1]))
        .orderBy(F.desc("year"))
    )


def yearly_summary(
    df: DataFrame,
    date_col: str,
    low_col: str,
    high_col: str,
    mean_col: str,
    names: tuple[str, str, str, str] = ("min_temperature", "max_temperature", "entries", "avg_windspeed"),
) -> DataFrame:
    """Per year: min, max, number of rows and the mean rounded to 2 digits."""
    return df.groupBy(F.year(date_col).alias("year")).agg(
        F.min(low_col).alias(names[0]),
        F.max(high_col).alias(names[1]),
        F.count(F.lit(1)).alias(names[2]),
        F.round(F.avg(mean_col), 2).alias(names[3]),
    )


def year_point_lookups(
    df: DataFrame,
    date_col: str,
    low_col: str,
    high_col: str,
    mean_col: str,
    min_year: int,
    max_year: int,
    count_year: int,
    mean_year: int,
) -> DataFrame:
    """Four single-year figures (min in one year, max in another, row count
    in a third, rounded mean in a fourth) from one scan, as one row."""
    year = F.year(date_col)
    return df.agg(
        F.min(F.when(year == min_year, F.col(low_col))).alias("min_value"),
        F.max(F.when(year == max_year, F.col(high_col))).alias("max_value"),
        F.count_if(year == count_year).alias("entries"),
        F.round(F.avg(F.when(year == mean_year, F.col(mean_col))), 2).alias("avg_value"),
    )


def top_flagged_year(df: DataFrame, date_col: str, flag: Column) -> DataFrame:
    """The year with most rows where ``flag`` holds; a tie goes to the earlier
    year. Days flagged by another column alone do not count (pass exactly the
    condition that defines a counted day)."""
    return (
        df.filter(flag)
        .groupBy(F.year(date_col).alias("year"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc("year"))
        .limit(1)
    )


def value_frequency(df: DataFrame, column: str) -> DataFrame:
    """How often each value of ``column`` occurs (most frequent first)."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(column))


def daily_totals(df: DataFrame, day_col: str, quantity_col: str, price_col: str) -> DataFrame:
    """Sum of quantity * price per day, rounded to cents (``day``, ``total_sales``)."""
    return df.groupBy(F.col(day_col).alias("day")).agg(
        F.round(F.sum(F.col(quantity_col) * F.col(price_col)), 2).alias("total_sales")
    )


def best_days(df: DataFrame, day_col: str, quantity_col: str, price_col: str, k: int = 12) -> DataFrame:
    """The ``k`` days with the highest quantity * price; ties go to the earlier day."""
    return (
        daily_totals(df, day_col, quantity_col, price_col)
        .orderBy(F.desc("total_sales"), F.asc("day"))
        .limit(k)
    )


def top_products_weighted(
    df: DataFrame,
    product_col: str,
    year_col: str,
    month_col: str,
    quantity_col: str,
    price_col: str,
    year: int,
    double_month: int = 1,
    k: int = 8,
) -> DataFrame:
    """Top ``k`` products by sale value in one year, with the sales of
    ``double_month`` counted twice; ties go to the smaller product key."""
    sale = F.col(quantity_col) * F.col(price_col)
    weighted = F.when(F.col(month_col) == double_month, sale * 2).otherwise(sale)
    return (
        df.filter(F.col(year_col) == year)
        .groupBy(F.col(product_col).alias("product"))
        .agg(F.round(F.sum(weighted), 2).alias("total_sales"))
        .orderBy(F.desc("total_sales"), F.asc("product"))
        .limit(k)
    )


def yearly_totals(df: DataFrame, year_col: str, amount_col: str, out: str = "euros") -> DataFrame:
    """Sum of ``amount_col`` per year (several sources may report one year)."""
    return df.groupBy(F.col(year_col).alias("year")).agg(F.sum(amount_col).alias(out))


def total_for_year(totals: DataFrame, year: int) -> DataFrame:
    return totals.filter(F.col("year") == year)


def best_year(totals: DataFrame, value_col: str = "euros") -> DataFrame:
    """The year with the largest total; a tie goes to the earlier year."""
    return totals.orderBy(F.desc(value_col), F.asc("year")).limit(1)


def leader_yearly_sales(
    sales: DataFrame,
    group_col: str,
    year_col: str,
    lead_col: str,
    total_col: str,
    first_year: int,
    last_year: int,
) -> DataFrame:
    """The group (e.g. publisher) with the largest ``lead_col`` sum over the
    year range, then its yearly ``lead_col`` and ``total_col`` sums
    (``publisher``, ``year``, ``eu_total``, ``global_total``).

    One scan and one shuffle: a single aggregate per group computes the
    range total and, for each year of the range, a row count and the two
    sums (conditional aggregates; their number is fixed by the range, not by
    the data, and partial aggregation collapses a hot group on the map side).
    The leader is a top-1 over groups (``TakeOrderedAndProject``) and its
    year columns are unpivoted into rows. Nothing is fetched to the driver
    and the input is not scanned twice."""
    if last_year < first_year:
        raise ValueError(f"empty year range {first_year}..{last_year}")
    years = list(range(first_year, last_year + 1))
    y = F.col(year_col)
    aggs = [F.sum(lead_col).alias("_lead_sum")]
    for yr in years:
        hit = y == yr
        aggs += [
            F.count_if(hit).alias(f"_n{yr}"),
            F.sum(F.when(hit, F.col(lead_col))).alias(f"_l{yr}"),
            F.sum(F.when(hit, F.col(total_col))).alias(f"_t{yr}"),
        ]
    per_group = (
        sales.filter(y.between(first_year, last_year)).groupBy(F.col(group_col).alias("publisher")).agg(*aggs)
    )
    leader = per_group.orderBy(F.desc(F.round("_lead_sum", 2)), F.asc("publisher")).limit(1)
    year_rows = F.array(
        *[
            F.struct(
                F.lit(yr).alias("year"),
                F.col(f"_n{yr}").alias("n"),
                F.col(f"_l{yr}").alias("lead"),
                F.col(f"_t{yr}").alias("total"),
            )
            for yr in years
        ]
    )
    return (
        leader.select("publisher", F.inline(year_rows))
        .filter(F.col("n") > 0)
        .select(
            "publisher",
            "year",
            F.round("lead", 2).alias("eu_total"),
            F.round("total", 2).alias("global_total"),
        )
    )


def sum_of_cubes(df: DataFrame, column: str) -> DataFrame:
    """Sum of x*x*x over a column, in 64-bit integers."""
    x = F.col(column).cast("bigint")
    return df.agg(F.sum(cube(x)).alias("sum_of_cubes"))
