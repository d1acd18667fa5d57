"""Summaries and top-k on inline goldens and hand-made rows."""

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import functions as F

from tessera.operators import summaries
from tessera.sources.files import literal_rows


@dataclass
class Sales:
    year: int
    euros: int


# The reference's two inline sales lists and their goldens.
SALES = [(2015, 325), (2016, 100), (2017, 15), (2018, 900), (2019, 50), (2020, 750), (2021, 950), (2022, 400)]
MULTI_SALES = SALES + [
    (2016, 250), (2017, 600), (2019, 75), (2016, 5), (2018, 127), (2019, 200), (2020, 225), (2016, 350)
]


def test_sales_by_year_goldens(spark):
    single = literal_rows(spark, [Sales(*r) for r in SALES], "year int, euros int")
    totals = summaries.yearly_totals(single, "year", "euros")
    assert summaries.total_for_year(totals, 2017).first()["euros"] == 15
    assert tuple(summaries.best_year(totals).first()) == (2021, 950)
    multi = literal_rows(spark, MULTI_SALES, "year int, euros int")
    totals = summaries.yearly_totals(multi, "year", "euros")
    assert summaries.total_for_year(totals, 2016).first()["euros"] == 705
    assert tuple(summaries.best_year(totals).first()) == (2018, 1027)


def test_sum_of_cubes_golden(spark):
    primes = spark.createDataFrame([(p,) for p in [2, 3, 5, 7, 11, 13, 17, 19]], "x int")
    assert summaries.sum_of_cubes(primes, "x").first()["sum_of_cubes"] == 15803


def test_fog_days_ignore_heavy_fog_flag(spark):
    rows = [
        (dt.date(2015, 1, 1), "Yes", "No"),
        (dt.date(2015, 1, 2), "Yes", "Yes"),
        (dt.date(2015, 1, 3), "No", "Yes"),
        (dt.date(2016, 1, 1), "Yes", "No"),
    ]
    df = spark.createDataFrame(rows, "date date, fog string, fogheavy string")
    row = summaries.top_flagged_year(df, "date", F.col("fog") == "Yes").first()
    assert (row["year"], row["n"]) == (2015, 2)


def test_best_days_tie_keeps_earlier_day(spark):
    rows = [
        (dt.date(2004, 1, 2), 1.0, 10.0),
        (dt.date(2004, 1, 1), 2.0, 5.0),
        (dt.date(2004, 1, 3), 1.0, 1.0),
    ]
    df = spark.createDataFrame(rows, "day date, q double, p double")
    got = [r["day"] for r in summaries.best_days(df, "day", "q", "p", 1).collect()]
    assert got == [dt.date(2004, 1, 1)]


def test_january_counts_twice(spark):
    rows = [(2003, 1, "A", 1.0, 10.0), (2003, 2, "B", 1.0, 15.0), (2004, 1, "C", 1.0, 100.0)]
    df = spark.createDataFrame(rows, "y int, m int, product string, q double, p double")
    got = [tuple(r) for r in summaries.top_products_weighted(df, "product", "y", "m", "q", "p", 2003).collect()]
    assert got == [("A", 20.0), ("B", 15.0)]


def test_yearly_summary_and_lookups(spark):
    rows = [(dt.date(2008, 1, 1), 10.0, 20.0, 6.0), (dt.date(2008, 6, 1), 5.0, 30.0, 7.0), (dt.date(2009, 1, 1), 1.0, 2.0, 3.0)]
    df = spark.createDataFrame(rows, "date date, tmin double, tmax double, wind double")
    summary = {r["year"]: tuple(r) for r in summaries.yearly_summary(df, "date", "tmin", "tmax", "wind").collect()}
    assert summary[2008] == (2008, 5.0, 30.0, 2, 6.5)
    row = summaries.year_point_lookups(df, "date", "tmin", "tmax", "wind", 2008, 2009, 2008, 2009).first()
    assert tuple(row) == (5.0, 2.0, 2, 3.0)
    ext = [r["year"] for r in summaries.yearly_extremes(df, "date", "tmin", "tmax").collect()]
    assert ext == [2009, 2008]


def test_leader_selected_in_plan(spark):
    rows = [("P1", 2000, 5.0, 10.0), ("P1", 2001, 5.0, 10.0), ("P2", 2000, 9.0, 9.0), ("P2", 2010, 100.0, 100.0)]
    df = spark.createDataFrame(rows, "pub string, year int, eu double, glob double")
    got = sorted(tuple(r) for r in summaries.leader_yearly_sales(df, "pub", "year", "eu", "glob", 2000, 2009).collect())
    assert got == [("P1", 2000, 5.0, 10.0), ("P1", 2001, 5.0, 10.0)]


def test_cube_root_tolerance_checks(spark):
    from tessera.functions.numeric import cube_root

    # the reference's checks: x = y^3 for these y, root within 1e-6
    ys = [2.0, 3.0, 2023.0, 1.0 / 42]
    df = spark.createDataFrame([(y, y**3) for y in ys], "y double, x double")
    for row in df.select("y", cube_root(F.col("x")).alias("r")).collect():
        assert abs(row["r"] - row["y"]) < 1e-6
    neg = spark.range(1).select(cube_root(F.lit(-27.0)).alias("r")).first()["r"]
    assert abs(neg + 3.0) < 1e-12


def test_leader_rejects_empty_year_range(spark):
    import pytest

    df = spark.createDataFrame([("P", 2000, 1.0, 1.0)], "pub string, year int, eu double, glob double")
    with pytest.raises(ValueError):
        summaries.leader_yearly_sales(df, "pub", "year", "eu", "glob", 2005, 2000)
