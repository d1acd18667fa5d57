"""Adapters from the supplied TPC-H-like tables to the input shapes of the
operators (the reference's own files are not available).

Each adapter is a projection/join written with the DataFrame API; the same
mapping is spelled out in SQL in ``tessera.plans.oracles`` so both engines
see identical inputs.

shots     one shot per ``lineitem`` row: game = order, season = order year,
          home team = customer nation, away team = a different nation derived
          from the order key, playoff = order status 'P', shot time =
          quantity * 80 s (> 3600 means extra time), side from the line
          number parity, event from the return flag (R goal, A shot, N miss).
points    one point per customer near (61 N, 23 E); postal code = nation.
weather   ``orders`` by order date; the measured value is the total price;
          a flag day is an order with status 'P'.
retail    ``lineitem``: day = ship date (midnight timestamp), product = part key,
          sale = quantity * extended price.
publisher ``lineitem`` -> ``supplier`` -> ``nation``: publisher = nation
          name, EU sales = extended price of returned lines (flag 'R'),
          global sales = all extended price.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.league import GAME_KEYS, games_from_shots

# Fixed values of the stand-in mappings.
N_TEAMS = 25
SHOT_SECONDS_PER_UNIT = 80
ANCHOR_ID = 42
POINT_LAT0, POINT_LAT_MUL, POINT_LAT_MOD = 61, 7919, 10007
POINT_LON0, POINT_LON_MUL, POINT_LON_MOD = 23, 104729, 10009


def year_start(year: int) -> Column:
    """Midnight of 1 January as a timestamp_ntz literal, so a year range on a
    timestamp column reaches the parquet scan as a pushed filter."""
    return F.lit(f"{year:04d}-01-01 00:00:00").cast("timestamp_ntz")


def in_years(ts: Column, years: Iterable[int]) -> Column:
    """Whether a timestamp_ntz lies in one of the years, as ranges that reach the scan."""
    ranges = [(ts >= year_start(y)) & (ts < year_start(y + 1)) for y in sorted(set(years))]
    return reduce(lambda a, b: a | b, ranges)


def day_of(ts: Column) -> Column:
    """The calendar day of a timestamp_ntz, kept as a midnight timestamp_ntz
    (the type every date column of the supplied tables has)."""
    return F.to_date(ts).cast("timestamp_ntz")


def _event(returnflag: Column) -> Column:
    return F.when(returnflag == "R", "GOAL").when(returnflag == "A", "SHOT").otherwise("MISS")


def shot_events(lineitem: DataFrame) -> DataFrame:
    """game_id, time, team, event -- the per-shot part of the shot log."""
    return lineitem.select(
        F.col("l_orderkey").alias("game_id"),
        (F.col("l_quantity") * SHOT_SECONDS_PER_UNIT).cast("int").alias("time"),
        F.when(F.col("l_linenumber") % 2 == 0, "HOME").otherwise("AWAY").alias("team"),
        _event(F.col("l_returnflag")).alias("event"),
    )


def game_facts(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """season, game_id, homeTeamCode, awayTeamCode, isPlayOffGame per game."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    c = customer.select("c_custkey", "c_nationkey")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.year("o_orderdate").alias("season"),
        F.col("o_orderkey").alias("game_id"),
        F.col("c_nationkey").cast("bigint").alias("homeTeamCode"),
        ((F.col("c_nationkey") + 1 + F.col("o_orderkey") % 24) % N_TEAMS).alias("awayTeamCode"),
        F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("isPlayOffGame"),
    )


def shots(lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    """The full shot log (game keys on every shot row)."""
    return shot_events(lineitem).join(game_facts(orders, customer), "game_id").select(
        *GAME_KEYS, "time", "team", "event"
    )


def games(
    lineitem: DataFrame, orders: DataFrame, customer: DataFrame, playoff: bool | None = None, season: int | None = None
) -> DataFrame:
    """Game table from the supplied tables, aggregating shots *before* the
    join: lineitem shrinks to one row per order on the map side, and only
    those rows meet the order/customer attributes. ``playoff`` and ``season``
    filter the orders at their scan, and a semi-join then keeps the shots of
    those games only, before they are aggregated."""
    if playoff is not None or season is not None:
        if playoff is not None:
            orders = orders.filter(F.col("o_orderstatus") == "P" if playoff else ~F.col("o_orderstatus").eqNullSafe("P"))
        if season is not None:
            orders = orders.filter(in_years(F.col("o_orderdate"), [season]))
        wanted = orders.select(F.col("o_orderkey").alias("l_orderkey"))
        lineitem = lineitem.join(wanted, "l_orderkey", "left_semi")
    per_game = games_from_shots(shot_events(lineitem), keys=["game_id"])
    return game_facts(orders, customer).join(per_game, "game_id").select(
        *GAME_KEYS, "homeTeamGoals", "awayTeamGoals", "lastGoalTime"
    )


def points(customer: DataFrame) -> DataFrame:
    """id, latitude_wgs84, longitude_wgs84, postal_code per customer."""
    key = F.col("c_custkey")
    return customer.select(
        key.alias("id"),
        (F.lit(POINT_LAT0) + (key * POINT_LAT_MUL % POINT_LAT_MOD).cast("double") / POINT_LAT_MOD).alias(
            "latitude_wgs84"
        ),
        (F.lit(POINT_LON0) + (key * POINT_LON_MUL % POINT_LON_MOD).cast("double") / POINT_LON_MOD).alias(
            "longitude_wgs84"
        ),
        F.col("c_nationkey").cast("bigint").alias("postal_code"),
    )


def weather(orders: DataFrame) -> DataFrame:
    """date, value, flag (order status 'P' -> 'Yes') per order."""
    return orders.select(
        F.to_date("o_orderdate").alias("date"),
        F.col("o_totalprice").alias("value"),
        F.when(F.col("o_orderstatus") == "P", "Yes").otherwise("No").alias("flag"),
    )


def retail(lineitem: DataFrame) -> DataFrame:
    """day, year, month, product, quantity, price per line."""
    return lineitem.select(
        day_of(F.col("l_shipdate")).alias("day"),
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        F.col("l_partkey").alias("product"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
    )


def sales_with_gaps(lineitem: DataFrame) -> DataFrame:
    """Rank, Year (text), Global_Sales per line: the year of a first line that was
    not returned is unknown ('N/A'), as in the reference's sales file."""
    unknown = (F.col("l_returnflag") == "N") & (F.col("l_linenumber") == 1)
    return lineitem.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("Rank"),
        F.when(unknown, "N/A").otherwise(F.year("l_shipdate").cast("string")).alias("Year"),
        F.col("l_extendedprice").alias("Global_Sales"),
    )


def publisher_sales(
    lineitem: DataFrame, supplier: DataFrame, nation: DataFrame, first_year: int, last_year: int
) -> DataFrame:
    """year, publisher, eu, global: partial sums per (supplier, year) for the
    years in range. Lines are summed per supplier before the supplier join,
    so the join sees one row per supplier-year instead of one per line; the
    sales operators sum these partial sums again per publisher."""
    year = F.year("l_shipdate")
    li = (
        lineitem.filter(F.col("l_shipdate") >= year_start(first_year))
        .filter(F.col("l_shipdate") < year_start(last_year + 1))
        .groupBy("l_suppkey", year.alias("year"))
        .agg(
            F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice")).otherwise(F.lit(0.0))).alias("eu"),
            F.sum("l_extendedprice").alias("global"),
        )
    )
    s = supplier.select("s_suppkey", "s_nationkey")
    n = nation.select("n_nationkey", F.col("n_name").alias("publisher"))
    return li.join(s, li.l_suppkey == s.s_suppkey).join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "year", "publisher", "eu", "global"
    )
