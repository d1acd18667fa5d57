"""Plan properties the scale design relies on (checked on executed plans)."""

import re

import pytest

from __spark_entry__ import queries
from tessera.plans.catalog import QUERIES
from tessera.plans.oracles import ORACLES
from tests.conftest import SF_SMALL


def _plan(spark, name):
    df = queries()[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(ORACLES) - {"stream_best_days", "stream_top_days"}))
def test_no_python_evaluation(spark, name):
    plan = _plan(spark, name)
    assert "EvalPython" not in plan and "PythonUDF" not in plan


def test_leader_scans_lineitem_once_with_pushed_range(spark):
    plan = _plan(spark, "leader_yearly_sales")
    assert len(re.findall(r"FileScan parquet \[l_", plan)) == 1
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan


def test_rank_filters_limit_before_shuffle(spark):
    for name in ("best_team_per_season", "worst_team_per_season"):
        assert "WindowGroupLimit" in _plan(spark, name)


def test_team_tables_stack_sides_without_union(spark):
    for name in ("season_points", "playoff_records"):
        plan = _plan(spark, name)
        assert "Union" not in plan and "Generate" in plan
        assert len(re.findall(r"FileScan parquet \[l_", plan)) == 1


def test_games_aggregate_shots_before_join(spark):
    plan = _plan(spark, "games_from_shots")
    # the lineitem side reaches the join through a (partial + final) aggregate
    assert re.search(r"Join[\s\S]*HashAggregate[\s\S]*Exchange[\s\S]*HashAggregate[\s\S]*FileScan parquet \[l_", plan)


def test_top_k_uses_take_ordered(spark):
    for name in ("best_days", "top_products_weighted", "top_words"):
        assert "TakeOrderedAndProject" in _plan(spark, name)


def test_scans_read_only_needed_columns(spark):
    plan = _plan(spark, "best_days")
    m = re.search(r"ReadSchema: struct<([^>]*)>", plan)
    cols = m.group(1) if m else ""
    assert "l_comment" not in cols and "l_tax" not in cols and "l_quantity" in cols


def test_filters_of_lookups_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # else the plan's text is cut
    for name in ("playoff_records", "best_team_per_season", "best_team_of_season", "top_flagged_year"):
        assert "EqualTo(o_orderstatus,P)" in _plan(spark, name), name
    for name in ("best_team_of_season", "worst_team_of_season"):
        plan = _plan(spark, name)
        assert "GreaterThanOrEqual(o_orderdate,2001-01-01T00:00)" in plan and "LessThan(o_orderdate,2002-01-01T00:00)" in plan
    assert "1998-01-01T00:00" in _plan(spark, "year_point_lookups").split("PushedFilters")[1]


def test_only_wanted_games_shots_are_aggregated(spark):
    for name in ("playoff_records", "best_team_of_season", "worst_team_of_season"):
        plan = queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        below = plan[plan.rindex("Aggregate [l_orderkey") if "Aggregate [l_orderkey" in plan else plan.rindex("Aggregate [game_id") :]
        assert "Join LeftSemi" in below, plan


def test_read_table_with_schema_and_columns_prunes_scan(spark):
    from tessera.sources.tables import read_table

    schema = "l_orderkey BIGINT, l_quantity DOUBLE, l_extendedprice DOUBLE, l_shipdate TIMESTAMP_NTZ"
    df = read_table(spark, SF_SMALL, "lineitem", schema=schema, columns=["l_orderkey", "l_quantity"])
    assert df.columns == ["l_orderkey", "l_quantity"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    m = re.search(r"ReadSchema: struct<([^>]*)>", plan)
    assert m and m.group(1) == "l_orderkey:bigint,l_quantity:double"
    assert df.count() > 0


def test_hot_game_is_combined_map_side(spark):
    """One game holds a third of all shots: partial aggregation collapses it
    in every map partition before the exchange, and the totals stay exact."""
    import random

    from pyspark.sql import functions as F

    from tessera.operators import league

    rnd = random.Random(3)
    rows = []
    for i in range(30000):
        gid = 0 if i % 3 == 0 else rnd.randint(1, 2000)
        rows.append((2020, gid, "H", "A", 0, rnd.randint(1, 3600), rnd.choice(["HOME", "AWAY"]), rnd.choice(["GOAL", "SHOT"])))
    shots = spark.createDataFrame(
        rows,
        "season int, game_id int, homeTeamCode string, awayTeamCode string, isPlayOffGame int, "
        "time int, team string, event string",
    ).repartition(8)
    games = league.games_from_shots(shots)
    games.write.format("noop").mode("overwrite").save()
    plan = games._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_", plan)
    hot = games.filter(F.col("game_id") == 0).first()
    hot_rows = [r for r in rows if r[1] == 0]
    assert hot["homeTeamGoals"] == sum(1 for r in hot_rows if r[6] == "HOME" and r[7] == "GOAL")
    assert hot["lastGoalTime"] == max(r[5] for r in hot_rows if r[7] == "GOAL")
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_hot_customer_join_is_split_by_aqe(spark):
    """A third of the orders belong to one customer. With broadcasts off (the
    at-scale case) the orders-customer sort-merge join runs with AQE's skew
    split, and the result is unchanged."""
    from pyspark.sql import functions as F

    from tessera.plans import standins
    from tessera.sources.tables import Tables

    t = Tables(spark, SF_SMALL)
    # many map tasks, as a large input has (AQE splits a hot partition along
    # map-output blocks, so a single-task fixture would leave nothing to split)
    hot_orders = t.orders.withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("o_custkey"))
    ).repartition(8)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    saved = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        facts = standins.game_facts(hot_orders, t.customer)
        n = len(facts.collect())  # runs this DataFrame's own (adaptive) execution
        plan = facts._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "skew=true" in plan
        assert n == hot_orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).count()
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_word_is_combined_map_side(spark):
    """'the' is a third of all tokens: the word count combines it on the map
    side (partial aggregation) and the count is exact."""
    from pyspark.sql import functions as F

    from tessera.functions.text import ENGLISH
    from tessera.operators import words

    docs = spark.createDataFrame(
        [("en", " ".join(["the", f"w{i % 97}", f"v{i % 89}"] * 50)) for i in range(400)], "lang string, text string"
    ).repartition(8)
    counts = words.word_counts_by_lang(docs, {"en": ENGLISH})
    counts.write.format("noop").mode("overwrite").save()
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_count", plan)
    assert counts.filter(F.col("word") == "the").first()["n"] == 400 * 50


TOP_K_KEYS = {
    "first_rows", "best_days", "top_products_weighted", "top_flagged_year", "best_sales_year",
    "leader_yearly_sales", "top_words", "top_words_of_length", "longest_frequent_word",
    "most_common_word_of_length", "stream_top_days",
}


@pytest.mark.parametrize(
    "name", sorted(k for k in ORACLES if not k.startswith("stream_"))
)
def test_limits_only_in_top_k_reports(spark, name):
    """Every other query reads its tables whole: no limit in its plan."""
    plan = queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    has_limit = "GlobalLimit" in plan or "LocalLimit" in plan
    assert has_limit == (name in TOP_K_KEYS), name


# Results built from a model fitted on the tables (the fit is the table work).
MODEL_DERIVED = {"linreg_coefficients", "linreg_predict_new", "kmeans_refine"}


@pytest.mark.parametrize("name", sorted(k for k in QUERIES if not k.startswith("stream_") and not k.startswith("kmeans")))
def test_every_query_scans_the_tables(spark, name):
    """The plan reads a supplied table (or a copy staged from one)."""
    plan = queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    locations = re.findall(r"Location: \w+\(\d+ paths?\)\[([^\]]*)\]", plan)
    reads = any(SF_SMALL in loc or "checkpoint" in loc or "tessera-ckpt" in loc for loc in locations)
    assert reads or name in MODEL_DERIVED, name
