"""Types of CSV values, values that break a schema, folds over arrays, shared frames."""

import pytest
from pyspark.sql import functions as F

from tessera.functions.numeric import sum_of_cubes
from tessera.operators import regression
from tessera.plans.catalog import QUERIES, _games
from tessera.plans.reuse import shared
from tessera.session import scratch_path
from tessera.sources.inference import column_evidence, read_csv_inferred, read_csv_text, split_malformed
from tessera.sources.tables import Tables
from tests.conftest import SF_SMALL


def _csv(spark, label, *files):
    path = scratch_path(spark, label)
    for i, text in enumerate(files):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/{i}")
    return f"{path}/*/"


def test_types_come_from_all_values(spark):
    header = "i;b;d;t;day;ts;s;empty;mixed"
    path = _csv(
        spark, "lattice",
        f"{header}\n1;1;1.5;true;2004-01-02;2004-01-02 03:04:05;x;;1\n-2;99999999999;2;FALSE;2004-1-3;2004-01-02;y y;;2004-01-01",
        f"{header}\n3;7;1e3;true;;2004-01-02T00:00:00.000;1;;x\n;;NaN;;2004-12-31;;;;",
    )
    found = {r["column"]: r.asDict() for r in column_evidence(read_csv_text(spark, path, ";")).collect()}
    types = {c: r["type"] for c, r in found.items()}
    assert types == {"i": "int", "b": "bigint", "d": "double", "t": "boolean", "day": "date", "ts": "timestamp_ntz", "s": "string", "empty": "string", "mixed": "string"}
    assert [found[c]["place"] for c in header.split(";")] == list(range(9))
    assert (found["i"]["n_values"], found["i"]["n_nulls"], found["b"]["int"], found["b"]["bigint"]) == (3, 1, 2, 3)
    assert (found["ts"]["date"], found["ts"]["timestamp_ntz"]) == (1, 3)
    frame = read_csv_inferred(spark, path, ";")
    assert [t for _, t in frame.dtypes] == ["int", "bigint", "double", "boolean", "date", "timestamp_ntz", "string", "string", "string"]
    assert frame.agg(F.sum("i"), F.max("b")).first() == (2, 99999999999)


def test_one_late_value_decides(spark):
    files = ["n\n" + "\n".join(map(str, range(500))), "n\n7.5"]
    assert read_csv_inferred(spark, _csv(spark, "late", *files)).dtypes == [("n", "double")]


def test_names_with_dots_and_other_headers(spark):
    assert read_csv_inferred(spark, _csv(spark, "dots", "a.b,c`d\n1,x")).dtypes == [("a.b", "int"), ("c`d", "string")]
    with pytest.raises(Exception, match="(?i)header|schema"):
        read_csv_text(spark, _csv(spark, "headers", "a,b\n1,2", "a,c\n1,2")).collect()


def test_quarantine_keeps_raw_rows(spark):
    rows = [("1", "2001", "5.5"), ("2", "N/A", "6"), ("x", "N/A", "7"), (None, None, None), ("5", "2002", "1,5")]
    raw = spark.createDataFrame(rows, "Rank string, Year string, Sales string")
    good, bad = split_malformed(raw, "Rank BIGINT, Year INT, Sales DOUBLE")
    assert good.dtypes == [("Rank", "bigint"), ("Year", "int"), ("Sales", "double")]
    assert sorted(map(tuple, good.collect()), key=repr) == [(1, 2001, 5.5), (None, None, None)]
    got = {tuple(r)[:3]: r["bad_columns"] for r in bad.collect()}
    assert got == {("2", "N/A", "6"): ["Year"], ("x", "N/A", "7"): ["Rank", "Year"], ("5", "2002", "1,5"): ["Sales"]}


def test_cubes_per_row(spark):
    rows = [([1.0, 2.0, -3.0],), ([],), (None,), ([None, 2.0],)]
    frame = spark.createDataFrame(rows, "v array<float>").select(sum_of_cubes(F.col("v")).alias("s"))
    assert [r["s"] for r in frame.collect()] == [-18.0, 0.0, None, 8.0]
    assert "Generate" not in frame._jdf.queryExecution().executedPlan().toString()


def test_reports_share_one_game_table(spark):
    tables = Tables(spark, SF_SMALL)
    with shared(_games(tables)) as games:
        from tessera.operators import league

        for report in (league.playoff_records(games), league.season_points(games), league.worst_team_per_season(league.season_points(games))):
            plan = report._jdf.queryExecution().executedPlan().toString()
            assert "InMemoryTableScan" in plan  # read from the kept frame
        assert games.storageLevel.useMemory
    assert not games.storageLevel.useMemory and not games.storageLevel.useDisk
    found = QUERIES["season_report"](spark, SF_SMALL)
    assert {r["report"] for r in found.select("report").distinct().collect()} == {"records", "points", "best", "worst"}
    assert "lineitem" not in found._jdf.queryExecution().executedPlan().toString()


def test_model_from_moments_equals_spark_ml(spark):
    rows = [(float(i % 7), float(i % 5) * 1e6 + 1e9, 3.0 * (i % 7) - 2e-6 * (i % 5) + (i * 37 % 11)) for i in range(200)]
    frame = spark.createDataFrame(rows, "a double, b double, label double")
    model = regression.fit_linear_regression(frame, ["a", "b"])
    got = regression.solved(regression.moments(frame, ["a", "b"]), 2).first()["model"]
    assert got["coefficients"] == pytest.approx(list(model.coefficients), rel=1e-6)
    assert got["intercept"] == pytest.approx(model.intercept, rel=1e-6)
    column = regression.predicted(regression.linear_model(frame, ["a", "b"]), ["a", "b"])
    ours = frame.select("a", "b", "label", column.alias("prediction"))
    assert regression.rmse(ours) == pytest.approx(regression.rmse(regression.predict(model, frame, ["a", "b"])), rel=1e-9)


def test_moments_of_awkward_inputs(spark):
    schema = "x double, z double, label double"
    collinear = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, 4.0, 2.0), (3.0, 6.0, 5.0)], schema)
    assert regression.solved(regression.moments(collinear, ["x", "z"]), 2).first()["model"]["intercept"] is None
    empty = spark.createDataFrame([], schema)
    assert regression.solved(regression.moments(empty, ["x"]), 1).first()["model"]["coefficients"] == [None]
    nulls = spark.createDataFrame([(1.0, 0.0, 1.0), (None, 0.0, 9.0), (2.0, 0.0, 3.0), (5.0, 0.0, None)], schema)
    row = regression.solved(regression.moments(nulls, ["x"]), 1).first()["model"]
    assert row["coefficients"] == [2.0] and row["intercept"] == -1.0


def test_moments_do_not_depend_on_the_layout(spark):
    frame = spark.range(1000).select((F.col("id") % 50 + 0.25).alias("x"), (F.col("id") % 50 * 3 + F.col("id") % 7).cast("double").alias("label"))
    models = [regression.solved(regression.moments(frame.repartition(n), ["x"]), 1).first()["model"] for n in (1, 7, 40)]
    for m in models[1:]:
        assert m["coefficients"] == pytest.approx(models[0]["coefficients"], rel=1e-12)
