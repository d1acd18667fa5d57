"""File sources (D11, ANSI years) and stream = batch (D12)."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import summaries
from tessera.session import scratch_path
from tessera.sources.files import read_csv, read_game_sales, read_text_lines, write_csv
from tessera.streaming import versions
from tessera.streaming.best_days import (
    agreement,
    daily_sales,
    read_csv_stream,
    read_result,
    run_to_parquet,
    stop_and_resume_daily_sales,
    stop_query_by_name,
    stream_daily_sales,
    top_days,
)


def _write_text(spark, label, text):
    path = scratch_path(spark, label)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return path


def test_csv_header_mismatch_fails(spark):
    path = _write_text(spark, "csv-bad", "A,B\n1,2")
    with pytest.raises(Exception):
        read_csv(spark, path, "A INT, X INT, B INT").collect()


def test_csv_with_matching_schema_reads(spark):
    path = _write_text(spark, "csv-good", "A;B\n1;2\n3;4")
    rows = read_csv(spark, path, "A INT, B INT", sep=";").orderBy("A").collect()
    assert [tuple(r) for r in rows] == [(1, 2), (3, 4)]


def test_na_year_dropped_without_error(spark):
    header = "Rank,Name,Platform,Year,Genre,Publisher,NA_Sales,EU_Sales,JP_Sales,Other_Sales,Global_Sales"
    body = "\n".join(
        [
            header,
            "1,G1,P,2005,X,Pub1,1.0,2.0,0.0,0.0,3.0",
            "2,G2,P,N/A,X,Pub2,1.0,9.0,0.0,0.0,10.0",
            "3,G3,P,2007,X,Pub2,1.0,1.0,0.0,0.0,2.0",
        ]
    )
    df = read_game_sales(spark, _write_text(spark, "sales", body))
    got = summaries.leader_yearly_sales(df, "Publisher", "Year", "EU_Sales", "Global_Sales", 2000, 2009).collect()
    assert [(r["publisher"], r["year"], r["eu_total"]) for r in got] == [("Pub1", 2005, 2.0)]


def test_csv_roundtrip_keeps_values(spark):
    df = spark.createDataFrame([(1, 2.5, "x"), (2, None, "y")], "a bigint, b double, c string")
    path = write_csv(df, scratch_path(spark, "rt"))
    back = read_csv(spark, path, "a BIGINT, b DOUBLE, c STRING").orderBy("a").collect()
    assert [tuple(r) for r in back] == [(1, 2.5, "x"), (2, None, "y")]


def test_text_lines(spark):
    path = _write_text(spark, "txt", "one two\nthree")
    assert read_text_lines(spark, path).count() == 2


def test_stream_equals_batch(spark):
    rows = [
        ("2004-11-24 00:00:00", 10.0, 3.5),
        ("2004-11-24 00:00:00", 1.0, 1.0),
        ("2003-11-14 00:00:00", 2.0, 100.0),
        ("2003-01-01 00:00:00", 1.0, 7.0),
        ("2005-05-05 00:00:00", 3.0, 3.0),
        ("2003-11-14 00:00:00", 1.0, 0.5),
    ]
    df = spark.createDataFrame(rows, "d string, q double, p double").select(
        F.col("d").cast("timestamp_ntz").alias("d"), "q", "p"
    )
    folder = scratch_path(spark, "stream-in")
    df.write.option("maxRecordsPerFile", 2).option("header", "true").csv(folder)  # several files
    schema = "d TIMESTAMP_NTZ, q DOUBLE, p DOUBLE"
    streamed = stream_daily_sales(spark, folder, schema, "d", "q", "p", max_files_per_trigger=1)
    batch = summaries.daily_totals(df.withColumn("day", F.to_date("d")), "day", "q", "p")
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    assert [tuple(r) for r in top_days(streamed, 2).collect()] == [tuple(r) for r in top_days(batch, 2).collect()]


def test_stream_resumes_from_checkpoint(spark):
    schema = "d TIMESTAMP_NTZ, q DOUBLE, p DOUBLE"
    folder = scratch_path(spark, "stream-resume")
    first = spark.createDataFrame([("2001-01-01 00:00:00", 1.0, 2.0), ("2001-01-02 00:00:00", 1.0, 1.0)], "d string, q double, p double")
    first.select(F.col("d").cast("timestamp_ntz").alias("d"), "q", "p").coalesce(1).write.option("header", "true").csv(f"{folder}/a")
    result, state = scratch_path(spark, "res"), scratch_path(spark, "state")
    glob = f"{folder}/*/"
    out1 = stream_daily_sales(spark, glob, schema, "d", "q", "p", result_path=result, checkpoint_path=state)
    assert sorted((str(r["day"]), r["total_sales"]) for r in out1.collect()) == [("2001-01-01", 2.0), ("2001-01-02", 1.0)]
    second = spark.createDataFrame([("2001-01-01 00:00:00", 3.0, 1.0)], "d string, q double, p double")
    second.select(F.col("d").cast("timestamp_ntz").alias("d"), "q", "p").coalesce(1).write.option("header", "true").csv(f"{folder}/b")
    out2 = stream_daily_sales(spark, glob, schema, "d", "q", "p", result_path=result, checkpoint_path=state)
    assert sorted((str(r["day"]), r["total_sales"]) for r in out2.collect()) == [("2001-01-01", 5.0), ("2001-01-02", 1.0)]


def test_inferred_csv_schema(spark):
    path = _write_text(spark, "csv-infer", "A,B,C\n1,2.5,x\n3,4.0,y")
    df = read_csv(spark, path, infer_schema=True)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["int", "double", "string"]


def test_live_stream_updates_and_stops_by_name(spark):
    schema = "d TIMESTAMP_NTZ, q DOUBLE, p DOUBLE"
    folder = scratch_path(spark, "live")

    def drop(label, rows):
        df = spark.createDataFrame(rows, "d string, q double, p double")
        df.select(F.col("d").cast("timestamp_ntz").alias("d"), "q", "p").coalesce(1).write.option(
            "header", "true"
        ).csv(f"{folder}/{label}")

    drop("a", [("2002-02-02 00:00:00", 2.0, 2.0)])
    stream = read_csv_stream(spark, f"{folder}/*/", schema, max_files_per_trigger=1)
    result = scratch_path(spark, "live-out")
    run = run_to_parquet(
        daily_sales(stream, "d", "q", "p"), result, scratch_path(spark, "live-state"),
        name="live_best_days", available_now=False, interval="1 second",
    )
    try:
        run.query.processAllAvailable()
        assert [r["total_sales"] for r in read_result(spark, result).collect()] == [4.0]
        drop("b", [("2002-02-02 00:00:00", 1.0, 1.0), ("2002-02-03 00:00:00", 5.0, 1.0)])
        run.query.processAllAvailable()
        got = sorted((str(r["day"]), r["total_sales"]) for r in read_result(spark, result).collect())
        assert got == [("2002-02-02", 5.0), ("2002-02-03", 5.0)]
    finally:
        assert stop_query_by_name(spark, "live_best_days")
    assert not run.query.isActive


def test_stream_over_empty_folder_gives_empty_table(spark):
    folder = scratch_path(spark, "stream-empty")
    spark.createDataFrame([], "d string").write.text(folder)  # folder exists, holds no CSV rows
    out = stream_daily_sales(spark, folder, "d TIMESTAMP_NTZ, q DOUBLE, p DOUBLE", "d", "q", "p")
    assert out.count() == 0 and out.columns == ["day", "total_sales"]


def test_malformed_values_fail_stream_and_batch_alike(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("q;p\n2;3.0\noops;5.0\n")
    schema = "q DOUBLE, p DOUBLE"
    with pytest.raises(Exception, match="(?i)malformed|oops"):
        read_csv(spark, str(tmp_path / "in"), schema, sep=";").collect()
    with pytest.raises(Exception, match="(?i)malformed|oops|terminated"):
        stream_daily_sales(spark, str(tmp_path / "in"), schema, F.lit("2020-01-01").cast("date"), "q", "p", sep=";")


def _version(spark, root, epoch, rows, buckets):
    frame = spark.createDataFrame(rows, "day int, total_sales double, bucket int")
    versions.write_version(frame, root, epoch)
    schema = frame.drop("bucket").schema
    versions.commit(spark, root, versions.Commit(epoch, schema, buckets))


def test_readers_see_whole_commits_and_old_versions_go(spark, tmp_path):
    root = str(tmp_path / "result")
    with pytest.raises(FileNotFoundError):
        read_result(spark, root)
    _version(spark, root, 0, [(1, 1.0, 0), (2, 2.0, 1)], {0: 0, 1: 0})
    _version(spark, root, 1, [(1, 5.0, 0)], {0: 1, 1: 0})
    _version(spark, root, 2, [(1, 6.0, 0)], {0: 2, 1: 0})
    versions.write_version(spark.createDataFrame([(9, 9.0, 0)], "day int, total_sales double, bucket int"), root, 3)  # not committed
    assert sorted(map(tuple, read_result(spark, root).collect())) == [(1, 6.0), (2, 2.0)]
    names = {f.name for f in (tmp_path / "result").iterdir() if not f.name.startswith(".")}
    assert names == {"v0", "v1", "v2", "v3", "commit1", "commit2"}  # bucket 1 is still that of batch 0
    _version(spark, root, 3, [(1, 7.0, 0), (2, 8.0, 1)], {0: 3, 1: 3})
    _version(spark, root, 4, [(1, 8.0, 0)], {0: 4, 1: 3})
    names = {f.name for f in (tmp_path / "result").iterdir() if not f.name.startswith(".")}
    assert names == {"v3", "v4", "commit3", "commit4"}


def _arrivals(spark, folder, days, files):
    """CSV files that all hold every day, and the daily totals."""
    rows = [(f, f"2004-01-{d + 1:02d} 00:00:00", float(f + 1), float(d + 1)) for f in range(files) for d in range(days)]
    frame = spark.createDataFrame(rows, "f int, d string, q double, p double")
    for f in range(files):
        one = frame.where(F.col("f") == f).select(F.col("d").cast("timestamp_ntz").alias("d"), "q", "p")
        one.coalesce(1).write.option("header", "true").csv(f"{folder}/{f:03d}")
    return {f"2004-01-{d + 1:02d}": round(sum(f + 1 for f in range(files)) * (d + 1.0), 2) for d in range(days)}


def test_state_is_carried_over_twelve_batches(spark):
    folder, result, state = (scratch_path(spark, x) for x in ("many-in", "many-out", "many-state"))
    want = _arrivals(spark, folder, days=5, files=12)
    stream = read_csv_stream(spark, f"{folder}/*/", "d TIMESTAMP_NTZ, q DOUBLE, p DOUBLE", max_files_per_trigger=1)
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    run = run_to_parquet(daily_sales(stream, "d", "q", "p"), result, state, buckets=3)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == provider  # the session's settings are its own
    run.finish()
    progress = [p for p in run.query.recentProgress if p["numInputRows"]]
    assert len(progress) == 12
    states = [p["stateOperators"][0] for p in progress]
    # Every later batch updates the same rows of the state and adds none.
    assert states[0]["numRowsUpdated"] >= 5 and len({(s["numRowsTotal"], s["numRowsUpdated"]) for s in states[1:]}) == 1
    assert any("rocksdb" in k.lower() for k in states[-1]["customMetrics"])
    assert {str(r["day"]): r["total_sales"] for r in read_result(spark, result).collect()} == want
    last = versions.last_commit(spark, result)
    assert last.epoch == 11 and set(last.buckets.values()) == {11}
    assert versions._epochs(spark, result, versions.COMMIT) == [10, 11]
    assert set(versions._epochs(spark, result, versions.VERSION)) <= {10, 11}


def test_only_buckets_of_changed_days_are_written(spark):
    folder, result, state = (scratch_path(spark, x) for x in ("few-in", "few-out", "few-state"))
    want = _arrivals(spark, folder, days=28, files=1)
    schema = "d TIMESTAMP_NTZ, q DOUBLE, p DOUBLE"
    args = (spark, f"{folder}/*/", schema, "d", "q", "p")
    stream_daily_sales(*args, result_path=result, checkpoint_path=state)
    one = spark.createDataFrame([("2004-01-03 00:00:00", 1.0, 100.0)], "d string, q double, p double")
    one.select(F.col("d").cast("timestamp_ntz").alias("d"), "q", "p").coalesce(1).write.option("header", "true").csv(f"{folder}/later")
    table = stream_daily_sales(*args, result_path=result, checkpoint_path=state)
    want["2004-01-03"] += 100.0
    assert {str(r["day"]): r["total_sales"] for r in table.collect()} == want
    assert sorted(versions.last_commit(spark, result).buckets.values()).count(1) == 1  # one bucket has the new version


def test_replayed_batch_gives_the_same_table(spark):
    folder, result, state = (scratch_path(spark, x) for x in ("again-in", "again-out", "again-state"))
    want = _arrivals(spark, folder, days=4, files=3)
    args = (spark, f"{folder}/*/", "d TIMESTAMP_NTZ, q DOUBLE, p DOUBLE", "d", "q", "p")
    stream_daily_sales(*args, result_path=result, checkpoint_path=state)
    fs, path = versions._files(spark, state)
    fs.delete(path(f"{state}/commits/2"), False)  # as if the driver was lost after the sink's commit
    table = stream_daily_sales(*args, result_path=result, checkpoint_path=state)
    assert {str(r["day"]): r["total_sales"] for r in table.collect()} == want
    assert versions.last_commit(spark, result).epoch == 2


def test_stream_is_found_by_name_stopped_and_resumed(spark):
    folder = scratch_path(spark, "stop-in")
    want = _arrivals(spark, folder, days=3, files=12)
    table, before, after = stop_and_resume_daily_sales(
        spark, f"{folder}/*/", "d TIMESTAMP_NTZ, q DOUBLE, p DOUBLE", "d", "q", "p", name="to be stopped", stop_after=4
    )
    assert 4 <= before < 12 and before + after >= 12  # the batch that the stop cut short runs again
    assert {str(r["day"]): r["total_sales"] for r in table.collect()} == want
    assert not stop_query_by_name(spark, "to be stopped")


def test_agreement_counts_each_kind(spark):
    left = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, None), (None, 4.0), (5, 5.0)], "day int, total double")
    right = spark.createDataFrame([(1, 1.0), (2, 2.5), (3, None), (None, 4.0), (6, 6.0), (7, 7.0)], "day int, total double")
    row = agreement(left, right, "day", "total", ("stream", "batch")).first().asDict()
    assert row == {"keys_on_both": 4, "equal_values": 3, "only_stream": 1, "only_batch": 2}


def test_the_registered_streams_take_many_batches(spark):
    from tessera.plans import catalog

    path, files = catalog._staged_lineitem_csv(spark, "/root/testdata/sf0.01")
    stream = read_csv_stream(spark, path, catalog.LINEITEM_SCHEMA, ";", True, files)
    agg = daily_sales(stream, catalog._stream_day(), "l_quantity", "l_extendedprice")
    run = run_to_parquet(agg, scratch_path(spark, "reg-out"), scratch_path(spark, "reg-state"))
    run.finish()
    progress = [p for p in run.query.recentProgress if p["numInputRows"]]
    assert len(progress) >= 10
    per_day = spark.read.schema(catalog.LINEITEM_SCHEMA).option("sep", ";").option("header", "true").csv(path)
    files_of_day = per_day.select(catalog._stream_day().alias("day"), F.input_file_name().alias("file")).groupBy("day").agg(F.countDistinct("file").alias("n"))
    assert files_of_day.agg(F.max("n")).first()[0] == len(progress)  # a day in all of them
