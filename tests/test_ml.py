"""Regression goldens (inline 30 points) and K-Means refinement invariants."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions.geo import haversine_km
from tessera.operators import clustering, regression

# The reference's 30 (X, label) points, and the X values of
# its published test split.
XY = [
    (0.0, 0.0), (0.3, 0.5), (0.9, 0.8), (1.0, 0.8), (5.2, 5.8), (6.9, 7.2),
    (6.4, 6.8), (2.0, 2.2), (2.2, 2.4), (3.0, 3.7), (4.0, 4.3), (3.8, 4.0),
    (7.1, 9.0), (1.9, 1.9), (1.5, 1.4), (3.2, 3.9), (3.5, 4.1), (1.2, 1.1),
    (5.9, 5.7), (6.1, 6.7), (4.4, 4.6), (5.5, 5.2), (6.6, 7.2), (6.9, 7.9),
    (3.1, 4.0), (0.1, 0.2), (7.8, 8.8), (4.7, 5.0), (4.8, 5.0), (7.5, 8.2),
]
TEST_X = {5.2, 3.8, 3.2, 6.1, 0.1, 7.5}


def test_regression_goldens(spark):
    df = spark.createDataFrame(XY, "X double, label double")
    train = df.filter(~F.col("X").isin(*TEST_X))
    test = df.filter(F.col("X").isin(*TEST_X))
    assert train.count() == 24 and test.count() == 6
    model = regression.fit_linear_regression(train, ["X"])
    assert model.coefficients[0] == pytest.approx(1.1118773006135, abs=1e-9)
    assert model.intercept == pytest.approx(-0.0936650306748, abs=1e-9)
    pred = regression.predict(model, test, ["X"])
    assert regression.rmse(pred) == pytest.approx(0.20619171009294207, abs=1e-9)
    assert regression.rmse_frame(pred).first()["rmse"] == pytest.approx(0.20619171009294207, abs=1e-9)
    new = spark.createDataFrame([(x,) for x in (-1.5, 2.5, 8.5, 31.4)], "X double")
    got = [round(r["prediction"], 4) for r in regression.predict(model, new, ["X"]).orderBy("X").collect()]
    assert got == [-1.7615, 2.686, 9.3573, 34.8193]


def test_hash_split_is_deterministic(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "k")
    a = regression.split_counts(df, F.col("k")).collect()
    b = regression.split_counts(df.repartition(7), F.col("k")).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_haversine_matches_python(spark):
    lat1, lon1, lat2, lon2 = 61.4498, 23.8595, 60.1699, 24.9384
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin(math.radians(lat2 - lat1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(
        math.radians(lon2 - lon1) / 2
    ) ** 2
    expected = 2 * 6378.1 * math.atan2(math.sqrt(a), math.sqrt(1 - a))
    got = spark.range(1).select(haversine_km(lat1, lon1, lat2, lon2).alias("d")).first()["d"]
    assert got == pytest.approx(expected, rel=1e-12)


def _three_groups(spark):
    rows, i = [], 0
    for clat, clon in [(61.45, 23.85), (60.17, 24.94), (65.01, 25.47)]:
        for a in range(6):
            for b in range(6):
                rows.append((i, clat + a * 0.002, clon + b * 0.004, 33720 if clat == 61.45 else 1))
                i += 1
    rows += [(1000, 69.0, 27.0, 2), (1001, 59.9, 20.0, 2), (1002, 62.5, 30.0, 2), (1003, 64.0, 21.0, 2)]
    return spark.createDataFrame(rows, "id long, latitude_wgs84 double, longitude_wgs84 double, postal_code long")


def _rounds(result):
    return clustering.rounds_frame(result).orderBy("round").collect()


def test_refinement_reaches_radius_and_keeps_anchor(spark):
    result = clustering.kmeans_refine(_three_groups(spark), 0, start_k=7, max_radius_km=3.0, seed=1)
    rounds = _rounds(result)
    assert [r["radius_km"] <= 3.0 for r in rounds] == [False] * (len(rounds) - 1) + [True]
    assert result.history.filter(F.col("id") == 0).count() == len(rounds)
    assert [r["k"] for r in rounds] == [max(7 - i, 2) for i in range(len(rounds))]
    assert [r["n_before"] for r in rounds[1:]] == [r["n_after"] for r in rounds[:-1]]
    final = clustering.final_counts(result.members, "postal_code", 33720).first()
    assert final["members"] == rounds[-1]["n_after"]
    assert final["members_in_postal_code"] <= final["members"]
    # Every round's radius is the distance of its farthest member to its own centre.
    for r in rounds:
        members = result.history.where(F.col("round") == r["round"])
        distance = haversine_km(F.col("latitude_wgs84"), F.col("longitude_wgs84"), r["center_lat"], r["center_lon"])
        assert members.agg(F.max(distance)).first()[0] == pytest.approx(r["radius_km"], abs=1e-6)


def test_refinement_continues_at_k2_until_radius(spark):
    # one long chain of points: k drops to 2 and stays there until <= limit
    rows = [(i, 61.0 + i * 0.01, 23.0, 1) for i in range(200)]
    points = spark.createDataFrame(rows, "id long, latitude_wgs84 double, longitude_wgs84 double, postal_code long")
    rounds = _rounds(clustering.kmeans_refine(points, 0, start_k=3, max_radius_km=3.0, seed=1))
    assert [r["k"] for r in rounds][:2] == [3, 2]
    assert rounds[-1]["radius_km"] <= 3.0
    assert all(r["k"] >= 2 for r in rounds)


def test_clusters_do_not_depend_on_the_layout(spark):
    points = _three_groups(spark).unionByName(
        spark.range(2000, 2400).selectExpr(
            "id", "60 + id * 7919 % 10007 / 2001.0D AS latitude_wgs84", "22 + id * 104729 % 10009 / 1999.0D AS longitude_wgs84", "3L AS postal_code"
        )
    )
    runs = []
    for n in (1, 16, 200):
        dealt = points.repartition(n, F.rand(n))
        result = clustering.kmeans_refine(dealt, 0, start_k=7, max_radius_km=3.0, seed=1)
        assigned = {r["id"]: r["cluster"] for r in clustering.kmeans_assign(dealt, 4).collect()}
        runs.append((_rounds(result), sorted(r["id"] for r in result.members.collect()), assigned))
    assert all(r == runs[0] for r in runs[1:])


def _plain_kmeans(rows, k, seed):
    """The clusters of (id, lat, lon) by the same rules, in plain Python."""
    points = [(i, round(a * 1e6), round(b * 1e6)) for i, a, b in rows]
    apart = lambda p, q: (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2
    order = sorted(points, key=lambda p: hashlib.md5(f"{seed}:{p[0]}".encode()).hexdigest())[:64]
    chosen = [order[0][1:]]
    while len(chosen) < k:
        chosen.append(max((p[1:] for p in order), key=lambda p: min(apart(p, c) for c in chosen)))
    for _ in range(20):
        homes = [min(range(k), key=lambda c: apart(p[1:], chosen[c])) for p in points]
        new = list(chosen)
        for c in range(k):
            of = [p for p, h in zip(points, homes) if h == c]
            if of:
                new[c] = (sum(p[1] for p in of) // len(of), sum(p[2] for p in of) // len(of))
        moved, chosen = max(map(apart, new, chosen)), new
        if moved <= 100**2:
            break
    return {p[0]: min(range(k), key=lambda c: apart(p[1:], chosen[c])) for p in points}


def test_kmeans_against_plain_rounds(spark):
    rng = random.Random(3)
    rows = [(i, rng.uniform(-60, 60), rng.uniform(-179, 179)) for i in range(300)] + [(i, 1.5, 2.5) for i in range(300, 400)]
    points = spark.createDataFrame([*rows, (900, None, 1.0)], "id long, latitude_wgs84 double, longitude_wgs84 double")
    for k in (1, 2, 5):
        got = {r["id"]: r["cluster"] for r in clustering.kmeans_assign(points, k, seed=4).collect()}
        assert got.pop(900) is None
        assert got == _plain_kmeans(rows, k, 4)
    assert clustering.kmeans_assign(points.limit(0), 3).collect() == []
    one_place = points.where("id >= 300 and id < 400")
    assert {r["cluster"] for r in clustering.kmeans_assign(one_place, 3).collect()} == {0}


def test_points_are_rounded_once_a_fit(spark, monkeypatch):
    """Rounds and distances read whole micro-degrees; a double is not rounded again for every centre."""
    points = _three_groups(spark)
    made = []
    plain = clustering.micro_degrees
    monkeypatch.setattr(clustering, "micro_degrees", lambda degrees: made.append(degrees) or plain(degrees))
    centres = clustering.fit_kmeans(points, 7)
    assert len(centres) == 7 and len(made) == 4  # two columns of the points, two of the candidates
    plan = clustering.kmeans_assign(points, 7)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("round(") == 2


def test_checks_count_points_that_are_not_with_their_nearest_centre(spark):
    points = _three_groups(spark).unionByName(spark.createDataFrame([(2000, None, 23.0, 3)], "id long, latitude_wgs84 double, longitude_wgs84 double, postal_code long"))
    result = clustering.kmeans_refine(points, 0)
    centres = clustering.fit_kmeans(points, 7)
    assigned = clustering.kmeans_assign(points, centres=centres, keep=(clustering.LAT, clustering.LON))
    assert clustering.checks_frame(points, assigned, centres, result, 0, 3.0).first().asDict() == {
        "points_in": 113, "points_assigned": 112, "not_nearest": 0, "rounds_chained": True, "anchor_present": True, "radius_within_limit": True,
    }
    for cluster, wrong in ((F.col("cluster") + F.when(F.col("id").between(1000, 1002), 1).otherwise(0), 3), (F.lit(99), 113)):
        moved = assigned.withColumn("cluster", cluster)
        assert clustering.checks_frame(points, moved, centres, result, 0, 3.0).first()["not_nearest"] == wrong


def test_refinement_that_cannot_progress_raises(spark):
    schema = "id long, latitude_wgs84 double, longitude_wgs84 double, postal_code long"
    twins = spark.createDataFrame([(0, 61.0, 23.0, 1), (0, 62.0, 23.0, 1)], schema)
    with pytest.raises(ValueError):
        clustering.kmeans_refine(twins, 0)
    same = spark.createDataFrame([(i, 61.0, 23.0, 1) for i in range(5)], schema)
    with pytest.raises(RuntimeError):
        clustering.kmeans_refine(same, 0, max_radius_km=-1.0)


def test_split_bucket_has_no_overflow_and_matches_formula(spark):
    ids = [0, 1, 42, 10006, 10007, 123456789, 2**40 + 3, -5, -10008]
    df = spark.createDataFrame([(i,) for i in ids], "k long")
    got = [r["b"] for r in df.select(regression.split_bucket(F.col("k")).alias("b")).collect()]
    def java_mod(a, m):  # remainder with the sign of the dividend, as in Spark/SQL
        r = abs(a) % m
        return r if a >= 0 else -r

    expected = [java_mod(java_mod(i * 7919, 10007), 100) for i in ids]
    assert got == expected
    big = spark.createDataFrame([(2**62,)], "k long").select(regression.split_bucket(F.col("k")).alias("b"))
    assert 0 <= big.first()["b"] < 100


def test_hash_split_keeps_every_row(spark):
    df = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "k long")
    train, test = regression.hash_split(df, F.col("k"))
    assert train.count() + test.count() == 51
    assert test.filter(F.col("k").isNull()).count() == 1
