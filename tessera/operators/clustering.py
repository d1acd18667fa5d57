"""K-Means assignment and the shrinking refinement around an anchor point.

K-Means runs on coordinates in whole micro-degrees, so every sum is exact and the
clusters are a function of the points alone: any number of partitions, any order
of rows and any cluster size give the same result.

- Seeds: the points are ordered by a hash of (seed, id); the first
  ``SEED_CANDIDATES`` of them are the candidates (one top-k, bounded whatever the
  input). The first candidate is the first seed, and the next one is always the
  candidate farthest from the seeds so far.
- Rounds (Lloyd): every point goes to its nearest centre, ties to the lower number,
  and a centre moves to the floor of its members' mean. One aggregate a round with
  partial sums, so at most k rows a task are shuffled and k rows reach the driver. It
  ends when no centre moves more than ``TOLERANCE`` or after ``MAX_ITER`` rounds (the
  defaults of Spark ML's K-Means). The micro-degrees are columns of the cached points:
  a round only subtracts and multiplies whole numbers.

Refinement: cluster all points with k = ``start_k``; keep the cluster that holds the
anchor; measure its radius (largest great-circle distance of a member to the cluster
centre); while the radius exceeds the limit, cluster the kept points again with k one
smaller (never below ``min_k``: the sequence is 7, 6, 5, 4, 3, 2, 2, ...).

The refinement is data: each round writes its members, with the round's k, centre and
every member's distance, to one table in the shared checkpoint folder, and the next
round reads its points from there. That cuts the lineage, so a lost executor costs
one round at most, and every report on the refinement (rounds, members, counts) is a
query over that table. Only centres, one radius and one count a round reach the
driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from tessera.functions.geo import haversine_km
from tessera.functions.numeric import percent
from tessera.session import checkpoint_root, temporary_path

LAT, LON = "latitude_wgs84", "longitude_wgs84"
Y, X = "_micro_lat", "_micro_lon"
MICRO = 1_000_000
SEED_CANDIDATES = 64
MAX_ITER = 20
TOLERANCE = 100  # micro-degrees
Centre = tuple[int, int]  # latitude, longitude


def micro_degrees(degrees: Column) -> Column:
    return F.round(degrees * MICRO).cast("long")


def _apart(a: Centre, b: Centre) -> int:
    return (a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2


def seeds(points: DataFrame, k: int, seed: int, id_col: str, lat: str, lon: str) -> list[Centre]:
    """At most k distinct points, far from each other."""
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")).cast("binary"))
    first = points.orderBy(order, lat, lon).select(micro_degrees(F.col(lat)), micro_degrees(F.col(lon)))
    candidates = [tuple(r) for r in first.limit(SEED_CANDIDATES).collect()]
    chosen = candidates[:1]
    while candidates and len(chosen) < k:
        farthest = max(candidates, key=lambda c: min(_apart(c, s) for s in chosen))  # the first of equals
        if farthest in chosen:
            break  # fewer distinct points than k
        chosen.append(farthest)
    return chosen


def _places(centres: Sequence[Centre]) -> Column:
    # One folded array literal: the generated code is the same for all centres of one k.
    return F.array(*[F.lit(v) for centre in centres for v in centre])


def _distances(centres: Sequence[Centre], y: str, x: str) -> list[Column]:
    at = _places(centres)

    def distance(i: int) -> Column:
        dy, dx = F.col(y) - F.get(at, F.lit(2 * i)), F.col(x) - F.get(at, F.lit(2 * i + 1))
        return dy * dy + dx * dx

    return [distance(i) for i in range(len(centres))]


def nearest(centres: Sequence[Centre], y: str = Y, x: str = X) -> Column:
    """The number of the centre nearest to a place in whole micro-degrees; ties go to
    the lower number."""
    if len(centres) == 1:
        return F.lit(0)
    return F.least(*[F.struct(d.alias("d"), F.lit(i).alias("i")) for i, d in enumerate(_distances(centres, y, x))])["i"]


def with_micro_degrees(points: DataFrame, lat: str = LAT, lon: str = LON) -> DataFrame:
    """The points with their whole micro-degrees as columns: rounding a double costs far
    more than a distance, and every distance needs both numbers."""
    return points.withColumns({Y: micro_degrees(F.col(lat)), X: micro_degrees(F.col(lon))})


def lloyd(points: DataFrame, centres: Sequence[Centre], max_iter: int = MAX_ITER, tolerance: int = TOLERANCE) -> list[Centre]:
    """The centres of points ``with_micro_degrees`` after at most ``max_iter`` rounds; one
    without members stays."""
    centres = list(centres)
    for _ in range(max_iter):
        sums = points.groupBy(nearest(centres).alias("c")).agg(
            F.sum(Y).alias("y"), F.sum(X).alias("x"), F.count(F.lit(1)).alias("n")
        )
        moved = 0
        for row in sums.collect():  # at most k rows
            new = (row["y"] // row["n"], row["x"] // row["n"])
            moved = max(moved, _apart(new, centres[row["c"]]))
            centres[row["c"]] = new
        if moved <= tolerance * tolerance:
            break
    return centres


def fit_kmeans(points: DataFrame, k: int, seed: int = 1, id_col: str = "id", lat: str = LAT, lon: str = LON) -> list[Centre]:
    """Centres in micro-degrees; points without a coordinate take no part."""
    known = points.select(id_col, lat, lon).where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    kept = with_micro_degrees(known, lat, lon).persist()
    try:
        first = seeds(kept, k, seed, id_col, lat, lon)
        return lloyd(kept, first) if first else []
    finally:
        kept.unpersist()


def kmeans_assign(
    points: DataFrame, k: int = 7, seed: int = 1, id_col: str = "id", lat: str = LAT, lon: str = LON,
    centres: Sequence[Centre] | None = None, keep: Sequence[str] = (),
) -> DataFrame:
    """``id``, ``cluster`` for every point; null for a point without coordinates. With
    ``centres``, those of an earlier fit are used; columns named in ``keep`` stay."""
    if centres is None:
        centres = fit_kmeans(points, k, seed, id_col, lat, lon)
    known = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    cluster = F.when(known, nearest(centres)) if centres else F.lit(None)
    return with_micro_degrees(points, lat, lon).select(F.col(id_col), *keep, cluster.cast("int").alias("cluster"))


@dataclass
class RefineResult:
    """``history``: the members of every round (column ``round``), each with k,
    n_before, cluster, center_lat, center_lon and distance_km of its round."""

    history: DataFrame
    last_round: int

    @property
    def members(self) -> DataFrame:
        """The points of the final cluster."""
        return self.history.where(F.col("round") == self.last_round)


def kmeans_refine(
    points: DataFrame,
    anchor_id,
    start_k: int = 7,
    min_k: int = 2,
    max_radius_km: float = 3.0,
    seed: int = 1,
    id_col: str = "id",
    lat: str = LAT,
    lon: str = LON,
) -> RefineResult:
    """Shrink the anchor's cluster until its radius is at most ``max_radius_km``,
    however many rounds it takes. A round at ``min_k`` that keeps every point cannot
    progress and raises, as do an anchor id that is missing, has no coordinates, or
    belongs to several points."""
    spark = points.sparkSession
    checkpoint_root(spark)  # fail fast when no shared folder is configured
    path = temporary_path(spark, "refinement")
    current = points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    n_before, anchors = current.agg(F.count(F.lit(1)), F.count_if(F.col(id_col) == anchor_id)).first()
    if anchors != 1:
        raise ValueError(f"anchor {anchor_id!r} must be the id of exactly one point with coordinates")
    k = start_k
    for number in count(1):
        centres = fit_kmeans(current, k, seed, id_col, lat, lon)
        cluster = F.col("cluster")
        at = _places(centres)
        assigned = with_micro_degrees(current, lat, lon).withColumn("cluster", nearest(centres)).drop(Y, X)
        # The anchor's cluster is found in the plan: a semi-join with the anchor's one row.
        home = assigned.where(F.col(id_col) == anchor_id).select("cluster")
        members = (
            assigned.join(home, "cluster", "left_semi")
            .withColumns({"k": F.lit(k), "n_before": F.lit(n_before).cast("long")})
            .withColumn("center_lat", F.get(at, 2 * cluster) / MICRO)
            .withColumn("center_lon", F.get(at, 2 * cluster + 1) / MICRO)
            .withColumn("distance_km", haversine_km(F.col(lat), F.col(lon), F.col("center_lat"), F.col("center_lon")))
        )
        members.write.parquet(f"{path}/round={number}")
        kept = spark.read.schema(members.schema).parquet(f"{path}/round={number}")
        n_after, radius = kept.agg(F.count(F.lit(1)), F.max("distance_km")).first()
        if radius <= max_radius_km:
            history = spark.read.schema(members.schema.add("round", IntegerType())).parquet(path)
            return RefineResult(history, number)
        if k == min_k and n_after == n_before:
            raise RuntimeError(f"k = {k} keeps all {n_after} points at a radius of {radius:.3f} km")
        current, n_before, k = kept.select(*points.columns), n_after, max(k - 1, min_k)


def rounds_frame(result: RefineResult) -> DataFrame:
    """One row per refinement round: round, k, n_before, n_after, cluster, centre and
    radius in km (rounded to 6 digits)."""
    return result.history.groupBy("round", "k", "n_before", "cluster", "center_lat", "center_lon").agg(
        F.count(F.lit(1)).alias("n_after"), F.round(F.max("distance_km"), 6).alias("radius_km")
    ).select("round", "k", "n_before", "n_after", "cluster", "center_lat", "center_lon", "radius_km")


def checks_frame(
    points: DataFrame, assigned: DataFrame, centres: Sequence[Centre], result: RefineResult, anchor_id, max_radius_km: float,
    lat: str = LAT, lon: str = LON,
) -> DataFrame:
    """What must hold, as one row: every point is assigned, none to a centre that is
    not its nearest (``assigned`` has the coordinates of its points); each round starts
    from what the one before kept; the anchor is a member of every round, and the radius
    is within the limit at the end."""
    rounds = rounds_frame(result)
    before = rounds.select((F.col("round") + 1).alias("round"), F.col("n_after").alias("kept_before"))
    chained = rounds.join(before, "round").agg(F.coalesce(F.bool_and(F.col("kept_before") == F.col("n_before")), F.lit(True)).alias("rounds_chained"))
    anchored = result.history.groupBy("round").agg((F.count_if(F.col("id") == anchor_id) == 1).alias("ok")).agg(F.bool_and("ok").alias("anchor_present"))
    within = result.members.agg((F.max("distance_km") <= max_radius_km).alias("radius_within_limit"))
    apart = F.array(*_distances(centres, Y, X)) if centres else F.array(F.lit(0))
    nearer = F.get(apart, F.col("cluster")) > F.array_min(apart)
    # A cluster that has no centre is not the nearest one either.
    wrong = F.col("cluster").isNotNull() & F.coalesce(nearer, F.lit(True))
    found = with_micro_degrees(assigned, lat, lon).agg(
        F.count("cluster").alias("points_assigned"), F.count_if(wrong).alias("not_nearest")
    )
    counts = points.agg(F.count(F.lit(1)).alias("points_in"))
    one_row = counts
    for part in (found, chained, anchored, within):  # aggregates without keys: one row each
        one_row = one_row.join(part, how="cross")
    return one_row


def final_counts(members: DataFrame, postal_col: str, postal_code) -> DataFrame:
    """Members of the final cluster, those with one postal code, and their
    share in percent -- one pass, one row."""
    in_code = F.count_if(F.col(postal_col) == postal_code)
    total = F.count(F.lit(1))
    return members.agg(
        total.alias("members"),
        in_code.alias("members_in_postal_code"),
        percent(in_code, total).alias("share_pct"),
    )
