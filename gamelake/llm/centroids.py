"""Centroid clustering (operator 13): Lloyd rounds as column expressions.

Vectors become integer arrays once. A round is one aggregation: ``zip_with``
and ``aggregate`` give the squared distance to each literal centroid array,
``array_min`` over (distance, number) structs picks the cluster, and one sum
per component, combined map-side, moves the centroids. Only the sums of the k
clusters reach the driver, whatever the number of vectors. No Python runs in
a task.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamelake.llm.tables import written

K = 16
ROUNDS = 3
SCALE = 64
DIMENSIONS = 64
#: Scaled components must stay below this, so that squared distances fit 64 bits.
REACH = float(1 << 27)


def integers(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE,
             id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): vectors of ``dimensions`` finite components as floor(scale * x).

    Vectors that are null, of another length, or hold a null or non-finite
    component are left out; so are those whose scaled components reach 2**27,
    as their squared distances need not fit 64 bits.
    """
    v = F.transform(F.col(vector_col), lambda x: F.lit(float(scale)) * x.cast("double"))
    fits = F.forall(v, lambda x: F.coalesce(F.abs(x) < REACH, F.lit(False)))  # false for null and infinite; NaN is above all numbers
    return (vectors.select(F.col(id_col).alias("vec_id"), v.alias("v"))
            .filter((F.size("v") == dimensions) & fits)
            .select("vec_id", F.transform("v", lambda x: F.floor(x).cast("int")).alias("v")))


def starts(ints: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The k vectors of smallest sha256 of ``seed:vec_id``, in that order (rows without an id last)."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = ints.select(key.alias("key"), "v").orderBy(F.asc_nulls_last("key"), "v").limit(k).collect()
    return [list(r["v"]) for r in rows]


def nearest(centroids: list[list[int]]) -> Column:
    """Struct (distance, cluster) of the nearest centroid; equal distances go to the smaller number."""
    def distance(c: list[int]) -> Column:
        squares = F.zip_with(F.col("v"), F.array(*[F.lit(int(x)).cast("long") for x in c]), lambda x, y: (x - y) * (x - y))
        return F.aggregate(squares, F.lit(0).cast("long"), lambda total, s: total + s)

    return F.array_min(F.array(*[F.struct(distance(c).alias("distance"), F.lit(i).alias("cluster")) for i, c in enumerate(centroids)]))


def moved(ints: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Centroids after one round: componentwise floor(sum / count); empty clusters keep theirs."""
    rows = (ints.select(nearest(centroids)["cluster"].alias("cluster"), "v")
            .groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(len(centroids[0]))])
            .collect())
    out = list(centroids)
    for r in rows:  # at most k rows
        out[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(len(centroids[0]))]
    return out


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = 1, dimensions: int = DIMENSIONS, scale: int = SCALE,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 per kept vector.

    Every row counts by itself, also where rows or ids repeat; a row without
    an id is clustered but starts a centroid only if too few others exist.
    With fewer than k vectors there are as many centroids as vectors; equal
    start vectors leave the later centroid empty. No vectors: no rows. Other
    columns are ignored.
    """
    spark = vectors.sparkSession
    ints = written(integers(vectors, dimensions, scale, id_col, vector_col), "centroid-ints")
    centroids = starts(ints, k, seed)
    if not centroids:
        return ints.select("vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
                           F.lit("").alias("centroid_sha256"))
    for _ in range(rounds):
        centroids = moved(ints, centroids)
    near = nearest(centroids)
    assigned = written(ints.select("vec_id", near.alias("near")).select("vec_id", "near.cluster", "near.distance"), "centroid-assigned")
    totals = {r["cluster"]: r["total"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    names = [(i, totals.get(i, 0), sum(totals.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
             for i, c in enumerate(centroids)]
    per_cluster = spark.createDataFrame(names, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(per_cluster), "cluster").select(  # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
