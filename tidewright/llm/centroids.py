"""Integer k-means in JVM expressions.

Components become integers once, in a stored table. A round is one pass:
`zip_with` and `aggregate` give the squared distance to every centroid, whose
components stand in the plan as literal arrays; `array_min` over (distance,
number) chooses the cluster; one sum a component and cluster, partly added
before the shuffle, moves the centroids. At most `k` rows of sums come to the
driver in a round, whatever the number of vectors.

Defined cases: vectors that are null, of another length or hold a null, NaN or
infinite component are left out; repeated rows and rows without an id count as
vectors of their own (an absent id hashes as the empty text; equal hashes are
ordered by the vector); fewer vectors than `k` give fewer centroids; an empty
table gives an empty result; other columns are ignored. A component whose
integer is so large that a squared distance might leave 64 bits (2^27 for 64
components) is an error that says so.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, functions as F

from tidewright.llm.common import picked
from tidewright.session import written

COMPONENTS = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = 3

RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def largest_component(components: int) -> int:
    """Integers of less than this size keep a sum of squared differences within 62 bits."""
    return 1 << (62 - math.ceil(math.log2(max(1, components)))) // 2 - 1


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, components: int, scale: int) -> DataFrame:
    """vec_id and `v`, floor(scale * x) of every component, of the vectors that are whole."""
    rows = picked(vectors, vec_id=id_col, v=vector_col).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("v").cast("array<double>").alias("v")
    )
    whole = (F.size("v") == components) & F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))
    )
    limit = largest_component(components)

    def integer(x: Column) -> Column:
        scaled = F.floor(x * scale)
        return F.when(F.abs(x * scale) < limit, scaled).otherwise(
            F.raise_error(F.lit(f"a component times {scale} is not under {limit}")).cast("bigint")
        ).cast("int")

    return rows.where(whole).select("vec_id", F.transform("v", integer).alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [list(r.v) for r in vectors.orderBy(name, "v").limit(k).select("v").collect()]


def squared_distance(vector: Column, centroid: list[int]) -> Column:
    fixed = F.array(*[F.lit(x).cast("bigint") for x in centroid])
    return F.aggregate(
        F.zip_with(vector, fixed, lambda x, c: (x - c) * (x - c)), F.lit(0).cast("bigint"), lambda total, x: total + x
    )


def nearest(centroids: list[list[int]]) -> Column:
    """Struct (distance, cluster) of the nearest centroid, the smaller number on ties."""
    return F.array_min(
        F.array(
            *[
                F.struct(squared_distance(F.col("v"), c).alias("distance"), F.lit(i).alias("cluster"))
                for i, c in enumerate(centroids)
            ]
        )
    )


def moved_centroids(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Floor of the mean of every cluster's vectors; an empty cluster's centroid stays."""
    components = len(centroids[0])
    near = vectors.select(nearest(centroids)["cluster"].alias("cluster"), "v")
    sums = near.groupBy("cluster").agg(
        F.count("*").alias("n"), *[F.sum(F.get("v", F.lit(i)).cast("bigint")).alias(f"s{i}") for i in range(components)]
    )
    moved = list(centroids)
    # One row a centroid at most.
    for row in sums.collect():
        moved[row.cluster] = [row[f"s{i}"] // row.n for i in range(components)]
    return moved


def fit(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> list[list[int]]:
    """Centroids after the rounds; once none moves, no later round moves any."""
    centroids = first_centroids(vectors, k, seed)
    for _ in range(rounds if centroids else 0):
        before, centroids = centroids, moved_centroids(vectors, centroids)
        if centroids == before:
            break
    return centroids


def clustered(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = SEED,
) -> DataFrame:
    """Cluster of every whole vector with its squared distance, the sums of distances, and its centroid's digest."""
    spark = vectors.sparkSession
    integers = written(integer_vectors(vectors, id_col, vector_col, components, scale), "vectors")
    centroids = fit(integers, k, rounds, seed)
    if not centroids:
        return spark.createDataFrame([], RESULT)
    near = integers.select("vec_id", nearest(centroids).alias("near"))
    found = written(near.select("vec_id", "near.cluster", "near.distance"), "clusters")
    inertia = {r.cluster: r.n for r in found.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def of_cluster(values: list, kind: str) -> Column:
        return F.get(F.array(*[F.lit(x).cast(kind) for x in values]), F.col("cluster"))

    return found.select(
        "vec_id",
        "cluster",
        "distance",
        of_cluster([inertia.get(i, 0) for i in range(len(centroids))], "bigint").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("bigint").alias("inertia"),
        of_cluster(digests, "string").alias("centroid_sha256"),
    )
