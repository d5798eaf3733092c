"""Centroid clustering in whole numbers, with a PCA-rotated filter before every exact distance.

A vector is kept if it has exactly ``size`` components, all finite; each component x becomes floor(1024 x), which is
a whole double of any size. Once, the kept vectors are rotated about their mean onto the leading axes of their
covariance, as many as hold ``SHARE`` of the variance, and stored with these coordinates and the norm of what is left. For a vector and a centroid,

    projected distance ^ 2 + (difference of the two left norms) ^ 2  <=  distance ^ 2.

In each round a vector is verified in whole numbers against the centroid with the smallest bound, and then against those
whose bound, less a slack for rounding, does not exceed what that gave. Others cannot be nearer, so the assignment is
the exact one: smallest distance, then smallest number. Rotation and bounds decide only how much is verified.

Sums are added per task and then by key, in limbs of 40 bits, so none overflows; floor(sum / count) is taken of the
whole sums. The driver gets the 64 x 64 second moments and 65 sums a cluster, whatever the number of vectors.

Other vectors are left out. Each row is a vector of its own, also with a repeated or null id (null: empty text in the
hash). Equal hashes fall to the vector's components. Fewer kept vectors than clusters make fewer clusters; none give
no rows. A distance that a long cannot hold is null, and so are the sums it belongs to. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.staging import stage

SIZE, CLUSTERS, ROUNDS = 64, 8, 10
SHARE = 0.9
#: Below this size of all components a distance fits 62 bits.
SMALL = float(1 << 27)
#: Vectors that are worked on at once.
ROWS = 16_384
LONG = 1 << 63
LIMB = 40
COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "n_verified"]


def whole_vectors(embeddings: DataFrame, vector: str = "embedding", size: int = SIZE) -> DataFrame:
    """``vec_id`` and ``q``, the kept vectors as whole doubles."""
    doubles = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    scaled = F.transform(doubles, lambda x: x * F.lit(1024.0))
    # floor of a double gives a BIGINT; from 2^52 on a double is whole as it is
    whole = F.transform(scaled, lambda x: F.when(F.abs(x) < F.lit(float(1 << 52)), F.floor(x).cast("double")).otherwise(x))
    return embeddings.where((F.size(vector) == size) & finite).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("q"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = 3) -> list[list[int]]:
    """The vectors with the smallest hashes of their ids."""
    identity = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    ranked = vectors.orderBy(F.sha2(identity.cast("binary"), 256), "q").limit(clusters)
    return [[int(x) for x in row["q"]] for row in ranked.select("q").collect()]


def matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    values = batch.column(batch.schema.get_field_index(column))
    return values.flatten().to_numpy().reshape(len(values), -1)


def parts(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, ROWS):
            yield batch.slice(low, ROWS)


@dataclass
class Rotation:
    """About ``centre``, onto the rows of ``axes``."""

    centre: np.ndarray
    axes: np.ndarray

    def turn(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Leading coordinates, the norm of what is left, and the squared norm."""
        moved = q - self.centre
        leading = moved @ self.axes.T
        norm = (moved * moved).sum(1)
        return leading, np.sqrt(np.maximum(norm - (leading * leading).sum(1), 0)), norm


def principal_rotation(vectors: DataFrame, size: int, share: float = SHARE) -> Rotation:
    """From the first and second moments of all vectors, added per task in doubles."""

    def moments(batches):
        # larger components would only blur the axes; any rotation gives true bounds
        total, square, count = np.zeros(size), np.zeros((size, size)), 0
        for part in parts(batches):
            q = np.clip(matrix(part, "q"), -SMALL, SMALL)
            total, square, count = total + q.sum(0), square + q.T @ q, count + len(q)
        if count:
            x = np.concatenate([square.ravel(), total, [count]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(x))), pa.array(x)], names=["at", "x"])

    found = np.zeros(size * size + size + 1)
    for row in vectors.select("q").mapInArrow(moments, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).collect():
        found[row["at"]] = row["x"]
    count = max(found[-1], 1)
    centre = found[size * size : -1] / count
    covariance = found[: size * size].reshape(size, size) / count - np.outer(centre, centre)
    spread, axes = np.linalg.eigh(np.nan_to_num(covariance + covariance.T))
    held = np.cumsum(np.maximum(spread[::-1], 0))
    many = 1 + int(np.searchsorted(held, share * held[-1]))
    return Rotation(centre, np.ascontiguousarray(axes[:, ::-1].T[: min(many, size)]))


def rotated(vectors: DataFrame, rotation: Rotation) -> DataFrame:
    """The vectors with their leading coordinates ``p``, the norm of the rest ``left``, and the squared norm ``norm``."""
    shared = vectors.sparkSession.sparkContext.broadcast(rotation)

    def run(batches):
        for part in parts(batches):
            with np.errstate(over="ignore", invalid="ignore"):
                leading, left, norm = shared.value.turn(matrix(part, "q"))
                leading = leading.astype(np.float32)
            ends = pa.array(np.arange(0, leading.size + 1, leading.shape[1]), pa.int32())
            columns = [part.column(0), part.column(1), pa.ListArray.from_arrays(ends, pa.array(leading.ravel())), pa.array(left), pa.array(norm)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "q", "p", "left", "norm"])

    return vectors.mapInArrow(run, "vec_id long, q array<double>, p array<float>, left double, norm double")


def columns(part: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    left, norm = (part.column(part.schema.get_field_index(name)).to_numpy() for name in ("left", "norm"))
    return matrix(part, "q"), matrix(part, "p").astype(float), left, norm


class Centroids:
    """Centroids as whole numbers of any size, and rotated."""

    def __init__(self, whole: list[list[int]], rotation: Rotation):
        self.whole = whole
        q = np.array(whole, float)
        with np.errstate(over="ignore", invalid="ignore"):
            self.leading, self.left, self.norm = rotation.turn(q)
        self.small = bool((np.abs(q) < SMALL).all())
        self.q = np.array(whole, np.int64 if self.small else object)

    def nearest(self, q: np.ndarray, p: np.ndarray, left: np.ndarray, norm: np.ndarray) -> tuple[np.ndarray, ...]:
        """Number and exact squared distance of each vector's centroid, how many distances were verified, and the vectors
        as whole numbers: of 64 bits, or any where one is not small."""
        if self.small and (np.abs(q) < SMALL).all():
            q = q.astype(np.int64)
        else:
            q = np.array([[int(x) for x in row] for row in q.tolist()], object).reshape(q.shape)
        # less what rounding may have added; where a number does not hold the norms, everything is verified
        with np.errstate(over="ignore", invalid="ignore"):
            bound = (p * p).sum(1)[:, None] - 2 * (p @ self.leading.T) + (self.leading * self.leading).sum(1) + (left[:, None] - self.left) ** 2
            bound -= 1e-6 * (norm[:, None] + self.norm) + 1e-3
        bound = np.where(np.isfinite(bound), bound, -np.inf)
        cluster = bound.argmin(1)
        best = exact(q, self.q[cluster])
        first, limit = cluster.copy(), doubles(best) * (1 + 1e-12)
        verified = np.ones(len(q), np.int32)
        for number in range(len(self.whole)):
            near = np.flatnonzero((bound[:, number] <= limit) & (first != number))
            if len(near):
                distance = exact(q[near], self.q[number])
                better = (distance < best[near]) | ((distance == best[near]) & (number < cluster[near]))
                best[near[better]], cluster[near[better]] = distance[better], number
                verified[near] += 1
        return cluster, best, verified, q


def doubles(whole: np.ndarray) -> np.ndarray:
    if whole.dtype != object:
        return whole.astype(float)
    return np.array([float(x) if x < 10**300 else np.inf for x in whole])


def exact(q: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    apart = q - centroid
    return (apart * apart).sum(1)


def assigned(part: pa.RecordBatch, centroids: Centroids) -> tuple[np.ndarray, ...]:
    cluster, best, _, q = centroids.nearest(*columns(part))
    return cluster, best, q


def limbs(x: int) -> list[int]:
    """A whole number of any size as parts of ``LIMB`` bits, the last with its sign; parts of many can be added apart."""
    out = []
    while abs(x) >> LIMB:
        out.append(x & ((1 << LIMB) - 1))
        x >>= LIMB
    return [*out, x]


def moved(stored: DataFrame, centroids: Centroids, size: int) -> list[list[int]]:
    """The centroids after one round: exact floor(sum / count) of each cluster that has vectors."""
    shared = stored.sparkSession.sparkContext.broadcast(centroids)

    def run(batches):
        total = [[0] * (size + 1) for _ in shared.value.whole]
        for part in parts(batches):
            cluster, _, q = assigned(part, shared.value)
            for number in np.unique(cluster).tolist():
                mine = q[cluster == number]
                total[number] = [a + int(b) for a, b in zip(total[number], [*mine.sum(0), len(mine)], strict=True)]
        rows = [(number, at, place, limb) for number, line in enumerate(total) for at, x in enumerate(line) if line[-1] for place, limb in enumerate(limbs(x))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=["cluster", "at", "place", "x"])

    cells = stored.select("q", "p", "left", "norm").mapInArrow(run, "cluster long, at long, place long, x long")
    found = [[0] * (size + 1) for _ in centroids.whole]
    for row in cells.groupBy("cluster", "at", "place").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect():
        found[row["cluster"]][row["at"]] += int(row["x"]) << (LIMB * row["place"])
    return [[x // line[-1] for x in line[:-1]] if line[-1] else old for line, old in zip(found, centroids.whole, strict=True)]


def cluster_vectors(embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, size: int = SIZE, seed: int = 3) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``; and ``n_verified``, the
    distances that were taken in whole numbers for the vector's last assignment."""
    spark = embeddings.sparkSession
    kept = whole_vectors(embeddings, size=size)
    whole = first_centroids(kept, clusters, seed)
    facts = "cluster int, cluster_inertia long, centroid_sha256 string"
    if not whole:
        return spark.createDataFrame([], f"vec_id long, {facts}, distance long, inertia long, n_verified int").select(*COLUMNS)
    rotation = principal_rotation(kept, size)
    stored = stage(rotated(kept, rotation), "rotated")
    for _ in range(rounds):
        whole = moved(stored, Centroids(whole, rotation), size)
    shared = spark.sparkContext.broadcast(Centroids(whole, rotation))

    def run(batches):
        for part in parts(batches):
            q, p, left, norm = columns(part)
            cluster, best, verified, _ = shared.value.nearest(q, p, left, norm)
            fits = pa.array([int(x) if x < LONG else None for x in best] if best.dtype == object else best, pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(cluster, pa.int32()), fits, pa.array(verified, pa.int32())], names=["vec_id", "cluster", "distance", "n_verified"])

    found = stage(stored.mapInArrow(run, "vec_id long, cluster int, distance long, n_verified int"), "assigned")
    total = F.when(F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(38,0)")))
    sums = {row["cluster"]: row["x"] for row in found.groupBy("cluster").agg(total.alias("x")).collect()}
    digests = [hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest() for centroid in whole]
    rows = [(number, fitting(x), digests[number]) for number, x in sums.items()]
    both = found.join(F.broadcast(spark.createDataFrame(rows, facts)), "cluster", "left")
    inertia = fitting(None if None in sums.values() else sum(sums.values()))
    return both.withColumn("inertia", F.lit(inertia).cast("long")).select(*COLUMNS)


def fitting(x: int | None) -> int | None:
    return int(x) if x is not None and x < LONG else None
