"""Centroid clustering: Lloyd's rounds with the components dealt over shards.

The components are cut into blocks of ``COLUMNS``; a shard holds one column block of a chunk of vectors, and
partitions hold shards of one block. Each round a shard computes exact partial squared distances of its chunk to the
block's slice of the centroids; ``reduceByKey`` adds the partials of a chunk and the least sum decides. The labels go back to the shards,
which add up their components by centroid, and each block replaces its own slice. Shards are shuffled once: they and
the labels share a partitioner, so that the rounds move partial distances and labels only.

Everything is whole numbers. Partials are 32-bit where the extent of all components proves that no distance needs
more. The driver holds the centroids, clusters times components, and no row per vector.

Defined cases: null vectors, those of another length than ``width``, those holding a null, NaN or infinity, and rows with a null ``vec_id``
are dropped; rows repeated under one id are vectors of their own, the smaller vector first among equal hashes; fewer
vectors than clusters give as many clusters; equal distances go to the smaller number, and an empty cluster keeps its centroid; squared
distances and sums must fit in 64 bits; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import binary, stored
from wayfare.llm.mtree import whole_vectors

CLUSTERS, ROUNDS, WIDTH = 40, 5, 64
COLUMNS = 32
ABOUT = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
CLUSTERED = f"vec_id long, cluster int, distance long, {ABOUT.removeprefix('cluster int, ')}"
# Vectors of a chunk; bytes of partial distances that a partition makes.
CHUNK = 1024
PARTIALS = 64 << 20


def partial(block: np.ndarray, centroids: np.ndarray, kind: type) -> np.ndarray:
    """Squared distances of the rows of ``block`` to each of ``centroids``, in whole numbers."""
    out = np.empty((len(block), len(centroids)), kind)
    for c, centroid in enumerate(centroids):
        gap = block.astype(kind) - centroid.astype(kind)
        out[:, c] = np.einsum("ij,ij->i", gap, gap)
    return out


def block_sums(block: np.ndarray, labels: np.ndarray, clusters: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows and number of rows, by label."""
    order = np.argsort(labels, kind="stable")
    counts = np.bincount(labels, minlength=clusters)
    sums = np.zeros((clusters, block.shape[1]), np.int64)
    used = np.flatnonzero(counts)
    sums[used] = np.add.reduceat(block[order].astype(np.int64), (np.cumsum(counts) - counts)[used], axis=0)
    return sums, counts


def dealt(chunk: int) -> int:
    """Where the partials of a chunk meet: its task and its number in the task."""
    return (chunk >> 32) * 1_000_003 + (chunk & 0xFFFFFFFF)


class Shards:
    """The column blocks of all chunks, dealt so that a partition holds chunks of one block."""

    def __init__(self, vectors: DataFrame, columns: int, clusters: int):
        self.spark = vectors.sparkSession
        low, high, n, width = vectors.agg(F.min(F.array_min("v")), F.max(F.array_max("v")), F.count("*"), F.max(F.size("v"))).first()
        starts = self.starts = list(range(0, width, columns))
        # Centroids lie between the least and the greatest component.
        short = max(width * (high - low) ** 2, abs(low), abs(high)) < 2**31
        kind = self.kind = np.int32 if short else np.int64

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            chunk = TaskContext.get().partitionId() << 32
            for batch in batches:
                for first in range(0, batch.num_rows, CHUNK):
                    part = batch.slice(first, CHUNK)
                    whole = part.column("v").flatten().to_numpy().reshape(part.num_rows, width).astype(kind)
                    blocks = [np.ascontiguousarray(b).tobytes() for b in np.split(whole, starts[1:], axis=1)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([chunk], pa.int64()), binary([part.column("vec_id").to_numpy().tobytes()]),
                         pa.array([blocks], pa.list_(pa.binary()))], ["chunk", "ids", "blocks"])
                    chunk += 1

        # Written once: a task that runs again finds the same chunks.
        self.chunks = stored(vectors.mapInArrow(cut, "chunk long, ids binary, blocks array<binary>"), "chunks")
        partials = n * clusters * np.dtype(kind).itemsize
        spread = max(1, -(-partials // PARTIALS), self.spark.sparkContext.defaultParallelism // len(starts))

        def place(key: tuple[int, int]) -> int:
            return key[0] * spread + dealt(key[1]) % spread

        self.place, self.partitions = place, spread * len(starts)
        rows = self.chunks.select("chunk", F.posexplode("blocks")).rdd
        self.blocks = rows.map(lambda r: ((r[1], r[0]), bytes(r[2]))).partitionBy(self.partitions, place)

    def labels(self, centroids: np.ndarray) -> RDD:
        """``(chunk, (labels, distances))`` of every chunk."""
        kind = self.kind
        slices = self.spark.sparkContext.broadcast(np.split(centroids, self.starts[1:], axis=1))

        def measure(row: tuple) -> tuple:
            (block, chunk), data = row
            own = slices.value[block]
            return chunk, partial(np.frombuffer(data, kind).reshape(-1, own.shape[1]), own, kind)

        def decide(total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            found = total.argmin(1)
            return found.astype(np.int32), total[np.arange(len(total)), found].astype(np.int64)

        return self.blocks.map(measure).reduceByKey(np.add, self.partitions, dealt).mapValues(decide)

    def updated(self, centroids: np.ndarray) -> np.ndarray:
        """The centroids after one more round."""
        kind, blocks, clusters = self.kind, len(self.starts), len(centroids)

        def back(row: tuple) -> list[tuple]:
            chunk, (found, _) = row
            return [((block, chunk), found) for block in range(blocks)]

        def add(rows: Iterator[tuple]) -> Iterator[tuple]:
            # The partition's labels come first and are held; its shards pass by.
            found, totals = {}, {}
            for (block, chunk), value in rows:
                if isinstance(value, np.ndarray):
                    found[block, chunk] = value
                    continue
                own = found[block, chunk]
                sums, counts = block_sums(np.frombuffer(value, kind).reshape(len(own), -1), own, clusters)
                if block in totals:
                    sums, counts = sums + totals[block][0], counts + totals[block][1]
                totals[block] = sums, counts
            yield from totals.items()

        to_shards = self.labels(centroids).flatMap(back).partitionBy(self.partitions, self.place)
        totals = to_shards.union(self.blocks).mapPartitions(add).reduceByKey(
            lambda a, b: (a[0] + b[0], a[1] + b[1]), blocks).collectAsMap()
        new = np.split(centroids, self.starts[1:], axis=1)
        for block, (sums, counts) in totals.items():
            used = counts > 0
            new[block] = new[block].copy()
            new[block][used] = sums[used] // counts[used, None]
        return np.hstack(new)


def cluster(rows: DataFrame, vector: str = "embedding", scale: int = 256, width: int = WIDTH, clusters: int = CLUSTERS,
            rounds: int = ROUNDS, seed: str = "2:", columns: int = COLUMNS) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector that is kept."""
    spark = rows.sparkSession
    kept = stored(whole_vectors(rows, vector, scale).where(F.size("v") == width), "whole-vectors")
    first = kept.orderBy(F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256), "v").limit(clusters).select("v").collect()
    if not first:
        return spark.createDataFrame([], CLUSTERED)
    centroids = np.array([r["v"] for r in first], np.int64)
    shards = Shards(kept, columns, clusters)
    for _ in range(rounds):
        centroids = shards.updated(centroids)
    last = spark.createDataFrame(
        shards.labels(centroids).map(lambda r: (r[0], r[1][0].tobytes(), r[1][1].tobytes())), "chunk long, labels binary, distances binary")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, found, far in zip(*batch.columns, strict=True):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(ids.as_py(), np.int64)), pa.array(np.frombuffer(found.as_py(), np.int32)),
                     pa.array(np.frombuffer(far.as_py(), np.int64))], ["vec_id", "cluster", "distance"])

    found = stored(shards.chunks.select("chunk", "ids").join(last, "chunk").select("ids", "labels", "distances").mapInArrow(
        spell, "vec_id long, cluster int, distance long"), "clustered")
    # A row per cluster.
    by_cluster = {r["cluster"]: r["d"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    about = [(c, by_cluster[c], sum(by_cluster.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
             for c in by_cluster]
    return found.join(F.broadcast(spark.createDataFrame(about, ABOUT)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
