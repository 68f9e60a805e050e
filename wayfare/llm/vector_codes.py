"""Vector code compression: product codes whose nearest entries are found with LAESA pivots.

Every vector is cut into ``PARTS`` equal parts; each part position has a codebook, and a vector's code is the number of the
nearest entry at each position. Some entries of the first codebook, each the farthest from those chosen before, are
the position's pivots for good. The distances of all parts to their pivots are computed once and stored beside the parts.
In a round only the distances between pivots and entries are new: the greatest difference of the two
over the pivots bounds the distance of part and entry from below (triangle inequality). Entries are taken in the order
of these bounds, and only those whose bound does not exceed the best distance so far are evaluated,
exactly, in integers. Bounds are kept a little too small, so that rounding never rules out the nearest entry or a tie.

Codebooks are numbers of entries times components, whatever the table holds; tasks add up their own parts for each
entry, and those sums meet by entry and component. No other rows leave their task before the result.

Defined cases: null vectors and those holding a null, NaN or infinity are dropped, as are rows with a null ``vec_id``; the width is
the commonest length divisible by ``PARTS`` (of several, the least), and vectors of other lengths are dropped too; rows repeated
under one id are vectors of their own, the smaller vector first; fewer vectors than entries give codebooks of that many; equal
distances go to the lower entry, and repeated entries stay unused; squared distances and sums must fit in 64 bits;
null labels are one label; an empty table gives an empty result; columns other than those named are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import stored, vectors
from wayfare.llm.mtree import whole_vectors

PARTS, ENTRIES, ROUNDS = 4, 256, 4
PIVOTS = 16
# How many entries are evaluated before the bounds are compared again.
AHEAD = 16
# Parts whose bounds are held at a time.
ROWS = 2048


class Codebook:
    """The entries of one part position, and its pivots."""

    def __init__(self, entries: np.ndarray, pivots: np.ndarray | None = None):
        self.entries = entries
        self.pivots = spread_entries(entries) if pivots is None else pivots
        self.far = distances(self.entries, self.pivots).T.copy()
        self.evaluated = 0

    def nearest(self, parts: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each part and its squared distance; ``far`` are the parts' distances to the pivots."""
        found = [self._nearest(parts[i:i + ROWS], far[i:i + ROWS]) for i in range(0, len(parts), ROWS)]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def exact(self, parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Squared distances of parts to an entry each, or to one entry, in whole numbers."""
        self.evaluated += len(parts)
        gap = parts - entries
        return np.einsum("ij,ij->i", gap, gap)

    def _nearest(self, parts: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bound = np.zeros((len(parts), len(self.entries)), np.float32)
        for p in range(len(self.pivots)):
            np.maximum(bound, np.abs(far[:, p, None] - self.far[p]), out=bound)
        # Distances are rounded to 24 bits: both may be off by a share of their own size.
        bound -= np.float32(1e-6) * (far.max(1, keepdims=True) + self.far.max() + 1)
        np.maximum(bound, 0, out=bound)
        least = bound.astype(np.float64) ** 2 * (1 - 1e-6)
        entry = bound.argmin(1)
        best = self.exact(parts, self.entries[entry])
        done = np.zeros(bound.shape, bool)
        done[np.arange(len(parts)), entry] = True
        # The entries of the least bounds first, then all whose bounds the best distance still allows.
        for ahead in (AHEAD, bound.shape[1]):
            open_ = (least <= best[:, None]) & ~done
            if ahead < bound.shape[1]:
                open_ &= least < np.partition(least, ahead, axis=1)[:, ahead, None]
            done |= open_
            for number, wanted in enumerate(np.ascontiguousarray(open_.T)):
                row = np.flatnonzero(wanted)
                if len(row):
                    d = self.exact(parts[row], self.entries[number])
                    better = (d < best[row]) | ((d == best[row]) & (number < entry[row]))
                    row = row[better]
                    best[row], entry[row] = d[better], number
        return entry, best


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distance of every row to every pivot, in 32-bit floats."""
    out = np.empty((len(rows), len(pivots)), np.float32)
    for p, pivot in enumerate(pivots):
        gap = (rows - pivot).astype(np.float64)
        out[:, p] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    return out


def spread_entries(entries: np.ndarray) -> np.ndarray:
    """Up to ``PIVOTS`` different entries, each the farthest from those before it."""
    chosen = [0]
    near = distances(entries, entries[:1])[:, 0]
    while len(chosen) < PIVOTS and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(entries, entries[chosen[-1:]])[:, 0])
    return entries[chosen]


def kept_vectors(rows: DataFrame, vector: str, label: str, scale: int) -> DataFrame:
    """``vec_id, v array<long>, label`` of the vectors that take part."""
    own = rows.select("vec_id", F.col(vector).alias("x"), F.col(label).alias("label"))
    whole = stored(whole_vectors(own, "x", scale, "label").where(F.size("v") % PARTS == 0), "whole-vectors")
    lengths = whole.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n"))
    # The commonest width, one row.
    width = lengths.orderBy(F.desc("n"), "width").limit(1).collect()
    return whole.where(F.size("v") == (width[0]["width"] if width else 0))


def matrix(column: pa.Array, kind: type = np.int64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)


def _cut(v: np.ndarray) -> list[np.ndarray]:
    return [np.ascontiguousarray(p) for p in np.split(v, PARTS, axis=1)]


def _assigned(batch: pa.RecordBatch, books: list[Codebook]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each part position of a batch with columns ``v`` and ``far``: parts, entries, squared distances."""
    parts, far = _cut(matrix(batch.column("v"))), np.split(matrix(batch.column("far"), np.float32), PARTS, axis=1)
    return [(p, *book.nearest(p, f[:, :len(book.pivots)])) for p, f, book in zip(parts, far, books, strict=True)]


def compress(rows: DataFrame, vector: str = "embedding", label: str = "label", scale: int = 1024,
             rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every vector that is kept."""
    spark = rows.sparkSession
    kept = kept_vectors(rows, vector, label, scale)
    # As many rows as a codebook has entries.
    head = kept.orderBy("vec_id", "v").limit(ENTRIES).select("v").collect()
    if not head:
        return kept.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    books = [Codebook(p) for p in _cut(np.array([r["v"] for r in head], np.int64))]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = [np.zeros((batch.num_rows, PIVOTS), np.float32) for _ in books]
            for out, part, book in zip(far, _cut(matrix(batch.column("v"))), books, strict=True):
                out[:, :len(book.pivots)] = distances(part, book.pivots)
            ends = pa.array(np.arange(batch.num_rows + 1) * (PARTS * PIVOTS), pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(np.hstack(far).ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "far"])

    kind = kept.schema["label"].dataType.simpleString()
    parts = stored(kept.mapInArrow(measure, f"vec_id long, v array<long>, label {kind}, far array<float>"), "parts")
    for _ in range(rounds):
        held = spark.sparkContext.broadcast(books)

        def add(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            sums = [np.zeros_like(b.entries) for b in held.value]
            counts = [np.zeros(len(b.entries), np.int64) for b in held.value]
            for batch in batches:
                for (part, entry, _), total, n in zip(_assigned(batch, held.value), sums, counts, strict=True):
                    np.add.at(total, entry, part)
                    n += np.bincount(entry, minlength=len(n))
            used = [(p, e) for p, n in enumerate(counts) for e in np.flatnonzero(n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in used], pa.int32()), pa.array([e for _, e in used], pa.int32()),
                 pa.array([counts[p][e] for p, e in used], pa.int64()), vectors([sums[p][e] for p, e in used], pa.int64())],
                ["part", "entry", "n", "sums"])

        tasks = parts.select("v", "far").mapInArrow(add, "part int, entry int, n long, sums array<long>")
        found = tasks.select("part", "entry", "n", F.posexplode("sums").alias("at", "s")).groupBy("part", "entry", "at").agg(
            F.sum("s").alias("s"), F.sum("n").alias("n"))
        # As many rows as the codebooks have numbers.
        new = found.toArrow()
        p, e, at, s, n = (new.column(c).to_numpy() for c in ("part", "entry", "at", "s", "n"))
        after = [b.entries.copy() for b in books]
        for i, entries in enumerate(after):
            own = p == i
            entries[e[own], at[own]] = s[own] // n[own]
        books = [Codebook(entries, b.pivots) for entries, b in zip(after, books, strict=True)]
        held.unpersist()
    held = spark.sparkContext.broadcast(books)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _assigned(batch, held.value)
            codes = np.column_stack([f[1] for f in found]).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array([c.tobytes().hex() for c in codes], pa.string()),
                 pa.array(sum(f[2] for f in found), pa.int64())], ["vec_id", "label", "code", "error"])

    coded = stored(parts.mapInArrow(code, f"vec_id long, label {kind}, code string, error long"), "codes")
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "own")
    digest = hashlib.sha256(",".join(str(x) for b in books for x in b.entries.ravel().tolist()).encode()).hexdigest()
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("own"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
