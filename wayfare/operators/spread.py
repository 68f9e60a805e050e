"""Joins and numbering that hold up when one key owns a large share of the rows.

One plan for all sizes, and no job while it is built: a fixed share of the rows, one in ``ROWS_PER_TASK`` by a hash of their
values, marks where keys are cut. A key of that many rows or more is likely to be cut, one with many times as many rows into about as
many pieces, and most keys are not. The marks are a function of the rows alone, so that every evaluation, also of a lost task, finds
the same pieces. At most one row in ``ROWS_PER_TASK`` is broadcast: half a million for a million million rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ROWS_PER_TASK = 2_000_000
# Cuts of one key that every row of it is compared with; with more marks, evenly chosen ones.
MAX_CUTS = 512


def _renamed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys under names of their own, so that a join against their source is unambiguous."""
    return df.withColumnsRenamed({key: f"_match_{key}" for key in keys})


def _same(keys: Sequence[str]) -> Column:
    """Equality with renamed keys; a null key equals itself."""
    return reduce(and_, [F.col(key).eqNullSafe(F.col(f"_match_{key}")) for key in keys])


def _marked(df: DataFrame, columns: Sequence[str], rows_per_task: int) -> DataFrame:
    return df.where(F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(rows_per_task)) == 0)


def join_unique(left: DataFrame, right: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK,
                identity: Sequence[str] | None = None) -> DataFrame:
    """Join rows of ``left`` to the one row ``right`` has per key, or the few.

    A heavy key of ``left`` is cut into pieces and its rows of ``right`` copied to each, so no
    task receives the whole key; all other rows join as usual. Adaptive skew handling alone would
    not do: it needs a shuffle on both sides, and an aggregated ``right`` brings none of its own.
    ``identity`` are columns that tell rows apart, all if not given; marks are looked for by these alone, so that no others are
    read for them. Many equal rows are marked together or not at all, and stay in one piece if they are not.
    """
    cut_right = right.join(_pieces(left, keys, rows_per_task, identity), list(keys), "left").withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1))).drop("_pieces")
    return cut_pieces(left, keys, rows_per_task, identity).join(cut_right, [*keys, "_piece"]).drop("_piece")


def _pieces(df: DataFrame, keys: Sequence[str], rows_per_task: int, identity: Sequence[str] | None = None) -> DataFrame:
    """How many pieces a key is cut into, where it is cut."""
    marks = _marked(df, identity or df.columns, rows_per_task).where(F.col(keys[0]).isNotNull())
    return F.broadcast(marks.groupBy(*keys).agg((F.count("*") + 1).cast("int").alias("_pieces")))


def cut_pieces(df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK,
               identity: Sequence[str] | None = None) -> DataFrame:
    """``df`` with a piece of its key for each row."""
    # The input partition is part of the hash, so that identical rows spread as well: any piece will do for a row.
    whole = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in identity or df.columns])
    return df.withColumn("_hash", whole).join(_pieces(df, keys, rows_per_task, identity), list(keys), "left").withColumn(
        "_piece", F.pmod("_hash", F.coalesce("_pieces", F.lit(1))).cast("int")).drop("_pieces", "_hash")


def _before(mark: Column, order: Sequence[str]) -> Column:
    """Whether a mark comes before the row, or is the row; nulls come first ascending and last descending."""
    out = F.lit(True)
    for spec in reversed(order):
        name = spec.removeprefix("-")
        # Structs of one field compare nulls, as the smallest.
        theirs, own = F.struct(mark[name].alias("x")), F.struct(F.col(name).alias("x"))
        out = (theirs > own if spec.startswith("-") else theirs < own) | ((theirs == own) & out)
    return out


def _cut(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_task: int, how: str) -> DataFrame:
    """``df`` with the piece of its key that a row is in, counted in ``order``."""
    names = [spec.removeprefix("-") for spec in order]
    every = F.greatest(F.ceil(F.size("_all") / F.lit(MAX_CUTS)), F.lit(1))
    # A key's list has as many rows as it has marks.
    marks = (_marked(df, [*keys, *names], rows_per_task).groupBy(*keys)
             .agg(F.array_sort(F.collect_list(F.struct(*names))).alias("_all"))
             .select(*keys, F.filter("_all", lambda _, i: F.pmod(i, every) == 0).alias("_marks")))
    found = F.size(F.filter("_marks", lambda mark: _before(mark, order)))
    return df.join(F.broadcast(_renamed(marks, keys)), _same(keys), how).withColumn(
        "_piece", F.when(F.col("_marks").isNull(), F.lit(0)).otherwise(found)).select(*df.columns, "_piece")


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rn",
                total: str | None = None, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``row_number()`` per key in the given order, and optionally the rows of the key as ``total``.

    ``order`` are columns that identify a row within its key; a leading ``-`` turns one round. Rows are numbered within
    the pieces of their key, which tasks share; to that come the rows of the pieces before, by sums over the
    counts of the pieces. Keys without a mark are one piece and need no sum.
    """
    turned = [F.desc(s[1:]) if s.startswith("-") else F.asc(s) for s in order]
    by_piece, by_key = Window.partitionBy(*keys, "_piece"), Window.partitionBy(*keys)
    rows = _cut(df, keys, order, rows_per_task, "left").withColumn("_in_piece", F.row_number().over(by_piece.orderBy(*turned)))
    counts = _cut(df, keys, order, rows_per_task, "inner").groupBy(*keys, "_piece").agg(F.count("*").alias("_rows"))
    earlier = by_key.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    sums = counts.select(*keys, "_piece", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
                         F.sum("_rows").over(by_key).alias("_total"))
    match = [*keys, "_piece"]
    if total:
        rows = rows.withColumn("_own", F.count("*").over(by_piece))
    # A row per piece of a key that is cut: twice the marks at most.
    joined = rows.join(F.broadcast(_renamed(sums, match)), _same(match), "left")
    columns = [F.col(c) for c in df.columns]
    columns.append((F.col("_in_piece") + F.coalesce("_before", F.lit(0))).cast("bigint").alias(name))
    if total:
        columns.append(F.coalesce("_total", "_own").alias(total))
    return joined.select(*columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """Last write wins: per key the row with the highest version, combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*version)).alias("_last")
    out = df.groupBy(*keys).agg(last)
    return out.select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in df.columns])


def merged_per_key(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """Cell-level upsert: per key and column the last value that is not null; a write leaves the cells it lacks."""
    at = F.struct(*version)
    merged = df.groupBy(*keys).agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(c)
                                     for c in df.columns if c not in keys])
    return merged.select(*df.columns)


def folded_per_key(df: DataFrame, keys: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """One row per key by aggregates, with the columns of ``df``."""
    return df.groupBy(*keys).agg(*[m.alias(name) for name, m in measures.items()]).select(*df.columns)
