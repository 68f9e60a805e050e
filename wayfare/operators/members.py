"""Keyed sets, counters and scored members, and word counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfare.functions.text import fields_trimmed, lines
from wayfare.operators.spread import ROWS_PER_TASK, number_rows


def counter_totals(increments: DataFrame) -> DataFrame:
    """Increments summed by key and field."""
    return increments.groupBy("key", "field").agg(F.sum("delta").alias("value"))


def cardinality(members: DataFrame) -> DataFrame:
    """Distinct members per key; (key, member) pairs are reduced before keys are gathered."""
    return members.groupBy("key").agg(F.countDistinct("member").alias("members"))


def scores(increments: DataFrame) -> DataFrame:
    """Members with their accumulated score."""
    return counter_totals(increments).select(
        "key", F.col("field").alias("member"), F.col("value").alias("score"))


def _score_order(descending: bool) -> list[str]:
    return ["-score", "-member"] if descending else ["score", "member"]


def member_ranks(scored: DataFrame, descending: bool = False,
                 rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Zero-based rank by (score, member), and how many members the key has."""
    ranked = number_rows(scored, ["key"], _score_order(descending), "_rn", "_n", rows_per_task)
    return ranked.select("key", "member", "score", (F.col("_rn") - 1).alias("rank"),
                         F.col("_n").alias("members"))


def rank_range(scored: DataFrame, start: int, stop: int, descending: bool = False,
               rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Members ranked from ``start`` to ``stop``, both inclusive; negative counts from the end.

    A short range from the front is a top-k: Spark keeps the first rows of each key within every task before the
    shuffle, so the size of a key does not matter. It does so up to a k that its own setting names.
    """
    pruned = int(scored.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if 0 <= start <= stop < pruned:
        turn = F.desc if descending else F.asc
        rank = F.row_number().over(Window.partitionBy("key").orderBy(turn("score"), turn("member")))
        top = scored.withColumn("_rn", rank).where(F.col("_rn") <= stop + 1)
        return top.where(F.col("_rn") > start).select(
            "key", "member", "score", (F.col("_rn") - 1).cast("bigint").alias("rank"))
    ranked = member_ranks(scored, descending, rows_per_task)
    return ranked.where(_in_rank_range(start, stop)).select("key", "member", "score", "rank")


def remove_rank_range(scored: DataFrame, start: int, stop: int,
                      rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Members left after a rank range is removed."""
    ranked = member_ranks(scored, False, rows_per_task)
    return ranked.where(~_in_rank_range(start, stop)).select("key", "member", "score")


def _in_rank_range(start: int, stop: int) -> Column:
    def position(p: int) -> Column:
        return F.lit(p) if p >= 0 else F.col("members") + p

    return F.col("rank").between(position(start), position(stop))


def score_range(scored: DataFrame, low: int, high: int) -> DataFrame:
    return scored.where(F.col("score").between(low, high))


def score_counts(scored: DataFrame, low: int, high: int) -> DataFrame:
    return score_range(scored, low, high).groupBy("key").agg(F.count("*").alias("members"))


def remove_score_range(scored: DataFrame, low: int, high: int) -> DataFrame:
    return scored.where(~F.col("score").between(low, high))


def _memberships(members: DataFrame, sets: Sequence[str]) -> DataFrame:
    """Per member, which of the sets hold it: one partially aggregated shuffle for any number of sets."""
    flags = [F.bool_or(F.col("key") == key).alias(f"_in{i}") for i, key in enumerate(sets)]
    return members.where(F.col("key").isin(*sets)).groupBy("member").agg(*flags)


def set_union(members: DataFrame, sets: Sequence[str]) -> DataFrame:
    return members.where(F.col("key").isin(*sets)).select("member").distinct()


def set_intersect(members: DataFrame, sets: Sequence[str]) -> DataFrame:
    found = _memberships(members, sets)
    for i in range(len(sets)):
        found = found.where(F.col(f"_in{i}"))
    return found.select("member")


def set_except(members: DataFrame, first: str, others: Sequence[str]) -> DataFrame:
    """Members of the first set in none of the others."""
    found = _memberships(members, [first, *others]).where("_in0")
    for i in range(1, len(others) + 1):
        found = found.where(~F.col(f"_in{i}"))
    return found.select("member")


def word_count(texts: DataFrame, column: str) -> DataFrame:
    """Words of every line, split at single blanks; trailing empty words are no words."""
    line = texts.select(F.explode(lines(F.col(column))).alias("line"))
    words = line.select(F.explode(fields_trimmed(F.col("line"))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("occurrences"))
