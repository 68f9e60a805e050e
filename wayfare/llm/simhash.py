"""SimHash near-dedup with deletion-variant signatures.

A document's fingerprint has the bits that are set in over half of the XXH64 values of its shingles of ``WORDS`` words,
repeats included. Equal fingerprints are one vertex. Of two fingerprints with at most ``MOST`` = 3 differing bits, cut into
two halves, one half differs in one bit at most. So each half is indexed as it is, and once for each of its bits with
that bit deleted; equal halves meet under the first key, halves that differ in one bit under the key without that bit,
where only rows that differ in it are partners. Every pair that meets is verified on the whole fingerprints.

No key ever has all its pairs written out. A key of two or three fingerprints is settled by the aggregation that counts the
keys: it keeps the least, the greatest and the exclusive or of all. Of a larger one, all are compared with its least and its
greatest fingerprint, and the components found so far decide what is left: keys within one component are done, and others compare fingerprints of different
components only. Keys with over ``CROWD`` fingerprints on either side are not compared but cut again, by the halves
of the half that is still free; after ``LEVELS`` cuts no more than 2^11 fingerprints can share a key.

Defined cases: a text without words, or a null one, has the fingerprint zero and is linked like any other; a text of fewer
words is one shingle; very long texts are hashed in pieces; rows with a null ``doc_id`` take no part; each row repeated
under one id is returned with the fingerprint of its own text; an empty table gives an empty result; columns other than ``doc_id``
and ``text`` are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import stored, texts
from wayfare.llm.graph import components

WORDS = 3
SEED = 42
MOST = 3
CROWD = 256
LEVELS = 3
# Fingerprints whose keys one task makes; keys of a crowd that may be sent to all executors, 16 bytes each. More are joined by a shuffle.
PRINTS_PER_TASK = 16_384
SENT_KEYS = 500_000
# Bytes of text hashed at a time.
BLOCK = 1 << 19

# XXH64, fixed values of the published algorithm.
P1, P2, P3, P4, P5 = (np.uint64(p) for p in (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def xxh64(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """XXH64 of the slices of ``data`` (bytes, followed by eight more), all short ones at once."""
    out = np.full(len(start), SEED, np.uint64) + P5 + length.astype(np.uint64)
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    at, left = start.copy(), length.copy()
    for _ in range(3):
        on = np.flatnonzero((left >= 8) & (length < 32))
        lane = _turned(words[at[on]] * P2, 31) * P1
        out[on] = _turned(out[on] ^ lane, 27) * P1 + P4
        at[on] += 8
        left[on] -= 8
    on = np.flatnonzero((left >= 4) & (length < 32))
    out[on] = _turned(out[on] ^ ((words[at[on]] & np.uint64(0xFFFFFFFF)) * P1), 23) * P2 + P3
    at[on] += 4
    left[on] -= 4
    for _ in range(3):
        on = np.flatnonzero((left >= 1) & (length < 32))
        out[on] = _turned(out[on] ^ (data[at[on]].astype(np.uint64) * P5), 11) * P1
        at[on] += 1
        left[on] -= 1
    out = (out ^ (out >> np.uint64(33))) * P2
    out = (out ^ (out >> np.uint64(29))) * P3
    out ^= out >> np.uint64(32)
    for i in np.flatnonzero(length >= 32):
        out[i] = xxhash.xxh64_intdigest(data[start[i]:start[i] + length[i]], SEED)
    return out


def blanks(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def block_counts(parts: list[np.ndarray], whole: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """Of each part, how many shingles it has, and in how many each bit is set.

    A part that is not ``whole`` is a piece of a longer text, so too few words are no shingle there.
    """
    sizes = np.array([len(p) + 1 for p in parts])
    blank = np.full(1, 32, np.uint8)
    data = np.concatenate([x for p in parts for x in (p, blank)])
    data = np.where((data >= 65) & (data <= 90), data | np.uint8(32), data)
    solid = ~blanks(data)
    after = np.concatenate(([False], solid[:-1]))
    first, last = np.flatnonzero(solid & ~after), np.flatnonzero(~solid & after)
    part = np.searchsorted(np.cumsum(sizes), first, "right")
    # The words again, each followed by one blank.
    tight = np.where(solid, data, np.uint8(32))[solid | after]
    ends = np.cumsum(last - first + 1)
    starts = ends - (last - first + 1)
    n = np.bincount(part, minlength=len(parts))
    short = np.flatnonzero((n > 0) & (n < WORDS) & np.array(whole))
    head = np.cumsum(n) - n
    run = np.flatnonzero(part[:-WORDS + 1] == part[WORDS - 1:]) if len(part) >= WORDS else np.empty(0, np.int64)
    begin = np.concatenate((starts[run], starts[head[short]]))
    length = np.concatenate((ends[run + WORDS - 1], ends[head[short] + n[short] - 1])) - 1 - begin
    owner = np.concatenate((part[run], short))
    order = np.argsort(owner, kind="stable")
    hashes = xxh64(np.concatenate((tight, np.zeros(8, np.uint8))), begin[order], length[order])
    totals = np.bincount(owner, minlength=len(parts))
    bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
    sums = np.zeros((len(parts), 64), np.int64)
    some = np.flatnonzero(totals)
    if len(some):
        sums[some] = np.add.reduceat(bits, (np.cumsum(totals) - totals)[some], axis=0, dtype=np.int64)
    return totals, sums


def pieces(text: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in pieces that end at blanks; each begins with the last ``WORDS`` - 1 words of the one before."""
    start, reach = 0, BLOCK
    while start + reach < len(text):
        blank = blanks(text[start:start + reach])
        ends = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
        if len(ends) < WORDS:
            reach += BLOCK
            continue
        yield text[start:start + ends[-1]]
        start, reach = start + ends[-WORDS], BLOCK
    yield text[start:]


def fingerprints_of(column: pa.Array) -> np.ndarray:
    """Signed 64-bit fingerprints of a column of bytes."""
    n = len(column)
    totals, sums = np.zeros(n, np.int64), np.zeros((n, 64), np.int64)
    parts: list[np.ndarray] = []
    owners: list[int] = []
    whole: list[bool] = []
    weight = 0

    def flush() -> None:
        nonlocal weight
        if parts:
            t, s = block_counts(parts, whole)
            np.add.at(totals, owners, t)
            np.add.at(sums, owners, s)
        for kept in (parts, owners, whole):
            kept.clear()
        weight = 0

    for i, value in enumerate(column):
        text = np.frombuffer(value.as_buffer(), np.uint8)
        cut = [text] if len(text) <= BLOCK else pieces(text)
        for piece in cut:
            if weight and weight + len(piece) > BLOCK:
                flush()
            parts.append(piece)
            owners.append(i)
            whole.append(len(text) <= BLOCK)
            weight += len(piece)
    flush()
    # A text of one or two words of a length beyond a block has no shingle so far: it is one itself.
    for i in np.flatnonzero(totals == 0):
        words = column[i].as_py().lower().split() if len(column[i].as_buffer()) > BLOCK else []
        if words:
            h = np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
            totals[i], sums[i] = 1, np.unpackbits(h.view(np.uint8), bitorder="little")
    return np.packbits(2 * sums > totals[:, None], axis=1, bitorder="little").view("<i8").ravel()


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp long`` of every row with an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fingerprints_of(batch.column(1).cast(pa.binary())))],
                                             ["doc_id", "fp"])

    return texts(docs).where(F.col("doc_id").isNotNull()).mapInArrow(run, "doc_id long, fp long")


def near(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= MOST


def side(fp: str) -> Column:
    """The deleted bit of a fingerprint under its key; null under a key without deletion (``at`` of 64 and more)."""
    return F.expr(f"CASE WHEN at < 64 THEN shiftrightunsigned({fp}, CAST(at AS INT)) & 1 END")


def keyed(rows: DataFrame, level: int) -> DataFrame:
    """``fp, node, at``: the keys of each fingerprint, by the two halves of what is free.

    At the first level that is the whole fingerprint; later ``at`` tells which half the parent key took, and its sibling is free.
    ``at`` is the deleted bit, or 64 and the first bit of the half. Parents that share a hash only meet in vain.
    """
    width = 32 >> (level - 1)
    if level == 1:
        free, node = F.lit(0).cast("long"), None
    else:
        taken = F.pmod(F.col("at"), F.lit(64))
        begin = taken - F.pmod(taken, F.lit(2 * width))
        free, node = begin.bitwiseXOR(F.lit(2 * width)), F.struct("node", "at")
    halves = F.array(free, free + width)
    rows = rows.select("fp", *([node.alias("parent")] if node is not None else []), F.explode(halves).alias("begin"))
    rows = rows.withColumn("value", F.expr(f"shiftrightunsigned(fp, CAST(begin AS INT)) & {(1 << width) - 1}L"))
    keys = F.transform(F.sequence(F.lit(-1), F.lit(width - 1)), lambda i: F.struct(
        F.when(i < 0, F.col("value")).otherwise(F.col("value").bitwiseAND(F.bitwise_not(
            F.call_function("shiftleft", F.lit(1).cast("long"), i)))).alias("value"),
        F.when(i < 0, F.col("begin") + 64).otherwise(F.col("begin") + i).alias("at")))
    out = rows.select("fp", *(["parent"] if node is not None else []), F.explode(keys).alias("k"))
    own = F.col("k.value") if node is None else F.xxhash64("parent.node", "parent.at", "k.value")
    return out.select("fp", own.alias("node"), F.col("k.at").alias("at"))


class Join:
    """Components of fingerprints under at most ``MOST`` differing bits."""

    def __init__(self, prints: DataFrame, crowd: int = CROWD):
        self.prints, self.crowd, self.found = prints, crowd, []

    def keep(self, links: DataFrame) -> None:
        self.found.append(stored(links.select("a", "b"), "simhash-links"))

    def label(self) -> DataFrame:
        """``id, component`` of the fingerprints with a link so far."""
        self.linked = stored(components(reduce(DataFrame.unionByName, self.found)), "simhash-components")
        return self.linked

    def run(self) -> DataFrame:
        tasks = -(-self.prints.count() // PRINTS_PER_TASK)
        rows = self.prints.select("fp").repartition(max(1, tasks))
        for level in range(1, LEVELS + 1):
            keys = keyed(rows, level)
            stats = stored(keys.groupBy("node", "at").agg(
                F.count("*").alias("n"), F.coalesce(F.sum(side("fp")), F.lit(-1)).alias("ones"),
                F.min("fp").alias("low"), F.max("fp").alias("high"), F.bit_xor("fp").alias("all")).where(
                    "n > 1 AND ones <> 0 AND ones <> n"), "simhash-keys")
            middle = F.col("low").bitwiseXOR(F.col("high")).bitwiseXOR(F.col("all"))
            few = stats.where("n < 4").select(F.inline(F.when(F.col("n") == 2, F.array(F.struct(F.col("low").alias("a"), F.col("high").alias("b"))))
                                                       .otherwise(F.array(*[F.struct(a.alias("a"), b.alias("b")) for a, b in (
                                                           (F.col("low"), middle), (middle, F.col("high")), (F.col("low"), F.col("high")))]))))
            self.keep(few.where(near("a", "b")).distinct())
            crowded = stats.where("n > 3").drop("all")
            keys_left = crowded.count()
            if not keys_left:
                break
            rows = stored(keys.join(F.broadcast(crowded) if keys_left <= SENT_KEYS else crowded, ["node", "at"]), "simhash-rows")
            # A fingerprint has the same pivot under many keys.
            self.keep(rows.select(F.col("fp").alias("b"), F.explode(F.array("low", "high")).alias("a")).where(
                (F.col("a") != F.col("b")) & near("a", "b")).distinct())
            known = self.label().select(F.col("id").alias("fp"), "component")
            rows = rows.join(known, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
            apart = rows.groupBy("node", "at").agg(F.min("component").alias("c"), F.max("component").alias("d")).where("c < d")
            rows = stored(rows.join(apart.select("node", "at"), ["node", "at"], "left_semi"), "simhash-apart")
            # Keys with a crowd on both sides (or without sides) are cut again, unless they are small by now.
            lesser = F.when(F.col("ones") < 0, F.col("n")).otherwise(F.least("ones", F.col("n") - F.col("ones")))
            crowd = (lesser > self.crowd) & F.lit(level < LEVELS)
            self.keep(self.met(rows.where(~crowd)))
            rows = rows.where(crowd).select("fp", "node", "at")
            if rows.isEmpty():
                break
        return self.label()

    @staticmethod
    def met(rows: DataFrame) -> DataFrame:
        """Links between the components of each key."""
        own = rows.select("node", "at", "fp", "component", side("fp").alias("side"))
        left = own.where("side IS NULL OR side = 0").select("node", "at", F.col("fp").alias("a"), F.col("component").alias("ca"))
        right = own.where("side IS NULL OR side = 1").select("node", "at", F.col("fp").alias("b"), F.col("component").alias("cb"))
        both = left.join(right, (left.node == right.node) & (left["at"] == right["at"]) & (F.col("ca") != F.col("cb")) & near("a", "b"))
        return both.select("a", "b").distinct()


def near_duplicates(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``doc_id, fingerprint, component_id``: documents linked when their fingerprints differ in at most ``MOST`` bits."""
    rows = stored(fingerprints(docs), "fingerprints")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    label = Join(prints, crowd).run()
    joined = stored(prints.join(label.withColumnRenamed("id", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")), "fingerprint-components")
    smallest = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    by_print = joined.join(smallest, "component").select("fp", "component_id")
    return rows.join(by_print, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
