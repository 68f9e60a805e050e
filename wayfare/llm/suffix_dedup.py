"""Suffix-array dedup: removal of every 50-byte string that a document of smaller id has too.

Sorting all suffixes of a corpus would move each of its bytes fifty times. Here the strings that need sorting
are found first, and suffix arrays are made of those:

1. Documents are packed into slots. Each 50-byte window has a minimizer, the least hash of its 16-byte strings, and on one side
   of that at least 17 more bytes: the 33 bytes are its key. Consecutive windows of one key are a block. Equal windows have equal
   keys. Minimizers alone would not do: the more text there is, the more of them are met again by chance.
2. Per slot the keys, three bytes each, go to their shards, which tell the slot those that other slots have too. For these, or
   where a slot has several blocks of a key, an entry with the hash of the block follows. A key met in one slot only, or
   always in the very same block, needs no more: of equal blocks, that of the smallest id is the original.
3. Where blocks with one key differ, as at the edges of copied passages, the blocks go to the shard, which joins the
   distinct ones, makes their suffix array by induced sorting, and from the permuted common prefixes the groups of equal
   windows with their smallest id.
4. Slots get the windows back, mark the bytes they cover, and cut them out.

A key in very many slots or with very many blocks (a passage a third of the documents share) sends its windows one
by one, each to the shard of its own hash, after equal windows of a slot are made one. So a shard
gets at most one entry per slot and string, however often that occurs.

Defined cases: a null text is empty; texts under 50 bytes lose nothing; rows with a null ``doc_id`` take no part; rows repeated
under one id are judged alike and none is the other's copy; an empty table gives an empty result; columns other than
``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.llm.common import (
    arrow_holds, as_rows, binary, brief_shuffles, shared_path, small_batches, stored, texts, tidied, tidied_group, whole_text)
from wayfare.llm.near_dedup import mixed
from wayfare.llm.suffixes import reaches, suffix_array

WINDOW, GRAM = 50, 16
# Strings of a window among which its minimizer is; bytes beside the minimizer that the window has on one side at least.
GRAMS, BESIDE = WINDOW - GRAM + 1, (WINDOW - GRAM) // 2
# Bytes of a slot, a share of the input within these bounds; text bytes per shard, what a worker sorts at a time.
SLOT, SHARD = (1 << 20, 1 << 26), 6 << 20
# Blocks of a slot, or slots, above which a key's windows go one by one.
MANY = 4096
# Documents to be cut whose ids may be sent to all executors, 40 bytes each, where Arrow can't carry the other columns.
SENT_IDS = 500_000
# Text worked on at a time within a slot.
STRETCH = 1 << 18
_DRAW = np.random.default_rng(7)
_GRAM = _DRAW.integers(0, 1 << 63, 2, np.uint64) << np.uint64(1) | np.uint64(1)
_BYTE = _DRAW.integers(0, 1 << 63, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
SEEN, COPY, DIFFERS, CROWDED = 0, 1, 2, 3


class Slot:
    """Documents in a row, and their blocks: start, number of windows, key, content hash, document."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, raw: bytes):
        self.ids, self.raw = ids, np.frombuffer(raw + bytes(WINDOW), np.uint8)
        self.ends = np.cumsum(lengths)
        self.begins = self.ends - lengths
        parts, at = [], 0
        while at < len(ids):
            upto = max(at + 1, int(np.searchsorted(self.ends, self.begins[at] + STRETCH, "right")))
            parts.append(self._blocks(at, upto))
            at = upto
        columns = zip(*parts, strict=True) if parts else [[np.empty(0, k)] for k in ("i8", "i8", "u8", "u8", "i8")]
        self.start, self.windows, self.key, self.content, self.doc = (np.concatenate(c) for c in columns)

    def _blocks(self, first: int, last: int) -> tuple[np.ndarray, ...]:
        base = int(self.begins[first])
        raw = self.raw[base:int(self.ends[last - 1]) + WINDOW]
        n = len(raw) - WINDOW
        starts = np.concatenate([np.arange(b - base, e - base - WINDOW + 1) for b, e in zip(
            self.begins[first:last].tolist(), self.ends[first:last].tolist(), strict=True) if e - b >= WINDOW] or [np.empty(0, int)])
        if not len(starts):
            return tuple(np.empty(0, k) for k in ("i8", "i8", "u8", "u8", "i8"))
        words = np.ndarray((len(raw) - 7,), "<u8", np.ascontiguousarray(raw), 0, (1,))
        low = hashes = mixed(words[:-8] * _GRAM[0] + mixed(words[8:] * _GRAM[1]))
        for width in (1, 2, 4, 8, 16):  # least of 35: of 32 by doubling, then two overlapping
            low = np.minimum(low[:-width], low[width:])
        low = np.minimum(low[:-(GRAMS - 32)], low[GRAMS - 32:])[starts]
        new = np.concatenate(([True], (np.diff(starts) != 1) | (low[1:] != low[:-1])))
        begin = np.flatnonzero(new)
        at, windows, place, least = _placed(hashes, starts[begin], np.diff(np.append(begin, len(starts))), low[begin])
        # Hashes of stretches: differences of a running polynomial, brought to a common power.
        power = _powers(_BASE, n)
        running = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[raw[:n]] * power[:n], dtype=np.uint64)))
        inverse = _powers(_INVERSE, n)

        def hashed(first: np.ndarray, size: np.ndarray) -> np.ndarray:
            return mixed((running[first + size] - running[first]) * inverse[first] + mixed(size.astype(np.uint64)))

        # Windows with enough bytes before the minimizer, the others, and those that have the minimizer more than once.
        before = np.where(place < 0, 0, np.clip(place - BESIDE + 1 - at, 0, windows))
        parts = []
        for side, own, begins, counts in (
                (-BESIDE, place >= 0, at, before), (0, place >= 0, at + before, windows - before), (None, place < 0, at, windows)):
            own = np.flatnonzero(own & (counts > 0))
            if side is None:
                key = least[own]
            else:
                key = hashed(place[own] + side, np.full(len(own), GRAM + BESIDE)) + np.uint64(-side)
            parts.append((begins[own], counts[own], key))
        at, windows, key = (np.concatenate(c) for c in zip(*parts, strict=True))
        doc = np.searchsorted(self.ends, at + base, "right")
        return at + base, windows, key, hashed(at, windows + WINDOW - 1), doc

    def entries(self) -> tuple[np.ndarray, ...]:
        """Blocks ordered by (key, content, id, place), each key's first, per key the number of different contents, and
        the first of each content."""
        owner = self.ids[self.doc]
        order = np.lexsort((self.start, owner, self.content, self.key))
        m, c = self.key[order], self.content[order]
        if not len(order):
            return order, np.empty(0, int), np.empty(0, int), np.empty(0, int)
        new_m = np.concatenate(([True], m[1:] != m[:-1]))
        new_c = new_m | np.concatenate(([True], c[1:] != c[:-1]))
        heads = np.flatnonzero(new_m)
        return order, heads, np.add.reduceat(new_c, heads), np.flatnonzero(new_c)


def _placed(hashes: np.ndarray, at: np.ndarray, windows: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows of one least hash, cut where the place of that changes: start, number, place and hash.

    The place is -1 where windows have the hash more than once, so that a long run of one sign is not cut into windows.
    """
    size, n = windows + GRAMS - 1, len(hashes)
    ends = np.cumsum(size)
    inside = np.repeat(at - ends + size, size) + np.arange(ends[-1])
    hit = np.flatnonzero(hashes[inside] == np.repeat(least, size))
    run, places = np.searchsorted(ends, hit, "right"), inside[hit]
    alone = np.bincount(run, minlength=len(at)) == 1
    place = np.full(len(at), -1)
    place[run] = places
    several = np.flatnonzero(~alone)
    if not len(several):
        return at, windows, place, least
    whose = np.repeat(several, windows[several])
    window = np.repeat(at[several], windows[several]) + _ranges(windows[several])
    # Places are in order by run, so one number is both.
    key = np.append(run * n + places, np.iinfo(np.int64).max)
    first = np.searchsorted(key, whose * n + window)
    again = key[first + 1] < whose * n + window + GRAMS
    own = np.where(again, -1, places[first])
    head = np.flatnonzero(np.concatenate(([True], (whose[1:] != whose[:-1]) | (own[1:] != own[:-1]))))
    return tuple(np.concatenate(c) for c in (
        (at[alone], window[head]), (windows[alone], np.diff(np.append(head, len(own)))), (place[alone], own[head]),
        (least[alone], least[whose[head]])))


def _shard_of(key: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard and 32 bits of a key; equal bits of different ones cost work, not results."""
    hashed = mixed(key + np.uint64(1))
    return ((hashed >> np.uint64(32)) % np.uint64(shards)).astype(np.int64), hashed.astype(np.uint32)


def _dealt(key: np.ndarray, shards: int) -> tuple[np.ndarray, ...]:
    """Shards, 32 bits, the order by both, and where in it a shard begins."""
    shard, short = _shard_of(key, shards)
    by = np.lexsort((short, shard))
    return shard, short, by, _heads(shard[by])


def _heads(numbers: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate((np.ones(min(1, len(numbers)), bool), numbers[1:] != numbers[:-1])))


def _steps(keys: np.ndarray) -> bytes:
    """Differences of sorted keys, first bytes first, last bytes last: those are mostly nothing."""
    return np.diff(keys, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unstepped(raw: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel(), dtype=np.uint32)


def _met(found: pa.Scalar, edges: np.ndarray, entries: int) -> np.ndarray:
    """Of entries in the order by shard and key, whether another slot has the key."""
    counts = np.diff(np.append(edges, entries)).tolist()
    bits = [np.frombuffer(x["met"], np.uint8) for x in sorted(found.as_py(), key=lambda x: x["shard"])]
    return np.concatenate([np.unpackbits(b, count=n) for b, n in zip(bits, counts, strict=True)]).astype(bool)


def _merged(marks: np.ndarray) -> np.ndarray:
    """Windows (start, number), those that follow or repeat each other as one."""
    marks = marks[np.argsort(marks[:, 0], kind="stable")]
    ends = np.maximum.accumulate(marks.sum(1))
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(marks)), bool), marks[1:, 0] > ends[:-1])))
    return np.column_stack((marks[first, 0], ends[np.append(first[1:], len(marks))[:len(first)] - 1] - marks[first, 0])).astype(np.int64)


def _narrow(numbers: np.ndarray) -> np.ndarray:
    """Numbers from 0 on in the least width that holds them; differences beyond 63 bits wrap round, and back when added."""
    fits = [k for k in ("<u1", "<u2", "<u4") if 0 <= int(numbers.min()) and int(numbers.max()) <= np.iinfo(k).max]
    return numbers.astype(fits[0] if fits else "<u8")


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 to base^n modulo 2^64."""
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _ranges(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count in turn."""
    total = np.cumsum(counts)
    return np.arange(total[-1] if len(total) else 0) - np.repeat(total - counts, counts)


class Dedup:
    """The steps over one table of documents."""

    def __init__(self, docs: DataFrame, whole: bool = False):
        """With ``whole``, slots hold the other columns too."""
        self.spark = docs.sparkSession
        rows = texts(docs).where(F.col("doc_id").isNotNull()).select("doc_id", F.col("text").cast("binary").alias("text"))
        total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        if whole:
            rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().cast("binary").alias("text"), F.struct(
                F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"), F.col("text").isNull().alias("bare")).alias(
                    "rest")).where(F.col("doc_id").isNotNull())
            self.rest = rows.schema["rest"].dataType
        limit = min(SLOT[1], max(SLOT[0], total // 1000))
        self.shards = max(1, -(-total // SHARD))
        self.slots = self._packed(rows, limit)

    def _packed(self, rows: DataFrame, limit: int) -> DataFrame:
        """``slot, ids, lengths, texts`` and ``rest`` if there is one: documents of a task in a row, written by slot into buckets
        without a shuffle."""
        whole = "rest" in rows.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            slot, ids, parts, size, rest = TaskContext.get().partitionId() << 32, [], [], 0, None
            packer = zstandard.ZstdCompressor(level=3)

            def taken(batch: pa.RecordBatch, first: int, upto: int) -> None:
                nonlocal rest
                if whole and upto > first:
                    own = batch.select(["rest"]).slice(first, upto - first)
                    rest = rest or (sink := pa.BufferOutputStream(), pa.ipc.new_stream(sink, own.schema))
                    rest[1].write_batch(own)

            def packed() -> pa.RecordBatch:
                columns = {"slot": pa.array([slot], pa.int64()), "ids": binary([np.array(ids, np.int64).tobytes()]),
                           "lengths": binary([np.array([len(p) for p in parts], np.int64).tobytes()]),
                           "texts": binary([packer.compress(b"".join(parts))])}
                if whole:
                    rest[1].close()
                    columns["rest"] = binary([packer.compress(rest[0].getvalue())])
                return pa.RecordBatch.from_pydict(columns)

            for batch in batches:
                first = 0
                for i, (doc, text) in enumerate(zip(batch.column(0), batch.column(1), strict=True)):
                    own = text.as_py()
                    if parts and size + len(own) > limit:
                        taken(batch, first, i)
                        yield packed()
                        slot, ids, parts, size, rest, first = slot + 1, [], [], 0, None, i
                    ids.append(doc.as_py())
                    parts.append(own)
                    size += len(own)
                taken(batch, first, batch.num_rows)
            if parts:
                yield packed()

        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        name = f"slots_{uuid.uuid4().hex}"
        (rows.mapInArrow(tidied(run), "slot long, ids binary, lengths binary, texts binary" + ", rest binary" * whole)
         .write.format("parquet").option("path", shared_path(self.spark, "slots")).option("compression", "none")
         .bucketBy(buckets, "slot").saveAsTable(name))
        return self.spark.table(name)

    @staticmethod
    def _slot(ids: bytes, lengths: bytes, packed: bytes) -> Slot:
        raw = zstandard.ZstdDecompressor().decompress(packed)
        return Slot(np.frombuffer(ids, np.int64), np.frombuffer(lengths, np.int64), raw)

    def _keys(self) -> DataFrame:
        """``shard, slot, keys``: the keys of a slot, in order."""
        shards, read = self.shards, self._slot

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            packer = zstandard.ZstdCompressor(level=1)
            for batch in batches:
                for slot, *packed in zip(*batch.columns, strict=True):
                    shard, short, by, edges = _dealt(np.unique(read(*(p.as_py() for p in packed)).key), shards)
                    if not len(by):
                        continue
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard[by][edges], pa.int64()), pa.array([slot.as_py()] * len(edges), pa.int64()),
                         binary(packer.compress(_steps(part)) for part in np.split(short[by], edges[1:]))], ["shard", "slot", "keys"])

        return self.slots.select("slot", "ids", "lengths", "texts").mapInArrow(tidied(run), "shard long, slot long, keys binary")

    def _shared(self) -> DataFrame:
        """``slot, found``: by shard, a bit for each key of the slot, in its order: whether another slot has it."""

        def run(key: tuple, table: pa.Table) -> pa.Table:
            unpack = zstandard.ZstdDecompressor()
            parts = [_unstepped(unpack.decompress(blob.as_py())) for blob in table.column("keys")]
            keys = np.concatenate(parts)
            order = np.argsort(keys, kind="stable")
            same = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
            met = np.zeros(len(keys), bool)
            met[order[same]] = met[order[same + 1]] = True
            edges = np.cumsum([len(p) for p in parts])[:-1]
            return pa.table({"slot": table.column("slot"), "shard": pa.array([key[0].as_py()] * table.num_rows, pa.int64()),
                             "met": binary(np.packbits(m).tobytes() for m in np.split(met, edges))})

        return stored(self._keys().groupBy("shard").applyInArrow(tidied_group(run), "slot long, shard long, met binary").groupBy(
            "slot").agg(F.collect_list(F.struct("shard", "met")).alias("found")), "shared-keys")

    def _entries(self, shared: DataFrame | None = None) -> DataFrame:
        """``shard, slot, entries``: key, content hash and smallest id of each key of a slot.

        With ``shared``, of those that other slots have too, or that have several contents.
        """
        shards, read = self.shards, self._slot

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for slot, *packed, found in zip(*batch.columns, strict=True):
                    own = read(*(p.as_py() for p in packed))
                    order, heads, kinds, _ = own.entries()
                    lead = order[heads]
                    shard, key, by, edges = _dealt(own.key[lead], shards)
                    if found.is_valid:
                        by = by[_met(found, edges, len(by)) | (kinds[by] > 1)]
                        edges = _heads(shard[by])
                    if not len(by):
                        continue
                    content, owner = own.content[lead], own.ids[own.doc[lead]]
                    blobs = []
                    for part in np.split(by, edges[1:]):
                        low = int(owner[part].min())
                        kind, above = _narrow(np.minimum(kinds[part], MANY)), _narrow(owner[part] - low)
                        blobs.append(b"".join((
                            np.array([len(part), low, kind.itemsize, above.itemsize], np.int64).tobytes(), key[part].tobytes(),
                            kind.tobytes(), content[part].tobytes(), above.tobytes())))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard[by][edges], pa.int64()), pa.array([slot.as_py()] * len(blobs), pa.int64()),
                         binary(blobs)], ["shard", "slot", "entries"])

        slots = self.slots.withColumn("found", F.lit(None)) if shared is None else self.slots.join(shared, "slot")
        return slots.select("slot", "ids", "lengths", "texts", "found").mapInArrow(tidied(run), "shard long, slot long, entries binary")

    def _judged(self, shared: DataFrame) -> DataFrame:
        """``slot, shard, verdicts``: per entry, in its order, what the shard knows of the key."""

        def run(key: tuple, table: pa.Table) -> pa.Table:
            keys, kinds, contents, owners, counts = [], [], [], [], []
            for blob in table.column("entries"):
                raw = blob.as_py()
                n, low, of_kind, of_owner = np.frombuffer(raw, np.int64, 4).tolist()
                at = 32
                for out, width in ((keys, 4), (kinds, of_kind), (contents, 8), (owners, of_owner)):
                    out.append(np.frombuffer(raw, f"<u{width}", n, at))
                    at += n * width
                owners[-1] = owners[-1].view(np.int64) + low if of_owner == 8 else owners[-1].astype(np.int64) + low
                counts.append(n)
            k, c, o, kind = (np.concatenate(x) for x in (keys, contents, owners, kinds))
            order = np.argsort(k, kind="stable")
            first = np.flatnonzero(np.concatenate(([True], np.diff(k[order]) != 0)))
            size = np.diff(np.append(first, len(k)))
            differs = (np.minimum.reduceat(c[order], first) != np.maximum.reduceat(c[order], first)) | (
                np.maximum.reduceat(kind[order], first) > 1)
            load = np.add.reduceat(kind[order].astype(np.int64), first)
            smallest = np.repeat(np.minimum.reduceat(o[order], first), size)
            verdict = np.empty(len(k), np.uint8)
            verdict[order] = np.where(np.repeat(differs, size), np.where(np.repeat(load >= MANY, size), CROWDED, DIFFERS),
                                      np.where(o[order] > smallest, COPY, SEEN))
            edges = np.cumsum(counts)[:-1]
            packer = zstandard.ZstdCompressor(level=1)
            return pa.table({"slot": table.column("slot"), "shard": pa.array([key[0].as_py()] * table.num_rows, pa.int64()),
                             "verdicts": binary(packer.compress(v.tobytes()) for v in np.split(verdict, edges))})

        return self._entries(shared).groupBy("shard").applyInArrow(tidied_group(run), "slot long, shard long, verdicts binary")

    def _sent(self) -> DataFrame:
        """``slot, marks`` where a slot knows by itself, and ``shard, slot, strings`` for what must be sorted."""
        shards, read = self.shards, self._slot
        shared = self._shared()
        judged = self._judged(shared).groupBy("slot").agg(F.collect_list(F.struct("shard", "verdicts")).alias("judged"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            unpack = zstandard.ZstdDecompressor()
            for batch in batches:
                for slot, *packed, found, judged in zip(*batch.columns, strict=True):
                    own = read(*(p.as_py() for p in packed))
                    order, heads, kinds, changes = own.entries()
                    shard, _, by, edges = _dealt(own.key[order[heads]], shards)
                    asked = by[_met(found, edges, len(by)) | (kinds[by] > 1)]
                    said = {j["shard"]: unpack.decompress(j["verdicts"]) for j in judged.as_py() or ()}
                    verdict = np.full(len(heads), SEEN, np.uint8)
                    verdict[asked] = np.frombuffer(b"".join(said[s] for s in sorted(said)), np.uint8)
                    verdict = np.repeat(verdict, np.diff(np.append(heads, len(order))))
                    shard = np.repeat(shard, np.diff(np.append(heads, len(order))))
                    # The id of the first block of equal content decides within the slot.
                    owner = own.ids[own.doc[order]]
                    leader = np.repeat(owner[changes], np.diff(np.append(changes, len(order))))
                    copies = (owner > leader) | (verdict == COPY)
                    marks = [np.column_stack((own.start[order[copies]], own.windows[order[copies]]))]
                    send = ~copies & (verdict == DIFFERS)
                    rows = [(shard[send], own.start[order[send]], own.windows[order[send]], owner[send])]
                    crowd = ~copies & (verdict == CROWDED)
                    if crowd.any():
                        each, mark = _single(own, order[crowd], shards)
                        rows.append(each)
                        marks.append(mark)
                    to, start, windows, doc = (np.concatenate(c) for c in zip(*rows, strict=True))
                    out = [(None, slot.as_py(), _merged(np.concatenate(marks)).tobytes(), True)]
                    sort = np.argsort(to, kind="stable")
                    if len(sort):
                        for part in np.split(sort, np.flatnonzero(np.diff(to[sort])) + 1):
                            size = windows[part] + WINDOW - 1
                            at = np.repeat(start[part], size) + _ranges(size)
                            head = np.concatenate(([len(part)], start[part], windows[part], doc[part])).astype(np.int64)
                            out.append((int(to[part[0]]), slot.as_py(), zstandard.compress(
                                head.tobytes() + own.raw[at].tobytes(), 1), False))
                    shard_, slot_, blob, mine = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard_, pa.int64()), pa.array(slot_, pa.int64()), binary(blob), pa.array(mine, pa.bool_())],
                        ["shard", "slot", "data", "marks"])

        return self.slots.join(shared, "slot").join(judged, "slot", "left").select(
            "slot", "ids", "lengths", "texts", "found", "judged").mapInArrow(tidied(run), "shard long, slot long, data binary, marks boolean")

    @staticmethod
    def _sorted(sent: DataFrame) -> DataFrame:
        """``slot, data``: windows (start, number) that a document of smaller id has too, by suffix arrays."""

        def run(key: tuple, table: pa.Table) -> pa.Table:
            strings: dict[bytes, int] = {}
            least: list[int] = []
            slots = []  # per row: string numbers, starts, ids
            for blob in table.column("data"):
                raw = zstandard.decompress(blob.as_py())
                n = int(np.frombuffer(raw, np.int64, 1)[0])
                start, windows, doc = np.frombuffer(raw, np.int64, 3 * n, 8).reshape(3, n)
                ends = np.cumsum(windows + WINDOW - 1) + 8 * (3 * n + 1)
                numbers, at = np.empty(n, np.int64), 8 * (3 * n + 1)
                for i, (end, owner) in enumerate(zip(ends.tolist(), doc.tolist(), strict=True)):
                    number = strings.setdefault(raw[at:end], len(strings))
                    if number == len(least):
                        least.append(owner)
                    elif owner < least[number]:
                        least[number] = owner
                    numbers[i], at = number, end
                slots.append((numbers, start, doc))
            raw = np.frombuffer(b"\0".join([*strings, bytes(WINDOW)]), np.uint8)
            size = np.fromiter(map(len, strings), np.int64, len(strings))
            begin = np.cumsum(size + 1) - size - 1
            n = int(size.sum() + len(size))
            symbols = raw[:n].astype(np.uint16) + np.uint16(2)
            symbols[begin + size] = 1
            symbols = np.append(symbols, np.uint16(0))
            strings.clear()
            sa = suffix_array(symbols, stop=1)[1:]
            del symbols
            windows = size - WINDOW + 1
            # Windows alone, each inside its string: a zero byte of a text is never taken for the end of one.
            valid = np.repeat(np.arange(2 * len(size)) % 2 == 0, np.column_stack((windows, np.full(len(size), WINDOW))).ravel())
            sa = sa[valid[sa]]
            first = np.flatnonzero(~reaches(raw, sa, WINDOW)[sa])
            # Ids by rank, which take half the room; each string's own before the groups of equal windows are known.
            ids, rank = np.unique(np.array(least, np.int64), return_inverse=True)
            smallest = np.repeat(rank.astype(np.int32), size + 1)
            if len(sa):
                smallest[sa] = np.repeat(np.minimum.reduceat(smallest[sa], first), np.diff(np.append(first, len(sa))))
            out = []
            for numbers, start, doc in slots:
                count = windows[numbers]
                inside = _ranges(count)
                copied = smallest[np.repeat(begin[numbers], count) + inside] < np.repeat(np.searchsorted(ids, doc), count)
                at = (np.repeat(start, count) + inside)[copied]
                out.append(_merged(np.column_stack((at, np.ones(len(at), np.int64)))).tobytes())
            return pa.table({"slot": table.column("slot"), "data": binary(zstandard.compress(o, 1) for o in out)})

        return sent.groupBy("shard").applyInArrow(tidied_group(run), "slot long, data binary")

    def _found(self) -> DataFrame:
        """Slots, and the windows of each that a document of smaller id has too: ``own`` and ``sorted``."""
        with brief_shuffles(self.spark):
            sent = stored(self._sent(), "slot-findings")
        found = sent.where("marks").select("slot", F.col("data").alias("own")).join(
            self._sorted(sent.where("NOT marks").select("shard", "slot", "data")).groupBy("slot").agg(
                F.collect_list("data").alias("sorted")), "slot", "left")
        return self.slots.join(found, "slot", "left")

    @staticmethod
    def _covered(packed: pa.Scalar, lengths: pa.Scalar, own: pa.Scalar, sorted_: pa.Scalar) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The bytes of each document of a slot, and which of them are covered."""
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed.as_py()), np.uint8)
        blobs = [own.as_py() or b"", *(zstandard.decompress(d) for d in sorted_.as_py() or ())]
        marks = np.frombuffer(b"".join(blobs), np.int64).reshape(-1, 2)
        change = np.zeros(len(raw) + 1, np.int64)
        np.add.at(change, marks[:, 0], 1)
        np.add.at(change, marks[:, 0] + marks[:, 1] + WINDOW - 1, -1)
        gone = np.cumsum(change[:-1]) > 0
        at = 0
        for n in np.frombuffer(lengths.as_py(), np.int64).tolist():
            yield raw[at:at + n], gone[at:at + n]
            at += n

    def result(self, cleaned: bool = False) -> DataFrame:
        """``doc_id, n_bytes, n_removed, n_spans, kept binary, text_md5`` of every document with an id.

        With ``cleaned``, of those that lose bytes, and a character of which only some bytes are covered goes as a whole.
        """
        covered = self._covered

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for ids, lengths, packed, own, sorted_ in zip(*batch.columns, strict=True):
                    rows = []
                    for doc, (text, mine) in zip(
                            np.frombuffer(ids.as_py(), np.int64).tolist(), covered(packed, lengths, own, sorted_), strict=True):
                        spans = int(np.count_nonzero(mine[1:] & ~mine[:-1]) + (len(mine) > 0 and bool(mine[0])))
                        left, removed = text[~mine].tobytes(), int(np.count_nonzero(mine))
                        if cleaned:
                            if not removed:
                                continue
                            left = left.decode("utf-8", "ignore").encode()
                        rows.append((doc, len(text), removed, spans, left, hashlib.md5(text.tobytes()).hexdigest()))
                    if not rows:
                        continue
                    own_ids, size, removed, spans, kept, md5 = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(x, pa.int64()) for x in (own_ids, size, removed, spans)), binary(kept), pa.array(md5)],
                        ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "text_md5"])

        return self._found().select("ids", "lengths", "texts", "own", "sorted").mapInArrow(
            tidied(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, text_md5 string")

    def whole(self) -> DataFrame:
        """``lost boolean, left binary, rest`` of every document with an id; a character of which only some bytes are covered goes
        as a whole."""
        covered = self._covered

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lengths, packed, rest, own, sorted_ in zip(*batch.columns, strict=True):
                    lost, left = [], []
                    for text, mine in covered(packed, lengths, own, sorted_):
                        lost.append(bool(mine.any()))
                        left.append(text[~mine].tobytes().decode("utf-8", "ignore").encode() if lost[-1] else text.tobytes())
                    table = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(rest.as_py())).read_all()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(lost), binary(left), pa.concat_arrays(table.column(0).chunks)], ["lost", "left", "rest"])

        return self._found().select("lengths", "texts", "rest", "own", "sorted").mapInArrow(tidied(run), T.StructType().add(
            "lost", "boolean").add("left", "binary").add("rest", self.rest))


def _single(own: Slot, blocks: np.ndarray, shards: int) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """Windows of crowded blocks one by one, equal ones of the slot once; and marks for the others."""
    windows = own.windows[blocks]
    at = np.repeat(own.start[blocks], windows) + _ranges(windows)
    doc = np.repeat(own.ids[own.doc[blocks]], windows)
    words = np.ndarray((len(own.raw) - 7,), "<u8", own.raw, 0, (1,))
    hashed = np.zeros(len(at), np.uint64)
    for offset in (0, 8, 16, 24, 32, 40, WINDOW - 8):
        hashed = mixed(hashed + words[at + offset])
    order = np.lexsort((doc, hashed))
    new = np.concatenate(([True], np.diff(hashed[order]) != 0))
    first = np.flatnonzero(new)
    leader = np.repeat(doc[order][first], np.diff(np.append(first, len(order))))
    copies = doc[order] > leader
    marked, kept = order[copies], order[~copies]
    to = (hashed[kept] % np.uint64(shards)).astype(np.int64)
    one = np.ones(len(kept), np.int64)
    return (to, at[kept], one, doc[kept]), np.column_stack((at[marked], np.ones(len(marked), np.int64)))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept``: what is left of each document's UTF-8 bytes."""
    with small_batches(docs.sparkSession):
        return Dedup(docs).result().drop("text_md5")


def cleaned_documents(docs: DataFrame) -> DataFrame:
    """The documents with repeated bytes cut out of ``text``, and ``n_chars`` to match if there is one.

    A character of which only some bytes are covered goes as a whole. Rows without an id stay as they are.
    """
    if not arrow_holds(docs.schema):
        return _joined_documents(docs)

    def column(name: str, kind: str) -> Column:
        own, text = F.col("rest.row").getField(name), F.col("left").cast("string")
        if name == "text":
            own = F.when(~F.col("rest.bare"), text.cast(kind))
        elif name == "n_chars":
            own = F.when(F.col("lost"), F.length(text).cast(kind)).otherwise(own)
        return own.alias(name)

    # Slots hold whole rows, so that no document is shuffled to meet its new text, however many are cut.
    spark = docs.sparkSession
    with small_batches(spark):
        rows = Dedup(docs, whole=True).whole().select(*[column(name, kind) for name, kind in docs.dtypes])
        with brief_shuffles(spark):
            left = stored(rows, "cut-texts")
    return left.unionByName(docs.where(F.col("doc_id").cast("long").isNull()))


def _joined_documents(docs: DataFrame) -> DataFrame:
    """``cleaned_documents`` of a table with columns that Arrow can't hold: rows meet their new texts in joins."""
    with small_batches(docs.sparkSession):
        # One Python step a task: a second one would be another worker in each, which stays and keeps its memory.
        left = stored(Dedup(docs).result(cleaned=True).select(
            F.col("doc_id").alias("id"), F.col("kept").cast("string").alias("left"), "text_md5"), "cut-texts")
    found = left.count()
    if left.select("id", "text_md5").distinct().count() < found:
        left = stored(left.dropDuplicates(["id", "text_md5"]), "cut-texts-once")
        found = left.count()
    rows = as_rows(docs).withColumn("md5", F.md5(F.coalesce("row.text", F.lit("")).cast("binary")))
    same = (F.col("row.doc_id") == F.col("id")) & (F.col("md5") == F.col("text_md5"))
    if found <= SENT_IDS:
        # Only the rows that change meet their new texts, and leave their old ones; the others stay where they are.
        changed = F.broadcast(left.select("id", "text_md5"))
        bare = F.col("row").withField("text", F.lit(None).cast(docs.schema["text"].dataType))
        both = rows.join(changed, same, "left_semi").withColumn("row", bare).join(left, same).unionByName(
            rows.join(changed, same, "left_anti"), True)
    else:
        both = rows.join(left, same, "left")
    text = F.when(F.col("id").isNotNull(), F.col("left")).otherwise(F.col("row.text"))

    def column(name: str, kind: str) -> Column:
        own = F.col("row").getField(name)
        if name == "text":
            own = text
        elif name == "n_chars":
            own = F.when(F.col("id").isNotNull(), F.length("left").cast(kind)).otherwise(own)
        return own.alias(name)

    return both.select(*[column(name, kind) for name, kind in docs.dtypes])
