"""MinHash near-dedup by a chosen-path set similarity join.

A document's set is its distinct shingles of ``WORDS`` words. Documents of equal sets are one vertex. Every
set gets ``POSITIONS`` minwise values; (position, value) pairs are the tokens of its embedding. A tree begins
with all sets in one node; a node selects ``BRANCHES`` positions by its path, and each of its sets goes to
the child of its own token there, so a pair of similarity s survives each selection with probability s.
With two branches a pair at 0.85 is missed by a tree with a probability below 0.03 at any depth,
and by all ``TREES`` trees below 1e-8 (at 0.8: below 0.0625 and 1e-7).

Nodes of at most ``SMALL`` sets are compared exhaustively where they are, and write no pairs: sketches of one byte
a minwise value tell which pairs can reach the threshold (six standard deviations below it), and the sets that such pairs
hang together make a *cluster*, the same in most nodes that its sets share. A cluster's full sets are brought together
once and compared exactly; of the links found, only those that join components come out. Larger nodes compare their sets with
two pivots, the sets of the least and the greatest component, and branch on. A node or cluster of one component is done. What
still stays together at ``DEPTH`` is compared exhaustively in blocks, and so are clusters of more shingles than a task should hold.

Defined cases: a null text, or one without words, has an empty set and is linked with nothing; a text of fewer
words is one shingle; rows with a null ``doc_id`` take no part; rows repeated under one id are one document
with the set of the row whose set hash is smallest (``kept_documents`` tells them apart by text); an empty table gives an empty result; columns
other than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import as_rows, binary, small_batches, stored, texts, tidied, vectors, whole_text
from wayfare.llm.graph import components
from wayfare.llm.numbering import numbered

WORDS = 5
POSITIONS = 64
TREES, BRANCHES = 6, 2
SMALL, DEPTH = 4096, 8
# Shingles that a group of compared sets may bring together, one for each side; ids that may be sent to all executors.
SLICE_SHINGLES = 500_000
SENT_IDS = 1_000_000
# Nodes up to this size are compared many at a time; pairs of sketches compared at a time.
FEW, AT_ONCE = 48, 1 << 18
KNOWN = 300_000
_DRAW = np.random.default_rng(6)
_ODD = _DRAW.integers(0, 1 << 63, WORDS, np.uint64) << np.uint64(1) | np.uint64(1)
_MIX = [np.uint64(x) for x in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]
_TIMES = _DRAW.integers(0, 1 << 31, POSITIONS, np.uint32) << np.uint32(1) | np.uint32(1)
_PLUS = _DRAW.integers(0, 1 << 32, POSITIONS, np.uint32)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > KNOWN:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    for times in _MIX:
        x = (x ^ (x >> np.uint64(33))) * times
    return x ^ (x >> np.uint64(33))


def shingles(text: bytes, hashes: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text in UTF-8.

    On bytes, ``lower`` touches A-Z alone and ``split`` knows just the six blanks of the word rule.
    """
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    own = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    # Shorter sequences are told apart from shingles, and by their length.
    n, width, short = max(1, len(own) - WORDS + 1), min(WORDS, len(own)), len(own) % WORDS if len(own) < WORDS else 0
    total = np.full(n, short, np.uint64)
    for i in range(width):
        total += own[i:i + n] * _ODD[i]
    found = mixed(total)
    found.sort()
    return found[np.concatenate(([True], found[1:] != found[:-1]))]


def minwise(found: np.ndarray) -> np.ndarray:
    """``POSITIONS`` minwise values of a set, as signed 32-bit numbers."""
    out = np.full(POSITIONS, np.iinfo(np.uint32).max, np.uint32)
    short = (found >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(short), 1024):
        part = short[start:start + 1024, None] * _TIMES
        part += _PLUS
        np.minimum(out, part.min(0), out=out)
    return out.view(np.int32)


def sketch(values: np.ndarray) -> np.ndarray:
    """The low byte of each minwise value, eight in a long."""
    return values.astype(np.uint8).view(np.int64)


def agreeing(a: Column, b: Column) -> Column:
    """In how many bytes two sketches agree: each byte that differs is folded into its lowest bit, and these are counted."""
    differing = F.lit(0)
    for i in range(POSITIONS // 8):
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        for shift, mask in ((4, 0x0F0F0F0F0F0F0F0F), (2, 0x0303030303030303), (1, 0x0101010101010101)):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift)).bitwiseAND(F.lit(mask))
        differing = differing + F.bit_count(x)
    return F.lit(POSITIONS) - differing


def least_agreeing(percent: int) -> int:
    """Agreeing minwise values below which a pair cannot reach the threshold, but for six standard deviations."""
    s = percent / 100
    return max(1, int(POSITIONS * s - 6 * (POSITIONS * s * (1 - s)) ** 0.5))


def hanging(linked: np.ndarray) -> np.ndarray:
    """Labels of the connected parts of a symmetric matrix of booleans."""
    label = np.full(len(linked), -1)
    for start in range(len(linked)):
        if label[start] >= 0:
            continue
        label[start] = start
        front = np.array([start])
        while len(front):
            front = np.flatnonzero(linked[front].any(0) & (label < 0))
            label[front] = start
    return label


def _ranges(counts: np.ndarray) -> np.ndarray:
    total = np.cumsum(counts)
    return np.arange(total[-1] if len(total) else 0) - np.repeat(total - counts, counts)


def screened_clusters(node: np.ndarray, ids: np.ndarray, component: np.ndarray, size: np.ndarray, sketches: np.ndarray,
                      percent: int) -> tuple[np.ndarray, np.ndarray]:
    """``cluster, id`` of the sets of whole nodes that pairs in reach of the threshold hang together, across components.

    Rows come by node; ``sketches`` are bytes. A cluster is called by its least id.
    """
    least = least_agreeing(percent)

    def reach(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        low, high = np.minimum(size[a], size[b]), np.maximum(size[a], size[b])
        fits = 100 * low >= percent * high
        fits[fits] = (sketches[a[fits]] == sketches[b[fits]]).sum(1) >= least
        return fits

    top = np.arange(len(ids))

    def root(i: int) -> int:
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    first = np.flatnonzero(np.diff(node, prepend=node[0] - 1 if len(node) else 0))
    n = np.diff(first, append=len(node))
    few = np.flatnonzero((n > 1) & (n <= FEW))
    # Pairs of all small nodes, some nodes at a time: each row with those after it in its node.
    for part in np.array_split(few, max(1, int((n[few] ** 2).sum() // AT_ONCE))):
        rows = np.repeat(first[part], n[part]) + _ranges(n[part])
        after = np.repeat(first[part] + n[part], n[part]) - rows - 1
        a = np.repeat(rows, after)
        b = a + 1 + _ranges(after)
        a, b = (x[component[a] != component[b]] for x in (a, b)) if len(a) else (a, b)
        keep = reach(a, b)
        for i, j in zip(a[keep].tolist(), b[keep].tolist(), strict=True):
            i, j = root(i), root(j)
            top[max(i, j)] = min(i, j)
    for start, count in zip(first[n > FEW].tolist(), n[n > FEW].tolist(), strict=True):
        order = start + np.argsort(size[start:start + count], kind="stable")
        linked = np.zeros((count, count), bool)
        for i in range(count - 1):
            # By size, partners in reach are a run.
            stop = np.searchsorted(size[order], 100 * size[order[i]] / percent, "right")
            linked[i, i + 1:stop] = linked[i + 1:stop, i] = (
                (sketches[order[i + 1:stop]] == sketches[order[i]]).sum(1) >= least) & (
                component[order[i + 1:stop]] != component[order[i]])
        label = hanging(linked)
        top[order] = order[label]
    top = np.array([root(i) for i in range(len(top))], np.int64)
    low, high = component.copy(), component.copy()
    np.minimum.at(low, top, component)
    np.maximum.at(high, top, component)
    out = np.flatnonzero(low[top] < high[top])
    name = ids.copy()
    np.minimum.at(name, top, ids)
    return name[top[out]], ids[out]


def exact_links(sets: list[np.ndarray], component: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Places of pairs of sets at the threshold or above that join the components, and no others."""
    n, size = len(sets), np.array([len(s) for s in sets])
    values, owner = np.concatenate(sets), np.repeat(np.arange(n), size)
    order = np.argsort(values, kind="stable")
    new = np.flatnonzero(np.diff(values[order], prepend=values[order[0]] - 1 if len(values) else 0))
    held = np.diff(new, append=len(values))
    number = np.empty(len(values), np.int64)
    number[order] = np.repeat(np.arange(len(new)), held)
    owners, at = owner[order], np.cumsum(size) - size
    component, out = component.copy(), []
    for i in range(n - 1):
        if component.min() == component.max():
            break
        own = number[at[i]:at[i] + size[i]]
        common = np.bincount(owners[np.repeat(new[own], held[own]) + _ranges(held[own])], minlength=n)
        found = np.flatnonzero((100 * common >= percent * (size[i] + size - common)) & (component != component[i]))
        for other in np.unique(component[found]):
            out.append((i, int(found[component[found] == other][0])))
        component[np.isin(component, component[found])] = component[i]
    return out


def whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Sorted rows again in pieces that hold whole runs of equal keys."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        changed = np.zeros(batch.num_rows, bool)
        for key in keys:
            own = batch.column(key).to_numpy()
            changed[1:] |= own[1:] != own[:-1]
            changed[0] |= not kept or kept[-1].column(key)[-1].as_py() != own[0]
        starts = np.flatnonzero(changed)
        if kept and not len(starts):
            kept.append(batch)
            continue
        # Up to the last run, which may go on.
        if starts[-1] or kept:
            whole = [*kept, batch.slice(0, int(starts[-1]))]
            yield pa.Table.from_batches(whole).combine_chunks()
        kept = [batch.slice(int(starts[-1]))]
    if kept:
        yield pa.Table.from_batches(kept).combine_chunks()


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_hash binary, minwise array<int>, sketch array<long>`` of every document with an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                sets = [shingles(text, hashes) for text in part.column(1).cast(pa.binary()).to_pylist()]
                values = [minwise(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                     binary(xxhash.xxh3_128_digest(s.tobytes()) for s in sets),
                     vectors(values, pa.int32()), vectors([sketch(v) for v in values], pa.int64())],
                    ["doc_id", "n_shingles", "set_hash", "minwise", "sketch"])

    return texts(docs).where(F.col("doc_id").isNotNull()).mapInArrow(
        tidied(run), "doc_id long, n_shingles long, set_hash binary, minwise array<int>, sketch array<long>")


def full_sets(wanted: DataFrame) -> DataFrame:
    """``id, shingles array<long>`` of the rows of ``wanted`` (``doc_id, text, set_hash``) whose text has that set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                rows = [(doc.as_py(), shingles(text, hashes), own.as_py()) for doc, text, own in zip(
                    part.column(0), part.column(1).cast(pa.binary()).to_pylist(), part.column(2), strict=True)]
                rows = [(doc, found) for doc, found, own in rows if xxhash.xxh3_128_digest(found.tobytes()) == own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), vectors([r[1].view(np.int64) for r in rows], pa.int64())],
                    ["id", "shingles"])

    return wanted.mapInArrow(tidied(run), "id long, shingles array<long>")


def children(node: Column, values: Column, first: bool) -> Column:
    """Keys of the nodes that a set goes to from ``node``: its tokens at the positions selected by the node."""
    if first:  # each tree starts on positions of its own
        picks = [F.lit(i) for i in range(TREES * BRANCHES)]
    else:
        start = F.pmod(F.xxhash64(node, F.lit("select")), F.lit(POSITIONS))
        step = F.pmod(F.xxhash64(node, F.lit("step")), F.lit(POSITIONS // 2)) * 2 + 1
        picks = [F.pmod(start + i * step, F.lit(POSITIONS)) for i in range(BRANCHES)]
    return F.explode(F.array(*[F.xxhash64(node, p.cast("int"), F.get(values, p.cast("int"))) for p in picks]))


class Join:
    """State of one similarity join: sets, links confirmed, components so far."""

    def __init__(self, docs: DataFrame, percent: int):
        self.docs, self.percent = docs, percent
        rows = stored(signatures(docs), "signatures")
        # One row per id: a repeated id keeps one of its sets.
        one = rows.groupBy("doc_id").agg(F.min_by(F.struct("n_shingles", "set_hash", "minwise", "sketch"), "set_hash").alias("s"),
                                         F.count("*").alias("n"))
        if not one.where("n > 1").isEmpty():
            rows = stored(one.select("doc_id", "s.*"), "signatures-by-id")
        self.members = rows
        self.sets = stored(rows.where("n_shingles > 0").groupBy("set_hash").agg(
            F.min("doc_id").alias("id"), F.first("n_shingles").alias("size"), F.first("minwise").alias("minwise"),
            F.first("sketch").alias("sketch")), "sets")
        self.label = self.sets.select("id", F.col("id").alias("component"))
        self.compared = self.sets.select(F.col("id").alias("a"), F.col("id").alias("b")).where("false")
        self.shingles: DataFrame | None = None

    def could_reach(self, a: Column, b: Column) -> Column:
        """Whether the sketches and sizes of two structs leave the threshold in reach."""
        low, high = F.least(a["size"], b["size"]), F.greatest(a["size"], b["size"])
        return (100 * low >= self.percent * high) & (agreeing(a["sketch"], b["sketch"]) >= least_agreeing(self.percent))

    def fetch(self, ids: DataFrame) -> None:
        """Work out the full sets of those ``ids`` that are not there yet."""
        need = ids.select("id").distinct()
        if self.shingles is not None:
            need = need.join(self.shingles.select("id"), "id", "left_anti")
        need = stored(need.join(self.sets.select("id", "set_hash"), "id").withColumnRenamed("id", "doc_id"), "wanted")
        wanted = need.count()
        if not wanted:
            return
        # Where they are few, the texts stay in place.
        chosen = texts(self.docs).join(F.broadcast(need) if wanted <= SENT_IDS else need, "doc_id").select("doc_id", "text", "set_hash")
        found = stored(full_sets(chosen).dropDuplicates(["id"]), "full-sets")
        self.shingles = found if self.shingles is None else self.shingles.unionByName(found)

    def merge(self, links: DataFrame) -> None:
        """Merge the components that links between them (``a, b``) join; older links need not be gone over again."""
        if links.isEmpty():
            return
        found = components(links)
        self.label = stored(self.label.join(found.select(F.col("id").alias("component"), F.col("component").alias("to")), "component",
                                            "left").select("id", F.coalesce("to", "component").alias("component")), "labels")

    def confirm(self, pairs: DataFrame) -> None:
        """Compare the full sets of pairs (``a, b, a_size, b_size, a_component, b_component``), few for each set, and merge what they link."""
        if pairs.isEmpty():
            return
        self.fetch(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))))
        # A pivot may have very many partners: its pairs are cut into slices and its set goes to each.
        load = pairs.groupBy("a").agg((F.sum("b_size") / SLICE_SHINGLES).cast("int").alias("last"))
        pivots = load.join(self.shingles.select(F.col("id").alias("a"), F.col("shingles").alias("a_shingles")), "a").select(
            "a", "a_shingles", F.explode(F.sequence(F.lit(0), "last")).alias("slice"))
        sliced = pairs.join(load, "a").select(
            "a", "b", "a_size", "b_size", "a_component", "b_component", F.pmod(F.xxhash64("b"), F.col("last") + 1).cast("int").alias("slice"))
        both = sliced.join(self.shingles.select(F.col("id").alias("b"), F.col("shingles").alias("b_shingles")), "b").join(
            pivots, ["a", "slice"])
        common = F.size(F.array_intersect("a_shingles", "b_shingles"))
        self.compared = self.compared.unionByName(pairs.select("a", "b"))
        self.merge(stored(both.withColumn("common", common).where(
            100 * F.col("common") >= self.percent * (F.col("a_size") + F.col("b_size") - F.col("common"))).select(
                F.col("a_component").alias("a"), F.col("b_component").alias("b")), "links"))

    def stars(self, large: DataFrame) -> DataFrame:
        """Pairs of the sets of large nodes with their node's two pivots that are in reach, each once."""
        own = F.struct("id", "size", "sketch", "component")
        pivots = large.groupBy("node").agg(F.min_by(own, F.struct("component", "id")).alias("low"),
                                           F.max_by(own, F.struct("component", "id")).alias("high"))
        both = large.select("node", own.alias("own")).join(pivots, "node")
        sides = [both.where((F.col("own.component") != F.col(f"{p}.component")) & self.could_reach(F.col("own"), F.col(p))).select(
            *[F.col(f"{side}.{c}").alias(to) for c, ends in (("id", ("a", "b")), ("size", ("a_size", "b_size")), (
                "component", ("a_component", "b_component"))) for side, to in zip((p, "own"), ends, strict=True)])
            for p in ("low", "high")]
        # The pivot stays on its side, so that its many partners are sliced; a pair of pivots may come twice.
        return stored(sides[0].unionByName(sides[1]).distinct().join(self.compared, ["a", "b"], "left_anti"), "candidates")

    def clusters(self, rows: DataFrame) -> DataFrame:
        """``cluster, id, size`` of the sets that must be compared, from rows of nodes; nodes beyond ``SMALL`` go in pairs of blocks."""
        last = F.ceil(F.col("n") / SMALL).cast("int") - 1
        dealt = rows.withColumn("last", last).withColumn("p", F.pmod(F.xxhash64("id"), F.col("last") + 1).cast("int")).withColumn(
            "q", F.explode(F.sequence(F.lit(0), "last")))
        dealt = dealt.select("node", F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j"), "id", "component", "size", "sketch")
        percent = self.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in whole_runs(batches, ["node", "i", "j"]):
                node, i, j, ids, component, size = (part.column(c).to_numpy() for c in ("node", "i", "j", "id", "component", "size"))
                change = np.zeros(len(node), bool)
                for key in (node, i, j):
                    change[1:] |= key[1:] != key[:-1]
                sketches = part.column("sketch").combine_chunks().flatten().to_numpy().view(np.uint8).reshape(-1, POSITIONS)
                name, own = screened_clusters(np.cumsum(change), ids, component, size, sketches, percent)
                known, at = np.unique(ids, return_index=True)
                at = at[np.searchsorted(known, own)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (name, own, size[at])], names)

        keys, names = ["node", "i", "j"], ["cluster", "id", "size"]
        return stored(dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
            tidied(run), ", ".join(f"{c} long" for c in names)).distinct(), "clusters")

    def settle(self, clusters: DataFrame) -> None:
        """Compare the full sets of each cluster and merge what they link; clusters of many shingles go in pairs of blocks."""
        if clusters.isEmpty():
            return
        self.fetch(clusters)
        load = clusters.groupBy("cluster").agg((F.sum("size") / SLICE_SHINGLES).cast("int").alias("last")).where("last > 0")
        dealt = clusters.join(load, "cluster", "left").fillna(0, ["last"]).withColumn(
            "p", F.pmod(F.xxhash64("id"), F.col("last") + 1).cast("int")).withColumn("q", F.explode(F.sequence(F.lit(0), "last"))).select(
            "cluster", F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j"), "id")
        percent, keys = self.percent, ["cluster", "i", "j"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in whole_runs(batches, keys):
                change = np.zeros(part.num_rows, bool)
                for key in keys:
                    own = part.column(key).to_numpy()
                    change[1:] |= own[1:] != own[:-1]
                change[0] = True
                first = np.flatnonzero(change)
                lists = part.column("shingles").combine_chunks()
                ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
                component = part.column("component").to_numpy()
                links = [(component[start + a], component[start + b])
                         for start, stop in zip(first.tolist(), [*first[1:].tolist(), part.num_rows], strict=True) for a, b in exact_links([flat[ends[k]:ends[k + 1]] for k in range(start, stop)], component[start:stop], percent)]
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

        rows = dealt.join(self.label, "id").join(self.shingles, "id")
        self.merge(stored(rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(tidied(run), "a long, b long"), "links"))

    def run(self) -> None:
        level = stored(self.sets.select("id", children(F.lit(0).cast("long"), F.col("minwise"), True).alias("node")), "level")
        for depth in range(1, DEPTH + 1):
            labelled = level.join(self.label, "id") if depth > 1 else level.withColumn("component", F.col("id"))
            mixed_ = labelled.groupBy("node").agg(F.count("*").alias("n"), F.min("component").alias("low"),
                                                  F.max("component").alias("high")).where("low < high").select("node", "n")
            rows = stored(labelled.select("node", "id", "component").join(mixed_, "node").join(
                self.sets.select("id", "size", "sketch"), "id"), "mixed-rows")
            large = rows.where((F.col("n") > SMALL) & F.lit(depth < DEPTH))
            some = not large.isEmpty()
            if some:
                self.confirm(self.stars(large))
            self.settle(self.clusters(rows.where((F.col("n") <= SMALL) | F.lit(depth == DEPTH))))
            if not some:
                return
            level = stored(large.select("node", "id").join(self.sets.select("id", "minwise"), "id").select(
                "id", children(F.col("node"), F.col("minwise"), False).alias("node")).distinct(), "level")


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: documents linked when 100 * common >= percent * union."""
    with small_batches(docs.sparkSession):
        join = Join(docs, percent)
        join.run()
    # Documents of equal sets follow their set; the set's id is their smallest id.
    by_set = join.sets.select("set_hash", "id").join(join.label, "id").select("set_hash", "component")
    out = join.members.where("n_shingles > 0").select("doc_id", "n_shingles", "set_hash").join(by_set, "set_hash")
    empty = join.members.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.select("doc_id", "n_shingles", F.col("component").alias("component_id")).unionByName(empty).withColumn(
        "kept", F.col("doc_id") == F.col("component_id"))


def kept_documents(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One document of each group, with the columns of ``docs``.

    Rows of one id with unlike texts are documents of their own here, in the order of id and text digest.
    """
    with_id = docs.where(F.col("doc_id").isNotNull())
    if with_id.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        kept = stored(near_duplicates(docs, percent).where("kept").select("doc_id"), "kept-ids")
        return as_rows(docs).join(kept, F.col("row.doc_id") == F.col("doc_id"), "left_semi").select("row.*")
    rows = stored(as_rows(with_id).select(
        "row", F.col("row.doc_id").alias("id"), F.sha2(whole_text("row.text"), 256).alias("digest")), "rows-by-digest")
    vertices = stored(numbered(rows.select("id", "digest").distinct(), [F.col("id"), F.col("digest")], "vertex"), "vertices")
    own = stored(rows.join(vertices, ["id", "digest"]).select("vertex", "row"), "rows-by-vertex")
    kept = stored(near_duplicates(own.select(F.col("vertex").alias("doc_id"), F.col("row.text").alias("text")), percent)
                  .where("kept").select(F.col("doc_id").alias("vertex")), "kept-vertices")
    return own.join(kept, "vertex", "left_semi").select("row.*")
