import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import DOCS, SF, rows_of

from wayfare.llm import common, graph, near_dedup, packing


def sets_of(rows):
    out = {}
    for i, t in rows:
        if i is not None:
            w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
            out[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    return out


def brute(rows, percent):
    sets = sets_of(rows)
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders, links = {}, 0
    for i in sorted(sets):
        seen = {j for s in sets[i] for j in holders.get(s, ())}
        for s in sets[i]:
            holders.setdefault(s, []).append(i)
        for j in seen:
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                parent[b], links = a, links + 1
    return {(i, len(s), top(i), top(i) == i) for i, s in sets.items()}, links


def check(docs, percent):
    want, links = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], percent)
    got = {tuple(r) for r in near_dedup.near_duplicates(docs, percent).select(
        "doc_id", "n_shingles", "component_id", "kept").collect()}
    assert got == want
    return links


def test_odd_documents(spark, odd, none):
    check(odd, 85)
    assert near_dedup.near_duplicates(none).count() == 0
    kept = near_dedup.kept_documents(odd)
    assert kept.columns == odd.columns


def planted(seed=5):
    """A chain of near copies, a large group around one text, and copies that share a passage."""
    draw = random.Random(seed)

    def text(n):
        return [f"w{draw.randrange(5000)}" for _ in range(n)]

    rows, hub, passage = [], text(200), text(60)
    for _ in range(150):
        near = list(hub)
        for _ in range(draw.randrange(0, 4)):
            near[draw.randrange(200)] = f"x{draw.randrange(10**6)}"
        rows.append(near)
    for _ in range(100):
        rows.append(text(60) + passage + text(60))
    link = text(150)
    for i in range(30):
        link = link[:]
        link[i * 5] = f"y{i}"
        rows.append(link)
    draw.shuffle(rows)
    return rows_of([(i, " ".join(r).upper() if i % 3 else " \n".join(r)) for i, r in enumerate(rows)])


@pytest.mark.parametrize("percent", [80, 85])
def test_planted_groups(spark, percent):
    assert check(spark.createDataFrame(planted(), DOCS), percent) > 300


@pytest.mark.parametrize(("small", "few", "slice_"), [(8, 3, 10_000_000), (40, 48, 3000), (2048, 2, 3000)])
def test_small_bounds_find_the_same(spark, monkeypatch, small, few, slice_):
    """Nodes that branch on with pivots, nodes compared one by one, and clusters in pairs of blocks."""
    monkeypatch.setattr(near_dedup, "SMALL", small)
    monkeypatch.setattr(near_dedup, "FEW", few)
    monkeypatch.setattr(near_dedup, "SLICE_SHINGLES", slice_)
    assert check(spark.createDataFrame(planted(6), DOCS), 80) > 300


def test_wanted_texts_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "SENT_IDS", 0)
    assert check(spark.createDataFrame(planted(7), DOCS), 85) > 300


@pytest.mark.parametrize("few", [2, 100])
def test_clusters_and_links_of_nodes(monkeypatch, few):
    """Against all pairs: the parts that screened pairs hang together, and a forest of the exact links between components."""
    monkeypatch.setattr(near_dedup, "FEW", few)
    draw = np.random.default_rng(few)
    base = [draw.integers(0, 10**6, 60) for _ in range(6)]
    sets = []
    for i in range(90):
        own = base[i % 6].copy()
        own[draw.integers(0, 60, draw.integers(0, 12))] = draw.integers(0, 10**6)
        sets.append(np.unique(own).astype(np.uint64) << np.uint64(20))
    node = np.repeat([3, 5, 9, 11], [1, 2, 50, 37])
    component = draw.integers(0, 25, 90)
    size = np.array([len(s) for s in sets])
    sketches = np.array([near_dedup.sketch(near_dedup.minwise(near_dedup.mixed(s))) for s in sets]).view(np.uint8)
    name, own = near_dedup.screened_clusters(node, np.arange(90), component, size, sketches, 80)
    least = near_dedup.least_agreeing(80)
    label = np.arange(90)
    for _ in range(90):
        for a in range(90):
            for b in range(a):
                low, high = sorted((size[a], size[b]))
                if (node[a] == node[b] and component[a] != component[b] and 100 * low >= 80 * high
                        and (sketches[a] == sketches[b]).sum() >= least):
                    label[[a, b]] = min(label[a], label[b])
    want = {(int(label[i]), i) for i in range(90) if len(set(component[label == label[i]])) > 1}
    assert set(zip(name.tolist(), own.tolist(), strict=True)) == want and want
    links = near_dedup.exact_links([s.view(np.int64) for s in sets], component, 80)
    merged = {c: c for c in component.tolist()}

    def top(c):
        return c if merged[c] == c else top(merged[c])

    for a, b in links:
        assert 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))
        assert top(component[a]) != top(component[b])
        merged[top(component[a])] = top(component[b])
    for a in range(90):
        for b in range(a):
            if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b])):
                assert top(component[a]) == top(component[b])


def test_whole_runs():
    keys = [1, 1, 2, 3, 3, 3, 3, 4, 5, 5]
    for cut in range(1, 6):
        rows = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(range(10))], ["k", "v"])
        parts = list(near_dedup.whole_runs((rows.slice(i, cut) for i in range(0, 10, cut)), ["k"]))
        assert [v for p in parts for v in p.column("v").to_pylist()] == list(range(10))
        ends = [set(p.column("k").to_pylist()) for p in parts]
        assert all(a.isdisjoint(b) for i, a in enumerate(ends) for b in ends[:i])
    assert list(near_dedup.whole_runs(iter([]), ["k"])) == []


def test_table(spark):
    assert check(spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet"), 85) > 20


def test_components(spark):
    draw = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 140)] + [(draw.randrange(60), draw.randrange(60)) for _ in range(40)] + [(7, 7)]
    label = {i: i for e in edges if e[0] != e[1] for i in e}
    for _ in range(100):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = {tuple(r) for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == set(label.items())


def test_unlike_texts_of_one_id_are_judged_apart(spark):
    copied, alone, later = (" ".join(f"{w}{i}" for i in range(40)) for w in ("copy", "alone", "later"))
    rows = [(1, copied), (2, copied + " end"), (2, alone), (3, later), (3, alone + " end"), (4, later), (4, later)]
    got = near_dedup.kept_documents(spark.createDataFrame(rows_of(rows), DOCS)).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(1, copied), (2, alone), (3, later)]


def test_arrow_batches_are_of_few_bytes(spark, monkeypatch):
    key, limits, stored = "spark.sql.execution.arrow.maxBytesPerBatch", [], near_dedup.stored

    def batches(rows):
        yield from (pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"]) for batch in rows)

    wide = spark.range(0, 3000, 1, 1).selectExpr("id", "repeat('x', 10000) AS text").mapInArrow(batches, "n long")
    with common.small_batches(spark):
        found = [r.n for r in wide.collect()]
    assert max(found) < 8 << 20 and sum(found) > 25 << 20
    monkeypatch.setattr(near_dedup, "stored", lambda df, name: limits.append(spark.conf.get(key, None)) or stored(df, name))
    near_dedup.near_duplicates(spark.createDataFrame(rows_of([(1, "one two")]), DOCS))
    assert limits and set(limits) == {str(4 << 20)} and spark.conf.get(key, None) is None
    spark.conf.set(key, "1000000")
    try:
        with common.small_batches(spark):
            assert spark.conf.get(key) == "1000000"
        assert spark.conf.get(key) == "1000000"
    finally:
        spark.conf.unset(key)


def test_workers_drop_what_packing_remembers(spark):
    def held(batches):
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(common._KEPT)])], ["n"])

    def most():
        return max(r.n for r in spark.range(0, 64, 1, 64).mapInArrow(held, "n long").collect())

    docs = spark.createDataFrame(rows_of([(i, f"one two {i}") for i in range(128)]), DOCS).repartition(64)
    packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).count()
    assert most() == 1
    near_dedup.signatures(docs).count()
    assert most() == 0


def test_few_shuffles(spark):
    """Each takes as many tasks as the session has partitions, however small its rows."""
    docs = spark.createDataFrame(planted(5), DOCS).localCheckpoint()
    spark.sparkContext.setJobGroup("shuffles", "")
    try:
        near_dedup.near_duplicates(docs, 85).collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("shuffles")) < 71


def test_a_crowd_of_near_copies_takes_one_level(spark, monkeypatch):
    text, levels, clusters = [f"w{i}" for i in range(200)], [], near_dedup.Join.clusters
    rows = [(i, " ".join([*text[:i % 200], f"x{i}", *text[i % 200 + 1:]])) for i in range(2500)]
    monkeypatch.setattr(near_dedup.Join, "clusters", lambda join, found: levels.append(1) or clusters(join, found))
    got = near_dedup.near_duplicates(spark.createDataFrame(rows_of(rows), DOCS), 85).collect()
    assert len(got) == 2500 and {r.component_id for r in got} == {0} and len(levels) == 1
