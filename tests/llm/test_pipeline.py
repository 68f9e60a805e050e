import re

import pytest
from cases import DOCS, rows_of
from test_near_dedup import brute as near_groups
from test_suffix_dedup import planted
from tokenizers import Tokenizer

import corpus_pipeline
from wayfare.llm import packing


def brute(rows):
    """What the stages keep, by plain loops; the languages are those of ``rows``, which all have letters or none."""
    rows = [(i, t) for i, t in rows if t and re.search(r"[^\W\d_]", t) and i is not None]
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append((-len(t), i, t))
    rows = [(i, t) for _, i, t in (min(g) for g in groups.values())]
    kept = {r[0] for r in near_groups(rows, 80)[0] if r[3]}
    rows = sorted((i, t.encode()) for i, t in rows if i in kept)
    first = {}
    for i, b in rows:
        for p in range(len(b) - 49):
            first.setdefault(b[p:p + 50], i)
    out = {}
    for i, b in rows:
        gone = set()
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < i:
                gone.update(range(p, p + 50))
        out[i] = bytes(c for p, c in enumerate(b) if p not in gone).decode("utf-8", "ignore")
    return out


def test_stages_by_brute_force(spark, tmp_path, odd):
    rows = [(i, t) for i, (_, t) in enumerate(planted(4, 80))] + [(1000, None), (1001, "12 %%"), (1002, "")]
    docs = spark.createDataFrame(rows_of(rows), DOCS)
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    want = brute(rows)
    assert {r.doc_id: r.text for r in docs.collect()} == want
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    tokenizer = Tokenizer.from_file(corpus_pipeline.WORD_BPE)
    assert {(r.doc_id, r.start, r.length) for r in pieces} == {
        (i, sum(packing.cuts(n)[:k]), c) for i, t in want.items()
        for n in [len(tokenizer.encode(t, add_special_tokens=False).ids) + 1] for k, c in enumerate(packing.cuts(n))}


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_documents(spark, odd, none, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, odd, "")
    assert out.count() > 0
    assert stage(spark, none, "").count() == 0
    if name != "packing":
        assert out.schema.names == odd.schema.names


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 100
