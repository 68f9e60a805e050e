import re

from cases import DOCS, rows_of

from wayfare.llm import exact_dedup, langid


def brute(rows):
    groups = {}
    for i, t in rows:
        if i is not None:
            groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i))
    return {(i, min(g)[1], len(g), i == min(g)[1]) for g in groups.values() for _, i in g}


def test_dedup_by_brute_force(spark, odd):
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.dedup(odd).collect()}
    assert got == brute([(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()])


def test_index_persists_and_takes_later_batches(spark, tmp_path):
    path = str(tmp_path / "index")
    first = exact_dedup.dedup(spark.createDataFrame(rows_of([(5, "a b"), (3, "ab"), (4, "c")]), DOCS),
                              exact_dedup.DigestIndex(spark, path, 4)).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in first} == {(5, 5, True), (3, 5, False), (4, 4, True)}
    again = exact_dedup.DigestIndex(spark, path, 4)
    assert again.rows().count() == 2
    second = exact_dedup.dedup(spark.createDataFrame(rows_of([(1, "a  b"), (9, "d")]), DOCS), again).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in second} == {(1, 5, False), (9, 9, True)}
    assert again.rows().count() == 3
    plan = again.missing(again.rows())._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_batches_go_through_one_index(spark, tmp_path, odd, none):
    rows = [(1, "a b"), (2, "c"), (30, "ab"), (31, "a  b"), (60, "a  b"), (61, "d"), (90, "c"), (91, "e"), (91, "e")]
    index = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), 4)
    got = {tuple(r)[:4] for r in exact_dedup.dedup_in_batches(spark.createDataFrame(rows_of(rows), DOCS), index).collect()}
    assert got == brute(rows)
    # Four texts, and the longer document of the second batch: the index decided the other rows.
    assert sorted(r.keep_id for r in index.rows().collect()) == [1, 2, 31, 61, 91]
    assert sorted(r.keep_id for r in index.best().collect()) == [2, 31, 61, 91]
    again = exact_dedup.dedup(spark.createDataFrame(rows_of([(5, "ab")]), DOCS), index).collect()
    assert [(r.doc_id, r.keep_id, r.kept) for r in again] == [(5, 31, False)]
    whole = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.dedup_in_batches(odd).collect()}
    assert whole == brute([(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()])
    assert exact_dedup.dedup_in_batches(none).count() == 0


def test_an_index_keeps_its_layout(spark, tmp_path):
    rows = [(i, f"text {i}") for i in range(50)]
    docs, path = spark.createDataFrame(rows_of(rows), DOCS), f"file://{tmp_path}/index"
    first = exact_dedup.dedup(docs, exact_dedup.DigestIndex(spark, path, 4))
    assert first.where("kept").count() == 50
    index = exact_dedup.DigestIndex(spark, path, 8)
    assert index.buckets == 4
    copies = spark.createDataFrame(rows_of([(100 + i, t) for i, t in rows]), DOCS)
    got = exact_dedup.dedup(copies, index)
    assert {(r.doc_id, r.keep_id, r.kept) for r in got.collect()} == {(100 + i, i, False) for i, _ in rows}
    # The first batch once more.
    again = exact_dedup.dedup(docs, exact_dedup.DigestIndex(spark, path, 8))
    assert {(r.doc_id, r.keep_id, r.kept) for r in again.collect()} == {(i, i, True) for i, _ in rows}
    assert index.rows().count() == 50


def test_kept_documents(spark, odd):
    out = exact_dedup.kept_documents(odd)
    assert out.columns == odd.columns
    ids = sorted(r.doc_id for r in out.collect())
    assert ids == [3, 5, 6, 8, 9, 10, 11, 12, 13, 14, 15]
    assert exact_dedup.kept_documents(spark.createDataFrame(rows_of([(1, "a"), (1, "a"), (1, "b")]), DOCS)).count() == 2


def test_repeated_null_texts_stay_a_document(spark):
    out = exact_dedup.kept_documents(spark.createDataFrame(rows_of([(1, None), (1, None), (2, "a")]), DOCS)).collect()
    assert sorted((r.doc_id, r.text, r.lang) for r in out) == [(1, None, "en"), (2, "a", "en")]


def test_empty(none):
    assert exact_dedup.dedup(none).count() == 0
    assert exact_dedup.kept_documents(none).count() == 0
    model = langid.learn(none)
    assert langid.predict(none, model).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.learn(docs.where(~langid.held_out()))
    assert model.languages == ["de", "en", "es", "fr"]
    rows = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(langid.held_out()).collect()
    assert len(rows) > 150
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.98


def test_language_cases(odd, docs):
    got = {(r.doc_id, r.lang_pred == "und", 0 <= r.score <= 1) for r in langid.predict(odd, langid.learn(docs)).collect()}
    assert {i for i, und, _ in got if und} == {1, 2, 3, 10, 14} and all(ok for *_, ok in got)
    nothing = langid.learn(docs.where("false"))
    assert {r.lang_pred for r in langid.predict(odd, nothing).collect()} == {"und"}
    kept = langid.identified(odd, langid.learn(docs))
    assert kept.columns == odd.columns and {1, 2, 3, 10}.isdisjoint(r.doc_id for r in kept.collect())


def test_codewords_keep_their_distance():
    for n in (2, 3, 4, 5, 6, 9, 20, 60):
        words = langid.codewords(n)
        apart = min((words[i] != words[j]).sum() for i in range(n) for j in range(i))
        assert apart >= max(1, words.shape[1] // 4)
    one = langid.Model({"en": langid.profile("hello")})
    assert one.predict("hi") == ("en", 1.0, False)


def test_broken_bits_are_corrected():
    texts = {"a": "aaab aaac", "b": "bbbx bbby", "c": "cccz cccw", "d": "dddq ddde"}
    model = langid.Model({k: langid.profile(v) for k, v in texts.items()})
    model.weights[2] *= -1
    model.middle[2] *= -1
    assert all(model.predict(v)[0] == k for k, v in texts.items())
