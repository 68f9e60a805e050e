import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from cases import DOCS, SF, long_text, rows_of

from wayfare.llm import common, suffix_dedup, suffixes
from wayfare.llm.suffixes import reaches, suffix_array


def brute(rows):
    first, out = {}, []
    rows = [(i, (t or "").encode()) for i, t in rows if i is not None]
    for i, b in sorted(rows):
        for p in range(len(b) - 49):
            first.setdefault(b[p:p + 50], i)
    for i, b in rows:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < i:
                gone[p:p + 50] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def check(docs):
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest())
                 for r in suffix_dedup.remove_repeats(docs).collect())
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert got == want
    return sum(r[2] for r in want)


def planted(seed=1, n=120):
    draw = random.Random(seed)

    def text(k):
        return " ".join("".join(draw.choices("abcdeéß", k=draw.randint(1, 8))) for _ in range(k))

    passages, base = [text(draw.randint(8, 40)) for _ in range(6)], text(300)
    rows = []
    for i in range(n):
        kind = i % 6
        if kind == 0:
            rows.append(text(60) + draw.choice(passages) + text(60))
        elif kind == 1:
            at = draw.randrange(len(base) - 5)
            rows.append(base[:at] + "#" + base[at + draw.randrange(4):])
        elif kind == 2:
            rows.append("aaaa " * draw.randint(5, 60))
        elif kind == 3:
            rows.append(draw.choice(passages)[draw.randrange(30):])
        elif kind == 4:
            rows.append(text(3) * draw.randint(1, 12))
        else:
            rows.append(rows[draw.randrange(len(rows))])
    return [(draw.randrange(n * 9 // 10), t) for t in rows]


@pytest.mark.parametrize(("seed", "many"), [(1, 4096), (2, 2)])
def test_planted(spark, monkeypatch, seed, many):
    monkeypatch.setattr(suffix_dedup, "MANY", many)
    monkeypatch.setattr(suffix_dedup, "SLOT", (3000, 3000))
    monkeypatch.setattr(suffix_dedup, "SHARD", 20_000)
    docs = spark.createDataFrame(rows_of(planted(seed)), DOCS).repartition(5, "doc_id")
    assert check(docs) > 10_000


@pytest.mark.parametrize("third", ["\0", "\x01", "c"])
def test_zero_bytes_are_text(spark, monkeypatch, third):
    """Few signs, so that copies end and begin anywhere, also at a zero byte."""
    monkeypatch.setattr(suffix_dedup, "SHARD", 20_000)
    draw = random.Random(2)
    texts = ["".join(draw.choices("ab" + third, (5, 5, 1), k=draw.randint(40, 120))) for _ in range(40)]
    rows = ["".join(draw.choice(texts)[draw.randint(0, 30):][:draw.randint(20, 120)] + draw.choice(["", third]) for _ in range(3))
            for _ in range(120)]
    assert check(spark.createDataFrame(rows_of(list(enumerate(rows, 1))), DOCS).repartition(4, "doc_id")) > 5000


def test_table(docs):
    assert check(docs) > 1000


@pytest.mark.parametrize("sent", [0, 500_000])
def test_odd(spark, monkeypatch, odd, none, sent):
    monkeypatch.setattr(suffix_dedup, "SENT_IDS", sent)
    check(odd)
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert suffix_dedup.cleaned_documents(none).count() == 0
    long = long_text(1000)
    rows = rows_of([(1, long), (2, "x " + long + " y"), (3, None), (2, "é" * 30), (4, "ü" + "é" * 30), (None, long)])
    out = suffix_dedup.cleaned_documents(spark.createDataFrame(rows, DOCS))
    assert out.columns == odd.columns
    assert sorted((str(r.doc_id), r.text, r.n_chars) for r in out.collect()) == sorted([
        ("1", long, None), ("2", "x  y", 4), ("3", None, None), ("2", "é" * 30, None), ("4", "ü", 1), ("None", long, None)])


def test_suffix_arrays():
    draw = np.random.default_rng(0)
    for turn in range(300):
        n, kinds = int(draw.integers(1, 300)), int(draw.integers(1, 6)) if turn % 3 else 2000
        s = draw.integers(1, kinds + 1, n)
        s = np.append(np.tile(s[:7], n // 7 + 1) if turn % 5 == 0 else s, 0)
        plain = s.tolist()
        assert suffix_array(s).tolist() == sorted(range(len(plain)), key=lambda i: plain[i:])


def test_wide_alphabets():
    draw = np.random.default_rng(3)
    s = draw.integers(1, 9, 20_000)
    s[5000:12_000] = s[11_000:18_000]
    s = np.append(s, 0)
    text = bytes(s.tolist())
    assert suffix_array(s).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_doubling_sorts_equal_suffixes_only(monkeypatch):
    """Of a wide reduced string, suffixes that their names tell apart are not sorted by rank."""
    draw, sizes, plain = np.random.default_rng(4), [], np.argsort
    s = np.append(draw.integers(1, 200, 20_000), 0)
    s[15_000:15_600] = s[2000:2600]
    monkeypatch.setattr(np, "argsort", lambda a, **how: (sizes.append(len(a) if a.itemsize == 8 else 0), plain(a, **how))[1])
    got = suffix_array(s)
    text = bytes(s.tolist())
    assert got.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    assert 0 < sum(sizes) < 6000


def test_stops_keep_equal_starts_together():
    draw = random.Random(5)
    base = "".join(draw.choices("abcd", k=400))
    strings = sorted({base[i:i + draw.randint(60, 90)] for i in (draw.randrange(300) for _ in range(60))})
    raw = np.frombuffer("\0".join([*strings, ""]).encode(), np.uint8)
    symbols = raw.astype(np.uint16) + np.uint16(2)
    symbols[raw == 0] = 1
    order = suffix_array(np.append(symbols, np.uint16(0)), stop=1)[1:]
    text = raw.tobytes()
    heads = [text[i:].split(b"\0")[0] for i in order]
    assert sorted(order.tolist()) == list(range(len(text))) and heads == sorted(heads)


def test_reaches():
    text = b"abcabcabcabc" * 9 + b"x" + b"abcabcabcab"
    sa = suffix_array(np.append(np.frombuffer(text, np.uint8).astype(int), 0))[1:]
    got = reaches(np.frombuffer(text + bytes(50), np.uint8), sa, 50)
    for before, at in zip(sa, sa[1:], strict=False):
        same = text[at:at + 50] + bytes(max(0, at + 50 - len(text)))
        assert got[at] == (same == text[before:before + 50] + bytes(max(0, before + 50 - len(text))))


def test_entries_are_small(spark):
    """An entry of a minimizer is a key, a content hash and two numbers of as few bytes as they take."""
    draw = random.Random(8)
    words = ["".join(draw.choices("abcdefghijklmnop", k=7)) for _ in range(5000)]
    for base in (0, -(1 << 62)):
        rows = rows_of((base + i, " ".join(draw.choices(words, k=300))) for i in range(100))
        blobs = [bytes(r.entries) for r in suffix_dedup.Dedup(spark.createDataFrame(rows, DOCS))._entries().collect()]
        entries = sum(int(np.frombuffer(b, np.int64, 1)[0]) for b in blobs)
        assert entries > 8000 and sum(map(len, blobs)) < 15 * entries


def test_numbers_in_the_least_width():
    for numbers, width in (([0, 255], 1), ([0, 256], 2), ([0, 1 << 16], 4), ([0, 1 << 32], 8), ([0, -2], 8)):
        packed = suffix_dedup._narrow(np.array(numbers, np.int64))
        assert packed.itemsize == width and packed.astype(np.int64).tolist() == numbers


def test_cut_texts_of_rows_repeated_under_an_id(spark):
    passage = " ".join(f"word{i}" for i in range(40))
    rows = rows_of([(1, passage), *[(2, f"{passage} more")] * 3, (3, "short")])
    out = suffix_dedup.cleaned_documents(spark.createDataFrame(rows, DOCS))
    cut = [(i, t, lang, source, 5, *rest) for i, t, lang, source, _, *rest in rows_of([(2, " more")] * 3)]
    assert sorted(map(tuple, out.collect())) == [*rows_of([(1, passage)]), *cut, *rows_of([(3, "short")])]


def test_sorting_takes_few_bytes_a_symbol(monkeypatch):
    monkeypatch.setattr(suffixes, "STRETCH", 1 << 14)
    draw = np.random.default_rng(5)
    words = [bytes(draw.integers(97, 123, n, np.uint8)) for n in draw.integers(1, 9, 2000)]
    raw = b" ".join(words[i] for i in draw.integers(0, 2000, 60_000))
    s = np.append(np.frombuffer(raw, np.uint8).astype(np.uint16) + 2, np.uint16(0))
    padded = np.frombuffer(raw + bytes(50), np.uint8)
    tracemalloc.start()
    sa = suffix_array(s, stop=1)
    sorting = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    reaches(padded, sa[1:], 50)
    comparing = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorting < 30 * len(s)
    assert comparing < 25 * len(s)


def test_one_python_step_a_task_and_arrow_batches_of_few_bytes(spark, monkeypatch, capsys):
    plans, sizes, whole = {}, {}, suffix_dedup.stored

    def stored(df, name):
        df.explain()
        plans[name] = capsys.readouterr().out
        sizes[name] = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None)
        return whole(df, name)

    monkeypatch.setattr(suffix_dedup, "stored", stored)
    docs = spark.createDataFrame([(1, "é" * 40 + "x" * 60), (2, "ü" + "é" * 40 + "x" * 60), (3, None), (4, "short")],
                                 "doc_id long, text string")
    assert sorted(suffix_dedup.cleaned_documents(docs).collect()) == [
        (1, "é" * 40 + "x" * 60), (2, "ü"), (3, None), (4, "short")]
    assert plans["cut-texts"].count("MapInArrow") == 1
    assert sizes["slot-findings"] == sizes["cut-texts"] == str(4 << 20)


def test_groups_leave_nothing_in_the_worker():
    held = []

    def run(key, table):
        held.append(len(common._KEPT))
        common.kept("words", lambda: [0])
        return table

    common.kept("words of another stage", lambda: [0])
    table = pa.table({"a": [1]})
    assert common.tidied_group(run)((1,), table) is table
    assert held == [0]
    assert not common._KEPT


def test_chance_does_not_send_text(spark):
    """Texts of so few syllables that nearly all 16-byte strings are met again, and hardly any of 50 bytes."""
    draw = random.Random(6)
    parts = ["".join(draw.choices("abcdefghij", k=4)) for _ in range(16)]
    texts = ["".join(draw.choices(parts, k=1000)) for _ in range(100)]
    copied = texts[3][1001:1401]
    texts[60] = texts[60][:2000] + copied + texts[60][2000:]
    docs = spark.createDataFrame(rows_of(list(enumerate(texts))), DOCS)
    sent = 0
    for row in suffix_dedup.Dedup(docs)._sent().where("NOT marks").collect():
        raw = zstandard.decompress(bytes(row.data))
        sent += len(raw) - 8 - 24 * int(np.frombuffer(raw, np.int64, 1)[0])
    assert 0 < sent < sum(map(len, texts)) // 5
    assert check(docs) >= 400


def test_blocks_cut_where_the_least_string_is(monkeypatch):
    """Each window is in one block; a block's windows have their least hash at one place, or each more than once."""
    monkeypatch.setattr(suffix_dedup, "GRAMS", 5)
    draw = np.random.default_rng(2)
    for kinds in (2, 4, 50, 1):
        hashes = draw.integers(0, kinds, 400).astype(np.uint64)
        low = np.array([hashes[i:i + 5].min() for i in range(396)])
        begin = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
        at, windows, place, least = suffix_dedup._placed(hashes, begin, np.diff(np.append(begin, 396)), low[begin])
        assert sorted(np.concatenate([np.arange(a, a + n) for a, n in zip(at, windows, strict=True)]).tolist()) == list(range(396))
        for a, n, p, value in zip(at.tolist(), windows.tolist(), place.tolist(), least.tolist(), strict=True):
            for w in range(a, a + n):
                found = [i for i in range(w, w + 5) if hashes[i] == low[w]]
                assert low[w] == value and (found == [p] if p >= 0 else len(found) > 1)
        if kinds == 1:
            assert (at.tolist(), windows.tolist(), place.tolist()) == ([0], [396], [-1])


def test_marks_that_meet_become_one():
    marks = np.array([[70, 2], [5, 3], [8, 1], [20, 1], [6, 1], [72, 1]])
    assert suffix_dedup._merged(marks).tolist() == [[5, 4], [20, 1], [70, 3]]
    assert suffix_dedup._merged(np.empty((0, 2), np.int64)).shape == (0, 2)


def test_keys_in_few_bytes():
    keys = np.sort(np.random.default_rng(1).integers(0, 1 << 32, 600).astype(np.uint32))
    for part in (keys, keys[:1], np.array([0, 0, (1 << 32) - 1], np.uint32)):
        packed = suffix_dedup._steps(part)
        assert suffix_dedup._unstepped(packed).tolist() == part.tolist()
    assert len(zstandard.compress(suffix_dedup._steps(keys), 1)) < 3.3 * len(keys)


EXTRA = ("struct(doc_id % 3 AS a, array(text, NULL) AS `b.c`) AS `odd.one`, map('k', doc_id) AS pairs, "
         "timestamp'2024-01-02 03:04:05.678901' AS seen, cast(doc_id AS decimal(20, 3)) AS money, cast(text AS binary) AS raw, "
         "cast(NULL AS string) AS nothing, date'1500-01-01' AS day")


@pytest.mark.parametrize("more", ["", ", INTERVAL '3' MONTH AS months"])
def test_other_columns_go_along(spark, monkeypatch, capsys, more):
    """However many documents are cut, and with columns that Arrow can't hold too; rows without joins where it can."""
    monkeypatch.setattr(suffix_dedup, "SENT_IDS", 0)
    monkeypatch.setattr(suffix_dedup, "SLOT", (300, 300))
    passage = "the passage é of many documents, sixty bytes long or more, ends here."
    rows = [(i % 25 if i % 7 else None, f"{draw} {passage if i % 3 else ''} {i}" if i % 11 else None)
            for i, draw in enumerate(random.Random(4).choices(["a b", "", "ü"], k=60))]
    plain = spark.createDataFrame(rows, "doc_id int, text string")
    docs = spark.sql(f"SELECT doc_id, length(text) AS n_chars, text, {EXTRA}{more} FROM {{plain}}", plain=plain)
    out = suffix_dedup.cleaned_documents(docs)
    assert out.dtypes == docs.dtypes
    keep = [c for c in docs.columns if c not in ("n_chars", "text", "months")]
    shown = lambda df: sorted(repr(tuple(r)) for r in df.select(*[f"`{c}`" for c in keep]).collect())
    assert shown(out) == shown(docs)
    least = min(i for i, t in rows if i is not None and t and passage in t)
    got = out.select("doc_id", "n_chars", "text", "raw").collect()
    for i, n, text, raw in got:
        was = None if raw is None else raw.decode()
        assert (text is None) == (was is None) and n == (None if text is None else len(text))
        assert text == was if i in (None, least) or not was or passage not in was else passage not in text
    out.explain()
    assert ("Join" in capsys.readouterr().out) == bool(more)


def test_shuffles_go_when_their_result_is_stored(spark, monkeypatch):
    key, seen, whole = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", {}, suffix_dedup.stored

    def stored(df, name):
        seen[name] = spark.conf.get(key, None)
        return whole(df, name)

    monkeypatch.setattr(suffix_dedup, "stored", stored)
    docs = spark.createDataFrame([(1, "x" * 90), (2, "y" + "x" * 90)], "doc_id long, text string")
    assert sorted(suffix_dedup.cleaned_documents(docs).collect()) == [(1, "x" * 90), (2, "y")]
    assert seen == dict.fromkeys(("shared-keys", "slot-findings", "cut-texts"), "true")
    assert spark.conf.get(key, None) is None
