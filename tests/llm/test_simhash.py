"""SimHash near-dedup against a version that works out every fingerprint and compares all of them."""

import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from cases import DOCS, SF, rows_of

from wayfare.llm import simhash
from wayfare.llm.queries import QUERIES


def plain_print(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in words.translate(dict.fromkeys(range(9, 14), " ")).split(" ") if w]
    runs = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    values = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def smallest(prints, ids):
    """The smallest id reachable by links of at most three bits, from all pairs."""
    values = np.array(prints, np.uint64)
    label = list(range(len(values)))

    def root(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for i in range(len(values)):
        bits = np.unpackbits((values[i + 1:] ^ values[i]).view(np.uint8)).reshape(-1, 64).sum(1)
        for j in np.flatnonzero(bits <= 3) + i + 1:
            label[root(j)] = root(i)
    least = {}
    for i, doc in enumerate(ids):
        least[root(i)] = min(doc, least.get(root(i), doc))
    return [least[root(i)] for i in range(len(values))]


def expected(rows):
    rows = [(i, plain_print(t)) for i, t in rows if i is not None]
    if not rows:
        return []
    found = smallest([p for _, p in rows], [i for i, _ in rows])
    return sorted((i, f"{p:016x}", c) for (i, p), c in zip(rows, found, strict=True))


def test_query(spark, docs):
    got = sorted(tuple(r) for r in QUERIES["op13_simhash_dedup"](spark, SF).collect())
    want = expected([(r.doc_id, r.text) for r in docs.collect()])
    assert got == want
    assert any(i != c for i, _, c in want)


def test_defined_cases(spark, odd, none):
    frame = simhash.near_duplicates(odd)
    assert frame.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(tuple(r) for r in frame.collect()) == expected([(r.doc_id, r.text) for r in odd.collect()])
    assert simhash.near_duplicates(none).collect() == []


def test_random_texts():
    draw = random.Random(5)
    texts = ["".join(draw.choices(" \t\n\x0b\x1c\0abCé日Z🙂", k=draw.randint(0, 60))) for _ in range(2000)]
    got = simhash.fingerprints_of(pa.array([t.encode() for t in texts], pa.binary()))
    assert [int(v) % (1 << 64) for v in got] == [plain_print(t) for t in texts]


@pytest.mark.parametrize("block", [40, 64])
def test_pieces_of_long_texts(monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    draw = random.Random(7)
    texts = [" " * draw.randint(0, 90) + "".join(draw.choices("ab\x1c \t", (8, 8, 1, 3, 1), k=draw.randint(0, 900))) for _ in range(300)]
    texts += ["a" * 500, "a" * 300 + "  " + "b" * 90, " " * 400, "x y" + " " * 200 + "z", "", "q" * 99 + " b c " + "d" * 200 + " e f "]
    got = simhash.fingerprints_of(pa.array([t.encode() for t in texts], pa.binary()))
    assert [int(v) % (1 << 64) for v in got] == [plain_print(t) for t in texts]


@pytest.mark.parametrize("crowd", [1, 256])
def test_crowded_keys(spark, crowd):
    """Chains, stars and clusters of near fingerprints in a half that is the same for all; also cut again."""
    draw = random.Random(11)
    prints = {0, (1 << 64) - 1}
    for half in (0xDEADBEEF, 0x12345678 << 32):
        free = 32 if half < 1 << 32 else 0
        for _ in range(40):
            value = draw.getrandbits(32)
            for _ in range(draw.randint(1, 12)):
                prints.add(half | value << free)
                for bit in draw.sample(range(32), draw.randint(1, 5)):
                    value ^= 1 << bit
        prints |= {half | draw.getrandbits(9) << free for _ in range(150)}
    prints = sorted(prints)
    rows = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    frame = spark.createDataFrame(rows, "fp long")
    got = {r.id: r.component for r in simhash.Join(frame, crowd).run().collect()}
    want = smallest(prints, range(len(prints)))
    groups = {}
    for (fp,), c in zip(rows, want, strict=True):
        groups.setdefault(c, set()).add(got.get(fp, fp))
    assert all(len(g) == 1 for g in groups.values())
    assert len({min(g) for g in groups.values()}) == len(groups)


def test_hot_group(spark):
    """A third of the rows are one text, others are copies with a word changed."""
    words = [f"w{i}" for i in range(400)]
    texts = [(i, " ".join(words)) for i in range(100)]
    texts += [(100 + i, " ".join(words[:i] + ["other"] + words[i + 1:])) for i in range(100)]
    texts += [(200 + i, " ".join(random.Random(i).choices(words, k=50))) for i in range(100)]
    frame = spark.createDataFrame(rows_of(texts), DOCS)
    assert sorted(tuple(r) for r in simhash.near_duplicates(frame).collect()) == expected(texts)
