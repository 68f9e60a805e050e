"""Vector codes with pivots against plain loops over all entries."""

import hashlib
import random

import numpy as np
import pytest

from wayfare.llm import vector_codes

VECS = "vec_id long, embedding array<float>, label int, v string, far long, code int"


def plain(rows):
    whole = [(i, np.floor(1024 * np.array(x, np.float32).astype(float)).astype(int).tolist(), label) for i, x, label in rows
             if i is not None and x and len(x) % 4 == 0 and all(c is not None and np.isfinite(c) for c in x)]
    if not whole:
        return []
    lengths = [len(v) for _, v, _ in whole]
    width = min(set(lengths), key=lambda n: (-lengths.count(n), n))
    whole = sorted((r for r in whole if len(r[1]) == width), key=lambda r: r[:2])
    w = width // 4
    parts = [[v[p * w:(p + 1) * w] for p in range(4)] for _, v, _ in whole]
    books = [[parts[r][p] for r in range(min(256, len(whole)))] for p in range(4)]

    def nearest(x, book):
        gaps = ((np.array(book) - np.array(x)) ** 2).sum(1).tolist()
        return min((d, e) for e, d in enumerate(gaps))

    for _ in range(4):
        for p in range(4):
            own = [nearest(v[p], books[p])[1] for v in parts]
            for e in set(own):
                mine = [v[p] for v, o in zip(parts, own, strict=True) if o == e]
                books[p][e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    last = [[nearest(v[p], books[p]) for p in range(4)] for v in parts]
    errors = [sum(d for d, _ in f) for f in last]
    by_label = {}
    for (_, _, label), e in zip(whole, errors, strict=True):
        by_label[label] = by_label.get(label, 0) + e
    return sorted((i, "".join(f"{e:02x}" for _, e in f), err, by_label[label], digest)
                  for (i, _, label), f, err in zip(whole, last, errors, strict=True))


def frame_of(spark, rows):
    return spark.createDataFrame([(i, x, label, "v", 3, 1) for i, x, label in rows], VECS)


@pytest.mark.parametrize(("seed", "width", "spread", "n"), [(1, 8, 1.0, 500), (2, 4, 0.002, 400), (3, 16, 0.2, 300), (4, 12, 0.5, 40)])
def test_by_brute_force(spark, seed, width, spread, n):
    draw = random.Random(seed)
    middles = [[draw.uniform(-1, 1) for _ in range(width)] for _ in range(7)]
    rows = [(i * 3 % 1009, [c + draw.gauss(0, spread) for c in draw.choice(middles)], draw.choice([1, 2, None])) for i in range(n)]
    rows += [(2000 + i, rows[0][1], 1) for i in range(n // 2)]  # a third are one vector
    rows += [(5, rows[9][1], 2), (5, rows[9][1], 2), (None, rows[0][1], 1), (3000, None, 1), (3001, [], 1), (3002, [1.0] * (width + 1), 1),
             (3003, [1.0] * (width + 4), 1), (3004, [float("nan")] * width, 1), (3005, [None] * width, 1), (-7, [float("-inf")] * width, 1)]
    got = vector_codes.compress(frame_of(spark, rows))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == plain(rows)


def test_nothing(spark):
    assert vector_codes.compress(frame_of(spark, [])).collect() == []
    assert vector_codes.compress(frame_of(spark, [(1, None, 1), (2, [1.0, 2.0], 1)])).collect() == []


def test_bounds_save_evaluations():
    draw = np.random.default_rng(4)
    middles = draw.integers(-4000, 4000, (256, 4))
    parts = middles[draw.integers(0, 256, 3000)] + draw.integers(-20, 20, (3000, 4))
    book = vector_codes.Codebook(middles)
    entry, best = book.nearest(parts, vector_codes.distances(parts, book.pivots))
    gaps = ((parts[:, None] - middles[None]) ** 2).sum(2)
    assert entry.tolist() == gaps.argmin(1).tolist()
    assert best.tolist() == gaps.min(1).tolist()
    assert book.evaluated < 3000 * 256 / 20


@pytest.mark.parametrize("scale", [1, 10**6, 2 * 10**8])
def test_ties_and_scales(scale):
    """Whole-numbered grids are full of equal distances."""
    draw = np.random.default_rng(9)
    entries = draw.integers(-3, 4, (100, 3)) * scale
    parts = draw.integers(-3, 4, (2000, 3)) * scale
    book = vector_codes.Codebook(entries)
    entry, best = book.nearest(parts, vector_codes.distances(parts, book.pivots))
    gaps = ((parts[:, None] - entries[None]) ** 2).sum(2)
    assert entry.tolist() == gaps.argmin(1).tolist()
    assert best.tolist() == gaps.min(1).tolist()
