"""Vector codes against plain Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from runweave.llm import vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int, code string, of_label int, error long"


def brute(rows, parts, size, rounds, scale=256):
    kept = [(i, [math.floor(x * scale) if abs(x) < 2 ** 53 else int(x) * scale for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    width = -(-max(len(v) for _, v, _ in kept) // parts)
    cut = [[(v + [0] * (width * parts - len(v)))[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:size]] for p in range(parts)]

    def best(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, y)), k) for k, y in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for c in cut:
                members.setdefault(best(c[p], books[p])[1], []).append(c[p])
            books[p] = [[sum(col) // len(members[k]) for col in zip(*members[k])] if k in members else y
                        for k, y in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for y in b for x in y).encode()).hexdigest()
    found = []
    for (i, _, label), c in zip(kept, cut):
        picks = [best(x, b) for x, b in zip(c, books)]
        found.append((i, label, "".join(f"{k:02x}" for _, k in picks), sum(d for d, _ in picks)))
    sums = {}
    for _, label, _, error in found:
        sums[label] = sums.get(label, 0) + error
    long = lambda x: x if x < 2 ** 63 else None
    return sorted(((i, code, long(error), long(sums[label]), digest) for i, label, code, error in found), key=str)


def answer(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(3)
    out = vector_codes.compress(df, **how)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted(map(tuple, out.collect()), key=str)


def test_equals_plain_integers(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(8)], rng.choice([0, 1, None])) for i in range(120)]
    rows += [(i, rows[7][1], 5) for i in range(200, 240)]  # one vector many times
    rows += [(300, None, 1), (301, [float("nan")] * 8, 1), (302, [None] * 8, 1), (303, [float("inf")] * 8, 1)]
    rows += [(304, [0.5] * 5, 2), (305, [], 2), (None, [0.25] * 8, 2), (3, rows[3][1], 0), (3, rows[4][1], 0)]
    assert answer(spark, rows, parts=4, size=9) == brute(rows, 4, 9, 2)


def test_any_finite_size(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([1, -1]) * 2.0 ** rng.randint(-3, 40 if i % 2 else 4) for _ in range(4)], i % 3) for i in range(60)]
    rows += [(100, [1e300, -1e300, 5e-324, 0.0], 7), (101, [1.7e308, 1.0, -5e-324, 3.0], 7)]
    assert answer(spark, rows, parts=2, size=5) == brute(rows, 2, 5, 2)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [], 1)], [(4, [0.1, 0.2, 0.3], None)]])
def test_small_tables(spark, rows):
    assert answer(spark, rows) == brute(rows, 16, 64, 2)


def test_dot_products_are_exact():
    rng = np.random.default_rng(1)
    x, y = rng.integers(-2 ** 62, 2 ** 62, (20, 7)), rng.integers(-2 ** 62, 2 ** 62, (5, 7))
    found = vector_codes.dot_products(x, y)
    for i, row in enumerate(x.tolist()):
        for j, other in enumerate(y.tolist()):
            assert (sum(a * b for a, b in zip(row, other)) - int(found[i, j])) % 2 ** 64 == 0


def test_decoding_is_near(spark):
    rng = random.Random(5)
    rows = [(i, [rng.random() for _ in range(4)], 0) for i in range(64)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    books = vector_codes.fit(df, parts=2, size=64, rounds=0)
    for row in vector_codes.encode(df, books).collect():
        want = rows[row.vec_id][1]
        assert row.error == 0 and all(abs(a - b) <= 0.5 / 256 for a, b in zip(books.decode(row.code), want))
