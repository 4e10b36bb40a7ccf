import math

import numpy as np

from runweave.llm import neighbours
from runweave.llm.store import Workspace

SCHEMA = "vec_id long, embedding array<float>, node long, rank string"


def brute(rows, every, k):
    good = {}
    for i, v in rows:
        if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v):
            good[i] = v
    out = {}
    for q, x in good.items():
        if q % every == 0:
            cos = lambda y: math.fsum(a * b for a, b in zip(x, y)) / (math.sqrt(math.fsum(a * a for a in x)) * math.sqrt(math.fsum(b * b for b in y)))  # noqa: E731,B023
            out[q] = sorted(((-cos(y), i) for i, y in good.items() if i != q))[:k]
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "r") for i, v in rows], SCHEMA)


def single(v):
    return np.asarray(v, np.float32).astype(float).tolist()


def test_small_table_is_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(k, single(rng.normal(size=8))) for k in range(300)]
    rows += [(k, rows[50][1]) for k in range(300, 420)]  # one vector that a quarter of all rows share
    rows += [(k, single(2 * np.array(rows[100][1]))) for k in range(420, 430)]  # ties up to length
    rows += [(500, None), (550, []), (600, [0.0] * 8), (650, [None] + [1.0] * 7), (700, [math.nan] + [1.0] * 7),
             (750, [math.inf] + [1.0] * 7), (None, rows[3][1]), rows[7]]
    got = {}
    for row in neighbours.nearest(table(spark, rows)).collect():
        got.setdefault(row.query_id, {})[row.rank] = (row.vec_id, row.score)
    want = brute(rows, 50, 5)
    assert set(got) == set(want)
    for q, found in want.items():
        assert [got[q][r][0] for r in range(1, 6)] == [i for _, i in found]
        assert [got[q][r][1] for r in range(1, 6)] == [-s for s, _ in found]


def test_recall_on_a_graph(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 150)
    monkeypatch.setattr(neighbours, "NODES_AT_ONCE", 900)
    rng = np.random.default_rng(2)
    rows = [(k, single(rng.normal(size=24))) for k in range(3000)]
    got = {}
    for row in neighbours.nearest(table(spark, rows)).collect():
        got.setdefault(row.query_id, set()).add(row.vec_id)
    want = brute(rows, 50, 5)
    assert np.mean([len(got[q] & {i for _, i in found}) / 5 for q, found in want.items()]) >= 0.9


def test_few_or_no_rows(spark):
    assert neighbours.nearest(table(spark, [])).collect() == []
    assert neighbours.nearest(table(spark, [(0, [1.0, 0.0])])).collect() == []
    rows = neighbours.nearest(table(spark, [(0, [1.0, 0.0]), (7, [1.0, 1.0]), (3, [-1.0, 0.0])])).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in sorted(rows, key=lambda r: r.rank)] == [(0, 1, 7), (0, 2, 3)]


def test_graph_of_a_hot_direction(spark, monkeypatch):
    for name, value in (("BLOCK", 10), ("DEGREE", 5), ("DIVISIONS", 2)):
        monkeypatch.setattr(neighbours, name, value)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(4000, 8)) + 12 * np.eye(8)[0]  # all on one side of nearly every plane
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype("<f4")
    work = Workspace(spark, "test")
    nodes = work.keep(spark.createDataFrame([(k, bytearray(v.tobytes())) for k, v in enumerate(x)], "node long, unit binary"), "nodes")
    got = {}
    for row in neighbours.build_graph(work, nodes, 8, len(x)).collect():
        got.setdefault(row.a, set()).add(row.b)
    sims = x @ x.T
    np.fill_diagonal(sims, -9)
    want = np.argpartition(-sims, 4, axis=1)[:, :5]
    assert np.mean([len(got[k] & set(want[k].tolist())) / 5 for k in range(len(x))]) >= 0.7


def exact(rows, every, k):
    from fractions import Fraction
    out = {}
    for q, x in rows:
        if q % every == 0:
            def key(y):
                dot, xx, yy = (sum(Fraction(a) * Fraction(b) for a, b in zip(u, v)) for u, v in ((x, y), (x, x), (y, y)))
                return -(dot * dot / (xx * yy)) * (1 if dot > 0 else -1)
            out[q] = [i for _, i in sorted((key(y), i) for i, y in rows if i != q and len(y) == len(x))[:k]]
    return out


def found_by(spark, rows):
    frame = spark.createDataFrame([(i, list(map(float, v))) for i, v in rows], "vec_id long, embedding array<double>")
    got = {}
    for row in sorted(neighbours.nearest(frame).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(row.query_id, []).append(row.vec_id)
    return got


def test_directions_equal_in_float32_only(spark):
    rows = [(0, [1.0, 0.0])] + [(j, [1.0, 1 - j * 1e-9]) for j in range(1, 21)]
    assert found_by(spark, rows) == {0: [20, 19, 18, 17, 16]} == exact(rows, 50, 5)


def test_any_finite_size_and_lengths_apart(spark):
    rng = np.random.default_rng(3)
    rows = [(k, (rng.normal(size=4) * 10.0 ** rng.integers(-200, 200)).tolist()) for k in range(60)]
    rows += [(k, rng.normal(size=3).tolist()) for k in range(100, 120)]
    rows += [(150, [1e-310, 0.0, 0.0]), (151, [1.7e308, 1.7e308, 1.0]), (200, [-0.0, 2.0]), (201, [0.0, 1.0])]
    assert found_by(spark, rows) == exact(rows, 50, 5)
