import hashlib
import random
from itertools import combinations

import pytest

from runweave.llm import linking, near_dups

SCHEMA = "doc_id long, text string, n long, component string"


def shingles(text, size):
    w = (text or "").encode().lower().split()
    return {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, size, percent):
    sets = [shingles(text, size) for _, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            parent[find(i)] = find(j)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(k)] = min(least.get(find(k), doc_id), doc_id)
    out = []
    for k, (doc_id, _) in enumerate(rows):
        component = least.get(find(k)) if sets[k] else doc_id
        out.append((doc_id, len(sets[k]), component, doc_id == component))
    return sorted(out, key=str)


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(3000)
    rows = [(None, "lone null id"), (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"),
            (7, "one two"), (8, "one two three"), (9, "Ünïted"), (10, "ünïted")]
    at = 11
    for group in range(12):  # a base and copies with a few words changed, near the threshold on both sides
        base = [word() for _ in range(rng.choice([30, 60, 150]))]
        for _ in range(rng.choice([2, 5, 25])):
            copy = list(base)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.3:
                copy = copy[:-rng.randrange(1, 6)]
            rows.append((at, " ".join(copy)))
            at += 1
    rows += [(at + k, " ".join(word() for _ in range(40))) for k in range(60)]
    rows += [rows[30], rows[31], (None, rows[40][1]), (rows[50][0], rows[60][1])]  # repeated rows, null and shared ids
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("size, percent, halves, small", [(3, 85, 12, 16), (3, 85, 12, 2), (5, 80, 16, 2)])
def test_against_all_pairs(spark, monkeypatch, size, percent, halves, small):
    monkeypatch.setattr(linking, "SMALL", small)
    rows = corpus()
    docs = spark.createDataFrame([(a, b, 1, "x") for a, b in rows], SCHEMA)
    got = near_dups.near_duplicates(docs, size, percent, halves).collect()
    assert sorted([tuple(row) for row in got], key=str) == brute(rows, size, percent)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert near_dups.near_duplicates(docs).collect() == []
    assert near_dups.keep_one(docs).columns == docs.columns


def test_one_of_each_group_stays(spark):
    text = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(9, text, 0, "a"), (3, text + " tail", 1, "b"), (5, "other text", 2, "c"), (7, None, 3, "d")], SCHEMA)
    assert sorted(row.doc_id for row in near_dups.keep_one(docs).collect()) == [3, 5, 7]


@pytest.mark.parametrize("seed", [1, 2])
def test_keep_one_against_all_pairs(spark, seed):
    rows = corpus(seed)
    rng = random.Random(seed)
    rows = [(rng.choice([i, i, i, rng.randrange(12, 60)]) if i is not None else None, text) for i, text in rows]  # shared ids
    rows += [rng.choice(rows) for _ in range(20)]
    sets = [shingles(text, 5) for _, text in rows]
    group = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both) and group[i] != group[j]:
            group = [group[i] if g == group[j] else g for g in group]
    want = [(*row, 1, "x") for row, s in zip(rows, sets) if not s]
    for g in set(group):
        members = [rows[k] for k in range(len(rows)) if group[k] == g and sets[k]]
        if members:
            want.append((*min(members, key=lambda r: (r[0] is None, r[0], hashlib.sha256(r[1].encode()).digest())), 1, "x"))
    docs = spark.createDataFrame([(a, b, 1, "x") for a, b in rows], SCHEMA)
    assert sorted(map(tuple, near_dups.keep_one(docs).collect()), key=str) == sorted(want, key=str)


def test_shared_ids_and_clashing_names(spark):
    a, b = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    rows = [(5, a, 1), (5, a, 2), (3, b, 3), (5, b + " tail", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_id int").selectExpr("*", "1 as digest", "2 as row", "3 as copies")
    out = near_dups.keep_one(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(3, b), (5, a)]
