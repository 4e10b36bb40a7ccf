"""The audit against each document looked at in each order, and list merges against Python's sets."""

import random
import re
from itertools import permutations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from runweave.llm import filter_audit

DOCS = "doc_id long, text string, lang string, part string, failed int, n long, good int, digest string"
LABELS = "doc_id long, quality int, toxic int, good int, part string"


def brute(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    parts = {}
    for i, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
                 "E": i is not None and i > least[text]}
        parts.setdefault(lang or "", []).append(({f for f in fails if fails[f]}, i in good, i in toxic))
    out, shapley = [], {}
    for part, rows in parts.items():
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                fails = sum(f in r[0] for r in rows)
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
                out.append([part, "".join(order), step + 1, len(left), len(gone), fails - len(gone),
                            sum(r[0] == {f} for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone), f])
    return sorted((*r[:-1], shapley[r[0], r[-1]]) for r in out)


def tables(seed, n=300):
    rng = random.Random(seed)
    texts = [None, "", " \t", "word " * 250, "A B C " * 100, "déjà\x0bvu x " * 210, "one # two"]
    texts += [" ".join(rng.choices(["alpha", "beta", "Gamma", "délta", "ε", "x|y", *map(str, range(300))], k=rng.choice([150, 199, 200, 230])))
              for _ in range(40)]
    docs = [(rng.choice([None, *range(-20, 200)]), rng.choice(texts), rng.choice([None, "", "en", "de", "fr"])) for _ in range(n)]
    docs += [(5, texts[3], "en")] * 100 + [(k, texts[3], "es") for k in range(1000, 1060)]
    labels = [(rng.choice([None, *range(-20, 200)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(150)]
    return docs, labels


def frames(spark, docs, labels):
    return (spark.createDataFrame([(*r, "x", 1, 2, 3, "y") for r in docs], DOCS).repartition(3),
            spark.createDataFrame([(*r, 7, "z") for r in labels], LABELS))


def test_equals_every_order(spark):
    docs, labels = tables(1)
    out = filter_audit.audit(*frames(spark, docs, labels))
    assert sorted(map(tuple, out.collect())) == brute(docs, labels)


def test_a_task_has_one_python_worker_at_a_time(spark):
    plan = filter_audit.audit(*frames(spark, *tables(1, 30)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_empty_tables(spark):
    docs, labels = tables(2, 30)
    assert filter_audit.audit(*frames(spark, [], labels)).count() == 0
    assert sorted(map(tuple, filter_audit.audit(*frames(spark, docs, [])).collect())) == brute(docs, [])


def test_ranges_add_up(spark, monkeypatch):
    docs, labels = tables(3)
    failed = filter_audit.failures(frames(spark, docs, labels)[0]).where("doc_id is not null").groupBy("doc_id", "part", "failed").sum("n")
    rows = failed.selectExpr("doc_id", "part", "failed", "int(pmod(doc_id, 3) = 0) as good", "int(pmod(doc_id, 4) = 0) as toxic",
                             "`sum(n)` as n").orderBy("doc_id", "part", "failed").toArrow().to_batches(max_chunksize=13)
    results = []
    for size in (7, 50, 10_000):
        monkeypatch.setattr(filter_audit, "RANGE", size)
        lists = list(filter_audit._posting_lists(iter(rows)))
        assert all(r["first_id"] <= r["last_id"] and r["ids"] == sorted(r["ids"]) for b in lists for r in b.to_pylist())
        for most in (1, 500):
            monkeypatch.setattr(filter_audit, "PARTS", most)
            total = {}
            for batch in filter_audit._sums(iter(lists)):
                for r in batch.to_pylist():
                    key = r["part"], r["filter"], r["before"]
                    total[key] = np.add(total.get(key, 0), [r[c] for c in filter_audit._SUMS])
            results.append({k: v.tolist() for k, v in total.items()})
    assert all(r == results[0] for r in results)


ascending = st.lists(st.integers(0, 60), unique=True).map(sorted).map(lambda x: np.array(x, np.int32))


@settings(max_examples=300, deadline=None)
@given(st.lists(ascending, max_size=5), ascending)
def test_merges(lists, some):
    union = sorted(set().union(*map(np.ndarray.tolist, lists)))
    assert filter_audit.merged(lists).tolist() == union
    assert filter_audit.beyond(some, filter_audit.merged(lists)).tolist() == sorted(set(some.tolist()) - set(union))
