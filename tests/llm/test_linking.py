import random
from itertools import combinations

import pytest

from runweave.llm import linking
from runweave.llm.store import Workspace


def similar(x, y, percent):
    return 100 * len(x & y) >= percent * len(x | y)


def brute(buckets, sets, percent):
    """The components of the linked items of common buckets, each named by its least item."""
    component = {item: item for item in sets}
    linked = set()
    for members in buckets.values():
        for a, b in combinations(members, 2):
            if similar(sets[a], sets[b], percent):
                linked |= {a, b}
                low, high = sorted((component[a], component[b]))
                component = {k: low if v == high else v for k, v in component.items()}
    return {item: component[item] for item in linked}


def linked(spark, buckets, sets, percent, work=None):
    rows = [(bucket, item, len(sets[item]), item % 7) for bucket, members in buckets.items() for item in members]
    buckets = spark.createDataFrame(rows, "bucket long, item long, n long, score long")
    members = spark.createDataFrame([(k, list(v)) for k, v in sets.items()], "item long, members array<long>")
    out = linking.link_buckets(work or Workspace(spark, "test"), buckets, members, percent, "near")
    return {row.item: row.component for row in out.collect()}


@pytest.mark.parametrize("percent, seed", [(80, 1), (85, 2), (50, 3)])
def test_large_buckets_against_all_pairs(spark, monkeypatch, percent, seed):
    """Members near and far from the leader, parts of it, and groups of their own at either side of the threshold."""
    monkeypatch.setattr(linking, "LEADER_ROUNDS", 1)
    rng = random.Random(seed)
    draw = lambda n: set(rng.sample(range(5000), n))
    buckets, sets = {}, {}
    for bucket in range(4):
        common, members = draw(rng.choice([1, 4, 8])), []
        base = [draw(rng.choice([12, 25, 60])) | common for _ in range(6)]
        base += [set(rng.sample(sorted(base[0]), max(1, int(len(base[0]) * share)))) for share in (0.6, 0.75, 0.83)]
        for _ in range(50):
            own = set(rng.choice(base))
            for _ in range(rng.randrange(0, 1 + len(own) // 5)):
                own.discard(rng.choice(sorted(own)))
                own |= draw(rng.randrange(2))
            sets[len(sets)] = own or {1}
            members.append(len(sets) - 1)
        buckets[bucket] = members + rng.sample(range(len(sets)), 5)
        buckets[bucket] = sorted(set(buckets[bucket]))
    assert linked(spark, buckets, sets, percent) == brute(buckets, sets, percent)


def test_members_that_only_share_a_phrase_send_no_rows(spark):
    rng = random.Random(4)
    sizes = {}

    class Counted(Workspace):
        def keep(self, df, name):
            table = super().keep(df, name)
            sizes[name] = table.count()
            return table

    for n in (40, 80):
        sets = {k: {1, 2, 3, 4} | set(rng.sample(range(10, 10**9), 30)) for k in range(n)}
        assert linked(spark, {1: range(n)}, sets, 80, Counted(spark, "test")) == {}
        assert sizes["near-differences"] == 30 * (n - 1)  # not what each lacks of the leader
        assert sizes["near-placed"] == 0
