import numpy as np
import pytest

from runweave.llm import words
from runweave.llm.components import connected_components
from runweave.llm.store import Workspace


def test_words_are_cut_at_ascii_white_space_only():
    texts = [b"", b" \t\n", b"one", " a b c".encode(), b"\x0bx\x0c\x1cy  z\r\n"]
    for text, (hashes, starts, ends) in zip(texts, words.hashed_words(texts)):
        assert [text[a:b] for a, b in zip(starts, ends)] == text.split()
        assert len(hashes) == len(text.split())


def test_hash_depends_on_the_word_alone(monkeypatch):
    text = b" ".join(b"w%d" % (k % 700) for k in range(5000)) + b" " + b"x" * 9000 + b" end"
    alone = words.hashed_words([text])[0]
    monkeypatch.setattr(words, "BLOCK", 1000)
    in_blocks = words.hashed_words([b"first", text, b"last"])[1]
    for a, b in zip(alone, in_blocks):
        assert np.array_equal(a, b)
    assert len(set(alone[0].tolist())) == len(set(text.split()))


@pytest.mark.parametrize("n, size, count", [(0, 3, 0), (1, 3, 1), (2, 3, 1), (3, 3, 1), (7, 3, 5)])
def test_shingles(n, size, count):
    assert len(words.shingles(np.arange(n, dtype=np.uint64), size)) == count


def test_components_against_union_find(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (330, 2))]
    links += [(1000, k) for k in range(1001, 1200)] + [(k, k + 1) for k in range(2000, 2060)]  # a hub and a path
    links += [(5, 5), (None, 3), (7, None), links[0]]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = connected_components(Workspace(spark, "test"), spark.createDataFrame(links, "a long, b long"), "cc")
    assert {row.item: row.component for row in got.collect()} == {x: find(x) for x in list(parent)}
    empty = connected_components(Workspace(spark, "test"), spark.createDataFrame([], "a long, b long"), "cc")
    assert empty.count() == 0
