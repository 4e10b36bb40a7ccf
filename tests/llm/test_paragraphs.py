import random

import numpy as np
import pyarrow as pa

from runweave.llm import paragraphs, words

SCHEMA = "doc_id long, text string, n_chars long, component string, low string"


def sentence(rng, n):
    return " ".join("w%d" % rng.randrange(50_000) for _ in range(n)) + "."


def prose(rng, sentences):
    return " ".join(sentence(rng, rng.randrange(4, 12)) for _ in range(sentences))


def table(spark, rows):
    return spark.createDataFrame([(i, t, len(t or ""), "c", "l") for i, t in rows], SCHEMA)


def test_shared_passages_go_and_the_rest_stays(spark):
    rng = random.Random(5)
    texts = [prose(rng, 30) for _ in range(40)]
    passages = [prose(rng, 14) for _ in range(6)]
    short = sentence(rng, 12)
    planted = {}
    for k, passage in enumerate(passages):
        for doc in (3 * k, 3 * k + 1, 3 * k + 2):
            cut = rng.randrange(len(texts[doc])) if doc % 3 else 0
            cut = texts[doc].find(" ", cut)
            texts[doc] = texts[doc][:cut] + " " + passage + texts[doc][cut:]
            planted.setdefault(k, []).append(doc)
    for doc in range(20, 40):
        texts[doc] += " " + short  # a short common line is no passage
    rows = list(enumerate(texts)) + [(100, None), (101, ""), (102, " \n"), (None, "no id here.")]
    out = {row.doc_id: row.text for row in paragraphs.without_passages(table(spark, rows)).collect()}
    assert set(out) == {i for i, _ in rows}
    for k, passage in enumerate(passages):
        assert [doc for doc in planted[k] if passage in out[doc]] == [min(planted[k])]
        for doc in planted[k][1:]:
            assert len(out[doc].split()) < len(texts[doc].split()) - 50
    for doc in [d for d in range(40) if d >= 18]:
        assert out[doc] == texts[doc]


def test_near_equal_passages_are_found(spark):
    rng = random.Random(8)
    long = [sentence(rng, 60) for _ in range(6)]
    changed = [s.replace(s.split()[30], "other", 1) for s in long]  # 5 of 61 shingles differ
    rows = [(1, prose(rng, 9) + " " + " ".join(long)), (2, prose(rng, 9) + " " + " ".join(changed))]
    runs = paragraphs.repeated_passages(table(spark, rows)).collect()
    assert {row.doc_id for row in runs} == {2} and sum(row.n_words for row in runs) >= 120
    assert {row.first_doc_id for row in runs} == {1}


def test_ties_copies_and_bytes(spark):
    rng = random.Random(9)
    text = "Ünïted ßtates. " + prose(rng, 12)
    rows = [(5, text), (5, text), (2, text), (None, text), (8, "x " * 40_000)]
    out = paragraphs.without_passages(table(spark, rows)).collect()
    assert sorted((row.doc_id is None, row.doc_id or 0) for row in out) == [(False, 2), (False, 8)]
    assert {row.doc_id: row.text for row in out}[2] == text
    row = paragraphs.without_passages(table(spark, [(1, text), (2, "Über allem. " + text)])).where("doc_id = 2").first()
    assert row.text.startswith("Über allem.") and row.n_chars == len(row.text) < 60


def test_empty_table(spark):
    assert paragraphs.repeated_passages(table(spark, [])).collect() == []
    assert paragraphs.without_passages(table(spark, [])).columns == table(spark, []).columns


def words_of(rng, n):
    return ["w%d" % rng.randrange(50_000) for _ in range(n)]


def sentences_of(rng, n, ends):
    out = words_of(rng, n)
    for k in range(1, ends + 1):
        out[k * n // (ends + 1) + rng.randrange(-3, 4)] += "."
    return " ".join(out)


def test_short_passages_go_whole_with_any_sentences(spark):
    rng = random.Random(11)
    rows, want = [], {}
    for k in range(120):
        passage = sentences_of(rng, rng.randrange(51, 81), k % 5)  # none to four sentence ends
        fill = [" ".join(words_of(rng, 40)) for _ in range(4)]
        rows += [(2 * k, f"{fill[0]} {passage} {fill[1]}"), (2 * k + 1, f"{fill[2]} {passage} {fill[3]}")]
        want[2 * k], want[2 * k + 1] = rows[-2][1], f"{fill[2]} {fill[3]}"
    out = {row.doc_id: row.text for row in paragraphs.without_passages(table(spark, rows)).collect()}
    assert out == want


def test_near_equal_passages_of_either_series_are_found(spark):
    rng = random.Random(12)
    rows = []
    for k in range(60):
        ends = 3 + k % 4
        # 5 of 52 shingles of a sentence differ
        parts = [sentence(rng, 56) for _ in range(ends)]
        changed = [" ".join("other" if i == 28 else w for i, w in enumerate(p.split())) for p in parts]
        rows += [(2 * k + i, " ".join([prose(rng, 5), *p, prose(rng, 5)])) for i, p in enumerate((parts, changed))]
    found = {row.doc_id for row in paragraphs.repeated_passages(table(spark, rows)).collect()}
    assert not any(k % 2 == 0 for k in found) and len(found) >= 58


def test_words_over_and_over_keep_their_first_occurrence(spark):
    rows = [(1, "x " * 500), (2, "a b " * 300), (3, "before it " + "x " * 80 + "and after")]
    out = {row.doc_id: row.text.split() for row in paragraphs.without_passages(table(spark, rows)).collect()}
    assert 30 <= len(out[1]) and set(out[1]) == {"x"} and 30 <= len(out[2]) and set(out[2]) == {"a", "b"}
    assert out[3] == "before it and after".split()


def test_columns_of_any_name_are_kept(spark):
    rng = random.Random(21)
    shared = prose(rng, 14)
    names = ["_cuts", "_doc", "_text", "row", "cuts", "cut_doc", "text_id", "a.b"]
    rows = [(k, prose(rng, 9) + " " + shared, 1, *(f"{name}{k}" for name in names)) for k in (1, 2)]
    schema = "doc_id long, text string, n_chars int, " + ", ".join(f"`{name}` string" for name in names)
    docs = spark.createDataFrame(rows, schema)
    out = paragraphs.without_passages(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    got = {row[0]: row for row in out.collect()}
    assert got[1] == rows[0] and got[2][3:] == rows[1][3:]
    assert len(got[2][1].split()) < len(rows[1][1].split()) - 50 and got[2][2] == len(got[2][1])


def plain_runs_in_order(spans):
    """Runs of one text's spans (first, last, source, room), and the windows near their ends, one span after the other."""
    runs = []
    for span in spans:
        first, last, source, _ = span
        if runs and first <= runs[-1]["last"]:
            run = runs[-1]
            if source != run["at"][0]:
                run["at"] = (source, first)
        else:
            run = {"first": first, "last": last, "source": source, "at": (source, first), "best": 0, "spans": []}
            runs.append(run)
        run["last"] = max(run["last"], last)
        run["best"] = max(run["best"], run["last"] - run["at"][1])
        run["spans"].append(span)
    for run in runs:
        run["edges"] = [(a, b) for a, b, _, room in run["spans"] if room is not None and (
            a - run["first"] < paragraphs.SELECT - 1 or run["last"] - b < paragraphs.SELECT - 1)]
    return [(r["first"], r["last"], r["source"], r["best"], r["edges"]) for r in runs]


def test_runs_of_spans_equal_a_plain_loop():
    rng = random.Random(31)
    fields = "first last low high first_doc_id component first_text first_place".split()
    span = pa.struct([*((name, pa.int64()) for name in fields), ("room", pa.int32())])
    texts = []
    for _ in range(200):
        spans = set()
        for _ in range(rng.randrange(1, 40)):
            first = rng.randrange(600)
            window = rng.random() < 0.5
            spans.add((first, first + (30 if window else rng.randrange(1, 40)), rng.choice([1, 2, 3]), 21 if window else None))
        texts.append(sorted(spans, key=lambda s: (s[0], s[1], s[2], -1 if s[3] is None else s[3])))
    rows = [[dict(zip([*fields, "room"], (a, b, 2 * a, 2 * b, source, 7, 8, 9, room))) for a, b, source, room in spans]
            for spans in texts]
    batch = pa.RecordBatch.from_arrays([pa.array(range(200), pa.int64()), pa.array([0] * 200, pa.int64()),
                                        pa.array(rows, pa.list_(span))], ["doc_id", "text_id", "spans"])
    found = {k: [] for k in range(200)}
    for out in paragraphs._runs(True)(iter([batch.slice(0, 77), batch.slice(77)])):
        for row in out.to_pylist():
            assert (row["low"], row["high"]) == (2 * row["first"], 2 * row["last"])
            found[row["doc_id"]].append((row["first"], row["last"], row["first_doc_id"], row["best"],
                                         [(e["first"], e["last"]) for e in row["edges"]]))
    key = lambda s: (s[0], s[1], s[2], -1 if s[3] is None else s[3])
    assert found == {k: plain_runs_in_order(sorted(spans, key=key)) for k, spans in enumerate(texts)}


def test_marks_by_range_equal_a_plain_count():
    rng = random.Random(41)
    draw = [rng.randrange(1 << 64) for _ in range(300)] + [0, (1 << 64) - 1]
    blocks = [[(rng.choice(draw), rng.randrange(-3, 3)) for _ in range(rng.randrange(1, 200))] for _ in range(6)]
    rows = [row for block in blocks for row in paragraphs._by_range(
        np.array([m for m, _ in block], np.uint64), np.array([i for _, i in block], np.int32)).to_pylist()]
    found, want = {}, {}
    for part in {row["part"] for row in rows}:
        out = paragraphs._repeated_marks(pa.Table.from_pylist([row for row in rows if row["part"] == part]))
        assert not out.num_rows or {m % (1 << 64) >> 52 for m in out["mark"].to_pylist()} == {part}
        found.update({m % (1 << 64): (a, b) for m, a, b in zip(*(out[c].to_pylist() for c in ("mark", "a", "b")))})
    for m, i in (row for block in blocks for row in block):
        want.setdefault(m, []).append(i)
    assert found == {m: (min(i), max(i)) for m, i in want.items() if len(i) > 1}
    # of a mark over and over, no block sends more than two
    hot = paragraphs._by_range(np.full(5000, 9, np.uint64), np.arange(5000, dtype=np.int32)).to_pylist()
    assert [np.frombuffer(row["items"], np.int32).tolist() for row in hot] == [[0, 4999]]


def test_shingles_of_paragraphs_equal_those_of_each():
    rng = random.Random(42)
    texts = [prose(rng, 12) + " a b c d e f g a b c d e f g a b." for _ in range(9)] + [None, ""]
    cut = paragraphs.Cut(pa.RecordBatch.from_pydict({"text": texts}), windows=False)
    own, _, _ = cut.banded()
    flat, ends = cut.shingles_of(own)
    for k, low, high in zip(own, [0, *ends], ends):
        assert flat[low:high].tolist() == np.unique(words.shingles(cut.hashes[cut.first[k]:cut.last[k]], paragraphs.SHINGLE)).tolist()
