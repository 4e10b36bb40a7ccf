import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from runweave.llm import packing, sequences
from runweave.llm.encoding import Encoder, vocabulary
from runweave.llm.store import Workspace

ODD = ["a  b", "\n\n a\r\n b ", "  lead", "trail  ", "don't I'll 's x's", "a\tb\t\tc", "é b", "x y z", "<|endoftext|> a",
       "日本語 テスト", "a\x1cb", "1234 12.5", "ΑΣ Σας", "é ́x", "a​b", "İstanbul.", "", " ", "\n", "foo.bar,baz!! a.b",
       "word,", "Wörd; ß. ÀÉ! x²: ½.", "x" * 300 + "."]


@pytest.mark.parametrize("name, keeps_space", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_ids_are_those_of_the_library(name, keeps_space):
    plain = Tokenizer.from_file(vocabulary(name))
    plain.encode_special_tokens = True
    encode = Encoder(vocabulary(name), keeps_space)
    want = [np.array(x.ids, "<u4").tobytes() for x in plain.encode_batch(ODD, add_special_tokens=False)]
    assert encode(ODD) == want and encode(ODD) == want


def test_new_words_are_encoded_together():
    name = vocabulary("word_bpe_49k.json")
    plain, encode, calls = Tokenizer.from_file(name), Encoder(name, False), []
    encode.tokenizer = type("Counted", (), {"encode_batch_fast": lambda _, texts, **k: calls.extend(texts) or plain.encode_batch_fast(texts, **k)})()
    texts = [" ".join(f"w{chr(97 + k % 26)}x{chr(97 + k // 26)}, ~" for k in range(300)), "~ a~b ~~ wax, ~", "", " \n", "~"]
    assert encode(texts) == [np.array(x.ids, "<u4").tobytes() for x in plain.encode_batch(texts, add_special_tokens=False)]
    assert len(calls) < 30  # some 300 different words


def rows_of(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, n string")


def expected(texts, name):
    plain = Tokenizer.from_file(vocabulary(name))
    plain.encode_special_tokens = True
    return [(i, plain.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in texts]


TEXTS = [(3, "some words here. " * 900), (1, None), (2, ""), (9, " \n"), (7, "a b c"), (7, "a b c"), (None, "null id"),
         (4, "z " * 3000), (5, "tail"), *[(k, "more text " * k) for k in range(20, 60)]]


def test_files_round_trip(spark):
    docs = rows_of(spark, TEXTS)
    path = vocabulary("word_bpe_49k.json")
    folder = Workspace(spark, "test").path("shards")
    shards = sequences.write_sequences(docs, folder, path, length=64)
    want, start = [], 0
    for doc_id, ids in sorted(expected(TEXTS, "word_bpe_49k.json"), key=lambda x: (x[0] is not None, x[0] or 0)):
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted((tuple(row) for row in sequences.read_documents(shards, folder).collect()), key=lambda x: x[1])
    assert got == want
    for row in shards.collect():
        shard = sequences.Shard(folder, row.shard)
        total = sum(batch.num_rows for batch in shard.batches)
        ids, mask = shard.sequence(total - 1)
        assert len(ids) == 64 and not ids.flags.owndata  # a view of the file
        assert (total - 1) * 64 + pa.compute.sum(mask).as_py() == row.tokens
    assert sequences.round_trip(rows_of(spark, []), path).collect() == []


def test_every_document_is_packed_once(spark):
    got = packing.pack(rows_of(spark, TEXTS), vocabulary("byte_bpe_50k.json")).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.piece) for r in got) == sorted(
        (i is None, i or 0, k) for i, ids in expected(TEXTS, "byte_bpe_50k.json") for k in range(-(-len(ids) // 1024)))
    by = {}
    for row in got:
        by.setdefault(row.sequence_id, []).append(row)
    for rows in by.values():
        at = 0
        for row in sorted(rows, key=lambda r: r.offset):
            assert row.offset == at
            at += row.length
        assert at <= 1024
    long = dict(expected(TEXTS[:1], "byte_bpe_50k.json"))[3]
    for row in (r for r in got if r.doc_id == 3):
        assert row.ids_crc32 == zlib.crc32(np.array(long[row.start:row.start + row.length], "<u4").tobytes())
        assert row.length == 1024 or row.piece == 0
    assert packing.pack(rows_of(spark, []), vocabulary("byte_bpe_50k.json")).collect() == []


def test_sum_of_squares_rule():
    # gaps 6 and 4 are open; 4 fits both: filling the gap of 4 leaves squares 1, the gap of 6 leaves 1 + 1
    assert packing.sum_of_squares([4, 6, 4], 10)[2] == 2
    assert packing.sum_of_squares([], 10) == ([], [], 0)
    assert packing.sum_of_squares([10, 10], 10) == ([0, 1], [0, 0], 2)


@pytest.mark.parametrize("seed", range(3))
def test_few_sequences(seed):
    sizes = sorted(np.random.default_rng(seed).integers(1, 1025, 3000).tolist(), reverse=True)
    bins, offsets, made = packing.pack_sizes(sizes, 1024)
    used = np.zeros(made, int)
    for size, at, offset in sorted(zip(sizes, bins, offsets), key=lambda x: (x[1], x[2])):
        assert offset == used[at]
        used[at] += size
    assert used.max() <= 1024 and used.min() > 0
    assert made <= 1.005 * packing.best_fit(sizes, 1024)[2] and made <= packing.sum_of_squares(sizes, 1024)[2]
