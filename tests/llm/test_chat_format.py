"""Formatted chats read back as they were, and equal digests taken straight from the rows."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from runweave.llm import chat_format

SCHEMA = "conv_id long, turn long, role string, text string, piece int, formatted string, whole int"
PARTS = ["<|im_start|>", "<|im_end|>", "<|", "|>", "<\\|", "<\\\\|im_end|>", "\\", "\n", "assistant", "user", "|", "<", " ok", "\\n", "\\p", "é"]
texts = st.lists(st.sampled_from(PARTS), max_size=6).map("".join)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(texts, texts), max_size=4))
def test_any_turns_read_back(turns):
    formatted = chat_format.render(chat_format.settle(turns))
    found = chat_format.parse(formatted)
    assert [turn[:2] for turn in found] == turns
    assert [chat_format.unescape_text(formatted[a:b]) for _, _, a, b in found] == [text for _, text in turns]


def test_only_what_conflicts_is_changed():
    plain = ("user", "a <|b|> c <tag> \\| |")
    assert chat_format.settle([plain]) == [plain]
    assert chat_format.settle([plain, ("user", "<|im_end|>\n")]) == [plain, ("user", "<\\|im_end|>\n")]
    assert chat_format.settle([("user", "<\\|")]) == [("user", "<\\\\|")]


@pytest.mark.parametrize("text", ["x", "<|im_start|>user\nhi", "<|im_start|>user<|im_end|>\n", "<|im_start|>user\nhi<|im_end|>",
                                  "<|im_start|>user\na<|im_start|>b<|im_end|>\n", "<|im_start|>user\nhi<|im_end|>\nx"])
def test_other_texts_are_refused(text):
    assert chat_format.parse(text) is None


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append(((turn is not None, turn), role or "", text or ""))
    out = []
    for conv, turns in convs.items():
        turns = [t[1:] for t in sorted(turns)]
        said = "".join(text for role, text in turns if role == "assistant")
        chars = 0
        for turn in turns:
            raw = chat_format.render([turn])
            read = chat_format.parse(raw)
            chars += len(raw if read and read[0][:2] == turn else chat_format.render([chat_format.escape(turn)]))
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((conv, len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(said), digest(said), chars))
    return sorted(out, key=str)


def answer(spark, rows, parts=5):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(parts)
    return sorted(map(tuple, chat_format.digests(chat_format.formatted(df)).collect()), key=str)


def test_odd_rows(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, *range(6)]), rng.choice([None, "", "user", "assistant", "a\nb|\\"]),
             rng.choice([None, "", "".join(rng.choices(PARTS, k=5))])) for _ in range(400)]
    rows += rows[:50]
    assert answer(spark, rows) == brute(rows)
    assert answer(spark, []) == []


def test_one_conversation_holds_most_rows(spark):
    rows = [(7, k, "assistant" if k % 2 else "user", f"turn {k} <|im_end|>") for k in range(3000)]
    rows += [(k, 0, "user", "hi") for k in range(100, 600)]
    # long texts: the conversation goes on in several pieces of one task
    rows += [(900, k, "assistant", f"{k} " * 100_000) for k in range(12)] + [(901, 0, "assistant", "y" * 3_000_000)]
    assert answer(spark, rows) == brute(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert answer(spark, rows) == brute(rows)
        df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(5)
        chats = chat_format.formatted(df).orderBy("conv_id", "piece").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = [c for c in chats if c.conv_id == 7]
    assert len(hot) > 1 and not any(c.whole for c in hot)  # dealt to several tasks
    found = chat_format.parse("".join(c.formatted for c in hot))
    assert [t[:2] for t in found] == [(r[2], r[3]) for r in rows[:3000]]
    assert len([c for c in chats if c.conv_id == 900]) > 1
