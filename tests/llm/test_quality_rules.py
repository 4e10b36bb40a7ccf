import random
import re

from runweave.llm.quality_rules import STOP_WORDS, measured


def brute(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    runs = {}
    for i in range(len(words) - 2):
        runs.setdefault(tuple(words[i:i + 3]), []).append(i)
    spots = {i + k for at in runs.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    n, dup = len(words), len(lines) - len(set(lines))
    chars, symbols = sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text))
    failed = n < 50 or 100 * len(spots) > 50 * n
    kept = (not failed and 200 * n <= 100 * chars <= 1500 * n and 100 * symbols <= 30 * n
            and 100 * text.count("!") <= 30 * n and len(set(words) & set(STOP_WORDS)) >= 2 and 100 * dup <= 60 * len(lines))
    return n, chars, symbols, dup, len(spots), failed, kept


def texts():
    rng = random.Random(11)
    out = [None, "", " ", "\n\n", "a", "a b", "a b c", "a b c a b c", "x x x x", "a b a b a b", "é\u00a0ß 漢字 🙂", "|#|", " a\tb\x0bc\x0cd\re\n"]
    for _ in range(120):
        pool = ["the", "and", "of", "die", "x$", "!!", "wörter", "a|b", "längeres", "word%d" % rng.randrange(9)] + ["w%d" % k for k in range(rng.choice([3, 40, 400]))]
        out.append("".join(rng.choice(pool) + rng.choice([" ", " ", " ", "\n", "  "]) for _ in range(rng.randrange(1, 200))))
    return out + ["one line\n" * 400, "the same of it " * 20_000, " ".join(f"w{k} the of" for k in range(30_000))]


def test_against_python(spark):
    rows = list(enumerate(texts())) + [(None, "null id"), (3, "repeated id"), (3, "repeated id")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, kept string, n_words long")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    got = [(row.doc_id, *(row[n] for n in names)) for row in measured(docs).collect()]
    assert sorted(got, key=str) == sorted(((i, *brute(t)) for i, t in rows), key=str)
    assert measured(docs.limit(0)).collect() == []


def test_plan_has_no_user_functions(spark):
    plan = measured(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
