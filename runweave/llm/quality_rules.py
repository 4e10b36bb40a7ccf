"""Quality rules: a threshold table compiled into one Spark projection, without user functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Patterns of the white space between words and of the characters that count as symbols; fixed values.
WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: Frequent words of the four languages; a text of natural prose holds some of them. Fixed values.
STOP_WORDS = ("the of and to a in is that for with as on are was this by "
              "der die und den von zu das mit sich des auf für ist im dem nicht ein eine "
              "de la le et les des un une du que en est pour qui dans par sur au avec pas "
              "el y los se del las por con no para al su").split()


@dataclass(frozen=True)
class Rule:
    """100 * part must lie between low and high per cent of whole; both name measures. None: no bound."""

    part: str
    whole: str
    low: int | None = None
    high: int | None = None

    def holds(self) -> Column:
        part, whole = 100 * F.col(self.part), F.col(self.whole)
        bounds = [part >= self.low * whole] if self.low is not None else []
        bounds += [part <= self.high * whole] if self.high is not None else []
        out = F.lit(True)
        for bound in bounds:
            out = out & bound
        return out


#: The threshold table: mean word length, symbols and exclamation marks per word, different stop words, repeated lines.
RULES = (
    Rule("word_chars", "n_words", low=200, high=1500),
    Rule("n_symbols", "n_words", high=30),
    Rule("n_exclamations", "n_words", high=30),
    Rule("n_stop_words", "one", low=200),
    Rule("n_dup_lines", "n_lines", high=60),
)


def bind(value: Column, body) -> Column:
    """body(value), with value computed once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column) -> Column:
    """How many words lie in a run of three words that the text holds twice or more, first one included."""
    hashes = F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - 3, F.lit(0))),
                         lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def starts(placed: Column) -> Column:
        # placed: (hash, position) in order, so equal runs are neighbours
        same = lambda k, j: F.get(placed, j)["h"].eqNullSafe(F.get(placed, k)["h"])
        return F.array_sort(F.array_compact(F.transform(
            placed, lambda run, k: F.when(same(k, k - 1) | same(k, k + 1), run["i"]))))

    def covered(at: Column) -> Column:
        steps = F.zip_with(at, F.slice(at, F.lit(2), F.size(at)), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    def count(runs: Column) -> Column:
        placed = F.sort_array(F.transform(runs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(runs)) == F.size(runs), F.lit(0).cast("long")).otherwise(
            bind(bind(placed, starts), covered))

    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(bind(hashes, count))


def _measures(text: Column) -> Column:
    """All measures of a text, as one struct."""
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("long")

    def of_words(words: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
        return bind(lines, lambda full: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            count(SYMBOLS).alias("n_symbols"),
            count("!").alias("n_exclamations"),
            F.size(F.array_intersect(words, F.array(*map(F.lit, dict.fromkeys(STOP_WORDS))))).cast("long").alias("n_stop_words"),
            F.size(full).cast("long").alias("n_lines"),
            (F.size(full) - F.size(F.array_distinct(full))).cast("long").alias("n_dup_lines"),
            _repeated_words(words).alias("n_repeat_words"),
            F.lit(1).cast("long").alias("one")))

    return bind(F.array_remove(F.split(text, WHITE), ""), of_words)


def measured(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`docs` with the measures of its texts, base_failed and kept added as columns (equal names are replaced).

    base_failed: fewer than 50 words, or more than half of the words in repeated runs of three words. kept: not
    base_failed and every rule of the table holds. Null and blank texts have no words, so they fail; rows are neither
    dropped nor joined, so null or repeated ids and an empty table need no care.
    """
    taken = docs.withColumn("_m", _measures(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    names = ["n_words", "word_chars", "n_symbols", "n_exclamations", "n_stop_words", "n_lines", "n_dup_lines",
             "n_repeat_words", "one"]
    taken = taken.withColumns({name: F.col("_m")[name] for name in names})
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    good = ~base
    for rule in rules:
        good = good & rule.holds()
    return taken.withColumns({"base_failed": base, "kept": good}).drop("_m", "one")
