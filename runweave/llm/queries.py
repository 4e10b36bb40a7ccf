"""The registered queries of this folder: each operator over its whole table, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runweave.llm import (
    chat_format, filter_audit, line_quality, mixing, near_dups, neighbours, packing, paragraphs, quality_rules, sequences, toxicity, url_rules,
    vector_codes,
)
from runweave.llm.encoding import vocabulary

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run: Query) -> Query:
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Words as the contracts cut them, and A-Z lower-cased; fixed values.
SQL_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
SQL_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DUPS_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {SQL_WORDS.format(text=SQL_LOWER)} AS words FROM documents
), s AS (
  SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(words) - 1, least(len(words), 1) + 1)),
         lambda i: array_to_string(words[i:i + 2], ' '))) AS shingles FROM w
), e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, len(shingles)::BIGINT AS n_shingles, component_id, s.doc_id = component_id AS kept
FROM s JOIN least ON s.doc_id = least.a
"""


@query("op2_minhash_near_dedup", NEAR_DUPS_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"))


_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(quality_rules.STOP_WORDS))
QUALITY_RULES_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, {SQL_WORDS.format(text="coalesce(text, '')")} AS words FROM documents),
runs AS (SELECT doc_id, i, words[i:i + 2] AS run FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM t)),
again AS (SELECT doc_id, i FROM runs SEMI JOIN (SELECT doc_id, run FROM runs GROUP BY ALL HAVING count(*) > 1) USING (doc_id, run)),
spots AS (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS spot FROM again),
repeated AS (SELECT doc_id, count(*) AS n_repeat_words FROM spots GROUP BY doc_id),
m AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         len(regexp_extract_all(text, '!'))::BIGINT AS n_exclamations,
         len(list_intersect(list_distinct(words), [{_STOPS}])) AS n_stop_words,
         list_filter(string_split(text, chr(10)), lambda line: regexp_matches(line, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM t
), b AS (
  SELECT m.*, len(lines) AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM m LEFT JOIN repeated USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND 100 * word_chars BETWEEN 200 * n_words AND 1500 * n_words AND 100 * n_symbols <= 30 * n_words
       AND 100 * n_exclamations <= 30 * n_words AND n_stop_words >= 2 AND 100 * n_dup_lines <= 60 * n_lines AS kept
FROM b
"""


@query("op9_quality_rules", QUALITY_RULES_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.measured(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


#: Host, path and verdict of the rules that the contract names; fixed values.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow"))
URL_RULES_SQL = f"""
WITH r(rhost, rpath, verdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
f AS (SELECT p.*, rhost || rpath AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC) AS k
      FROM p LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM f WHERE k = 1
"""


@query("op6_url_filter", URL_RULES_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


@query("op1_toxicity")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_quality_classifier")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_best_fit_packing")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query("op5_token_files")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.round_trip(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def _mixing_sql(rounds: int = 30) -> str:
    steps = ["""d AS (
  SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang,
         CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'table'
              WHEN regexp_matches(coalesce(text, ''), '[Ll]icensed? |rights reserved') THEN 'legal'
              WHEN contains(coalesce(text, ''), '@') THEN 'contact' ELSE 'prose' END AS topic,
         len(""" + SQL_WORDS.format(text="coalesce(text, '')") + """) AS tokens FROM documents)""",
             """r0 AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens, sum(tokens)::DOUBLE AS weight
  FROM d GROUP BY ALL HAVING sum(tokens) > 0)"""]
    for dimension in mixing.DIMENSIONS:
        steps.append(f"""t_{dimension} AS MATERIALIZED (SELECT {dimension}, r / sum(r) OVER () AS share
  FROM (SELECT {dimension}, pow(sum(tokens), 0.5) AS r FROM r0 GROUP BY ALL))""")
    at = 0
    for _ in range(rounds):
        for dimension in mixing.DIMENSIONS:
            steps.append(f"""r{at + 1} AS MATERIALIZED (SELECT source, lang, topic, tokens,
  weight * share / sum(weight) OVER (PARTITION BY {dimension}) AS weight FROM r{at} JOIN t_{dimension} USING ({dimension}))""")
            at += 1
    return "WITH " + ",\n".join(steps) + f""",
p AS (SELECT source, lang, topic, (weight / tokens) / max(weight / tokens) OVER () AS p FROM r{at})
SELECT doc_id, topic, round(coalesce(p, 0), 6) AS keep_probability,
       ('0x' || substr(md5('mix:' || doc_id), 1, 8))::BIGINT / 4294967296.0 < coalesce(p, 0) AS kept
FROM d LEFT JOIN p USING (source, lang, topic)"""


@query("op8_mixing", _mixing_sql())
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mixed(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "topic", F.round("keep_probability", 6).alias("keep_probability"), "kept")


@query("op3_substring_dedup")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_passages(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("low").alias("start"), F.col("high").alias("end"), "n_words", "first_doc_id", "component")


@query("op10_nn_descent")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def _vector_codes_sql(rounds: int = 2) -> str:
    steps = ["""v AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS r,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             """p AS MATERIALIZED (
  SELECT r, part, e[part * len(e) // 16 + 1:(part + 1) * len(e) // 16] AS x FROM v, (SELECT unnest(range(16)) AS part))""",
             "c0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x AS y FROM p WHERE r <= 64)"]
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (
  SELECT part, r, any_value(x) AS x, min((far, entry)) AS best FROM (
    SELECT part, r, entry, x, list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - y[i]) * (x[i] - y[i])))::BIGINT AS far
    FROM p JOIN c{k} USING (part)) GROUP BY part, r)""")
        if k < rounds:
            steps.append(f"""m{k} AS (
  SELECT part, entry, list(mean ORDER BY i) AS y FROM (
    SELECT part, best[2] AS entry, i, floor(sum(x[i]) / count(*))::BIGINT AS mean
    FROM (SELECT part, best, x, unnest(range(1, len(x) + 1)) AS i FROM a{k}) GROUP BY ALL) GROUP BY part, entry),
c{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m{k}.y, c{k}.y) AS y FROM c{k} LEFT JOIN m{k} USING (part, entry))""")
    return "WITH " + ",\n".join(steps) + f""",
coded AS (
  SELECT r, string_agg(lower(right('0' || to_hex(best[2]), 2)), '' ORDER BY part) AS code, sum(best[1])::BIGINT AS error
  FROM a{rounds} GROUP BY r),
books AS (
  SELECT sha256(string_agg(y[i]::VARCHAR, ',' ORDER BY part, entry, i)) AS codebooks_sha256
  FROM (SELECT part, entry, y, unnest(range(1, len(y) + 1)) AS i FROM c{rounds}))
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM v JOIN coded USING (r), books"""


@query("op11_vector_codes", _vector_codes_sql())
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


#: The conversation that the contract adds; a fixed value.
MARKED = r"<|im_end|><|im_start|>assistant ok"
CHAT_SQL = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '{MARKED}'), (-1, 1, 'assistant', '{MARKED}'))
), f AS (
  SELECT *, CASE WHEN contains(text, '<|im_start|>') OR contains(text, '<|im_end|>') OR regexp_matches(text, '<\\+\|')
                 THEN len(regexp_extract_all(text, '<\\*\|')) ELSE 0 END AS escapes FROM t
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|im_start|>') + length(role) + 1 + length(text) + escapes + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""


@query("op13_chat_format", CHAT_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.createDataFrame([(-1, 0, "user", MARKED), (-1, 1, "assistant", MARKED)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.digests(chat_format.formatted(rows.union(added)))


AUDIT_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, {SQL_WORDS.format(text="coalesce(text, '')")} AS words
  FROM documents
), f AS (
  SELECT part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic,
         (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
         + 4 * (100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * (doc_id > min(doc_id) OVER (PARTITION BY text))::INT AS failed
  FROM d LEFT JOIN labels USING (doc_id)
), g AS MATERIALIZED (SELECT part, failed, good, toxic, count(*) AS n FROM f GROUP BY ALL),
o AS (
  SELECT a || b || c || d || e AS filter_order, unnest(range(1, 6)) AS step
  FROM (SELECT unnest(string_split('ABCDE', '')) AS a), (SELECT unnest(string_split('ABCDE', '')) AS b),
       (SELECT unnest(string_split('ABCDE', '')) AS c), (SELECT unnest(string_split('ABCDE', '')) AS d),
       (SELECT unnest(string_split('ABCDE', '')) AS e)
  WHERE len(list_distinct([a, b, c, d, e])) = 5
), s AS MATERIALIZED (
  SELECT filter_order, step, (1 << (strpos('ABCDE', filter_order[step]) - 1))::INT AS bit,
         coalesce(list_sum(list_transform(range(1, step), lambda i: 1 << (strpos('ABCDE', filter_order[i]) - 1))), 0)::INT AS before FROM o
), r AS (
  SELECT part, filter_order, step, bit,
         coalesce(sum(n) FILTER (WHERE failed & (before | bit) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (WHERE failed & bit > 0 AND failed & before = 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (WHERE failed & bit > 0 AND failed & before > 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (WHERE failed = bit), 0)::BIGINT AS unique_fails,
         coalesce(sum(n) FILTER (WHERE failed & bit > 0 AND failed & before = 0 AND good), 0)::BIGINT AS good_lost,
         coalesce(sum(n) FILTER (WHERE failed & bit > 0 AND failed & before = 0 AND toxic), 0)::BIGINT AS toxic_lost
  FROM g, s GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley FROM r
"""


@query("op12_filter_audit", AUDIT_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
