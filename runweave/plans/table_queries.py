"""The engine's operators on the test tables, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runweave.functions.kv import kv_list
from runweave.functions.sample_key import KeyPatterns, parse_sample_key
from runweave.functions.sequence import fraction_called, threshold_flag
from runweave.functions.text import (
    extract, joined_text, na_to_null, path_component, prefixed_int, presence_text, strip_ws,
)
from runweave.config import NA_TOKENS, PRESENCE_TEXTS
from runweave.operators.align import align_to, override_column, union_by_name
from runweave.operators.events import events, reject_events
from runweave.operators.fill import forward_fill
from runweave.operators.guards import exactly_one, singleton_groups
from runweave.operators.joins import left_join_default
from runweave.operators.pivot import first_failing_stage, membership_matrix, pivot_last_wins
from runweave.operators.topk import first_match, last_wins_map, top1_per_group
from runweave.sources.delimited import cell, delimited_rows, parse_delimited
from runweave.sources.fasta import read_fasta
from runweave.sources.sections import read_sections
from runweave.sources.task_log import process_dirs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- scalar functions --------------------------------------------------------------------------

@query("c01_distinct_names", """
    SELECT DISTINCT regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host FROM pages ORDER BY host""")
def distinct_names(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select(extract(F.col("url"), "^[a-z]+://([^/?#]+)").alias("host")).distinct().orderBy("host")


_URL_KEY = KeyPatterns(
    ("kind", "site", "lang", "number"),
    (
        r"^https?://(www)\.([a-z]+)\.example\.com/([a-z]{2})/([0-9]+)$",
        r"^https?://(blog)\.([a-z]+)\.example\.[a-z]+/([a-z]{2})/([0-9]+)$",
    ),
    r"://([a-z.]+)/([a-z]{2})/([0-9]+)$",
    (r"^(https)", r"^(http)://m\."),
)


@query("c02_key_cascade", r"""
    WITH m AS (
      SELECT page_id, url,
        '^https?://(www)\.([a-z]+)\.example\.com/([a-z]{2})/([0-9]+)$' AS p1,
        '^https?://(blog)\.([a-z]+)\.example\.[a-z]+/([a-z]{2})/([0-9]+)$' AS p2,
        '://([a-z.]+)/([a-z]{2})/([0-9]+)$' AS p3
      FROM pages)
    SELECT page_id,
      CASE WHEN regexp_matches(url, p1) THEN regexp_extract(url, p1, 1)
           WHEN regexp_matches(url, p2) THEN regexp_extract(url, p2, 1)
           ELSE coalesce(nullif(regexp_extract(url, '^(https)', 1), ''),
                         nullif(regexp_extract(url, '^(http)://m\.', 1), ''), url) END AS kind,
      CASE WHEN regexp_matches(url, p1) THEN regexp_extract(url, p1, 2)
           WHEN regexp_matches(url, p2) THEN regexp_extract(url, p2, 2)
           ELSE nullif(regexp_extract(url, p3, 1), '') END AS site,
      CASE WHEN regexp_matches(url, p1) THEN regexp_extract(url, p1, 3)
           WHEN regexp_matches(url, p2) THEN regexp_extract(url, p2, 3)
           ELSE nullif(regexp_extract(url, p3, 2), '') END AS lang,
      CASE WHEN regexp_matches(url, p1) THEN regexp_extract(url, p1, 4)
           WHEN regexp_matches(url, p2) THEN regexp_extract(url, p2, 4)
           ELSE nullif(regexp_extract(url, p3, 3), '') END AS number
    FROM m""")
def key_cascade(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", parse_sample_key(F.col("url"), _URL_KEY).alias("k")).select("page_id", "k.*")


@query("c03_path_component", """
    SELECT page_id, string_split(rtrim(url, '/'), '/')[-3] AS part FROM pages""")
def path_part(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", path_component(F.col("url"), -3).alias("part"))


@query("c04_status_text", """
    WITH calls AS (
      SELECT doc_id, 'H' || nullif(quality, 0) AS h, 'N' || nullif(toxic, 0) AS n,
             coalesce('H' || nullif(quality, 0), '') || coalesce('N' || nullif(toxic, 0), '') AS subtype
      FROM labels)
    SELECT d.doc_id, h, n, subtype,
      CASE WHEN h IS NOT NULL AND n IS NOT NULL THEN 'HA and NA subtype successful'
           WHEN n IS NOT NULL THEN 'NA subtype successful'
           WHEN h IS NOT NULL THEN 'HA subtype successful'
           ELSE 'No subtype for HA or NA' END AS status
    FROM documents d LEFT JOIN calls c ON d.doc_id = c.doc_id""")
def status_text(spark, sf_dir):
    calls = table(spark, sf_dir, "labels").select(
        "doc_id",
        prefixed_int("H", F.nullif("quality", F.lit(0)).cast("string")).alias("h"),
        prefixed_int("N", F.nullif("toxic", F.lit(0)).cast("string")).alias("n"),
    ).withColumn("subtype", joined_text(F.col("h"), F.col("n")))
    docs = table(spark, sf_dir, "documents").select("doc_id")
    joined = left_join_default(docs, calls, ["doc_id"])
    return joined.withColumn("status", presence_text(F.col("h"), F.col("n"), PRESENCE_TEXTS))


# correct rounding of the exact binary value, in whole numbers (same result as a correctly rounded print)
_COMPLETENESS_SQL = """
    SELECT doc_id, CASE WHEN len > 0 THEN
        ((s // 140737488355328) +
         CASE WHEN s % 140737488355328 > 70368744177664
                OR (s % 140737488355328 = 70368744177664 AND (s // 140737488355328) % 2 = 1)
              THEN 1 ELSE 0 END) / 100.0::DOUBLE END AS completeness
    FROM (SELECT doc_id, len, CAST(x * 140737488355328.0::DOUBLE AS BIGINT) * 100 AS s
          FROM (SELECT doc_id, length(text) AS len,
                  100.0::DOUBLE - (length(text) - length(translate(text, 'Nn', ''))) * 100.0::DOUBLE
                    / nullif(length(text), 0) AS x
                FROM documents))"""


def _completeness(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", fraction_called(F.col("text")).alias("completeness"))


@query("c06_completeness", _COMPLETENESS_SQL)
def completeness(spark, sf_dir):
    return _completeness(spark, sf_dir)


@query("c07_threshold_flag", f"""
    SELECT doc_id, CAST(coalesce(completeness > 90, false) AS INTEGER) AS tree_pass FROM ({_COMPLETENESS_SQL})""")
def completeness_flag(spark, sf_dir):
    return _completeness(spark, sf_dir).select("doc_id", threshold_flag(F.col("completeness"), 90).alias("tree_pass"))


@query("c08_range_extract", """
    SELECT page_id, nullif(regexp_extract(url, '/([a-z]{2})/([0-9]+)', 1), '') AS lang,
           TRY_CAST(nullif(regexp_extract(url, '/([a-z]{2})/([0-9]+)', 2), '') AS INTEGER) AS number
    FROM pages""")
def range_extract(spark, sf_dir):
    pattern = "/([a-z]{2})/([0-9]+)"
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", extract(url, pattern, 1).alias("lang"), extract(url, pattern, 2).try_cast("int").alias("number")
    )


@query("c09_kv_list", """
    SELECT event_id, json_extract_string(props, '$.k') AS m, 1 AS n_keys FROM events""")
def kv_columns(spark, sf_dir):
    pairs = kv_list(F.translate("props", '{}"', ""), {"k": "M"})
    return table(spark, sf_dir, "events").select("event_id", pairs.alias("pairs")).select(
        "event_id", strip_ws(F.try_element_at("pairs", F.lit("M"))).alias("m"), F.size("pairs").alias("n_keys")
    )


@query("c11_nested_lookup", """
    SELECT event_id, event_type AS section, json_extract_string(props, '$.k') AS value FROM events""")
def nested_lookup(spark, sf_dir):
    lines = F.replace(F.translate("props", '{}"', ""), F.lit(", "), F.lit("\n  "))
    texts = table(spark, sf_dir, "events").select(
        "event_id", F.concat("event_type", F.lit(":\n  "), lines, F.lit("\n")).alias("content")
    )
    return read_sections(texts).where("key = 'k'").select("event_id", "section", "value")


@query("c28_na_tokens", f"""
    WITH u AS (SELECT page_id, regexp_extract(url, 'utm_source=([^&#]*)', 1) AS s FROM pages)
    SELECT page_id, CASE WHEN s NOT IN ({", ".join(f"'{t}'" for t in NA_TOKENS)}) THEN s END AS utm_source FROM u""")
def na_tokens(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select(
        "page_id", na_to_null(F.regexp_extract("url", "utm_source=([^&#]*)", 1)).alias("utm_source")
    )


# ---- row picking -------------------------------------------------------------------------------

@query("c10_section_fill", """
    SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS)
             OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS last_user_text
    FROM conversations""")
def section_fill(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.when(F.col("role") == "user", F.col("text")).alias("user_text")
    )
    filled = forward_fill(turns, ["conv_id"], "turn", "user_text", "last_user_text")
    return filled.select("conv_id", "turn", "last_user_text")


_BEST_LINES_SQL = """
    SELECT l_orderkey, l_extendedprice, l_partkey, l_linenumber, l_suppkey FROM lineitem
    WHERE l_returnflag = 'R'
    QUALIFY row_number() OVER (PARTITION BY l_orderkey
              ORDER BY l_extendedprice DESC, l_partkey, l_linenumber, l_suppkey) = 1"""


def _best_lines(spark, sf_dir):
    returned = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(
        "l_orderkey", "l_extendedprice", "l_partkey", "l_linenumber", "l_suppkey"
    )
    return top1_per_group(returned, ["l_orderkey"], "l_extendedprice", ["l_partkey", "l_linenumber", "l_suppkey"])


@query("c12_best_row", _BEST_LINES_SQL)
def best_row(spark, sf_dir):
    return _best_lines(spark, sf_dir)


@query("c13_two_level_best", """
    WITH per_supplier AS (
      SELECT l_orderkey, l_suppkey, l_extendedprice, l_partkey, l_linenumber FROM lineitem
      QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_suppkey
                ORDER BY l_extendedprice DESC, l_partkey, l_linenumber) = 1)
    SELECT * FROM per_supplier
    QUALIFY row_number() OVER (PARTITION BY l_orderkey
              ORDER BY l_extendedprice DESC, l_suppkey, l_partkey, l_linenumber) = 1""")
def two_level_best(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_extendedprice", "l_partkey", "l_linenumber"
    )
    per_supplier = top1_per_group(
        lines, ["l_orderkey", "l_suppkey"], "l_extendedprice", ["l_partkey", "l_linenumber"]
    )
    return top1_per_group(
        per_supplier, ["l_orderkey"], "l_extendedprice", ["l_suppkey", "l_partkey", "l_linenumber"]
    )


@query("c16_singleton_groups", """
    SELECT l_orderkey AS o_orderkey, l_partkey, l_quantity FROM lineitem
    QUALIFY count(*) OVER (PARTITION BY l_orderkey) = 1""")
def singletons(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return singleton_groups(lines, ["l_orderkey"]).withColumnRenamed("l_orderkey", "o_orderkey")


@query("c17_exactly_one", """
    SELECT p_brand, p_type, p_size, CASE WHEN count(*) = 1 THEN min(p_name) END AS value,
           CASE WHEN count(*) = 1 THEN 'one' ELSE 'multiple' END AS reason, count(*) AS n
    FROM part GROUP BY p_brand, p_type, p_size""")
def only_part(spark, sf_dir):
    return exactly_one(table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_size"], "p_name")


@query("c18_last_wins_map", """
    SELECT user_id, event_type, first_seen FROM (
      SELECT user_id, event_type, min(ts) OVER (PARTITION BY user_id) AS first_seen,
             row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1""")
def last_event(spark, sf_dir):
    return last_wins_map(table(spark, sf_dir, "events"), [], "user_id", "event_type", ["ts", "event_id"])


@query("c19_first_match", """
    WITH m AS (
      SELECT lang, source, arg_max(n_chars, doc_id) AS n_chars, min(doc_id) AS first_seen
      FROM documents GROUP BY lang, source)
    SELECT lang, source, n_chars, first_seen FROM m WHERE contains(source, '1')
    QUALIFY row_number() OVER (PARTITION BY lang ORDER BY first_seen, source) = 1""")
def first_source(spark, sf_dir):
    last = last_wins_map(table(spark, sf_dir, "documents"), ["lang"], "source", "n_chars", "doc_id")
    return first_match(last, ["lang"], "source", "n_chars", "first_seen", "1")


# ---- pivots and stages -------------------------------------------------------------------------

_LINES = range(1, 8)
_LAST_LINE = "l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC"
_PIVOT_SQL = f"""
    SELECT l_orderkey, {", ".join(
        f"coalesce(max(CASE WHEN l_linenumber = {i} THEN {m} END), 0.0) AS line{i}_{m}"
        for i in _LINES for m in ("l_quantity", "l_extendedprice"))}
    FROM (SELECT * FROM lineitem
          QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LAST_LINE}) = 1)
    GROUP BY l_orderkey"""


def _line_pivot(spark, sf_dir):
    return pivot_last_wins(
        table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber", _LINES,
        ["l_quantity", "l_extendedprice"],
        ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"],
        default=0.0, name="line{}_{}".format,
    )


@query("c05_pivot_last_wins", _PIVOT_SQL)
def line_pivot(spark, sf_dir):
    return _line_pivot(spark, sf_dir)


def _stage_sql(last: int) -> str:
    cases = "\n".join(
        f"WHEN a.on{i} AND NOT coalesce(k.ok{i}, false) THEN {i + 1}" for i in range(1, last + 1)
    )
    return f"""
    WITH facts AS (
      SELECT year(o_orderdate) AS run, o_orderkey, l_linenumber
      FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
    k AS (SELECT run, o_orderkey, {", ".join(f"bool_or(l_linenumber = {i}) AS ok{i}" for i in range(1, last + 1))}
          FROM facts GROUP BY run, o_orderkey),
    a AS (SELECT run, {", ".join(f"bool_or(l_linenumber = {i}) AS on{i}" for i in range(1, last + 1))}
          FROM facts GROUP BY run)
    SELECT CAST(year(o.o_orderdate) AS INTEGER) AS run, o.o_orderkey,
      CASE WHEN k.o_orderkey IS NULL THEN 1 {cases} ELSE 0 END AS status
    FROM orders o LEFT JOIN k ON k.run = year(o.o_orderdate) AND k.o_orderkey = o.o_orderkey
    LEFT JOIN a ON a.run = year(o.o_orderdate)"""


def _order_stages(spark, sf_dir, last):
    orders = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("run"), "o_orderkey")
    seen = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    facts = orders.join(seen, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "run", "o_orderkey", F.col("l_linenumber").alias("stage"), F.lit(True).alias("passed")
    )
    listed = facts.select("run", "o_orderkey").distinct()
    codes = first_failing_stage(
        listed, facts, {i: i + 1 for i in range(1, last + 1)}, ["run", "o_orderkey"], ["run"]
    )
    return left_join_default(orders, codes, ["run", "o_orderkey"], {"status": 1})


@query("c20_first_failing_stage", _stage_sql(7))
def failing_stage(spark, sf_dir):
    return _order_stages(spark, sf_dir, 7)


@query("c21_skip_inactive_stage", _stage_sql(8))
def skip_inactive_stage(spark, sf_dir):
    return _order_stages(spark, sf_dir, 8)


_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query("c22_membership_matrix", f"""
    WITH s AS (SELECT o_custkey, {", ".join(
        f"bool_or(o_orderpriority = '{p}') AS p{i}" for i, p in enumerate(_PRIORITIES))}
      FROM orders GROUP BY o_custkey)
    SELECT c_custkey, {", ".join(
        f'CASE WHEN p{i} THEN 0 ELSE 1 END AS "status_{p}"' for i, p in enumerate(_PRIORITIES))}
    FROM customer LEFT JOIN s ON o_custkey = c_custkey""")
def priorities_ordered(spark, sf_dir):
    roster = table(spark, sf_dir, "customer").select("c_custkey")
    sheets = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority")
    return membership_matrix(roster, sheets, ["c_custkey"], "o_orderpriority", _PRIORITIES)


# ---- joins and column sets ---------------------------------------------------------------------

@query("c14_lookup_default", """
    SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'N/A' ELSE CAST(quality AS VARCHAR) END AS quality,
           CASE WHEN l.doc_id IS NULL THEN 'N/A' ELSE CAST(toxic AS VARCHAR) END AS toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def lookup_default(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").cast("string"), F.col("toxic").cast("string")
    )
    return left_join_default(docs, labels, ["doc_id"], {"quality": "N/A", "toxic": "N/A"})


@query("c15_union_drift", """
    SELECT c_custkey AS id, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
           c_mktsegment AS mktsegment FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier""")
def union_drift(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("mktsegment"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("acctbal"), F.col("s_nationkey").alias("nationkey"),
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"),
    )
    return union_by_name([customers, suppliers])


@query("c23_schema_align", """
    SELECT c_mktsegment, c_custkey, c_name, CAST(NULL AS VARCHAR) AS c_phone,
           CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer""")
def schema_align(spark, sf_dir):
    schema = T.StructType.fromDDL(
        "c_mktsegment string, c_custkey bigint, c_name string, c_phone string, c_nationkey bigint"
    )
    return align_to(table(spark, sf_dir, "customer"), schema)[0]


_SUMMARY_COLUMNS = (
    "o_orderkey bigint, run int, customer string, nation string, status string, "
    + ", ".join(f"line{i}_l_quantity double, line{i}_pass int" for i in _LINES)
    + ", best_price double, best_part bigint, orders_in_run bigint, note string"
)


@query("c24_run_summary", f"""
    WITH p AS ({_PIVOT_SQL}), b AS ({_BEST_LINES_SQL}),
    r AS (SELECT year(o_orderdate) AS run, count(*) AS orders_in_run FROM orders GROUP BY 1)
    SELECT o.o_orderkey, CAST(year(o.o_orderdate) AS INTEGER) AS run, c.c_name AS customer, n.n_name AS nation,
      CASE WHEN b.l_orderkey IS NOT NULL AND p.l_orderkey IS NOT NULL THEN 'HA and NA subtype successful'
           WHEN b.l_orderkey IS NOT NULL THEN 'NA subtype successful'
           WHEN p.l_orderkey IS NOT NULL THEN 'HA subtype successful'
           ELSE 'No subtype for HA or NA' END AS status,
      {", ".join(f"coalesce(p.line{i}_l_quantity, 0.0) AS line{i}_l_quantity, "
                 f"CAST(coalesce(p.line{i}_l_quantity > 25, false) AS INTEGER) AS line{i}_pass" for i in _LINES)},
      b.l_extendedprice AS best_price, b.l_partkey AS best_part, r.orders_in_run, CAST(NULL AS VARCHAR) AS note
    FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
    LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
    LEFT JOIN p ON p.l_orderkey = o.o_orderkey
    LEFT JOIN b ON b.l_orderkey = o.o_orderkey
    LEFT JOIN r ON r.run = year(o.o_orderdate)""")
def order_summary(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("run"), F.col("o_custkey").alias("c_custkey")
    )
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_name").alias("customer"), F.col("c_nationkey").alias("n_nationkey")
    )
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("nation"))
    lines = _line_pivot(spark, sf_dir).withColumnRenamed("l_orderkey", "o_orderkey").withColumn("found", F.lit(1))
    best = _best_lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_extendedprice").alias("best_price"), F.col("l_partkey").alias("best_part"),
    )
    per_run = orders.groupBy("run").agg(F.count(F.lit(1)).alias("orders_in_run"))
    zeros = {f"line{i}_l_quantity": 0.0 for i in _LINES}
    wide = left_join_default(orders, customers, ["c_custkey"])
    wide = left_join_default(wide, nations, ["n_nationkey"])
    wide = left_join_default(wide, lines, ["o_orderkey"], zeros)
    wide = left_join_default(wide, best, ["o_orderkey"])
    wide = left_join_default(wide, per_run, ["run"])
    wide = wide.withColumn("status", presence_text(F.col("found"), F.col("best_part"), PRESENCE_TEXTS))
    for i in _LINES:
        wide = wide.withColumn(f"line{i}_pass", threshold_flag(F.col(f"line{i}_l_quantity"), 25))
    return align_to(wide, T.StructType.fromDDL(_SUMMARY_COLUMNS))[0]


@query("c25_constants", """
    WITH s AS (SELECT s_nationkey, count(*) AS n_suppliers, max(s_acctbal) AS top_balance FROM supplier GROUP BY 1)
    SELECT c_custkey, n_suppliers, top_balance FROM customer LEFT JOIN s ON s_nationkey = c_nationkey""")
def constants(spark, sf_dir):
    per_nation = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(
        F.count(F.lit(1)).alias("n_suppliers"), F.max("s_acctbal").alias("top_balance")
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return left_join_default(customers, per_nation, ["c_nationkey"]).drop("c_nationkey")


@query("c26_events", """
    SELECT 'no_line_items' AS event_type, CAST(o_orderkey AS VARCHAR) AS key, o_orderstatus AS detail
    FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    UNION ALL
    SELECT 'no_label', CAST(doc_id AS VARCHAR), source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    UNION ALL
    SELECT 'flag_rejected', CAST(l_orderkey AS VARCHAR), l_returnflag FROM lineitem WHERE l_returnflag <> 'R'""")
def quality_events(spark, sf_dir):
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = union_by_name([
        reject_events(orders, lines.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"],
                      "no_line_items", run="o_orderstatus", sample="o_orderkey", value="o_orderstatus"),
        reject_events(docs, labels, ["doc_id"], "no_label", run="source", sample="doc_id", value="source"),
        events(lines.where("l_returnflag <> 'R'"), "flag_rejected", run="l_linestatus", sample="l_orderkey",
               value="l_returnflag"),
    ])
    return found.select(
        "event_type", F.col("sample").alias("key"), F.try_element_at("detail", F.lit("value")).alias("detail")
    )


@query("c27_fanout_join", """
    SELECT c_nationkey AS nationkey, count(*) AS n_copies
    FROM customer LEFT JOIN supplier ON s_nationkey = c_nationkey GROUP BY c_nationkey""")
def fanout(spark, sf_dir):
    left = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nationkey"))
    right = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nationkey"), "s_suppkey")
    return left_join_default(left, right, ["nationkey"], on_duplicate="fanout").select("nationkey", "n_copies")


@query("c29_override_column", """
    SELECT p_partkey, p_brand AS p_type, p_brand FROM part""")
def override(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    return override_column(parts, "p_type", "p_brand", True)


@query("c30_manifest", """
    SELECT doc_id, length(text) AS length, md5(text) AS md5 FROM documents""")
def manifest(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.length("text").cast("bigint").alias("length"), F.md5(F.col("text").cast("binary")).alias("md5")
    )


@query("c31_content_flag", """
    SELECT d.doc_id, coalesce(CAST(toxic AS VARCHAR) <> '1', false) AS passed
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def content_flag(spark, sf_dir):
    flags = table(spark, sf_dir, "labels").select("doc_id", (F.col("toxic").cast("string") != "1").alias("passed"))
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return left_join_default(docs, flags, ["doc_id"], {"passed": False})


# ---- sources on texts --------------------------------------------------------------------------

def _as_csv(*columns: str) -> str:
    """A line of quoted cells, in SQL."""
    return " || ',' || ".join(f"""'"' || replace({c}, '"', '""') || '"'""" for c in columns)


_QUOTING = """concat(text, ' say "hi", ', lang)"""
# a table in a cell: text with quotes, separators and breaks quoted; quotes inside a cell as they are
_CSV_TEXT = f"""
    'id,text,size' || chr(10) || {_as_csv("cast(doc_id as string)", _QUOTING)}
    || ',5" x' || chr(10) || chr(10) || doc_id || ',"",' || source || '"s'"""


@query("c32_delimited_shape", """
    SELECT doc_id, CASE WHEN lang = 'de' THEN 'unclosed quote' WHEN lang = 'fr' THEN 'ragged' END AS problem,
           CAST(2 AS BIGINT) AS n_columns,
           CASE WHEN lang NOT IN ('de', 'fr') THEN CAST(len(string_split(text, chr(10))) AS BIGINT) END AS n_records
    FROM documents""")
def delimited_shape(spark, sf_dir):
    # each line of a text is a quoted cell of its own record
    quoted = F.transform(F.split("text", "\n"), lambda line: F.concat(
        F.lit('"'), F.replace(line, F.lit('"'), F.lit('""')), F.lit('",x')))
    end = F.when(F.col("lang") == "de", '\n1,"open,2').when(F.col("lang") == "fr", '\n1,2,"3","4"').otherwise("")
    texts = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("line,size\n"), F.array_join(quoted, "\n"), end).alias("content"))
    return parse_delimited(texts, ",").select(
        "doc_id", "problem", F.size("header").cast("bigint").alias("n_columns"),
        F.when(F.col("problem").isNull(), F.size("records")).cast("bigint").alias("n_records"))


@query("c33_delimited_rows", """
    SELECT doc_id, CAST(0 AS BIGINT) AS pos, CAST(doc_id AS VARCHAR) AS id, text || ' say "hi", ' || lang AS text,
           '5" x' AS size FROM documents
    UNION ALL SELECT doc_id, 1, CAST(doc_id AS VARCHAR), NULL, source || '"s' FROM documents""")
def delimited_values(spark, sf_dir):
    texts = table(spark, sf_dir, "documents").select("doc_id", F.expr(_CSV_TEXT).alias("content"))
    rows = delimited_rows(parse_delimited(texts, ","))
    return rows.select("doc_id", "pos", *(cell(name).alias(name) for name in ("id", "text", "size")))


@query("c34_fasta_records", """
    WITH t AS (SELECT doc_id, string_split(chr(10) || replace(text, '. ', chr(10) || '>'), chr(10) || '>')[2:] AS recs
               FROM documents),
    r AS (SELECT doc_id, generate_subscripts(recs, 1) - 1 AS pos, unnest(recs) AS rec FROM t)
    SELECT doc_id, CAST(pos AS BIGINT) AS pos,
           regexp_extract(split_part(rec, chr(10), 1), '^[ \\t]*([^ \\t]*)', 1) AS id,
           translate(substr(rec, length(split_part(rec, chr(10), 1)) + 1), chr(10) || chr(13) || ' ', '') AS seq
    FROM r""")
def fasta_records(spark, sf_dir):
    content = F.replace("text", F.lit(". "), F.lit("\n>"))
    return read_fasta(table(spark, sf_dir, "documents").select("doc_id", content.alias("content")))


@query("c35_task_log", """
    SELECT o_orderstatus AS run, 'log' AS path, o_orderpriority AS process,
           '/w/' || arg_max(o_custkey, o_orderkey) AS workdir, min(o_orderkey) AS first_seen
    FROM orders GROUP BY o_orderstatus, o_orderpriority""")
def task_log(spark, sf_dir):
    line = F.concat(
        F.lit("Task completed > TaskHandler[id: "), "o_orderkey", F.lit("; name: "), "o_orderpriority",
        F.lit("; status: COMPLETED; workDir: /w/"), "o_custkey", F.lit(" exit: 0]"),
    )
    lines = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("run"), F.lit("log").alias("path"), F.col("o_orderkey").alias("pos"),
        line.alias("content"),
    )
    return process_dirs(lines)
