"""Runs with sheets, logs and clade files of several records, derived from the test tables.

Every customer is a run and their orders are the samples: start sheets and output sheets list them, a task log has a line
for each, and the line items of an order are the records of one clade file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runweave.config import STAGE_CODES, JobConfig
from runweave.plans import clades, status
from runweave.plans.table_queries import query, table
from runweave.plans.table_runs import _entries, _text, _texts
from runweave.sources.content import spread
from runweave.sources.tables import RunTables, union_all
from runweave.sources.task_log import dataset_files

_STAGES = [s for s in STAGE_CODES if s != "mixture"]
_PIPELINES = ("pF", "pO", "pP")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
        _text("/data/C", F.col("o_custkey"), "/out/analysis").alias("run"), _text("S", F.col("o_orderkey")).alias("sample"))
    return spread(orders, "o_orderkey")


def _lines_of(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, lines): `line` of all rows of a key as one text, in order of `at`."""
    listed = F.array_sort(F.collect_list(F.struct("at", "line")))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(listed, lambda x: x["line"]), "\n").alias("lines"))


def customer_runs(spark: SparkSession, sf_dir: str) -> RunTables:
    """Of the customers, every seventh has no start sheet and some have two; logs are there once, twice or not at all."""
    orders = _orders(spark, sf_dir)
    run, sample, customer = F.col("run"), F.col("sample"), F.col("o_custkey")
    runs = orders.select("run", "o_custkey").distinct()
    sheets = F.when(customer % 7 == 0, F.array().cast("array<string>")).when(
        customer % 6 == 1, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a")))
    sheet_name = F.concat("sheet", F.lit("_start_samplesheet.csv"))
    logs = F.when(customer % 4 == 0, F.array().cast("array<string>")).when(
        customer % 4 == 2, F.array(F.lit("1"), F.lit("2"))).otherwise(F.array(F.lit("1")))
    log_name = F.concat("log", F.lit(".nextflow.log"))

    lines = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    stage = F.element_at(F.array(*map(F.lit, _STAGES)), F.col("l_linenumber"))
    in_folder = stage.isin("reference", "minimap2", "freebayes")
    ending = F.when(in_folder, "").when(stage == "irma", ".irma.consensus.fasta").when(
        stage == "bcftools", ".consensus.fasta").otherwise(".blastn.txt")
    listing = union_all([
        _entries(orders.where("o_orderkey % 5 <> 0"), F.lit("fastq"), F.lit("fastq"), _text(sample, ".merged.fastq.gz"), F.lit(False)),
        _entries(lines.select("run", "sample", "l_linenumber").distinct(), stage, stage, F.concat(sample, ending), in_folder),
        _entries(runs.select("run", F.explode(sheets).alias("sheet")), F.lit("start_sheet"), F.lit("samplesheets"), sheet_name, F.lit(False)),
        _entries(runs.select("run", F.explode(logs).alias("log")), F.lit("task_log"), F.lit("logs"), log_name, F.lit(False)),
    ])

    listed = orders.select("run", "o_custkey", "o_orderstatus", F.col("o_orderkey").alias("at"), _text(sample, ",1").alias("line"))
    started = _lines_of(listed, "run", "o_custkey").select("run", "lines", F.explode(sheets).alias("sheet"))
    finished = orders.select(
        "run", F.col("o_orderkey").alias("pos"), F.explode(logs).alias("log"),
        _text("Task completed > TaskHandler[id: 1; name: N:AGG_NEXTCLADE_TSV (", F.col("o_orderkey") % 3,
              "); status: COMPLETED; workDir: /w/", F.col("o_orderkey"), " x]").alias("line"))
    logged = finished.select(
        "run", F.lit("task_log").alias("source"), _text(run, "/logs/", log_name).alias("path"), F.lit("logs").alias("folder"),
        log_name.alias("name"), F.col("pos").cast("bigint").alias("pos"), F.col("line").alias("content"),
        F.lit(None).cast("string").alias("problem"))
    texts = union_all([
        _texts(started, "start_sheet", F.lit("samplesheets"), sheet_name, _text("ID,x\n", F.col("lines"), "\n")),
        _texts(_lines_of(listed, "run", "o_orderstatus"), "output_sheet", F.lit("samplesheets"),
               _text("X_p", F.col("o_orderstatus"), "_output_samplesheet.csv"), _text("ID,x\n", F.col("lines"), "\n")),
        _texts(orders, "mixture", sample, _text(sample, "_mixtures.txt"), F.when(F.col("o_orderpriority") == "5-LOW", "1").otherwise("0")),
        _texts(runs, "dataset_versions", F.lit("nextclade"), F.lit("nextclade-dataset-versions.csv"), F.lit("x,pub,1,RF.nextclade.tsv\n")),
        _texts(runs.where("o_custkey % 2 = 1"), "linked_datasets", F.lit("w"), F.lit("nextclade-tsv-outputs.csv"),
               _text("x,flu_RF,", customer, ",RF.nextclade.tsv\n,,,\n")),
        logged,
    ])
    return RunTables(runs.select("run", F.lit(True).alias("present")), listing, texts)


def clade_runs(spark: SparkSession, sf_dir: str) -> RunTables:
    """The line items of an order as the records of one clade file; quantities are scores, so there are ties."""
    orders = _orders(spark, sf_dir).select("o_orderkey", "run", "sample")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    lines = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "run", "sample", F.struct("l_linenumber", "l_partkey", "l_suppkey", cents.alias("cents")).alias("at"),
        _text(F.col("sample"), "_s_", F.when(F.col("l_returnflag") == "R", "HA").otherwise("NA"), "\tc", F.col("l_linenumber"),
              "\t", F.col("l_quantity").cast("bigint"), "\t", F.col("l_partkey")).alias("line"))
    texts = _texts(_lines_of(lines, "run", "sample"), "clades", F.col("sample"), F.lit("RF.nextclade.tsv"),
                   _text("seqName\tclade\talignmentScore\tpart\n", F.col("lines"), "\n"))
    nothing = spark.createDataFrame([], "run string, source string, path string, folder string, name string, "
                                    "is_dir boolean, length bigint")
    return RunTables(orders.select("run").distinct().withColumn("present", F.lit(True)), nothing, texts)


# ---- SQL pieces --------------------------------------------------------------------------------

_O = """(SELECT *, '/data/C' || o_custkey || '/out/analysis' AS run, 'S' || o_orderkey AS sample FROM orders)"""
_ONE_SHEET = "o_custkey % 7 <> 0 AND o_custkey % 6 <> 1"
_AUTO_STATUS = f"""
    WITH own AS (SELECT l_orderkey, {", ".join(f"bool_or(l_linenumber = {i}) AS ok{i}" for i in range(1, 8))}
                 FROM lineitem GROUP BY l_orderkey),
    there AS (SELECT run, {", ".join(f"bool_or(o_orderstatus = '{p[1]}') AS has_{p}" for p in _PIPELINES)},
                     {", ".join(f"bool_or(coalesce(ok{i}, false)) AS on{i}" for i in range(1, 8))}
              FROM {_O} LEFT JOIN own ON l_orderkey = o_orderkey GROUP BY run)
    SELECT o.run, sample, {", ".join(
        f"CASE WHEN o_orderstatus = '{p[1]}' THEN 0 WHEN has_{p} THEN 1 END AS status_{p}" for p in _PIPELINES)},
        CASE WHEN o_orderkey % 5 = 0 THEN 1 {" ".join(
            f"WHEN on{i} AND NOT coalesce(ok{i}, false) THEN {i + 1}" for i in range(1, 8))}
             WHEN o_orderpriority = '5-LOW' THEN 9 ELSE 0 END AS "status_nf-flu"
    FROM {_O} o JOIN there ON there.run = o.run LEFT JOIN own ON l_orderkey = o_orderkey WHERE {_ONE_SHEET}"""
_BEST_RECORDS = f"""SELECT o.run, sample, l_linenumber, CAST(l_quantity AS BIGINT) AS score, l_partkey
    FROM lineitem JOIN {_O} o ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'
    QUALIFY row_number() OVER (PARTITION BY sample ORDER BY CAST(l_quantity AS BIGINT) DESC, l_linenumber, l_partkey,
              l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT)) = 1"""


# ---- queries -----------------------------------------------------------------------------------

@query("f15_auto_status", _AUTO_STATUS)
def auto_status_query(spark, sf_dir):
    return status.pipeline_status(customer_runs(spark, sf_dir), _PIPELINES).rows


@query("f16_dataset_versions", f"""
    SELECT DISTINCT run, CAST(0 AS BIGINT) AS pos, 'x' AS sample_name,
           CASE WHEN o_custkey % 2 = 1 THEN 'flu_RF' ELSE 'pub' END AS nextclade_dataset_name,
           CASE WHEN o_custkey % 2 = 1 THEN CAST(o_custkey AS VARCHAR) ELSE '1' END AS nextclade_dataset_version,
           'RF.nextclade.tsv' AS nextclade_filename FROM {_O}""")
def dataset_versions_query(spark, sf_dir):
    return clades.dataset_versions(customer_runs(spark, sf_dir)).rows


@query("f17_dataset_files", f"""
    WITH p AS (SELECT run, o_orderkey % 3 AS process, min(o_orderkey) AS first_seen, max(o_orderkey) AS workdir
               FROM {_O} WHERE o_custkey % 2 = 1 GROUP BY ALL)
    SELECT run, '/w/' || arg_min(workdir, first_seen) || '/nextclade-tsv-outputs.csv' AS path FROM p GROUP BY run""")
def dataset_files_query(spark, sf_dir):
    tables = customer_runs(spark, sf_dir)
    return dataset_files(tables.read("task_log"), tables.files("task_log")).select("run", "path")


@query("f18_best_records", f"""
    SELECT run, sample, 'HA' AS segment, 'c' || l_linenumber AS clade, 'N/A' AS dataset,
           CAST(l_partkey AS VARCHAR) AS part FROM ({_BEST_RECORDS})""")
def best_records_query(spark, sf_dir):
    best = clades.best_clades(clade_runs(spark, sf_dir), JobConfig()).rows
    return best.select("run", "sample", "segment", "clade", "dataset", F.try_element_at("cells", F.lit("part")).alias("part"))


@query("f19_wide_clades", f"""
    SELECT run, run || '/clades/' || sample || '/RF.nextclade.tsv' AS path, sample, sample || '_s_HA' AS "seqName",
           'HA' AS segment, 'N/A' AS dataset, 'c' || l_linenumber AS clade, CAST(score AS VARCHAR) AS "alignmentScore",
           CAST(l_partkey AS VARCHAR) AS part, 'N/A' AS nextclade_dataset_name, 'N/A' AS nextclade_dataset_version
    FROM ({_BEST_RECORDS})""")
def wide_clades_query(spark, sf_dir):
    tables = clade_runs(spark, sf_dir)
    return clades.wide_clades(tables, JobConfig(), clades.best_clades(tables, JobConfig()).rows)
