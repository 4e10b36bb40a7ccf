"""Run tables derived from the test tables, and the run jobs on them with the SQL they must match.

Every order is a sample and every year of orders a run; its line items, priority and status are
written out as the texts a run folder would hold (one small text per order or line item), which the
jobs then parse and roll up over the whole tables. Documents serve as consensus sequences.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runweave.config import EXPECTED_COLUMNS, REPORT_SEGMENTS, SEGMENTS, STAGE_CODES, JobConfig
from runweave.operators.pivot import membership_matrix
from runweave.plans import clades, facts, manifest, mixtures, roster, run_events, status, subtype, summary, versions
from runweave.plans.table_queries import query, table
from runweave.sources.content import spread
from runweave.sources.delimited import compute_once
from runweave.sources.tables import RunTables

_STAGES = [s for s in STAGE_CODES if s != "mixture"]


def _text(*parts: str | Column) -> Column:
    """Parts joined to one text: strings are literal, columns are cast."""
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their run and sample, spread over all tasks; these texts are made of the rows after the shuffle."""
    year = F.year("o_orderdate")
    orders = spread(table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"), "o_orderkey")
    # worked out once: filters on the texts stay behind the shuffle, which all readers then share
    return compute_once(
        orders, ("o_orderdate",), year=year, month=F.month("o_orderdate"),
        run=_text("/data/R", year, "/out/analysis"),
        sample=_text(
            "R", F.lpad(F.col("o_orderkey").cast("string"), 10, "0"),
            "-", F.lpad(F.col("o_custkey").cast("string"), 4, "0"),
            "-", F.substring("o_orderpriority", 3, 1),
            "-", F.col("o_orderstatus"), F.lpad(F.month("o_orderdate").cast("string"), 2, "0"),
        ),
    )


def _texts(df: DataFrame, source: str, folder: Column, name: Column, content: Column, path: Column | None = None):
    path = _text(F.col("run"), f"/{source}/", folder, "/", name) if path is None else path
    return df.select(
        "run", F.lit(source).alias("source"), path.alias("path"), folder.alias("folder"), name.alias("name"),
        F.lit(0).cast("bigint").alias("pos"), content.alias("content"), F.lit(None).cast("string").alias("problem"),
    )


def _entries(df: DataFrame, source: Column, folder: Column, name: Column, is_dir: Column) -> DataFrame:
    return df.select(
        "run", source.alias("source"), _text(F.col("run"), "/", folder, "/", name).alias("path"),
        folder.alias("folder"), name.alias("name"), is_dir.alias("is_dir"), F.lit(0).cast("bigint").alias("length"),
    )


def order_runs(spark: SparkSession, sf_dir: str) -> RunTables:
    """Orders and line items as runs and samples.

    The rows are spread over all tasks before the texts are made of them, as read files are: their parsing is the work,
    not their bytes, which Spark would gather in a few tasks. Both tables are dealt by the order's key, so their join
    needs no further shuffle and what is rolled up by sample leaves a task as one row.
    """
    orders = _orders(spark, sf_dir)
    lines = spread(table(spark, sf_dir, "lineitem"), "l_orderkey").join(
        orders.select("o_orderkey", "run", "sample"), F.col("l_orderkey") == F.col("o_orderkey")
    ).withColumn("cents", F.round(F.col("l_extendedprice") * 100).cast("bigint"))
    sample, run, year = F.col("sample"), F.col("run"), F.col("year")
    state, priority = F.col("o_orderstatus"), F.col("o_orderpriority")

    ends = F.when(state == "F", F.array(F.lit("_1"), F.lit("_2"))).otherwise(F.array(F.lit("")))
    reads = orders.select("run", "sample", F.explode(ends).alias("mate"))
    stage = F.element_at(F.array(*map(F.lit, _STAGES)), F.col("l_linenumber"))
    folder_stage = stage.isin("reference", "minimap2", "freebayes")
    ending = (
        F.when(stage == "irma", ".irma.consensus.fasta").when(stage == "bcftools", ".consensus.fasta")
        .when(folder_stage, "").otherwise(".blastn.txt")
    )
    reached = lines.select("run", "sample", "l_linenumber").distinct()
    listing = _entries(
        reads, F.lit("fastq"), F.lit("fastq"), _text(sample, F.col("mate"), ".merged.fastq.gz"), F.lit(False)
    ).unionByName(_entries(reached, stage, stage, F.concat(sample, ending), folder_stage))

    segment = F.element_at(F.array(*map(F.lit, SEGMENTS)), F.col("l_linenumber"))
    more = F.when(F.col("l_returnflag") == "A", "x\t1\t1\t1\n").otherwise("")
    by_year = orders.select("run", "year").distinct()
    texts = [
        _texts(
            lines, "idxstats", sample,
            _text(sample, ".Segment_", F.col("l_linenumber"), "_", segment, ".", F.col("l_partkey"), ".",
                  F.col("l_suppkey"), ".", F.col("cents"), ".idxstats"),
            _text("ref\t", F.col("l_quantity").cast("bigint"), "\t", F.col("cents"), "\t0\n*\t0\t0\t1\n", more),
        ),
        _texts(
            lines, "clades", sample, _text(F.col("l_returnflag"), F.col("l_linestatus"), ".nextclade.tsv"),
            _text("seqName\tclade\talignmentScore\tlegacy-clade\n", sample, "_segment4_",
                  F.when(F.col("l_returnflag") == "R", "HA").otherwise("NA"), "\tc", F.col("l_linenumber"), "\t",
                  F.col("cents"), "\t", F.col("l_linestatus"), "\n"),
            _text(run, "/nextclade/", sample, "/", F.col("l_partkey"), ".", F.col("l_suppkey"), ".",
                  F.col("l_linenumber"), ".", F.col("cents")),
        ),
        _texts(by_year, "dataset_versions", F.lit("nextclade"), F.lit("nextclade-dataset-versions.csv"),
               _text("x,flu_RF,", year, ",RF.nextclade.tsv\n")),
        _texts(by_year, "versions", F.lit("pipeline_info"), F.lit("software_versions.yml"),
               _text("GENOFLU:\n  genoflu: 1.", year, "\nNEXTCLADE_RUN:\n  nextclade: \"3.", year,
                     "\"\nWorkflow:\n  CFIA-NCFAD/nf-flu: v", year, "\n")),
        _texts(orders, "subtype", F.lit("subtyping_report"), _text(sample, ".csv"),
               _text(",sample,Genotype,H_type,N_type\n0,", sample, ",x,",
                     F.when(state == "O", "").otherwise(_text(F.substring(priority, 1, 1), ".0")), ",",
                     F.when(state == "P", "x").otherwise(F.col("month").cast("string")), "\n")),
        _texts(orders, "bcftools", F.lit("bcftools"), _text(sample, ".consensus.fasta"),
               _text(">", sample, "_segment4_HA note\n", priority, "\nn\n>", sample, "_segment6_NA\n", state, "\n")),
        _texts(orders, "cleavage", sample, _text(sample, ".cleavage.tsv"),
               _text("Sample\tCleavage Sequence\tCleavage Site Sequence Header\n", sample, "\t",
                     F.when(state == "P", "NA").otherwise(priority), "\tx|HA|", F.col("o_custkey"), "..",
                     F.col("o_orderkey"), " site\n")),
        _texts(orders, "genotype", F.lit("genoflu"), _text(sample, ".genoflu.tsv"),
               _text("Strain\tGenotype\tGenotype List Used, >=98.0%\nx\t", state, "\t",
                     F.when(priority == "5-LOW", "HA").otherwise(
                         _text("PB2:c", F.col("o_custkey"), ", MP:", year, ", HA:", priority)), "\n")),
        _texts(orders, "mixture", sample, _text(sample, "_mixtures.txt"),
               F.when(priority == "5-LOW", "1").when(priority == "4-NOT SPECIFIED", "1\n").otherwise("0")),
        _texts(orders, "mixtures", sample, _text(sample, "_mixtures.csv"),
               F.when(state == "F", _text("sample_name,mixture_present\n", sample, ",True\n"))
               .when(state == "O", _text("sample_name,ratio\n", sample, ",0.5\n"))
               .otherwise(_text("sample_name,ratio\n", sample, ",0.5\n", sample, ",0.6\n"))),
        _texts(orders, "output_sheet", F.lit("samplesheets"), _text("X_p", state, "_output_samplesheet.csv"),
               _text("ID,x\n", sample, ",1\n"), _text(run, "/sheets/", sample)),
    ]
    runs = by_year.select("run", F.lit(True).alias("present"))
    return RunTables(runs, listing, reduce(DataFrame.unionByName, texts))


def shown_events(found: DataFrame) -> DataFrame:
    """Events with their details as one text, key=value in order of the keys."""
    pairs = F.transform(F.map_entries("detail"), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))))
    return found.select("run", "sample", "event_type", F.array_join(F.array_sort(pairs), ";").alias("detail"))


def document_runs(spark: SparkSession, sf_dir: str) -> RunTables:
    """Documents as consensus files of one run per source."""
    docs = table(spark, sf_dir, "documents").select(
        _text("/data/", F.col("source"), "/out/analysis").alias("run"),
        _text("D", F.col("doc_id")).alias("sample"), "text", "lang", "source",
        F.element_at(F.array(*map(F.lit, SEGMENTS)), (F.pmod("doc_id", F.lit(len(SEGMENTS))) + 1).cast("int")).alias("segment"),
    )
    docs, sample = spread(docs, "sample"), F.col("sample")
    texts = _texts(
        docs, "bcftools", F.lit("bcftools"), _text(sample, ".consensus.fasta"),
        _text(">", sample, "_segment4_HA note\n", F.col("text"), "\n>", sample, "_x_", F.upper("lang"), "\n",
              F.col("lang"), "\n>", sample, "_", F.col("segment"), "\n", F.col("lang"), "N", F.col("source"), "\n"),
    )
    runs = docs.select("run").distinct().withColumn("present", F.lit(True))
    nothing = spark.createDataFrame([], "run string, source string, path string, folder string, name string, "
                                    "is_dir boolean, length bigint")
    return RunTables(runs, nothing, texts)


# ---- SQL pieces --------------------------------------------------------------------------------

_O = """(SELECT o_orderkey, o_custkey, o_orderstatus AS state, o_orderpriority AS priority,
      year(o_orderdate) AS year, month(o_orderdate) AS month,
      '/data/R' || year(o_orderdate) || '/out/analysis' AS run,
      'R' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || '-' || lpad(CAST(o_custkey AS VARCHAR), 4, '0') || '-'
        || substr(o_orderpriority, 3, 1) || '-' || o_orderstatus
        || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS sample
      FROM orders)"""
_L = f"""(SELECT l.*, o.run, o.sample, o.year, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents
      FROM lineitem l JOIN {_O} o ON l_orderkey = o_orderkey)"""

_ROSTER = f"""SELECT sample AS FastQID, 'R' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS CID,
      lpad(CAST(o_custkey AS VARCHAR), 4, '0') AS Plate, substr(priority, 3, 1) AS "Index",
      state || lpad(CAST(month AS VARCHAR), 2, '0') AS Well, 'R' || year AS Run FROM {_O}"""

_READS = f"""SELECT sample, {", ".join(
        f"coalesce(max(CASE WHEN l_linenumber = {i} THEN cents END), 0) AS {s}_reads_mapped, "
        f"coalesce(max(CASE WHEN l_linenumber = {i} THEN CAST(l_quantity AS BIGINT) END), 0) AS {s}_seq_length"
        for i, s in enumerate(SEGMENTS, 1))}
    FROM (SELECT * FROM {_L} WHERE l_returnflag <> 'A'
          QUALIFY row_number() OVER (PARTITION BY sample, l_linenumber
                    ORDER BY l_partkey || '.' || l_suppkey || '.' || cents || '.idxstats' DESC) = 1)
    GROUP BY sample"""


def _percent(seq: str) -> str:
    scaled = (f"CAST((100.0::DOUBLE - (length({seq}) - length(translate({seq}, 'Nn', ''))) * 100.0::DOUBLE "
              f"/ nullif(length({seq}), 0)) * 140737488355328.0::DOUBLE AS BIGINT) * 100")
    return f"""coalesce((({scaled}) // 140737488355328
      + CASE WHEN ({scaled}) % 140737488355328 > 70368744177664
               OR (({scaled}) % 140737488355328 = 70368744177664 AND (({scaled}) // 140737488355328) % 2 = 1)
             THEN 1 ELSE 0 END) / 100.0::DOUBLE, 0.0)"""


_CLEAVAGE = f"""SELECT sample, CAST(o_custkey AS INTEGER) AS HPAI_cleave_start,
      CAST(o_orderkey AS INTEGER) AS HPAI_cleave_end,
      CASE WHEN state <> 'P' THEN priority END AS HPAI_cleavage_site_motif FROM {_O}"""
_GENOTYPE = f"""SELECT sample, state AS GenoFLU_Genotype, {", ".join(
        f"CASE WHEN priority <> '5-LOW' THEN {value} END AS GenoFLU_{s}"
        for s, value in {**dict.fromkeys(SEGMENTS, "CAST(NULL AS VARCHAR)"), "PB2": "'c' || o_custkey",
                         "M": "CAST(year AS VARCHAR)", "HA": "priority"}.items())}
    FROM {_O}"""
_SUBTYPE = f"""SELECT sample, h AS HA_subtype, n AS NA_subtype, coalesce(h, '') || coalesce(n, '') AS subtype
    FROM (SELECT sample, CASE WHEN state <> 'O' THEN 'H' || substr(priority, 1, 1) END AS h,
                 CASE WHEN state <> 'P' THEN 'N' || month END AS n FROM {_O})"""
_CLADES = f"""SELECT sample, 'HA' AS segment, 'c' || l_linenumber AS clade, l_linestatus AS legacy_clade,
      CASE WHEN l_linestatus = 'F' THEN 'flu_RF' ELSE 'N/A' END AS dataset,
      CASE WHEN l_linestatus = 'F' THEN CAST(year AS VARCHAR) ELSE 'N/A' END AS version
    FROM {_L} WHERE l_returnflag = 'R'
    QUALIFY row_number() OVER (PARTITION BY sample ORDER BY cents DESC,
              l_partkey || '.' || l_suppkey || '.' || l_linenumber || '.' || cents) = 1"""
_STATUS = f"""SELECT o.run, o.sample, CASE {" ".join(
        f"WHEN a.on{i} AND NOT coalesce(k.ok{i}, false) THEN {i + 1}" for i in range(1, 8))}
      WHEN priority = '5-LOW' THEN 9 ELSE 0 END AS "status_nf-flu"
    FROM {_O} o
    LEFT JOIN (SELECT sample, {", ".join(f"bool_or(l_linenumber = {i}) AS ok{i}" for i in range(1, 8))}
               FROM {_L} GROUP BY sample) k ON k.sample = o.sample
    LEFT JOIN (SELECT run, {", ".join(f"bool_or(l_linenumber = {i}) AS on{i}" for i in range(1, 8))}
               FROM {_L} GROUP BY run) a ON a.run = o.run"""


# ---- queries -----------------------------------------------------------------------------------

@query("f01_roster", _ROSTER)
def roster_query(spark, sf_dir):
    rows = roster.roster(order_runs(spark, sf_dir), JobConfig()).rows
    return rows.select("FastQID", "CID", "Plate", "Index", "Well", F.col("Run_").alias("Run"))


@query("f02_mapped_reads", _READS)
def mapped_reads_query(spark, sf_dir):
    return facts.mapped_reads(order_runs(spark, sf_dir)).rows.drop("run")


_CALLED = {s: f"""CASE WHEN doc_id % {len(SEGMENTS)} = {i} THEN {_percent("short")}
        {f"ELSE {_percent('seq')}" if s == "HA" else "ELSE 0.0"} END""" for i, s in enumerate(SEGMENTS)}


@query("f03_consensus_completeness", f"""
    SELECT sample, {", ".join(f"{s} AS {s}_consensus_completeness, CAST({s} > 90 AS INTEGER) AS {s}_tree_pass" for s in SEGMENTS)}
    FROM (SELECT 'D' || doc_id AS sample, {", ".join(f"{sql} AS {s}" for s, sql in _CALLED.items())}
          FROM (SELECT doc_id, lang || 'N' || source AS short,
                       translate(text, chr(10) || chr(13) || ' ', '') AS seq FROM documents))""")
def completeness_query(spark, sf_dir):
    rows = facts.completeness(document_runs(spark, sf_dir)).rows.withColumns(facts.tree_pass())
    return rows.select("sample", *(f"{s}_{m}" for s in SEGMENTS for m in ("consensus_completeness", "tree_pass")))


@query("f04_cleavage_sites", _CLEAVAGE)
def cleavage_query(spark, sf_dir):
    return facts.cleavage_sites(order_runs(spark, sf_dir)).rows.drop("run")


@query("f05_genotypes", _GENOTYPE)
def genotype_query(spark, sf_dir):
    return facts.genotypes(order_runs(spark, sf_dir)).rows.drop("run")


@query("f06_subtypes", _SUBTYPE)
def subtype_query(spark, sf_dir):
    return subtype.subtypes(order_runs(spark, sf_dir)).rows.drop("run")


@query("f07_best_clades", _CLADES)
def clade_query(spark, sf_dir):
    best = clades.best_clades(order_runs(spark, sf_dir), JobConfig()).rows
    return best.select(
        "sample", "segment", "clade", F.try_element_at("cells", F.lit("legacy-clade")).alias("legacy_clade"),
        "dataset", F.col("nextclade_dataset_version").alias("version"),
    )


@query("f08_software_versions", f"""
    SELECT DISTINCT run, '3.' || year AS nextclade_version, '1.' || year AS genoflu_version,
           'v' || year AS nfflu_version FROM {_O}""")
def versions_query(spark, sf_dir):
    return versions.software_versions(order_runs(spark, sf_dir)).rows


@query("f09_file_status", _STATUS)
def file_status_query(spark, sf_dir):
    tables = order_runs(spark, sf_dir)
    return status.file_status(tables, roster.fastq_samples(tables)).rows


@query("f10_pipeline_sheets", f"""
    SELECT o.run, sample, {", ".join(
        f"CASE WHEN state = '{s}' THEN 0 WHEN r.has_{s} THEN 1 END AS status_p{s}" for s in "FOP")}
    FROM {_O} o JOIN (SELECT run, {", ".join(f"bool_or(state = '{s}') AS has_{s}" for s in "FOP")}
                      FROM {_O} GROUP BY run) r ON r.run = o.run""")
def pipeline_sheets_query(spark, sf_dir):
    tables = order_runs(spark, sf_dir)
    sheets = status.pipeline_sheets(tables).rows
    return membership_matrix(
        roster.fastq_samples(tables), sheets, ["run", "sample"], "pipeline", status.pipeline_names(sheets), ["run"]
    )


@query("f11_mixture_report", f"""
    SELECT run, sample AS FastQID, CASE WHEN state = 'F' THEN 'True' END AS mixture_present,
           CASE WHEN state = 'O' THEN '0.5' END AS ratio FROM {_O} WHERE state <> 'P'""")
def mixture_query(spark, sf_dir):
    return mixtures.wide_mixtures(order_runs(spark, sf_dir)).drop("path")


def _summary_sql() -> str:
    called = {"HA": _percent("priority_seq"), "NA": "100.0::DOUBLE"}

    def column(name: str) -> str:
        part = name.split("_", 1)[-1]
        if name in ("FastQID", "CID", "Plate", "Index", "Well", "Run"):
            return f'r."{name}"'
        if name == "subtype_HA_NA_status":
            return """CASE WHEN HA_subtype IS NOT NULL AND NA_subtype IS NOT NULL THEN 'HA and NA subtype successful'
                WHEN NA_subtype IS NOT NULL THEN 'NA subtype successful'
                WHEN HA_subtype IS NOT NULL THEN 'HA subtype successful' ELSE 'No subtype for HA or NA' END"""
        if part in ("reads_mapped", "seq_length"):
            return f"coalesce({name}, 0)"
        if part == "consensus_completeness":
            return called.get(name.split("_")[0], "0.0::DOUBLE")
        if part == "tree_pass":
            return f"CAST({called.get(name.split('_')[0], '0.0::DOUBLE')} > 90 AS INTEGER)"
        return {
            "Nextclade_clade": "clade", "Nextclade_legacy_clade": "legacy_clade",
            "Nextclade_subclade": "CAST(NULL AS VARCHAR)", "Nextclade_qc.overallStatus": "CAST(NULL AS VARCHAR)",
            "Nextclade_qc.overallScore": "CAST(NULL AS DOUBLE)",
            "Nextclade_dataset_name": "dataset", "Nextclade_dataset_version": "version",
            "nextclade_version": "'3.' || year", "genoflu_version": "'1.' || year", "nfflu_version": "'v' || year",
        }.get(name, name)

    shown = ", ".join(f'{column(c)} AS "{c}"' for c in EXPECTED_COLUMNS)
    return f"""SELECT {shown} FROM ({_ROSTER}) r
        JOIN (SELECT sample, year, replace(priority, ' ', '') || 'n' AS priority_seq FROM {_O}) o ON o.sample = FastQID
        LEFT JOIN ({_READS}) m ON m.sample = FastQID LEFT JOIN ({_CLEAVAGE}) c ON c.sample = FastQID
        LEFT JOIN ({_GENOTYPE}) g ON g.sample = FastQID LEFT JOIN ({_SUBTYPE}) s ON s.sample = FastQID
        LEFT JOIN ({_CLADES}) n ON n.sample = FastQID"""


@query("f12_run_summary", _summary_sql())
def summary_query(spark, sf_dir):
    return summary.run_summary(order_runs(spark, sf_dir)).rows.drop("run_folder", "roster_pos")


_RUNS = f"(SELECT run, count(*) AS n FROM {_O} GROUP BY run)"


@query("f13_sample_events", f"""
    SELECT run, sample, 'unexpected_idxstats_format' AS event_type,
           'path=' || run || '/idxstats/' || sample || '/' || sample || '.Segment_' || l_linenumber || '_' || segment || '.'
           || l_partkey || '.' || l_suppkey || '.' || cents || '.idxstats;rows=3;segment=' || segment AS detail
    FROM (SELECT *, ({list(SEGMENTS)})[l_linenumber] AS segment FROM {_L}) WHERE l_returnflag = 'A'
    UNION ALL SELECT run, sample, 'genoflu_file_read_error', 'error=malformed list;path=' || run || '/genotype/genoflu/'
           || sample || '.genoflu.tsv' FROM {_O} WHERE priority = '5-LOW'
    UNION ALL SELECT run, sample, 'subtype_file_read_error', 'H_type=' || substr(priority, 1, 1) || '.0;N_type=x'
    FROM {_O} WHERE state = 'P'
    UNION ALL SELECT run, sample, 'unexpected_mixture_report_rows', 'row_count=2' FROM {_O} WHERE state = 'P'
    UNION ALL SELECT run, NULL, 'samples_collected', 'sample_count=' || n || ';source=fastq_directory' FROM {_RUNS}
    UNION ALL SELECT run, NULL, 'no_files_found', 'pattern=*nextflow.log' FROM {_RUNS}
    UNION ALL SELECT run, NULL, unnest(['nextflow_log_not_found', 'publish_nc_datasets_failed_file_missing']), '' FROM {_RUNS}""")
def events_query(spark, sf_dir):
    return shown_events(run_events.run_events(order_runs(spark, sf_dir)))


@query("f14_consensus_manifest", f"""
    SELECT DISTINCT run, sample, run || '/bcftools/' || sample || '.consensus.fasta' AS path,
           CAST(0 AS BIGINT) AS length FROM {_L} WHERE l_linenumber = 6""")
def manifest_query(spark, sf_dir):
    return manifest.consensus_manifest(order_runs(spark, sf_dir))
