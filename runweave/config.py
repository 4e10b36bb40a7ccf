"""Job settings and the fixed values of the run-tree format."""

from __future__ import annotations

from dataclasses import dataclass

# ---- fixed values: genome segments, in report order -------------------------
SEGMENTS = ("PB2", "PB1", "PA", "HA", "NP", "NA", "M", "NS")

# ---- fixed values: cell texts that a delimited reader treats as missing ------
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# ---- fixed values: presence code (HA + 2 * NA) -> text -----------------------
PRESENCE_TEXTS = (
    "No subtype for HA or NA",
    "HA subtype successful",
    "NA subtype successful",
    "HA and NA subtype successful",
)

# ---- fixed values: sample-name patterns --------------------------------------
# whole-name forms with four groups (CID, Plate, Index, Well), tried in this order
STANDARD_NAME = r"^([A-Z][0-9]{10})-([0-9]{4,})-([A-Z0-9]{1,})-([A-Z][0-9]{2})$"
CONTROL_NAME = r"^([A-Za-z]{3,}[0-9]{8})-[A-Za-z]+-([0-9]{4,})-([A-Z0-9]{1,})-([A-Z][0-9]{2})$"
# salvage: the tail gives Plate, Index, Well; the heads give the CID
SALVAGE_TAIL = r"-([0-9]{4,9})-([A-Z0-9]{1,})-([A-Z][0-9]{2})$"
SALVAGE_HEADS = (r"^([A-Z][0-9]{10})", r"^([A-Za-z]{3,}[0-9]{8})")

# ---- fixed values: other patterns --------------------------------------------
SEGMENT_IN_FILE_NAME = r"Segment_\d+_([A-Za-z0-9]+)\."
RANGE_IN_HEADER = r"\|(\d+)\.\.(\d+)"
COMPLETED_TASK = r"Task completed.+name: ([^;]+).+workDir: ([^\s]+)"
DATASET_PROCESS = "AGG_NEXTCLADE_TSV"
DATASET_FILE_IN_WORKDIR = "nextclade-tsv-outputs.csv"
FASTQ_SUFFIX = ".merged.fastq.gz"
CONSENSUS_SUFFIX = ".consensus.fasta"
UNKNOWN_DATASET = "N/A"
COMPLETENESS_LIMIT = 90

# ---- fixed values: stages of the status code, in order -----------------------
STAGE_CODES = {
    "irma": 2,
    "blastn_ref": 3,
    "reference": 4,
    "minimap2": 5,
    "freebayes": 6,
    "bcftools": 7,
    "blastn_subtype": 8,
    "mixture": 9,
}

# ---- fixed values: software versions shown (column -> section, key) ----------
VERSION_KEYS = {
    "nextclade_version": ("NEXTCLADE_RUN", "nextclade"),
    "genoflu_version": ("GENOFLU", "genoflu"),
    "nfflu_version": ("Workflow", "CFIA-NCFAD/nf-flu"),
}

# ---- fixed values: clade columns shown (source column -> summary column) -----
CLADE_COLUMNS = {
    "clade": "Nextclade_clade",
    "subclade": "Nextclade_subclade",
    "legacy-clade": "Nextclade_legacy_clade",
    "qc.overallScore": "Nextclade_qc.overallScore",
    "qc.overallStatus": "Nextclade_qc.overallStatus",
    "nextclade_dataset_name": "Nextclade_dataset_name",
    "nextclade_dataset_version": "Nextclade_dataset_version",
}

# ---- fixed values: where the files of one run lie ----------------------------
# source name -> (base directory, glob below it); "parent" is the folder above the run's own
SOURCE_GLOBS = {
    "fastq": ("run", "fastq/*.merged.fastq.gz"),
    "subtype": ("run", "subtyping_report/subtype_results.csv"),
    "clade_dir": ("run", "nextclade/*"),
    "clades": ("run", "nextclade/*/*.nextclade.tsv"),
    "dataset_versions": ("run", "nextclade/nextclade-dataset-versions.csv"),
    "task_log": ("run", "*nextflow.log"),
    "idxstats": ("run", "mapping/*/*.idxstats"),
    "bcftools": ("run", "consensus/bcftools/*.consensus.fasta"),
    "cleavage": ("run", "annotation/*/*.cleavage.tsv"),
    "genotype": ("run", "genoflu/*.genoflu.tsv"),
    "versions": ("run", "pipeline_info/software_versions.yml"),
    "mixtures": ("run", "mixtures/*/*_mixtures.csv"),
    "mixture": ("run", "mixtures/*/*_mixtures.txt"),
    "irma": ("run", "irma/*.irma.consensus.fasta"),
    "blastn_ref": ("run", "blast/blastn/irma/*blastn.txt"),
    "reference": ("run", "reference_sequences/*"),
    "minimap2": ("run", "mapping/*"),
    "freebayes": ("run", "variants/*"),
    "blastn_subtype": ("run", "blast/blastn/consensus/*.blastn.txt"),
    "start_sheet": ("parent", "samplesheets/*start_samplesheet.csv"),
    "output_sheet": ("parent", "samplesheets/*_output_samplesheet.csv"),
}

# sources whose content is read; the others are looked at by name only
CONTENT_SOURCES = (
    "subtype", "clades", "dataset_versions", "task_log", "idxstats", "bcftools", "cleavage",
    "genotype", "versions", "mixtures", "mixture", "start_sheet", "output_sheet",
)


def _segment_columns(segment: str) -> tuple[str, ...]:
    return tuple(
        f"{segment}_{m}" for m in ("reads_mapped", "seq_length", "consensus_completeness", "tree_pass")
    )


# ---- fixed values: columns of the summary, in order --------------------------
REPORT_SEGMENTS = ("HA", "NA", "M", "NP", "NS", "PA", "PB1", "PB2")
EXPECTED_COLUMNS = (
    "FastQID", "CID", "Plate", "Index", "Well", "Run",
    "subtype_HA_NA_status", "subtype", "HA_subtype", "NA_subtype",
    *(c for s in REPORT_SEGMENTS for c in _segment_columns(s)),
    "HPAI_cleave_start", "HPAI_cleave_end", "HPAI_cleavage_site_motif",
    *CLADE_COLUMNS.values(),
    "GenoFLU_Genotype", *(f"GenoFLU_{s}" for s in REPORT_SEGMENTS),
    *VERSION_KEYS,
)


@dataclass(frozen=True)
class JobConfig:
    """Settings of the jobs; a list given by the user replaces the default list as a whole."""

    expected_columns: tuple[str, ...] = EXPECTED_COLUMNS
    auto_mode: bool = False
    pipelines: tuple[str, ...] | None = None  # status columns; None: those of the runs at hand, so columns may change
    legacy_clade: bool = False
    ha_only: bool = True
