"""Writes a small two-run tree with the edge rows every golden test needs."""

from __future__ import annotations

import os
from pathlib import Path

S1 = "R1234567890-2404-A-D09"
S2 = "POS20240101-abc-2404-A-D10"
S3 = "R1234567890-x-2404-A-D11"
S4 = "foo"
S5 = "_odd"


def put(root: Path, rel: str, text: str = "") -> None:
    path = root / rel
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def fasta(sample: str, **segments: str) -> str:
    return "".join(f">{sample}_segment_{s} note\n{seq}\n" for s, seq in segments.items())


def clade_row(sample: str, segment: str, clade: str, score: str, *more: str) -> str:
    return "\t".join(["0", f"{sample}_segment4_{segment}", clade, score, *more])


def write_run_one(base: Path) -> str:
    run = base / "RUN1" / "out" / "analysis"
    for s in (S1, S2):
        put(run, f"fastq/{s}_1.merged.fastq.gz")
        put(run, f"fastq/{s}_2.merged.fastq.gz")
    for s in (S3, S4, S5):
        put(run, f"fastq/{s}.merged.fastq.gz")
    put(run, "fastq/other.txt", "no sample")

    put(run, "subtyping_report/subtype_results.csv",
        f",sample,Genotype,H_type,N_type\n0,{S1},H5N1,5.0,1\n1,{S2},H5,5,\n2,{S3},x,x,1\n3,{S4},,,\n4,{S4},,9,9\n")

    def idx(sample: str, name: str, text: str) -> None:
        put(run, f"mapping/{sample}/{sample}.{name}.idxstats", text)

    good = "AB1.1\t1701\t52310\t0\n*\t0\t0\t918\n"
    idx(S1, "Segment_4_HA.a", good)
    idx(S1, "Segment_4_HA.b", "AB2.1\t1702\t99\t0\n\n*\t0\t0\t1\n")      # second file of a segment wins
    idx(S1, "Segment_6_NA.a", "AB3.1\t1400\t7\t0\n")                     # one row
    idx(S1, "Segment_7_M.a", good + "x\t1\t1\t1\n")                      # three rows
    idx(S1, "Segment_9_ZZ.a", good)                                      # unknown segment
    idx(S1, "nothing", good)                                             # no segment
    idx(S2, "Segment_6_NA.a", "AB3.1\tlong\t7\t0\n*\t0\t0\t1\n")         # no number
    idx(S5, "Segment_1_PB2.a", "P\t2341\t10\t0\n*\t0\t0\t1\n")

    put(run, f"consensus/bcftools/{S1}.consensus.fasta",
        "ignored\n" + fasta(S1, HA="ACGTnNAC", NA="AC--RY", M="", ZZ="AC") + f">{S1}_x_HA\nACGTACGTAN\nACGTACGTAC\n")
    put(run, f"consensus/bcftools/{S2}.consensus.fasta", fasta(S2, HA="A" * 9 + "N", PA="A" * 1000 + "N"))

    head = "Sample\tCleavage Sequence\tCleavage Site Sequence Header\n"
    put(run, f"annotation/{S1}/{S1}.cleavage.tsv",
        head + f"a\tPLREKRRKR\t{S1}_segment4_HA|misc_feature|HA|1035..1061 cleavage site\nb\tX\ty|1..2\n")
    put(run, f"annotation/{S2}/{S2}.cleavage.tsv", "")
    put(run, f"annotation/{S3}/{S3}.cleavage.tsv", head)
    put(run, f"annotation/{S4}/{S4}.cleavage.tsv", head + "a\tMOTIF\tno range here\n")

    ghead = "Strain\tGenotype\tGenotype List Used, >=98.0%\n"
    put(run, f"genoflu/{S1}.genoflu.tsv",
        ghead + "x\tB3.2\tPB2:am1.2, PB1:am4, PA:ea1, HA:ea1, NP:am8, NA:ea1, MP:ea1, NS:am1.1, XX:q\n")
    put(run, f"genoflu/{S2}.genoflu.tsv", ghead + "x\tNot assigned\t\n")
    put(run, f"genoflu/{S3}.genoflu.tsv", ghead + "x\tA1\tHA:ea1, broken\n")
    put(run, f"genoflu/{S4}.genoflu.tsv", ghead + "x\tA1\tHA:h, M:own, HA:last\n")

    put(run, "pipeline_info/software_versions.yml",
        "GENOFLU:\n  genoflu: 1.10\nNEXTCLADE_RUN:\n    nextclade: '3.8.2'\nOTHER:\n  nextclade: 9\n"
        "Workflow:\n  CFIA-NCFAD/nf-flu: v3.5.0  # note\n  Nextflow: 23.04\n")

    wide = "index\tseqName\tclade\talignmentScore\tsubclade\tqc.overallScore\tqc.overallStatus\n"
    slim = "index\tseqName\tclade\talignmentScore\tlegacy-clade\n"
    put(run, f"nextclade/{S1}/a.h5.nextclade.tsv", wide + "\n".join([
        clade_row(S1, "HA", "2.3.4.4b", "5012", "s1", "1.5", "good"),
        clade_row(S1, "HA", "2.3.4.4c", "5012", "s2", "2.5", "bad"),      # tie: the first row wins
        clade_row(S1, "NA", "never", "9999", "", "", ""),
        clade_row(S1, "HA", "", "9998", "", "", ""),
    ]) + "\n")
    put(run, f"nextclade/{S1}/b.h5.nextclade.tsv", slim + clade_row(S1, "HA", "old", "4000", "L1") + "\n")
    put(run, f"nextclade/{S2}/two.nextclade.tsv", slim + "\n".join([     # two samples in one file
        clade_row(S2, "HA", "c2", "10", "L2"), clade_row("other", "HA", "c3", "20", '"tab\there ""q"""'),
    ]) + "\n")
    put(run, f"nextclade/{S3}/noscore.nextclade.tsv", slim + clade_row(S3, "HA", "c4", "", "L3") + "\n")
    put(run, f"nextclade/{S4}/empty.nextclade.tsv", "")
    put(run, f"nextclade/{S4}/nohead.nextclade.tsv", "a\tb\n1\t2\n")
    (run / "nextclade" / "nofiles").mkdir()
    work = base / "work" / "aa"
    put(work, "nextclade-tsv-outputs.csv", f"{S1},flu_h5_all,2024-05-08,a.h5.nextclade.tsv\n")
    put(run, "nextclade/nextclade-dataset-versions.csv", "x,published,1,a.h5.nextclade.tsv\n")
    put(run, "1.nextflow.log", "\n".join([
        "start", f"DEBUG Task completed > TaskHandler[id: 1; name: A:AGG_NEXTCLADE_TSV (1); status: COMPLETED; workDir: /gone x]",
        "Task completed > TaskHandler[id: 3; name: B:AGG_NEXTCLADE_TSV (2); status: COMPLETED; workDir: /other x]",
        f"Task completed > TaskHandler[id: 5; name: A:AGG_NEXTCLADE_TSV (1); status: COMPLETED; workDir: {work} x]",
    ]) + "\n")

    mhead = "sample_name,mixture_present,ha_read_ratio\n"
    put(run, f"mixtures/{S1}/{S1}_mixtures.csv", mhead + f"{S1},True,0.62\n")
    put(run, f"mixtures/{S2}/{S2}_mixtures.csv", "sample_name,extra\n" + f'{S2},"a, b"\n')
    put(run, f"mixtures/{S3}/{S3}_mixtures.csv", mhead)
    put(run, f"mixtures/{S4}/{S4}_mixtures.csv", mhead + "a,True,1\nb,True,2\n")
    put(run, f"mixtures/{S1}/{S1}_mixtures.txt", "0")
    put(run, f"mixtures/{S2}/{S2}_mixtures.txt", "1")
    put(run, f"mixtures/{S3}/{S3}_mixtures.txt", "1\n")
    put(run, f"mixtures/{S4}/{S4}_mixtures.txt", "")

    # all stages but irma for S3; no blastn_subtype file in the whole run
    for s in (S1, S2, S4):
        put(run, f"irma/{s}.irma.consensus.fasta", ">x\n")
    for s in (S1, S2, S3, S4):
        put(run, f"blast/blastn/irma/{s}.blastn.txt")
        (run / "reference_sequences" / s).mkdir(parents=True)
        (run / "variants" / s).mkdir(parents=True)
        (run / "mapping" / s).mkdir(parents=True, exist_ok=True)
    put(run, f"consensus/bcftools/{S3}.consensus.fasta", "")
    put(run, f"consensus/bcftools/{S4}.consensus.fasta", "no record")
    parent = run.parent
    put(parent, "samplesheets/r_start_samplesheet.csv", f"ID,R1\n{S4},x\n{S1},x\n{S2},x\n{S3},x\nlate,x\n{S1},y\n")
    put(parent, "samplesheets/X_typing_output_samplesheet.csv", f"ID\n{S1}\n{S2}\n")
    put(parent, "samplesheets/X_trees_output_samplesheet.csv", f"ID\n{S1}\n{S1}\n")
    put(parent, "samplesheets/X_broken_output_samplesheet.csv", "name\nx\n")
    put(parent, "samplesheets/X_nf-flu_output_samplesheet.csv", f"ID\n{S4}\n")
    return str(run)


def write_run_two(base: Path) -> str:
    """A run with little in it: one sample, no subtype table, no log, no versions."""
    run = base / "RUN2" / "out" / "analysis"
    put(run, "fastq/" + S1 + ".merged.fastq.gz")
    put(run, f"nextclade/{S1}/a.nextclade.tsv",
        "seqName\tclade\talignmentScore\n" + f"{S1}_segment4_HA\tonly\t1.5\n")
    put(run.parent, "samplesheets/a_start_samplesheet.csv", f"ID\n{S1}\n")
    put(run.parent, "samplesheets/b_start_samplesheet.csv", f"ID\n{S1}\n")
    return str(run)
