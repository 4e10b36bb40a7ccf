"""Types of the summary columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

from runweave.config import EXPECTED_COLUMNS

_BY_ENDING = {
    "_reads_mapped": T.LongType(),
    "_seq_length": T.LongType(),
    "_consensus_completeness": T.DoubleType(),
    "_tree_pass": T.IntegerType(),
    "HPAI_cleave_start": T.IntegerType(),
    "HPAI_cleave_end": T.IntegerType(),
    "qc.overallScore": T.DoubleType(),
}


def summary_type(column: str) -> T.DataType:
    return next((t for ending, t in _BY_ENDING.items() if column.endswith(ending)), T.StringType())


def summary_schema(columns: Sequence[str] = EXPECTED_COLUMNS) -> T.StructType:
    return T.StructType([T.StructField(c, summary_type(c)) for c in columns])
