"""Software versions of a run."""

from __future__ import annotations

from pyspark.sql import functions as F

from runweave.config import VERSION_KEYS
from runweave.operators.events import events
from runweave.plans.result import Result
from runweave.sources.sections import read_sections
from runweave.sources.tables import RunTables


def software_versions(tables: RunTables) -> Result:
    """(run, one column per version); the last entry of a section and key wins."""
    texts = tables.read("versions")
    entries = read_sections(texts.where("problem is null"))

    def version(section: str, key: str):
        wanted = (F.col("section") == section) & (F.col("key") == key)
        return F.max_by("value", F.when(wanted, F.col("line")))

    rows = entries.groupBy("run").agg(*(version(s, k).alias(c) for c, (s, k) in VERSION_KEYS.items()))
    broken = texts.where("problem is not null")
    return Result(rows, lambda: [events(broken, "software_versions_file_read_error", path="path", error="problem")])
