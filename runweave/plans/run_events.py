"""All data-quality events of the jobs as one table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from runweave.config import JobConfig
from runweave.operators.events import all_events
from runweave.plans.mixtures import mixtures
from runweave.plans.summary import run_summary
from runweave.sources.tables import RunTables


def run_events(tables: RunTables, config: JobConfig = JobConfig()) -> DataFrame:
    """(run, sample, event_type, detail) of the summary, clade, status and mixture jobs."""
    return all_events([*run_summary(tables, config).events(), *mixtures(tables).events()])
