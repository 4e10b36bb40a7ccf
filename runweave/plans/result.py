"""Rows of a plan together with its data-quality events."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame


def _none() -> list[DataFrame]:
    return []


@dataclass(frozen=True)
class Result:
    """The events are built on demand: a job that only wants the rows does not plan them."""

    rows: DataFrame
    events: Callable[[], list[DataFrame]] = _none
