"""Operators put together the way a batch job runs them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rollmark.operators.admit import School, to_events, validate_marks
from rollmark.operators.arbitrate import arbitrate_marks
from rollmark.plans.session import cut
from rollmark.plans.skew import ROWS_PER_TASK


def admit_and_settle(
    requests: DataFrame,
    school: School,
    history: DataFrame | None = None,
    *,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Requests to settled events: those that pass validation, with ``accepted`` and
    ``reject_reason`` of the arbitration. The validated events are stored in between, as they
    are read more than once."""
    events = cut(to_events(validate_marks(requests, school, rows_per_task=rows_per_task)))
    return arbitrate_marks(events, history, rows_per_task=rows_per_task)
