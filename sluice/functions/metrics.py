"""Named metrics that double as plan fences.

``df.observe`` inserts a ``CollectMetrics`` node.  Besides reporting counts to
listeners and hooks, it is a boundary Catalyst does not push filters through
and whole-stage code generation does not fuse across.  Both matter for the
decoder: without the boundary, a predicate on a decoded column would copy the
JSON parse into itself once per reference, and long chains of staged
projections fuse into one generated method that re-evaluates shared values
inside every conditional branch.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame


def observed(df: DataFrame, label: str, *metrics: Column) -> DataFrame:
    """Attach named metrics (``sluice_<label>_<id>``) to a step of the plan."""
    return df.observe(f"sluice_{label}_{uuid.uuid4().hex[:10]}", *metrics)
