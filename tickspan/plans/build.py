"""Build every layer, then test it: the one command that rebuilds the
warehouse and reports the data-quality checks on what was written."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickspan.operators.quality import Watch, run_suite
from tickspan.sources.sinks import materialize


def build(models, root: str | None = None, target_schema: str = "PUBLIC", versioned: bool = False) -> tuple[dict, DataFrame]:
    """Materialize all models (shared intermediates computed once) and run
    every declared check plus the grain checks against the written tables (missing
    and unaccepted values are counted while writing).
    Returns ({model: location}, check results: model, column_name, test,
    failures)."""
    watch = Watch()
    locations = materialize(models, root=root, target_schema=target_schema, rebind=True, versioned=versioned, watch=watch)
    return locations, run_suite(models, watch=watch)
