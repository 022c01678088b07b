"""Plan shape of every registered batch query: no cross products, no nested-loop
joins, and no window without a partition key (a single-partition window)."""

import contextlib
import io
import re

import pytest

from conftest import SMOKE
from ledgerlake import catalog

# Queries whose callables run streaming jobs or writes before returning a DataFrame.
SIDE_EFFECTS = {"stream_append", "stream_merge", "stream_flash", "append_journal",
                "merge_commit", "merge_subledgers", "stream_merge_disordered", "stream_late_rows", "append_runs", "append_run_log"}
KEYS = [k for k in catalog.REGISTRY if k not in SIDE_EFFECTS]
EMPTY_PARTITION_WINDOW = re.compile(r"Window \[.*\], \[\], \[")


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("extended")
    return buf.getvalue()


@pytest.mark.parametrize("key", KEYS)
def test_plan_has_no_cross_products_or_global_windows(spark, key):
    plan = _plan(catalog.REGISTRY[key].run(spark, SMOKE))
    physical = plan[plan.index("== Physical Plan =="):]
    assert "CartesianProduct" not in physical
    assert "BroadcastNestedLoopJoin" not in physical
    assert not EMPTY_PARTITION_WINDOW.search(physical), physical


def test_single_period_reports_prune_partitions(spark):
    plan = _plan(catalog.REGISTRY["income_statement"].run(spark, SMOKE))
    assert re.search(r"PartitionFilters: \[.*GB_DATE.* = 200102", plan)
    assert "BroadcastHashJoin" in plan  # the bounded account master is broadcast


def test_scans_read_only_needed_columns(spark):
    plan = _plan(catalog.REGISTRY["journal_to_period"].run(spark, SMOKE))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "YJ_DES" not in schema and "YJ_CRT" not in schema and "YJ_AMT" in schema
