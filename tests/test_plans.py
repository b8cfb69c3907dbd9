"""Plan lint over every registered batch query: the physical plans must not contain
shapes that break at scale — no cartesian products or nested-loop joins, no window
without a partition key, and filters on the scanned tables reach the Parquet reader."""

import contextlib
import io
import re

import pytest

from marketweave.plans import load_all
from tests.conftest import SMALL

QUERIES = load_all().REGISTRY
# these run streams or read back what they wrote: their result plans say nothing of the work;
# test_streaming, test_json_split and the oracles check them
SKIP = {k for k in QUERIES if k.startswith("stream_") or k in (
    "fault_isolation", "write_json", "write_csv", "scan_json_records")}
# a running count over one row per date of an aggregate
SMALL_WINDOWS = {"sort_macro"}


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_plan_shapes(spark, name):
    plan = _plan(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    for args in re.findall(r"\(\d+\) Window\n(?:.*\n)*?Arguments: (.*)", plan):
        # Arguments: [window exprs], [partition spec], [order spec]
        parts = re.findall(r"\[([^\[\]]*)\]", args)
        assert name in SMALL_WINDOWS or (len(parts) >= 2 and parts[1].strip()), \
            f"unpartitioned window in {name}"


def test_symbol_filter_pushed_to_scan(spark):
    plan = _plan(QUERIES["symbol_filter"](spark, SMALL))
    assert "PushedFilters" in plan


def test_scan_prunes_columns(spark):
    plan = _plan(QUERIES["language_flag"](spark, SMALL))
    m = re.search(r"ReadSchema: struct<(.*)>", plan)
    assert m and set(re.findall(r"(\w+):", m.group(1))) == {"doc_id", "lang"}


@pytest.mark.parametrize("name", ["per_term_cap", "last_n_by_symbol"])
def test_top_n_limited_before_shuffle(spark, name):
    assert "WindowGroupLimit" in _plan(QUERIES[name](spark, SMALL))
