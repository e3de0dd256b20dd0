"""Plan-shape guards for every registered query (no cross joins; pruned scans)."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from kiln.plans import catalog

from tables import SF0001


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture()
def no_broadcast(spark):
    """Everything is small here; without broadcasts the plans are those of large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_cross_or_nested_loop_join(spark, no_broadcast, name):
    text = plan_text(catalog.queries()[name](spark, SF0001))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_flagship_scan_is_pruned(spark):
    text = plan_text(E.entry(spark))
    schemas = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    assert schemas and all("n_chars" not in s for s in schemas)
