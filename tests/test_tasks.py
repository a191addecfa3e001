"""What a task is given does not follow the input: the named queries' settings, and what they do to a shuffle."""

import os

import pytest
from pyspark.sql import functions as F

from dispatchlake.plans import catalog
from dispatchlake.session import PARTS, TASK_BYTES, bound_tasks, in_bytes

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
NAMED = ["metric_r06_unit_availability", "metric_i04_initial_dispatch", "ag_16_span_guard", "inc_09_day_guard", "metric_r08_r09_open_turnouts", "str_07_batch_check", "call_04_disagreeing_legs", "metric_i10_late_dispatches", "qry_11_own_rows_only", "wn_07_rank_alternatives"]


@pytest.fixture
def fresh(spark):
    """A session with Spark's own settings."""
    session = spark.newSession()
    for key in (*TASK_BYTES, FIRST):
        session.conf.unset(key)
    return session


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", NAMED)
def test_named_queries_bound_their_tasks(fresh, name):
    assert all(in_bytes(fresh.conf.get(key)) > size for key, size in TASK_BYTES.items())
    catalog.QUERIES[name](fresh, SF)
    assert all(in_bytes(fresh.conf.get(key)) <= size for key, size in TASK_BYTES.items())
    assert int(fresh.conf.get(FIRST)) >= PARTS


def test_a_large_shuffle_is_cut(fresh):
    """Some 50 MB that cannot be packed, for few cores: parts of 8 MB at most, not one for each core."""
    parts = lambda: fresh.range(400_000).select((F.col("id") % 5000).alias("k"), F.expr("concat_ws('', transform(sequence(1, 4), i -> sha2(cast(id * 5 + i AS string), 256)))").alias("t")).repartition("k").rdd.getNumPartitions()
    assert parts() <= 5
    bound_tasks(fresh)
    assert parts() >= 8


def test_tighter_settings_are_kept(fresh):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    fresh.conf.set(key, "16k")
    fresh.conf.set(FIRST, "5000")
    bound_tasks(fresh)
    assert fresh.conf.get(key) == "16k" and fresh.conf.get(FIRST) == "5000"
    assert [in_bytes(t) for t in ("64MB", "16k", "134217728b", "1024", "1m")] == [64 << 20, 16 << 10, 1 << 27, 1024, 1 << 20]
