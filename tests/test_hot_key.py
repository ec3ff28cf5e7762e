"""One GPU holding a third of all points: results stay exact and no window task holds the hot GPU's rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

from devmetrics.functions.values import NS_PER_DAY, NS_PER_HOUR
from devmetrics.operators import enrich
from devmetrics.operators.points import build_points
from devmetrics.plans import fixtures as fx
from tests.conftest import SF_CHECK


@pytest.fixture(scope="module")
def hot_points(spark):
    p = build_points(fx.telemetry(spark, SF_CHECK)).select(
        "persist_key", "timestamp_ns", F.col("fields.metric_name").alias("metric_name"),
        F.col("fields.value").alias("value"),
        F.when(F.col("persist_key") % 3 == 0, F.lit("hot")).otherwise(F.col("gpu_id")).alias("gpu_id"))
    return p


def _largest_partition_share(df, window_col: str) -> float:
    """Largest share of rows in one partition of the window stage (the window output is used, so the window is
    not pruned away)."""
    rows = df.where(F.col(window_col).isNotNull() | F.lit(True)).groupBy(F.spark_partition_id().alias("p")).agg(
        F.count(F.lit(1)).alias("n"), F.max(window_col).alias("_keep")).collect()
    counts = [r.n for r in rows]
    return max(counts) / sum(counts)


@pytest.fixture
def no_aqe(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", old)


def test_rolling_mean_hot_gpu(spark, hot_points, no_aqe):
    width = 6 * NS_PER_HOUR
    out = enrich.rolling_mean(hot_points, width, bucket_ns=NS_PER_DAY, keys=("gpu_id",))
    # The window stage is the last shuffle: its partitions are the window tasks.
    assert _largest_partition_share(out, "window_points") < 0.25
    got = {r.persist_key: (r.rolling_mean, r.window_points) for r in out.collect()}
    pdf = hot_points.toPandas()
    expected = duckdb.sql(f"""
        SELECT persist_key, avg(value) OVER w AS m, count(*) OVER w AS n FROM pdf
        WINDOW w AS (PARTITION BY gpu_id ORDER BY timestamp_ns RANGE BETWEEN {width - 1} PRECEDING AND CURRENT ROW)
    """).fetchall()
    assert len(got) == len(expected)
    for k, m, n in expected:
        assert got[k][1] == n and abs(got[k][0] - m) < 1e-9, k


def test_derivative_hot_gpu(spark, hot_points, no_aqe):
    out = enrich.derivative(hot_points, bucket_ns=NS_PER_DAY, keys=("gpu_id",))
    got = {r.persist_key: r.prev_timestamp_ns for r in out.collect()}
    pdf = hot_points.toPandas()
    expected = duckdb.sql("""
        SELECT persist_key, lag(timestamp_ns) OVER (PARTITION BY gpu_id ORDER BY timestamp_ns, persist_key) FROM pdf
    """).fetchall()
    assert got == dict(expected)


def test_hot_gpu_would_skew_a_plain_window(spark, hot_points, no_aqe):
    # Control: partitioned by GPU alone, one task gets at least the hot third.
    from pyspark.sql import Window

    plain = hot_points.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("gpu_id")))
    assert _largest_partition_share(plain, "n") >= 1 / 3
