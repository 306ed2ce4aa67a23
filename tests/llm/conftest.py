import re

import pytest

TINY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.shuffle.partitions": "8",
    # Stored tables are read by several tasks: a hot partition is split between those that wrote to it.
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.files.openCostInBytes": "1KB",
    "spark.sql.files.maxPartitionBytes": "64KB",
}


@pytest.fixture
def skew_joins(spark):
    """Runs a frame with tiny thresholds and returns the joins of its final plan that were split for a hot key."""
    before = {k: spark.conf.get(k, None) for k in TINY}
    for k, v in TINY.items():
        spark.conf.set(k, v)

    def run(df):
        df.write.format("noop").mode("overwrite").save()
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        return re.findall(r"SortMergeJoin\(skew=true\)|SortMergeJoin.*skew=true", plan), rows

    yield run
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)
