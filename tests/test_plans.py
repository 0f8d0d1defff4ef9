"""Physical-plan properties the design relies on."""

import re

from conftest import SF_SMALL
from sensorlake.operators.windows import eligible
from sensorlake.plans.queries import parsed, raw
from sensorlake.session import scratch_dir
from sensorlake.sources.log import SourceSpec, read_bounded, to_envelope, write_log


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_json_parsed_once_per_row(spark):
    plan = _plan(eligible(parsed(spark, SF_SMALL)))
    assert len(re.findall(r"from_json", plan)) == 1


def test_log_partitions_pruned_at_scan(spark):
    path = scratch_dir(spark, "t-log")
    write_log(to_envelope(raw(spark, SF_SMALL)), path, partition_by=("partition",))
    df = read_bounded(spark, SourceSpec(format="json", path=path, partitions=(0, 2)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*partition#\d+ IN \(0,2\)", plan)
    assert df.count() == raw(spark, SF_SMALL).where("partition IN (0, 2)").count()
