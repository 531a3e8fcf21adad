"""Tables laid out by user: pruned reads; counts by partition."""

import re

from pyspark.sql import functions as F

from encore.operators.partitions import map_with_index, step_counts
from encore.session import scratch_path
from encore.sinks import keyed
from encore.sources import testdata as td
from tests.conftest import SF_MID


def test_a_batch_reads_only_its_buckets(spark):
    pairs = td.dismissals(spark, SF_MID)
    table = keyed.write_by_user(pairs, scratch_path(spark, "dismissals"), 64)
    users = pairs.select("user_id").distinct().orderBy("user_id").limit(10)
    ten = [r.user_id for r in users.collect()]
    batch = spark.createDataFrame([(u,) for u in ten] + [(None,), (-5,)], "user_id long")
    got = table.of(batch)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, pairs.filter(F.col("user_id").isin(ten)).collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    wanted = {1 + u % 64 for u in [*ten, -5]}
    listed = re.search(r"PartitionFilters: \[.*?_user_bucket#\d+ (?:IN|INSET) \(?([\d, ]+)", plan)
    assert listed, plan
    assert {int(x) for x in listed[1].replace(" ", "").strip(",").split(",")} <= wanted
    assert sorted(map(tuple, table.all().drop(keyed.BUCKET).collect())) == sorted(map(tuple, pairs.collect()))


def test_counts_have_a_row_for_each_partition_and_step(spark):
    df = spark.range(0, 1000, 1, 7)
    got = step_counts(df, {"all": F.lit(True), "even": F.col("id") % 2 == 0}).collect()
    assert len(got) == 14 and {r.partition for r in got} == set(range(7))
    assert sum(r.n_rows for r in got if r.step == "all") == 1000
    assert sum(r.n_rows for r in got if r.step == "even") == 500


def test_work_with_the_partition_index(spark):
    def work(index, batches):
        for pdf in batches:
            yield pdf.assign(partition=index)

    got = map_with_index(spark.range(0, 100, 1, 5), work, "id long, partition int")
    assert {(r.partition, r.id // 20) for r in got.collect()} == {(i, i) for i in range(5)}
