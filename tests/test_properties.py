"""Property tests from the test strategy: masking leaves no non-finite
value, the final status is monotone in severity, renames and sorted writes."""

import math

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from fieldcat.functions import issue, mask_nonfinite
from fieldcat.operators import fields as fld, jobs, sinks
from fieldcat.session import scratch_dir

finite_or_not = st.one_of(st.floats(allow_nan=True, allow_infinity=True), st.none())


@settings(max_examples=20, deadline=None)
@given(st.lists(st.lists(finite_or_not, max_size=8), min_size=1, max_size=5))
def test_mask_leaves_no_nonfinite(spark, arrays):
    rows = [(a,) for a in arrays]
    out = spark.createDataFrame(rows, "a array<double>").select(mask_nonfinite("a").alias("m")).collect()
    for src, r in zip(arrays, out):
        assert len(r.m) == len(src)
        for x, y in zip(src, r.m):
            if x is None or not math.isfinite(x):
                assert y is None
            else:
                assert y == x


RANK = {"successful": 0, "complete_with_issues": 1, "error": 2}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.sampled_from(["warning", "error"]), max_size=5),
       st.sampled_from(["warning", "error"]))
def test_final_status_monotone(spark, sevs, extra):
    jb = spark.createDataFrame([("j",)], "job_id string")
    def status(ss):
        if not ss:
            iss = spark.createDataFrame([], "job_id string, seq int, sev string")
        else:
            iss = spark.createDataFrame([("j", i, s) for i, s in enumerate(ss)], "job_id string, seq int, sev string")
        iss = iss.select("job_id", "seq", issue(F.col("sev"), F.lit("m")).alias("issue"))
        return jobs.final_status(jb, iss).first().status
    # adding an issue never makes the status better
    assert RANK[status(sevs + [extra])] >= RANK[status(sevs)]


def test_rename_separator(spark):
    df = spark.createDataFrame([(1, 2)], "`:measurement:sample:name` int, plain int")
    assert fld.rename_separator(df).columns == ["/measurement/sample/name", "plain"]
    f = spark.createDataFrame([(":a:b",)], "key string")
    assert fld.rename_keys(f).first().key == "/a/b"


def test_write_table_sorted_partitioned(spark):
    path = scratch_dir(spark, "test-write")
    df = spark.createDataFrame([(3, "b"), (1, "a"), (2, "a")], "submit int, status string")
    sinks.write_table(df, path, partition_by=["status"], sort_within=["submit"])
    back = spark.read.parquet(path)
    assert sorted((r.submit, r.status) for r in back.collect()) == [(1, "a"), (2, "a"), (3, "b")]
    assert back.where("status = 'a'").count() == 2
