"""Isolation inside a task, the incremental fold, bitmaps of access, and table layouts."""

import datetime as dt
import glob
import os
import random

import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fieldcat.operators import access, isolate, jobs as J, layout
from fieldcat.operators.registry import Registry

T0 = dt.datetime(2024, 1, 1)
EVENTS = "id string, time timestamp_ntz, status string, submitter string, log string, event_id long"


def some_events(n, jobs=8, seed=1):
    rng = random.Random(seed)
    statuses = ["submitted", "running", "successful", "error", "complete_with_issues"]
    return [(rng.choice([None, *[f"j{k}" for k in range(jobs)]]), T0 + dt.timedelta(hours=rng.randrange(200)), rng.choice(statuses),
             f"u{rng.randrange(3)}", rng.choice([None, "log"]), i) for i in range(n)]


# ---------------------------------------------------------------- isolation

def test_bisecting_finds_the_bad_rows_only():
    calls = []

    def fn(rows):
        calls.append(len(rows))
        bad = rows[rows["v"] % 100 == 7]
        if len(bad):
            raise KeyError(int(bad["v"].iloc[0]))
        return rows.assign(w=rows["v"] * 2)

    out = list(isolate.bisect(pd.DataFrame({"v": range(1000)}), fn))
    good = sorted(v for part, text in out if text is None for v in part["w"])
    assert good == [2 * v for v in range(1000) if v % 100 != 7]
    assert sorted((int(part["v"].iloc[0]), text) for part, text in out if text) == [(v, f"KeyError: {v}") for v in range(7, 1000, 100)]
    assert len(calls) < 10 * 2 * 11  # k log n, not n


@pytest.mark.parametrize("partitions", [1, 5])
def test_the_other_rows_of_a_task_are_as_if_the_bad_ones_were_not_there(spark, partitions):
    def fn(rows):
        if (rows["job_id"] == "j3").any():
            raise ValueError("no such thing: é " + "x" * 10_000)
        return rows[["job_id"]].assign(pid="p-" + rows["job_id"])

    jobs = spark.createDataFrame([(f"j{i}", f"/f{i}", "spec") for i in range(20)], "job_id string, document_path string, mapping_id string")
    reg = Registry()
    reg.register("spec", isolate.row_ingestor(fn, "job_id string, pid string"))
    _, res = reg.run(jobs.repartition(partitions), None)
    assert sorted(r.pid for r in res.datasets.collect()) == sorted(f"p-j{i}" for i in range(20) if i != 3)
    issue = [r for r in res.issues.collect()]
    assert [(r.job_id, r.issue.msg) for r in issue] == [("j3", "ingestor failed")]
    text = issue[0].issue.exception
    assert text.startswith("ValueError: no such thing: é xx") and len(text) == isolate.MOST_TEXT
    good, bad = isolate.run_isolated(jobs.limit(0), fn, "job_id string, pid string")
    assert good.count() == 0 and bad.count() == 0


def test_wrong_columns_are_the_plug_ins_fault_too(spark):
    jobs = spark.createDataFrame([("a", 1), ("b", 2)], "job_id string, n int")
    good, bad = isolate.run_isolated(jobs, lambda rows: rows.rename(columns={"n": "m"}), "job_id string, m int")
    assert sorted((r.job_id, r.m) for r in good.collect()) == [("a", 1), ("b", 2)] and bad.count() == 0


# ---------------------------------------------------------------- the fold kept up to date

@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order_fold_to_the_same_jobs(spark, tmp_path, seed):
    events = some_events(400, seed=seed)
    random.Random(seed).shuffle(events)
    path = str(tmp_path / "jobs")
    for i in range(4):
        batch = spark.createDataFrame(events[i::4], EVENTS)
        J.update_jobs(batch, path, i, 4, tiebreak="event_id")
        if i == 2:  # a replayed batch changes nothing
            J.update_jobs(batch, path, i, 4, tiebreak="event_id")
    whole = J.fold_jobs(spark.createDataFrame(events, EVENTS), tiebreak="event_id")
    assert sorted(map(str, J.read_jobs(spark, path).collect())) == sorted(map(str, whole.select(J.read_jobs(spark, path).columns).collect()))


def test_a_batch_touches_the_buckets_of_its_jobs_only(spark, tmp_path):
    path = str(tmp_path / "jobs")
    J.update_jobs(spark.createDataFrame(some_events(300, jobs=40), EVENTS), path, 0, 32, tiebreak="event_id")
    one = spark.createDataFrame([("j1", T0, "running", "u", None, 1000)], EVENTS)
    assert len(J.update_jobs(one, path, 1, 32, tiebreak="event_id")) == 1


# ---------------------------------------------------------------- bitmaps

def test_reach_equals_the_pairs(spark):
    rng = random.Random(3)
    groups = [f"g{i}" for i in range(9)]
    records = [(f"p{i}", rng.choice([None, *groups]), rng.choice([None, [], rng.choices([None, *groups], k=3)])) for i in range(500)]
    users = [(f"u{i}", rng.choice([None, [], rng.choices([None, *groups, "other"], k=4)])) for i in range(30)] + [("u0", None)]
    ds = spark.createDataFrame(records, "pid string, ownerGroup string, accessGroups array<string>")
    us = spark.createDataFrame(users, "user string, groups array<string>")
    want = {u: [0, 0] for u, _ in users}
    for r in access.visible(ds, us).collect():
        want[r.user][0] += 1
        want[r.user][1] += r.can_write
    got = {r.user: [r.n_read, r.n_write] for r in access.user_reach(ds, us).collect()}
    assert got == want and sum(n for n, _ in want.values()) > 1000


def test_bitmaps_over_many_blocks_and_no_pairs(spark):
    ds = spark.range(100_000).select(F.col("id").alias("pid"), F.lit("hot").alias("ownerGroup"), F.array(F.concat(F.lit("a"), F.col("id") % 3)).alias("accessGroups"))
    us = spark.createDataFrame([("all", ["hot", "a0"]), ("third", ["a1"]), ("none", ["x"])], "user string, groups array<string>")
    assert {r.user: (r.n_read, r.n_write) for r in access.user_reach(ds, us).collect()} == {
        "all": (100_000, 100_000), "third": (33_333, 0), "none": (0, 0)}
    assert access.group_bitmaps(ds).count() == 4 * 4  # 100,000 records: four blocks a group
    assert access.user_reach(ds.limit(0), us).agg(F.sum("n_read")).first()[0] == 0


def test_reach_of_records_with_many_groups_and_of_repeated_rows(spark):
    """Records with more groups than are counted by subsets, with equal ids, and without any."""
    rng = random.Random(4)
    groups = [f"g{i}" for i in range(14)]
    records = [(i % 90, rng.choice([None, *groups]), rng.sample(groups, rng.randrange(13))) for i in range(200)]
    users = [(rng.choice([None, *"abcdefgh"]), rng.sample([*groups, "other"], rng.randrange(9))) for _ in range(20)]
    ds = spark.createDataFrame(records, "pid long, ownerGroup string, accessGroups array<string>")
    us = spark.createDataFrame(users, "user string, groups array<string>")
    want = {}
    for u in {u for u, _ in users}:
        own = {g for v, gs in users for g in gs if v == u and u is not None}
        want[u] = [sum(bool(own & {o, *a}) for _, o, a in records), sum(o in own for _, o, _ in records)]
    assert {r.user: [r.n_read, r.n_write] for r in access.user_reach(ds, us).collect()} == want


def test_reach_holds_no_row_for_each_user_and_part_of_the_records(spark):
    """Counts of group sets: as many rows for many records as for few."""
    def rows(n):
        ds = spark.range(n).select(F.col("id").alias("pid"), F.concat(F.lit("o"), F.col("id")).alias("ownerGroup"),
                                   F.array(F.concat(F.lit("a"), F.col("id") % 3)).alias("accessGroups"))
        held = spark.createDataFrame([("a0", 9), ("a1", 9), ("o5", 1)], "_g string, _users long")
        return access.group_set_counts(ds, held).where("n_read <> 0").count()
    assert rows(100) == rows(100_000) == 3  # a0, a1 and o5, whose other group no one holds


def test_visible_pairs_stream_past_blocks_of_users(spark, monkeypatch):
    """A hot group's users in several blocks and its records in several parts give each pair once,
    by a hash join that sorts and buffers no records."""
    for name, n in (("USERS_OF_BLOCK", 7), ("USERS_OF_PART", 4), ("PARTS", 3)):
        monkeypatch.setattr(access, name, n)
    ds = spark.createDataFrame([(i, f"g{i % 3}", ["all", None, f"h{i % 2}"]) for i in range(60)] + [(None, "all", None)],
                               "pid long, ownerGroup string, accessGroups array<string>")
    us = spark.createDataFrame([(f"u{i}", ["all", f"g{i % 4}"]) for i in range(20)], "user string, groups array<string>")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = access.visible(ds, us)
        rows = [tuple(r) for r in out.collect()]
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = [(f"u{u}", p, True, p is None or u % 4 == p % 3) for u in range(20) for p in [*range(60), None]]
    assert sorted(rows, key=str) == sorted(want, key=str)
    assert "ShuffledHashJoin" in plan


def test_a_record_joins_a_block_of_users_once(spark, monkeypatch):
    """No row of the join for each pair; equal and null users, owners held by some, and no owner."""
    monkeypatch.setattr(access, "USERS_OF_BLOCK", 50)
    rng = random.Random(9)
    groups = [f"g{i}" for i in range(6)]
    records = [(i % 50, rng.choice([None, "a-not-held", "z-not-held", *groups]), rng.choice([None, ["all", None], ["all", *rng.sample(groups, 2)]]))
               for i in range(80)]
    users = [(rng.choice([None, *"abcdefgh"]), rng.choice([None, ["all"], ["all", *rng.sample(groups, 2), None]])) for _ in range(120)]
    ds = spark.createDataFrame(records, "pid long, ownerGroup string, accessGroups array<string>")
    us = spark.createDataFrame(users, "user string, groups array<string>")
    out = access.visible(ds, us)
    want = []
    for u, held in users:
        own = {g for g in held or [] if g}
        want += [(u, p, True, o in own) for p, o, more in records if own & {o, *(more or [])} - {None}]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str) and len(want) > 1000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert -1 < plan.find("Generate inline") < plan.find("Join")  # the users of a block are listed after the last join


# ---------------------------------------------------------------- layouts

def test_events_by_job_are_not_shuffled(spark, tmp_path):
    events = spark.createDataFrame(some_events(2000, jobs=60), EVENTS)
    path = str(tmp_path / "events")
    table = layout.write_events_by_job(events, path, 8)
    assert len(glob.glob(f"{path}/*.parquet")) == 8
    ids = spark.createDataFrame([("j1",), ("j7",), ("nobody",)], "id string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = layout.lookup_indexed(spark, table, ids, tiebreak="event_id")
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    events_side = plan[plan.index("FileScan"):]
    above = [line for line in plan[:plan.index("FileScan")].splitlines() if "Exchange" in line]
    assert "Bucketed: true" in events_side and len(above) <= 2  # the ids are dealt to the buckets (and the answers to the ids)
    assert plan.count("FileScan") == 1
    want = J.lookup_events(events, ids, tiebreak="event_id")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    few = layout.find_jobs(spark, table, ["j5"], tiebreak="event_id")
    assert "SelectedBucketsCount: 1 out of 8" in few._jdf.queryExecution().executedPlan().toString()
    assert few.collect() == J.fold_jobs(events.where("id = 'j5'"), tiebreak="event_id").collect()


def test_every_ordering_of_a_clustered_table_prunes(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, T0 + dt.timedelta(minutes=rng.randrange(40_000)), rng.randrange(1000), rng.choice("abcdefgh") + str(rng.randrange(100))) for i in range(20_000)]
    df = spark.createDataFrame([*rows, (-1, None, None, None)], "k long, t timestamp_ntz, user int, name string")
    path = str(tmp_path / "z")
    layout.write_clustered(df, path, ["t", "user"], 64)
    assert sorted(map(str, spark.read.parquet(path).collect())) == sorted(map(str, df.collect()))

    def touched(column, low, high):
        groups = [pq.ParquetFile(f).metadata.row_group(g) for f in glob.glob(f"{path}/*.parquet") for g in range(pq.ParquetFile(f).num_row_groups)]
        at = groups[0].to_dict()["columns"].index(next(c for c in groups[0].to_dict()["columns"] if c["path_in_schema"] == column))
        spans = [g.column(at).statistics for g in groups]
        return sum(s.min <= high and s.max >= low for s in spans if s and s.has_min_max), len(groups)

    for column, low, high in (("t", T0 + dt.timedelta(minutes=20_000), T0 + dt.timedelta(minutes=21_000)), ("user", 500, 510)):
        read, files = touched(column, low, high)
        assert files >= 32 and read <= 0.4 * files, (column, read, files)
    layout.write_clustered(df.limit(0), str(tmp_path / "none"), ["t", "name"], 4)
    assert os.path.exists(str(tmp_path / "none"))
    layout.write_clustered(df, str(tmp_path / "names"), ["name", "user"], 8)
    assert spark.read.parquet(str(tmp_path / "names")).count() == 20_001
