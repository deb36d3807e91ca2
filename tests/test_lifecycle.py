"""Typed state per job: claims with leases and transitions, in any order of arrival."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fieldcat.operators import jobs as J
from fieldcat.streaming import jobs as S
from fieldcat.streaming import lifecycle as L

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id string, time timestamp_ntz, action string, runner string, event_id long"
LEASE = dt.timedelta(hours=2)


def plain_claims(events):
    """The rules, one event at a time."""
    jobs, out = {}, []
    for job, time, action, runner, event in sorted(events, key=lambda e: (e[1], L.ORDER[e[2]], e[4])):
        j = jobs.setdefault(job, {"status": "none", "holder": None, "fence": 0, "until": T0})
        why = None
        if action == "submit":
            if j["status"] != "submitted" and j["status"] != "running":
                j.update(status="submitted", holder=None)
            continue
        if action == "claim":
            why = {"none": "not submitted", "ended": "already ended"}.get(j["status"])
            if j["status"] == "running" and time < j["until"]:
                why = "held"
            if why is None:
                j.update(status="running", holder=runner, fence=j["fence"] + 1, until=time + LEASE)
        elif j["status"] != "running":
            why = "not running"
        elif j["holder"] != runner:
            why = "not the holder"
        elif action == "renew":
            j["until"] = time + LEASE
        else:
            j["status"] = "ended"
        out.append((job, event, action, runner, why is None, j["fence"], j["holder"], why))
    return sorted(out)


def run(spark, tmp_path, drops, name="q", closing=True):
    """The verdicts of a stream that is started anew for each drop."""
    path = str(tmp_path / name)
    if closing:
        drops = [*drops, [("last", T0 + dt.timedelta(days=30), "submit", "r", -1)]]
    for drop in drops:
        S.stage_files(spark.createDataFrame(drop, SCHEMA), f"{path}/in", ["event_id"])
        q = S.claim_stream(S.read_files(spark, f"{path}/in", SCHEMA), f"{path}/out", f"{path}/ck", "1 day", LEASE, "availableNow")
        q.awaitTermination()
    rows = spark.read.schema(L.CLAIM_OUT).parquet(f"{path}/out").collect()
    return sorted((r.id, r.event_id, r.action, r.runner, r.granted, r.fence, r.holder, r.reason) for r in rows), q


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def test_a_dead_runners_job_is_taken_again_and_its_late_write_refused(spark, tmp_path):
    events = [("j", at(0), "submit", "u", 1), ("j", at(1), "claim", "a", 2), ("j", at(2), "claim", "b", 3), ("j", at(4), "claim", "b", 4),
              ("j", at(5), "finish", "a", 5), ("j", at(5.5), "renew", "b", 6), ("j", at(7), "claim", "c", 7), ("j", at(8), "finish", "b", 8),
              ("j", at(9), "claim", "c", 9), ("j", at(10), "submit", "u", 10), ("j", at(11), "claim", "c", 11), ("x", at(1), "claim", "a", 12)]
    got, _ = run(spark, tmp_path, [events])
    verdict = {r[1]: (r[4], r[5], r[6], r[7]) for r in got}
    assert verdict[2] == (True, 1, "a", None) and verdict[3] == (False, 1, "a", "held")
    assert verdict[4] == (True, 2, "b", None) and verdict[5] == (False, 2, "b", "not the holder")
    assert verdict[6] == (True, 2, "b", None) and verdict[7] == (False, 2, "b", "held") and verdict[8][0]
    assert verdict[9] == (False, 2, "b", "already ended") and verdict[11] == (True, 3, "c", None)
    assert verdict[12] == (False, 0, None, "not submitted") and got == plain_claims(events)


def test_arrival_order_and_restarts_do_not_matter_within_the_delay(spark, tmp_path):
    rng = random.Random(5)
    events = [(f"j{rng.randrange(6)}", at(rng.randrange(0, 20 * 24 * 4) / 4), rng.choice(list(L.ORDER)), rng.choice("ab"), i) for i in range(600)]
    days = {}
    for e in events:  # a drop holds a day, in no order, and half of it comes a drop late
        days.setdefault((e[1] - T0).days + (e[4] % 2 == 0 and (e[1] - T0).seconds > 43200), []).append(e)
    for d in days.values():
        rng.shuffle(d)
    got, q = run(spark, tmp_path, [days[d] for d in sorted(days)])
    assert got == plain_claims(events)
    # what is left in the state: the closing event, and a verdict for each job
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4 * (6 + 1)


def test_an_event_later_than_the_delay_is_dropped(spark, tmp_path):
    drops = [[("j", at(0), "submit", "u", 1), ("j", at(1), "claim", "a", 2)], [("k", at(100), "submit", "u", 3)], [("j", at(2), "finish", "a", 4)]]
    got, _ = run(spark, tmp_path, drops)
    assert [r[1] for r in got] == [2]


@pytest.mark.parametrize("seed", [1, 2])
def test_transitions_equal_the_batch_check(spark, tmp_path, seed):
    rng = random.Random(seed)
    schema = "id string, event_id long, time timestamp_ntz, status string, submitter string, log string"
    statuses = ["submitted", "running", "successful", "error", "complete_with_issues"]
    events = [(f"j{rng.randrange(5)}", i, at(rng.randrange(0, 60)), rng.choice(statuses), "u", None) for i in range(300)]
    path = str(tmp_path / "t")
    for drop in (events[:150], events[150:], [("last", -1, at(1000), None, "u", None)]):
        S.stage_files(spark.createDataFrame(drop, schema), f"{path}/in", ["event_id"])
        S.transition_stream(S.read_files(spark, f"{path}/in", schema), f"{path}/out", f"{path}/ck", "10 days", "availableNow").awaitTermination()
    got = sorted((r.id, r.event_id, r.prev_status, r.status) for r in spark.read.schema(S.TRANSITION_OUT).parquet(f"{path}/out").collect())
    batch = J.transition_issues(spark.createDataFrame(events, schema), tiebreak="event_id")
    assert got == sorted((r.id, r.event_id, r.prev_status, r.status) for r in batch.select("id", F.col("event_id"), "prev_status", "status").collect())


def test_jobs_share_the_state_of_their_part(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(L, "PARTS", 3, raising=False)
    monkeypatch.setattr(L, "BLOCK", 16, raising=False)
    rng = random.Random(8)
    events = [(f"j{rng.randrange(60)}", at(rng.randrange(0, 300) / 4), rng.choice(list(L.ORDER)), rng.choice("ab"), i) for i in range(900)]
    drops = [[e for e in events if (e[1] - T0).days // 2 == d] for d in range(2)]
    got, q = run(spark, tmp_path, drops, closing=False)
    assert {r[1] for r in got} <= {e[4] for e in events}
    # jobs, next, a timer's two rows, and waiting blocks: far less than a row for each job
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3 * (1 + 1 + 2) + 900 // 16
    got, q = run(spark, tmp_path, [[("last", T0 + dt.timedelta(days=30), "submit", "r", -1)]], closing=False)
    assert got == plain_claims(events)
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3 + 4
