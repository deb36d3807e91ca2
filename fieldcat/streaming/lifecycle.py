"""Lifecycle checks (T2) and job claims with leases (P9) as typed state of parts of the jobs.

Both are ``transformWithState`` processors in event time. A job's events wait in a list state
until the watermark (latest event time less the stream's delay) has passed them; an event-time
timer at the earliest one releases them, and they are then taken in (time, rank, event id)
order. So arrival order does not matter within the delay, a job's state is its last verdict and
the events of one delay, and a job that rests keeps a few fields only. An event that arrives
later than the delay is dropped, as event-time streams do.

The hash of its id puts a job in one of ``PARTS`` parts, which share state calls and timers: a
batch makes a few calls for each part, however many jobs it holds. State is kept in columns, a
list element or value for many events or jobs. A part's waiting events and job states must fit
a task's memory; more parts make them smaller. The number must not change while a checkpoint lives.

**Claims.** A job is claimed by compare-and-set on its folded state: an attempt is granted if
the job is submitted, or runs under a lease that has ended, and each grant raises the job's
fencing number. A final status is accepted from the holder of the present grant only, also
after its lease has ended if nobody has claimed the job since; one of an earlier holder, or of
a runner that never claimed, is refused. A heartbeat of the holder renews the lease. A
submission makes an ended job claimable again and does nothing to a running one.
"""

from __future__ import annotations

import datetime as dt
import itertools
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Processors travel by value, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TRANSITION_OUT = "id string, event_id long, time timestamp_ntz, prev_status string, status string, msg string"
CLAIM_OUT = "id string, event_id long, time timestamp_ntz, action string, runner string, granted boolean, fence long, holder string, reason string"

#: What an event does to a claim.
SUBMIT, CLAIM, RENEW, FINISH = "submit", "claim", "renew", "finish"
ORDER = {SUBMIT: 0, CLAIM: 1, RENEW: 2, FINISH: 3}
#: Parts of the jobs, by the hash of their ids, and the most events in an element of list state.
PARTS, BLOCK = 512, 10_000
RDD_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def typed_state(spark: SparkSession) -> None:
    """Several state variables for a key need the RocksDB store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", RDD_PROVIDER)


def _arrays(columns: str) -> str:
    """The schema of the same columns, each as an array."""
    return ", ".join(f"{name} array<{kind}>" for name, kind in map(str.split, columns.split(",")))


def _in_order(event: tuple) -> tuple:
    micros, rank, event_id = event[:3]
    return micros, rank, event_id is not None, event_id or 0


class InOrder(StatefulProcessor):
    """Hands a part's events to ``take`` in (micros, rank, event id) order once the watermark has
    passed them. Subclasses name the state of a job and the columns of a waiting event."""

    #: Columns of a waiting event after micros, rank, event_id and id.
    columns = "status string"
    #: Columns of a job's state after its id.
    job = "status string"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _arrays(f"micros long, rank int, event_id long, id string, {self.columns}"))
        self.jobs = handle.getValueState("jobs", _arrays(f"id string, {self.job}"))
        self.next = handle.getValueState("next", "at long")

    def event(self, row: Row) -> tuple:
        raise NotImplementedError

    def take(self, jobs: dict[str, tuple], events: list[tuple]) -> Iterator[Row]:
        """The rows of events of any of the part's jobs; sets the states of their ``jobs``."""
        raise NotImplementedError

    def _wake(self, at: int) -> None:
        self.handle.registerTimer(at)
        self.next.update((at,))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        events = (e for e in map(self.event, rows) if e[0] >= mark)  # later than the delay: dropped
        first = None
        while block := list(itertools.islice(events, BLOCK)):
            self.waiting.appendValue(tuple(map(list, zip(*block))))
            least = min(e[0] for e in block)
            first = least if first is None else min(first, least)
        if first is not None:
            at = max(first // 1000 + 1, mark // 1000 + 1)
            now = self.next.get()
            if now is None or at < now[0]:
                if now is not None:
                    self.handle.deleteTimer(now[0])
                self._wake(at)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        events = [e for block in self.waiting.get() for e in zip(*block)]
        ready = sorted((e for e in events if e[0] < mark), key=_in_order)
        left = [e for e in events if e[0] >= mark]
        if left:
            self.waiting.put([tuple(map(list, zip(*left[s:s + BLOCK]))) for s in range(0, len(left), BLOCK)])
            self._wake(max(min(e[0] for e in left) // 1000 + 1, mark // 1000 + 1))
        else:
            self.waiting.clear()
            self.next.clear()
        if ready:
            jobs = {job: state for job, *state in zip(*(self.jobs.get() or ()))}
            yield from self.take(jobs, ready)
            self.jobs.update(tuple(map(list, zip(*((job, *state) for job, state in jobs.items())))))


def _time(micros: int) -> dt.datetime:
    return dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=micros)


class Transitions(InOrder):
    """A row for each event whose status may not follow the one before."""

    def __init__(self, allowed: dict[str, list[str]], ranks: dict[str, int]):
        self.pairs = {(p, n) for p, nexts in allowed.items() for n in nexts}
        self.ranks = ranks

    def event(self, row: Row) -> tuple:
        return row.micros, self.ranks.get(row.status, 2), row.event_id, row.id, row.status

    def take(self, jobs: dict[str, tuple], events: list[tuple]) -> Iterator[Row]:
        for micros, _, event, job, status in events:
            before, = jobs.get(job, ("none",))
            if before is not None and status is not None and (before, status) not in self.pairs:
                yield Row(id=job, event_id=event, time=_time(micros), prev_status=before, status=status,
                          msg=f"invalid transition {before} -> {status}")
            jobs[job] = (status,)


class Claims(InOrder):
    """A row for each claim, renewal and final status: granted or refused, and why."""

    columns = "action string, runner string"
    #: status: none, submitted, running, ended
    job = "status string, holder string, fence long, until long"

    def __init__(self, lease: dt.timedelta):
        self.lease = int(lease.total_seconds() * 1_000_000)

    def event(self, row: Row) -> tuple:
        return row.micros, ORDER[row.action], row.event_id, row.id, row.action, row.runner

    def take(self, jobs: dict[str, tuple], events: list[tuple]) -> Iterator[Row]:
        for micros, _, event, job, action, runner in events:
            status, holder, fence, until = jobs.get(job, ("none", None, 0, 0))
            reason = None
            if action == SUBMIT:
                if status in ("none", "ended"):
                    status, holder = "submitted", None
            elif action == CLAIM:
                if status == "none":
                    reason = "not submitted"
                elif status == "ended":
                    reason = "already ended"
                elif status == "running" and micros < until:
                    reason = "held"
                else:
                    status, holder, fence, until = "running", runner, fence + 1, micros + self.lease
            elif status != "running":
                reason = "not running"
            elif runner != holder:
                reason = "not the holder"
            elif action == RENEW:
                until = micros + self.lease
            else:
                status = "ended"
            jobs[job] = (status, holder, fence, until)
            if action != SUBMIT:
                yield Row(id=job, event_id=event, time=_time(micros), action=action, runner=runner, granted=reason is None, fence=fence,
                          holder=holder, reason=reason)


def _timed(events: DataFrame, delay: str, *columns: str) -> DataFrame:
    # wall-clock micros, so that no session time zone moves an event
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", epoch, F.col("time").cast("timestamp_ntz"))
    part = F.pmod(F.xxhash64("id"), F.lit(PARTS)).cast("int").alias("part")
    return events.select(part, "id", "event_id", F.timestamp_micros(micros).alias("at"), micros.alias("micros"), *columns).withWatermark("at", delay)


def transitions(events: DataFrame, delay: str) -> DataFrame:
    """(id, event_id, time, prev_status, status, msg) of a stream of job events (id, event_id,
    time, status): those that no allowed transition leads to."""
    from fieldcat.schemas import ALLOWED_TRANSITIONS, STATUS_RUNNING, STATUS_SUBMITTED

    typed_state(events.sparkSession)
    return _timed(events, delay, "status").groupBy("part").transformWithState(
        Transitions(ALLOWED_TRANSITIONS, {STATUS_SUBMITTED: 0, STATUS_RUNNING: 1}), TRANSITION_OUT, "append", "EventTime")


def claims(events: DataFrame, delay: str, lease: dt.timedelta) -> DataFrame:
    """The verdicts over a stream of (id, event_id, time, action, runner)."""
    typed_state(events.sparkSession)
    return _timed(events, delay, "action", "runner").groupBy("part").transformWithState(Claims(lease), CLAIM_OUT, "append", "EventTime")
