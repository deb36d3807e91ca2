"""Ingest jobs as tables: admission (J3, S5), the state fold over status
events (A3, A4, S10), lookups (P7, P8, K1, E2), registry match (J2), final
status and log (A1, A2) and the status timeline (E1, F17)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcat.functions.ids import utc_now
from fieldcat.functions.issues import issue
from fieldcat.operators.buckets import read_buckets, upsert_buckets
from fieldcat.operators.ordering import group_row_number
from fieldcat.schemas import (
    PENDING_STATUSES, SEVERITY_ERROR, SEVERITY_WARNING, STATUS_COMPLETE_WITH_ISSUES,
    STATUS_ERROR, STATUS_RUNNING, STATUS_SUBMITTED, STATUS_SUCCESSFUL, TERMINAL_STATUSES,
    status_rank,
)


# --- admission ---------------------------------------------------------------

def admit(requests: DataFrame, clients: DataFrame, key_col: str = "api_key",
          check_api: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Requests whose key digest matches a client (client name becomes the
    submitter), and the rejected rest. Keys are compared as SHA-256 digests
    by equi-join; Spark broadcasts the client side only when its measured
    size is under the broadcast threshold (AQE), else it shuffles. A digest
    listed for several APIs admits a request once, under the least client name."""
    by = ["key_digest", "api"] if check_api else ["key_digest"]
    clients = clients.groupBy(*by).agg(F.min("client").alias("client"))
    req = requests.withColumn("_digest", F.sha2(F.col(key_col), 256))
    cl = clients.select(F.col("key_digest").alias("_digest"), F.col("client").alias("_client"),
                        (F.col("api") if check_api else F.lit(None).cast("string")).alias("_api"))
    cond = [req["_digest"] == cl["_digest"]]
    if check_api:
        cond.append(F.col(check_api) == F.col("_api"))
    accepted = (req.join(cl, cond, "inner").drop(cl["_digest"])
                .withColumn("submitter", F.col("_client"))
                .drop("_digest", "_client", "_api", key_col))
    rejected = req.join(cl, cond, "left_anti").drop("_digest", key_col)
    return accepted, rejected


def check_types(requests: DataFrame, allowed: list[str], col: str = "ingest_types",
                stage: str = "submit") -> tuple[DataFrame, DataFrame]:
    """Requests whose ingest types are all among ``allowed`` (null or none
    asked for: all of them), and the rest with an error ``issue``."""
    bad = F.array_except(F.coalesce(F.col(col), F.array().cast("array<string>")), F.array(*[F.lit(a) for a in allowed]))
    checked = requests.withColumn("_bad", bad)
    msg = F.concat(F.lit("unknown ingest types "), F.array_join("_bad", ","))
    return (checked.where(F.size("_bad") == 0).drop("_bad"),
            checked.where(F.size("_bad") > 0).withColumn("issue", issue(SEVERITY_ERROR, msg, stage)).drop("_bad"))


def initial_events(accepted: DataFrame, now=None) -> DataFrame:
    """One ``submitted`` status event per accepted request. ``id`` is the
    natural id of the request key (replays do not create second jobs)."""
    t = now if now is not None else F.current_timestamp()
    return accepted.select(
        F.col("id"), (F.col("submit_time") if "submit_time" in accepted.columns else t).alias("time"),
        F.lit(STATUS_SUBMITTED).alias("status"), F.col("submitter"),
        F.lit(None).cast("string").alias("log"))


# --- state fold ----------------------------------------------------------------

def _order(time="time", status="status", tiebreak: str | None = None):
    parts = [F.col(time), status_rank(F.col(status))]
    if tiebreak:
        parts.append(F.col(tiebreak))
    return F.struct(*parts)


def fold_jobs(events: DataFrame, key: str = "id", tiebreak: str | None = None) -> DataFrame:
    """Current state of every job from its status events.

    status / time / last actor = the last event by (time, status rank,
    tiebreak); submit_time and submitter from the first ``submitted`` event;
    start_time = first ``running``; end_time = first terminal event. All are
    partial aggregates (min / max / max_by), so a job with very many events
    is combined map-side, never gathered into one task. Each column is an
    aggregate of its own, so columns that a result does not use are pruned."""
    o = _order(tiebreak=tiebreak)
    is_sub = F.col("status") == STATUS_SUBMITTED
    return (events.groupBy(key).agg(
        F.max_by("status", o).alias("_status"), F.max_by("time", o).alias("status_time"),
        F.max_by("submitter", o).alias("last_actor"), F.max_by("log", o).alias("last_log"),
        F.min(F.when(is_sub, F.col("time"))).alias("submit_time"),
        F.min_by(F.col("submitter"), F.when(is_sub, o)).alias("submitter"),
        F.min(F.when(F.col("status") == STATUS_RUNNING, F.col("time"))).alias("start_time"),
        F.min(F.when(F.col("status").isin(TERMINAL_STATUSES), F.col("time"))).alias("end_time"),
        F.count(F.lit(1)).alias("n_events"),
    ).select(key, F.col("_status").alias("status"), "status_time", "submit_time", "start_time", "end_time",
             "submitter", "last_actor", "last_log", "n_events"))


def fold_state(events: DataFrame, key: str = "id", tiebreak: str | None = None) -> DataFrame:
    """The fold as mergeable state, one row per job: the last event, the first submission, the
    earliest start and end, the number of events (A3 kept up to date)."""
    o = _order(tiebreak=tiebreak)
    is_sub = F.col("status") == STATUS_SUBMITTED
    last = F.struct(o.alias("o"), F.col("status"), F.col("time"), F.col("submitter"), F.col("log"))
    return merge_states(events.select(
        key, last.alias("last"), F.when(is_sub, F.struct(o.alias("o"), F.col("submitter"))).alias("submitted"),
        F.when(is_sub, F.col("time")).alias("submit_time"),
        F.when(F.col("status") == STATUS_RUNNING, F.col("time")).alias("start_time"),
        F.when(F.col("status").isin(TERMINAL_STATUSES), F.col("time")).alias("end_time"), F.lit(1).cast("bigint").alias("n_events")), key)


def merge_states(states: DataFrame, key: str = "id") -> DataFrame:
    """One state per job from any number of states of disjoint events, in any order."""
    return states.groupBy(key).agg(
        F.max_by("last", F.col("last.o")).alias("last"), F.min_by("submitted", F.col("submitted.o")).alias("submitted"),
        *[F.min(c).alias(c) for c in ("submit_time", "start_time", "end_time")], F.sum("n_events").alias("n_events"))


def jobs_of_states(states: DataFrame, key: str = "id") -> DataFrame:
    """The columns of ``fold_jobs`` from merged states."""
    return states.select(key, F.col("last.status").alias("status"), F.col("last.time").alias("status_time"), "submit_time", "start_time", "end_time",
                         F.col("submitted.submitter").alias("submitter"), F.col("last.submitter").alias("last_actor"),
                         F.col("last.log").alias("last_log"), "n_events")


def update_jobs(events: DataFrame, path: str, batch_id: int, n_buckets: int, key: str = "id", tiebreak: str | None = None) -> list[int]:
    """Fold new events into the state table at ``path``: only the key buckets of the jobs that
    have new events are read and rewritten. Each event may come in one batch only."""
    return upsert_buckets(fold_state(events, key, tiebreak), path, key, batch_id, n_buckets, combine=lambda x: merge_states(x, key))


def read_jobs(spark, path: str, key: str = "id") -> DataFrame:
    return jobs_of_states(read_buckets(spark, path), key)


def job_history(events: DataFrame, key: str = "id", tiebreak: str | None = None,
                previous: dict[str, str] | None = None) -> DataFrame:
    """The status history in long form: one row per event with its 1-based
    position ``pos`` in (time, status rank, tiebreak) order. Long form keeps
    a job with a huge history spread over many tasks."""
    ev = events.withColumn("_rank", status_rank(F.col("status")))
    order = ["time", "_rank"] + ([tiebreak] if tiebreak else [])
    numbered = group_row_number(ev, [key], order, rn="pos", n="history_len", previous=previous)
    return numbered.drop("_rank")


def orphan_events(events: DataFrame, jobs: DataFrame, key: str = "id") -> DataFrame:
    """Status events for unknown jobs: they change nothing and are reported."""
    return events.join(jobs.select(key), key, "left_anti")


# --- lookups -------------------------------------------------------------------

def lookup(jobs: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Every asked id with ``found`` and, when found, the job's status."""
    j = jobs.select(key, "status").withColumn("_found", F.lit(True))
    return (ids.select(key).join(j, key, "left")
            .select(key, F.coalesce("_found", F.lit(False)).alias("found"), "status"))


def lookup_events(events: DataFrame, ids: DataFrame, key: str = "id", tiebreak: str | None = None) -> DataFrame:
    """``lookup`` straight from the status events: only the asked jobs' events
    are folded."""
    asked = events.join(ids.select(key), key, "left_semi")
    return lookup(fold_jobs(asked, key=key, tiebreak=tiebreak), ids, key)


def job_records(requests: DataFrame, events: DataFrame, key: str = "id", tiebreak: str | None = None) -> DataFrame:
    """Every request with its current state and its ordered history: one row
    per (job, history item), ``pos`` null for a job without events. Long form
    keeps a job with a huge history spread over many tasks."""
    state = fold_jobs(events, key=key, tiebreak=tiebreak)
    items = job_history(events, key=key, tiebreak=tiebreak).select(
        key, "pos", F.col("time").alias("item_time"), F.col("status").alias("item_status"), F.col("submitter").alias("item_actor"))
    return requests.join(state.drop("submitter", "submit_time", "last_log"), key, "left").join(items, key, "left")


def unstarted(jobs: DataFrame) -> DataFrame:
    return jobs.where(F.col("status") == STATUS_SUBMITTED)


def next_jobs(jobs: DataFrame, n: int = 1, key: str = "id") -> DataFrame:
    """The next unstarted job(s): latest submit time first, then id (a top-k;
    Spark plans it as TakeOrderedAndProject, a bounded per-task heap)."""
    return unstarted(jobs).orderBy(F.col("submit_time").desc(), F.col(key).desc()).limit(n)


def pending(jobs: DataFrame) -> DataFrame:
    return jobs.where(F.col("status").isin(PENDING_STATUSES))


def finished(jobs: DataFrame) -> DataFrame:
    return jobs.where(F.col("status").isin(TERMINAL_STATUSES))


def phase(jobs: DataFrame) -> DataFrame:
    return jobs.withColumn("phase", F.when(F.col("status").isin(PENDING_STATUSES), F.lit("pending"))
                           .otherwise(F.lit("terminal")))


# --- registry, final status, log ---------------------------------------------------

def match_registry(jobs: DataFrame, specs, mapping_col: str = "mapping_id",
                   path_col: str = "document_path", stage: str = "ingest") -> DataFrame:
    """Adds ``registered`` and, for jobs whose mapping has no ingestor, an
    error ``issue``. ``specs`` is the ingestor registry: a list of spec
    names (a literal IN predicate, no join) or a DataFrame with a ``spec``
    column (a broadcast left join; registries are small by nature)."""
    msg = F.concat(F.lit("mapping is not configured "), F.col(path_col),
                   F.lit(" and mapping "), F.col(mapping_col))
    if isinstance(specs, (list, tuple, set)):
        out = jobs.withColumn("registered", F.coalesce(F.col(mapping_col).isin(list(specs)), F.lit(False)))
    else:
        reg = F.broadcast(specs.select(F.col("spec").alias("_spec")).distinct())
        out = (jobs.join(reg, F.col(mapping_col) == F.col("_spec"), "left")
               .withColumn("registered", F.col("_spec").isNotNull()).drop("_spec"))
    return out.withColumn("issue", F.when(~F.col("registered"), issue(SEVERITY_ERROR, msg, stage)))


def final_status(jobs: DataFrame, issues: DataFrame, key: str = "job_id") -> DataFrame:
    """error if any error issue, complete_with_issues if any issue,
    successful otherwise. Issue-free jobs come through the left join."""
    sev = (issues.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_issues"),
        F.sum(F.when(F.col("issue.severity") == SEVERITY_ERROR, 1).otherwise(0)).cast("bigint").alias("n_errors"),
        F.sum(F.when(F.col("issue.severity") == SEVERITY_WARNING, 1).otherwise(0)).cast("bigint").alias("n_warnings")))
    j = jobs.select(key).join(sev, key, "left").na.fill(0, ["n_issues", "n_errors", "n_warnings"])
    status = (F.when(F.col("n_errors") > 0, F.lit(STATUS_ERROR))
              .when(F.col("n_issues") > 0, F.lit(STATUS_COMPLETE_WITH_ISSUES))
              .otherwise(F.lit(STATUS_SUCCESSFUL)))
    return j.select(key, status.alias("status"), "n_issues", "n_errors", "n_warnings")


def job_log(jobs: DataFrame, issues: DataFrame, key: str = "job_id", path_col: str = "file_path",
            dataset_col: str = "dataset_id") -> DataFrame:
    """'ingested dataset: <path> as <id>', then per issue (in ``seq`` order)
    a line ' :  <msg>' and, when there is one, '    Exception: <text>'.
    Issues per job are bounded by the requested keys plus one."""
    line = F.concat(
        F.lit("\n :  "), F.col("issue.msg"),
        F.when(F.col("issue.exception").isNotNull(),
               F.concat(F.lit("\n    Exception: "), F.col("issue.exception"))).otherwise(F.lit("")))
    per_job = (issues.groupBy(key)
               .agg(F.array_sort(F.collect_list(F.struct(F.col("seq"), line.alias("line")))).alias("_lines")))
    head = F.concat(F.lit("ingested dataset: "), F.col(path_col), F.lit(" as "),
                    F.coalesce(F.col(dataset_col), F.lit("None")))
    body = F.coalesce(F.array_join(F.transform("_lines", lambda x: x["line"]), ""), F.lit(""))
    return (jobs.select(key, path_col, dataset_col).join(per_job, key, "left")
            .select(key, F.concat(head, body).alias("log")))


def status_timeline(history: DataFrame, key: str = "id") -> DataFrame:
    """One row per log line of every history item; a log splits on newlines
    and on the two characters backslash-n."""
    lines = F.split(F.col("log"), r"\n|\\n")
    return history.where(F.col("log").isNotNull()).select(
        key, "pos", "time", "status", F.posexplode(lines).alias("line_no", "line"))


def issue_col(severity: str, msg: str, stage: str):
    return issue(severity, msg, stage).alias("issue")


def overdue(jobs: DataFrame, wait_seconds: int = 180) -> DataFrame:
    """Unfinished jobs whose last status is older than a client waits (F15)."""
    return pending(jobs).where(F.col("status_time").cast("timestamp") < utc_now() - F.make_dt_interval(secs=F.lit(wait_seconds)))


# --- state machine -------------------------------------------------------------------

def _allowed(prev, status):
    from fieldcat.schemas import ALLOWED_TRANSITIONS
    cond = F.lit(False)
    for p, nexts in ALLOWED_TRANSITIONS.items():
        if nexts:
            cond = cond | ((prev == F.lit(p)) & status.isin(nexts))
    return cond


def transition_issues(events: DataFrame, key: str = "id", tiebreak: str | None = None,
                      stage: str = "lifecycle") -> DataFrame:
    """Every status event that breaks the job lifecycle (submitted ->
    running -> terminal, error allowed from any non-terminal state, nothing
    after a terminal state), with the status it followed.

    The status before comes with the skew-safe row numbering (``lag`` inside
    a piece, the last status of the piece before at its border), so events
    are neither numbered twice nor joined to themselves."""
    j = job_history(events, key=key, tiebreak=tiebreak, previous={"prev_status": "status"})
    j = j.withColumn("prev_status", F.when(F.col("pos") == 1, F.lit("none")).otherwise(F.col("prev_status")))
    bad = j.where(~_allowed(F.col("prev_status"), F.col("status")))
    msg = F.concat(F.lit("invalid transition "), F.col("prev_status"), F.lit(" -> "), F.col("status"))
    return bad.withColumn("issue", issue(SEVERITY_WARNING, msg, stage))
