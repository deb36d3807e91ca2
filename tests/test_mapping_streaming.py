"""Mapping documents and the streaming jobs (replays, restarts, upsert)."""

import json
import os

from pyspark.sql import functions as F

from fieldcat.operators import jobs as J, mapping as mp, sinks
from fieldcat.operators.registry import IngestResult, Registry
from fieldcat.schemas import FIELDS
from fieldcat.session import scratch_dir
from fieldcat.sources.mapping import RESOURCE_DIR, load_mapping, packaged_mapping
from fieldcat.streaming import jobs as S

from conftest import SF_SMALL


def test_mapping_tables(spark):
    m = packaged_mapping(spark)
    assert sorted(r.field for r in m.md_fields.collect()) == ["/doc/lang", "/doc/n_chars", "/doc/source", "/doc/title"]
    conf = sorted((r.device, r.field) for r in m.conf_fields.collect())
    assert conf == [("doc", "/doc/n_chars"), ("labels", "/labels/quality"), ("labels", "/labels/toxic")]
    ev = {r.field: r.external for r in m.event_fields.collect()}
    assert ev == {"/vec/frame": True, "/vec/embedding": False, "/vec/positive": False}
    unresolved = sorted(r.out_name for r in mp.unresolved_projections(m).collect())
    assert unresolved == ["author"]
    # the same document read from storage with the declared schema
    m2 = load_mapping(spark, os.path.join(RESOURCE_DIR, "doc_mapping.json"))
    assert m2.projections.count() == m.projections.count() == 6


def test_event_rows_pad_and_warn(spark):
    m = packaged_mapping(spark)
    rows = [
        ("f1", "/vec/index", "f", [3], [3], None, None, [0.0, 1.0, 2.0]),
        ("f1", "/vec/embedding", "f", [3], [3], None, None, [5.0, 6.0, 7.0]),
        ("f1", "/vec/positive", "f", [4], [4], None, None, [1.0, 2.0, 3.0, 4.0]),
        ("f2", "/vec/index", "f", [2], [2], None, None, [0.0, 1.0]),
        ("f2", "/vec/embedding", "f", [1], [1], None, None, [9.0]),
    ]
    ev, issues = mp.event_rows(spark.createDataFrame(rows, FIELDS), m)
    got = sorted(tuple(r) for r in ev.collect())
    assert got == [("f1", 0, 0.0, 5.0, 1.0), ("f1", 1, 1.0, 6.0, 2.0), ("f1", 2, 2.0, 7.0, 3.0),
                   ("f2", 0, 0.0, 9.0, None), ("f2", 1, 1.0, None, None)]
    msgs = sorted((r.file_path, r.field) for r in issues.collect())
    assert msgs == [("f1", "/vec/positive"), ("f2", "/vec/embedding")]


def test_upsert_replay_is_idempotent(spark):
    root = scratch_dir(spark, "test-upsert")
    v1 = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "pid string, v int, val string")
    v2 = spark.createDataFrame([("a", 2, "x2")], "pid string, v int, val string")
    sinks.upsert_batch(v1, root, 0)
    sinks.upsert_batch(v2, root, 1)
    sinks.upsert_batch(v2, root, 1)  # a replayed batch replaces itself
    cur = sorted(tuple(r) for r in sinks.read_latest(sinks.read_batches(spark, root), "pid", ["v"]).collect())
    assert cur == [("a", 2, "x2"), ("b", 1, "y")]
    snap = sinks.compact(spark, root, "pid", scratch_dir(spark, "test-snap"), ["v"])
    assert snap.count() == 2


def test_job_state_stream_restart_equals_batch(spark):
    from fieldcat.operators.jobs import fold_jobs
    from fieldcat.plans import adapters as ad
    root = scratch_dir(spark, "test-state")
    events = ad.job_events(spark, SF_SMALL)
    S.stage_files(events, f"{root}/in", ["time", "event_id"])
    src = S.read_files(spark, f"{root}/in", events.schema, max_files=1)
    S.job_state_stream(src, f"{root}/out", f"{root}/ck", "availableNow", tiebreak="event_id").awaitTermination()
    # more files arrive; the restarted query resumes from its checkpoint
    S.stage_files(events.where("status = 'running'"), f"{root}/in", ["time", "event_id"])
    src = S.read_files(spark, f"{root}/in", events.schema, max_files=1)
    S.job_state_stream(src, f"{root}/out", f"{root}/ck", "availableNow", tiebreak="event_id").awaitTermination()
    got = S.job_states(spark, f"{root}/out").drop("n_events")
    want = fold_jobs(events.unionByName(events.where("status = 'running'")), tiebreak="event_id").drop("n_events")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_ingest_stream_claims_once_and_isolates_failures(spark):
    calls = []

    def ingest(jobs, ctx):
        calls.append(1)
        ds = jobs.select("job_id", F.sha2("document_path", 256).alias("pid"))
        issues = jobs.where(F.col("document_path").contains("warn")).select(
            "job_id", F.lit(0).alias("seq"),
            F.struct(F.lit("x").alias("stage"), F.lit("warning").alias("severity"),
                     F.lit("w").alias("msg"), F.lit(None).cast("string").alias("exception")).alias("issue"))
        return IngestResult(ds, issues)

    reg = Registry()
    assert reg.register("spec", ingest) and not reg.register("spec", ingest)
    root = scratch_dir(spark, "test-ingest")
    reqs = spark.createDataFrame([("j1", "/a.h5", "spec"), ("j2", "/warn.h5", "spec"),
                                  ("j3", "/c.h5", "nope"), ("j4", None, "spec")],
                                 "job_id string, document_path string, mapping_id string")
    reqs.write.parquet(f"{root}/in")
    reqs.where("job_id = 'j1'").write.mode("append").parquet(f"{root}/in")  # replay
    src = S.read_files(spark, f"{root}/in", reqs.schema, max_files=1)
    S.run_stream(src, reg, None, f"{root}/ev", f"{root}/ck", trigger="availableNow").awaitTermination()
    ev = sinks.read_batches(spark, f"{root}/ev")
    got = {r.job_id: r.status for r in ev.collect()}
    assert got == {"j1": "successful", "j2": "complete_with_issues", "j3": "error", "j4": "error"}
    assert ev.count() == 4  # the replayed j1 was not run again


def test_field_table_roundtrip(spark):
    from fieldcat.plans import adapters as ad
    from fieldcat.sources.fields import read_fields, write_fields
    path = scratch_dir(spark, "test-fields")
    write_fields(ad.doc_fields(spark, SF_SMALL, ["/doc/lang", "/labels/quality"]), path)
    f = read_fields(spark, path, ["/labels/quality"])
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "key" in plan
    assert f.count() == spark.read.parquet(f"{SF_SMALL}/labels.parquet").count()


def test_extract_fields_from_files(spark, tmp_path):
    import numpy as np
    from fieldcat.operators import fields as fld
    from fieldcat.sources.readers import extract_fields
    np.savez(tmp_path / "a.npz", **{
        "measurement/sample/name": np.array(b"my sample", dtype="|S256"),
        "measurement/sample/position_x": np.array([1.0, 2.0]),
        "exchange/data": np.arange(3 * 16 * 9, dtype=np.int16).reshape(3, 16, 9),
        "process/count": np.array([7], dtype=np.int64),
    })
    np.savez(tmp_path / "b.npz", **{"measurement/sample/name": np.array([b"x", b"y", b"z"])})
    (tmp_path / "broken.npz").write_bytes(b"not an archive")
    keys = ["/measurement/sample/name", "/measurement/sample/position_x", "/process/count", "/missing"]
    f = extract_fields(spark, str(tmp_path), keys, glob="*.npz")
    norm = {(r.file_path.split("/")[-1], r.key): r for r in fld.normalise(f).collect()}
    a = norm[("a.npz", "/measurement/sample/name")]
    assert a.value_kind == "string" and a.str_value == "my sample"
    assert norm[("a.npz", "/measurement/sample/position_x")].dbl_array == [1.0, 2.0]
    assert norm[("a.npz", "/process/count")].int_value == 7
    assert norm[("b.npz", "/measurement/sample/name")].str_array == ["x", "y", "z"]
    assert not any(k[1] == "/exchange/data" for k in norm)  # not requested, not read into rows
    files = spark.read.format("binaryFile").load(str(tmp_path)).select(F.col("path").alias("file_path"))
    miss = fld.missing_issues(files, f, keys).collect()
    assert {(m.file_path.split("/")[-1], m.key) for m in miss} >= {("broken.npz", "/missing"), ("a.npz", "/missing")}


def test_start_doc_json_and_job_sources(spark, tmp_path):
    import json as _json
    from fieldcat.sources.jobs import load_clients, read_job_requests
    m = packaged_mapping(spark)
    norm = spark.createDataFrame([("f", "/doc/lang", "en"), ("f", "/doc/source", "s1"), ("f", "/other", "x")],
                                 "file_path string, key string, value_text string")
    js = mp.start_doc_json(mp.start_docs(norm, m)).first().start_doc
    assert _json.loads(js) == {"/doc/lang": "en", "/doc/source": "s1"}
    req = tmp_path / "req.json"
    req.write_text('{"id": "j1", "submitter": "user1", "document_path": "/foo/bar.hdf5", '
                   '"mapping_id": "magrathia_42", "ingest_types": ["databroker"], '
                   '"submit_time": "2024-01-01T00:00:00"}\n')
    r = read_job_requests(spark, str(req), fmt="json").first()
    assert r.document_path == "/foo/bar.hdf5" and r.ingest_types == ["databroker"]
    cpath = str(tmp_path / "clients")
    spark.createDataFrame([("d", "sirius_cybernetics_gpp", "door_operation")],
                          "key_digest string, client string, api string").write.parquet(cpath)
    assert load_clients(spark, cpath).first().client == "sirius_cybernetics_gpp"


def test_mapping_text_and_storage_readers_agree(spark):
    m1 = packaged_mapping(spark)
    m2 = load_mapping(spark, os.path.join(RESOURCE_DIR, "doc_mapping.json"))
    for attr in ["md_fields", "conf_fields", "event_fields", "streams", "projections"]:
        a, b = getattr(m1, attr), getattr(m2, attr)
        cols = sorted(a.columns)
        assert cols == sorted(b.columns), attr
        ra = sorted(tuple(r) for r in a.select(*cols).collect())
        rb = sorted(tuple(r) for r in b.select(*cols).collect())
        assert ra == rb, attr
    for kind in ["md", "conf", "event", "external", "time_stamp"]:
        assert m1.keys(kind) == m2.keys(kind), kind
    assert sorted(m1.keys("projection")) == sorted(m2.keys("projection"))


def test_ingest_stream_survives_a_crash_mid_batch(spark, monkeypatch):
    """The catalogue write of a batch fails once, after that batch's events
    were written. The restarted query re-runs the batch from its checkpoint:
    every job ends up recorded exactly once."""
    import pytest as _pytest
    from pyspark.errors import StreamingQueryException

    def ingest(jobs, ctx):
        ds = jobs.select("job_id", F.sha2("document_path", 256).alias("pid"))
        none = jobs.select("job_id", F.lit(0).alias("seq"), F.lit(None).cast(
            "struct<stage:string,severity:string,msg:string,exception:string>").alias("issue")).where("false")
        return IngestResult(ds, none)

    reg = Registry()
    reg.register("spec", ingest)
    root = scratch_dir(spark, "test-crash")
    reqs = spark.createDataFrame([(f"j{i}", f"/f{i}.h5", "spec") for i in range(20)],
                                 "job_id string, document_path string, mapping_id string")
    reqs.where("job_id < 'j2'").write.parquet(f"{root}/in")
    reqs.where("job_id >= 'j2'").write.mode("append").parquet(f"{root}/in")

    real = sinks.upsert_batch
    calls = {"n": 0}

    def flaky(df, path, batch_id):
        calls["n"] += 1
        if calls["n"] == 2:
            raise RuntimeError("executor lost")
        real(df, path, batch_id)

    monkeypatch.setattr(S.sinks, "upsert_batch", flaky)
    src = S.read_files(spark, f"{root}/in", reqs.schema, max_files=1)
    q = S.run_stream(src, reg, None, f"{root}/ev", f"{root}/ck", catalog_dir=f"{root}/cat", trigger="availableNow")
    with _pytest.raises(StreamingQueryException):
        q.awaitTermination()
    src = S.read_files(spark, f"{root}/in", reqs.schema, max_files=1)
    S.run_stream(src, reg, None, f"{root}/ev", f"{root}/ck", catalog_dir=f"{root}/cat",
                 trigger="availableNow").awaitTermination()
    ev = sinks.read_batches(spark, f"{root}/ev")
    assert ev.count() == 20 and ev.select("job_id").distinct().count() == 20
    cat = sinks.read_latest(sinks.read_batches(spark, f"{root}/cat"), "pid")
    assert cat.count() == 20


def test_dedup_stream_bounded_state_in_time_order(spark):
    import datetime as dt
    root = scratch_dir(spark, "test-dedup-wm")
    base = dt.datetime(2024, 1, 1)
    rows = [(i, base + dt.timedelta(hours=i)) for i in range(30)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz")
    # three time slices arrive in order, each replayed right away
    for lo, hi in [(0, 10), (10, 20), (20, 30)]:
        part = df.where(f"event_id >= {lo} AND event_id < {hi}")
        part.write.mode("append").parquet(f"{root}/in")
        part.write.mode("append").parquet(f"{root}/in")
    src = S.read_files(spark, f"{root}/in", df.schema, max_files=2)
    S.dedup_stream(src, ["event_id"], f"{root}/out", f"{root}/ck", "availableNow",
                   event_time="ts", delay="1 day").awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    assert out.count() == 30 and out.select("event_id").distinct().count() == 30


def test_pending_and_finished(spark):
    from fieldcat.operators import jobs as J
    jb = spark.createDataFrame([("a", "submitted"), ("b", "running"), ("c", "error"), ("d", "successful")],
                               "id string, status string")
    assert sorted(r.id for r in J.pending(jb).collect()) == ["a", "b"]
    assert sorted(r.id for r in J.finished(jb).collect()) == ["c", "d"]


def test_lifecycle_stream_takes_late_events_in_time_order(spark):
    import datetime as dt
    schema = "id string, event_id long, time timestamp_ntz, status string"
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    root = scratch_dir(spark, "test-late")
    batches = [[("a", 1, at(1), "submitted"), ("a", 3, at(3), "successful"), ("b", 4, at(1), "submitted"), ("c", 8, at(1), None)],
               [("a", 2, at(2), "running"), ("b", 5, at(3), "successful"), ("c", 9, at(2), "running")],
               [("z", 99, dt.datetime(2030, 1, 1), None)]]
    every = [r for b in batches[:2] for r in b]
    for b in batches:
        S.stage_files(spark.createDataFrame(b, schema).coalesce(1), f"{root}/in", ["event_id"])
    src = S.read_files(spark, f"{root}/in", spark.createDataFrame([], schema).schema, max_files=1)
    S.transition_stream(src, f"{root}/out", f"{root}/ck", "1 day", "availableNow").awaitTermination()
    got = sorted((r.id, r.event_id, r.prev_status) for r in spark.read.parquet(f"{root}/out").collect())
    batch = J.transition_issues(spark.createDataFrame(every, schema), tiebreak="event_id")
    assert got == sorted((r.id, r.event_id, r.prev_status) for r in batch.collect()) == [("b", 5, "submitted")]


def test_a_registered_job_without_a_dataset_ends_in_error(spark):
    from fieldcat.operators import sinks
    from fieldcat.operators.registry import IngestResult, Registry

    def only_present(jb, ctx):
        none = jb.where("false").select("job_id", F.lit(0).alias("seq"), J.issue_col("error", "", "s"))
        return IngestResult(jb.where("document_path <> '/ghost'").select("job_id", F.col("document_path").alias("pid")), none)

    reg = Registry()
    reg.register("m", only_present)
    reqs = spark.createDataFrame([("1", "/a", "m"), ("2", "/ghost", "m")], "job_id string, document_path string, mapping_id string")
    out = scratch_dir(spark, "test-ghost")
    S.ingest_batch(reqs, 0, reg, None, out, claim_from_table=True)
    got = {r.job_id: (r.status, r.log.split("\n")[0]) for r in sinks.read_batches(spark, out).collect()}
    assert got == {"1": ("successful", "ingested dataset: /a as /a"), "2": ("error", "ingested dataset: /ghost as None")}


def test_frames_table_first_frames_and_refs(spark):
    from fieldcat.operators import frames as fr
    from fieldcat.sources.fields import read_frames
    path = scratch_dir(spark, "test-frames")
    rows = [("/s.h5", i, 2, 2, [float(i), 1.0, 2.0, 3.0]) for i in range(3)]
    spark.createDataFrame(rows, "file_path string, frame_idx int, height int, width int, pixels array<double>") \
        .write.parquet(path)
    first = read_frames(spark, path, first_n=1)
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "frame_idx" in plan and "PushedFilters" in plan
    assert [r.frame_idx for r in first.collect()] == [0]
    from fieldcat.operators.mapping import external_refs
    from fieldcat.sources.mapping import packaged_mapping
    frames = read_frames(spark, path).withColumn("key", F.when(F.col("frame_idx") > 0, F.lit("/vec/frame")).otherwise(F.lit("/other")))
    refs = external_refs(frames, packaged_mapping(spark)).collect()
    assert sorted((r.key, r.frame_idx) for r in refs) == [("/vec/frame", 1), ("/vec/frame", 2)]
    stats = fr.frame_stats(first).first()
    assert (stats.frame_min, stats.frame_max) == (0.0, 3.0)
