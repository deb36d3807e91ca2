"""Operators against the reference's test cases (jobs, clients, access) and
the semantic contract (null vs absent, stride, fold, visibility)."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from fieldcat.operators import access, catalog, fields as fld, frames, jobs, quality, sampling
from fieldcat.operators.ordering import group_row_number
from fieldcat.schemas import FIELDS, JOB_EVENTS


def test_normalise_unboxing_rules(spark):
    rows = [
        ("f", "s0", "S", [], [], ["my sample"], None, None),          # 0-d string -> string
        ("f", "s1", "S", [1], [1], ["one"], None, None),               # (1,) string -> unboxed
        ("f", "s3", "S", [3], [3], ["a", "b", "c"], None, None),       # (3,) -> array
        ("f", "s0e", "S", [0], [0], [], None, None),                   # (0,) -> empty array
        ("f", "i1", "i", [1], [1], None, [7], None),                   # maxshape (1,) -> scalar
        ("f", "iu", "i", [1], [None], None, [7], None),                # resizable -> stays array
        ("f", "d3", "f", [3], [3], None, None, [1.0, 2.0, 3.0]),
        ("f", "i0", "i", [], [], None, [5], None),                     # 0-d number -> scalar
        ("f", "bad", "i", [1], [1], None, [], None),                   # unboxing fails -> null
    ]
    norm = fld.normalise(spark.createDataFrame(rows, FIELDS))
    got = {r.key: r for r in norm.collect()}
    assert got["s0"].value_kind == "string" and got["s0"].str_value == "my sample"
    assert got["s1"].str_value == "one"
    assert got["s3"].value_kind == "string_array" and got["s3"].str_array == ["a", "b", "c"]
    assert got["s0e"].value_kind == "string_array" and got["s0e"].str_array == []
    assert got["i1"].int_value == 7
    assert got["iu"].value_kind == "int_array" and got["iu"].int_array == [7]
    assert got["d3"].dbl_array == [1.0, 2.0, 3.0]
    assert got["i0"].int_value == 5
    assert got["bad"].value_kind == "int" and got["bad"].int_value is None


def test_missing_issues_null_vs_absent_and_duplicates(spark):
    fields = spark.createDataFrame([
        ("a.h5", "/k1", "S", [], [], [None], None, None),   # present with a null value: no issue
        ("b.h5", "/k2", "S", [], [], ["x"], None, None),
    ], FIELDS)
    files = spark.createDataFrame([("a.h5",), ("b.h5",), ("c.h5",)], "file_path string")
    iss = fld.missing_issues(files, fields, ["/k1", "/k2", "/k2"]).select("file_path", "key", "issue.msg")
    got = sorted(tuple(r) for r in iss.collect())
    assert got == [("a.h5", "/k2", "dataset not found /k2"), ("b.h5", "/k1", "dataset not found /k1"),
                   ("c.h5", "/k1", "dataset not found /k1"), ("c.h5", "/k2", "dataset not found /k2")]


def _t(s):
    return dt.datetime.fromisoformat(s)


def test_job_fold_workflow_cases(spark):
    ev = spark.createDataFrame([
        ("j1", _t("2024-01-01 00:00:00"), "submitted", "user1", None, None),
        ("j2", _t("2024-01-01 00:00:01"), "submitted", "user1", None, None),
        ("j3", _t("2024-01-01 00:00:02"), "submitted", "user1", None, None),
        ("j2", _t("2024-01-01 00:01:00"), "running", "slartibartfast", "rebuild earth", None),
        ("j3", _t("2024-01-01 00:01:00"), "running", "slartibartfast", "rebuild earth", None),
        # equal times: rank orders submitted < running < terminal
        ("j3", _t("2024-01-01 00:01:00"), "successful", "system", "done", None),
        ("j1", _t("2024-01-01 00:02:00"), "running", "system", None, None),
        ("j1", _t("2024-01-01 00:03:00"), "running", "system", "again", None),
        ("j1", _t("2024-01-01 00:04:00"), "error", "system", "boom", None),
    ], JOB_EVENTS)
    cur = {r.id: r for r in jobs.fold_jobs(ev).collect()}
    assert cur["j2"].status == "running" and cur["j2"].last_actor == "slartibartfast"
    assert cur["j2"].submitter == "user1" and cur["j2"].last_log == "rebuild earth"
    assert cur["j3"].status == "successful" and cur["j3"].end_time == _t("2024-01-01 00:01:00")
    assert cur["j1"].start_time == _t("2024-01-01 00:02:00") and cur["j1"].n_events == 4
    assert cur["j1"].end_time == _t("2024-01-01 00:04:00")
    unstarted = jobs.unstarted(jobs.fold_jobs(ev)).count()
    assert unstarted == 0
    hist = jobs.job_history(ev).where("id = 'j3'").orderBy("pos").collect()
    assert [h.status for h in hist] == ["submitted", "running", "successful"]
    assert hist[-1].history_len == 3
    # an event for an unknown job changes nothing and is reported
    orphan = spark.createDataFrame([("42", _t("2024-01-02 00:00:00"), "running", "slartibartfast", None, None)],
                                   JOB_EVENTS)
    assert jobs.orphan_events(orphan, jobs.fold_jobs(ev)).count() == 1
    lk = {r.id: r.found for r in jobs.lookup(jobs.fold_jobs(ev), spark.createDataFrame([("j1",), ("42",)], "id string")).collect()}
    assert lk == {"j1": True, "42": False}


def test_admit_clients(spark):
    key = "b3f0c7f6-key"
    digest = hashlib.sha256(key.encode()).hexdigest()
    clients = spark.createDataFrame([
        (hashlib.sha256(b"other").hexdigest(), "sirius_cybernetics_gpp", "door_operation"),
        (digest, "sirius_cybernetics_gpp", "infinite_probability_drive"),
    ], "key_digest string, client string, api string")
    reqs = spark.createDataFrame([("r1", key, "/foo/bar.hdf5"), ("r2", "foobar", "/foo/bar.hdf5")],
                                 "id string, api_key string, document_path string")
    acc, rej = jobs.admit(reqs, clients)
    a = acc.collect()
    assert [(r.id, r.submitter) for r in a] == [("r1", "sirius_cybernetics_gpp")]
    assert [r.id for r in rej.collect()] == ["r2"]


def test_final_status_and_log(spark):
    jb = spark.createDataFrame([("j1", "/a.h5", "pid1"), ("j2", "/b.h5", "pid2"), ("j3", "/c.h5", None)],
                               "job_id string, file_path string, dataset_id string")
    from fieldcat.functions.issues import issue
    iss = spark.createDataFrame([("j1", 1, "warning", "w1", None), ("j3", 0, "error", "e1", "Boom"),
                                 ("j3", 1, "warning", "w2", None)],
                                "job_id string, seq int, sev string, msg string, exc string")
    iss = iss.select("job_id", "seq", issue(F.col("sev"), F.col("msg"), "s", F.col("exc")).alias("issue"))
    st = {r.job_id: r.status for r in jobs.final_status(jb, iss).collect()}
    assert st == {"j1": "complete_with_issues", "j2": "successful", "j3": "error"}
    logs = {r.job_id: r.log for r in jobs.job_log(jb, iss).collect()}
    assert logs["j2"] == "ingested dataset: /b.h5 as pid2"
    assert logs["j3"] == "ingested dataset: /c.h5 as None\n :  e1\n    Exception: Boom\n :  w2"


def test_visibility_doc_example(spark):
    ds = spark.createDataFrame([("d1", "PROP-000", ["bl0.0.0"])], "pid string, ownerGroup string, accessGroups array<string>")
    users = spark.createDataFrame([("User1", ["PROP-000", "PROP-000-001"]), ("User2", ["PROP-0001"]),
                                   ("BeamlineScientist", ["bl0.0.0"])], "user string, groups array<string>")
    got = {r.user: (r.can_read, r.can_write) for r in access.visible(ds, users).collect()}
    assert got == {"User1": (True, True), "BeamlineScientist": (True, False)}


def test_visibility_rewrite_equals_plain(spark):
    import random
    rnd = random.Random(5)
    groups = [f"g{i}" for i in range(12)]
    ds = [(f"d{i}", rnd.choice(groups), rnd.sample(groups, rnd.randint(0, 4))) for i in range(80)]
    us = [(f"u{i}", rnd.sample(groups, rnd.randint(0, 5))) for i in range(30)]
    d = spark.createDataFrame(ds, "pid string, ownerGroup string, accessGroups array<string>")
    u = spark.createDataFrame(us, "user string, groups array<string>")
    a = sorted(tuple(r) for r in access.visible(d, u).collect())
    b = []
    for name, own in us:  # the rule, spelled out
        for pid, owner, more in ds:
            if owner in own or set(more) & set(own):
                b.append((name, pid, True, owner in own))
    assert a == sorted(b) and len(a) > 0


def test_route_shares(spark):
    ds = spark.createDataFrame([(1, "p1"), (2, "p2")], "pid int, proposal string")
    sh = spark.createDataFrame([("p1", "/shares/p1")], "proposal string, share_folder string")
    got = {r.pid: (r.routed, r.issue.msg if r.issue else None) for r in access.route_shares(ds, sh).collect()}
    assert got == {1: (True, None), 2: (False, "no share for proposal p2")}


def test_group_row_number_hot_group(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3 == 0).cast("int").alias("g"), F.col("id"),
                                     (F.col("id") * 7 % 5000).alias("o"))
    out = group_row_number(df, ["g"], ["o", "id"]).toPandas()
    for g, part in out.groupby("g"):
        part = part.sort_values(["o", "id"])
        assert list(part.rn) == list(range(1, len(part) + 1))
        assert (part.n == len(part)).all()


def test_stride_rows(spark):
    df = spark.createDataFrame([(g, i) for g, n in [("a", 25), ("b", 5), ("c", 10)] for i in range(n)],
                               "g string, i int")
    got = sampling.stride_rows(df, order_by=["i"], partition_by=["g"]).toPandas()
    assert sorted(got[got.g == "a"].i) == list(range(0, 25, 2))
    assert sorted(got[got.g == "b"].i) == list(range(5))
    assert sorted(got[got.g == "c"].i) == list(range(10))
    js = sampling.to_column_json(got[["g", "i", "row_idx"]].pipe(spark.createDataFrame).where("g = 'b'"),
                                 ["g"], "row_idx", ["i"]).first().page_json
    assert js == '{"i":{"0":0,"1":1,"2":2,"3":3,"4":4}}'


def _autocontrast_reference(levels, cutoff=0.1):
    """The bin-by-bin cutting loop of an 8-bit autocontrast, for comparison."""
    h = [0] * 256
    for v in levels:
        h[v] += 1
    n = sum(h)
    cut = n * cutoff // 100
    for lo in range(256):
        if cut > h[lo]:
            cut -= h[lo]
            h[lo] = 0
        else:
            h[lo] -= cut
            cut = 0
        if cut <= 0:
            break
    cut = n * cutoff // 100
    for hi in range(255, -1, -1):
        if cut > h[hi]:
            cut -= h[hi]
            h[hi] = 0
        else:
            h[hi] -= cut
            cut = 0
        if cut <= 0:
            break
    lo = next((i for i in range(256) if h[i]), 0)
    hi = next((i for i in range(255, -1, -1) if h[i]), 255)
    if hi <= lo:
        return list(levels)
    scale = 255.0 / (hi - lo)
    offset = -lo * scale
    return [min(max(int(v * scale + offset), 0), 255) for v in levels]


def test_contrast_stretch_matches_bin_loop(spark):
    import random
    rnd = random.Random(11)
    rows = []
    for f in range(6):
        n = rnd.choice([1, 50, 1500, 4000])
        base = rnd.randint(0, 200)
        for p in range(n):
            rows.append((f, p, min(255, base + int(rnd.expovariate(0.05)))))
    df = spark.createDataFrame(rows, "frame int, pix int, v int")
    got = frames.contrast_stretch(df, ["frame"], "v").toPandas()
    for f, part in got.groupby("frame"):
        part = part.sort_values("pix")
        assert list(part.stretched) == _autocontrast_reference(list(part.v)), f


def test_first_wins_and_duplicates(spark):
    df = spark.createDataFrame([("s1", 2, "b"), ("s1", 1, "a"), ("s2", 5, "c")], "spec string, pos int, f string")
    got = sorted(tuple(r) for r in quality.first_wins(df, "spec", ["pos"]).collect())
    assert got == [("s1", 1, "a"), ("s2", 5, "c")]
    d = quality.duplicate_ids(df, ["spec"]).collect()
    assert [(r.spec, r.n_rows) for r in d] == [("s1", 2)]


def test_catalog_records(spark):
    meta = spark.createDataFrame([
        ("/data/x/a.h5", 10, None, "Time-is_an illusion.", None, "", "bl832-inst", "42", "bl832", "svc", "{}"),
    ], "file_path string, size long, mod_time timestamp, file_name string, pi string, email string, "
       "instrument_name string, proposal string, beamline string, username string, scientific_metadata string")
    ds = catalog.dataset_records(meta).first()
    assert ds.owner == "Unknown" and ds.contactEmail == "Unknown" and ds.creationLocation == "bl832-inst"
    assert ds.description == "time is an illusion" and ds.keywords == ["time", "is", "an", "illusion"]
    assert ds.sourceFolder == "/data/x" and ds.ownerGroup == "42"
    assert ds.accessGroups == ["bl832", "svc", "8.3.2"]
    assert ds.pid == hashlib.sha256(b"/data/x/a.h5").hexdigest()
    files = spark.createDataFrame([("/data/x/a.h5", 10, dt.datetime(2024, 1, 2, 3, 4, 5))],
                                  "file_path string, size long, mod_time timestamp")
    blocks = catalog.datablocks(files, catalog.dataset_records(meta)).first()
    assert blocks.datasetId == ds.pid and blocks.dataFileList[0].path == "a.h5"
    assert blocks.dataFileList[0].type == "RawDatasets" and blocks.accessGroups == ds.accessGroups


def test_stride_elements_equals_array_form(spark):
    from fieldcat.functions import stride_array
    rows = [(i, [float(x) for x in range(n)]) for i, n in enumerate([0, 1, 9, 10, 19, 20, 25, 105])]
    df = spark.createDataFrame(rows, "id int, a array<double>")
    arr = {r.id: r.s for r in df.select("id", stride_array("a").alias("s")).collect()}
    long = sampling.stride_elements(df, ["id"], "a").toPandas()
    for i, want in arr.items():
        part = long[long.id == i].sort_values("pos")
        assert list(part.value) == want
        assert list(part.pos) == list(range(len(want)))
        if len(part):
            assert (part.sample_len == len(want)).all()


def test_visibility_functional_login(spark):
    ds = spark.createDataFrame([("d1", "robot", ["bl1"]), ("d2", "grp", [])],
                               "pid string, ownerGroup string, accessGroups array<string>")
    users = spark.createDataFrame([("u1", "robot", ["bl1"]), ("u2", "robot", ["grp"])],
                                  "user string, login string, groups array<string>")
    got = sorted(tuple(r) for r in access.visible(ds, users, login="login").collect())
    assert got == [("u1", "d1", True, True), ("u2", "d1", True, True), ("u2", "d2", True, True)]


def test_transition_issues(spark):
    from fieldcat.schemas import JOB_EVENTS
    ev = spark.createDataFrame([
        ("j1", _t("2024-01-01 00:00:00"), "submitted", "u", None, None),
        ("j1", _t("2024-01-01 00:01:00"), "running", "s", None, None),
        ("j1", _t("2024-01-01 00:02:00"), "successful", "s", None, None),
        ("j1", _t("2024-01-01 00:03:00"), "running", "s", None, None),      # after a terminal state
        ("j2", _t("2024-01-01 00:00:00"), "running", "s", None, None),      # never submitted
        ("j2", _t("2024-01-01 00:00:00"), "submitted", "u", None, None),    # equal time: ranks first
    ], JOB_EVENTS)
    got = sorted((r.id, r.prev_status, r.status) for r in jobs.transition_issues(ev).collect())
    assert got == [("j1", "successful", "running")]


def test_group_row_number_mixed_hot_and_cold(spark):
    sizes = {"hot": 3000, "warm": 150, "cold": 7, "one": 1}
    rows = [(g, i, (i * 37) % 1009) for g, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "g string, i int, o int")
    out = group_row_number(df, ["g"], ["o", "i"]).toPandas()
    assert len(out) == sum(sizes.values())
    for g, part in out.groupby("g"):
        part = part.sort_values(["o", "i"])
        assert list(part.rn) == list(range(1, sizes[g] + 1))
        assert (part.n == sizes[g]).all()


def test_stride_rows_single_page(spark):
    df = spark.range(0, 105).withColumnRenamed("id", "i")
    got = sampling.stride_rows(df, order_by=["i"]).toPandas().sort_values("i")
    assert list(got.i) == list(range(0, 105, 10))
    assert (got.n == 105).all() and list(got.row_idx) == list(range(0, 105, 10))


def test_match_registry_list_and_table_agree(spark):
    jb = spark.createDataFrame([("j1", "/a.h5", "s1"), ("j2", "/b.h5", "s9"), ("j3", "/c.h5", None)],
                               "job_id string, document_path string, mapping_id string")
    as_list = jobs.match_registry(jb, ["s1", "s2"])
    as_table = jobs.match_registry(jb, spark.createDataFrame([("s1",), ("s2",)], "spec string"))
    a = sorted((r.job_id, r.registered, r.issue.msg if r.issue else None) for r in as_list.collect())
    b = sorted((r.job_id, r.registered, r.issue.msg if r.issue else None) for r in as_table.collect())
    assert a == b
    assert a[1] == ("j2", False, "mapping is not configured /b.h5 and mapping s9")


def test_group_row_number_string_order_and_many_buckets(spark):
    rows = [("hot", f"k{(i * 7919) % 4001:05d}", i) for i in range(4000)] + [("c", "a", 1), ("c", "a", 0)]
    df = spark.createDataFrame(rows, "g string, s string, i int")
    out = group_row_number(df, ["g"], ["s", "i"]).toPandas()
    for g, part in out.groupby("g"):
        part = part.sort_values(["s", "i"])
        assert list(part.rn) == list(range(1, len(part) + 1))


def test_attachments_and_orphans(spark):
    import base64
    meta = spark.createDataFrame([
        ("/d/a.h5", 1, None, "a", None, None, "i", None, "bl1", "svc", "{}"),
        ("/d/b.h5", 1, None, "b", None, None, "i", "7", None, "svc", "{}"),
    ], "file_path string, size long, mod_time timestamp, file_name string, pi string, email string, "
       "instrument_name string, proposal string, beamline string, username string, scientific_metadata string")
    ds = catalog.dataset_records(meta)
    png = b"\x89PNG\r\n\x1a\n" + bytes(range(200))
    images = spark.createDataFrame([("/d/a.h5", png), ("/d/zzz.h5", png)], "file_path string, content binary")
    att = catalog.attachments(images, ds).collect()
    assert len(att) == 1  # the image of an unknown file has no dataset to attach to
    a = att[0]
    assert a.thumbnail == "data:image/jpg;base64," + base64.b64encode(png).decode()
    assert a.caption == "raw image" and a.ownerGroup == "svc" and a.accessGroups == ["bl1", "svc"]
    orphan = catalog.orphans(images, ds, "file_path", "file_path").collect()
    assert [r.file_path for r in orphan] == ["/d/zzz.h5"]


def test_group_row_number_nulls_sort_first(spark):
    rows = [("g", None if i % 97 == 0 else float(i % 500), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, o double, i int")
    out = group_row_number(df, ["g"], ["o", "i"]).toPandas()
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] if r[1] is not None else 0.0, r[2]))
    got = out.sort_values("rn")
    assert list(got.i) == [r[2] for r in want]


def test_group_row_number_constant_first_order_column(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    rows = [("g", t0, (i * 31) % 2000, i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, t timestamp_ntz, o int, i int")
    out = group_row_number(df, ["g"], ["t", "o", "i"]).toPandas()
    got = out.sort_values("rn")
    assert list(got.i) == [r[3] for r in sorted(rows, key=lambda r: (r[2], r[3]))]


def test_group_row_number_splits_hot_and_null_groups(spark):
    from fieldcat.operators.ordering import piece_of
    rows = [(g, i * 1000) for g in ("hot", None) for i in range(2000)] + [("one", None)]
    df = spark.createDataFrame(rows, "g string, o long")
    pieces = {r.g: r.n for r in df.withColumn("p", piece_of(df, "o")).groupBy("g").agg(F.count_distinct("p").alias("n")).collect()}
    assert pieces["hot"] > 1 and pieces[None] > 1
    out = group_row_number(df, ["g"], ["o"], previous={"before": "o"}).collect()
    got = sorted((r.rn, r.o, r.before, r.n) for r in out if r.g is None)
    assert got == [(i + 1, i * 1000, (i - 1) * 1000 if i else None, 2000) for i in range(2000)]
    assert [(r.rn, r.n, r.before) for r in out if r.g == "one"] == [(1, 1, None)]


def test_admit_once_for_a_key_of_two_apis(spark):
    req = spark.createDataFrame([("r1", "k1")], "id string, api_key string")
    cl = spark.createDataFrame([("k1", "c", "a"), ("k1", "c", "b")], "k string, client string, api string")
    cl = cl.select(F.sha2("k", 256).alias("key_digest"), "client", "api")
    acc, rej = jobs.admit(req, cl)
    assert [(r.id, r.submitter) for r in acc.collect()] == [("r1", "c")] and rej.count() == 0


def test_files_without_requested_keys_stay(spark):
    from fieldcat.operators import fields as fld
    from fieldcat.schemas import FIELDS
    files = spark.createDataFrame([("/a",), ("/b",)], "file_path string")
    norm = fld.normalise(spark.createDataFrame([("/a", "k", "S", [], [], ["v"], None, None)], FIELDS))
    got = {r.file_path: r.metadata for r in fld.metadata_json(norm, ["k"], files=files).collect()}
    assert got == {"/a": '{"k":"v"}', "/b": "{}"}
    wide = {r.file_path: r.k for r in fld.pivot_fields(fld.value_text(norm), ["k"], files=files).collect()}
    assert wide == {"/a": "v", "/b": None}


def test_visibility_flags_are_never_null(spark):
    ds = spark.createDataFrame([("d", None, ["g"])], "pid string, ownerGroup string, accessGroups array<string>")
    users = spark.createDataFrame([("u", ["g"], None)], "user string, groups array<string>, login string")
    assert [(r.can_read, r.can_write) for r in access.visible(ds, users, login="login").collect()] == [(True, False)]
    assert [(r.group, r.can_read, r.can_write) for r in access.grants(ds).collect()] == [("g", True, False)]


def test_a_raising_ingestor_fails_its_own_jobs_only(spark):
    from fieldcat.operators.registry import IngestResult, Registry

    def good(jb, ctx):
        none = jb.where("false").select("job_id", F.lit(0).alias("seq"), jobs.issue_col("error", "", "s"))
        return IngestResult(jb.select("job_id", F.col("document_path").alias("pid")), none)

    def bad(jb, ctx):
        raise ValueError("broken")

    reg = Registry()
    reg.register("g", good)
    reg.register("b", bad)
    jb = spark.createDataFrame([("1", "/x", "g"), ("2", "/y", "b")], "job_id string, document_path string, mapping_id string")
    _, res = reg.run(jb, None)
    assert [r.job_id for r in res.datasets.collect()] == ["1"]
    assert [(r.job_id, r.issue.exception) for r in res.issues.collect()] == [("2", "ValueError: broken")]


def test_upsert_ties_agree(spark):
    from fieldcat.operators import sinks
    rows = [("k", v, 0) for v in ("a", "b", "c")]
    got = {sinks.read_latest(spark.createDataFrame(r, "k string, v string, _batch int"), "k").first().v for r in (rows, rows[::-1])}
    assert len(got) == 1


def test_ingest_types_are_checked_and_carried(spark):
    req = spark.createDataFrame([("1", ["a"]), ("2", ["a", "x"]), ("3", None), ("4", [])], "id string, ingest_types array<string>")
    good, bad = jobs.check_types(req, ["a", "b"])
    assert sorted((r.id, r.ingest_types) for r in good.collect()) == [("1", ["a"]), ("3", None), ("4", [])]
    assert [(r.id, r.issue.msg) for r in bad.collect()] == [("2", "unknown ingest types x")]
